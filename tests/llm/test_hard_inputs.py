"""Very long texts and runs, samples that must lose nothing, exact optima of small cases."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language_id, packing, pretokens, quality_rules, secret_scan, token_counts

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def long_runs():
    rng = random.Random(1)
    n = 1_200_000
    yield from ("a" + c * n + "b" for c in (" ", "\n", "\t", "x", "=", "7", "é", " "))
    yield "a" + "".join(rng.choice(" \t\n\r") for _ in range(n)) + "b" + "".join(rng.choice("abcdefghij") for _ in range(n))
    yield "a" + " " * 10_000_000 + "b"
    yield "a" * 10_000_000
    yield "<|endoftext|>" + " " * n


def test_runs_of_millions_of_characters_equal_the_library(spark):
    library = pretokens.load("byte_bpe_50k.json")
    encoder = pretokens.RankEncoder("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    texts = list(long_runs())
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for t, ids in zip(texts, want, strict=True):
        assert encoder.text(t).tolist() == ids
    few = [0, 1, 8, 11]
    docs = spark.createDataFrame([(k, texts[k]) for k in few], "doc_id long, text string")
    counted = {r.doc_id: (r.n_tokens, r.n_bytes) for r in token_counts.token_counts(docs).collect()}
    assert counted == {k: (len(want[k]), len(texts[k].encode())) for k in few}
    packed = packing.best_fit_pack(docs).collect()
    for k in few:
        pieces = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in packed if r.doc_id == k)
        ids = np.array([*want[k], 0], "<u4")
        assert [p[1] for p in pieces] == np.cumsum([0, *(p[2] for p in pieces[:-1])]).tolist() and sum(p[2] for p in pieces) == len(ids)
        assert all(p[3] == zlib.crc32(ids[p[1] : p[1] + p[2]].tobytes()) for p in pieces[:3] + pieces[-2:])


def optimum(lengths, tokens, docs, cost):
    """Fewest sequences, by trying all placements."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in sorted(set(bins)):
            size = lengths[i]
            if b[0] + size <= tokens and b[1] < docs and b[2] + size * size <= cost:
                rest = list(bins)
                rest[rest.index(b)] = (b[0] + size, b[1] + 1, b[2] + size * size)
                go(i + 1, rest)
        go(i + 1, [*bins, (lengths[i], 1, lengths[i] ** 2)])

    go(0, [])
    return best


@pytest.mark.parametrize(("docs", "cost"), [(None, None), (3, None), (None, 4200.0), (2, 4200.0)])
def test_packing_is_near_the_optimum_under_every_capacity(docs, cost):
    rng = random.Random(2)
    equal = 0
    for _ in range(120):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 9))]
        bins, _ = packing.pack_balanced(lengths, 100, docs, cost)
        best = optimum(lengths, 100, docs or 100, cost or 1e9)
        used = len(set(bins.tolist()))
        assert best <= used <= best + 1
        equal += used == best
    assert equal >= 110


def test_default_capacities_bind_and_cost_no_sequence():
    rng = random.Random(3)
    lengths = [min(2048, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(8000)] + [1] * 400 + [2048] * 300
    loose, _ = packing.pack(lengths, 2048, 2048, 2048.0**2)
    tight, offsets = packing.pack_balanced(lengths, 2048, None, None)
    assert np.bincount(tight).max() < np.bincount(loose).max()
    assert len(set(tight.tolist())) <= len(set(loose.tolist()))
    assert np.bincount(tight, weights=lengths).max() <= 2048
    assert all(sorted(offsets[tight == b])[0] == 0 for b in range(0, 2000, 97))


def test_long_and_repeated_texts_teach_their_language(spark):
    rng = random.Random(4)
    english, french = [f"the{a}{b}" for a in "abcdefgh" for b in "stuvwx"], [f"le{a}{b}" for a in "mnopqrst" for b in "efghij"]
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(say(english, 5000), "en") for _ in range(20)] + [(say(french, 40), "fr")] * 900 + [(say(english, 30), "en")] * 9000
    known = language_id.Identifier(language_id.learn_dictionaries(spark.createDataFrame(rows, "text string, lang string")))
    assert known.names == ["en", "fr"]
    assert known.identify(say(english, 60))[0] == "en" and known.identify(say(french, 60))[0] == "fr"


def brute_identify(text, dictionaries):
    """Compressed sizes by plain calls, one compressor per block."""
    import zstandard

    raw = language_id.letters(text)
    sizes = {}
    for name, content in dictionaries.items():
        total = 0
        for at in range(0, len(raw), language_id.BLOCK_BYTES):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            total += len(zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(raw[at : at + language_id.BLOCK_BYTES]))
        sizes[name] = total
    order = sorted(sizes, key=lambda n: (sizes[n], n))
    margin = sizes[order[1]] - sizes[order[0]]
    return order[0], margin, margin < max(language_id.MIN_MARGIN_BYTES, language_id.MIN_MARGIN_PART * sizes[order[0]])


def test_language_choice_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    dictionaries = language_id.learn_dictionaries(docs)
    rows = docs.where("text IS NOT NULL").collect()
    got = {r.doc_id: (r.lang_pred, r.margin_bytes, r.rejected) for r in language_id.identify_languages(docs, dictionaries).collect()}
    for r in rows:
        want = brute_identify(r.text, dictionaries)
        if any(map(str.isalpha, r.text)):
            assert (got[r.doc_id][0], got[r.doc_id][2]) == (want[0], want[2]) and abs(got[r.doc_id][1] - want[1]) <= 2, r.doc_id
        else:
            assert got[r.doc_id][0] == "und"


def test_kept_columns_that_clash_give_way(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox", 2.5, True, "x")], "doc_id long, text string, score double, kept boolean, lang_pred string")
    judged = quality_rules.judge(docs, quality_rules.fit(docs, None), keep=("score", "kept", "lang_pred"))
    assert judged.columns.count("kept") == 1 and judged.first().lang_pred == "x" and judged.first().kept is False
    found = language_id.identify_languages(docs, {"en": b"the quick brown fox"}, keep=("score", "kept", "lang_pred"))
    assert found.columns == ["doc_id", "kept", "lang_pred", "score", "margin_bytes", "rejected"] and found.first().lang_pred == "en"


def credential(rng):
    return "gtx_" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(28))


def test_a_credential_of_any_length_teaches(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("0123456789abcdefXYZ") for _ in range(300))
    grammars = secret_scan.learn_grammars(spark.createDataFrame([(1, f"password={long} end")], "doc_id long, text string"))
    assert "assign" in grammars.automata and grammars.ratio(long[:256].translate(secret_scan._CLASS)) > 0


def test_learned_spans_find_bare_secrets_and_leave_clean_texts_alone(spark):
    rng = random.Random(6)
    links = lambda: f"https://example.com/{rng.choice(WORDS)}-{rng.choice(WORDS)}/{rng.choice(WORDS)}.html"
    clean = [(i, f"{prose(rng, 30)} {links()} antidisestablishmentarianism well-known-long-hyphenated-words {rng.randint(10**15, 10**16)} {prose(rng, 9)}") for i in range(300)]
    told = [(1000 + i, f'{prose(rng, 9)} token = "{credential(rng)}" {prose(rng, 9)}') for i in range(200)]
    planted = {2000 + i: credential(rng) for i in range(40)}
    bare = [(i, f"{prose(rng, 9)} {c} {prose(rng, 9)}") for i, c in planted.items()]
    docs = spark.createDataFrame(clean + told + bare + [(None, None), (3000, ""), clean[0]], "doc_id long, text string")
    grammars = secret_scan.learn_grammars(docs)
    got = {r.doc_id: r for r in secret_scan.scan_secrets(docs, grammars).collect()}
    texts = dict(bare)
    caught = [i for i, c in planted.items() if f"learned:{texts[i].index(c)}:{texts[i].index(c) + len(c)}" in got[i].spans.split(",")]
    assert len(caught) >= 38 and all(got[i].n_learned == 1 and got[i].n_assign == 0 for i in caught)
    assert sum(got[i].n_learned > 0 for i, _ in clean) <= 3
    # Candidates inside base spans are scored as well, and by the automaton of their kind.
    assert all(got[i].n_learned == 0 and got[i].scored for i, _ in told)
    assert sum(max(s.score for s in got[i].scored) > grammars.threshold for i, _ in told) >= 190
    assert {s.automaton for i, _ in told for s in got[i].scored} == {"assign"}
    assert credential(rng) not in secret_scan.redact(f"x {credential(rng)} y", grammars)
