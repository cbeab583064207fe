"""Text operators against brute force, the libraries they must equal, and edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, language_id, line_dedup, minhash_dedup, packing, pretokens, quality_rules, secret_scan, skew, substring_dedup, token_counts
from tidemark.llm.components import connected_components
from tidemark.llm.textops import shingle_set
from tidemark.llm.workspace import Workspace

ODD = [None, "", " ", "\n\n", "a", "Straße  ΣΑΣ é́\t日本語 ½", "<|endoftext|>hi <|startoftext|>", "don't we'LL\r\n x", "\x85\x1c  end  ", "ʼn " * 50, "word " * 3000, "\U0001f600" * 40]
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n_tokens string, kept int")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = list(enumerate(ODD)) + [(100 + i, prose(rng, rng.randint(1, 120))) for i in range(60)]
    return rows + [rows[5], rows[70], (None, "no id"), (None, None)]


def test_token_counts_equal_the_library(spark, docs):
    lib = pretokens.load("byte_bpe_50k.json")
    got = sorted(map(tuple, token_counts.token_counts(frame(spark, docs), table_size=50).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in docs]
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(frame(spark, [])).count() == 0


def test_codec_equals_the_library(spark, docs):
    lib = pretokens.load("word_bpe_49k.json")
    want = []
    for i, t in docs:
        e = lib.encode(t or "", add_special_tokens=False)
        want.append((i, len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe_codec.bpe_digests(frame(spark, docs)).collect()), key=str) == sorted(want, key=str)
    codec = bpe_codec.BpeCodec("word_bpe_49k.json")
    rng = random.Random(2)
    for _ in range(2000):
        w = "".join(rng.choice("abcdehilnorst'!é") for _ in range(rng.randint(1, 14)))
        ids = codec.encode(w)
        assert ids == lib.encode(w, add_special_tokens=False).ids and codec.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    assert bpe_codec.bpe_encode(frame(spark, [(1, "hello")])).first().ids == lib.encode("hello", add_special_tokens=False).ids


def test_packing_is_whole_gapless_and_tight(spark, docs):
    lib = pretokens.load("byte_bpe_50k.json")
    rows = packing.best_fit_pack(frame(spark, docs), max_tokens=256, group_size=40).collect()
    want = []
    for i, t in docs:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 256 if len(ids) > 256 else len(ids)
        cuts = [(0, first)] * bool(first) + [(s, 256) for s in range(first, len(ids), 256)]
        want += [(i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cuts)]
    assert sorted((tuple(r[:5]) for r in rows), key=str) == sorted(want, key=str)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.best_fit_pack(frame(spark, [])).count() == 0


@pytest.mark.parametrize("rule", ["residual", "dot"])
def test_pack_respects_every_capacity(rule):
    rng = random.Random(4)
    lengths = [rng.randint(1, 70) for _ in range(2000)]
    bins, offsets = packing.pack(lengths, 100, 3, 6000.0, rule=rule)
    held = {}
    for b, n in zip(bins, lengths, strict=True):
        held.setdefault(b, []).append(n)
    assert all(sum(v) <= 100 and len(v) <= 3 for v in held.values())
    assert all(sum(x * x for x in v) <= 6000 for v in held.values())
    free, _ = packing.pack(lengths, 100, 10**6, 1e9, rule="residual")
    assert len(set(free.tolist())) <= 1.02 * -(-sum(lengths) // 100) + 1
    with pytest.raises(ValueError):
        packing.pack([101], 100, 3, 1e9)


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    pool = [f" Line {i} " for i in range(12)] + ["", "\t", "É x", "é x"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 8)))) for i in range(40)] + [(50, None), (51, ""), (52, "\n")]
    rows += [rows[3], (None, "line 1"), (None, None)]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    found = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            found.setdefault(key(line), set()).add(("t", t) if i is None else i)
    gone = {k for k, v in found.items() if k and len(v) >= 10}
    assert gone
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        want.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def brute_sets(rows):
    out = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute_components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_rows(seed):
    """Groups of near copies with edits around the threshold, copies, shared passages, short texts."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    rows = []
    for g in range(12):
        base = prose(rng, rng.randint(40, 150)).split()
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 22))):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            rows.append(" ".join(w))
    rows += [shared + " " + prose(rng, 40) for _ in range(15)] + ["a b", "A  B", "a b c", "", None, " \n"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = near_rows(seed)
    sets = brute_sets(rows)
    want = brute_components(sets)
    extra = [rows[0], (None, "a b"), (None, None)]
    got = minhash_dedup.near_duplicates(frame(spark, rows + extra)).collect()
    assert len(got) == len(rows) + 3
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {(i, len(sets[i]), c, c == i) for i, c in want.items()}
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert minhash_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_tiles_find_what_the_leader_misses(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "TILE", 4)
    monkeypatch.setattr(skew, "HOT", 3)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    rows = near_rows(9)
    want = brute_components(brute_sets(rows))
    assert {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame(spark, rows)).collect()} == want


def test_exact_copies_are_linked_whoever_leads_their_buckets(spark):
    """Smaller ids that are not near-duplicates lead all buckets of a text: its copies still form one group."""
    rng = random.Random(21)
    base = prose(rng, 100)
    rows = [(i, base + " " + prose(rng, rng.randint(36, 42))) for i in range(400)]
    rows += [(1000 + i, base.upper() if i % 2 else base) for i in range(5)]
    want = brute_components(brute_sets(rows))
    assert {want[1000 + i] for i in range(5)} == {1000}
    assert {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame(spark, rows)).collect()} == want


def test_bands_and_bayes_bounds():
    p = minhash_dedup.MinHash()
    assert p.recall(0.75) > 0.9999
    bands, rows = minhash_dedup.tune_bands(75, 0.999, 48)
    assert 1 - (1 - 0.75**rows) ** bands >= 0.999 and bands * rows <= 48
    need = minhash_dedup.needed_matches(p)
    assert list(need) == sorted(need) and need[-1] < 0.75 * p.size
    assert len(shingle_set("a b c d")) == 1 and len(shingle_set(" ")) == 0


def test_components_equal_brute_force(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(0, i) for i in range(400, 460)] + [(i, i + 1) for i in range(500, 540)] + [(7, 7), (None, 1)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(Workspace(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_repeated_passages(spark):
    rng = random.Random(6)
    passage = prose(rng, 55)
    para = prose(rng, 40).split()
    edited = para[:]
    edited[20] = "changed"
    rows = [(1, prose(rng, 30) + " " + passage + " " + prose(rng, 30)), (2, prose(rng, 70) + "\n" + prose(rng, 25) + " " + passage.upper() + " " + prose(rng, 9)), (3, " ".join(para) + "\n" + prose(rng, 30)), (4, prose(rng, 30) + "\n" + " ".join(edited)), (5, prose(rng, 200)), (6, "short line\nsame"), (7, "short line\nsame"), (8, None), (None, passage)]
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1].n_spans == 1 and got[1].removed_spans == [] and got[2].removed_spans
    s = got[2].spans[0]
    assert rows[1][1].encode()[s.start : s.end].decode().lower() in passage
    assert [(p.pos, p.removed) for p in got[3].paragraphs] == [(0, False)] and [(p.pos, p.removed) for p in got[4].paragraphs] == [(1, True)]
    assert substring_dedup.repeated_passages(frame(spark, [])).count() == 0


def test_copies_of_a_short_line_that_longer_lines_extend(spark):
    """The copies' hashed ids are the largest, so longer lines lead all their buckets."""
    rng = random.Random(31)
    order = [r.id for r in spark.range(220).select("id", F.xxhash64("id", F.lit(0)).alias("h")).orderBy("h").collect()]
    line = prose(rng, 30)
    rows = [(i, line + " " + prose(rng, 10)) for i in order[:-4]] + [(i, line) for i in order[-4:]]
    got = {r.doc_id: r.paragraphs for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    copies = sorted(order[-4:])
    assert [[p.removed for p in got.get(i, [])] for i in copies] == [[False], [True], [True], [True]]
    assert len({got[i][0].cluster for i in copies}) == 1


def test_repeats_within_one_document(spark):
    rng = random.Random(32)
    passage, line = prose(rng, 60), prose(rng, 25)
    text = " ".join([prose(rng, 15), passage, prose(rng, 15), passage, prose(rng, 15)])
    rows = [(1, text), (2, "\n".join([line, "gap", line, line])), (3, prose(rng, 10) + " " + passage), (4, prose(rng, 90)), (5, prose(rng, 90)), (5, prose(random.Random(33), 90))]
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == {1, 2, 3}
    second = text.rindex(passage)
    assert got[1].removed_spans and all(second <= s.start and s.end <= second + len(passage) for s in got[1].removed_spans)
    assert got[1].n_spans == 2 and got[3].removed_spans
    assert [(p.pos, p.removed) for p in got[2].paragraphs] == [(0, False), (2, True), (3, True)]


def brute_quality(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n")]
    dup = sum(1 for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:k])
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    inside = set()
    for k, g in enumerate(grams):
        if grams.count(g) > 1:
            inside |= {k, k + 1, k + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(inside)


def test_quality_base_equals_brute_force_and_verdicts_separate(spark):
    rng = random.Random(11)
    good = [(i, prose(rng, 80)) for i in range(120)]
    bad = [(1000 + i, " ".join(w + rng.choice("*#") for w in prose(rng, 80).split())) for i in range(40)]
    odd = [(2000 + i, t) for i, t in enumerate([*ODD[:-2], "x y z " * 30, "a b\na b\n \n \nc", "one two three one two three"])]
    rows = good + bad + odd + [(None, "x " * 60), good[0]]
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:60]] + [(i, 0) for i, _ in bad[:20]] + [(good[61][0], 1), (good[61][0], 0), (None, 1), (3, None)], "doc_id long, quality int")
    docs = frame(spark, rows)
    model = quality_rules.fit(docs, labels)
    got = quality_rules.judge(docs, model).collect()
    text = dict(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(text[r.doc_id]), r.doc_id
            assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
    kept = {r.doc_id for r in got if r.kept}
    assert {i for i, _ in good} <= kept and not kept & {i for i, _ in bad}
    rest = quality_rules.keep_good(docs, model)
    assert rest.columns == docs.columns and {r.doc_id for r in rest.collect()} == kept
    assert quality_rules.judge(frame(spark, []), quality_rules.fit(frame(spark, []), None)).count() == 0


def brute_secrets(t):
    out = []
    for kind, pattern, group, least in (("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, t or "") if len(m[group]) >= least]
    return sorted(out, key=lambda s: (s[0], ["assign", "access", "hex"].index(s[1])))


def test_secret_scan(spark):
    rng = random.Random(12)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"{prose(rng, 10)} password={hexes(18)} é {prose(rng, 5)}") for i in range(30)] + [(100 + i, f'x token = "{hexes(40)}" y') for i in range(30)]
    rows += [(200 + i, "AKIA" + "".join(rng.choice("ABCDEFGHIJ23456789") for _ in range(16))) for i in range(30)]
    rows += [(300, None), (301, ""), (302, "secret=token:abcdefgh"), (303, "ſecret=abcdefgh PASSWD: 'a.b/c=d'"), (304, "AKIA2"), (305, hexes(24).upper()), (306, "plain words only and nothing else " * 9), (307, f"see {hexes(12)}Zq{hexes(12)} end"), (None, "apikey:123456")]
    docs = frame(spark, rows)
    grammars = secret_scan.learn_grammars(docs)
    for r in secret_scan.scan_secrets(docs, grammars).collect():
        want = brute_secrets(dict(rows)[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in want) for x in ("assign", "access", "hex"))
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("learned")) == joined
        if r.doc_id == 306:
            assert r.spans == ""
    assert secret_scan.redact('a password="abcdef123456" b', grammars) == 'a [REDACTED]" b'
    red = secret_scan.redact_secrets(docs, grammars)
    assert red.columns == docs.columns and red.count() == len(rows)
    empty = secret_scan.learn_grammars(frame(spark, []))
    assert secret_scan.scan_secrets(frame(spark, []), empty).count() == 0


def test_runs_beside_base_spans_and_without_digits_are_scored():
    rng = random.Random(41)
    draw = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n))
    words = secret_scan.transitions(" ".join(prose(rng, 5) + " plain words of a sentence" for _ in range(400)))
    g = secret_scan.Grammars({"assign": [letters(32) for _ in range(300)], "hex": [draw(32) for _ in range(300)]}, {k: int(v) for k, v in enumerate(words) if v})
    whole = letters(16) + draw(24) + letters(16)
    bare = letters(32)
    for run in (whole, bare):
        assert (5, 5 + len(run), "learned") in g.spans("see: " + run + " end")
    assert secret_scan.redact("see: " + whole + " end", g) == "see: [REDACTED] end"
    run = draw(32)
    assert g.spans(run) == [(0, 32, "hex")]


def test_languages_of_copies_and_of_long_texts_have_dictionaries(spark):
    copies = [("same text", "xx")] * 5000 + [(f"mot{chr(97 + i // 20)}{chr(97 + i % 20)}q", "xx") for i in range(40)]
    rows = copies + [("lang " * 4000 + str(i), "yy") for i in range(3)]
    found = language_id.learn_dictionaries(spark.createDataFrame(rows, "text string, lang string"))
    assert set(found) == {"xx", "yy"} and found["yy"].startswith(b"lang lang")
    assert all(t.encode() in found["xx"] for t, _ in copies[-40:])


def test_language_held_out_accuracy(spark):
    from tidemark.llm.queries import op2_language_id

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op2_language_id(spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    rows = frame(spark, [(1, None), (2, "12 !"), (3, "abc def"), (None, "abc")])
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify_languages(rows, {"xx": b"abc def"}).collect()}
    assert out[1] == ("und", 0.0) and out[2] == ("und", 0.0) and out[3][0] == "xx" and 0 <= out[3][1] <= 1
    assert language_id.learn_dictionaries(spark.createDataFrame([], "text string, lang string")) == {}
