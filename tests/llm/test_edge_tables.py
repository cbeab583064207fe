"""Empty tables, repeated rows, null ids, very long texts and clashing names for the operators that judge single texts."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import bpe_codec, language_id, pretokens, quality_rules, secret_scan

SCHEMA = "doc_id long, text string, n_tokens string, lang_pred string, spans int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "own", "own", 5) for i, t in rows], SCHEMA)


def long_text(words, n, seed=1):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    words = "the of and Water houses, where lines ñandú été 123 don't".split()
    return [(1, long_text(words, 200_000)), (2, None), (3, ""), (None, "one two"), (4, "same text"), (4, "same text"), (None, None)]


def test_bpe_digests(spark, rows):
    got = bpe_codec.bpe_digests(table(spark, rows)).collect()
    library = pretokens.load("word_bpe_49k.json")
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe_codec.bpe_digests(table(spark, [])).collect() == []


def test_languages(spark, rows):
    known = {"en": language_id.letters(long_text("the of and water houses where lines".split(), 3000)), "xx": language_id.letters(long_text("zu bo ke la mi".split(), 3000))}
    got = language_id.identify_languages(table(spark, rows), known).collect()
    assert len(got) == len(rows)
    by_text = {(r.doc_id, r.lang_pred, r.rejected) for r in got}
    assert (1, "en", False) in by_text and {(2, "und", True), (3, "und", True), (None, "und", True)} <= by_text
    assert len({tuple(r) for r in got if r.doc_id == 4}) == 1
    assert language_id.identify_languages(table(spark, []), known).collect() == [] and language_id.learn_dictionaries(table(spark, []).withColumnRenamed("lang_pred", "lang")) == {}
    none = language_id.identify_languages(table(spark, rows), {}).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_quality_and_secrets_on_a_very_long_text(spark, rows):
    docs = table(spark, [*rows, (9, rows[0][1] + ' password = "abcdef0123456789" ' + "x" * 1_000_000)])
    judged = {r.doc_id: r for r in quality_rules.judge(docs, quality_rules.fit(docs, None)).collect()}
    assert judged[1].n_words == 200_000 and judged[9].n_words == 200_004 and judged[2].base_failed
    found = {r.doc_id: r for r in secret_scan.scan_secrets(docs, secret_scan.learn_grammars(docs)).collect()}
    assert (found[9].n_assign, found[1].n_assign) == (1, 0) and found[9].spans.startswith(f"assign:{len(rows[0][1]) + 1}:")
    assert secret_scan.scan_secrets(table(spark, []), secret_scan.learn_grammars(table(spark, []))).collect() == []
