"""Embedding near-duplicates against brute force; the pipeline's stages on a small table."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import embedding_dedup, minhash_dedup, skew


def brute(rows, threshold=0.98):
    sound = [(i, np.array(e, float), k) for i, e, k in rows if i is not None and k is not None and e and None not in e and np.isfinite(e).all() and np.any(e)]
    links, parent = {}, {i: i for i, *_ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x, k) in enumerate(sound):
        for j, y, m in sound[a + 1 :]:
            if k == m and i != j and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links.setdefault(i, set()).add(j)
                links.setdefault(j, set()).add(i)
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: (len(links.get(i, ())), find(i)) for i in parent}


def test_huge_and_tiny_components_do_not_overflow(spark):
    rows = [(1, [1e200, 0.0], 0), (2, [1e200, 1e190], 0), (3, [1e-200, 0.0], 0), (4, [1e-310, 0.0], 0), (5, [0.0, 1e300], 0), (6, [1e300, 1e300], 0)]
    got = embedding_dedup.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6)}


@pytest.mark.parametrize("most", [8, 512])
def test_embedding_duplicates_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(skew, "HOT", most)
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.normal(size=12)
            for _ in range(random.Random(n).randint(1, 14)):
                rows.append((n, [float(np.float32(v)) for v in base + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.2])], label))
                n += 1
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 12, 0), (n + 3, [float("nan")] * 12, 0), (n + 4, [1.0, None], 0), (n + 5, [1.0, 0.0], 0), (n + 6, [2.0, 0.0], 0), (n + 7, [float("inf"), 1.0], 0), (n + 8, [5.0], 1)]
    rows += [(n + 9 + i, rows[3][1], 0) for i in range(40)] + [rows[0], (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, kept string")
    got = embedding_dedup.embedding_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == brute(rows)
    assert embedding_dedup.embedding_duplicates(df.limit(0)).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
        if name == "quality_rules":
            assert not any(labels.get(i) == 0 for i in after)
            assert all(i in after for i, q in labels.items() if q == 1 and len(before[i].split()) >= 50)
        if name == "near_dedup":
            kept = {r.doc_id for r in minhash_dedup.near_duplicates(docs).collect() if r.kept}
            assert set(after) == kept
        if name in ("line_dedup", "secret_scan"):
            assert set(after) == set(before)
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == set(after)
    assert corpus_pipeline.run(spark, sf).count() == len(packed)


def test_pipeline_handles_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0


def test_pipeline_stages_take_nulls_repeats_and_clashing_columns(spark, tmp_path):
    rng = random.Random(7)
    say = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    rows = [(i, say(80), "en", "s", 1, 5, False, "k", i) for i in range(30)]
    rows += [rows[0], rows[0], (100, rows[1][1] + " tail", "en", "s", 1, 5, True, "k", 0), (None, rows[2][1], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [(101, None, "en", "s", 0, 1, True, "k", 1), (102, "", "en", "s", 0, 1, True, "k", 1), (103, say(60) + " password=abcdef0123456789", "en", "s", 1, 7, True, "k", 1), (104, say(30_000), "en", "s", 1, 1, True, "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines long, kept boolean, fp string, id long")
    spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda df: sorted(map(str, df.collect()))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        if name == "line_dedup":
            whole = out.where("doc_id = 103").first()
            assert (whole.n_lines, whole.kept, whole.fp) == (7, True, "k") and out.count() == len(rows)
        if name == "near_dedup":
            assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([0, 0, 0, *range(1, 30), None, None, 101, 102, 103, 104], key=str)
        if name == "secret_scan":
            changed = {r.doc_id for r in out.collect()} and {r.doc_id for r in out.where("text LIKE '%REDACTED%'").collect()}
            assert changed == {103} and out.count() == len(rows)
    kept = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.where("text IS NULL OR text = ''").isEmpty() and kept.where("doc_id = 0").count() == 3
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() >= 30
    assert len(key(corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).where("doc_id = 102"))) == 1
