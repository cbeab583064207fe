"""Whitening against fractions and a plain eigendecomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import embedding_whitening as ew

SCHEMA = "vec_id long, embedding array<double>, component int, n string"


def brute(rows):
    """n, deviations by id, covariance as fractions, centred rows."""
    x = {i: [math.floor(1024 * v) + 100_000 for v in e] for i, e in rows}
    n, d = len(x), len(next(iter(x.values())))
    s = [sum(v[j] for v in x.values()) for j in range(d)]
    y = {i: [n * v[j] - s[j] for j in range(d)] for i, v in x.items()}
    cov = [[Fraction(sum(v[a] * v[b] for v in y.values()), n**3) for b in range(d)] for a in range(d)]
    return n, {i: sum(a * a for a in v) for i, v in y.items()}, cov, {i: [float(Fraction(a, n)) for a in v] for i, v in y.items()}


def check(got, rows, components=8):
    n, deviation, cov, centred = brute(rows)
    d = len(cov)
    v = np.array([[float(c) for c in row] for row in cov])
    values, axes = np.linalg.eigh(v)
    found = {}
    for r in got:
        assert (r.vec_id, r.component) not in found
        found[r.vec_id, r.component] = r
    k = min(components, d)
    assert set(found) == {(i, c) for i, _ in rows for c in range(1, k + 1)}
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-6
    for c in range(1, k + 1):
        e, axis = values[-c], axes[:, -c]
        sign = 0
        for i, _ in rows:
            r = found[i, c]
            assert int(r.deviation_exact) == deviation[i] and r.deviation == (deviation[i] if deviation[i] < 1 << 63 else None)
            assert r.explained == pytest.approx(e / np.trace(v), rel=1e-9)
            want = float(np.dot(centred[i], axis)) / math.sqrt(e)
            if not sign:
                sign = 1 if want * r.whitened > 0 else -1
            assert sign * r.whitened == pytest.approx(want, abs=1e-7)


def test_whitening_equals_fractions(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 12)) * np.geomspace(1, 0.05, 12)
    rows = [(i, [float(np.float32(v)) for v in e]) for i, e in enumerate(base @ rng.normal(size=(12, 12)))]
    df = spark.createDataFrame([(i, e, 7, "x") for i, e in rows], SCHEMA).repartition(7)
    check(ew.whiten(df).collect(), rows)


def test_large_entries_need_several_slices(spark, monkeypatch):
    monkeypatch.setattr(ew, "ROWS", 16)
    monkeypatch.setattr(ew, "FAN_IN", 2)
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(rng.normal(size=(90, 3)) * [1e12, 1e9, 1e11])]
    check(ew.whiten(spark.createDataFrame([(i, e, 7, "x") for i, e in rows], SCHEMA).repartition(9)).collect(), rows)


def test_gram_is_exact_for_all_sizes():
    rng = np.random.default_rng(1)
    for bits in (3, 19, 20, 21, 40, 60):
        x = rng.integers(-(1 << bits), 1 << bits, (50, 4))
        x[0] = [-(1 << bits), (1 << bits) - 1, 0, 1 << (bits - 1)]
        want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j], strict=True)) for j in range(4)] for i in range(4)]
        assert ew.gram(x).tolist() == want


def test_unsound_rows_go_and_repeats_count(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(rng.normal(size=(30, 2)))]
    odd = [(90, None), (91, [1.0, None]), (92, [float("nan"), 1.0]), (93, [float("inf"), 1.0]), (94, []), (95, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, e, 7, "x") for i, e in rows + odd], SCHEMA)
    check(ew.whiten(df).collect(), rows)
    twice = df.unionByName(spark.createDataFrame([(None, rows[0][1], 1, "y"), (0, rows[0][1], 1, "y")], SCHEMA))
    got = ew.whiten(twice).collect()
    assert len(got) == 2 * 32 and {r.n for r in got} == {32} and sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 0 for r in got) == 4


def test_no_variance_single_rows_and_empty_tables(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25], 0, "x")], SCHEMA)
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in ew.whiten(one).collect()] == [(1, c, 1, 0, None, None, 0.0) for c in (1, 2)]
    flat = ew.whiten(spark.createDataFrame([(i, [float(i), 3.0], 0, "x") for i in range(5)], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and {r.explained for r in flat} == {1.0, 0.0} and flat[0].identity_error < 1e-9
    assert ew.whiten(one.where("false")).collect() == []
    huge = ew.whiten(spark.createDataFrame([(1, [1e308], 0, "x"), (2, [-1e308], 0, "x")], SCHEMA)).collect()
    assert [abs(r.whitened) for r in huge] == [1.0, 1.0] and {r.deviation for r in huge} == {None}
