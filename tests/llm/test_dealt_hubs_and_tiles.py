"""Hubs of any id, and tiles bounded by what their texts hold, give what the plain forms give."""

import random

import pytest

from tidemark.llm import components, minhash_dedup, skew
from tidemark.llm.components import connected_components
from tidemark.llm.workspace import Workspace


def roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent if find(x) != x}


def test_hubs_with_the_largest_or_the_smallest_id(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT", 8)
    rng = random.Random(1)
    edges = [(i, 10_000) for i in range(200)] + [(500, 500 + i) for i in range(1, 200)] + [(20_000 + i, 20_001 + i) for i in range(40)] + [(rng.randint(0, 199), rng.randint(500, 699)) for _ in range(2)]
    got = connected_components(Workspace(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == roots(edges) and len(got) == len(roots(edges))


@pytest.mark.parametrize("shingles", [60, 2_000_000])
def test_tiles_bounded_by_shingles_lose_no_link(spark, monkeypatch, shingles):
    monkeypatch.setattr(minhash_dedup, "TILE_SHINGLES", shingles)
    monkeypatch.setattr(minhash_dedup, "TILE", 4)
    rng = random.Random(2)
    rows = []
    for g in range(12):
        base = [f"w{g}x{i}" for i in range(60)]
        for _ in range(6):
            words = list(base)
            for at in rng.sample(range(60), rng.randint(0, 2)):
                words[at] = f"o{rng.randint(0, 9)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    sets = {i: set(minhash_dedup.shingle_set(t).tolist()) for i, t in rows}
    edges = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = {i: i for i in sets} | roots(edges)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_only_open_edges_and_unmoved_pointers_are_looked_up(spark, monkeypatch):
    """Of stars, whose every edge is a pointer's, no edge is joined again with the roots; a pointer that has met its root is not followed again."""
    monkeypatch.setattr(skew, "HOT", 8)
    joined = []
    plain = components.join_spread
    monkeypatch.setattr(components, "join_spread", lambda ws, many, one, on, by, how: joined.append((on, many.count())) or plain(ws, many, one, on, by, how))
    edges = [(100 * s, 100 * s + i) for s in range(5) for i in range(1, 60)] + [(1, 700), (700, 701)]
    got = connected_components(Workspace(spark, "test"), spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == roots(edges)
    assert [n for on, n in joined if on == "a"] == [0]
    followed = [n for on, n in joined if on == "p"]
    assert followed[0] == 297 and max(followed[1:]) <= 2


@pytest.mark.parametrize("how", ["inner", "left"])
def test_dealt_joins_look_up_rows_of_the_many_side_only(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "HOT", 4)
    ws = Workspace(spark, "test")
    many = ws.save(spark.createDataFrame([(k, i) for k in (1, 2, 3, None) for i in range(50 if k == 2 else 3)], "k long, i long"), "many")
    one = ws.save(spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (4, "d"), (None, "e")], "k long, v string"), "one")
    got = skew.join_spread(ws, many, one, "k", "i", how)
    assert sorted(map(str, got.collect())) == sorted(map(str, many.join(one, "k", how).collect()))
    looked_up = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert len(looked_up) == (2 if how == "left" else 1)
