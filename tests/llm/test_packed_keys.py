"""Rows with equal keys, found on packed records, against plain groups; what op1 shuffles."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import packed, skew, substring_dedup
from tidemark.llm.workspace import Workspace

BLOCK = packed.record("c", "start", "end", "again")


def packs(spark, rows, size):
    """The rows as packs of ``size`` records, as tasks write them."""
    out = []
    for at in range(0, len(rows), size):
        k, c, of, start, again = (np.array(x, t) for x, t in zip(zip(*rows[at : at + size], strict=True), (np.uint64, np.int64, np.int64, np.int64, bool), strict=True))
        part, values = packed.packs(packed.records(BLOCK, k=k, c=c, of=of, start=start, end=start + 1, again=again))
        out += zip(part.tolist(), map(bytearray, values.to_pylist()), strict=True)
    return spark.createDataFrame(out, "part int, rows binary")


@pytest.mark.parametrize("hot", [512, 3])
def test_packed_groups_equal_plain_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "HOT", hot)
    rng = random.Random(hot)
    keys = [rng.getrandbits(64) for _ in range(300)]
    rows = [(k, rng.randrange(2), rng.randrange(900), n, False) for n, k in enumerate(rng.choices(keys, k=400))]
    rows += [(keys[0], 0, rng.randrange(40, 900), 1000 + n, False) for n in range(200)]  # many of one key, in several packs
    rows += [(7, 1, 5, 2000 + n, n % 60 == 59) for n in range(100)]  # of one owner, some again
    rows += [(8, 1, 5, 3000 + n, False) for n in range(100)]  # of one owner, overlapping only
    rows += [(9, 1, 6, 4000 + n, True) for n in range(40)]
    ahead = rows[:]
    rng.shuffle(rows)
    plain = defaultdict(list)
    for r in rows:
        plain[r[:2]].append(r)
    want = set()
    for (k, c), v in plain.items():
        lo, hi = min(r[2] for r in v), max(r[2] for r in v)
        if lo != hi or any(r[4] for r in v):
            want |= {(k, c, of, start, again, lo) for _, _, of, start, again in v}
    for order, size in ((rows, 150), (ahead, 1000), (ahead, 90)):
        ws = Workspace(spark, "packed")
        got = packed.groups(ws, ws.save(packs(spark, order, size), "packs"), BLOCK).collect()
        assert len(got) == len(want)
        assert {(r.k % (1 << 64), r.c, r.of, r.start, r.again, r.lo) for r in got} == want


def test_a_range_gets_few_records_of_one_key():
    rows = packed.records(BLOCK, k=np.full(10_000, 3, np.uint64), c=np.zeros(10_000, np.int64), of=np.arange(10_000), start=np.zeros(10_000, np.int64), end=np.ones(10_000, np.int64), again=np.zeros(10_000, bool))
    part, values = packed.packs(rows)
    sizes = dict(zip(part.tolist(), (len(v) // BLOCK.itemsize for v in values.to_pylist()), strict=True))
    assert set(sizes) == {packed.ASIDE, 0} and sizes[0] <= 3 and sum(sizes.values()) == 10_000


def test_passages_shuffle_no_row_for_a_key_that_stands_alone(spark):
    """Before, every band of every paragraph and every block was a row of a shuffle."""
    rng = random.Random(5)
    rows = [(d, "\n".join(" ".join(f"x{rng.getrandbits(40)}" for _ in range(80)) for _ in range(10))) for d in range(100)]
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {(stages.apply(n).stageId(), stages.apply(n).attemptId()): stages.apply(n).shuffleWriteRecords() for n in range(stages.size())}

    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    before = written()
    assert substring_dedup.repeated_passages(docs).count() == 0
    assert sum(n for stage, n in written().items() if stage not in before) < 4 << packed.BITS  # a value for each range and kind; bands and blocks are 16,000 or so


def test_scan_of_joined_texts_keeps_each_apart(spark):
    """Texts are hashed joined: lines, places and blocks must not reach over their ends."""
    words = [f"v{n}" for n in range(60)]
    half, whole = " ".join(words[:30]), " ".join(words)
    rows = [(1, "\n \n" + whole + "\n"), (2, half), (3, " ".join(words[30:])), (4, ""), (5, "  é " + whole), (6, "\n\n")]
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert set(got) == {1, 5}
    assert [p.pos for p in got[1].paragraphs] == [2] and [p.pos for p in got[5].paragraphs] == [0]
    for d, text in rows:
        if d in got:
            raw = text.encode()
            assert {raw[s.start : s.end].split()[0] for s in got[d].spans} <= {w.encode() for w in words}
    assert [x.end - x.start for x in got[1].spans] == [x.end - x.start for x in got[5].spans]
