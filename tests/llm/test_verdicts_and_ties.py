"""The quality verdict against a plain ratio and threshold, with few labels too; packing that no row order changes."""

import math
import random
from collections import Counter

import numpy as np

from tidemark.llm import packing, quality_rules
from tidemark.llm.workspace import Workspace

DOCS = "doc_id long, text string"


def texts(rng, n, topics, words=70):
    """Texts of a few topics each; every topic has words of its own beside common ones."""
    common = [f"c{i}" for i in range(60)]
    out = []
    for _ in range(n):
        own = [f"{topics}{t}w{i}" for t in rng.sample(range(40), 3) for i in range(12)]
        out.append(" ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(own) for _ in range(words)))
    return out


def grams(text):
    return quality_rules.grams(quality_rules.hashes(text)).tolist()


def plain_model(rows, labels):
    """Ratios as a function and the threshold, from the definition."""
    buckets, smooth, prior = quality_rules.BUCKETS, quality_rules.SMOOTHING, quality_rules.PRIOR
    raw, good = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if labels.get(i) == 1:
            good.update(grams(t))

    def score(text, without=None):
        own = Counter(without or [])
        g = grams(text)
        of_raw = {k: (raw[k] + smooth) / (raw.total() + smooth * buckets) for k in g}
        return sum(math.log((good[k] - own[k] + prior * of_raw[k]) / (good.total() - own.total() + prior)) - math.log(of_raw[k]) for k in g) / len(g)

    copies = Counter(t for i, t in rows if labels.get(i) == 1)
    trusted = [score(t, grams(t) * copies[t]) for i, t in rows if labels.get(i) == 1]
    bad = [score(t) for i, t in rows if labels.get(i) == 0]
    least = sorted(trusted)[int((1 - quality_rules.KEEP_TRUSTED) * len(trusted))]
    values = sorted({v for v in [*trusted, *bad] if v <= least})
    best = None
    for low, value in zip([values[0] - 1.0, *values[:-1]], values, strict=True):
        cut = (low + value) / 2
        errors = round(sum(v < cut for v in trusted) / len(trusted) + sum(v >= cut for v in bad) / len(bad), 12)
        if best is None or (errors, low - value, cut) < best[:3]:
            best = (errors, low - value, cut)
    return score, best[2]


def test_verdict_equals_a_plain_ratio_and_threshold(spark):
    rng = random.Random(1)
    rows = list(enumerate(texts(rng, 120, "a") + texts(rng, 60, "b")))
    rows += [(500 + i, rows[i][1]) for i in range(5)]  # copies, trusted too
    labels = {**{i: 1 for i in range(40)}, **{500 + i: 1 for i in range(5)}, **{120 + i: 0 for i in range(20)}}
    docs = spark.createDataFrame(rows, DOCS)
    model = quality_rules.fit(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"))
    score, threshold = plain_model(rows, labels)
    assert abs(model.threshold - threshold) < 1e-5
    for r in quality_rules.judge(docs, model).collect():
        s = score(dict(rows)[r.doc_id])
        assert abs(r.score - s) < 1e-4 and (abs(s - threshold) < 1e-4 or r.kept == (s >= threshold))


def test_few_labels_keep_unseen_trusted_texts(spark):
    rng = random.Random(2)
    trusted, noise = texts(rng, 1200, "a"), [" ".join(f"z{rng.randint(0, 999)}" for _ in range(70)) for _ in range(400)]
    rows = list(enumerate(trusted + noise))
    labels = [(i, 1) for i in range(80)] + [(1200 + i, 0) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = {r.doc_id for r in quality_rules.judge(docs, quality_rules.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))).collect() if r.kept}
    assert sum(i in kept for i in range(80, 1200)) >= 0.99 * 1120
    assert sum(i in kept for i in range(1200, 1600)) <= 8


def test_packing_does_not_depend_on_row_order(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "of"]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(None, "x"), (None, "x"), (7, rows[7][1])]

    def placed(order):
        got = packing.best_fit_pack(spark.createDataFrame(order, DOCS).coalesce(1), max_tokens=64, group_size=10**6).collect()
        return Counter(tuple(r) for r in got)

    assert placed(rows) == placed(rng.sample(rows, len(rows)))


def test_packing_takes_no_more_sequences_than_tokens_alone():
    rng = random.Random(4)
    for n in (5, 60, 700, 3000):
        lengths = [min(512, int(rng.lognormvariate(4, 1.3)) + 1) for _ in range(n)]
        loose, _ = packing.pack(lengths, 512, 512, 512.0**2)
        tight, _ = packing.pack_balanced(lengths, 512, None, None)
        assert len(set(tight.tolist())) <= len(set(loose.tolist()))
        assert np.bincount(tight).max() <= np.bincount(loose).max()


def test_target_counts_every_trusted_text(spark):
    """More labels than one sample of 20,000 ids held: each adds its counts to the target, however rare its words."""
    n = 21_000
    rows = [(i, f"word{i} " + "common " * 3) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(1 AS INT) AS quality")
    seen = []
    ratios = quality_rules.log_ratios

    def watched(raw, good):
        seen.append((raw, good))
        return ratios(raw, good)

    quality_rules.log_ratios = watched
    try:
        quality_rules.fit(docs, labels)
    finally:
        quality_rules.log_ratios = ratios
    (raw, good), = seen
    assert raw.sum() == good.sum() == n * 7 and (raw == good).all()


def test_threshold_over_ranges_equals_the_plain_search(spark):
    """Errors, gaps and ties of all cuts, whatever the ranges that the scores are dealt to."""
    rng = random.Random(5)
    for n_good, n_bad, digits in ((3000, 400, 6), (1500, 300, 2), (40, 0, 3), (0, 10, 3), (5, 3, 1)):
        good = [round(rng.gauss(0.5, 0.3), digits) for _ in range(n_good)]
        bad = [round(rng.gauss(-0.3, 0.4), digits) for _ in range(n_bad)]
        rows = [(1, s, 1) for s in good] + [(0, s, 1) for s in bad]
        scored = spark.createDataFrame([(q, s, 2 * n) for q, s, n in rows], "q int, s double, n long").repartition(3)
        got = quality_rules.choose_threshold(Workspace(spark, "test"), scored)
        if not good:
            assert got == -math.inf
            continue
        good, bad = np.sort(np.repeat(good, 2)), np.sort(np.repeat(bad, 2))
        least = good[int((1 - quality_rules.KEEP_TRUSTED) * len(good))]
        if not len(bad):
            assert got == least - 1e-9
            continue
        values = np.unique(np.concatenate([good, bad]))
        values = values[values <= least]
        lows = np.concatenate([[values[0] - 1.0], values[:-1]])
        cuts = (lows + values) / 2
        errors = np.searchsorted(good, cuts) / len(good) + (len(bad) - np.searchsorted(bad, cuts)) / len(bad)
        assert got == cuts[np.lexsort((cuts, -(values - lows), np.round(errors, 12)))[0]]
