"""Quality rules: surface counts and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into ``BUCKETS`` counters, once over all
documents (raw corpus) and once over trusted ones (target). A document's
score is the mean over its n-grams of log p_target - log p_raw; it passes if
the score reaches one threshold, set from labelled documents; trusted ones are
scored with their own counts taken out of the target, as any other text is.

The raw counters come from every document, target and threshold from every
labelled one: a task adds up its own counters and sends one row per counter it
touched; labelled scores are dealt by ranges, in which running sums give the
errors of every cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.skew import by_size
from tidemark.llm.textops import hash_words, map_rows, mix64, slices, struct, windows
from tidemark.llm.workspace import Workspace

#: Counters; a power of two.
BUCKETS = 1 << 18
#: Pseudo-count of every counter of the raw corpus.
SMOOTHING = 0.5
#: Weight, in n-grams, of the raw distribution within the target: what few trusted texts do not hold costs little, with many it counts in full.
PRIOR = 1000.0
#: Part of the trusted texts that the threshold must keep.
KEEP_TRUSTED = 0.999
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Columns of the verdict.
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
#: Fixed values of the base rules: symbol characters and white space.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"

_DOWN = np.uint64(64 - BUCKETS.bit_length() + 1)
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def hashes(text: str | None) -> np.ndarray:
    return hash_words(text, lower=False)


def grams(h: np.ndarray) -> np.ndarray:
    """Counter numbers of a text's words and word pairs."""
    if len(h) == 0:
        return np.empty(0, np.int64)
    return (np.concatenate([mix64(h), mix64(windows(h, 2) ^ _PAIR)]) >> _DOWN).astype(np.int64)


def duplicate_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[str] = set()
    dup = 0
    for line in lines:
        if line in seen:
            dup += 1
        elif line.strip(WHITE):
            seen.add(line)
    return dup


def repeated_words(h: np.ndarray) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    if len(h) < 4:
        return 0
    w = windows(h, 3)
    ordered = np.sort(w)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice) == 0:
        return 0
    hit = np.isin(w, twice)
    inside = np.zeros(len(h), bool)
    for j in range(3):
        inside[j : j + len(w)] |= hit
    return int(inside.sum())


def base_counts(text: str | None, h: np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text and its word hashes."""
    if not text:
        return 0, 0, 0, 0, 0
    chars = len(text) - sum(map(text.count, WHITE))
    return len(h), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeated_words(h)


def gram_counts(texts: DataFrame) -> np.ndarray:
    """Counters over (text, n): every text counts n times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [grams(hashes(t)) for t in part.column(0).to_pylist()]
                times = np.repeat(part.column(1).to_numpy(), [len(g) for g in found])
                counts += np.bincount(np.concatenate(found), weights=times, minlength=BUCKETS).astype(np.int64)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"b": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})

    sums = texts.select("text", F.col("n").cast("long").alias("n")).mapInArrow(run, struct("b int, n long")).groupBy("b").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS, np.int64)
    counts[table.column("b").to_numpy()] = table.column("n").to_numpy()
    return counts


def log_ratios(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """log p_good - log p_raw of every counter, smoothed; zero if nothing is trusted."""
    if good.sum() == 0:
        return np.zeros(len(raw))
    q = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * len(raw))
    p = (good + PRIOR * q) / (good.sum() + PRIOR)
    return np.log(p) - np.log(q)


def score(h: np.ndarray, ratios: np.ndarray) -> float:
    g = grams(h)
    return float(ratios[g].mean()) if len(g) else 0.0


def score_apart(h: np.ndarray, raw: np.ndarray, good: np.ndarray, copies: int) -> float:
    """The score of a trusted text as one that is not in the target: its own counts, and those of its copies there, are taken out."""
    at, n = np.unique(grams(h), return_counts=True)
    if len(at) == 0:
        return 0.0
    q = (raw[at] + SMOOTHING) / (raw.sum() + SMOOTHING * len(raw))
    p = (good[at] - copies * n + PRIOR * q) / (good.sum() - copies * n.sum() + PRIOR)
    return float((n * (np.log(p) - np.log(q))).sum() / n.sum())


def choose_threshold(ws: Workspace, scored: DataFrame) -> float:
    """The cut between labelled scores (q, s, n) with the fewest errors that keeps KEEP_TRUSTED of the good ones.

    Among equally good cuts the one amid the widest gap wins, then the lowest.
    Without good scores nothing is cut, without bad ones the bound on good ones alone counts.
    Scores are dealt by ranges; the driver gets three numbers of each range.
    """
    of = lambda q: F.sum(F.when(F.col("q") == q, F.col("n")).otherwise(0))
    values = scored.groupBy("s").agg(of(1).alias("good"), of(0).alias("bad")).repartitionByRange("s")
    values = ws.save(values.withColumn("part", F.spark_partition_id()), "values")
    ranges = values.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("s").alias("top")).orderBy("part").collect()
    goods, bads = (np.array([r[c] for r in ranges], np.int64) for c in ("good", "bad"))
    n_good, n_bad = int(goods.sum()), int(bads.sum())
    if n_good == 0:
        return -np.inf
    # What lies in the ranges before: scores, and the last of them.
    before = [(r.part, int(g), int(b), ranges[i - 1].top if i else None) for i, (r, g, b) in enumerate(zip(ranges, np.cumsum(goods) - goods, np.cumsum(bads) - bads, strict=True))]
    before = values.sparkSession.createDataFrame(before, "part int, good0 long, bad0 long, top0 double")
    w = W.partitionBy("part").orderBy("s")
    below = lambda c: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col(f"{c}0")
    cuts = values.join(F.broadcast(before), "part").select("s", "good", below("good").alias("good_below"), below("bad").alias("bad_below"), F.coalesce(F.lag("s").over(w), "top0", F.col("s") - 1.0).alias("low"))
    cuts = ws.save(cuts, "cuts")
    ceiling = cuts.where(F.col("good_below") + F.col("good") > int((1 - KEEP_TRUSTED) * n_good)).agg(F.min("s")).first()[0]
    if n_bad == 0:
        return float(ceiling) - 1e-9
    middle = (F.col("low") + F.col("s")) / 2
    cut = F.when(middle > F.col("low"), middle).otherwise(F.col("s"))
    errors = F.round(F.col("good_below") / n_good + (n_bad - F.col("bad_below")) / n_bad, 12)
    best = cuts.where(F.col("s") <= ceiling).agg(F.min(F.struct(errors.alias("errors"), (F.col("low") - F.col("s")).alias("gap"), cut.alias("cut"))).alias("best"))
    return float(best.first().best.cut)


class Model:
    """What every document is judged by: ratios of the counters and one threshold."""

    def __init__(self, ratios: np.ndarray, threshold: float):
        self.ratios, self.threshold = ratios.astype(np.float32), threshold


def fit(docs: DataFrame, labels: DataFrame | None) -> Model:
    """Counts over all of ``docs``; target and threshold from all labelled ids (doc_id, quality).

    Ids that carry both labels, null ids and null labels teach nothing. Without
    labels every score is 0 and passes, so the base rules decide alone.
    """
    docs = docs.select("doc_id", "text")
    if labels is None:
        return Model(np.zeros(BUCKETS), -np.inf)
    ws = Workspace(docs.sparkSession, "quality")
    pure = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2")).where("q = q2")
    known = ws.save(pure.select("doc_id", "q"), "known")
    # Every labelled text once, with its copies of one label.
    chosen = ws.save(docs.join(by_size(known), "doc_id").groupBy("q", "text").agg(F.count(F.lit(1)).alias("n")), "labelled")
    if chosen.isEmpty():
        ws.drop_all_but()
        return Model(np.zeros(BUCKETS), -np.inf)
    raw, good = gram_counts(docs.withColumn("n", F.lit(1))), gram_counts(chosen.where("q = 1"))
    ratios = log_ratios(raw, good)
    shared = docs.sparkSession.sparkContext.broadcast((ratios.astype(np.float32), raw, good))

    # A trusted text is scored as if it were not in the target, like those the labels leave out.
    def prepare():
        def one(t, q, n):
            h = hashes(t)
            if not base_passes(base_counts(t, h)):
                return None
            return score_apart(h, *shared.value[1:], n) if q == 1 else score(h, shared.value[0])

        return lambda marks, texts, copies: [marks, copies, [one(t, q, n) for t, q, n in zip(texts, marks, copies, strict=True)]]

    scored = map_rows(chosen, struct("q int, n long, s double"), prepare).where("s IS NOT NULL")
    threshold = choose_threshold(ws, scored)
    ws.drop_all_but()
    return Model(ratios, threshold)


def base_passes(counts: tuple[int, int, int, int, int]) -> bool:
    n, repeated = counts[0], counts[4]
    return not (n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n)


def judge(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept), one row per input row.

    A null or empty text has no words and fails. Null ids and repeated rows
    stay; an empty table gives an empty result. Columns of ``keep`` that have
    a result's name are left out for it. ``kept`` needs the base rules passed
    and a score that reaches the threshold.
    """
    rows = docs.select("doc_id", "text", *[c for c in keep if c not in ("doc_id", "text", *RESULTS)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        m = shared.value

        def work(ids, texts, *others):
            hashed = [hashes(t) for t in texts]
            base = [base_counts(t, h) for t, h in zip(texts, hashed, strict=True)]
            fails = [not base_passes(b) for b in base]
            scores = [score(h, m.ratios) for h in hashed]
            kept = [not f and s >= m.threshold for f, s in zip(fails, scores, strict=True)]
            texts_out = [texts] if "text" in keep else []
            return [ids, *texts_out, *others, *([b[k] for b in base] for k in range(5)), fails, scores, kept]

        return work

    fields = [f for f in rows.schema if f.name != "text" or "text" in keep]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return map_rows(rows, struct(f"{kinds}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"), prepare)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns, whatever their names.

    Null and empty texts go, as they have no words; null ids and repeated rows
    are judged like others. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value

        def good(t: str | None) -> bool:
            h = hashes(t)
            return base_passes(base_counts(t, h)) and score(h, m.ratios) >= m.threshold

        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array([good(t) for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
