"""Repeated passages: paragraph MinHash banding, and verbatim blocks for what hides inside paragraphs.

Paragraphs (lines of at least ``MIN_WORDS`` words) are sketched; bands are
tuned for high recall, colliding paragraphs are verified by exact Jaccard
similarity of their shingles and grouped by components, all as for whole
documents. A passage set into the middle of other text makes no similar
paragraph; for it, windows of ``BLOCK_WORDS`` words that start at
content-chosen words are one long band each: any run of at least
``BLOCK_WORDS + WINNOW - 1`` words shared by two texts holds a common one. The
spans are cores: up to ``WINNOW - 1`` words a side of such a run lie outside.

Of each group the first occurrence in the document with the smallest id stays;
the others, those in the same document included, are removals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm import packed
from tidemark.llm.minhash_dedup import MinHash, band_key_matrix, hash_functions, linked_members, tune_bands
from tidemark.llm.skew import by_size, few, hot_keys, join_dealt
from tidemark.llm.textops import hash_spans, mix64, slices, struct, windows, word_spans
from tidemark.llm.workspace import Workspace

#: Words of the shortest paragraph that counts as a passage.
MIN_WORDS = 20
#: Words of a verbatim block, and starts among which one is chosen.
BLOCK_WORDS = 32
WINNOW = 20
#: Recall of the bands at the threshold, and hash functions to reach it with.
RECALL = 0.999
HASHES = 48

_BANDS, _ROWS = tune_bands(75, RECALL, HASHES)
#: Bits of a winnowing key that hold the place.
_PLACE = np.uint64(28)
PARAGRAPH = MinHash(bands=_BANDS, rows=_ROWS, batch=_BANDS * _ROWS // 3, miss=1e-4)

#: Records of which rows with equal keys are sought: paragraphs by set and by band, verbatim blocks.
RECORDS = {"copy": packed.record("c"), "band": packed.record(), "block": packed.record("c", "start", "end", "again")}


def block_starts(h: np.ndarray) -> np.ndarray:
    """Content-chosen words at which the verbatim blocks of a text with these word hashes start."""
    if len(h) < BLOCK_WORDS:
        return np.empty(0, np.int64)
    return _chosen(windows(h, 5)[: len(h) - BLOCK_WORDS + 1])


def _chosen(first: np.ndarray) -> np.ndarray:
    """The places of the minima of all runs of ``WINNOW`` hashes."""
    if len(first) <= WINNOW:
        return np.array([int(first.argmin())])
    # The hash's leading bits, then the place: minima are unique, the leftmost wins.
    low = ((first >> _PLACE) << _PLACE) | np.arange(len(first), dtype=np.uint64)
    width = 1
    while 2 * width <= WINNOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < WINNOW:
        low = np.minimum(low[: len(low) - (WINNOW - width)], low[WINNOW - width :])
    return (low[np.append(True, low[1:] != low[:-1])] & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)


def sketch_lines(parts: list[tuple[int, int, np.ndarray]], p: MinHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n, fp, keys, sig) of paragraphs given as (., ., word hashes), all at once.

    The fingerprint is two wrapping sums over the distinct shingles, a set's in any order.
    """
    lengths = np.array([len(h) for *_, h in parts])
    joined = np.concatenate([h for *_, h in parts])
    owner = np.repeat(np.arange(len(parts)), lengths)
    ends = np.cumsum(lengths)
    every = windows(joined, p.ngram)
    inside = np.arange(len(every)) + p.ngram <= ends[owner[: len(every)]]
    sh, own = every[inside], owner[: len(every)][inside]
    # Owner and 48 hash bits in one number: within a paragraph that tells shingles apart.
    coded = np.sort((own.astype(np.uint64) << np.uint64(48)) | (sh >> np.uint64(16)))
    coded = coded[np.append(True, coded[1:] != coded[:-1])]
    own, sh = (coded >> np.uint64(48)).astype(np.int64), coded << np.uint64(16)
    n = np.bincount(own, minlength=len(parts))
    starts = np.cumsum(n) - n
    fp = np.stack([np.add.reduceat(mix64(sh ^ np.uint64(salt)), starts) for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)], axis=1)
    a, b = hash_functions(p.size, p.seed)
    low = (sh >> np.uint64(32)).astype(np.uint32)
    sig = np.empty((len(parts), p.size), np.uint32)
    for k in range(p.size):
        v = low * a[k]
        v += b[k]
        sig[:, k] = np.minimum.reduceat(v, starts)
    return n, fp, band_key_matrix(sig, p), (sig & np.uint32(0xFF)).astype(np.uint8)


def _binary(rows: np.ndarray) -> pa.Array:
    """A byte matrix as one binary value per row."""
    size = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * size), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


_SCAN = "id long, doc long, pos int, n int, keys array<long>, sig binary, kind string, part int, rows binary"


def _blocks(docs: list[int], at: np.ndarray, h: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[np.ndarray]:
    """Records of the verbatim blocks of joined texts, which begin at the bytes ``at``."""
    bounds = np.searchsorted(first, at).tolist()
    begin, key = windows(h, 5), windows(h, BLOCK_WORDS)
    check = windows(h ^ np.uint64(0x5851F42D4C957F2D), BLOCK_WORDS)
    for d, byte, x, y in zip(docs, at[:-1].tolist(), bounds[:-1], bounds[1:], strict=True):
        if y - x < BLOCK_WORDS:
            continue
        b = x + _chosen(begin[x : y - BLOCK_WORDS + 1])
        k, start, end = key[b], first[b], last[b + BLOCK_WORDS - 1]
        out = np.zeros(len(b), RECORDS["block"])
        out["k"], out["c"], out["of"] = k, check[b] >> np.uint64(33), d
        out["start"], out["end"] = start - byte, end - byte
        ordered = np.sort(k)
        if (ordered[1:] == ordered[:-1]).any():
            _, where, which = np.unique(k, return_index=True, return_inverse=True)
            out["again"] = start >= end[where[which]]  # clear of the block's first place in this text
        yield out


def scan(docs: DataFrame, p: MinHash) -> DataFrame:
    """One pass over the texts: a row with ``id`` per paragraph (its sketch), and packed records of a ``kind``.

    A paragraph's number is made of the task's and a count, so two never share one.
    """
    schema = to_arrow_schema(struct(_SCAN))

    def batch(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[str, list[np.ndarray]] = {kind: [] for kind in RECORDS}

        def put(kind: str, *rows: np.ndarray, least: int = packed.PACK) -> Iterator[pa.RecordBatch]:
            held[kind] += rows
            n = sum(map(len, held[kind]))
            if n and n >= least:
                part, values = packed.packs(np.concatenate(held[kind]))
                held[kind] = []
                yield batch({"kind": pa.array([kind] * len(part)), "part": pa.array(part), "rows": values}, len(part))

        for whole in batches:
            for part in slices(whole, "text"):
                ids, texts = (c.to_pylist() for c in part.columns)
                texts = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
                at = np.cumsum([0, *(len(t) + 1 for t in texts)])
                raw = np.frombuffer(b"\n".join(texts), np.uint8)
                first, last = word_spans(raw)
                h = hash_spans(raw, first, last)
                ends = np.flatnonzero(raw == 10)
                line = np.searchsorted(ends, first)
                counts = np.bincount(line) if len(line) else np.empty(0, np.int64)
                wide = np.flatnonzero(counts >= MIN_WORDS)
                starts = (np.cumsum(counts) - counts)[wide]
                owner = np.searchsorted(at, first[starts], side="right") - 1
                doc, pos = np.array(ids, np.int64)[owner], wide - np.searchsorted(ends, at[:-1])[owner]
                lines = [(0, 0, h[x:y]) for x, y in zip(starts.tolist(), (starts + counts[wide]).tolist(), strict=True)]
                for x in range(0, len(lines), 1 << 16):
                    now = slice(x, x + (1 << 16))
                    n, fp, keys, sig = sketch_lines(lines[now], p)
                    own = np.arange(number, number + len(n))
                    number += len(n)
                    listed = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * p.bands), pa.array(keys.ravel()))
                    yield batch({"id": pa.array(own), "doc": pa.array(doc[now]), "pos": pa.array(pos[now]), "n": pa.array(n), "keys": listed, "sig": _binary(sig)}, len(n))
                    yield from put("copy", packed.records(RECORDS["copy"], k=fp[:, 0], c=fp[:, 1], of=own))
                    # A copy of an earlier paragraph leaves the banding, so it need not enter it.
                    fresh = np.sort(np.unique(np.ascontiguousarray(fp).view("V16").ravel(), return_index=True)[1])
                    yield from put("band", packed.records(RECORDS["band"], k=keys[fresh].ravel(), of=np.repeat(own[fresh], p.bands)))
                yield from put("block", *_blocks(ids, at, h, first, last))
        for kind in RECORDS:
            yield from put(kind, least=0)

    return docs.select("doc", "text").mapInArrow(run, struct(_SCAN))


def _paragraph_texts(ws: Workspace, docs: DataFrame, places: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the paragraphs in the written table ``ids``, whose places are (id, doc, pos).

    The places come to the documents, one list a document, and only the lines
    they name are taken out.
    """
    wanted = ws.save(places.join(by_size(ids), "id", "left_semi"), "wanted")
    listed = ws.save(wanted.groupBy("doc").agg(F.collect_list(F.struct("pos", "id")).alias("places")), "places")
    found = docs.join(F.broadcast(listed) if few(wanted) else listed, "doc").select(F.split("text", "\n", -1).alias("lines"), F.explode("places").alias("place"))
    return found.select(F.col("place.id").alias("id"), F.try_element_at("lines", F.col("place.pos") + 1).alias("text")).where("text IS NOT NULL")


def _packed(scanned: DataFrame, kind: str) -> DataFrame:
    return scanned.where(F.col("kind") == kind).select("part", "rows")


def repeated_paragraphs(ws: Workspace, docs: DataFrame, scanned: DataFrame, params: MinHash = PARAGRAPH) -> DataFrame:
    """(doc, pos, cluster, removed) of the paragraphs that have a near-duplicate, in another document or their own."""
    own = Workspace(ws.spark, "paragraphs")
    same = packed.groups(own, _packed(scanned, "copy"), RECORDS["copy"]).where("of != lo")
    copies = own.save(same.select(F.col("of").alias("id"), F.col("lo").alias("first")), "copies")
    banded = packed.groups(own, _packed(scanned, "band"), RECORDS["band"]).select("k", F.col("of").alias("id"), F.col("lo").alias("lead"))
    # The smallest of a bucket is no copy: the first of its set has the same bands.
    members = own.save(banded.join(by_size(copies.select("id")), "id", "left_anti"), "members")
    named = members.select("id").unionByName(copies.select("id")).unionByName(copies.select(F.col("first").alias("id")))
    named = own.save(named.distinct(), "named")
    # Only paragraphs that share a band or a set are looked at again.
    sketches = own.save(scanned.where("id IS NOT NULL").select("id", "doc", "pos", "n", "keys", "sig").join(by_size(named), "id", "left_semi"), "sketches")
    places = sketches.select("id", "doc", "pos")
    labels = linked_members(own, lambda ids: _paragraph_texts(own, docs, places, ids), sketches, members, copies, params)
    leads = labels.select(F.col("component").alias("id"), "component").distinct()
    found = ws.save(places.join(labels.unionByName(leads), "id").select("doc", "pos", F.col("component").alias("cluster")), "paragraphs")
    own.drop_all_but()
    place = F.struct("doc", "pos")
    spread = found.groupBy("cluster").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count(F.lit(1)).alias("n")).where("lo != hi")
    spread = ws.save(spread.select("cluster", "lo", "n"), "clusters")
    joined = join_dealt(found, spread.select("cluster", "lo"), ["cluster"], "pos", hot_keys(ws, spread, ["cluster"]))
    return joined.select("doc", "pos", "cluster", (place != F.col("lo")).alias("removed"))


def repeated_blocks(ws: Workspace, scanned: DataFrame) -> DataFrame:
    """(doc, start, end, removed) of the verbatim blocks that stand elsewhere too, in another document or their own."""
    found = packed.groups(ws, _packed(scanned, "block"), RECORDS["block"])
    return found.select(F.col("of").alias("doc"), "start", "end", ((F.col("of") != F.col("lo")) | F.col("again")).alias("removed"))


def merged_spans(blocks: DataFrame) -> DataFrame:
    """(doc, spans, removed_spans): the blocks of every document, and those removed, as ranges joined where they overlap.

    Runs in order of start with a running end: linear in the blocks, in one exchange by document.
    """
    kinds = F.explode(F.when(F.col("removed"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = blocks.repartition("doc").select("doc", kinds.alias("kind"), "start", "end")
    w = W.partitionBy("doc", "kind").orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    fresh = rows.withColumn("fresh", F.coalesce((F.col("start") > before).cast("int"), F.lit(1)))
    runs = fresh.withColumn("run", F.sum("fresh").over(w.rowsBetween(W.unboundedPreceding, 0)))
    spans = runs.groupBy("doc", "kind", "run").agg(F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("span"))
    listed = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("span"))))
    return spans.groupBy("doc").agg(listed(0).alias("spans"), listed(1).alias("removed_spans"))


def repeated_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", params: MinHash = PARAGRAPH) -> DataFrame:
    """(doc_id, n_paragraphs, n_removed_paragraphs, paragraphs, n_spans, span_bytes, spans, removed_spans), one row per document with a repeated passage.

    ``paragraphs`` lists (pos, cluster, removed); ``spans`` and
    ``removed_spans`` are byte ranges, joined where they overlap, of verbatim
    repeats and of those whose first place is elsewhere. Documents
    without a repeated passage have no row. Rows without an id or a text are
    passed over; rows with one id are one document. ``doc_id`` is an integer
    column; other columns are not read.
    """
    ws = Workspace(docs.sparkSession, "passages")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    scanned = ws.save(scan(rows, params), "scan")
    paragraphs = repeated_paragraphs(ws, rows, scanned, params).groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("pos", "cluster", "removed"))).alias("paragraphs"))
    both = paragraphs.join(merged_spans(repeated_blocks(ws, scanned)), "doc", "full_outer")
    none = F.array().cast("array<struct<start:int,end:int>>")
    both = both.withColumn("paragraphs", F.coalesce("paragraphs", F.array().cast("array<struct<pos:int,cluster:bigint,removed:boolean>>")))
    both = both.withColumn("spans", F.coalesce("spans", none)).withColumn("removed_spans", F.coalesce("removed_spans", none))
    return both.select(
        F.col("doc").cast(docs.schema[doc_id].dataType).alias("doc_id"),
        F.size("paragraphs").cast("long").alias("n_paragraphs"),
        F.size(F.filter("paragraphs", lambda s: s["removed"])).cast("long").alias("n_removed_paragraphs"),
        "paragraphs",
        F.size("spans").cast("long").alias("n_spans"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("span_bytes"),
        "spans",
        "removed_spans",
    )
