"""Near-duplicate groups: MinHash bands, sequential Bayesian pruning, exact verification.

1. Every text is sketched: hashed distinct word shingles give a fingerprint
   of the whole set, band keys, and one byte per MinHash value.
2. Texts with equal fingerprints are copies: each is linked with the smallest
   id of its fingerprint, which alone goes on. Groups of copies cost one row a
   copy from here, however large they are.
3. Texts that share a band key form a bucket. Each is paired with its bucket's
   smallest id only: as many pairs as rows, however large the bucket is.
4. Pairs are compared signature batch by signature batch. After each, those
   whose posterior probability of reaching the threshold has fallen below the
   miss probability are dropped.
5. Survivors are verified on the full shingle sets, one pair per text and
   round at first; verified links give components.
6. Links that the smallest id of a bucket did not show are sought between the
   bucket's other members, but only across components: buckets are dealt out
   in tiles of bounded size, members of a bucket's largest component against
   the others only. What the signatures leave open is verified within the
   tile. After that no pair is left that could join two components.

A leader, bucket or fingerprint with very many rows is dealt to several tasks
(:mod:`tidemark.llm.skew`), whatever the session's own skew handling does.
"""

from __future__ import annotations

import functools
import math
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.skew import by_size, hot_keys, join_dealt, join_spread
from tidemark.llm.textops import jaccard_at_least, map_rows, runs, shingle_set, slices, struct
from tidemark.llm.workspace import Workspace

#: Members of one side of a tile.
TILE = 256
#: Shingles that the members of a block have, about.
TILE_SHINGLES = 2_000_000


#: (id, text) of a written table of ids.
Selection = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class MinHash:
    """Sketch and test parameters."""

    bands: int = 40
    rows: int = 5
    ngram: int = 5
    percent: int = 75
    #: Probability of losing a true link in the Bayesian test, per batch.
    miss: float = 1e-5
    #: Signature bytes compared at a time.
    batch: int = 25
    seed: int = 20_240_229

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def recall(self, similarity: float) -> float:
        """Probability that a pair of this similarity shares a band."""
        return 1 - (1 - similarity**self.rows) ** self.bands


def tune_bands(percent: int, recall: float, most: int) -> tuple[int, int]:
    """(bands, rows): the longest bands that reach ``recall`` at the threshold with ``most`` hashes."""
    for rows in range(8, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("too few hashes for this recall")


@functools.lru_cache(maxsize=8)
def hash_functions(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, size, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None], rng.integers(0, 1 << 32, size, dtype=np.uint64).astype(np.uint32)[:, None]


@functools.lru_cache(maxsize=8)
def _band_mix(bands: int, rows: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed + 1).integers(0, 1 << 63, (bands, rows), dtype=np.uint64) | np.uint64(1)


def minhash(shingles: np.ndarray, size: int, seed: int) -> np.ndarray:
    """``size`` minima of hash functions over the shingles."""
    a, b = hash_functions(size, seed)
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    step = max(1, 200_000 // max(1, size))
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), step):
        values = h[i : i + step][None, :] * a
        values += b
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_key_matrix(signatures: np.ndarray, p: MinHash) -> np.ndarray:
    """One 64-bit key per signature and band; keys of different bands never meet but by chance."""
    mixed = (signatures.reshape(-1, p.bands, p.rows).astype(np.uint64) + np.uint64(1)) * _band_mix(p.bands, p.rows, p.seed)
    keys = mixed.sum(axis=2, dtype=np.uint64)
    keys ^= keys >> np.uint64(29)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def band_keys(signature: np.ndarray, p: MinHash) -> np.ndarray:
    return band_key_matrix(signature[None, :], p)[0]


@functools.lru_cache(maxsize=8)
def needed_matches(p: MinHash) -> tuple[int, ...]:
    """Least number of equal bytes after each batch that keeps a pair.

    With a uniform prior on the match rate, m matches of n leave a posterior
    Beta(m+1, n-m+1); a pair stays while the probability that its rate is at
    least the threshold's is not below ``miss``. Bytes of different values
    match by chance once in 256.
    """
    s = p.percent / 100
    t = s + (1 - s) / 256
    out = []
    for n in range(p.batch, p.size + 1, p.batch):
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= p.miss:
                out.append(m)
                break
    return tuple(out)


def bayes_filter(x: np.ndarray, y: np.ndarray, p: MinHash) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the pairs that stay, their match rates) for two aligned byte matrices."""
    alive = np.arange(len(x))
    matches = np.zeros(len(x), np.int64)
    for k, least in enumerate(needed_matches(p)):
        part = slice(k * p.batch, (k + 1) * p.batch)
        matches[alive] += (x[alive, part] == y[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive, matches[alive] / p.size


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, size)


def sketch(texts: DataFrame, p: MinHash) -> DataFrame:
    """(id, n, fp, keys, sig) of every (id, text); a text without words has n 0 and nulls."""

    def prepare():
        def work(ids, values):
            out: list[list] = [ids, [], [], [], []]
            for t in values:
                s = shingle_set(t, p.ngram)
                out[1].append(len(s))
                if len(s) == 0:
                    for c in out[2:]:
                        c.append(None)
                    continue
                m = minhash(s, p.size, p.seed)
                out[2].append(xxhash.xxh3_128_digest(s.tobytes()))
                out[3].append(band_keys(m, p))
                out[4].append((m & np.uint32(0xFF)).astype(np.uint8).tobytes())
            return out

        return work

    kind = texts.schema["id"].dataType.simpleString()
    return map_rows(texts.select("id", "text"), struct(f"id {kind}, n int, fp binary, keys array<long>, sig binary"), prepare)


def select_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts with these ids (a written table): by broadcast if the ids are small, else by a shuffle."""
    return texts.join(by_size(ids), "id", "left_semi")


def _verify(ws: Workspace, pairs: DataFrame, texts: DataFrame, p: MinHash) -> DataFrame:
    """(a, b, ok) of written pairs, on their full shingle sets."""
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    hot = hot_keys(ws, pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), ["a"])
    both = join_dealt(with_b, texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), ["a"], "b", hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[tuple, np.ndarray] = OrderedDict()  # rows come by a: its sets are made once

        def shingles(i, text):
            key = (i, len(text))
            if key not in known:
                known[key] = shingle_set(text, p.ngram)
                if len(known) > 64:
                    known.popitem(last=False)
            return known[key]

        for batch in batches:
            for part in slices(batch, "tb"):
                a, b, ta, tb = (c.to_pylist() for c in part.columns)
                ok = [jaccard_at_least(shingles(i, s), shingle_set(t, p.ngram), p.percent) for i, s, t in zip(a, ta, tb, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    kind = pairs.schema["a"].dataType.simpleString()
    checked = both.select("a", "b", "ta", "tb").mapInArrow(run, struct(f"a {kind}, b {kind}, ok boolean"))
    return ws.save(checked.groupBy("a", "b").agg(F.max("ok").alias("ok")), "verified")


def _compare(ws: Workspace, pairs: DataFrame, sketches: DataFrame, p: MinHash) -> DataFrame:
    """(a, b, rate) of the written pairs that pass the size bound and the Bayesian test."""
    half = sketches.select("id", "n", "sig")
    with_b = pairs.join(half.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b")
    both = join_spread(ws, pairs, half.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a", "b", many_as=with_b)
    both = both.where(100 * F.least("na", "nb") >= p.percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            stay, rate = bayes_filter(_matrix(batch.column(2), p.size), _matrix(batch.column(3), p.size), p)
            at = pa.array(stay)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(rate)], names=["a", "b", "rate"])

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, struct(f"a {kind}, b {kind}, rate double"))


def open_pairs(key: int, ids, comps, sizes, sigs, keys, left, right, p: MinHash) -> list[tuple[int, int]]:
    """Row pairs of two blocks that could join two components and share no earlier band."""
    i, j = np.meshgrid(left, right, indexing="ij")
    i, j = i.ravel(), j.ravel()
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    ok = (comps[i] != comps[j]) & (100 * small >= p.percent * large) & (ids[i] < ids[j]) if left is right else (comps[i] != comps[j]) & (100 * small >= p.percent * large)
    i, j = i[ok], j[ok]
    out = []
    for at in range(0, len(i), 50_000):
        x, y = i[at : at + 50_000], j[at : at + 50_000]
        stay, _ = bayes_filter(sigs[x], sigs[y], p)
        x, y = x[stay], y[stay]
        equal = keys[x] == keys[y]
        mine = keys[x, equal.argmax(axis=1)] == key
        out += zip(x[mine].tolist(), y[mine].tolist(), strict=True)
    return out


def _distinct_rows(ids: np.ndarray, sigs: np.ndarray) -> np.ndarray:
    """Numbers of the rows that differ in id or signature (repeated rows of one id come once)."""
    if len(np.unique(ids)) == len(ids):
        return np.arange(len(ids))
    return np.sort(np.unique(np.hstack([ids.astype("<i8").view(np.uint8).reshape(len(ids), 8), sigs]), axis=0, return_index=True)[1])


def _tiles(comp: DataFrame, ws: Workspace) -> DataFrame:
    """(k, ti, tj, block, id, comp): members of buckets with several components, dealt to tiles of two blocks.

    Members of a bucket's largest component (its blocks are -1, -2, ..) meet
    the blocks of the others only; these meet each other too. A block has
    about ``TILE`` members, and about ``TILE_SHINGLES`` shingles of theirs,
    which bounds the texts that a tile holds.
    """
    parts = comp.groupBy("k", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("w"))
    mixed = parts.groupBy("k").agg(F.max(F.struct("n", "comp", "w")).alias("top"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    blocks = lambda n, w: F.ceil(F.greatest(n / TILE, w / TILE_SHINGLES)).cast("int")
    own, rest = blocks(F.col("top.n"), F.col("top.w")), blocks(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w"))
    mixed = ws.save(mixed.select("k", "n", F.col("top.comp").alias("major"), own.alias("own"), rest.alias("rest")), "mixed")
    rows = join_dealt(comp, mixed.select("k", "major", "own", "rest"), ["k"], "id", hot_keys(ws, mixed, ["k"]))
    major = F.col("comp") == F.col("major")
    block = F.pmod(F.xxhash64("id", "k"), F.when(major, F.col("own")).otherwise(F.col("rest"))).cast("int")
    rows = rows.withColumn("block", F.when(major, -1 - block).otherwise(block))
    others = F.sequence(F.lit(0), F.col("rest") - 1)
    ours = F.transform(F.sequence(F.lit(1), F.col("own")), lambda i: -i)
    rows = rows.withColumn("other", F.explode(F.when(major, others).otherwise(F.concat(ours, others))))
    return rows.select("k", F.least("block", "other").alias("ti"), F.greatest("block", "other").alias("tj"), "block", "id", "comp")


def _residual(ws: Workspace, members: DataFrame, labels: DataFrame, sketches: DataFrame, select: Selection, p: MinHash) -> DataFrame:
    """(a, b): verified links between bucket members, its smallest id aside, of different components.

    Tiles first name the rows that have open pairs (by signature), then only
    those bring their texts: rows grow with the members of a tile, never with
    its pairs.
    """
    sizes = sketches.groupBy("id").agg(F.max("n").cast("long").alias("size"))
    comp = members.where("id != lead").select("k", "id").join(sizes, "id").join(labels, "id", "left")
    comp = ws.save(comp.select("k", "id", "size", F.coalesce("component", "id").alias("comp")), "members")
    rows = _tiles(comp, ws).join(sketches.select("id", "n", "sig", "keys"), "id")
    dealt = rows.repartition("k", "ti", "tj").sortWithinPartitions("k", "ti", "tj", "id")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ("k", "ti", "tj")):
            ids, comps, sizes, block = (t.column(c).to_numpy() for c in ("id", "comp", "n", "block"))
            k, ti, tj = t.column("k")[0].as_py(), t.column("ti")[0].as_py(), t.column("tj")[0].as_py()
            if comps.min() == comps.max():
                continue
            sigs = _matrix(t.column("sig"), p.size)
            single = _distinct_rows(ids, sigs)
            keys = np.stack([np.asarray(v) for v in t.column("keys").to_pylist()])
            left, right = single[block[single] == ti], single[block[single] == tj]
            pairs = open_pairs(k, ids, comps, sizes, sigs, keys, left, left if ti == tj else right, p)
            partners: dict[int, list[int]] = {}
            for x, y in pairs:
                partners.setdefault(x, []).append(int(ids[y]))
                partners.setdefault(y, [])
            at = list(partners)
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * n, pa.int64()), pa.array([ti] * n, pa.int32()), pa.array([tj] * n, pa.int32()), pa.array(ids[at], pa.int64()), pa.array(comps[at], pa.int64()), pa.array(list(partners.values()), pa.list_(pa.int64()))],
                names=["k", "ti", "tj", "id", "comp", "partners"],
            )

    named = ws.save(dealt.select("k", "ti", "tj", "block", "id", "comp", "n", "sig", "keys").mapInArrow(look, struct("k long, ti int, tj int, id long, comp long, partners array<long>")), "open")
    whole = select(ws.save(named.select("id").distinct(), "needed"))
    told = named.join(whole, "id").repartition("k", "ti", "tj").sortWithinPartitions("k", "ti", "tj", "id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ("k", "ti", "tj")):
            ids, comps, partners = (t.column(c).to_pylist() for c in ("id", "comp", "partners"))
            parent: dict[int, int] = {}

            def find(x: int, parent=parent) -> int:
                while parent.get(x, x) != x:
                    x = parent[x]
                return x

            sets: dict[int, list[np.ndarray]] = {}  # two texts may stand under one id
            for i, v in zip(ids, t.column("text"), strict=True):  # one text at a time as a string
                sets.setdefault(i, []).append(shingle_set(v.as_py(), p.ngram))
            comp_of = dict(zip(ids, comps, strict=True))
            a, b = [], []
            for i, others in zip(ids, partners, strict=True):
                for j in others:
                    x, y = find(comp_of[i]), find(comp_of[j])
                    if x != y and any(jaccard_at_least(s, u, p.percent) for s in sets[i] for u in sets[j]):
                        parent[max(x, y)] = min(x, y)
                        a.append(i)
                        b.append(j)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return ws.save(told.select("k", "ti", "tj", "id", "comp", "partners", "text").mapInArrow(verify, struct("a long, b long")), "links")


def near_components(ws: Workspace, select: Selection, sketches: DataFrame, p: MinHash) -> DataFrame:
    """(id, component) of every id that is not the smallest of its group of near-duplicates.

    ``select`` gives (id, text) of a written table of ids, ``sketches`` is a
    written table from :func:`sketch`.
    """
    own = sketches.where("id IS NOT NULL AND n > 0")
    first = ws.save(own.groupBy("fp").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("first != last"), "first")
    copies = join_dealt(own.select("id", "fp"), first.select("fp", "first"), ["fp"], "id", hot_keys(ws, first, ["fp"])).where("id != first")
    copies = ws.save(copies.select("id", "fp", "first").distinct(), "copies")

    banded = own.select("id", "fp", "keys").join(copies.select("id", "fp"), ["id", "fp"], "left_anti").select("id", F.explode("keys").alias("k"))
    shared = banded.groupBy("k").agg(F.min("id").alias("lead"), F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("lead != top")
    shared = ws.save(shared.select("k", "lead", "n"), "buckets")
    members = ws.save(join_dealt(banded, shared.select("k", "lead"), ["k"], "id", hot_keys(ws, shared, ["k"])).select("k", "id", "lead"), "members")
    ws.drop(shared)
    labels = linked_members(ws, select, own, members, copies, p)
    ws.drop_all_but(sketches, labels)
    return labels


def linked_members(ws: Workspace, select: Selection, own: DataFrame, members: DataFrame, copies: DataFrame, p: MinHash) -> DataFrame:
    """(id, component) of every id that is not the smallest of its group, from the written (k, id, lead) of buckets and (id, first) of copies.

    ``own`` has the sketches (id, n, sig, keys) of all members; copies are in no bucket.
    """
    pairs = ws.save(members.where("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    survivors = ws.save(_compare(ws, pairs, own, p), "survivors")
    ws.drop(pairs)

    links = copies.select(F.col("first").alias("a"), F.col("id").alias("b"))
    nearest = survivors.groupBy("b").agg(F.max(F.struct("rate", (-F.col("a")).alias("m"))).alias("x")).select((-F.col("x.m")).alias("a"), "b")
    # What the survivors need is selected once and serves both rounds.
    needed = ws.save(survivors.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    texts = ws.save(select(needed), "texts")
    checked = _verify(ws, ws.save(nearest, "nearest"), texts, p)
    links = links.unionByName(checked.where("ok").select("a", "b"))
    labels = connected_components(ws, links)
    # What the nearest smallest id left open: at most one pair per band and text.
    ca = labels.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    cb = labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    across = join_spread(ws, survivors, ca, "a", "b", "left").join(cb, "b", "left").where("coalesce(ca, a) != coalesce(cb, b)").select("a", "b")
    left_open = ws.save(across.join(checked.select("a", "b"), ["a", "b"], "left_anti"), "open")
    if not left_open.isEmpty():
        links = links.unionByName(_verify(ws, left_open, texts, p).where("ok").select("a", "b"))
        labels = connected_components(ws, links)
    ws.drop(texts, survivors, needed, left_open)
    found = _residual(ws, members, labels, own, select, p)
    if not found.isEmpty():
        labels = connected_components(ws, links.unionByName(found))
    return labels


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", params: MinHash = MinHash()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Documents are linked if their sets of distinct word shingles (A-Z
    lower-cased; the whole sequence if there are fewer words than a shingle
    has) reach the threshold; a document without words is linked with
    nothing. ``component_id`` is the smallest id reachable. Rows with one id
    are one document: equal rows stay repeated, texts that differ under one
    id join its component. A row without an id links with nothing, has no
    component and is kept. ``doc_id`` is an integer column; others are not read.
    """
    ws = Workspace(docs.sparkSession, "near")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    sketches = ws.save(sketch(texts, params), "sketches")
    labels = near_components(ws, lambda ids: select_texts(texts, ids), sketches, params)
    out = sketches.select("id", "n").join(labels, "id", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component", "id"))
    return out.select(
        F.col("id").cast(docs.schema[doc_id].dataType).alias("doc_id"),
        F.col("n").cast("long").alias("n_shingles"),
        component.cast(docs.schema[doc_id].dataType).alias("component_id"),
        (F.col("id").isNull() | (component == F.col("id"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, *, params: MinHash = MinHash()) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns.

    The ids to drop are broadcast if they are small, else joined by a shuffle.
    Documents without an id, a text or a word stay, rows of one id stay or go
    together, columns of any name pass; an empty table gives an empty result.
    """
    gone = Workspace(docs.sparkSession, "gone").save(near_duplicates(docs, params=params).where("NOT kept").select("doc_id").distinct(), "gone")
    return docs.join(by_size(gone), "doc_id", "left_anti").select(*docs.columns)
