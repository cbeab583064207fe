"""The trie of conversation prefixes, with subtree figures.

Turns are put in order by a range sort, so a conversation of any length is
dealt to several tasks, and are known by 128-bit digests whose texts are
compared wherever a digest occurs twice. Numpy scans make polynomial rolling
fingerprints of every prefix: the sum of digest times a power of a fixed point,
modulo 2**61 - 1, along chunks of a conversation whose totals are then carried
over. Equal (depth, fingerprint) are candidates for one node; a group is
verified turn by turn against its representative, its smallest conversation.
Given equal fingerprints and equal last turns, the fingerprints of the parents
are equal too, so it is enough to compare the last turns of all depths. Where
one differs, groups are split by (turn, parent) until none splits any more.

The rollup needs no walk: the nodes that one conversation represents are the
tail of its path, from some depth on, and this chain hangs off the path of a
smaller conversation. A subtree's figures are therefore sums over the members
of its top node: of their whole chain, or of what lies below that node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.skew import hot_keys, join_dealt
from tidemark.llm.textops import mix64, struct
from tidemark.llm.workspace import Workspace

#: Turns of a conversation that one task scans.
CHUNK = 4096
#: Conversation numbers whose decimals are joined at a time.
ENDS = 4096
MODULUS = (1 << 61) - 1
#: Points of the two polynomials.
POINTS = (0x1B873593CC9E2D51, 0x0F5A3D2B7C4E9A17)

Rebuild = Callable[[DataFrame, DataFrame], DataFrame]
_NODE = ["rep", "d"]


def multiply(x: np.ndarray, y: np.ndarray, modulus: int = MODULUS) -> np.ndarray:
    """x * y modulo 2**61 - 1, or a modulus below 2**31, of reduced uint64 arrays."""
    if modulus < 1 << 31:
        return x * y % np.uint64(modulus)
    p, low, half = np.uint64(modulus), np.uint64(0xFFFFFFFF), np.uint64(32)
    xh, xl, yh, yl = x >> half, x & low, y >> half, y & low
    # 2**64 is 8, and 2**29 of the middle products' upper part is 2**61, which is 1.
    mid, least = xh * yl + xl * yh, xl * yl
    total = ((xh * yh) << np.uint64(3)) + (mid >> np.uint64(29)) + ((mid & np.uint64((1 << 29) - 1)) << half) + (least & p) + (least >> np.uint64(61))
    total = (total & p) + (total >> np.uint64(61))
    return np.where(total >= p, total - p, total)


def powers(point: int, first: int, n: int, modulus: int = MODULUS) -> np.ndarray:
    """point ** first .. point ** (first + n - 1)."""
    out = np.array([pow(point, first, modulus)], np.uint64)
    step = point % modulus
    while len(out) < n:  # doubling: the next ones are those at hand times a power
        out = np.concatenate([out, multiply(out, np.full(len(out), pow(step, len(out), modulus), np.uint64), modulus)])
    return out[:n]


def running_sums(terms: np.ndarray, starts: np.ndarray, modulus: int = MODULUS) -> np.ndarray:
    """Sums of the terms since the last start, modulo; ``starts`` are flags, the first of them set."""
    half, p = np.uint64(32), np.uint64(modulus)
    high, low = np.cumsum(terms >> half), np.cumsum(terms & np.uint64(0xFFFFFFFF))
    at = np.flatnonzero(starts)[np.cumsum(starts) - 1]
    high, low = high - high[at] + (terms[at] >> half), low - low[at] + (terms[at] & np.uint64(0xFFFFFFFF))
    return (multiply(high % p, np.full(len(high), (1 << 32) % modulus, np.uint64), modulus) + low % p) % p


def _starts(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def digests(role: Column, text: Column) -> tuple[Column, Column]:
    return F.xxhash64(role, text), F.xxhash64(F.lit(1), text, role)


def _numbered(ws: Workspace, turns: DataFrame) -> DataFrame:
    """(c, pos, a, b, k, bytes): turns (c, turn, role, text, a, b, k) with their place from 1."""
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # Equal rows may stand in any order; their numbers part them where they are very many.
    tie = F.monotonically_increasing_id().alias("tie")
    sized = turns.select("c", "turn", "role", "text", "a", "b", "k", F.octet_length("text").cast("long").alias("bytes"), tie)
    dealt = sized.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").select("c", "a", "b", "k", "bytes", F.spark_partition_id().alias("p"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.column(0).to_numpy()
            new = _starts(c)
            at = np.arange(len(c))
            i = at - np.flatnonzero(new)[np.cumsum(new) - 1] + 1
            i[: int(np.argmax(np.append(c != c[0], True)))] += held if c[0] == last else 0
            last, held = c[-1], int(i[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i)], names=["c", "a", "b", "k", "bytes", "p", "i"])

    local = ws.save(dealt.mapInArrow(number, struct("c long, a long, b long, k long, bytes long, p int, i long")), "turns")
    # A conversation goes over from one partition to the next at most once a partition: as many rows.
    runs = local.groupBy("c", "p").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("c").orderBy("p").rowsBetween(W.unboundedPreceding, -1))
    over = ws.save(runs.withColumn("before", before).where("before > 0").select("c", "p", "before"), "over")
    return local.join(F.broadcast(over), ["c", "p"], "left").select("c", (F.col("i") + F.coalesce("before", F.lit(0))).alias("pos"), "a", "b", "k", "bytes")


def _collided(ws: Workspace, turns: DataFrame) -> DataFrame:
    """(a, b, role, text, k) of digests that several texts share; only texts whose digest occurs twice are looked at."""
    twice = ws.save(turns.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "twice")
    same = join_dealt(turns.select("a", "b", "role", "text", F.monotonically_increasing_id().alias("i")), twice.select("a", "b"), ["a", "b"], "i", hot_keys(ws, twice, ["a", "b"]))
    texts = same.select("a", "b", "role", "text").distinct()
    w = W.partitionBy("a", "b").orderBy("role", "text")
    ranked = texts.withColumn("k", F.row_number().over(w).cast("long")).withColumn("texts", F.count(F.lit(1)).over(W.partitionBy("a", "b")))
    return ws.save(ranked.where("texts > 1").select("a", "b", "role", "text", "k"), "collided")


def known_turns(ws: Workspace, conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, digest=digests) -> DataFrame:
    """(c, pos, a, b, k, bytes), one row a turn in order; two turns have equal (a, b, k) if and only if role and text are equal."""
    rows = conversations.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    a, b = digest(F.col("role"), F.col("text"))
    rows = rows.withColumn("a", a).withColumn("b", b)
    collided = _collided(ws, rows)
    if collided.isEmpty():
        rows = rows.withColumn("k", F.lit(0).cast("long"))
    else:
        rows = rows.join(collided, ["a", "b", "role", "text"], "left").withColumn("k", F.coalesce("k", F.lit(0)))
    return _numbered(ws, rows)


def shared_heads(turns: DataFrame, convs: DataFrame, ws: Workspace, width: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c anew: the first h turns of conversation c - c % width, then its own after its first h; h = crc32(c) % most.

    ``turns`` has (c, pos, ...), ``convs`` (c, n). A conversation that has no
    turns left has no rows; what the base lacks is left out, and later turns move up.
    """
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % most).cast("long")
    plan = convs.select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % width).alias("base"))
    bases = plan.where("c = base").select("base", F.col("n").alias("base_n"))
    plan = ws.save(plan.join(bases, "base", "left").withColumn("had", F.least("h", F.coalesce("base_n", F.lit(0)))), "heads")
    rest = [c for c in turns.columns if c not in ("c", "pos")]
    own = join_dealt(turns.withColumn("h", h).where("pos > h").drop("h"), plan.select("c", "h", "had"), ["c"], "pos", hot_keys(ws, plan, ["c"]))
    own = own.select("c", (F.col("pos") - F.col("h") + F.col("had")).alias("pos"), *rest)
    heads = turns.where((F.col("c") % width == 0) & (F.col("pos") < most)).withColumnRenamed("c", "base").join(plan.select("c", "base", "h"), "base").where("pos <= h")
    return own.unionByName(heads.select("c", "pos", *rest))


def prefixes(ws: Workspace, turns: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """(c, d, a, b, k, bytes, f, g): the two fingerprints of every prefix, for turns numbered without gaps from 1."""
    rows = turns.select("c", F.col("pos").alias("d"), "a", "b", "k", "bytes", F.floor((F.col("pos") - 1) / CHUNK).cast("long").alias("chunk"))
    dealt = rows.repartition("c", "chunk").sortWithinPartitions("c", "chunk", "d")
    points = [p % modulus for p in POINTS]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = np.uint64(modulus)
        table = [powers(x, 0, CHUNK, modulus) for x in points]
        bases: dict[int, tuple] = {}
        last, carry = None, (np.uint64(0), np.uint64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            c, d, a, b, k, _, chunk = (col.to_numpy() for col in batch.columns)
            new = _starts(c, chunk)
            inside = (d - 1) % CHUNK
            shift = mix64(k.view(np.uint64)) if k.any() else np.uint64(0)
            out = []
            for which, digest in enumerate((a, b)):
                term = multiply((mix64(digest.view(np.uint64)) ^ shift) % p, table[which][inside], modulus)
                if chunk.any():
                    for j in np.unique(chunk):
                        if j not in bases:
                            if len(bases) > 1000:
                                bases.clear()
                            bases[j] = tuple(np.uint64(pow(x, int(j) * CHUNK, modulus)) for x in points)
                        at = chunk == j
                        term[at] = multiply(term[at], np.full(int(at.sum()), bases[j][which], np.uint64), modulus)
                sums = running_sums(term, new, modulus)
                if (c[0], chunk[0]) == last:
                    n = int(np.argmax(np.append(new[1:], True))) + 1
                    sums[:n] = (sums[:n] + carry[which]) % p
                out.append(sums)
            last, carry = (c[-1], chunk[-1]), (out[0][-1], out[1][-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out[0].view(np.int64)), pa.array(out[1].view(np.int64))], names=["c", "d", "a", "b", "k", "bytes", "chunk", "f", "g"])

    local = ws.save(dealt.mapInArrow(scan, struct("c long, d long, a long, b long, k long, bytes long, chunk long, f long, g long")), "scanned")
    # The last row of a full chunk holds its total; longer conversations carry these on.
    totals = local.where(F.col("d") % CHUNK == 0).select("c", (F.col("chunk") + 1).alias("chunk"), F.col("f").cast("decimal(38,0)").alias("tf"), F.col("g").cast("decimal(38,0)").alias("tg"))
    w = W.partitionBy("c").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0)
    carried = totals.select("c", "chunk", *[(F.sum(t).over(w).cast("decimal(38,0)") % F.lit(modulus).cast("decimal(38,0)")).cast("long").alias(t) for t in ("tf", "tg")])
    whole = local.join(carried, ["c", "chunk"], "left")
    add = lambda x, t: (F.col(x) + F.coalesce(t, F.lit(0))) % F.lit(modulus)
    return whole.select("c", "d", "a", "b", "k", "bytes", add("f", "tf").alias("f"), add("g", "tg").alias("g"))


def _refined(ws: Workspace, rows: DataFrame) -> DataFrame:
    """The rows with ``s`` that parts conversations of one fingerprint and different prefixes: the representative of their true group."""
    turn = ["d", "f", "g", "a", "b", "k"]
    spread = lambda t, keys: join_dealt(t, ws.save(t.groupBy(*keys).agg(F.min("c").alias("s"), F.count(F.lit(1)).alias("n")), "split"), keys, "c", hot_keys(ws, t.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)).drop("n")
    now = ws.save(spread(rows, turn), "split")
    n = now.select("d", "s").distinct().count()
    while True:
        parent = now.select("c", (F.col("d") + 1).alias("d"), F.col("s").alias("up"))
        known = now.drop("s").join(parent, ["c", "d"], "left").withColumn("up", F.coalesce("up", F.lit(0)))
        now = ws.save(spread(known, [*turn, "up"]).drop("up"), "split")
        more = now.select("d", "s").distinct().count()
        if more == n:
            return now
        n = more


def labelled(ws: Workspace, rows: DataFrame) -> DataFrame:
    """(c, d, bytes, rep, n): the representative and the number of members of every prefix's node."""
    rows = ws.save(rows, "prefixes")
    keys = ["d", "f", "g"]
    turn = F.struct("a", "b", "k")
    groups = ws.save(rows.groupBy(*keys).agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("n"), F.min(turn).alias("least"), F.max(turn).alias("most")).where("n > 1"), "groups")
    if not groups.where("least != most").isEmpty():
        rows = _refined(ws, rows)
        keys = ["d", "f", "g", "s"]
        groups = ws.save(rows.groupBy(*keys).agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
    named = join_dealt(rows, groups.select(*keys, "rep", "n"), keys, "c", hot_keys(ws, groups, keys), "left")
    return ws.save(named.select("c", "d", "bytes", F.coalesce("rep", "c").alias("rep"), F.coalesce("n", F.lit(1)).alias("n")), "labelled")


def _ends(members: DataFrame) -> DataFrame:
    """(rep, d, ends): SHA-256 of the decimals of ``c`` in order, of (rep, d, c). Decimals are joined in blocks; a node's blocks pass through one hash."""
    block = F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",")
    blocks = members.groupBy(*_NODE, F.floor(F.col("c") / ENDS).alias("at")).agg(block.alias("ids")).repartition(*_NODE).sortWithinPartitions(*_NODE, "at")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done: list[tuple] = []
            for rep, d, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (rep, d) != node:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (rep, d), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _batch(done)
        if node is not None:
            yield _batch([(*node, sha.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["rep", "d", "ends"])

    return blocks.mapInArrow(hashed, struct("rep long, d long, ends string"))


def prefix_trie(ws: Workspace, turns: DataFrame, convs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """One row a node, of turns (c, pos, a, b, k, bytes) numbered without gaps and all conversations (c), those without turns too."""
    rows = labelled(ws, prefixes(ws, turns, modulus))
    own = F.col("rep") == F.col("c")
    value = (F.col("n") - 1) * F.col("bytes")
    # A conversation's chain: where it begins, what it hangs off, what it saves.
    paths = rows.groupBy("c").agg(
        F.max("d").alias("length"), F.min(F.when(own, F.col("d"))).alias("first"), F.max_by(F.when(~own, F.col("rep")), F.when(~own, F.col("d"))).alias("up"), F.sum(F.when(own, value).otherwise(0)).alias("chain")
    )
    paths = ws.save(convs.select("c").join(paths, "c", "left").select("c", F.coalesce("length", F.lit(0)).alias("length"), "first", "up", F.coalesce("chain", F.lit(0)).alias("chain")), "paths")
    root = paths.agg(F.min("c")).first()[0]
    if root is None:
        return _result(ws.spark.createDataFrame([], "rep long, d long, parent long, n_convs long, kids long, leaves long, saved long, ends string"))
    kids = ws.save(paths.where("first > 1").groupBy(F.col("up").alias("rep"), (F.col("first") - 1).alias("d")).agg(F.count(F.lit(1)).alias("kids")), "kids")
    bare = kids.select(F.col("rep").alias("c"), F.col("d").alias("length"), F.lit(True).alias("extended"))
    tips = ws.save(paths.join(bare, ["c", "length"], "left").withColumn("leaf", (F.col("first").isNotNull() & F.col("extended").isNull()).cast("long")).drop("extended"), "tips")

    # What a chain saves from a depth on: within chunks, then what later chunks save.
    chunk = F.floor((F.col("d") - 1) / CHUNK)
    shared = rows.where(own & (F.col("n") > 1)).withColumn("chunk", chunk).withColumn("below", F.sum(value).over(W.partitionBy("c", "chunk").orderBy(F.desc("d"))))
    sums = shared.groupBy("c", "chunk").agg(F.max("below").alias("v"))
    later = sums.withColumn("later", F.sum("v").over(W.partitionBy("c").orderBy(F.desc("chunk")).rowsBetween(W.unboundedPreceding, -1))).where("later IS NOT NULL").drop("v")
    shared = shared.join(later, ["c", "chunk"], "left").withColumn("below", F.col("below") + F.coalesce("later", F.lit(0))).drop("chunk", "later")
    every = shared.unionByName(rows.where(~own | (F.col("n") == 1)).withColumn("below", F.lit(0).cast("long")))
    lengths = hot_keys(ws, tips, ["c"], "length")
    met = ws.save(join_dealt(every, tips, ["c"], "d", lengths), "met")

    up = F.when(F.col("d") > F.col("first"), F.col("c")).otherwise(F.coalesce("up", F.lit(root)))
    none = F.lit(None)
    member = met.select(
        "rep", "d", F.when(own, up).alias("parent"), F.lit(1).alias("n_convs"), (own & (F.col("d") < F.col("length"))).cast("long").alias("kids"), "leaf", F.when(own, F.col("below")).otherwise(F.col("chain")).alias("saved"), none.cast("string").alias("ends")
    )
    top = tips.select(F.lit(root).alias("rep"), F.lit(0).cast("long").alias("d"), none.cast("long").alias("parent"), F.lit(1).alias("n_convs"), F.coalesce((F.col("first") == 1).cast("long"), F.lit(0)).alias("kids"), "leaf", F.col("chain").alias("saved"), none.cast("string").alias("ends"))
    blank = [none.cast("long").alias("parent"), F.lit(0).alias("n_convs")]
    hung = kids.select("rep", "d", *blank, "kids", F.lit(0).alias("leaf"), F.lit(0).alias("saved"), none.cast("string").alias("ends"))
    last = met.where("d = length").select("rep", "d", "c").unionByName(tips.where("length = 0").select(F.lit(root).alias("rep"), F.lit(0).cast("long").alias("d"), "c"))
    ended = _ends(last).select("rep", "d", *blank, F.lit(0).alias("kids"), F.lit(0).alias("leaf"), F.lit(0).alias("saved"), "ends")
    parts = member.unionByName(top).unionByName(hung).unionByName(ended)
    nodes = parts.groupBy(*_NODE).agg(F.max("parent").alias("parent"), F.sum("n_convs").alias("n_convs"), F.sum("kids").alias("kids"), F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"))
    return _result(nodes)


def _result(nodes: DataFrame) -> DataFrame:
    # A root that nothing hangs off is its own leaf.
    leaves = F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long")
    return nodes.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n_convs").cast("long").alias("n_convs"), F.col("kids").cast("long").alias("n_children"), leaves.alias("n_leaves"), F.col("saved").cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rebuild: bool = False, digest=digests, modulus: int = MODULUS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row a node, the root too.

    A node is a distinct sequence of the first d turns (role, text); its
    conv_id is its smallest member. Turns stand in order of ``turn``, null
    first, ties in order of role and text; repeated rows are turns of their
    own. A null role or text is empty. Rows without a conversation are passed
    over; other columns are not read. ``rebuild`` takes conversations as
    :func:`shared_heads` makes them. An empty table gives an empty result.
    """
    ws = Workspace(conversations.sparkSession, "trie")
    turns = ws.save(known_turns(ws, conversations, conv_id, turn, role, text, digest), "known")
    convs = ws.save(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "convs")
    return prefix_trie(ws, shared_heads(turns, convs, ws) if rebuild else turns, convs, modulus)
