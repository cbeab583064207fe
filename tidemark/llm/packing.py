"""Packing of documents into training sequences by vector best fit.

Every sequence has three capacities: tokens, documents and attention cost
(the sum of squared piece lengths). Pieces are placed in descending length;
each goes to the open sequence that has room in every dimension and scores
best: the least weighted norm of what would remain ("residual"), or the
largest weighted dot product of need and room ("dot").

Where the capacities for documents and cost are not given, they are set for
each group to the smallest multiple of the mean of a sequence, found by
bisection, that takes no sequence more than tokens alone do: few sequences come
first, then sequences of like numbers of documents and like cost.

Only piece sizes are dealt out for packing, to groups of about ``group_size``
pieces of any origin; a full piece is a sequence of its own and needs none.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pretokens
from tidemark.llm.textops import map_rows, struct
from tidemark.llm.workspace import Workspace

MAX_TOKENS = 2048
#: Pieces that one packing task gets at a time, on average.
GROUP_SIZE = 16_384
#: Weights of tokens, documents and attention cost.
WEIGHTS = (1.0, 1e-3, 1e-3)
#: Capacities for documents and cost are this many times the mean of a sequence at most, and steps of bisection towards 1.
MOST_SLACK, STEPS = 64.0, 7
#: Id placed after every document.
SEPARATOR_ID = 0


def pack(lengths: Sequence[int], max_tokens: int, max_docs: int, max_cost: float, weights: Sequence[float] = WEIGHTS, rule: str = "residual") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece; pieces longer than a limit alone are refused.

    Ties between bins go to the bin opened first, between pieces to the one
    that comes first.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n == 0:
        return bins, offsets
    if lengths.max() > max_tokens or float(lengths.max()) ** 2 > max_cost or max_docs < 1:
        raise ValueError("a piece exceeds a capacity by itself")
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths[order[-1]])
    caps = np.array([max_tokens, max_docs, max_cost], float)
    w = np.asarray(weights, float)
    room, names = np.empty((3, 1024)), np.empty(1024, np.int64)
    open_, opened = 0, 0
    for at, i in enumerate(order):
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size])
        live = room[:, :open_]
        fits = np.flatnonzero((live[0] >= need[0]) & (live[1] >= 1.0) & (live[2] >= need[2])) if open_ else ()
        if len(fits):
            have = live[:, fits]
            if rule == "residual":
                left = (have - need[:, None]) / caps[:, None]
                j = fits[int(np.argmin(w @ (left * left)))]
            else:
                j = fits[int(np.argmax((w * need / caps) @ (have / caps[:, None])))]
        else:
            if open_ == len(names):
                room, names = np.concatenate([room, np.empty_like(room)], axis=1), np.concatenate([names, np.empty_like(names)])
            j, open_ = open_, open_ + 1
            names[j], room[:, j] = opened, caps
            opened += 1
        bins[i], offsets[i] = names[j], max_tokens - int(room[0, j])
        room[:, j] -= need
        if at % 512 == 511:  # bins that nothing left can enter are closed
            stay = np.flatnonzero((room[0, :open_] >= least) & (room[1, :open_] >= 1))
            room[:, : len(stay)], names[: len(stay)] = room[:, stay], names[stay]
            open_ = len(stay)
    return bins, offsets


def pack_balanced(lengths: Sequence[int], max_tokens: int, max_docs: int | None, max_cost: float | None, weights: Sequence[float] = WEIGHTS, rule: str = "residual") -> tuple[np.ndarray, np.ndarray]:
    """:func:`pack` with the capacities that are None set as tight as no further sequence allows.

    Pieces of ``max_tokens`` fill a sequence each and have no part in the means.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    docs, cost = max_tokens if max_docs is None else max_docs, float(max_tokens) ** 2 if max_cost is None else max_cost
    loose = pack(lengths, max_tokens, docs, cost, weights, rule)
    rest, alone = np.flatnonzero(lengths < max_tokens), np.flatnonzero(lengths == max_tokens)
    if len(rest) == 0 or (max_docs is not None and max_cost is not None):
        return loose
    part = lengths[rest]
    fewest = int(loose[0].max()) + 1 - len(alone)
    low, high, best = 0.0, math.log(MOST_SLACK), None
    for _ in range(STEPS):
        at = (low + high) / 2
        slack = math.exp(at)
        tight_docs = min(docs, math.ceil(slack * len(part) / fewest)) if max_docs is None else docs
        tight_cost = min(cost, max(slack * float((part * part).sum()) / fewest, float(part.max()) ** 2)) if max_cost is None else cost
        bins, offsets = pack(part, max_tokens, tight_docs, tight_cost, weights, rule)
        if int(bins.max()) + 1 <= fewest:
            high, best, fewest = at, (bins, offsets), int(bins.max()) + 1
        else:
            low = at
    if best is None:
        return loose
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bins[rest], offsets[rest] = best
    bins[alone] = fewest + np.arange(len(alone))
    return bins, offsets


def cut(total: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole if it fits, else a shorter first piece and full ones."""
    if total <= size:
        return [(0, total)]
    first = total % size
    starts = ([0] if first else []) + list(range(first, total, size))
    return [(s, (first if first and s == 0 else size)) for s in starts]


def pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def prepare():
        encode = pretokens.RankEncoder(ranks, tokenizer).text

        def work(ids, texts):
            out: list[list] = [[], [], [], [], []]
            for d, t in zip(ids, texts, strict=True):
                tokens = np.append(encode(t or ""), np.array([SEPARATOR_ID], "<u4")).astype("<u4", copy=False)
                for k, (start, length) in enumerate(cut(len(tokens), max_tokens)):
                    for column, value in zip(out, (d, k, start, length, zlib.crc32(tokens[start : start + length].tobytes())), strict=True):
                        column.append(value)
            return out

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, struct(f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"), prepare)


def best_fit_pack(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken",
    max_tokens: int = MAX_TOKENS,
    max_docs: int | None = None,
    max_cost: float | None = None,
    weights: Sequence[float] = WEIGHTS,
    rule: str = "residual",
    group_size: int = GROUP_SIZE,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A null or empty text is the separator alone; texts may be of any length.
    ``max_docs`` and ``max_cost`` default to the tightest that cost no
    sequence (:func:`pack_balanced`). Ties between pieces go by (doc_id, piece,
    ids_crc32), whatever order rows arrive in. Repeated rows and null ids are
    documents of their own; other columns are not read. An empty table gives an
    empty result.
    """
    ws = Workspace(docs.sparkSession, "pack")
    # Written once: the texts are encoded once, and numbering rows is repeatable.
    cut_up = ws.save(pieces(docs, doc_id=doc_id, text=text, tokenizer=tokenizer, ranks=ranks, max_tokens=max_tokens), "pieces")
    groups = max(1, -(-cut_up.count() // group_size))
    dealt = cut_up.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long"))
    schema = struct(cut_up.schema.simpleString()[7:-1].replace(":", " ") + ", sequence_id long, offset long")

    def packed(key, pdf):
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offsets = pack_balanced(pdf["length"].to_numpy(), max_tokens, max_docs, max_cost, weights, rule)
        return pdf.drop(columns="g").assign(sequence_id=(np.int64(key[0]) << 32) + bins, offset=offsets)

    return dealt.groupBy("g").applyInPandas(packed, schema)
