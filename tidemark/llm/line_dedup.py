"""Removal of lines that many documents share, in DataFrame functions only.

Documents are exploded to 24-byte rows (key hash, document hash), never to
line texts; the texts move once, and only their dropped positions come to
them. A line's key is the line stripped of ASCII white space at both ends,
with A-Z lower-cased; it is represented by 96 hash bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts into which the documents of one line are dealt.
SALTS = 32
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_SPACE))
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def line_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The input's columns with ``text`` replaced, plus n_lines and n_dropped.

    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    distinct documents lose all their lines; the other lines stay in order,
    joined by a newline. A null text counts as one empty line and becomes an
    empty text. Rows that share an id count as one document, rows without an
    id as one document for each distinct text. If all lines go, the text
    becomes empty. Repeated rows stay. Input columns named n_lines or
    n_dropped are replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(whole, "\n", -1)
    doc = F.when(F.col(doc_id).isNull(), F.xxhash64(whole)).otherwise(F.xxhash64(F.col(doc_id)))
    # A row is known by 96 bits of its id and text; repeated rows lose the same lines.
    row, check = F.xxhash64(F.col(doc_id), whole), F.hash(F.col(doc_id), whole)
    key = [F.xxhash64("_key").alias("a"), F.hash("_key").alias("b")]

    distinct = F.array_distinct(F.filter(F.transform(lines, _key), lambda k: F.length(k) >= min_chars))
    common = (
        docs.select(doc.alias("_doc"), F.explode(distinct).alias("_key"))
        .select("_doc", *key)
        .groupBy("a", "b", "_doc")
        .agg(F.lit(1).alias("_one"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("_docs"))
        .where(F.col("_docs") >= min_docs)
        # A line that a third of all documents hold is dealt to many tasks.
        .select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    placed = (
        docs.select(row.alias("_row"), check.alias("_check"), F.posexplode(F.transform(lines, _key)).alias("_pos", "_key"))
        .where(F.length("_key") >= min_chars)
        .select("_row", "_check", "_pos", *key, F.pmod(F.col("_row"), F.lit(SALTS)).cast("int").alias("_salt"))
    )
    dropped = placed.join(common, ["a", "b", "_salt"]).groupBy("_row", "_check").agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))

    rows = docs.select(*keep, row.alias("_row"), check.alias("_check"))
    out = rows.join(dropped.hint("shuffle_hash"), ["_row", "_check"], "left").withColumn("_lines", lines)
    n, gone = F.size(F.col("_lines")), F.col("_gone")
    # The kept lines are the runs between dropped positions.
    out = out.withColumn("_edges", F.concat(F.array(F.lit(-1)), gone, F.array(n)))

    def run(i: Column) -> Column:
        before, after = F.element_at("_edges", i), F.element_at("_edges", i + 1)
        return F.slice("_lines", before + 2, after - before - 1)

    runs = F.transform(F.sequence(F.lit(1), F.size(gone) + 1), run)
    kept = F.when(gone.isNull(), whole).otherwise(F.array_join(F.flatten(runs), "\n"))
    return out.select(
        *[kept.alias(c) if c == text else F.col(c) for c in keep],
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )
