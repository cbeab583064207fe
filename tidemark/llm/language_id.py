"""Language identification by compression with one raw-content dictionary per language.

A text's letters, in lower case, go through the compressor once per language, block by block, each
block with the language's dictionary as its past; the language whose
dictionary leaves the fewest bytes wins. Dictionaries are made from a bounded,
hash-chosen sample of labelled texts (``SAMPLE_DOCS`` per language, texts of
at most ``SAMPLE_CHARS`` characters, ``DICT_BYTES`` of content each).
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textops import map_rows, struct

#: Labelled texts per language that a dictionary is made from, at most.
SAMPLE_DOCS = 400
#: Characters of a labelled text that may enter the sample, from its start.
SAMPLE_CHARS = 16_384
#: Bytes of a language's dictionary.
DICT_BYTES = 256 * 1024
#: Bytes of text compressed at once; small enough for the dictionary to matter throughout.
BLOCK_BYTES = 2048
LEVEL = 3
#: A margin below so many bytes, or so large a part of the smallest size, is narrow.
MIN_MARGIN_BYTES = 2
MIN_MARGIN_PART = 0.004
#: Bytes of difference that halve a language's share of the score.
SCORE_BYTES = 2.0
UNKNOWN = "und"
#: Columns of a prediction.
RESULTS = ("lang_pred", "score", "margin_bytes", "rejected")

_LETTER = regex.compile(r"\p{L}")
_OTHER = re.compile(r"[\W\d_]+")


def learn_dictionaries(labelled: DataFrame, *, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Language -> dictionary content, from rows with a text and a language.

    Rows are chosen by a hash of their text below a bound that follows the
    language's number of different texts, so the sample needs no sort and no
    group in one task. Equal texts enter once, and count once; of a long text
    the first ``SAMPLE_CHARS`` characters do.
    """
    rows = labelled.select(F.substring(text, 1, SAMPLE_CHARS).alias("text"), F.col(lang).alias("lang")).where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("n")).collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    chosen: Column = F.lit(False)
    for name, n in counts.items():
        chosen = chosen | ((F.col("lang") == name) & (draw < F.lit(int((1 << 40) * min(1.0, 2 * SAMPLE_DOCS / n)))))
    # One text counts once, whatever the copies do. A language's texts, at most about 2 * SAMPLE_DOCS, meet in one task, which sends its dictionary only.
    sample = rows.where(chosen).groupBy("lang", "text").agg(F.lit(1).alias("_one")).select("lang", "text", F.xxhash64("text").alias("_at"))

    def fill(table: pa.Table) -> pa.Table:
        own = table.sort_by([("_at", "ascending"), ("text", "ascending")]).slice(0, SAMPLE_DOCS).column("text").to_pylist()
        return pa.table({"lang": table.column("lang")[:1], "content": pa.array([b" ".join(map(letters, own))[-DICT_BYTES:]], pa.binary())})

    kind = rows.schema["lang"].dataType.simpleString()
    return {r.lang: bytes(r.content) for r in sample.groupBy("lang").applyInArrow(fill, f"lang {kind}, content binary").orderBy("lang").collect()}


def letters(text: str) -> bytes:
    """The text's words of letters, in lower case, with one space between: what the language shows in."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


class Identifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self._compress = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self._compress.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        raw = letters(text)
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(compress(b)) for b in blocks) for compress in self._compress]

    def identify(self, text: str | None) -> tuple[str, float, int, bool]:
        """(language, score, margin in bytes, rejected)."""
        if not text or not self.names or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=lambda k: (sizes[k], self.names[k]))
        rest = [s for k, s in enumerate(sizes) if k != best]
        margin = min(rest) - sizes[best] if rest else sizes[best]
        score = 1.0 / sum(math.pow(2.0, -min(60.0, (s - sizes[best]) / SCORE_BYTES)) for s in sizes)
        return self.names[best], score, margin, margin < max(MIN_MARGIN_BYTES, MIN_MARGIN_PART * sizes[best])


def identify_languages(docs: DataFrame, dictionaries: dict[str, bytes], *, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, lang_pred, score, margin_bytes, rejected), one row per input row.

    ``lang_pred`` is the language of the smallest size (ties: the first name);
    ``rejected`` says that the margin is too narrow to rely on. A text that is
    null or has no letter, and any text if there are no dictionaries, is
    ``und`` with score 0 and rejected. Repeated rows and null ids stay; an
    empty table gives an empty result. Columns of ``keep`` that have a
    result's name are left out for it.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *[c for c in keep if c not in ("doc_id", "text", *RESULTS)])
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def prepare():
        known = Identifier(shared.value)

        def work(ids, texts, *others):
            found = [known.identify(t) for t in texts]
            return [ids, *others, *([f[k] for f in found] for k in range(4))]

        return work

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return map_rows(rows, struct(f"{kinds}, lang_pred string, score double, margin_bytes long, rejected boolean"), prepare)
