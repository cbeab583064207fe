"""The queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, conversation_trie, embedding_dedup, embedding_whitening, language_id, line_dedup, minhash_dedup, packing, personal_data, quality_rules, secret_scan, substring_dedup, token_counts

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    learned = language_id.learn_dictionaries(docs.where("NOT held_out"))
    return language_id.identify_languages(docs.select("doc_id", "text", "held_out"), learned, keep=("held_out",))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.bpe_digests(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, quality_rules.fit(docs, _table(spark, sf_dir, "labels")))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan_secrets(docs, secret_scan.learn_grammars(docs))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.find_personal_data(docs, personal_data.learn_detector(docs))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(_table(spark, sf_dir, "conversations"), rebuild=True)


_OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, n, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos, len(ls) AS n
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), common AS (
  SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, CAST(max(n) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE c.k IS NOT NULL) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.k = c.k
GROUP BY doc_id
"""


_OP9_SQL = r"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), edges AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT DISTINCT a AS vec_id, a AS other FROM edges
  UNION
  SELECT r.vec_id, e.b FROM reach r JOIN edges e ON r.other = e.a
), low AS (
  SELECT vec_id, min(other) AS c FROM reach GROUP BY vec_id
), n AS (
  SELECT a, count(*) AS n FROM edges GROUP BY a
)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(low.c, v.vec_id) AS component_id,
       coalesce(low.c, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN low ON v.vec_id = low.vec_id LEFT JOIN n ON v.vec_id = n.a
"""


# CRC-32 of the decimals, bit by bit; a node is its list of turns.
_OP13_SQL = r"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, count(*) AS n,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
                                      lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 9 AS h
  FROM own GROUP BY c
), plan AS (
  SELECT p.c, p.h, least(p.h, coalesce(b.n, 0)) AS had, p.c - p.c % 5 AS base FROM convs p LEFT JOIN convs b ON b.c = p.c - p.c % 5
), turns AS (
  SELECT o.c, o.pos - p.h + p.had AS d, role, text FROM own o JOIN plan p ON o.c = p.c WHERE o.pos > p.h
  UNION ALL
  SELECT p.c, o.pos, role, text FROM own o JOIN plan p ON o.c = p.base WHERE o.pos <= p.h
), paths AS (
  SELECT c, d, list(struct_pack(r := role, t := text)) OVER (PARTITION BY c ORDER BY d) AS path, octet_length(encode(text)) AS bytes FROM turns
  UNION ALL
  SELECT c, 0, []::STRUCT(r VARCHAR, t VARCHAR)[], 0 FROM convs
), tops AS (
  SELECT path, d, min(c) AS c, count(*) AS n, max(bytes) AS bytes FROM paths GROUP BY path, d
), nodes AS (
  SELECT t.*, (SELECT count(*) FROM tops k WHERE k.d = t.d + 1 AND k.path[1:t.d] = t.path) AS kids FROM tops t
), below AS (
  SELECT a.path, a.d, sum(CAST(u.kids = 0 AS BIGINT)) AS leaves, sum((u.n - 1) * u.bytes) AS saved
  FROM nodes a JOIN nodes u ON u.d >= a.d AND u.path[1:a.d] = a.path GROUP BY a.path, a.d
), lengths AS (
  SELECT c, max(d) AS d FROM paths GROUP BY c
), ended AS (
  SELECT p.path, p.d, string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) AS ids FROM paths p JOIN lengths l ON p.c = l.c AND p.d = l.d GROUP BY p.path, p.d
)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, up.c AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs, CAST(v.kids AS BIGINT) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes v JOIN below b ON b.path = v.path AND b.d = v.d
LEFT JOIN nodes up ON up.d = v.d - 1 AND up.path = v.path[1:v.d - 1]
LEFT JOIN ended e ON e.path = v.path AND e.d = v.d
"""


def queries() -> dict[str, Query]:
    found = (op1_substring_dedup, op2_language_id, op3_token_counts, op4_minhash_dedup, op5_bpe_codec, op6_quality_rules, op7_secret_scan, op8_line_dedup, op9_embedding_dedup, op10_best_fit_packing, op11_embedding_whitening, op12_personal_data, op13_conversation_trie)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup": _OP8_SQL, "op9_embedding_dedup": _OP9_SQL, "op13_conversation_trie": _OP13_SQL}
