"""The thin queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import plan

    return plan(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip

    return round_trip(spark, table(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL),
win AS (
  SELECT r, doc_id, i - 1 AS s, array_to_string(list_slice(w, i, i + 49), ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
c AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g HAVING count(*) > 1),
m AS (SELECT r, doc_id, s, s + 50 AS e, f FROM win JOIN c USING (g)),
n AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 50 THEN 0 ELSE 1 END AS b FROM m),
p AS (SELECT *, sum(b) OVER (PARTITION BY r ORDER BY s) AS k FROM n)
SELECT doc_id, CAST(min(s) AS BIGINT) AS "start", CAST(max(e) AS BIGINT) AS "end", CAST(max(e) - min(s) AS BIGINT) AS n_words, min(f) AS first_doc_id
FROM p GROUP BY r, doc_id, k
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest

    return digest(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer())


def op7_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_fm import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM documents_vectors),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
""".replace("documents_vectors", "embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .host_rules import judge

    return judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM dup) GROUP BY r),
ln AS (
  SELECT r, count(*) - count(DISTINCT x) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (
  SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(ln.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov ON cov.r = d.r LEFT JOIN ln ON ln.r = d.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM b GROUP BY source),
m AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v FROM h),
p AS (SELECT m, least(0.5, greatest(2 * m, m + 4 * sqrt(v))) AS most, least(1e6, greatest(1.0, coalesce(CASE WHEN v > 0 THEN m * (1 - m) / v END - 1, 1e6))) AS s FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (k + s * m) / (n + s) <= most AS kept
FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.source, p
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op4_suffix_dedup": OP4_SQL, "op8_topk": OP8_SQL, "op10_host_rules": OP10_SQL}
