"""How a candidate compares with its rivals: windows over queries and over candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folds import numbered


def margin(value: str, *keys: str) -> Column:
    """The value less the best other one of its group; 0 stands for the other in a group of one."""
    w = Window.partitionBy(*keys)
    order = w.orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best, second = F.max(value).over(w), F.nth_value(value, 2).over(order)
    return F.col(value) - F.when(F.col(value) >= best, F.coalesce(second, F.lit(0.0))).otherwise(best)


def rank(value: str, tie: str, *keys: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), tie)) - 1


def rivals(rows: DataFrame) -> DataFrame:
    """``rows(s1_id, cand_id, score)`` with c_n, c_rank, c_gap and c_margin, over all queries of a candidate.

    A candidate can be one of very many queries, so its rows are numbered by steps of the
    score (numbered()), and its best two scores are those of its steps.
    """
    bucket = -F.floor(16 * F.col("score")).cast("int")
    placed = numbered(rows, ["cand_id"], bucket, [F.desc("score"), "s1_id"])
    facts = placed.groupBy("cand_id").agg(F.count("*").cast("int").alias("c_n"), F.max("score").alias("_best"), F.max(F.when(F.col("rn") == 2, F.col("score"))).alias("_second"))
    other = F.when(F.col("score") >= F.col("_best"), F.coalesce("_second", F.lit(0.0))).otherwise(F.col("_best"))
    joined = placed.join(facts, "cand_id").withColumns({"c_rank": (F.col("rn") - 1).cast("int"), "c_gap": F.col("_best") - F.col("score"), "c_margin": F.col("score") - other})
    return joined.drop("rn", "_best", "_second")


def competition(candidates: DataFrame) -> DataFrame:
    """``candidates(s1_id, cand_id, cos_name, cos_addr, score)`` with is_s3 and the twelve features of rivalry."""
    rows = candidates.withColumn("is_s3", F.col("cand_id").startswith("S3-").cast("int"))
    q, s = Window.partitionBy("s1_id"), Window.partitionBy("s1_id", "is_s3")
    best = lambda v, w: F.max(v).over(w)
    # a query has as many rows as blocking keeps, a candidate any number
    return rivals(rows).select(
        *rows.columns,
        best("score", q).alias("q_best"), (best("score", q) - F.col("score")).alias("q_gap"), F.count("*").over(q).cast("int").alias("q_n"),
        rank("score", "cand_id", "s1_id", "is_s3").alias("q_rank_src"), (best("score", s) - F.col("score")).alias("q_gap_src"),
        best("cos_name", q).alias("q_best_name"), best("cos_addr", q).alias("q_best_addr"),
        "c_n", "c_rank", "c_gap", "c_margin", margin("score", "s1_id").alias("q_margin"),
    )
