"""Validation of result files, each rule an aggregate over lines or ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCHED, CANDIDATES = "matched_entity_ids", "candidate_entity_ids"
FINDING = "file string, rule string, severity string, n long, examples array<string>"


def parsed(lines: DataFrame) -> DataFrame:
    """(s1_id, ids, tab) of data ``lines(value)``; an empty rest is an empty list, blank lines without a tab go, nothing is stripped."""
    at = F.instr("value", "\t")
    rest = F.expr("substring(value, instr(value, '\t') + 1)")
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",", -1))
    rows = lines.select(F.when(at > 0, F.expr("substring(value, 1, instr(value, '\t') - 1)")).otherwise(F.col("value")).alias("s1_id"), F.when(at > 0, ids).alias("ids"), (at > 0).alias("tab"))
    return rows.filter("tab OR trim(s1_id) <> ''")


def findings(rows: DataFrame, required: DataFrame, name: str, known: DataFrame | None = None) -> DataFrame:
    """Findings on ``rows(s1_id, ids, tab)`` against ``required(s1_id)`` and, if given, ``known(id)``: one row a rule that is broken, with at most five sorted examples."""
    good = rows.filter("tab")
    ids = good.select("s1_id", F.explode("ids").alias("id"))
    bad = {
        "malformed": rows.filter("NOT tab").select(F.col("s1_id").alias("x")),
        "duplicate_row": good.groupBy(F.col("s1_id").alias("x")).agg(F.count("*").alias("c")).filter("c > 1").select("x"),
        "repeated_id": good.filter(F.size("ids") > F.size(F.array_distinct("ids"))).select(F.col("s1_id").alias("x")),
        "self_match": ids.filter(F.col("id").startswith("S1-")).select(F.col("id").alias("x")),
        "wrong_prefix": ids.filter(~F.col("id").rlike("^S[123]-")).select(F.col("id").alias("x")),
        "missing": required.select("s1_id").join(good, "s1_id", "left_anti").select(F.col("s1_id").alias("x")),
        "extra": good.select("s1_id").join(required, "s1_id", "left_anti").select(F.col("s1_id").alias("x")),
    }
    if known is not None:
        bad["unknown"] = ids.filter(F.col("id").rlike("^S[23]-")).join(known.select("id"), "id", "left_anti").select(F.col("id").alias("x"))
    tall = reduce(DataFrame.unionByName, [v.distinct().select(F.lit(k).alias("rule"), "x") for k, v in bad.items()])
    return summary(tall, name, "error")


def summary(tall: DataFrame, name: str, severity: str) -> DataFrame:
    """Counts and the five smallest examples of ``tall(rule, x)``, without gathering a rule's offenders."""
    from pyspark.sql import Window

    order = Window.partitionBy("rule").orderBy("x")
    few = tall.withColumn("r", F.row_number().over(order)).filter("r <= 5").groupBy("rule").agg(F.array_sort(F.collect_list("x")).alias("examples"))
    rows = tall.groupBy("rule").agg(F.count("*").alias("n")).join(few, "rule")
    return rows.select(F.lit(name).alias("file"), "rule", F.lit(severity).alias("severity"), "n", "examples")


def fatal(spark: SparkSession, name: str, rule: str, severity: str = "error") -> DataFrame:
    return spark.createDataFrame([(name, rule, severity, 1, [])], FINDING)


def check_file(spark: SparkSession, path: str, column: str, required: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(findings, rows) of a file; rows is None if it can't be parsed."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        text = spark.read.text(path)
        head = text.limit(1).collect()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return fatal(spark, name, "file_missing"), None
    if not head:
        return fatal(spark, name, "empty"), None
    header = head[0][0]
    if "\t" not in header and "," in header:
        return fatal(spark, name, "comma_separated"), None
    if [c.strip().lower() for c in header.split("\t")] != ["source1_entity_id", column]:
        return fatal(spark, name, "header"), None
    # the first line is the header; a line that repeats it is data
    again = text.filter(F.col("value") == header).count() - 1
    body = text.filter(F.col("value") != header)
    rows = parsed(body.unionByName(text.sparkSession.createDataFrame([(header,)], "value string").withColumn("value", F.explode(F.array_repeat("value", again)))) if again else body)
    return findings(rows, required, name, known), rows


def validate(spark: SparkSession, matching: str, candidates: str | None, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """All findings on the result files; matches outside the candidates and an absent candidate file are warnings. No errors: the files pass."""
    found, rows = check_file(spark, matching, MATCHED, required, known)
    if candidates is None:
        return found.unionByName(fatal(spark, "candidates", "file_missing", "warning"))
    other, pool = check_file(spark, candidates, CANDIDATES, required, known)
    if other.filter("rule = 'file_missing'").count():
        return found.unionByName(other.withColumn("severity", F.lit("warning")))
    found = found.unionByName(other)
    if rows is not None and pool is not None:
        pair = lambda r: r.filter("tab").select("s1_id", F.explode("ids").alias("id"))
        outside = pair(rows).join(pair(pool), ["s1_id", "id"], "left_anti").select(F.lit("not_in_candidates").alias("rule"), F.concat_ws(" ", "s1_id", "id").alias("x")).distinct()
        found = found.unionByName(summary(outside, "matching", "warning"))
    return found
