"""From probabilities to results: one-to-one assignment, threshold search, macro F0.5, result lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The thresholds that are tried, in hundredths.
GRID = list(range(30, 100, 5))


def assign_best(scored: DataFrame, prob: str = "prob") -> DataFrame:
    """``scored`` with best: whether a row has its candidate's highest probability; ties go to the smaller s1_id."""
    order = Window.partitionBy("cand_id").orderBy(F.desc(prob), "s1_id")
    return scored.withColumn("best", F.row_number().over(order) == 1)


def f05(predicted: Column, correct: Column, true: Column) -> Column:
    """F0.5 of one entity; 1 where nothing is true and nothing predicted."""
    p, r = F.try_divide(correct, predicted), F.try_divide(correct, true)
    return F.when(correct > 0, F.coalesce(F.try_divide(1.25 * p * r, 0.25 * p + r), F.lit(0.0))).when((true == 0) & (predicted == 0), 1.0).otherwise(0.0)


def macro_f05(entities: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row (f05, entities): the mean over ``entities(s1_id)`` of predictions ``(s1_id, cand_id)`` against ``truth``."""
    t = truth.select("s1_id", "cand_id").distinct()
    n = t.groupBy("s1_id").agg(F.count("*").alias("n"))
    hits = predicted.select("s1_id", "cand_id").join(t.withColumn("ok", F.lit(1)), ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count("*").alias("p"), F.count("ok").alias("ok"))
    rows = entities.select("s1_id").distinct().join(n, "s1_id", "left").join(hits, "s1_id", "left").na.fill(0, ["n", "p", "ok"])
    return rows.agg(F.avg(f05(F.col("p"), F.col("ok"), F.col("n"))).alias("f05"), F.count("*").alias("entities"))


def threshold_grid(entities: DataFrame, truth: DataFrame, scored: DataFrame) -> DataFrame:
    """(assign, threshold, f05) for each rule: with and without assignment, over GRID; ``scored(s1_id, cand_id, prob)``.

    Pairs are summed for all rules in one aggregation; a rule is one of 28 columns, not a copy of the pairs.
    """
    t = truth.select("s1_id", "cand_id").distinct()
    n = t.groupBy("s1_id").agg(F.count("*").alias("n"))
    rows = assign_best(scored).join(t.withColumn("ok", F.lit(1)), ["s1_id", "cand_id"], "left").withColumn("ok", F.coalesce("ok", F.lit(0)))
    rules = [(a, g) for a in (0, 1) for g in GRID]
    sums = []
    for a, g in rules:
        taken = (F.col("prob") >= g / 100) & (F.col("best") if a else F.lit(True))
        sums += [F.count_if(taken).alias(f"p{a}_{g}"), F.count_if(taken & (F.col("ok") == 1)).alias(f"k{a}_{g}")]
    per = entities.select("s1_id").distinct().join(n, "s1_id", "left").join(rows.groupBy("s1_id").agg(*sums), "s1_id", "left").na.fill(0)
    one = per.agg(*[F.avg(f05(F.col(f"p{a}_{g}"), F.col(f"k{a}_{g}"), F.col("n"))).alias(f"f{a}_{g}") for a, g in rules])
    cells = F.array(*[F.struct(F.lit(a).alias("assign"), F.lit(g / 100).alias("threshold"), F.col(f"f{a}_{g}").alias("f05")) for a, g in rules])
    return one.select(F.explode(cells).alias("x")).select("x.*")


def best_rule(grid: DataFrame) -> DataFrame:
    """The rule of highest f05; ties go to no assignment, then to the lower threshold."""
    return grid.orderBy(F.desc("f05"), "assign", "threshold").limit(1)


def ceiling(entities: DataFrame, truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """macro_f05 of a perfect matcher on the candidates."""
    return macro_f05(entities, truth, candidates.join(truth, ["s1_id", "cand_id"], "left_semi"))


def decide(scored: DataFrame, assign: bool, threshold: float) -> DataFrame:
    rows = assign_best(scored).filter("best") if assign else scored
    return rows.filter(F.col("prob") >= threshold)


def id_lists(rows: DataFrame, by: str) -> DataFrame:
    """(s1_id, ids): candidate ids joined by commas, best ``by`` first, ties by id."""
    return rows.groupBy("s1_id").agg(F.expr(f"listagg(cand_id, ',') WITHIN GROUP (ORDER BY {by} DESC, cand_id)").alias("ids"))


def result_table(entities: DataFrame, lists: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """One row for every entity, '' if it has no ids."""
    rows = entities.select("s1_id").join(lists, "s1_id", "left")
    return rows.select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias(column))
