"""Small consistent samples of a data set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tsv import truth_pairs
from .folds import picked


def sample_train(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, fraction: float) -> dict[str, DataFrame]:
    """A share of references, all their true matches and a share of the other records; truth of the kept references."""
    keep = s1.filter(picked(F.col("entity_id"), fraction, "s1:"))
    gt = truth.join(keep.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    linked = truth_pairs(gt).select(F.col("cand_id").alias("entity_id")).distinct().withColumn("_l", F.lit(True))

    def some(rows: DataFrame, salt: str) -> DataFrame:
        return rows.join(linked, "entity_id", "left").filter(F.col("_l").isNotNull() | picked(F.col("entity_id"), fraction, salt)).select(*rows.columns)

    return {"s1": keep, "s2": some(s2, "s2"), "s3": some(s3, "s3"), "truth": gt}


def sample_test(sources: dict[str, DataFrame], fraction: float) -> dict[str, DataFrame]:
    """A share of each source ts1, ts2, ts3, independently."""
    return {k: rows.filter(picked(F.col("entity_id"), fraction, k)) for k, rows in sources.items()}
