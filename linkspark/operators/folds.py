"""Deterministic folds and samples by CRC-32 of an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..settings import DEFAULT, Settings


def crc(text: Column, salt: str = "") -> Column:
    return F.crc32(F.encode(F.concat(F.lit(salt), text), "UTF-8"))


def is_val(entity: Column, share: int = DEFAULT.val_share) -> Column:
    """Validation fold: one entity in ``share``."""
    return crc(entity) % share == 0


def is_fit(entity: Column, share: int = DEFAULT.fit_share) -> Column:
    return crc(entity, "fit:") % share == 0


def is_stop(entity: Column, share: int = DEFAULT.stop_share) -> Column:
    return crc(entity, "stop:") % share == 0


def picked(entity: Column, fraction: float, salt: str) -> Column:
    """Whether a hash threshold keeps an id, at a resolution of a millionth."""
    return crc(entity, salt) % 1_000_000 < int(fraction * 1_000_000)


def query_filter(queries: DataFrame, mode: str, settings: Settings = DEFAULT) -> DataFrame:
    """Queries of a mode: all, val (validation) or fit (validation or fit sample)."""
    if mode == "all":
        return queries
    keep = is_val(F.col("entity_id"), settings.val_share)
    return queries.filter(keep if mode == "val" else keep | is_fit(F.col("entity_id"), settings.fit_share))


def numbered(rows: DataFrame, keys: list[str], bucket: Column, order: list) -> DataFrame:
    """``rows`` with ``rn``, their places from 1 in each group of ``keys`` in the order of ``order``.

    ``bucket`` is a number that never falls along that order. Rows are numbered within
    their buckets and raised by the sizes of the buckets before, so a group of any size is
    spread over as many tasks as it has buckets.
    """
    rows = rows.withColumn("_bucket", bucket)
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    within = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    placed = rows.withColumn("_at", within).join(sizes.select(*keys, "_bucket", F.coalesce(before, F.lit(0)).alias("_before")), [*keys, "_bucket"])
    return placed.withColumn("rn", F.col("_at") + F.col("_before")).drop("_bucket", "_at", "_before")


def capped(rows: DataFrame, n: int, *keys: str, seed: int = 0) -> DataFrame:
    """At most ``n`` rows, the first in an order fixed by a hash of ``keys``: a seeded shuffle and a head, or a random sample of n.

    The hash up to which rows are taken is found by two histograms of 65,536 bins, the
    second within a bin of the first; only rows that share that very hash are sorted.
    """
    hashed = rows.withColumn("_h", crc(F.concat_ws(":", *keys), f"{seed}:"))
    prefix, left = 0, n
    for shift in (16, 0):
        bins = hashed.filter(F.shiftright("_h", shift + 16) == prefix) if shift == 0 else hashed
        counts = bins.groupBy(F.shiftright("_h", shift).alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect()
        for b in counts:
            if b.n > left:
                prefix = b.b
                break
            left -= b.n
        else:
            # all rows of the bin fit, or all there are
            if shift:
                return rows
            prefix = (prefix + 1) << 16
            return hashed.filter(F.col("_h") < prefix).drop("_h")
    edge = hashed.filter(F.col("_h") == prefix).orderBy(*keys).limit(left)
    return hashed.filter(F.col("_h") < prefix).unionByName(edge).drop("_h")
