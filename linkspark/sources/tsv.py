"""Scans and sinks: unquoted TSV, labelled pairs, partitioned Parquet, dictionaries as JSON."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DICTIONARY, RECORD, TRUTH


def fingerprint(rows: DataFrame) -> str:
    """A hash of a table's rows, whatever their order."""
    row = F.xxhash64(*rows.columns)
    got = rows.agg(F.count("*"), F.sum((row % 2147483647).cast("decimal(38,0)")), F.bit_xor(row)).first()
    return "-".join(str(x) for x in got)


def blanked(rows: DataFrame) -> DataFrame:
    """Missing strings as ''."""
    return rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes])


def read_tsv(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """Tab-separated text with a header and no quoting; an empty field is ''."""
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("encoding", "UTF-8")
    return blanked(reader.csv(path))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """The labelled table of a TSV file or, by its name, a Parquet one."""
    if path.rstrip("/").endswith(".parquet"):
        return blanked(spark.read.parquet(path).select(*[x.split()[0] for x in TRUTH.split(", ")]))
    return read_tsv(spark, path, TRUTH)


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1_id, cand_id) of each labelled match."""
    ids = F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")
    return truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(ids).alias("cand_id"))


def singletons(truth: DataFrame) -> DataFrame:
    """Reference entities without a match."""
    return truth.filter(F.size(F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")) == 0).select(F.col("source1_entity_id").alias("s1_id"))


def lines(rows: DataFrame) -> Column:
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])


def write_tsv(rows: DataFrame, path: str, order: list[str] | None = None, columns: list[str] | None = None) -> None:
    """Raw unquoted TSV, one file with a header, rows in ``order``; of ``columns``, or all.

    Rows are sorted by ranges and written as parts by all tasks; the parts, whose names are
    in that order, are then joined byte by byte to the file.
    """
    spark, shown = rows.sparkSession, columns or rows.columns
    parts = f"{path}.parts"
    body = rows.withColumn("_line", lines(rows.select(*shown)))
    (body.orderBy(*order) if order else body).select("_line").write.mode("overwrite").text(parts)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    names = sorted(f.getPath().toString() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-"))
    files.delete(target, True)
    out = files.create(target, True)
    try:
        out.write(bytearray(("\t".join(shown) + "\n").encode()))
        for name in names:
            part = files.open(jvm.org.apache.hadoop.fs.Path(name))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            finally:
                part.close()
    finally:
        out.close()
    files.delete(folder, True)


def read_tsv_in_order(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """read_tsv() with ``_place``, which grows along the file."""
    start = F.col("_metadata.file_block_start")
    rows = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("encoding", "UTF-8").csv(path)
    return blanked(rows.select("*", F.struct(start.alias("block"), F.monotonically_increasing_id().alias("row")).alias("_place")))


def read_stamp(spark: SparkSession, path: str) -> str | None:
    """The stamp of a stage's result, or None if there is no whole one."""
    try:
        return spark.read.text(f"{path}/_stamp").first()[0]
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def write_stamp(spark: SparkSession, path: str, stamp: str) -> None:
    spark.createDataFrame([(stamp,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_stamp")


def write_stage(rows: DataFrame, path: str, parts: tuple[str, ...] = (), stamp: str | None = None) -> DataFrame:
    """Parquet in zstd, partitioned by ``parts``; with a ``stamp`` (a fingerprint of the inputs) an equal earlier result is read instead."""
    spark = rows.sparkSession
    if stamp is None or read_stamp(spark, path) != stamp:
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*parts).parquet(f"{path}/data")
        if stamp is not None:
            write_stamp(spark, path, stamp)
    return read_stage(spark, path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage's result; columns that name its folders are strings, as they were written, and an empty one is ''."""
    names = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(names)
    spark.conf.set(names, "false")
    try:
        rows = spark.read.parquet(f"{path}/data")
        return blanked(rows) if "country" in rows.columns else rows
    finally:
        spark.conf.set(names, before)


def write_dictionary(words: DataFrame, path: str) -> None:
    """A line of JSON for each kind and country: {kind, country, map}."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("noisy", "canon"))))
    words.groupBy("kind", "country").agg(entries.alias("map")).orderBy("kind", "country").coalesce(1).write.mode("overwrite").json(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("kind string, country string, map map<string,string>").json(path)
    return rows.select("kind", "country", F.explode("map").alias("noisy", "canon")).select(*[x.split()[0] for x in DICTIONARY.split(", ")])


def write_decision(decision: dict, spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(json.dumps(decision, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_decision(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
