"""The folder that driver and executors share: where it is, tables written to it, files opened in it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset a local one is set, if all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="linkspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stashed_at = path
    return out


def delete(df: DataFrame) -> None:
    """Removes the folder of a table that stash() gave and that is no longer read; any other table is left as it is."""
    folder = vars(df).get("stashed_at")
    if folder:
        remove(df.sparkSession, folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; file:/x, as Hadoop writes it, and plain paths are local."""
    if re.match(r"file:/+", uri):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/+", "", uri)
    if "://" in uri:
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
    return fs.LocalFileSystem(), uri
