"""Candidates for records as they arrive: files of new queries scored against a frozen target side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.blocking import block
from ..operators.normalise import clean
from ..schemas import RECORD
from ..settings import DEFAULT, Settings
from ..sources.tsv import blanked


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of TSV records from files that appear in ``folder``."""
    return blanked(spark.readStream.schema(RECORD).option("sep", "\t").option("header", True).option("quote", "").csv(folder))


def block_arrivals(stream: DataFrame, targets: DataFrame, out: str, checkpoint: str, settings: Settings = DEFAULT, words: DataFrame | None = None) -> StreamingQuery:
    """Writes the candidates of each batch of new records to ``out``/batch=N; a batch that runs again replaces its own."""

    def each(batch: DataFrame, n: int) -> None:
        block(clean(batch, words), targets, settings).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
