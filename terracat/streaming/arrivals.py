"""Structured Streaming over files that arrive: each run takes what is new since the last and ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.sources.folders import shared_path
from terracat.streaming.state import KeyedTable


def arriving(spark: SparkSession, path: str) -> DataFrame:
    only = f"{path[:-1]}[{path[-1]}]"  # a glob of this one name: the source takes a plain path for a folder
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(only)


def incremental(spark: SparkSession, path: str, step: Callable[[DataFrame], DataFrame], checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Run step over files that arrived since the last run with this checkpoint; the table at out gets their rows once."""
    checkpoint, out = checkpoint or shared_path(spark, "progress"), out or shared_path(spark, "arrivals")
    rows = step(arriving(spark, path))
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


class RunningSummary:
    """Counts and ranges of a value by key, kept current: a batch merges the keys that it changed into the table and no others."""

    def __init__(self, spark: SparkSession, path: str, key: str, value: str, folder: str | None = None):
        self.spark, self.path, self.folder = spark, path, folder or shared_path(spark, "summary")
        self.rows = arriving(spark, path).groupBy(key).agg(F.count("*").alias("n"), F.min(value).alias("vmin"), F.max(value).alias("vmax")).where(F.col(key).isNotNull())
        self.table = KeyedTable(spark, f"{self.folder}/keys", ", ".join(f"`{c}` {t}" for c, t in self.rows.dtypes), [key])

    def run(self) -> DataFrame:
        """Take what has arrived since the last run and end; the summary as it is then. Rows of a null key count nowhere."""
        stream = self.rows.writeStream.outputMode("update").foreachBatch(self.table.merge).option("checkpointLocation", f"{self.folder}/progress")
        stream.trigger(availableNow=True).start().awaitTermination()
        return self.table.read()
