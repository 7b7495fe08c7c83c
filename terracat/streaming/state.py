"""A table kept by a stream: each batch adds its changed rows, a reader takes the latest row of each key."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GONE, BATCH = "gone_", "batch_"


class KeyedTable:
    """Rows by key in a folder that all machines share: one folder for each batch, holding the rows that it changed.

    A batch that is run again replaces its own folder, so its rows count once however often it fails; what it compared
    itself with is read `before` it. fold() gathers the batches so far in one folder, for readers to start from.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str]):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.fields = spark.createDataFrame([], schema).schema

    def _listed(self) -> dict[str, list[int]]:
        """Numbers of the complete folders, by kind."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        at = hadoop.Path(self.path)
        store = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = {"batch": [], "upto": []}
        for f in store.listStatus(at) if store.exists(at) else []:
            m = re.fullmatch(r"(batch|upto)-(\d+)", f.getPath().getName())
            if m and store.exists(hadoop.Path(f.getPath(), "_SUCCESS")):
                found[m[1]].append(int(m[2]))
        return found

    def merge(self, rows: DataFrame, number: int, gone: DataFrame | None = None) -> None:
        """Put rows (one for each key) in the place of those of their keys; the keys of gone have none from now on."""
        out = rows.select(*self.fields.names).withColumn(GONE, F.lit(False))
        if gone is not None:
            none = [F.col(c) if c in self.key else F.lit(None).cast(self.fields[c].dataType).alias(c) for c in self.fields.names]
            out = out.unionByName(gone.select(*none, F.lit(True).alias(GONE)))
        out.write.mode("overwrite").parquet(f"{self.path}/batch-{number}")

    def changes(self, number: int) -> DataFrame:
        """What one batch wrote."""
        return self.spark.read.parquet(f"{self.path}/batch-{number}")

    def _latest(self, before: int | None) -> DataFrame:
        listed = self._listed()
        old = [n for n in listed["upto"] if before is None or n < before]
        base = max(old, default=-1)
        late = sorted(n for n in listed["batch"] if n > base and (before is None or n < before))
        paths = [f"{self.path}/upto-{base}"] * (base >= 0) + [f"{self.path}/batch-{n}" for n in late]
        if not paths:
            return self.spark.createDataFrame([], self.fields).withColumn(GONE, F.lit(False))
        number = F.regexp_extract("_metadata.file_path", r"/(?:batch|upto)-(\d+)/", 1).cast("long")
        every = self.spark.read.parquet(*paths).select("*", number.alias(BATCH))
        if len(paths) == 1:
            return every.drop(BATCH)
        rest = [c for c in every.columns if c not in (*self.key, BATCH)]
        return every.groupBy(*self.key).agg(F.max_by(F.struct(*rest), BATCH).alias("r")).select(*self.key, *[F.col(f"r.{c}").alias(c) for c in rest])

    def read(self, before: int | None = None) -> DataFrame:
        """The latest row of each key, as of all batches or those before one."""
        return self._latest(before).where(~F.col(GONE)).select(*self.fields.names)

    def fold(self) -> None:
        """Gather all batches in one folder. Batches stay, for runs that are repeated."""
        last = max(self._listed()["batch"], default=None)
        if last is not None:
            self._latest(None).where(~F.col(GONE)).write.mode("overwrite").parquet(f"{self.path}/upto-{last}")
