"""The catalog as files arrive: classify, gate against what is known, keep what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import upkeep as U
from terracat.operators.registry import products_by_settings
from terracat.sources.folders import shared_path
from terracat.streaming.arrivals import arriving
from terracat.streaming.state import KeyedTable

#: What is kept of each file. created and updated are numbers of batches.
ENTRY = "campaign string, parent string, name string, label string, category string, item string, length long, checksum string, digest string, created long, updated long"
FAILED = "campaign string, parent string, name string, error string"


class IncrementalCatalog:
    """A catalog that files (campaign, parent, name, length, checksum, seen) update in batches of what has arrived since the last run.

    Of a file that arrived several times in a batch the latest `seen` counts (ties: the largest checksum). Files are
    classified by their campaign's settings or the default registry; those without a length or checksum fail alone, and
    what was known of them stays. gate_status decides what is built again; the rest of the table is not written.
    digests (campaign, digest) says which settings campaigns have now: another digest than the one kept builds a file again.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, settings: DataFrame | None = None, digests: DataFrame | None = None):
        self.spark, self.folder = spark, folder or shared_path(spark, "catalog_state")
        self.settings, self.digests = settings, digests
        self.entries = KeyedTable(spark, f"{self.folder}/entries", ENTRY, ["parent", "name"])
        self.failures = KeyedTable(spark, f"{self.folder}/failures", FAILED, ["parent", "name"])

    def step(self, arrived: DataFrame, number: int) -> None:
        """One batch. Run again with the same number it has the same outcome."""
        latest = arrived.groupBy("parent", "name").agg(F.max(F.struct("seen", "checksum", "length", "campaign")).alias("f")).select("parent", "name", "f.campaign", "f.length", "f.checksum")
        error = F.when(F.col("length").isNull() | F.col("checksum").isNull(), "unreadable")
        good, bad, _ = U.failure_isolation(latest.withColumn("error", error))
        made = products_by_settings(good, self.settings) if self.settings is not None else C.products(good, self.spark).join(good.select("parent", "name", "campaign"), ["parent", "name"])
        sums = good.select("parent", "name", "checksum")
        now = made.join(sums, ["parent", "name"])
        now = now.join(self.digests, "campaign", "left") if self.digests is not None else now.withColumn("digest", F.lit(None).cast("string"))
        path = F.concat_ws("/", "parent", "name")
        before = self.entries.read(before=number).withColumn("path", path)
        now = now.withColumn("path", path)
        known = before.join(now.select("path"), "path", "left_semi")  # a batch says nothing of files that did not arrive
        gates = U.gate_status(now, known)
        stamps = known.select("path", F.col("created").alias("was_created"))
        changed = now.join(gates.where("gate = 'rebuild'"), "path").join(stamps, "path", "left")
        self.entries.merge(changed.withColumns({"created": F.coalesce("was_created", F.lit(number)).cast("long"), "updated": F.lit(number).cast("long")}), number)
        self.failures.merge(bad, number, gone=good.join(self.failures.read(before=number).select("parent", "name"), ["parent", "name"], "left_semi"))

    def run(self, path: str, checkpoint: str | None = None) -> DataFrame:
        """Take what has arrived at path since the last run and end; the catalog as it is then."""
        stream = arriving(self.spark, path).writeStream.foreachBatch(self.step).option("checkpointLocation", checkpoint or f"{self.folder}/progress")
        stream.trigger(availableNow=True).start().awaitTermination()
        return self.entries.read()
