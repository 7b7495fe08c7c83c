"""Items kept by collection, with a table of the collections' extents beside them, and searches that open only what can hold hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terracat.operators.snapshot import collection_extent, search_spatiotemporal


def store_items(items: DataFrame, folder: str) -> None:
    """Write items (collection, item, x0, y0, x1, y1, start, points, ...) in a folder for each collection, by start within its
    files, and the extents of the collections. Items of a null collection are kept apart by Spark and found by no search."""
    placed = items.repartition("collection").sortWithinPartitions("collection", "start")
    placed.write.mode("overwrite").partitionBy("collection").parquet(f"{folder}/items")
    collection_extent(stored_items(items.sparkSession, folder, items.schema)).coalesce(1).write.mode("overwrite").parquet(f"{folder}/extents")


def stored_items(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/items")


def search_stored(spark: SparkSession, folder: str, schema, box: tuple[float, float, float, float], since: str, until: str, least: float, rings=None) -> DataFrame:
    """search_spatiotemporal over stored items: item, collection, by item.

    The extents are a small file that comes to all tasks by its size; what is left of it prunes the folders of items
    while the query runs, so files of collections that miss the box or the dates are not opened. rings: a column of
    polygons by which items are tested after their boxes.
    """
    items = stored_items(spark, folder, schema)
    if rings is not None:
        items = items.withColumn("rings_", rings)
    return search_spatiotemporal(items, spark.read.parquet(f"{folder}/extents"), box, since, until, least, "rings_" if rings is not None else None)
