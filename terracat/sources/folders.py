"""Folders: inventories of files, and tables written as partitioned files in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir; an own folder where that is unset and all runs on one machine (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not at:
        at = "file://" + tempfile.mkdtemp(prefix="catalog-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scan_inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, length, modificationTime of every file below root; contents are never read. Empty files do not appear."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")


def tile_blocks(points: DataFrame, most: int) -> int:
    """Tiles on a side of the square blocks that points (tile_col, tile_row) are stored by: 1 if there are at most so many tiles,
    else as few as leave at most so many blocks over all columns and rows."""
    at = ("tile_col", "tile_row")
    wide = [F.coalesce((F.max(c) - F.min(c) + 1).cast("long"), F.lit(1)).alias(c) for c in at]  # a null tile has a folder of its own
    seen = points.agg(F.approx_count_distinct(F.struct(*at), 0.02).alias("n"), *wide).first()
    side = 1
    if seen["n"] > most:
        while -(-seen["tile_col"] // side) * -(-seen["tile_row"] // side) > most:
            side *= 2
    return side


def tile_partitions(points: DataFrame, most: int = 512) -> DataFrame:
    """Points (with tile_col, tile_row) in the order of their tiles, in one folder for each tile, read back.

    From about so many tiles on a folder holds a square block of tiles, so that folders and files don't grow with the tiles;
    its rows stand tile by tile, and a filter on a tile opens the row groups that hold it alone. Rows are dealt by
    ranges: a tile of many points has several files, so none is bound to one task.
    """
    path, side = shared_path(points.sparkSession, "tiles"), tile_blocks(points, most)
    block = {f"block_{c}": F.floor(F.col(f"tile_{c}") / side) for c in ("col", "row")}
    order = [*block, "tile_col", "tile_row"]
    dealt = points.withColumns(block).repartitionByRange(*order, F.xxhash64(*points.columns)).sortWithinPartitions(*order)
    dealt.write.partitionBy(*block).parquet(path)
    return points.sparkSession.read.schema(points.schema).parquet(path).select(*points.columns)


def catalog_json(items: DataFrame, fields: str) -> DataFrame:
    """Items as JSON lines in one folder for each collection, read back."""
    path = shared_path(items.sparkSession, "catalog")
    items.write.partitionBy("collection").json(path)
    return items.sparkSession.read.schema(f"{fields}, collection string").json(path)


def tree_json(documents: DataFrame, links: DataFrame, path: str) -> None:
    """Write a catalog's documents and links (links.catalog_tree) as JSON lines, in one folder for each kind of document and of link."""
    documents.write.mode("overwrite").partitionBy("kind").json(f"{path}/documents")
    links.write.mode("overwrite").partitionBy("rel").json(f"{path}/links")


def read_tree(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """documents (path, id, title, kind) and links (source, href, rel) of a written catalog."""
    documents = spark.read.schema("path string, id string, title string, kind string").json(f"{path}/documents")
    return documents, spark.read.schema("source string, href string, rel string").json(f"{path}/links")
