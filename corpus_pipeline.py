"""A corpus pipeline of five stages: quality rules, near-duplicates, byte-level dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.llm.common import fresh_path, staged, table
from terracat.llm.decontaminate import find_contamination
from terracat.llm.near_dup import near_duplicates
from terracat.llm.packing import pack_documents
from terracat.llm.quality import judge_quality
from terracat.llm.queries import BYTE_BPE
from terracat.llm.suffix_dedup import dedup_bytes


#: Key of a row within a stage.
ROW = "stage_row"


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with a key of its own for each row, and (doc_id, text) under that key as the operators take them.

    Keys follow doc_id; where ids are null or shared, rows of one id follow a hash of all they hold and null ids come
    last. So each row is a document, and exact repeats of a row are told apart.
    """
    name = F.col("doc_id").cast("long")
    if docs.groupBy(name.alias("doc_id")).count().where("doc_id is null or count > 1").isEmpty():
        rows = docs.withColumn(ROW, name)
    else:
        content = F.xxhash64(F.to_json(F.struct(*docs.columns)))
        # The place as last key lets exact repeats be dealt over several tasks.
        told = docs.select("*", content.alias("stage_hash"), F.monotonically_increasing_id().alias("stage_place"))
        ordered = told.orderBy(name.asc_nulls_last(), "stage_hash", "stage_place").drop("stage_hash", "stage_place")
        rows = staged(ordered.withColumn(ROW, F.monotonically_increasing_id()), "keyed")
    return rows, rows.select(F.col(ROW).alias("doc_id"), "text")


def _retain(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows whose key is in kept (doc_id holds the key, once each)."""
    return rows.join(kept.select(F.col("doc_id").alias(ROW)), ROW, "left_semi").drop(ROW)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior keeps. Each row is judged by itself, whether its id is null, shared or its own."""
    rows, given = _keyed(docs)
    return _retain(rows, judge_quality(given).where("kept").select("doc_id")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies (five-word shingles, similarity of 0.8 or more).

    Rows that share an id are compared like others and one of them stays; a null id is larger than any other.
    """
    rows, given = _keyed(docs)
    return _retain(rows, near_duplicates(given, shingle=5, percent=80).where("kept").select("doc_id")).select(docs.columns)


def byte_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte passages that an earlier document has. A cut through a character drops its rest; a document left without text goes.

    Documents are in the order of their ids, null ids last; of rows that share an id one is the earlier. Each row gets
    its own new text.
    """
    rows, given = _keyed(docs)
    found = dedup_bytes(given, window=50).where("n_removed > 0")
    changed = found.select(F.col("doc_id").alias(ROW), F.col("kept_text").alias("stage_text"), (F.col("n_removed") == F.col("n_bytes")).alias("stage_gone"))
    joined = rows.join(changed, ROW, "left").where(~F.coalesce("stage_gone", F.lit(False)))
    text = F.coalesce("stage_text", "text")
    return joined.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands. Each row is looked at by itself, null and shared ids included."""
    rows, given = _keyed(docs)
    return _retain(rows, find_contamination(given, table(spark, sf_dir, "benchmark"), window=10).where("not contaminated").select("doc_id")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048, those of null and shared ids too."""
    return pack_documents(docs, BYTE_BPE, "kept", 0, 2048)


STAGES = [("quality rules", quality), ("near-duplicates", near_dedup), ("suffix-array dedup", byte_dedup), ("decontamination", decontaminate), ("packing", pack)]
#: Posterior weights, tokenizers and packing are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = fresh_path(spark, f"stage{k}")
        out.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
