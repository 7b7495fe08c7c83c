"""What the operators of this subpackage share: reading, staging, hashing, words."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Multiplier of the positional hash (odd, so it has an inverse modulo 2**64) and that inverse.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(int(BASE), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Words whose hashes a task remembers; beyond it the memory is emptied, results stay the same.
WORD_CACHE = 400_000
#: Spark's setting that removes a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or an own one where that is unset and all runs
    on one machine (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not at:
        at = "file://" + tempfile.mkdtemp(prefix="terracat-")
        spark.conf.set("spark.checkpoint.dir", at)
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here and lost executors cost nothing.

    The shuffle files behind the table are given back as soon as it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns only: the id as long and the text as UTF-8 bytes (null: empty)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("body"))


def doc_chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list]]:
    """Ids and texts (or bytes) of the rows of a task, in chunks of at most so many characters; a longer text is a chunk of its own."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            if size and size + len(text) > most:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc.as_py())
            texts.append(text)
            size += len(text)
    if ids:
        yield ids, texts


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word bytes -> 64-bit hash, computed once per distinct word of a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


class Ranges:
    """Hashes of any range of a sequence of 64-bit values, from one running sum.

    The hash of [i, j) is sum(v[k] * BASE**(k - i)), mixed; equal sequences hash equally wherever they stand.
    """

    _pow = np.ones(1, dtype=np.uint64)
    _inv = np.ones(1, dtype=np.uint64)

    @classmethod
    def _powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._pow) < n:
            size = max(n, 2 * len(cls._pow), 1 << 14)
            step = lambda b: np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, b, dtype=np.uint64))))
            cls._pow, cls._inv = step(BASE), step(BASE_INV)
        return cls._pow, cls._inv

    def __init__(self, values: np.ndarray):
        power, self.inverse = self._powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start])

    def every(self, length: int) -> np.ndarray:
        """The hash of each window of so many values."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) over each window of the width, by doubling."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        out = best(out[: len(out) - step], out[step:])
        span += step
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class WideIds(Exception):
    """Repeated ids leave no room for numbers below them."""


def any_ids(*columns: str) -> Callable:
    """For operators on (doc_id, text) that call with_uid first: where ids are too wide for it, they are numbered in
    order, and the columns of the result that hold ids are named back."""

    def wrap(op: Callable) -> Callable:
        @functools.wraps(op)
        def run(docs: DataFrame, *args, **named) -> DataFrame:
            try:
                return op(docs, *args, **named)
            except WideIds:
                rows = docs.select(F.col("doc_id").cast("long").alias("real_id"), "text")
            ids = rows.select("real_id").where("real_id is not null").distinct().orderBy("real_id")
            numbers = staged(ids.select("real_id", F.monotonically_increasing_id().alias("doc_id")), "ids")
            out = op(rows.join(numbers, "real_id", "left").select("doc_id", "text"), *args, **named)
            order = out.columns
            for c in columns:
                back = numbers.select(F.col("doc_id").alias(c), "real_id")
                out = out.join(back, c, "left").withColumn(c, F.col("real_id")).drop("real_id")
            return out.select(order)

        return run

    return wrap


def with_uid(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """doc_id, uid, text, body: rows with a key of their own, and the bits by which uid >> bits is doc_id.

    Where ids are unique uid is the id and bits is 0. Rows that share an id are numbered by text below it; WideIds is
    raised if ids are too large for that. Rows with a null id are left out.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = rows.groupBy("doc_id").count().agg(F.max("count").alias("most"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    bits = ((seen["most"] or 1) - 1).bit_length()
    if bits and max(-seen["low"], seen["high"] + 1) > 1 << (63 - bits):
        raise WideIds
    if bits:
        number = F.row_number().over(Window.partitionBy("doc_id").orderBy("text")) - 1
        rows = staged(rows.withColumn("uid", F.shiftleft("doc_id", bits) + number), "numbered")
    else:
        rows = rows.withColumn("uid", F.col("doc_id"))
    return rows.withColumn("body", F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))), bits
