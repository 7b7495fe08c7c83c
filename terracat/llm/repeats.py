"""Repeated word passages across documents: the ladder of windows of op8, and what op10 uses of it.

A window is `window` consecutive units (word hashes). A run of a shorter length is a seed of the windows of which it
is the least by hash (a minimizer), so copies of a window hold the same seed, and a window can only be repeated while
its seed of each length is. Lengths double from rung to rung, and only windows whose seed was repeated are looked at
on the next one. The context of a seed is what the windows around it can touch. Documents that share a whole context
need no look at single windows: all but the first are covered there. Only where a seed has several contexts are
windows compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import Ranges, discard, mix, signed, sliding, staged

PLACES = "seed long, uid long"
PLACE_FIELDS = pa.schema([("seed", pa.int64()), ("uid", pa.int64())])
SEEDS = "seed long, ctx long, uid long, lo int, hi int"
SEED_FIELDS = pa.schema([("seed", pa.int64()), ("ctx", pa.int64()), ("uid", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
#: A key of more than this share of all rows is hot, unless it has fewer than LEAST_HOT rows.
HOT_SHARE, LEAST_HOT = 2_000, 5_000


def ladder(window: int, least: int = 13) -> list[int]:
    """Lengths of the rungs below the window, each half the next, the shortest first."""
    out = [(window + 1) // 2]
    while out[0] > 2 * least - 2:
        out.insert(0, (out[0] + 1) // 2)
    return out


def least_of_windows(every: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The least seed hash of each window."""
    return sliding(every, window - seed + 1, np.minimum)


def seed_places(ranges: Ranges, n: int, window: int, seed: int, known: tuple[int, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places whose seed is the least of some window, and the hash of each place's seed.

    known: length and hashes of the shorter seeds that are repeated; windows of another least seed are not looked at.
    """
    if n < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    every = ranges.every(seed)
    least = least_of_windows(every, window, seed)
    if known is not None:
        length, hashes = known
        least = np.where(np.isin(least_of_windows(ranges.every(length), window, length), hashes), least, np.uint64(0))
    edge = np.zeros(window - seed, dtype=np.uint64)
    chosen = sliding(np.concatenate((edge, least, edge)), window - seed + 1, np.maximum) == every  # the greatest least of a place's windows
    return np.flatnonzero(chosen), every


def contexts(ranges: Ranges, n: int, places: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of the context of each place: all that windows holding the seed can touch."""
    lo, hi = np.maximum(places + seed - window, 0), np.minimum(places + window, n)
    key = ranges.of(lo, hi) ^ mix((places - lo).astype(np.uint64) * np.uint64(1 << 20) + (hi - places).astype(np.uint64))
    return key, lo, hi


def seed_rows(uid: int, ranges: Ranges, n: int, places: np.ndarray, every: np.ndarray, window: int, seed: int) -> list[np.ndarray]:
    ctx, lo, hi = contexts(ranges, n, places, window, seed)
    return [signed(every[places]), signed(ctx), np.full(len(places), uid, dtype=np.int64), lo.astype(np.int32), hi.astype(np.int32)]


def batch_of(rows: list[list[np.ndarray]], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)


def place_rows(uid: int, places: np.ndarray, every: np.ndarray) -> list[np.ndarray]:
    """Each seed of a document once."""
    seeds = np.unique(every[places])
    return [signed(seeds), np.full(len(seeds), uid, dtype=np.int64)]


def join_uneven(rows: DataFrame, keyed: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of rows with keyed (staged; one row for each key, with n_rows, the rows of that key).

    Keys of more than a HOT_SHARE-th of all rows are fewer than HOT_SHARE, so they can be broadcast and their rows stay
    where they are; all others are shuffled.
    """
    total = keyed.agg(F.sum("n_rows")).first()[0] or 0
    hot = F.col("n_rows") > max(LEAST_HOT, total // HOT_SHARE)
    some = keyed.where(hot)
    if some.isEmpty():
        return rows.join(keyed, on)
    few = rows.join(F.broadcast(some), on)
    return rows.join(F.broadcast(some.select(on)), on, "left_anti").join(keyed.where(~hot), on).unionByName(few)


def repeated_seeds(seeds: DataFrame, bits: int, label: str) -> DataFrame:
    """Seed rows whose seed stands in two documents at least, as a staged table."""
    doc = F.shiftright("uid", bits)
    counted = seeds.groupBy("seed").agg(F.min(doc).alias("least"), F.max(doc).alias("most"), F.count("*").alias("n_rows"))
    twice = staged(counted.where("least < most").select("seed", "n_rows"), "twice")
    found = staged(join_uneven(seeds, twice, ["seed"]).select(seeds.columns), label)
    discard(twice)
    return found


def split_contexts(seeds: DataFrame, bits: int) -> DataFrame:
    """(seed, uid, lo, hi, covered) as a staged table: contexts covered as a whole by a smaller document's equal one,
    and those of first documents whose seed has other contexts."""
    doc = F.shiftright("uid", bits)
    first = staged(seeds.groupBy("seed", "ctx").agg(F.min(doc).alias("first"), F.max(doc).alias("last"), F.count("*").alias("n_rows")), "firsts")
    several = staged(first.groupBy("seed").agg(F.count("*").alias("n_rows")), "several")
    # A context that one document alone has, and whose seed has no other, says nothing.
    counted = join_uneven(first.withColumnRenamed("n_rows", "n_equal"), several, ["seed"]).withColumnRenamed("n_rows", "n_ctx").withColumnRenamed("n_equal", "n_rows")
    telling = staged(counted.where("first < last or n_ctx > 1").select("seed", "ctx", "first", "n_ctx", "n_rows"), "telling")
    joined = join_uneven(seeds, telling, ["seed", "ctx"]).withColumn("covered", doc > F.col("first"))
    marked = staged(joined.where("covered or n_ctx > 1").select("seed", "uid", "lo", "hi", "covered"), "marked")
    discard(first, several, telling)
    return marked


def repeated_windows(windows: DataFrame, bits: int, window: int) -> DataFrame:
    """windows (w long, uid long, p int) -> (uid, lo, hi) of those that also start in a smaller document, staged."""
    doc = F.shiftright("uid", bits)
    counted = windows.groupBy("w").agg(F.min(doc).alias("first"), F.max(doc).alias("last"), F.count("*").alias("n_rows"))
    first = staged(counted.where("first < last").select("w", "first", "n_rows"), "firsts")
    found = join_uneven(windows, first, ["w"]).where(doc > F.col("first"))
    spans = staged(found.select("uid", F.col("p").cast("int").alias("lo"), (F.col("p") + window).cast("int").alias("hi")), "repeats")
    discard(first)
    return spans


def windows_of_places(uid: int, ranges: Ranges, lo: np.ndarray, hi: np.ndarray, window: int) -> list[np.ndarray]:
    """The windows within the contexts [lo, hi) of a document, each once."""
    edge = np.zeros(int(hi.max()) + 2, dtype=np.int32)
    ok = hi - lo >= window
    np.add.at(edge, lo[ok], 1)
    np.add.at(edge, hi[ok] - window + 1, -1)
    p = np.flatnonzero(np.cumsum(edge) > 0)
    return [signed(ranges.of(p, p + window)), np.full(len(p), uid, dtype=np.int64), p.astype(np.int32)]


def removal(docs: DataFrame, spans: DataFrame, rewrite: Callable, schema: str, fields: pa.Schema) -> DataFrame:
    """Each document once, with its spans merged, through rewrite(body, mask of removed units or None).

    rewrite gets the body and the (lo, hi) pairs and returns the columns after uid.
    """
    by_doc = spans.groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))  # bounded by the document's length
    joined = docs.select("uid", "body").join(by_doc, "uid", "left").select("uid", "body", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for k in range(part.num_rows):
                    lo, hi = (part.column(c)[k].values for c in (2, 3))
                    rows.append((part.column(0)[k].as_py(), *rewrite(part.column(1)[k].as_py(), None if lo is None else lo.to_numpy(), None if hi is None else hi.to_numpy())))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

    return joined.mapInArrow(run, schema)


def mask_of(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi, -1)
    return np.cumsum(edge)[:n] > 0


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()
