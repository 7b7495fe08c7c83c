"""Runs of words that repeat with a period, by minimizers of several scales.

A run is a stretch of consecutive words with smallest period q, at least max(LEAST, TIMES * q) words long, that no
neighbouring word extends. Periods below SHORT are found by direct scans: words are compared with those q places on.
Longer ones belong to the scale w with w <= q < 2w. Within a run, equal windows of w words lie q apart, so the places of
their minima do too, and from such a place at most w words into the run, 2w equal words follow both there and q words
on. As 2w > q, no place between the two is followed by the same words: of the places of minima with equal words after
them, neighbours exactly q apart are the seeds. Each seed is extended to both sides by bisection over hashes of ranges,
and what comes out is compared word for word. Of stretches found with several periods the smallest period stays.

Documents are strung together with marks that equal nothing, so the scans of many short texts are one array operation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import Ranges, doc_chunks, id_text, mix, sliding

SHORT, LEAST, TIMES = 8, 6, 4
#: Bytes of text that are scanned in one go; a longer text is one go of its own.
GO = 1 << 21
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Numbers(dict):
    """word -> a number of its own, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the stretches of True, and the places after them."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def lag_scan(x: np.ndarray, q: int) -> np.ndarray:
    """(start, end, q) of each stretch of period q that is long enough."""
    start, stop = stretches(x[q:] == x[:-q]) if len(x) > q else (np.zeros(0, dtype=np.int64),) * 2
    stop = stop + q
    long = stop - start >= max(LEAST, TIMES * q)
    return np.stack((start[long], stop[long], np.full(long.sum(), q)), axis=1)


def minima(order: np.ndarray, width: int) -> np.ndarray:
    """Places of the least value of each window (of equal ones the leftmost), each once."""
    bits = np.uint64(len(order).bit_length())
    key = order >> bits << bits | np.arange(len(order), dtype=np.uint64)
    return np.unique((sliding(key, width, np.minimum) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))


def reach(equal: Callable[[np.ndarray], np.ndarray], most: np.ndarray) -> np.ndarray:
    """The largest r in 0..most for which equal(r) holds, elementwise; it holds for all smaller ones."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        half = (low + high + 1) >> 1
        yes = equal(half)
        low, high = np.where(yes, half, low), np.where(yes, high, half - 1)
    return low


def scale_scan(x: np.ndarray, order: np.ndarray, w: int) -> np.ndarray:
    """(start, end, q) of each stretch of a period in w..2w-1 that is long enough."""
    none = np.zeros((0, 3), dtype=np.int64)
    if len(x) < TIMES * w:
        return none
    at = minima(order, w)
    at = at[at + 2 * w <= len(x)]
    ranges = Ranges(order)
    after = ranges.of(at, at + 2 * w)
    by = np.lexsort((at, after))
    at, after = at[by], after[by]
    lag = at[1:] - at[:-1]
    seed = (after[1:] == after[:-1]) & (lag >= w) & (lag < 2 * w)
    at, lag = at[:-1][seed], lag[seed]
    if not len(at):
        return none
    # Of the seeds of one stretch one is enough: those a period apart are linked, and the first of each chain stays.
    by = np.lexsort((at, lag))
    at, lag = at[by], lag[by]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (lag[1:] != lag[:-1]) | (at[1:] - at[:-1] > 2 * w)
    at, lag = at[first], lag[first]
    right = reach(lambda r: ranges.of(at, at + r) == ranges.of(at + lag, at + lag + r), len(x) - at - lag)
    left = reach(lambda r: ranges.of(at - r, at) == ranges.of(at + lag - r, at + lag), at)
    found = np.unique(np.stack((at - left, at + lag + right, lag), axis=1), axis=0)
    found = found[found[:, 1] - found[:, 0] >= TIMES * found[:, 2]]
    sure = [np.array_equal(x[s : e - q], x[s + q : e]) for s, e, q in found.tolist()]
    return found[np.array(sure, dtype=bool)] if len(found) else none


def runs_of(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs in x, by start, then period.

    x: numbers of words (0 or more), each text followed by one mark (a negative number of its own); sizes: words of each text.
    """
    found = [lag_scan(x, q) for q in range(1, SHORT)]
    order = mix(x.view(np.uint64) + np.uint64(1))
    place, w = np.arange(len(x)), SHORT
    while True:
        long = sizes >= TIMES * w
        if not long.any():
            break
        if not long.all():  # texts too short for this scale fall out
            stay = np.repeat(long, sizes + 1)
            x, order, place, sizes = x[stay], order[stay], place[stay], sizes[long]
        got = scale_scan(x, order, w)
        got[:, 0], got[:, 1] = place[got[:, 0]], place[got[:, 1] - 1] + 1
        found.append(got)
        w *= 2
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    least = np.ones(len(runs), dtype=bool)
    least[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[least]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n places lie in a run after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    return np.cumsum(edge)[:n] > 0


def scan(texts: list[list[bytes]]) -> tuple[list[list[dict]], list[list[bytes]]]:
    """Of each list of words its runs and the words that are no repeats."""
    numbers, sizes = Numbers(), np.array([len(t) for t in texts], dtype=np.int64)
    x = np.zeros(int(sizes.sum()) + len(texts), dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    for k, words in enumerate(texts):
        x[first[k] : first[k] + len(words)] = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        x[first[k] + len(words)] = -1 - k
    runs = runs_of(x, sizes)
    dropped = repeats(len(x), runs)
    edge = np.searchsorted(runs[:, 0], np.append(first, len(x)))
    spans, kept = [], []
    for k, words in enumerate(texts):
        own = runs[edge[k] : edge[k + 1]]
        spans.append([{"start": s - int(first[k]), "length": e - s, "period": q} for s, e, q in own.tolist()])
        gone = dropped[first[k] : first[k] + len(words)].tolist() if len(own) else ()
        kept.append([w for w, g in zip(words, gone, strict=True) if not g] if len(own) else words)
    return spans, kept


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words long, runs array<struct<start, length, period>> (longs, by start, then period) and
    collapsed_text, the words that no run repeats, joined by one space.

    Words are runs of bytes other than ASCII white space. rewrite(doc_id, words) may give the words to look at instead.
    Null and empty texts have no words, no runs and an empty collapsed text. Rows are judged one by one: null and
    repeated ids stay, extra columns are ignored, an empty table gives an empty result.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", RUNS), ("collapsed_text", pa.string())])

    def answer(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        spans, kept = scan(texts)
        out = [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, RUNS), pa.array([b" ".join(k).decode("utf-8", "replace") for k in kept], pa.string())]
        return pa.RecordBatch.from_arrays(out, schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, bodies in doc_chunks(batches, GO):
            words = [b.split() for b in bodies]
            yield answer(ids, [rewrite(d, w) for d, w in zip(ids, words, strict=True)] if rewrite else words)

    return id_text(docs).mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string")


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest run (null: none), and two digests, of periodic_runs' rows."""
    # Least by falling length, then start, then period.
    keyed = F.transform("runs", lambda r: F.struct((-r["length"]).alias("k"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    top = F.array_min(keyed)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of op13's contract: of documents whose id's crc32 ends in 0 the tail from word a on goes round with period p."""
    if doc_id is None or not words:
        return words
    from zlib import crc32

    h, n = crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * (-(-(n - a) // p)))[: n - a]
