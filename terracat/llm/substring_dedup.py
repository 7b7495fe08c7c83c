"""Substring dedup by level-wise doubling, on words.

Rungs of growing length lead up to the window asked for (13, 25 and 50 words). A rung looks at runs of its length,
thinned to minimizers of the windows; those found in one document alone end there. On the next rung only windows whose
run was repeated are looked at, by runs of twice the length. It ends when no candidates survive, or with the windows
themselves: those that survive are removed from all documents but the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import Ranges, WordHashes, any_ids, discard, staged, with_uid
from terracat.llm.repeats import PLACE_FIELDS, PLACES, SEED_FIELDS, SEEDS, batch_of, ladder, mask_of, place_rows, removal, repeated_seeds, repeated_windows, seed_places, seed_rows, sha, split_contexts, windows_of_places


def _rung(window: int, seed: int, below: int | None, last: bool):
    """(uid, body) or, above the first rung, (uid, body, repeated seeds of the rung below) -> seed rows; those of the
    last rung have their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, rows = batch.slice(at, 500), []
                for k in range(part.num_rows):
                    uid, words = part.column(0)[k].as_py(), part.column(1)[k].as_py().split()
                    if len(words) < window:
                        continue
                    ranges = Ranges(hashes.of(words))
                    known = (below, part.column(2)[k].values.to_numpy().view(np.uint64)) if below else None
                    places, every = seed_places(ranges, len(words), window, seed, known)
                    rows.append(seed_rows(uid, ranges, len(words), places, every, window, seed) if last else place_rows(uid, places, every))
                if rows:
                    yield batch_of(rows, SEED_FIELDS if last else PLACE_FIELDS)

    return run


def _windows(window: int):
    fields = pa.schema([("w", pa.int64()), ("uid", pa.int64()), ("p", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for k in range(batch.num_rows):
                uid, body, lo, hi = (batch.column(c)[k] for c in range(4))
                ranges = Ranges(hashes.of(body.as_py().split()))
                yield batch_of([windows_of_places(uid.as_py(), ranges, lo.values.to_numpy(), hi.values.to_numpy(), window)], fields)

    return run


def repeated_word_spans(rows: DataFrame, bits: int, window: int) -> DataFrame:
    """(uid, lo, hi) word ranges of rows (uid, body) that also stand in a document of a smaller id."""
    docs = rows.select("uid", "body")
    below = survivors = None
    rungs = ladder(window)
    for length in rungs:
        last = length == rungs[-1]
        # A document has at most as many seeds as words.
        told = docs if below is None else docs.join(survivors.groupBy("uid").agg(F.collect_list("seed").alias("seeds")), "uid")
        seeds = staged(told.mapInArrow(_rung(window, length, below, last), SEEDS if last else PLACES), "seeds")
        found = repeated_seeds(seeds, bits, "survivors")
        discard(seeds, *([] if below is None else [survivors]))
        below, survivors = length, found
        if not last and survivors.isEmpty():
            return rows.sparkSession.createDataFrame([], "uid long, lo int, hi int")
    marked = split_contexts(survivors, bits)
    near = marked.where("not covered").groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("at")).select("uid", F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"))
    windows = staged(docs.join(near, "uid").mapInArrow(_windows(window), "w long, uid long, p int"), "windows")
    discard(survivors)
    spans = marked.where("covered").select("uid", "lo", "hi").unionByName(repeated_windows(windows, bits, window))
    discard(windows)
    return spans


@any_ids("doc_id")
def dedup_substrings(docs: DataFrame, window: int = 50) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed (long), kept_sha256, kept_text (string, words joined by one space).

    Null or empty text has no words. A document of fewer words than the window loses nothing. Rows with a null id are
    returned whole and take no part in comparisons; rows that share an id are never compared with each other. An empty
    table gives an empty result. Extra columns are ignored.
    """
    rows, bits = with_uid(docs)
    spans = repeated_word_spans(rows, bits, window)
    fields = pa.schema([("uid", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def rewrite(body: bytes, lo, hi) -> tuple:
        words = body.split()
        n = len(words)
        if lo is not None:
            gone = mask_of(n, lo, hi)
            words = np.array(words, dtype=object)[~gone].tolist()
        kept = b" ".join(words)
        return n, n - len(words), sha(kept), kept.decode("utf-8", "replace")

    schema = "uid long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    nameless = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("uid"), F.coalesce(F.encode(F.col("text").cast("string"), "UTF-8"), F.lit(b"")).alias("body"))
    out = removal(rows.select("uid", "body").unionByName(nameless), spans, rewrite, schema, fields)
    return out.select(F.shiftright("uid", bits).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text")
