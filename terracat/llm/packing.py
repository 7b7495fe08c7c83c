"""Best-fit packing of token sequences, hierarchically.

Pieces are dealt at random over at least two parts of some FEW to ITEMS pieces. Each part packs its own by best fit in falling size and emits its nearly full bins. The underfull bins, each
now one item of its fill, are dealt over fewer parts and packed again, in a tree, until they all met in one part or a
round saves less than LEAST of them. What a part holds is bounded by ITEMS, never by the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import discard, staged
from terracat.llm.tokens import Encoder, doc_texts, no_cycles

#: Items that one part packs, and the parts of a round whose underfull bins meet in one part of the next.
ITEMS, FAN_IN = 400_000, 8
#: Items that a part of the first round should hold, as long as the session has shuffle partitions for the parts.
FEW = 4_000
#: A bin with at most this share of free room is closed.
SLACK = 0.002
#: A round that saves a smaller share of the underfull bins is the last.
LEAST = 0.001


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit in falling size: the bin of each item, its offset there, and the fill of each bin."""
    order = np.argsort(-sizes, kind="stable")
    bin_of, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    open_rooms = 0  # bit r: some bin has r free
    fill: list[int] = []
    for k in order.tolist():
        n = int(sizes[k])
        fits = open_rooms >> n
        if n and fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms &= ~(1 << r)
        else:
            b, r = len(fill), capacity
            fill.append(0)
        bin_of[k], offset[k] = b, fill[b]
        fill[b] += n
        left = r - n
        if left:
            room[left].append(b)
            open_rooms |= 1 << left
    return bin_of, offset, np.array(fill, dtype=np.int64)


def _round(items: DataFrame, capacity: int, parts: int, number: int) -> DataFrame:
    """items (item long, size int) -> item, bin, offset, fill; bins get ids of this round and part."""
    fields = pa.schema([("item", pa.int64()), ("bin", pa.int64()), ("offset", pa.int32()), ("fill", pa.int32())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = [b for b in batches if b.num_rows]
        if got:
            rows = pa.Table.from_batches(got).sort_by([("size", "descending"), ("item", "ascending")]).combine_chunks()
            bin_of, offset, fill = best_fit(rows["size"].to_numpy(), capacity)
            first = (number << 56) + (TaskContext.get().partitionId() << 32)
            out = pa.RecordBatch.from_arrays([rows["item"].combine_chunks(), pa.array(first + bin_of), pa.array(offset, pa.int32()), pa.array(fill[bin_of], pa.int32())], schema=fields)
            yield from (out.slice(k, 50_000) for k in range(0, out.num_rows, 50_000))

    dealt = items.select("item", "size").repartition(parts, F.xxhash64("item", F.lit(number)))
    return staged(dealt.mapInArrow(pack, "item long, bin long, offset int, fill int"), "bins")


def pack_items(items: DataFrame, capacity: int) -> DataFrame:
    """items (item long unique, size int in 1..capacity) -> item, sequence_id, offset: bins of at most capacity, gapless.

    No items give no rows.
    """
    total = items.count()
    parts = max(2, min(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // FEW), -(-total // ITEMS))
    placed, number, saved, count = _round(items, capacity, parts, 1), 1, 1, 1
    while parts > 1 and saved > LEAST * count:
        number += 1
        under = placed.where(F.col("fill") < capacity * (1 - SLACK)).groupBy("bin").agg(F.first("fill").alias("size"))
        count = under.count()
        parts = max(-(-count // ITEMS), -(-parts // FAN_IN))
        merged = _round(under.select(F.col("bin").alias("item"), "size"), capacity, parts, number)
        saved = count - merged.select("bin").distinct().count()
        up = merged.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("by"), F.col("fill").alias("now"))
        moved = placed.join(up, "bin", "left")
        offset = F.col("offset") + F.coalesce("by", F.lit(0))
        below = placed
        placed = staged(moved.select("item", F.coalesce("to", "bin").alias("bin"), offset.alias("offset"), F.coalesce("now", "fill").alias("fill")), "bins")
        discard(below, merged)
    return placed.select("item", F.col("bin").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


def pieces_of(docs: DataFrame, tokenizer: str, blanks: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of each document; a longer one's first may be shorter."""
    fields = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = Encoder(tokenizer, blanks), end_id.to_bytes(4, "little")
        with no_cycles():
            for batch in batches:
                rows = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    raw = own.raw(text.as_py()) + end
                    n = len(raw) // 4
                    at, size, piece = 0, (n - 1) % capacity + 1, 0
                    while at < n:
                        rows.append((doc, piece, at, size, zlib.crc32(raw[4 * at : 4 * (at + size)])))
                        at, size, piece = at + size, capacity, piece + 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

    return doc_texts(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer: str, blanks: str = "kept", end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece int, start, length, ids_crc32 (long), sequence_id, offset (long).

    A document of more than capacity ids is cut into pieces of capacity, of which the first may be shorter. Null or
    empty text is the end id alone. Null ids and repeated rows are packed like others, a row for each. An empty table
    gives an empty result. Extra columns are ignored.
    """
    pieces = staged(pieces_of(docs, tokenizer, blanks, end_id, capacity).withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = pack_items(pieces.select("item", F.col("length").cast("int").alias("size")), capacity)
    return pieces.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
