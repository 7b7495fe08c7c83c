"""Tokenised corpora: encoding with a public tokenizer, and token-id files in a byte-aligned code.

Encoding works on chunks and pieces that the tokenizer itself never merges across. A task remembers the ids of those it
has seen; a new piece goes to the tokenizer's merge model alone.

File format: Parquet as the container, one row per block of documents in ascending doc_id order:
`part int, block int, base long (ids before the block in its part), doc_ids array<long>, lengths array<int>,
control binary, data binary`. Ids are replaced by their rank in falling corpus frequency; rank r takes 1 to 4
little-endian bytes in `data`, and its byte count less one takes two bits of `control`, four ranks a byte, low bits
first. A side table holds (rank, id).
"""

from __future__ import annotations

import array
import contextlib
import functools
import gc
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terracat.llm.common import fresh_path, staged

#: White space of Unicode, as the tokenizers see it.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Tokenizers that drop white space: a chunk is a run without any. Others: a run with the one blank before it, or blanks.
CHUNKS = {"dropped": rf"[^{BLANK}]+", "kept": rf" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"}
#: Letters and numbers up to U+00FF, and how the two tokenizers cut a chunk of such characters into pieces.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
PIECES = {
    "dropped": rf"{ENDINGS}|[{LETTERS}]+|[{NUMBERS}]|[^{BLANK}{LETTERS}{NUMBERS}]+",
    "kept": rf"{ENDINGS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANK}{LETTERS}{NUMBERS}]+|[{BLANK}]+",
}
LAST = "ÿ"
#: Blanks that plain string functions would cut in another way than CHUNKS does.
CONTROL, UNEVEN = re.compile(r"[\x1c-\x1f]"), ("  ", "\n\n", " \n", "\n ")
#: Chunks and pieces a task remembers, and the longest one worth it; beyond it the memory is emptied.
CACHE, CACHED_CHARS = 500_000, 48
#: Ids in a block of a token file, about.
BLOCK_IDS = 1 << 18


@functools.lru_cache(maxsize=2)
def tokenizer_of(path: str):
    """A worker's tokenizer; what is remembered of texts belongs to a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder(dict):
    """Whole texts to token ids; as a dict, what it remembers: chunk or piece -> its ids as bytes.

    blanks: "dropped" or "kept" by the tokenizer; kind: numpy type of the ids in bytes.
    """

    def __init__(self, path: str, blanks: str, kind: str = "<u4"):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer, self.kind, self.code = tokenizer_of(path), kind, {"<u2": "H", "<u4": "I"}[kind]
        self.merge = self.tokenizer.model.tokenize
        self.dropped = blanks == "dropped"
        self.split, self.cut = re.compile(CHUNKS[blanks]).findall, re.compile(PIECES[blanks]).findall
        spelt = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str  # bytes as the merge model spells them
        self.spelling = {k: spelt(chr(k))[0][0] for k in range(ord(LAST) + 1)}
        # A special token's string in a text cuts it for the tokenizer: such texts are encoded in one go.
        self.specials = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)")

    def raw(self, text: str) -> bytes:
        """Ids of a text, as bytes."""
        if self.specials.search(text):
            return self._whole(text)
        return b"".join(map(self.__getitem__, self._chunks(text)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.raw(t), dtype=self.kind) for t in texts]

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() or max(chunk) <= LAST:
            pieces = self.cut(chunk.lower() if self.dropped else chunk)
            if len(pieces) == 1:
                ids = [t.id for t in self.merge(pieces[0].translate(self.spelling))]
                value = array.array(self.code, ids).tobytes()
            else:
                value = b"".join(map(self.__getitem__, pieces))
        else:  # composed forms and letter cases beyond are the tokenizer's own matter
            value = self._whole(chunk)
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHE:
                self.clear()
            self[chunk] = value
        return value

    def _chunks(self, text: str) -> list[str]:
        if self.dropped:  # str.split knows the same blanks, and four control characters besides
            return self.split(text) if CONTROL.search(text) else text.split()
        if not text.replace("\n", "").isprintable() or any(x in text for x in UNEVEN):  # printable: the blank is the only white space
            return self.split(text)
        return text.replace("\n", "\x1f\n\x1f").replace(" ", "\x1f ").split("\x1f")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()


@contextlib.contextmanager
def no_cycles():
    """The memory of an encoder holds no cycles, and searching it for some again and again takes a tenth of the time."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id long, text (null: empty)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encoded(docs: DataFrame, tokenizer: str, blanks: str, end_id: int, narrow: bool = True) -> DataFrame:
    """doc_id, n_tokens int, ids binary (little-endian, two bytes each if narrow else four), the end id appended.

    Null text counts as empty and yields the end id alone. tokenizer: path of its file on every machine.
    """
    kind = "<u2" if narrow else "<u4"
    fields = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = Encoder(tokenizer, blanks, kind), np.array([end_id], dtype=kind).tobytes()
        with no_cycles():
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    ids = [own.raw(t) + end for t in part.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // len(end) for x in ids], pa.int32()), pa.array(ids, pa.binary())], schema=fields)

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_tokens int, ids binary")


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF) + (ranks > 0xFFFF).astype(int) + (ranks > 0xFFFFFF)
    raw = ranks.view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4) < size[:, None]].tobytes()
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    return (codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6).astype(np.uint8).tobytes(), data


#: Byte counts of the four values of each control byte.
SIZES = np.stack([np.arange(256) >> s & 3 for s in (0, 2, 4, 6)], axis=1).astype(np.uint8) + 1


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The inverse of pack_ranks: sizes by table look-up, then one gather per byte place."""
    size = SIZES[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n].astype(np.int64)
    start = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_token_files(docs: DataFrame, tokenizer: str, path: str, blanks: str = "dropped", end_id: int = 1) -> None:
    """Encode docs and write them under path, ascending by doc_id (null ids first; repeated ids side by side).

    Counts of ids are over the whole corpus; the rank table has at most one row for each id of the vocabulary.
    """
    spark = docs.sparkSession
    narrow = vocabulary(tokenizer) <= 1 << 16
    kind, width = ("<u2", 2) if narrow else ("<u4", 4)
    ids = staged(encoded(docs, tokenizer, blanks, end_id, narrow), "ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            got = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=kind))
            if len(got) > len(total):
                got, total = total, got
            total[: len(got)] += got
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    counts = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    by_rank = np.array([r["id"] for r in sorted(counts.collect(), key=lambda r: (-r["n"], r["id"]))], dtype=np.int64)  # at most the vocabulary
    spark.createDataFrame([(r, int(i)) for r, i in enumerate(by_rank)], "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    fields = pa.schema([("block", pa.int32()), ("base", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("control", pa.binary()), ("data", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, base, held, doc_ids, lengths, size = 0, 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            ranks = rank_of[np.frombuffer(b"".join(held), dtype=kind)]
            control, data = pack_ranks(ranks)
            return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(([block], [base], [doc_ids], [lengths], [control], [data]), fields, strict=True)], schema=fields)

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = len(raw) // width
                if size and size + n > BLOCK_IDS:
                    yield close()
                    block, base, held, doc_ids, lengths, size = block + 1, base + size, [], [], [], 0
                held.append(raw)
                doc_ids.append(doc)
                lengths.append(n)
                size += n
        if size:
            yield close()

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids").select("doc_id", "ids")
    blocks = ordered.mapInArrow(write, "block int, base long, doc_ids array<long>, lengths array<int>, control binary, data binary")
    blocks.withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/blocks")


def vocabulary(tokenizer: str) -> int:
    return tokenizer_of(tokenizer).get_vocab_size()


def read_token_files(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary, little-endian unsigned 32-bit) of every document in files at path."""
    by_rank = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], dtype="<u4")
    blocks = spark.read.schema("block int, base long, doc_ids array<long>, lengths array<int>, control binary, data binary, part int").parquet(f"{path}/blocks")
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = blocks.groupBy("part").agg(F.sum(total).alias("n"))  # a row for each part file
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, doc_ids, lengths, control, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n = np.array(lengths, dtype=np.int64)
                ends = np.cumsum(n)
                ids = by_rank[unpack_ranks(control, data, int(ends[-1]))]
                texts = [ids[e - k : e].tobytes() for e, k in zip(ends, n, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(base + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array(texts, pa.binary())], schema=fields)

    placed = blocks.join(F.broadcast(before), "part").select((F.col("base") + F.col("before")).alias("base"), "doc_ids", "lengths", "control", "data")
    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_index(docs: DataFrame, tokenizer: str, blanks: str = "dropped", end_id: int = 1) -> DataFrame:
    """Write the token files of docs in the shared folder, read them back: doc_id, start, n_tokens, ids_crc32 (long).

    Null text is empty: the end id alone. Empty tables give no files' rows and an empty result.
    """
    path = fresh_path(docs.sparkSession, "tokens")
    write_token_files(docs, tokenizer, path, blanks, end_id)
    return read_token_files(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
