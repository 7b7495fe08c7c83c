"""Links between the tokens of two tokenizers over the same texts, by products of sparse matrices.

A token covers bytes of its text: tokens x bytes is an incidence matrix, and the product of the one tokenizer's with the
other's transpose holds how many bytes each pair of tokens has in common: its entries are the overlap links. Offsets
where tokens of both end cut a text into groups; the product of tokens x groups matrices links the tokens of one group.
Matrices are rows of compressed columns, made here; products go row by row (Gustavson), a block of rows at a time.

Both tokenizers cut a text before a blank or line feed that follows other than white space, whatever stands around: the
texts of a task fall into segments there, and matrices are built for the different segments of a chunk of texts, one
after the other on the diagonal. Documents x segments and segments x pairs of ids give every document's links.

Corpus-wide counts of id pairs are summed per chunk first. The counts come back to a chunk once for each of its
different pairs, and the chunk's own matrices carry them to its documents: no link is shuffled by itself.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import doc_chunks, staged
from terracat.llm.tokens import doc_texts

#: White space is as wide as either tokenizer may see it, so a cut is never inside a piece.
SEGMENT = re.compile(r"[ \n]\s*\S*(?:(?![ \n])\s+\S*)*").findall
#: Bytes of text in a chunk, and different segments a task remembers; a longer text is a chunk of its own.
CHUNK, MEMORY = 1 << 23, 400_000
#: Segments that are tokenized in one go.
TOGETHER = 128
#: Within the list of groups: between tokens, between the two tokenizers' tokens, between groups, at the end.
SEPARATORS = ",|;\n"
#: Terms of a product that are expanded at a time.
BLOCK = 1 << 20
#: Bits of the second id within a pair.
BITS = 32


class Csr:
    """A sparse matrix by rows: the columns of row i are indices[indptr[i]:indptr[i + 1]], with their values in data."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, width: int):
        self.indptr, self.indices, self.data, self.width = indptr, indices, data, width

    @classmethod
    def of_rows(cls, sizes: np.ndarray, indices: np.ndarray, width: int) -> Csr:
        """Ones at the given columns, so many to each row."""
        return cls(np.concatenate(([0], np.cumsum(sizes))), indices, np.ones(len(indices), dtype=np.int64), width)

    @property
    def height(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.indptr))

    def transpose(self) -> Csr:
        by = np.argsort(self.indices, kind="stable")
        sizes = np.bincount(self.indices, minlength=self.width)
        return Csr(np.concatenate(([0], np.cumsum(sizes))), self.rows()[by], self.data[by], self.height)

    def blocks(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The product with other, as (rows, columns, values) of blocks of rows: row i is the sum of other's rows that
        row i of this one names. A block expands at most BLOCK terms, or one row."""
        size = np.diff(other.indptr)
        terms = np.concatenate(([0], np.cumsum(size[self.indices])))  # before each entry
        ends = terms[self.indptr]  # before each row
        row_of, at = self.rows(), 0
        while at < self.height:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, "right")) - 1)
            i, j = self.indptr[at], self.indptr[to]
            named, n = self.indices[i:j], size[self.indices[i:j]]
            place = np.repeat(other.indptr[named] - (terms[i:j] - terms[i]), n) + np.arange(int(n.sum()))
            key = np.repeat(row_of[i:j], n) * other.width + other.indices[place]
            value = np.repeat(self.data[i:j], n) * other.data[place]
            by = np.argsort(key, kind="stable")
            key, value = key[by], value[by]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            if len(first):
                yield key[first] // other.width, key[first] % other.width, np.add.reduceat(value, first)
            at = to

    def times(self, other: Csr) -> Csr:
        parts = list(self.blocks(other)) or [(np.zeros(0, dtype=np.int64),) * 3]
        rows, columns, values = (np.concatenate(p) for p in zip(*parts, strict=True))
        return Csr(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=self.height)))), columns, values, other.width)


def covers(lengths: np.ndarray) -> Csr:
    """Tokens x bytes of tokens that follow each other."""
    return Csr.of_rows(lengths, np.arange(int(lengths.sum())), int(lengths.sum()))


def group_ends(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Byte offsets where tokens of these lengths end in both."""
    return np.intersect1d(np.cumsum(a), np.cumsum(b), assume_unique=True)


def groups_of(lengths: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each token."""
    return np.searchsorted(ends, np.cumsum(lengths))


@functools.lru_cache(maxsize=1)
def byte_spelling() -> dict[str, int]:
    """The characters by which a byte-level tokenizer spells bytes."""
    from tokenizers.pre_tokenizers import ByteLevel

    spelt = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    found = {}
    for b in range(256):  # a character whose UTF-8 form holds the byte; those never seen in UTF-8 don't matter
        if b < 128:
            found[spelt(chr(b))[0][0]] = b
    for code in [*range(0x80, 0x800), *range(0x800, 0x10000, 0x40), *range(0x10000, 0x110000, 0x1000)]:
        if not 0xD800 <= code < 0xE000:
            for s, b in zip(spelt(chr(code))[0][0], chr(code).encode(), strict=True):
                found[s] = b
    return found


def lengths_and_names(bytes_of: dict[int, bytes]) -> tuple[np.ndarray, list[list[str]]]:
    """By id: bytes of a token, and its decimal spelling before each separator."""
    top = max(bytes_of) + 1
    lengths = np.zeros(top, dtype=np.int64)
    lengths[list(bytes_of)] = [len(t) for t in bytes_of.values()]
    return lengths, [[f"{i}{s}" for i in range(top)] for s in SEPARATORS]


class ByteLevelTokens:
    """A tokenizer of the tokenizers library that spells bytes; strings of special tokens count as plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spelling, known = byte_spelling(), self.tokenizer.get_vocab()
        self.bytes_of = {i: bytes(spelling[c] for c in token) if all(c in spelling for c in token) else token.encode() for token, i in known.items()}
        self.lengths, self.names = lengths_and_names(self.bytes_of)

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """A sentencepiece model with byte fallback; it puts a blank before a text, and so takes texts that begin with one without it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = {i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}
        self.lengths, self.names = lengths_and_names(self.bytes_of)
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces) or len(self.model.encode("\n")) != 2:
            raise ValueError("pieces of this model may cross the cuts between segments")

    def encode(self, text: str) -> list[int]:
        """Of a text as it stands within a longer one: after a line feed, whose two tokens are taken off."""
        return self.model.encode("\n" + text, num_threads=1)[2:]


class Segments(dict):
    """segment -> its number; what is known of each: counts, links, groups as text."""

    def __init__(self, a: ByteLevelTokens, b: PieceTokens):
        super().__init__()
        self.a, self.b = a, b
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.fresh: list[str] = []
        self.texts: list[str] = []  # groups, by decimal ids
        self.counts = np.zeros((0, 6), dtype=np.int64)  # right, tokens of A, of B, groups, links, shared-group links
        self.links = Csr.of_rows(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 1 << 62)  # segments x pairs of ids

    def __missing__(self, segment: str) -> int:
        value = self[segment] = len(self)
        self.fresh.append(segment)
        return value

    def tokens(self, segments: list[str]) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
        """Ids of A and of B and bytes of each segment (0: no tokens), of so many segments at a time."""
        text = "".join(segments)
        # Segments that end in white space (the last of a text) would meet the next one in another way than in theirs.
        if len(segments) == 1 or not any(s[-1].isspace() for s in segments):
            x, y = self.a.encode(text), self.b.encode(text)
            body = text.encode()
            if b"".join(map(self.a.bytes_of.__getitem__, x)) == body == b"".join(map(self.b.bytes_of.__getitem__, y)):
                yield x, y, np.array([len(s) for s in segments] if len(body) == len(text) else [len(s.encode()) for s in segments])
                return
            if len(segments) == 1:
                yield [], [], np.zeros(1, dtype=np.int64)
                return
        half = len(segments) // 2
        yield from self.tokens(segments[:half])
        yield from self.tokens(segments[half:])

    def learn(self) -> None:
        """Tokenize and link the segments that are new, all in one block matrix."""
        if not self.fresh:
            return
        segments, self.fresh = self.fresh, []
        n = len(segments)
        units = [u for at in range(0, n, TOGETHER) for u in self.tokens(segments[at : at + TOGETHER])]
        flat_a, flat_b = (np.concatenate([np.array(u[k], dtype=np.int64) for u in units]) for k in (0, 1))
        size = np.concatenate([u[2] for u in units])
        until = np.cumsum(size)
        len_a, len_b = self.a.lengths[flat_a], self.b.lengths[flat_b]
        overlap = covers(len_a).times(covers(len_b).transpose())  # A tokens x B tokens
        of_a, of_b = np.searchsorted(until, np.cumsum(len_a)), np.searchsorted(until, np.cumsum(len_b))  # the segment of a token
        row = overlap.rows()
        pairs = flat_a[row] << BITS | flat_b[overlap.indices]
        ends = group_ends(len_a, len_b)  # the end of each segment is one
        group_a, group_b = groups_of(len_a, ends), groups_of(len_b, ends)
        in_group = Csr.of_rows(np.ones(len(group_b), dtype=np.int64), group_b, len(ends)).transpose()
        # A's tokens x groups times groups x B's tokens, a block at a time: the links of each token of A within its group.
        shared = np.zeros(len(flat_a), dtype=np.int64)
        for rows, _, _ in Csr.of_rows(np.ones(len(group_a), dtype=np.int64), group_a, len(ends)).blocks(in_group):
            shared += np.bincount(rows, minlength=len(shared))
        per = lambda of, weights=None: np.bincount(of, weights=weights, minlength=n).astype(np.int64)
        found = (size > 0, per(of_a), per(of_b), per(np.searchsorted(until, ends)), per(of_a[row]), per(of_a, shared))
        # All tokens by segment, group and tokenizer, each before the separator that its successor asks for.
        by = np.lexsort((np.repeat((0, 1), (len(flat_a), len(flat_b))), np.concatenate((group_a, group_b))))
        ids, group, second = np.concatenate((flat_a, flat_b))[by], np.concatenate((group_a, group_b))[by], by >= len(flat_a)
        segment = np.append(np.concatenate((of_a, of_b))[by], n)
        mark = np.zeros(len(ids), dtype=np.int64)
        mark[:-1] = np.where(group[1:] != group[:-1], 2, np.where(second[1:] != second[:-1], 1, 0))
        mark[segment[1:] != segment[:-1]] = 3
        names = [(self.b if k else self.a).names[m] for k in (0, 1) for m in range(len(SEPARATORS))]
        spelt = "".join([names[k][i] for k, i in zip((mark + 4 * second).tolist(), ids.tolist(), strict=True)]).split("\n")
        texts = [""] * n
        for k, t in zip(np.flatnonzero(size).tolist(), spelt):
            texts[k] = t
        self.texts += texts
        self.counts = np.concatenate((self.counts, np.stack(found, axis=1)))
        old = self.links
        self.links = Csr(np.concatenate((old.indptr, old.indptr[-1] + np.cumsum(found[4]))), np.concatenate((old.indices, pairs)), np.concatenate((old.data, np.ones(len(pairs), dtype=np.int64))), old.width)


def shared_group_links(len_a: np.ndarray, len_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (token of A, token of B, 1) of all pairs within one group: tokens x groups times groups x tokens."""
    ends = group_ends(len_a, len_b)
    one = lambda g: Csr.of_rows(np.ones(len(g), dtype=np.int64), g, len(ends))
    return one(groups_of(len_a, ends)).blocks(one(groups_of(len_b, ends)).transpose())


#: doc rows: all but the last four; chunk rows: chunk and the last four (its pairs, how often each, and segments x pairs).
PARTS = pa.schema([
    ("chunk", pa.int64()), ("is_doc", pa.bool_()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_group_links", pa.int64()), ("groups_sha256", pa.string()),
    ("segments", pa.binary()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("edges", pa.binary()), ("members", pa.binary()),
])
PART_TYPES = "chunk long, is_doc boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string, segments binary, pairs array<long>, times array<long>, edges binary, members binary"


def align_chunk(chunk: int, ids: list, texts: list[str], known: Segments) -> pa.RecordBatch:
    """The rows of a chunk of documents."""
    spans = [np.fromiter(map(known.__getitem__, SEGMENT(" " + t)), dtype=np.int64) if t else np.zeros(0, dtype=np.int64) for t in texts]
    known.learn()
    spans = [s if known.counts[s, 0].all() else s[:0] for s in spans]  # other bytes than the text's: no tokens
    flat = np.concatenate(spans) if spans else np.zeros(0, dtype=np.int64)
    used, place = np.unique(flat, return_inverse=True)
    often = np.bincount(place, minlength=len(used))
    # Segments x pairs of the chunk, with columns numbered within it.
    size = np.diff(known.links.indptr)[used]
    at = np.repeat(known.links.indptr[used] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum())) if len(used) else np.zeros(0, dtype=np.int64)
    pairs, member = np.unique(known.links.indices[at], return_inverse=True)
    times = np.bincount(member, weights=np.repeat(often, size), minlength=len(pairs)).astype(np.int64)
    counts, edge = known.counts, np.concatenate(([0], np.cumsum([len(s) for s in spans]))).astype(np.int64)
    rows = {name: [] for name in PARTS.names}

    def add(**values) -> None:
        for name in PARTS.names:
            rows[name].append(values.get(name))

    for k, (doc, s) in enumerate(zip(ids, spans, strict=True)):
        sums = counts[s].sum(axis=0).tolist()
        digest = hashlib.sha256(";".join(map(known.texts.__getitem__, s.tolist())).encode()).hexdigest() if len(s) else ""
        local = place[edge[k] : edge[k + 1]].astype("<u4").tobytes()
        add(chunk=chunk, is_doc=True, doc_id=doc, n_a=sums[1], n_b=sums[2], n_groups=sums[3], n_links=sums[4], n_group_links=sums[5], groups_sha256=digest, segments=local)
    add(chunk=chunk, is_doc=False, pairs=pairs, times=times, edges=np.concatenate(([0], np.cumsum(size))).astype("<u4").tobytes(), members=member.astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in PARTS], schema=PARTS)


def carry(parts: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one chunk with their counts; counts holds (place, total, best) of each of the chunk's pairs."""
    fields = pa.schema([f for f in PARTS if f.name in LINK_COLUMNS] + [("n_best", pa.int64()), ("count_sum", pa.int64())])
    kept = parts.filter(parts["is_doc"])
    head = parts.filter(pa.compute.invert(parts["is_doc"])).to_pylist()[0]
    place = counts["place"].to_numpy()
    known = np.zeros((len(place), 2), dtype=np.int64)
    known[place, 0], known[place, 1] = counts["total"].to_numpy(), counts["best"].to_numpy(zero_copy_only=False)
    edge, member = np.frombuffer(head["edges"], dtype="<u4").astype(np.int64), np.frombuffer(head["members"], dtype="<u4")
    before = np.concatenate((np.zeros((1, 2), dtype=np.int64), np.cumsum(known[member], axis=0)))
    by_segment = before[edge[1:]] - before[edge[:-1]]
    sums = [by_segment[np.frombuffer(s, dtype="<u4")].sum(axis=0).tolist() for s in kept["segments"].to_pylist()]
    columns = [kept[c] for c in LINK_COLUMNS]
    return pa.table([*columns, pa.array([s[1] for s in sums], pa.int64()), pa.array([s[0] for s in sums], pa.int64())], schema=fields)


LINK_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256"]


def align_tokens(docs: DataFrame, byte_level: str, pieces: str) -> tuple[DataFrame, DataFrame]:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_group_links, groups_sha256, n_best, count_sum; and per pair of ids: a_id, b_id, total, best.

    byte_level, pieces: paths of the tokenizers' files on every machine. Every text with a blank before it goes to the
    first; the second puts one before it. Null and empty texts, and texts whose tokens spell other bytes (a U+2581 among
    them), have no tokens: zeros and the digest ''. total: links of the whole corpus that hold the pair; best: no pair
    of its B id has more. Rows are taken one by one: null and repeated ids stay; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk = Segments(ByteLevelTokens(byte_level), PieceTokens(pieces)), TaskContext.get().partitionId() << 32
        for ids, texts in doc_chunks(batches, CHUNK):
            yield align_chunk(chunk, ids, texts, known)
            chunk += 1
            if len(known) > MEMORY:
                known.clear()

    parts = staged(doc_texts(docs).mapInArrow(run, PART_TYPES), "aligned")
    each = parts.where("not is_doc").select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x")).select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = staged(each.groupBy("pair").agg(F.sum("times").alias("total")), "pairs")
    b_id = F.col("pair").bitwiseAND((1 << BITS) - 1)
    most = counts.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("most"))  # at most the second vocabulary
    marked = counts.withColumn("b_id", b_id).join(F.broadcast(most), "b_id").select("pair", "b_id", "total", (F.col("total") == F.col("most")).alias("best"))
    told = each.join(marked, "pair").select(F.col("chunk").alias("home"), F.col("place").cast("long").alias("place"), "total", "best")
    types = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in LINK_COLUMNS) + ", n_best long, count_sum long"
    out = parts.drop("pairs", "times").groupBy("chunk").cogroup(told.groupBy("home")).applyInArrow(carry, types)
    return out, marked.select(F.shiftright("pair", BITS).alias("a_id"), "b_id", "total", "best")
