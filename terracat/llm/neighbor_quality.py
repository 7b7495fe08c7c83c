"""Quality by the votes of the nearest labelled texts in a latent-semantic space.

A text is a bag of terms: its words, the shapes of its words (letters in one case or the other, digits, marks as they
are), the shapes of two neighbouring words, marks for a word or line that stands twice, and its length in powers of two.
Terms are hashed into BUCKETS, damped by the logarithm and weighed by how few texts of the whole corpus have them.
Labelled texts give the leading DIM singular directions, by iteration of a random subspace. Their vectors, at most
TRAIN_ROWS of DIM numbers, go to every task, which takes the cosines of blocks of texts with all of them; the NEAREST
ones vote for their labels with weight similarity ** SHARP.

TRAIN_ROWS bounds the labelled rows: that many by smallest hash of the id, half of each label, and votes are weighed
back to the shares of the labels among all rows that may be learned from. Counts of terms cover all texts.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import BASE, WORD_CACHE, doc_chunks, id_text, mix, staged

TRAIN_ROWS = 3_000
#: Hashed terms: WORDS of the buckets hold words, the rest shapes and marks.
BUCKETS, WORDS, DIM = 1 << 13, 5 << 10, 48
NEAREST, SHARP = 25, 8
#: Texts whose cosines are taken in one product.
BLOCK = 64
#: Bytes of text that a task holds at a time; a longer text is held alone.
HELD = 1 << 22
#: Rounds of the subspace, and directions beyond DIM that are carried along.
ROUNDS, SPARE = 8, 16
AGAIN, LINE_AGAIN, LENGTH = (np.uint64(xxhash.xxh3_64_intdigest(t)) for t in (b"\nword again", b"\nline again", b"\nlength"))
_SHAPE = bytes(120 if 97 <= c < 123 or c >= 128 else 88 if 65 <= c < 91 else 57 if 48 <= c < 58 else c for c in range(256))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


class Shapes(dict):
    """word with letters as x or X and digits as 9 -> hash of it with stretches of one character as one; marks stay."""

    def __missing__(self, drawn: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[drawn] = xxhash.xxh3_64_intdigest(bytes(c for k, c in enumerate(drawn) if not k or c != drawn[k - 1]))
        return value


class Terms(dict):
    """word -> its bucket and the hash of its shape, in one number."""

    def __init__(self):
        super().__init__()
        self.shapes = Shapes()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        bucket = xxhash.xxh3_64_intdigest(word.lower().strip(_MARKS)) % WORDS
        value = self[word] = self.shapes[word.translate(_SHAPE)] >> 14 << 13 | bucket
        return value


def term_counts(bodies: list[bytes], known: Terms) -> np.ndarray:
    """How often each text has each bucket's terms: texts x BUCKETS."""
    words = [b.split() for b in bodies]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    packed = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(words)), dtype=np.int64, count=int(sizes.sum())).view(np.uint64)
    of = np.repeat(np.arange(len(bodies)), sizes)
    own = packed >> np.uint64(13)
    two = of[1:] == of[:-1]
    pair = (own[:-1] * BASE + own[1:])[two]
    again = of[1:][two & (packed[1:] == packed[:-1])]
    lines = [(k, n - len(set(some))) for k, b in enumerate(bodies) if b"\n" in b and (n := len(some := [x for x in b.split(b"\n") if x.strip()]))]
    lines_of, lines_n = np.array([k for k, _ in lines], dtype=np.int64), np.array([n for _, n in lines], dtype=np.int64)
    long = LENGTH + np.ceil(np.log2(sizes + 1)).astype(np.uint64)
    place = lambda h: WORDS + (mix(h) % np.uint64(BUCKETS - WORDS)).astype(np.int64)
    one = lambda h, n: np.full(n, place(np.array([h]))[0])
    column = np.concatenate(((packed & np.uint64((1 << 13) - 1)).astype(np.int64), place(own), place(pair), one(AGAIN, len(again)), np.repeat(one(LINE_AGAIN, len(lines)), lines_n), place(long)))
    row = np.concatenate((of, of, of[1:][two], again, np.repeat(lines_of, lines_n), np.arange(len(bodies))))
    return np.bincount(row * BUCKETS + column, minlength=len(bodies) * BUCKETS).reshape(len(bodies), BUCKETS)


def normal(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; rows of nothing stay nothing."""
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1)


def weighed(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Damped counts times rarity, rows at length 1."""
    at = np.flatnonzero(counts)  # few of a row
    row, column = at // BUCKETS, at % BUCKETS
    value = np.log1p(counts.reshape(-1)[at]) * rarity[column]
    size = np.sqrt(np.bincount(row, weights=value * value, minlength=len(counts)))
    out = np.zeros(counts.size, dtype=np.float32)
    out[at] = value / np.where(size > 0, size, 1)[row]
    return out.reshape(counts.shape)


def train(bodies: list[bytes], labels: list[int], rarity: np.ndarray, shares: dict[int, float]) -> dict[str, np.ndarray]:
    """{"rarity", "axes" (BUCKETS x DIM), "vectors", "labels", "votes"}. Without texts of both labels: no vectors, untrained."""
    rarity = rarity.astype(np.float32)
    if len(set(labels)) < 2:
        return {"rarity": rarity, "axes": np.zeros((BUCKETS, DIM), dtype=np.float32), "vectors": np.zeros((0, DIM), dtype=np.float32), "labels": np.zeros(0), "votes": np.zeros(0)}
    known = Terms()
    x = np.concatenate([weighed(term_counts(bodies[k : k + BLOCK], known), rarity) for k in range(0, len(bodies), BLOCK)])
    rng = np.random.default_rng(11)
    axes = rng.standard_normal((BUCKETS, DIM + SPARE)).astype(np.float32)
    for _ in range(ROUNDS):
        axes, _ = np.linalg.qr(x.T @ (x @ axes))
    _, _, turn = np.linalg.svd(x @ axes, full_matrices=False)
    axes = (axes @ turn.T)[:, :DIM]
    if axes.shape[1] < DIM:
        axes = np.pad(axes, ((0, 0), (0, DIM - axes.shape[1])))
    y = np.array(labels, dtype=np.float64)
    drawn = {c: (y == c).mean() for c in (0, 1)}
    votes = np.where(y == 1, shares[1] / drawn[1], shares[0] / drawn[0])
    return {"rarity": rarity, "axes": axes.astype(np.float32), "vectors": normal(x @ axes).astype(np.float32), "labels": y, "votes": votes}


def vote(model: dict[str, np.ndarray], bodies: list[bytes], known: Terms) -> np.ndarray:
    """Scores of texts: the share of label 1 among the votes of the nearest labelled texts."""
    if not len(model["vectors"]):
        return np.full(len(bodies), 0.5)
    out = []
    for k in range(0, len(bodies), BLOCK):
        own = normal(weighed(term_counts(bodies[k : k + BLOCK], known), model["rarity"]) @ model["axes"])
        near = own @ model["vectors"].T
        n = min(NEAREST, near.shape[1])
        at = np.argpartition(-near, n - 1, axis=1)[:, :n]
        weight = np.maximum(np.take_along_axis(near, at, axis=1).astype(np.float64), 1e-3) ** SHARP * model["votes"][at]
        out.append((weight * model["labels"][at]).sum(axis=1) / weight.sum(axis=1))
    return np.clip(np.concatenate(out), 0.0, 1.0)


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def term_rarity(docs: DataFrame) -> np.ndarray:
    """log((1 + texts) / (1 + texts with a term)) of each bucket, over all texts; null and empty ones have their length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, texts = Terms(), np.zeros(BUCKETS, dtype=np.int64), 0
        for _, bodies in doc_chunks(batches, HELD):
            for k in range(0, len(bodies), BLOCK):
                total += (term_counts(bodies[k : k + BLOCK], known) > 0).sum(axis=0)
            texts += len(bodies)
        yield pa.RecordBatch.from_arrays([pa.array([*range(BUCKETS), -1], pa.int32()), pa.array([*total.tolist(), texts], pa.int64())], names=["bucket", "n"])

    counted = id_text(docs).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r["bucket"]: r["n"] for r in counted.collect()}  # BUCKETS rows and one
    have = np.array([found.get(k, 0) for k in range(BUCKETS)])
    return np.log((1 + found.get(-1, 0)) / (1 + have))


def fit_neighbors(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Vectors of at most `rows` labelled documents outside the held-out fold; finding the directions is one task.

    Null labels, ids and texts are left out. Without rows of both labels the model is untrained and gives every text the score 0.5.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    usable = known.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    sizes = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}  # two rows
    total = max(1, sum(sizes.values()))
    shares = {c: sizes.get(c, 0) / total for c in (0, 1)}
    order, picked = F.xxhash64("doc_id"), None
    for label in (0, 1):
        some = usable.where(F.col("quality") == label).orderBy(order, "doc_id").limit(rows // 2)
        picked = some if picked is None else picked.unionByName(some)
    picked = F.broadcast(picked.withColumnRenamed("doc_id", "key"))  # at most `rows` pairs of numbers
    sample = id_text(docs.where("text is not null")).join(picked, F.col("doc_id") == F.col("key")).select("doc_id", "body", "quality")
    rarity = term_rarity(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = {}
        for b in batches:
            for d, t, y in zip(*[c.to_pylist() for c in b.columns], strict=True):
                got[d] = max(got.get(d, (b"", y)), (t, y))  # one row for each id
        rows = [got[d] for d in sorted(got)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train([t for t, _ in rows], [y for _, y in rows], rarity, shares))], pa.binary())], names=["model"])

    trained = staged(sample.repartition(1).mapInArrow(run, "model binary"), "neighbors").first()
    return pickle.loads(trained["model"]) if trained else train([], [], rarity, shares)


def score_quality(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """One row per input row: doc_id, held_out boolean, score double in 0..1, predicted int (1 if score >= 0.7).

    A text without words has its length as only term, null like empty. Null ids count as not held out. Rows are scored
    one by one; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # (BUCKETS + TRAIN_ROWS) * DIM floats
    fields = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        for ids, bodies in doc_chunks(batches, HELD):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vote(shared.value, bodies, known), pa.float64())], schema=fields)

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
