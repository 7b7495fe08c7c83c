"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of itself and its character n-grams, hashed into rows of an embedding table, so an unseen spelling
shares most of its vectors with known ones. An average over a whole long text would drown a few words, and a sum would
grow with its length. So a text is read in short runs of words, each run's average goes through the softmax's linear
map, and the text's gap between the labels is the average over the strongest hundredth of its runs (LEAST at least), so
it means the same at every length. Embeddings and softmax weights are trained together through that average, in
batches, by Adagrad; training begins with the average of all runs, and halves their share every round.

TRAIN_ROWS bounds the labelled rows that the model is fitted on: that many by smallest hash of the id, half of each
label. Everything else covers all rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import WORD_CACHE, staged

TRAIN_ROWS = 3_000
BUCKETS, DIM, GRAMS, RUN = 1 << 17, 8, (3, 4, 5), 2
#: Texts of a batch, texts seen in training (repeats included), the bounds of the rounds that makes, and the rate of steps.
BATCH, SEEN, EPOCHS, RATE = 4, 24_000, (8, 40), 0.5
#: The share of a text's runs that count, and the least number of them.
SHARE, LEAST = 0.01, 2
TRIM = " \t\r\n\v\f.,;:!?\"'()[]{}<>-–—…«»„“”‚‘’*#$%&|"


def grams(word: str) -> np.ndarray:
    """Rows of the embedding table of a word: itself and its n-grams, with marked ends."""
    marked = f"<{word}>"
    parts = [marked, *(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))]
    return np.array([xxhash.xxh32_intdigest(p) % BUCKETS for p in parts], dtype=np.int32)


def words_of(text: str | None) -> list[str]:
    return [w for x in (text or "").lower().split() if (w := x.strip(TRIM))]


def pooled(shares: np.ndarray, first: np.ndarray, sizes: np.ndarray, bias: float, share: float = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """The gap of each text from the shares of its words, and what a word's share counts in it.

    Texts follow each other: sizes words from first on, at least one. Runs are of RUN = 2 words, one word apart; a text
    of one word is a run.
    """
    starts = np.ones(len(shares), dtype=bool)
    starts[(first + sizes - 1)[sizes > 1]] = False  # a run starts at each word but the last one
    at = np.flatnonzero(starts)
    to = np.where(np.repeat(sizes == 1, sizes)[at], at, at + 1)
    gap = (shares[at] + shares[to]) / 2 + bias
    n_runs = np.maximum(sizes - 1, 1)
    edge = np.cumsum(n_runs) - n_runs
    most = np.minimum(n_runs, np.maximum(LEAST, np.ceil(n_runs * share).astype(np.int64)))
    of = np.repeat(np.arange(len(sizes)), n_runs)
    by = np.lexsort((-gap, of))
    strong = by[np.arange(len(gap)) - edge[of] < most[of]]
    part = 1 / most[of[strong]]
    counts = np.bincount(at[strong], weights=part / 2, minlength=len(shares)) + np.bincount(to[strong], weights=part / 2, minlength=len(shares))
    return np.bincount(of[strong], weights=part * gap[strong]), counts


def train(texts: list[str], labels: list[int], seed: int = 7) -> dict[str, np.ndarray]:
    """Embedding table and softmax weights, as {"table", "weight", "bias"}. Without texts of both labels all are zero: untrained."""
    if len(set(labels)) < 2:
        return {"table": np.zeros((BUCKETS, DIM), dtype=np.float32), "weight": np.zeros((2, DIM)), "bias": np.zeros(2)}
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    weight, bias = np.zeros((2, DIM)), np.array([2.0, -2.0])
    weight[1] = rng.uniform(-0.5, 0.5, DIM)
    g_table, g_weight, g_bias = np.full(BUCKETS, 1e-2), np.full(DIM, 1e-1), 1.0
    known: dict[str, int] = {}
    bags = [np.array([known.setdefault(w, len(known)) for w in words_of(t)], dtype=np.int64) for t in texts]
    rows_of = [grams(w) for w in known]  # in the order of their numbers
    y = np.array(labels, dtype=np.float64)
    use = np.array([k for k, b in enumerate(bags) if len(b)], dtype=np.int64)
    if not len(use):
        return {"table": table.astype(np.float32), "weight": weight, "bias": bias}
    epochs = min(EPOCHS[1], max(EPOCHS[0], SEEN // len(use)))
    for epoch in range(epochs):
        rng.shuffle(use)
        rate = RATE * (1 - epoch / epochs)
        for k in range(0, len(use), BATCH):
            part = use[k : k + BATCH]
            sizes = np.array([len(bags[i]) for i in part])
            types, back = np.unique(np.concatenate([bags[i] for i in part]), return_inverse=True)
            n_rows = np.array([len(rows_of[i]) for i in types])
            flat = np.concatenate([rows_of[i] for i in types])
            vectors = np.add.reduceat(table[flat], np.cumsum(n_rows) - n_rows) / n_rows[:, None]
            apart = weight[1] - weight[0]
            gap, counts = pooled((vectors @ apart)[back], np.cumsum(sizes) - sizes, sizes, bias[1] - bias[0], max(SHARE, 0.5**epoch))
            d = 1 / (1 + np.exp(-np.clip(gap, -30, 30))) - y[part]
            by_type = np.bincount(back, weights=counts * np.repeat(d, sizes), minlength=len(types))
            grad_w, grad_b = by_type @ vectors, d.sum()
            rows, place = np.unique(flat, return_inverse=True)
            by_row = np.bincount(place, weights=np.repeat(by_type / n_rows, n_rows))
            g_table[rows] += by_row**2 * (apart**2).mean()
            table[rows] -= rate * by_row[:, None] * apart / np.sqrt(g_table[rows])[:, None]
            g_weight += grad_w**2
            g_bias += grad_b**2
            move, shift = rate * grad_w / np.sqrt(g_weight), rate * grad_b / np.sqrt(g_bias)
            weight += np.stack((move, -move)) / 2
            bias += np.array([shift, -shift]) / 2
    return {"table": table.astype(np.float32), "weight": weight, "bias": bias}


class Scorer(dict):
    """The model as a scorer; as a dict, what it remembers: each word's share of the logit gap, by its raw spelling (nan: no letters)."""

    def __init__(self, model: dict[str, np.ndarray]):
        super().__init__()
        self.rows = (model["table"] @ (model["weight"][1] - model["weight"][0])).astype(np.float64)
        self.bias = float(model["bias"][1] - model["bias"][0])
        self.trained = bool(model["weight"].any() or model["bias"].any())

    def __missing__(self, raw: str) -> float:
        if len(self) >= WORD_CACHE:
            self.clear()
        w = raw.strip(TRIM)
        value = self[raw] = float(self.rows[grams(w)].mean()) if w else float("nan")
        return value

    def score(self, text: str | None) -> float:
        if not self.trained:
            return 0.5
        raw = (text or "").lower().split()
        shares = np.fromiter(map(self.__getitem__, raw), dtype=np.float64, count=len(raw))
        shares = shares[~np.isnan(shares)]
        gap = self.bias
        if len(shares):  # as pooled() does, for one text
            runs = (shares[:-1] + shares[1:]) / 2 if len(shares) > 1 else shares
            most = min(len(runs), max(LEAST, int(np.ceil(len(runs) * SHARE))))
            gap += np.partition(runs, len(runs) - most)[len(runs) - most :].mean()
        return float(1 / (1 + np.exp(-np.clip(gap, -30, 30))))


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Train on at most `rows` labelled documents outside the held-out fold; the training is one task.

    Null labels, ids or texts are left out. Without rows of both labels the model is untrained and gives every text the score 0.5.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    usable = known.where(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    picked = None
    for label in (0, 1):
        some = usable.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(rows // 2)
        picked = some if picked is None else picked.unionByName(some)
    picked = F.broadcast(picked)  # at most `rows` pairs of numbers
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id").where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = {}
        for b in batches:
            for d, t, y in zip(*[c.to_pylist() for c in b.columns], strict=True):
                got[d] = (t, y)  # one row for each id
        rows = [got[d] for d in sorted(got)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train([t for t, _ in rows], [y for _, y in rows]))], pa.binary())], names=["model"])

    trained = staged(sample.repartition(1).mapInArrow(run, "model binary"), "model").first()
    return pickle.loads(trained["model"]) if trained else train([], [])


def score_toxicity(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """One row per input row: doc_id, held_out boolean, score double in 0..1, predicted int (1 if score >= 0.5).

    Null and empty texts get the score of no words. Null ids count as not held out. Extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * DIM floats
    fields = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([scorer.score(t) for t in b.column(1).to_pylist()], pa.float64())], schema=fields)

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
