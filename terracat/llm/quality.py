"""Quality rules: rules vote or abstain, expectation-maximisation weighs them, the posterior decides.

Each rule looks at a few counts of a text and votes good, bad or nothing. No rule can reject a text alone:
the vote patterns of all documents are counted, a two-class latent model with one outcome table per rule is
fitted to the counts, and a document is kept when its posterior probability of being good is at least a half.
Only counts of vote patterns reach the driver: at most 3 ** len(RULES) rows, however large the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import id_text, staged

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: (name, feature, good range, bad range); a value in neither range abstains. Shares are of words or characters.
RULES = (
    ("length", "n_words", (20, 1e12), (0, 9)),
    ("word_size", "mean_word", (2.2, 11.0), (14.0, 1e9)),
    ("symbols", "symbol_share", (0.0, 0.02), (0.08, 1e9)),
    ("marked_words", "marked_share", (0.0, 0.1), (0.35, 1.0)),
    ("capitals", "upper_share", (0.0, 0.25), (0.6, 1.0)),
    ("shouting", "shout_share", (0.0, 0.05), (0.3, 1.0)),
    ("line_copies", "dup_line_share", (0.0, 0.1), (0.3, 1.0)),
    ("phrase_copies", "repeat_share", (0.0, 0.05), (0.15, 1.0)),
)
FEATURES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("pattern", pa.int32())])
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def repeated_words(words: list[bytes], ids: dict[bytes, int], width: int = 5) -> int:
    """Words that lie in a window of so many words found twice or more in the text, the first finding included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    order = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.uint64, count=len(words))
    key = order[:n].copy()
    for k in range(1, width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + order[k : n + k] + np.uint64(k)
        key ^= key >> np.uint64(29)
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    if not twice.any():
        return 0
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[:n] += twice
    cover[width : n + width] -= twice
    return int((np.cumsum(cover)[:-1] > 0).sum())


def features(body: bytes, ids: dict[bytes, int]) -> tuple[int, int, int, int, int, int]:
    words = body.split()
    n = len(words)
    chars = len(body.decode("utf-8", "replace")) - (len(body) - len(body.translate(None, SPACES)))
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in body.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    if len(ids) > 400_000:
        ids.clear()
    repeat = repeated_words(words, ids)
    letters = len(body) - len(body.translate(None, _LETTERS))
    upper = len(body) - len(body.translate(None, _UPPER))
    marked = sum(w[-1] in SYMBOLS or w[0] in SYMBOLS for w in words)
    shout = body.count(b"!!")
    share = {
        "n_words": n, "mean_word": chars / n if n else 0.0, "symbol_share": symbols / chars if chars else 0.0, "marked_share": marked / n if n else 0.0,
        "upper_share": upper / letters if letters else 0.0, "shout_share": min(1.0, shout / n) if n else 0.0, "dup_line_share": dup / lines if lines else 0.0, "repeat_share": repeat / n if n else 0.0,
    }
    pattern = 0
    for _, name, good, bad in RULES:
        x = share[name]
        pattern = pattern * 3 + (2 if bad[0] <= x <= bad[1] else 1 if good[0] <= x <= good[1] else 0)
    return n, chars, symbols, dup, repeat, pattern


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: dict[bytes, int] = {}
    for batch in batches:
        rows = [features(b.as_py(), ids) for b in batch.column(1)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=f.type) for c, f in zip(columns, list(FEATURES)[1:], strict=True))], schema=FEATURES)


def votes_of(pattern: np.ndarray) -> np.ndarray:
    """Outcome of each rule (0 abstains, 1 good, 2 bad) for each pattern number."""
    return np.stack([pattern // 3 ** (len(RULES) - 1 - k) % 3 for k in range(len(RULES))], axis=1)


def fit(pattern: np.ndarray, count: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior probability of good for each pattern.

    Starts from the share of bad votes; every outcome table has pseudo-counts, in which a rule is right more often
    than not, so that a rule that never fires, or an empty corpus, has a defined result.
    """
    if not len(pattern):
        return np.zeros(0)
    vote = votes_of(pattern)
    bad, good = (vote == 2).sum(1), (vote == 1).sum(1)
    p_good = np.clip(1 - 2.0 * bad / np.maximum(1, bad + good), 0.02, 0.98)
    prior = np.array([[2.0, 8.0, 0.2], [2.0, 2.0, 6.0]])  # pseudo-counts of abstain, good, bad within the good and the bad class
    for _ in range(rounds):
        weight = np.stack([count * p_good, count * (1 - p_good)])
        share = (weight.sum(1) + [9.0, 1.0]) / (weight.sum() + 10.0)
        log_p = np.log(share)[:, None] + np.zeros((2, len(pattern)))
        for r in range(len(RULES)):
            seen = np.stack([np.bincount(vote[:, r], weights=w, minlength=3) for w in weight]) + prior
            log_p += np.log(seen / seen.sum(1, keepdims=True))[:, vote[:, r]]
        p_good = 1 / (1 + np.exp(np.clip(log_p[1] - log_p[0], -500, 500)))
    return p_good


def judge_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    kept (boolean), p_good (double).

    Null or empty text: no words, fails the base. Null ids keep their row. Repeated rows are each judged. An empty
    table gives an empty result. Extra columns are ignored.
    """
    spark = docs.sparkSession
    measured = staged(id_text(docs).mapInArrow(_measure, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, pattern int"), "quality")
    counted = measured.groupBy("pattern").count().collect()  # at most 3 ** len(RULES) rows
    pattern = np.array([r["pattern"] for r in counted], dtype=np.int64)
    p_good = fit(pattern, np.array([r["count"] for r in counted], dtype=float))
    known = spark.createDataFrame([(int(k), float(p)) for k, p in zip(pattern, p_good, strict=True)], "pattern int, p_good double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        measured.join(F.broadcast(known), "pattern", "left")
        .withColumn("base_failed", failed)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("p_good") >= threshold)).alias("kept"), "p_good")
    )
