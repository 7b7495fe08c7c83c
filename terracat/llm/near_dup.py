"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

Sketch of a set, of T coordinates: round i < T throws every element into bin h_i(x) mod T with value i + fraction;
round T + i throws all of them into bin i. A bin keeps its least value, so values of earlier rounds win and the work
ends with the round that fills the last bin: every coordinate is filled, after about T log T / |set| rounds.

Equal sets are one class first; only class representatives are banded. A link must be confirmed on the full sets.
Within a bucket no pairs are listed at first: members are compared with a centre, components are formed, and only
members that are still in different components are then compared with each other: all of them that a bound through a
common reference set does not rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import Ranges, WordHashes, any_ids, mix, signed, staged, with_uid
from terracat.llm.graph import components

#: A pair of similarity 0.8 shares no band with probability 3e-6.
BANDS, ROWS = 42, 6
T = BANDS * ROWS
_SEED = np.array([(0x9E3779B97F4A7C15 * (i + 1)) % (1 << 64) for i in range(2 * T)], dtype=np.uint64)
_LOW = np.uint64(0xFFFFFFFF)


def shingle_set(body: bytes, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; a text of fewer words is one shingle, one without words has none."""
    words = body.lower().split()  # bytes: only A-Z change, only ASCII blanks separate
    if not words:
        return np.zeros(0, dtype=np.uint64)
    values = hashes.of(words)
    k = min(size, len(words))
    return np.unique(mix(Ranges(values).every(k) + np.uint64(k)))


def sketch(elements: np.ndarray) -> np.ndarray:
    """T coordinates of a set that is not empty."""
    least = np.full(T, np.iinfo(np.uint64).max, dtype=np.uint64)
    n, i = len(elements), 0
    while i < T:
        rounds = max(1, min(T - i, 4096 // n))
        h = mix(elements[None, :] ^ _SEED[i : i + rounds, None])
        value = (np.arange(i, i + rounds, dtype=np.uint64)[:, None] << np.uint64(32)) | (h & _LOW)
        np.minimum.at(least, ((h >> np.uint64(32)) % np.uint64(T)).ravel().astype(np.int64), value.ravel())
        i += rounds
        if int(least.max()) >> 32 < i:
            return least
    for b in np.flatnonzero(least == np.iinfo(np.uint64).max):
        least[b] = (T + int(b) << 32) | int((mix(elements ^ _SEED[T + b]) & _LOW).min())
    return least


def band_keys(sketched: np.ndarray) -> np.ndarray:
    """One hash for each band, the band's number in it."""
    rows = sketched.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return key


def _sketched(size: int):
    fields = pa.schema([("uid", pa.int64()), ("n", pa.int32()), ("same", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                counts, same, bands = [], [], []
                for body in part.column(1).to_pylist():
                    s = shingle_set(body, hashes, size)
                    counts.append(len(s))
                    same.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    bands.append(signed(band_keys(sketch(s))) if len(s) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int32()), pa.array(same, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=fields)

    return run


def _sets(size: int):
    fields = pa.schema([("uid", pa.int64()), ("set", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([signed(shingle_set(b, hashes, size)) for b in part.column(1).to_pylist()], pa.list_(pa.int64()))], schema=fields)

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) whose sets reach the similarity."""
    left, right = sets.select(F.col("uid").alias("a"), F.col("set").alias("of_a")), sets.select(F.col("uid").alias("b"), F.col("set").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("both"), (F.size("of_a") + F.size("of_b") - both).alias("either"))
    return met.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def _across(apart: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) in a common bucket but in different components that can still be close, for whatever data.

    apart: key, rep, n, comp, major (the largest component of the bucket). With any reference set c,
    |x & y| <= min(|x & c|, |y & c|) + |(x - c) & (y - c)|. The reference of a component is what half of its members
    hold. So a pair either has enough in common with the reference on both sides, which few pairs of a centre's
    strangers have, or shares an element outside it: an equality join on such elements.
    """
    size = label.groupBy("component").agg(F.count("*").alias("members"))
    majors = apart.select("major").distinct()
    voters = majors.join(size, majors.major == size.component, "left").select("major", F.coalesce("members", F.lit(1)).alias("members"))
    many = voters.where("members >= 8").join(label, F.col("major") == F.col("component")).select("major", F.col("node").alias("uid"), F.col("members").alias("k"))
    few = voters.where("members < 8").select("major", F.col("major").alias("uid"), F.lit(1).cast("long").alias("k"))
    votes = many.unionByName(few).join(sets, "uid").select("major", "k", F.explode("set").alias("s")).groupBy("major", "s").agg(F.count("*").alias("c"), F.first("k").alias("k"))
    reference = votes.where("2 * c >= k").groupBy("major").agg(F.collect_list("s").alias("ref"))
    member = apart.select("rep", "n", "comp", "major").distinct()
    seen = member.join(sets.withColumnRenamed("uid", "rep"), "rep").join(reference, "major", "left")
    ref = F.coalesce("ref", F.array().cast("array<long>"))
    seen = staged(seen.select("rep", "n", "comp", "major", F.size(F.array_intersect("set", ref)).alias("common"), F.array_except("set", ref).alias("extra")), "references")

    def sides(rows: DataFrame, *on: str) -> DataFrame:
        x = rows.where("comp <> major").select(*on, F.col("rep").alias("a"), F.col("comp").alias("of_a"), "n", F.col("common").alias("common_a"))
        y = rows.select(*on, F.col("rep").alias("b"), F.col("comp").alias("of_b"), F.col("n").alias("m"), F.col("common").alias("common_b"), (F.col("comp") == F.col("major")).alias("top"))
        same = [x[c] == y[c] for c in on]
        close = (F.col("of_a") != F.col("of_b")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.col("top") | (F.col("a") < F.col("b")))
        enough = (100 + percent) * F.least("common_a", "common_b") >= percent * (F.col("n") + F.col("m"))
        close = close & (enough if "key" in on else ~enough)
        return x.join(y, [*same, close]).select("a", "b")

    # Of a pair with enough in common each side alone has percent of its own elements in the reference: m is at least
    # percent of n, so (100 + percent) * common >= percent * (n + m) gives 100 * common >= percent * n. Others stay out of the join.
    can = seen.where(100 * F.col("common") >= percent * F.col("n")).select("rep", "major", "common")
    by_key = sides(apart.join(can, ["rep", "major"]), "key")
    by_extra = sides(seen.select("rep", "n", "comp", "major", "common", F.explode("extra").alias("s")), "major", "s")
    return by_key.unionByName(by_extra).distinct()


@any_ids("doc_id", "component_id")
def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80, stars: int = 2) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles long, component_id long, kept boolean.

    Null or empty texts and texts without words have no shingles and are their own component. Rows with a null id are
    their own: component_id null, kept. Rows that share an id count as one document for component_id, and are all kept
    if it is the smallest. An empty table gives an empty result.
    """
    rows, bits = with_uid(docs)
    sketched = staged(rows.select("uid", "body").mapInArrow(_sketched(shingle), "uid long, n int, same binary, bands array<long>"), "sketches")
    classes = sketched.where("n > 0").groupBy("same").agg(F.min("uid").alias("rep"))
    reps = sketched.join(classes.select(F.col("rep").alias("uid")), "uid", "left_semi").select(F.col("uid").alias("rep"), "n", "bands")
    keys = reps.select("rep", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    member = staged(keys.join(shared, "key"), "buckets")
    ids = member.select(F.col("rep").alias("uid")).distinct()
    sets = staged(rows.select("uid", "body").join(ids, "uid", "left_semi").mapInArrow(_sets(shingle), "uid long, set array<long>"), "sets")
    close = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    links, label = None, None
    for turn in range(stars + 1):
        if label is None:
            now = member.withColumn("comp", F.col("rep"))
        else:
            now = member.join(label, member.rep == label.node, "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("comp"))
        by_comp = now.groupBy("key", "comp").agg(F.count("*").alias("c"), F.min(F.struct((F.xxhash64("rep", F.lit(turn)) if turn else F.col("rep")).alias("order"), "rep", "n")).alias("one"))
        largest = by_comp.groupBy("key").agg(F.count("*").alias("comps"), F.max_by(F.struct("comp", "one"), F.struct("c", -F.col("comp"))).alias("top")).where("comps > 1")
        largest = largest.select("key", F.col("top.comp").alias("major"), F.col("top.one.rep").alias("center"), F.col("top.one.n").alias("m"))
        apart = now.join(largest, "key")
        if turn < stars:
            pairs = apart.where((F.col("comp") != F.col("major")) & close).groupBy(F.col("rep").alias("a"), F.col("center").alias("b")).agg(F.count("*").alias("c"))
            if turn == 0:  # the centre that shares most bands; others come later if they still matter
                pairs = pairs.groupBy("a").agg(F.max_by("b", F.struct("c", -F.col("b"))).alias("b"))
        else:
            apart = staged(apart.select("key", "rep", "n", "comp", "major"), "apart")
            pairs = _across(apart, label, sets, percent)
        found = _confirmed(pairs.select("a", "b"), sets, percent)
        links = staged(found if links is None else links.unionByName(found), "links")
        label = components(links)
    by_rep = label.select(F.col("node").alias("rep"), "component")
    of_class = classes.join(by_rep, "rep", "left").select("same", F.coalesce("component", "rep").alias("component"))
    out = sketched.join(of_class, "same", "left").select("uid", "n", F.coalesce("component", "uid").alias("component"))
    ident = F.shiftright("uid", bits)
    out = out.select(ident.alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.shiftright("component", bits).alias("component_id"))
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    return out.unionByName(_unnamed(docs, shingle))


def _unnamed(docs: DataFrame, size: int) -> DataFrame:
    run = _sketched(size)
    rows = docs.where("doc_id is null").select(F.lit(0).cast("long").alias("uid"), F.coalesce(F.encode(F.col("text").cast("string"), "UTF-8"), F.lit(b"")).alias("body"))
    got = rows.mapInArrow(run, "uid long, n int, same binary, bands array<long>")
    return got.select(F.lit(None).cast("long").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
