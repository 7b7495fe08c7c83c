"""Suffix-array dedup by threshold-bounded interval expansion on a Burrows-Wheeler transform, on bytes.

A window is a string of the length asked for. Its seed is the first least (by hash) of the strings of half that length
in it, so copies of a window have the same seed at the same place. Neighbouring windows of one seed place form a strip.
Equal windows lie in strips of equal seeds:

1. Each document is cut into strips. They are sent by their seed to buckets, packed; within a block of documents, of
   equal strips only those of the smallest document are sent, and those of others are covered at once.
2. A bucket covers strips that a smaller document has in whole. Seeds with several different strips remain, and of
   each strip one copy.
3. Those copies are cut from the texts, and the copies of a bucket become one text. Its suffixes are sorted, its
   Burrows-Wheeler transform is taken, and intervals of equal prefixes are extended backwards breadth first, one byte a
   level, so that the places where neighbours share exactly 0, 1, 2 ... bytes are found in that order. It stops at the
   length asked for: what is not yet parted shares that many bytes. What it finds holds for all places of the copy.

Seeds of more different strips than one text should hold (HEAVY) send their single windows to buckets of the windows'
own hashes instead, which finds the same. Between stages, places travel in packed rows, by the document's group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracat.llm.common import Ranges, any_ids, discard, mix, sliding, staged, with_uid
from terracat.llm.repeats import mask_of, sha

#: Different strips of one seed that may meet in one text, bytes of such a text, and bytes of documents for each bucket.
HEAVY, TEXT_BYTES, BUCKET_BYTES = 10_000, 1_000_000, 12 << 20
#: Shuffle partitions at most: with more buckets than that, a partition holds several, one after the other.
PARTITIONS = 20_000
#: Strips that a block of documents holds, about.
BLOCK_STRIPS = 800_000
#: Levels of the expansion after which intervals of one suffix are set aside.
SETTLE = 5
UNIT = mix(np.arange(1, 257, dtype=np.uint64))
LOW = np.uint64(0xFFFFFFFF)
#: Kinds of packed rows; documents come after all others of their group.
COVERED, STRIP, COPY, HEAVY_COPY, TEXT, WINDOW, DOC = range(7)
SCHEMA = "to int, kind int, uid binary, count binary, lo binary, size binary, key binary, more binary, body binary"
PACKED = pa.schema([("to", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("uid", "count", "lo", "size", "key", "more", "body"))])


def units(body: bytes) -> np.ndarray:
    return UNIT[np.frombuffer(body, dtype=np.uint8)]


def strips(ranges: Ranges, n: int, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seed hash, content hash (with the seed's place in it), start and end of each strip of a text of n units."""
    every = ranges.every(seed)
    ordered = (every & ~LOW) | np.arange(len(every), dtype=np.uint64)  # by hash, then by place
    place = (sliding(ordered, window - seed + 1, np.minimum) & LOW).astype(np.int64)
    lo = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    hi = np.append(lo[1:], len(place)) - 1 + window
    at = place[lo]
    content = ranges.of(lo, hi) ^ mix(((at - lo) << 20).astype(np.uint64) + (hi - lo).astype(np.uint64))
    return mix(every[at]), content, lo, hi


def edges_of(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)


def segments(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + count), one after the other."""
    total = int(count.sum())
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(total)


def firsts(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, number of the key's group of each place of that order, and the smallest document of each group."""
    order = np.argsort(key)
    start = edges_of(key[order])
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
    return order, group, np.minimum.reduceat(doc[order], start) if len(start) else start


def rows_of(kind: int, to: np.ndarray, uid: np.ndarray, lo: np.ndarray, size: np.ndarray, key=None, more=None) -> Iterator[tuple]:
    """Packed rows of places, one for each `to`; key and more are arrays of as many values, or None."""
    order = np.argsort(to, kind="stable")
    bounds = np.append(edges_of(to[order]), len(order))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        own = order[a:b]
        of = uid[own]
        change = edges_of(of)
        yield (
            int(to[own[0]]), kind, of[change].astype("<i8").tobytes(), np.diff(np.append(change, len(of))).astype("<i4").tobytes(),
            lo[own].astype("<i4").tobytes(), size[own].astype("<i4" if kind == COVERED else "<u2").tobytes(),
            None if key is None else key[own].tobytes(), None if more is None else more[own].tobytes(), None,
        )


def places_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    uid = np.repeat(np.frombuffer(row["uid"], dtype="<i8"), np.frombuffer(row["count"], dtype="<i4"))
    size = np.frombuffer(row["size"], dtype="<i4" if row["kind"] == COVERED else "<u2")
    return uid, np.frombuffer(row["lo"], dtype="<i4").astype(np.int64), size.astype(np.int64)


def batch_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 200):
        part = rows[at : at + 200]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*part, strict=True), PACKED, strict=True)], schema=PACKED)


def covered_rows(uid: np.ndarray, lo: np.ndarray, size: np.ndarray, groups: int) -> Iterator[tuple]:
    """Packed rows of covered places; those of a document that touch become one."""
    if not len(uid):
        return
    order = np.lexsort((lo, uid))
    uid, lo, hi = uid[order], lo[order], (lo + size)[order]
    first = np.concatenate(([True], uid[1:] != uid[:-1]))
    # Ends only grow within a document: strips and windows of one size are in order of both ends, or nearly; a span
    # that would be cut short by that is only stored in two parts.
    fresh = first | np.concatenate(([True], lo[1:] > hi[:-1]))
    start = np.flatnonzero(fresh)
    end = np.maximum.reduceat(hi, start)
    yield from rows_of(COVERED, uid[start] % groups, uid[start], lo[start], end - lo[start])


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """Rows sorted by (to, kind), gathered: (to, kind, rows); documents come one by one."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["to"], row["kind"]) != now or row["kind"] == DOC:
                if held:
                    yield *now, held
                now, held = (row["to"], row["kind"]), []
            held.append(row)
    if held:
        yield *now, held


def _scan(window: int, buckets: int, bits: int):
    """Documents (uid, body) to packed strips by bucket, and what is covered within the block."""
    seed = window // 2

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        uid, seeds, content, lo, hi = map(np.concatenate, zip(*held, strict=True))
        order, group, least = firsts(seeds ^ content, uid >> bits)
        first = (uid[order] >> bits) == least[group]
        rest, own = order[~first], np.sort(order[first])
        yield from batch_of(list(covered_rows(uid[rest], lo[rest], (hi - lo)[rest], buckets)))
        bucket = ((seeds[own] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        yield from batch_of(list(rows_of(STRIP, bucket, uid[own], lo[own], (hi - lo)[own], (seeds[own] & LOW).astype("<u4"), content[own])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            for u, body in zip(batch.column(0), batch.column(1), strict=True):
                raw = body.as_py()
                if len(raw) < window:
                    continue
                found = strips(Ranges(units(raw)), len(raw), window, seed)
                held.append((np.full(len(found[0]), u.as_py(), dtype=np.int64), *found))
                n_held += len(found[0])
                if n_held >= BLOCK_STRIPS:
                    yield from flush(held)
                    held, n_held = [], 0
        if held:
            yield from flush(held)

    return run


def _judge(buckets: int, bits: int, heavy: int):
    """Packed strips, sorted by bucket, to covered places and copies that must be compared, by documents' groups."""

    def copies(bucket: int, rows: list[dict]) -> Iterator[tuple]:
        uid, lo, size = (np.concatenate(c) for c in zip(*map(places_of, rows), strict=True))
        ident = np.concatenate([np.frombuffer(r["key"], dtype="<u4") for r in rows])
        content = np.concatenate([np.frombuffer(r["more"], dtype="<u8") for r in rows])
        doc = uid >> bits
        order, group, least = firsts(mix(ident.astype(np.uint64) + np.uint64(1)) ^ content, doc)
        first = doc[order] == least[group]
        rest = order[~first]
        yield from covered_rows(uid[rest], lo[rest], size[rest], buckets)
        order, group = order[first], group[first]
        start = edges_of(group)
        count = np.diff(np.append(start, len(group)))
        own = order[start]  # one copy of each different strip
        of_seed = np.argsort(ident[own], kind="stable")
        seed_start = edges_of(ident[own][of_seed])
        n_strips = np.diff(np.append(seed_start, len(own)))
        apart = np.minimum.reduceat(least[of_seed], seed_start) < np.maximum.reduceat(least[of_seed], seed_start)
        for kind, wanted in ((COPY, apart & (n_strips <= heavy)), (HEAVY_COPY, apart & (n_strips > heavy))):
            picked = of_seed[np.repeat(wanted, n_strips)]
            to = uid[own[picked]] % buckets
            picked = picked[np.argsort(to, kind="stable")]
            to = uid[own[picked]] % buckets
            bounds = np.append(edges_of(to), len(to))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                part = picked[a:b]
                row = list(next(rows_of(kind, np.full(b - a, to[a]), uid[own[part]], lo[own[part]], size[own[part]])))
                inside = order[segments(start[part], count[part])]
                row[6] = ((np.uint64(bucket) << np.uint64(32)) | ident[own[part]].astype(np.uint64)).astype("<u8").tobytes()
                row[7] = count[part].astype("<i4").tobytes()
                row[8] = uid[inside].astype("<i8").tobytes() + lo[inside].astype("<i4").tobytes()
                yield tuple(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for to, kind, rows in by_group(batches):
            made = [tuple(r.values()) for r in rows] if kind == COVERED else list(copies(to, rows))
            yield from batch_of(made)

    return run


def copies_of(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """uid, start, size and seed key of copies; number of places, first place, and uid and start of all places."""
    uid, lo, size = (np.concatenate(c) for c in zip(*map(places_of, rows), strict=True))
    key = np.concatenate([np.frombuffer(r["key"], dtype="<u8") for r in rows])
    count = np.concatenate([np.frombuffer(r["more"], dtype="<i4") for r in rows]).astype(np.int64)
    at_uid, at_lo = [], []
    for r in rows:
        n = len(r["body"]) // 12
        at_uid.append(np.frombuffer(r["body"], dtype="<i8", count=n))
        at_lo.append(np.frombuffer(r["body"], dtype="<i4", offset=8 * n))
    return uid, lo, size, key, count, np.cumsum(count) - count, np.concatenate(at_uid), np.concatenate(at_lo).astype(np.int64)


def _cut(window: int, buckets: int, bits: int):
    """Copies and then documents of each group to copies with their text by bucket of the seed, and single windows of
    heavy seeds by bucket of the window."""

    def texts(parts: list[tuple]) -> Iterator[tuple]:
        key, size, count, at_uid, at_lo = (np.concatenate(c) for c in zip(*[p[:5] for p in parts], strict=True))
        pieces = [x for p in parts for x in p[5]]
        to = (mix(key) % np.uint64(buckets)).astype(np.int64)
        order, start = np.argsort(to, kind="stable"), np.cumsum(count) - count
        bounds = np.append(edges_of(to[order]), len(order))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = order[a:b]
            inside = segments(start[own], count[own])
            yield (
                int(to[own[0]]), TEXT, at_uid[inside].astype("<i8").tobytes(), count[own].astype("<i4").tobytes(), at_lo[inside].astype("<i4").tobytes(),
                size[own].astype("<u2").tobytes(), key[own].astype("<u8").tobytes(), None, b"".join([pieces[k] for k in own.tolist()]),
            )

    def windows(parts: list[tuple]) -> Iterator[tuple]:
        w, uid, p = (np.concatenate(c) for c in zip(*parts, strict=True))
        order, group, least = firsts(w, uid >> bits)
        first = (uid[order] >> bits) == least[group]
        rest, own = order[~first], order[first]
        yield from covered_rows(uid[rest], p[rest], np.full(len(rest), window), buckets)
        yield from rows_of(WINDOW, (w[own] % np.uint64(buckets)).astype(np.int64), uid[own], p[own], np.full(len(own), window), w[own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, parts, single = None, {}, [], []
        for to, kind, rows in by_group(batches):
            if to != now:
                if parts:
                    yield from batch_of(list(texts(parts)))
                if single:
                    yield from batch_of(list(windows(single)))
                now, known, parts, single = to, {}, [], []
            if kind != DOC:
                got = copies_of(rows)
                order = np.argsort(got[0], kind="stable")
                start = edges_of(got[0][order])
                for u, a, b in zip(got[0][order][start].tolist(), start.tolist(), np.append(start[1:], len(order)).tolist(), strict=True):
                    known.setdefault(u, []).append((kind, got, order[a:b]))
                continue
            for kind_of, (_, lo, size, key, count, start, at_uid, at_lo), own in known.get(int.from_bytes(rows[0]["uid"], "big", signed=True), ()):
                raw = rows[0]["body"]
                inside = segments(start[own], count[own])
                if kind_of == COPY:
                    pieces = [raw[a:b] for a, b in zip(lo[own].tolist(), (lo + size)[own].tolist(), strict=True)]
                    parts.append((key[own], size[own], count[own], at_uid[inside], at_lo[inside], pieces))
                    continue
                ranges = Ranges(units(raw))
                span = np.repeat(np.arange(len(own)), count[own])
                n = (size[own] - window + 1)[span]  # windows of each place
                k = np.repeat(np.arange(len(span)), n)
                step = segments(np.zeros(len(n), dtype=np.int64), n)
                here = lo[own][span][k] + step
                single.append((ranges.of(here, here + window), at_uid[inside][k], at_lo[inside][k] + step))
        if parts:
            yield from batch_of(list(texts(parts)))
        if single:
            yield from batch_of(list(windows(single)))

    return run


def suffixes_by_prefix(text: np.ndarray, length: int) -> np.ndarray:
    """Start places sorted by their next `length` bytes at least (zeros after the end), by prefix doubling from eight bytes."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : n + k]
    done = 8
    while True:
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])), dtype=np.uint64)
        if done >= length or int(rank.max()) == n:
            return order
        ahead = np.zeros(n, dtype=np.uint64)
        ahead[: max(0, n - done)] = rank[done:]
        key = rank << np.uint64(32) | ahead
        done *= 2


def prefix_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffix starts, and the class of each: equal classes share their first `length` bytes.

    Breadth-first backward extension: level k holds the intervals of all strings of k bytes; putting a byte before
    them maps each interval to one within that byte's part of the order, and where two neighbours fall into different
    intervals their common prefix is k + 1 at most. Levels end at `length`, or when every interval is a single suffix.
    Intervals of one suffix can't be parted again and get numbers of their own, below zero.
    """
    order = suffixes_by_prefix(text, length + 1)
    n = len(order)
    before = text[order - 1]  # the transform; the place before the first is the last
    back = np.argsort(before, kind="stable").astype(np.int32)  # where each place of the order comes from, one byte on
    byte = before[back]
    interval, live = np.zeros(n, dtype=np.int32), np.arange(n, dtype=np.int32)
    for level in range(length):
        come = interval[back]
        edge = np.ones(len(live), dtype=bool)
        edge[1:] = (come[1:] != come[:-1]) | (byte[1:] != byte[:-1])
        interval[live] = np.cumsum(edge, dtype=np.int32)
        if level % SETTLE == SETTLE - 1:
            alone = edge & np.append(edge[1:], True)
            interval[live[alone]] = -1 - live[alone]
            stay = ~alone
            live, back, byte = live[stay], back[stay], byte[stay]
            if not len(live):
                break
    return order, interval


def _expand(window: int, buckets: int, bits: int):
    """Copies with their texts, and single windows, to covered places."""

    def solve(key, size, count, at_uid, at_lo, body: np.ndarray) -> Iterator[tuple]:
        start = np.cumsum(size + 1) - (size + 1)
        text = np.zeros(int(size.sum()) + len(size), dtype=np.uint16)
        text[np.arange(len(body)) + np.repeat(np.arange(len(size)), size)] = body.astype(np.uint16) + 1
        # Bytes and the separator make 257 letters; 8-bit keys need 256, so letters are renamed by those in use.
        used = np.flatnonzero(np.bincount(text, minlength=257))
        if len(used) <= 256:
            name = np.zeros(257, dtype=np.uint8)
            name[used] = np.arange(len(used))
            order, cls = prefix_classes(name[text], window)
        else:  # every byte value occurs: two letters a unit, twice the length
            wide = np.stack((text >> 4, text & 15), axis=1).astype(np.uint8).ravel()
            order, cls = prefix_classes(wide, 2 * window)
            even = order % 2 == 0
            order, cls = order[even] // 2, cls[even]
        owner_at = np.repeat(np.arange(len(size)), size + 1)
        owner = owner_at[order]
        inside = (order + window <= start[owner] + size[owner]) & (cls >= 0)
        order, cls, owner = order[inside], cls[inside], owner[inside]
        if not len(order):
            return
        first_place = np.cumsum(count) - count
        doc = (at_uid[first_place] >> bits)[owner]  # all places of a copy are of one document id
        edge = edges_of(cls)
        least = np.repeat(np.minimum.reduceat(doc, edge), np.diff(np.append(edge, len(cls))))
        hit = np.flatnonzero(doc > least)
        owner, step = owner[hit], (order - start[owner])[hit]
        k = segments(first_place[owner], count[owner])
        yield from covered_rows(at_uid[k], at_lo[k] + np.repeat(step, count[owner]), np.full(len(k), window), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kind, rows in by_group(batches):
            if kind == COVERED:
                yield from batch_of([tuple(r.values()) for r in rows])
            elif kind == WINDOW:
                uid, p, size = (np.concatenate(c) for c in zip(*map(places_of, rows), strict=True))
                order, group, least = firsts(np.concatenate([np.frombuffer(r["key"], dtype="<u8") for r in rows]), uid >> bits)
                rest = order[(uid[order] >> bits) > least[group]]
                yield from batch_of(list(covered_rows(uid[rest], p[rest], size[rest], buckets)))
            else:
                read = lambda name, kind: np.concatenate([np.frombuffer(r[name], dtype=kind) for r in rows])  # noqa: B023, E731
                key, size, count = read("key", "<u8"), read("size", "<u2").astype(np.int64), read("count", "<i4").astype(np.int64)
                at_uid, at_lo, body = read("uid", "<i8"), read("lo", "<i4").astype(np.int64), read("body", np.uint8)
                order = np.argsort(key, kind="stable")
                # Whole seeds, until a text is full.
                seed_end = np.append(edges_of(key[order])[1:], len(order))
                total = np.cumsum(size[order])[seed_end - 1]
                a = 0
                while a < len(order):
                    base = int(np.cumsum(size[order[:a]])[-1]) if a else 0
                    b = int(seed_end[max(np.searchsorted(total, base + TEXT_BYTES, side="right") - 1, np.searchsorted(seed_end, a, side="right"))])
                    own = order[a:b]
                    places = segments((np.cumsum(count) - count)[own], count[own])
                    yield from batch_of(list(solve(key[own], size[own], count[own], at_uid[places], at_lo[places], body[segments((np.cumsum(size) - size)[own], size[own])])))
                    a = b

    return run


def _dealt(packed: DataFrame, buckets: int) -> DataFrame:
    """Packed rows by bucket, a partition for each: dealt by a hash of the bucket's number, several would meet in one."""
    return packed.repartitionById(min(buckets, PARTITIONS), "to").sortWithinPartitions("to", "kind")


def _with_docs(rows: DataFrame, packed: DataFrame, groups: int) -> DataFrame:
    """Documents (uid, body) behind the packed rows of their group, dealt by group."""
    anywhere = F.pmod(F.monotonically_increasing_id(), F.lit(groups))  # rows with no id belong nowhere
    to: Column = F.coalesce(F.pmod("uid", F.lit(groups)), anywhere).cast("int")
    none = F.lit(None).cast("binary")
    name = F.unhex(F.lpad(F.hex("uid"), 16, "0"))  # big end first
    docs = rows.select(to.alias("to"), F.lit(DOC).alias("kind"), name.alias("uid"), *[none.alias(c) for c in ("count", "lo", "size", "key", "more")], "body")
    return _dealt(packed.unionByName(docs), groups)


def covered_places(rows: DataFrame, bits: int, window: int, heavy: int) -> tuple[list[DataFrame], int]:
    """Packed rows of byte ranges of rows (uid, text, body) that also stand in a document of a smaller id, as staged
    tables (other kinds beside), and the number of groups they are dealt by."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(12, -(-total // BUCKET_BYTES)) | 1  # odd, so that ids of any step spread over all
    docs = rows.select("uid", "body")
    dealt = _dealt(docs.mapInArrow(_scan(window, buckets, bits), SCHEMA), buckets)
    judged = staged(dealt.mapInArrow(_judge(buckets, bits, heavy), SCHEMA), "judged")
    wanted = judged.where(F.col("kind").isin(COPY, HEAVY_COPY))
    cut = _dealt(_with_docs(docs, wanted, buckets).mapInArrow(_cut(window, buckets, bits), SCHEMA), buckets)
    found = staged(cut.mapInArrow(_expand(window, buckets, bits), SCHEMA), "found")
    return [judged, found], buckets


@any_ids("doc_id")
def dedup_bytes(docs: DataFrame, window: int = 50, heavy: int = HEAVY) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans (long), kept_sha256, kept_text (string;
    a character cut in part is left out of kept_text).

    Null text is empty; a text of fewer bytes than the window loses nothing. Rows with a null id are returned whole and
    take no part in comparisons; rows that share an id are never compared with each other. An empty table gives an
    empty result. Extra columns are ignored. heavy: different strips of one seed that may meet in one text; the result
    does not depend on it.
    """
    rows, bits = with_uid(docs)
    tables, groups = covered_places(rows, bits, window, heavy)
    covered = tables[0].where(F.col("kind") == COVERED).unionByName(tables[1])
    fields = pa.schema([("uid", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def rewrite(uid, body: bytes, spans) -> tuple:
        n = len(body)
        if spans is None:
            return uid, n, 0, 0, sha(body), body.decode("utf-8", "replace")
        gone = mask_of(n, *spans)
        kept = np.frombuffer(body, dtype=np.uint8)[~gone].tobytes()
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
        return uid, n, int(gone.sum()), runs, sha(kept), kept.decode("utf-8", "ignore")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, uids, lo, hi, out, held = None, np.zeros(0, dtype=np.int64), None, None, [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

        for to, kind, rows in by_group(batches):
            if to != now:
                now, uids = to, np.zeros(0, dtype=np.int64)
            if kind != DOC:
                uids, lo, size = (np.concatenate(c) for c in zip(*map(places_of, rows), strict=True))
                order = np.argsort(uids, kind="stable")
                uids, lo, hi = uids[order], lo[order], (lo + size)[order]
                continue
            raw = rows[0]["body"]
            uid = None if rows[0]["uid"] is None else int.from_bytes(rows[0]["uid"], "big", signed=True)
            a, b = (0, 0) if uid is None else (np.searchsorted(uids, uid), np.searchsorted(uids, uid, side="right"))
            out.append(rewrite(uid, raw, (lo[a:b], hi[a:b]) if b > a else None))
            held += len(raw)
            if held > 4_000_000:
                yield close()
                out, held = [], 0
        if out:
            yield close()

    nameless = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("uid"), F.coalesce(F.encode(F.col("text").cast("string"), "UTF-8"), F.lit(b"")).alias("body"))
    every = rows.select("uid", "body").unionByName(nameless)
    out = _with_docs(every, covered, groups).mapInArrow(run, "uid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return out.select(F.shiftright("uid", bits).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
