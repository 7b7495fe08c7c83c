"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item's windows are its runs of `window` words (a shorter item is one window). Each window is a set of positioned
shingles. The shingles of all items are looked up in all documents, counted over the whole corpus, and each window
keeps one shingle as its prefix: full containment must meet every shingle, so the rarest one alone is necessary.
A document position that holds a prefix shingle fixes the window's start (positional bound) and must leave room for
the whole window (length bound); the window is confirmed when all its shingles, word for word, stand at their offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terracat.llm.common import any_ids, staged, with_uid

#: Everything else separates words: controls, blanks and ASCII punctuation. A fixed value of the contract.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Item shingles that may be sent to every task; above it the look-up is a shuffled join.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    """Words with A-Z in lower case; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD)
    return F.array_remove(parts, "")  # only the ends can be empty


def windows_of(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """item_id, window_id, start of each distinct window of an item, its length and its positioned shingles."""
    words = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    starts = words.select("item_id", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))
    text = starts.select("item_id", "size", F.slice("words", F.col("start") + 1, F.col("size")).alias("run"))
    named = text.withColumn("window_id", F.sha2(F.array_join("run", " "), 256))
    k = F.least(F.col("size"), F.lit(shingle))
    return named.select("item_id", "window_id", "size", "run", k.alias("k"))


@any_ids("doc_id")
def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items (long), items_sha256 (string), contaminated (boolean),
    hit_spans array<struct<from,to>> (maximal runs of hit words, half open).

    Null or empty text: no words, never contaminated. Items with null or empty text, and null item ids, match nothing.
    Rows that share an id are each matched on their own; a null id keeps its row, without hits. Empty tables on
    either side give rows without hits, or none. Extra columns are ignored.
    """
    rows, bits = with_uid(docs)
    nameless = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("uid"), F.col("text").cast("string").alias("text"))
    docs = rows.select("uid", "text").unionByName(nameless)
    windows = staged(windows_of(items.where(F.col("item_id").isNotNull()), window, shingle), "windows")
    distinct = windows.groupBy("window_id").agg(F.first("run").alias("run"), F.first("size").alias("size"), F.first("k").alias("k"))
    parts = distinct.select("window_id", "size", "k", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))).alias("offset"), "run").select(
        "window_id", "size", "k", "offset", F.array_join(F.slice("run", F.col("offset") + 1, F.col("k")), " ").alias("shingle")
    )
    sizes = [r["k"] for r in windows.select("k").distinct().collect()] or [shingle]  # at most `shingle` values
    known = parts.select("k", F.xxhash64("shingle", "k").alias("key")).distinct()
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    # One pass over the documents. It keeps where a shingle of any item stands, and of each document the first place
    # for its number of words.
    tokens = docs.select("uid", words_of(F.col("text")).alias("words"))
    grams = None
    for k in sorted(sizes):
        shifted = [F.slice("words", i + 1, F.greatest(F.size("words") - (k - 1), F.lit(0))).alias(f"w{i}") for i in range(k)]
        opened = F.posexplode_outer if grams is None else F.posexplode
        one = tokens.select("uid", F.size("words").cast("long").alias("n_words"), opened(F.arrays_zip(*shifted)).alias("pos", "run"))
        one = one.withColumn("gram", F.concat_ws(" ", *[F.col("run")[f"w{i}"] for i in range(k)]))
        one = one.select("uid", "n_words", "pos", "gram", F.xxhash64("gram", F.lit(k)).alias("key"), (F.coalesce("pos", F.lit(0)) == 0 if grams is None else F.lit(False)).alias("head"))
        grams = one if grams is None else grams.unionByName(one)
    looked = grams.join(known.select("key", F.lit(True).alias("hit")), "key", "left").where(F.col("head") | F.col("hit"))
    looked = looked.withColumn("gram", F.when(F.col("hit"), F.col("gram")))
    seen = staged(looked, "found")
    found = seen.where("hit and pos is not null")
    lengths = seen.where("head").select("uid", "n_words")
    rarity = found.groupBy("key").agg(F.count("*").alias("df"))
    keyed_parts = parts.select("window_id", "size", "k", "offset", "shingle", F.xxhash64("shingle", "k").alias("key"))
    # A window with a shingle that no document has cannot occur: the inner join drops that shingle, the count below the window.
    ranked = keyed_parts.join(rarity, "key").groupBy("window_id").agg(F.count("*").alias("met"), F.min(F.struct("df", "offset", "key")).alias("prefix"), F.first("size").alias("size"), F.first("k").alias("k"))
    prefix = ranked.where(F.col("met") == F.col("size") - F.col("k") + 1).select("window_id", "size", "k", F.col("prefix.offset").alias("offset"), F.col("prefix.key").alias("key"))
    start = F.col("pos") - F.col("offset")
    # Positional bound: the window begins within the text. Length bound: it also ends there.
    fits = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    candidates = found.select("uid", "pos", "key", "n_words").join(prefix, "key").where(fits).select("uid", start.alias("start"), "window_id", "size", "k").distinct()
    wanted = candidates.join(keyed_parts.select("window_id", "offset", "shingle"), "window_id").select("uid", "window_id", "start", "size", "k", (F.col("start") + F.col("offset")).alias("pos"), F.col("shingle").alias("gram"))
    held = found.select("uid", "pos", "gram").distinct()
    # The words themselves are compared, all of the window.
    whole = wanted.join(held, ["uid", "pos", "gram"]).groupBy("uid", "window_id", "start").agg(F.count("*").alias("met"), F.first("size").alias("size"), F.first("k").alias("k"))
    confirmed = staged(whole.where(F.col("met") == F.col("size") - F.col("k") + 1).select("uid", "window_id", "start", "size"), "confirmed")
    # Runs of hit words: a place that no earlier window of the document reaches begins one.
    by_start = Window.partitionBy("uid").orderBy("start")
    places = confirmed.groupBy("uid", "start").agg(F.max(F.col("start") + F.col("size")).alias("stop"))
    reached = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    runs = places.withColumn("fresh", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int")).withColumn("run", F.sum("fresh").over(by_start))
    runs = runs.groupBy("uid", "run").agg(F.struct(F.min("start").alias("from"), F.max("stop").alias("to")).alias("span"))
    spans = runs.groupBy("uid").agg(F.array_sort(F.collect_list("span")).alias("hit_spans"))
    empty = F.array().cast("array<struct<from:int,to:int>>")
    hits = confirmed.select("uid", "window_id").distinct().join(windows.select("window_id", F.col("item_id").cast("string").alias("item")), "window_id").groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = lengths.join(spans, "uid", "left").join(hits, "uid", "left")
    hit = F.aggregate(F.coalesce("hit_spans", empty), F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select(
        F.shiftright("uid", bits).alias("doc_id"), "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), F.coalesce("hit_spans", empty).alias("hit_spans")
    )
