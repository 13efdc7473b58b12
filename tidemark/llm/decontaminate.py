"""Benchmark decontamination by winnowing; DataFrame functions only.

Words are runs of characters other than the ASCII ones that are no letters or digits, A-Z lower-cased. A window is
``WINDOW`` consecutive words of an item; an item of fewer words is one window. Of every WINDOW - GRAM + 1 consecutive
GRAM-word hashes the smallest is a fingerprint, so a document and an item that share a window share a fingerprint.

1. Documents' fingerprints are joined with the items'. Documents without a common one are done.
2. Each common fingerprint is extended to the windows around it, and these are joined with the items' windows by their
   words, so hits are exact.
3. Items shorter than WINDOW words have no fingerprint of that many words: the documents' word sequences of their lengths
   (WINDOW - 1 at most) are hashed in one pass, and those that an item's hash allows are joined with the items' by two
   independent 64-bit hashes. Up to ``short_in_plan`` such hashes stand in the plan itself, so that a sequence becomes a row
   only if it is a hit; more are met by a join.
4. Windows that are in the same items share one item set, and documents that meet the same sets one list of items, so a
   window in many items and documents isn't multiplied out.

The items' side of a join is broadcast if its counted rows are at most ``broadcast_rows``; beyond that the join shuffles
on the hash or the words, where AQE splits skewed partitions. No pairs of documents are made. A row of the result per row
of ``docs``: rows are told apart by (doc_id, hash of the text), so repeated doc_ids with different texts keep their own
results. Null text has no words; null doc_id is kept; a null item_id counts as an item with an empty id; empty tables
give no rows, or no hits. Other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

WINDOW = 10
GRAM = 6
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of an items' table up to which it is broadcast: under 50 MB of hashes, or of windows.
BROADCAST_ROWS = 500_000
#: Hashes of short items up to which they stand in the plan.
SHORT_IN_PLAN = 10_000


def words(text: Column) -> Column:
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(lower, F.lit("")), SEPARATORS), "")


def _runs(n: Column, length: int) -> Column:
    """1, 2, ... for each run of ``length`` among n things; empty if there is none."""
    return F.when(n >= length, F.sequence(F.lit(1), n - (length - 1))).otherwise(F.array().cast("array<int>"))


def gram_hashes(w: Column, n: Column) -> Column:
    return F.transform(_runs(n, GRAM), lambda i: F.xxhash64(F.slice(w, i, GRAM)))


def fingerprints(grams: Column, n: Column, window: int = WINDOW) -> Column:
    span = window - GRAM + 1
    return F.array_distinct(F.transform(_runs(n - (GRAM - 1), span), lambda i: F.array_min(F.slice(grams, i, span))))


def _with_grams(df: DataFrame, *keep: str) -> DataFrame:
    df = df.select(*keep, words(F.col("text")).alias("w"))
    df = df.select(*keep, "w", F.size("w").alias("n"))
    return df.withColumn("g", gram_hashes(F.col("w"), F.col("n")))


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, window (words joined by a space, which no word holds), size."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w"))
    size = F.least(F.size("w"), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    rows = rows.where(F.size("w") > 0).select("item_id", "w", size.alias("size"), F.explode(starts).alias("s"))
    return rows.select("item_id", F.array_join(F.slice("w", F.col("s"), F.col("size")), " ").alias("window"), "size").distinct()


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= rows else df


def _short_hits(docs: DataFrame, short: DataFrame, broadcast_rows: int, short_in_plan: int) -> DataFrame | None:
    """(doc_id, h, start, size, window) of each occurrence of an item of fewer than WINDOW words."""
    sizes = [r["size"] for r in short.select("size").distinct().collect()]  # WINDOW - 1 at most
    if not sizes:
        return None
    hashes = lambda w: (F.xxhash64(w), F.xxhash64(F.lit(1), w))
    x, y = hashes(F.split("window", " "))
    short = stored(short.select("window", F.col("size").alias("size_2"), x.alias("x_2"), y.alias("y_2")), "short_windows")
    rows = docs.select("doc_id", "h", words(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    found = lambda size: lambda i: F.struct(i.alias("start"), F.lit(size).alias("size"), hashes(F.slice("w", i, size))[0].alias("x"))
    at = F.concat(*[F.transform(_runs(F.col("n"), size), found(size)) for size in sizes])
    if short.count() <= short_in_plan:
        known = [r["x_2"] for r in short.select("x_2").distinct().collect()]
        at = F.filter(at, lambda s: s["x"].isin(known))
    at = F.transform(at, lambda s: F.struct(s["start"], s["size"], s["x"], hashes(F.slice("w", s["start"], s["size"]))[1].alias("y")))
    rows = rows.select("doc_id", "h", F.explode(at).alias("s")).select("doc_id", "h", "s.*")
    same = (F.col("x") == F.col("x_2")) & (F.col("y") == F.col("y_2")) & (F.col("size") == F.col("size_2"))
    return rows.join(_small(short, broadcast_rows), same).select("doc_id", "h", "start", "size", "window")


def hits(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS, short_in_plan: int = SHORT_IN_PLAN) -> tuple[DataFrame, DataFrame]:
    """(doc_id, h, start, size, window) of each occurrence of a window; and (item_id, window, size) of all items."""
    windows = stored(item_windows(items), "item_windows")
    distinct = windows.select("window", "size").distinct()
    long_windows = _small(distinct.where(F.col("size") == WINDOW).select("window"), broadcast_rows)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))

    item_prints = _with_grams(items, "item_id").select(F.explode(fingerprints(F.col("g"), F.col("n"))).alias("fp")).distinct()
    prints = _with_grams(docs, "doc_id", "h").select("doc_id", "h", F.explode(fingerprints(F.col("g"), F.col("n"))).alias("fp"))
    common = prints.join(_small(item_prints, broadcast_rows), "fp").groupBy("doc_id", "h").agg(F.collect_set("fp").alias("fps"))
    common = stored(common, "common_fingerprints").withColumnsRenamed({"doc_id": "doc_id_2", "h": "h_2"})

    near = docs.join(common, F.col("doc_id").eqNullSafe(F.col("doc_id_2")) & (F.col("h") == F.col("h_2")))
    near = _with_grams(near, "doc_id", "h", "fps")
    # an array indexed inside a lambda would be made again for each element: it is the lambda's own argument here
    at = F.filter(F.transform("g", lambda x, i: F.when(F.array_contains("fps", x), i + 1)), lambda p: p.isNotNull())
    starts = near.where(F.col("n") >= WINDOW).select("doc_id", "h", "w", "n", at.alias("at"))
    around = F.transform("at", lambda i: F.filter(F.sequence(i - (WINDOW - GRAM), i), lambda s: (s >= 1) & (s <= F.col("n") - (WINDOW - 1))))
    starts = starts.select("doc_id", "h", "w", F.explode(F.array_distinct(F.flatten(around))).alias("start"))
    tried = starts.select("doc_id", "h", "start", F.lit(WINDOW).alias("size"), F.array_join(F.slice("w", F.col("start"), WINDOW), " ").alias("window"))
    found = tried.join(long_windows, "window").select("doc_id", "h", "start", "size", "window")
    short = _short_hits(docs, distinct.where(F.col("size") < WINDOW), broadcast_rows, short_in_plan)
    return (found if short is None else found.unionByName(short)), windows


def contamination(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS, short_in_plan: int = SHORT_IN_PLAN) -> DataFrame:
    """doc_id, n_words, n_hit (words inside any occurrence of a window), n_items, item_ids (sorted strings), items_sha256,
    contaminated, and h (hash of the text) for each row of ``docs``."""
    found, windows = hits(docs, items, broadcast_rows, short_in_plan)
    sets = windows.groupBy("window", "size").agg(F.sort_array(F.collect_set("item_id")).alias("ids")).withColumn("of", F.md5(F.to_json("ids")))
    sets = stored(sets, "item_sets")
    found = found.join(_small(sets.select("window", "size", "of"), broadcast_rows), ["window", "size"])
    covered = F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("start", "size")), lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))))
    hit = found.groupBy("doc_id", "h").agg(F.size(covered).cast("long").alias("n_hit"), F.sort_array(F.collect_set("of")).alias("sets"))
    hit = stored(hit.withColumn("listed", F.md5(F.array_join("sets", ","))), "hit_documents")
    one = hit.groupBy("listed").agg(F.first("sets").alias("sets")).select("listed", F.explode("sets").alias("of"))
    ids = sets.groupBy("of").agg(F.first("ids").alias("ids"))
    ids = one.join(ids, "of").select("listed", F.explode("ids").alias("item_id")).distinct().groupBy("listed").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    both = hit.join(ids, "listed").select(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h"), "n_hit", "item_ids")
    rows = docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), F.xxhash64("text").alias("h"))
    rows = rows.join(both, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("h") == F.col("hit_h")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"), "h",
    )


def clean(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` without any window of an item, their columns untouched."""
    bad = contamination(docs, items, broadcast_rows).where("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("h").alias("_bad_h")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs["text"]) == F.col("_bad_h")), "left_anti")
