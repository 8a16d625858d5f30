"""Evaluation items in documents: which words come from which items, and the documents without them.

A match is a stretch of words that a document and an item share, as long as it goes on, of at least n words (an item of fewer
words matches whole). It counts if one of its n-grams is rare: it occurs at most `most` times in all items; a phrase that
many items share is no evidence alone, but belongs to a match that goes on into it. Words are compared in lower case.

The items' n-grams form an inverted index (gram, item, place). Each document's n-grams meet the distinct grams of the index first, which
leaves next to nothing of clean text, and stands in the scan's own stage while the index is small. Of what is left, rare grams are joined with their
places, so no pair is made that rests on a common gram; then the neighbours of these seeds are joined along the diagonal (place in the document less place in
the item) within their stretch of the document, and chained by gaps. Equal texts are matched once, known by SHA-256.

Edge cases: a null text has no words and stays null; so does an item. Items alike in words count once, under their smallest id. Repeated rows each get their result. Empty tables on either
side remove nothing. An item whose id is null removes its words, but is not in the list of ids. Columns of documents called removed or cleaned are replaced, others kept. Texts of any length are taken whole; a text's matched places are in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.sources.shared import settle

N = 13
MOST = 64  #: occurrences in all items of a gram that is evidence
MOST_SENT = 500_000  #: grams that are broadcast; more are joined by shuffling
WORD = r"[^\x20\x09-\x0D]+"
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
TAIL = r"[\x20\x09-\x0D]*\z"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def windows(df: DataFrame, size: Column | int, *keys: str) -> DataFrame:
    """(keys, size, place, gram) of all stretches of size words of w."""
    size = size if isinstance(size, Column) else F.lit(size)
    last = F.size("w") - size
    grams = F.when((size > 0) & (last >= 0), F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice("w", i + 1, size), " ")))
    return df.select(*keys, size.alias("size"), F.posexplode(grams).alias("place", "gram"))


def index(items: DataFrame, n: int = N, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(item, size, at, gram) of items' n-grams, and (size, gram, rare) of distinct ones; both written. item holds the id, so that a null one joins too."""
    distinct = items.select("item_id", words("text").alias("w")).filter(F.size("w") > 0).groupBy("w").agg(F.struct(F.min("item_id").alias("item_id")).alias("item"))
    places = settle(windows(distinct, F.least(F.lit(n), F.size("w")), "item").withColumnRenamed("place", "at"), "index")
    return places, settle(places.groupBy("size", "gram").agg((F.count("*") <= most).alias("rare")), "grams")


def matches(texts: DataFrame, items: DataFrame, n: int = N, most: int = MOST) -> DataFrame:
    """texts (key, text), keys telling texts apart -> (key, item_id, start, end, item_start), in words from 0."""
    places, grams = index(items, n, most)
    split = texts.select("key", words("text").alias("w"))
    sizes = sorted(r.size for r in grams.select("size").distinct().collect())  # n of them at most
    if not sizes:
        return texts.select("key", F.lit(0).cast(items.schema["item_id"].dataType).alias("item_id"), *(F.lit(0).alias(x) for x in ("start", "end", "item_start"))).limit(0)
    each = [windows(split, size, "key") for size in sizes]
    known = F.broadcast(grams) if grams.count() <= MOST_SENT else grams
    hits = each[0]
    for more in each[1:]:
        hits = hits.unionByName(more)
    hits = hits.join(known, ["size", "gram"]).groupBy("key", "size", "place").agg(F.first("gram").alias("gram"), F.first("rare").alias("rare"))
    stretch = F.col("place") - F.row_number().over(Window.partitionBy("key", "size").orderBy("place"))
    hits = settle(hits.withColumn("stretch", stretch), "hits")
    seeds = hits.filter("rare").join(places, ["size", "gram"]).select("key", "size", "stretch", "item", (F.col("place") - F.col("at")).alias("diagonal")).distinct()
    near = seeds.join(hits, ["key", "size", "stretch"]).withColumn("at", F.col("place") - F.col("diagonal")).join(places, ["item", "size", "at", "gram"])
    line = Window.partitionBy("key", "item", "size", "diagonal").orderBy("place")
    chains = near.withColumn("chain", F.col("place") - F.row_number().over(line)).groupBy("key", "item", "size", "diagonal", "chain")
    found = chains.agg(F.min("place").alias("start"), F.max("place").alias("last"), F.max("rare").alias("rare")).filter("rare")
    return found.select("key", "item.item_id", "start", (F.col("last") + F.col("size")).alias("end"), (F.col("start") - F.col("diagonal")).alias("item_start"))


def spans(found: DataFrame) -> DataFrame:
    """Matches to (key, start, end, items): stretches that overlap or touch as one, with the ids of all their items, sorted."""
    order = Window.partitionBy("key").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    merged = marked.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("key", "span")
    return merged.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_set("item_id")).alias("items")).drop("span")


def decontaminate(docs: DataFrame, items: DataFrame, n: int = N, most: int = MOST) -> DataFrame:
    """docs with removed (array of start, end, items) and cleaned: the text without these words and the white space before each."""
    key = F.sha2(F.encode("text", "UTF-8"), 256)
    found = spans(matches(docs.select(key.alias("key"), "text"), items, n, most))
    by_text = settle(found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "items"))).alias("removed")), "spans")
    known = F.broadcast(by_text) if by_text.count() <= MOST_SENT // 10 else by_text
    rows = docs.drop("removed", "cleaned").select(F.struct("*").alias("row"), key.alias("key")).join(known, "key", "left")
    text = F.col("row.text")
    stays = lambda _, i: ~F.exists("removed", lambda s: (i >= s["start"]) & (i < s["end"]))
    kept = F.concat(F.array_join(F.filter(F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0)), stays), ""), F.regexp_extract(text, TAIL, 0))
    return rows.select("row.*", F.coalesce("removed", F.array().cast(by_text.schema["removed"].dataType)).alias("removed"), F.when(F.col("removed").isNull(), text).otherwise(kept).alias("cleaned"))
