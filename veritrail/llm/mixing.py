"""Mixing sources to target weights by hash-threshold histograms.

A document's place in its source is a hash of its id, so the documents below a threshold are nested
samples: a larger budget takes the same ones and more. Sizes are summed by source and leading hash
bits; only the bucket in which the budget runs out is split again, three times ten bits in all. What
remains undecided is a billionth of a source, taken if that comes nearer to the target. No sort.

A source whose target passes its size is taken whole as often as it fits, and the rest by threshold.

Edge cases: a null or empty text has size 0; a null source is a source of its own, last in the order.
A source without words has target 0 and takes nothing. Rows with the same id share their hash: all are
taken or none. An empty table gives an empty table. Further columns are kept by mix() and ignored by
plan_mix().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import free_name, n_words, settle

MOST = 3  #: a target stops at this many times its source's size
CYCLE = 3  #: weights 1, 2, 3, repeating
LEVELS, LEVEL_BITS, HASH_BITS = 3, 10, 60
#: Source tables up to this many rows are broadcast (some 100 bytes a row); larger ones are joined.
BROADCAST_SOURCES = 100_000


def place(doc_id: Column) -> Column:
    """60 bits of the id's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def key_of(source: Column) -> Column:
    """A source as a key that is never null: null itself is "~", others get a leading "s"."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("~"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source_key, source_size) -> the same with target double, copies long, need double.

    Water filling: with sources in order of cap by weight, those are capped whose even share of what is
    left reaches their cap. All comparisons are between integers. One row for each source passes here.
    """
    order = Window.orderBy("source_key")  # "s..." by code point, "~" for null after them
    ranked = sizes.withColumn("w", (F.pmod(F.row_number().over(order) - 1, F.lit(CYCLE)) + 1).cast("long"))
    ranked = ranked.withColumn("cap", F.col("source_size") * MOST)
    fill = Window.orderBy(F.col("cap") / F.col("w"), "source_key")
    all_rows = Window.partitionBy()
    ranked = ranked.withColumns(
        {
            "total": F.sum("source_size").over(all_rows),
            "before": F.sum("cap").over(fill) - F.col("cap"),
            "rest": F.sum("w").over(all_rows) - F.sum("w").over(fill) + F.col("w"),
        }
    ).withColumn("open", (F.col("total") - F.col("before")) * F.col("w") < F.col("cap") * F.col("rest"))
    # of the open ones the first in order has the largest rest
    first = F.max(F.when(F.col("open"), F.struct("rest", "before"))).over(all_rows)
    ranked = ranked.withColumn("level", first)
    level = (F.col("total") - F.col("level.before")).cast("double") * F.col("w") / F.col("level.rest")
    target = F.when(F.col("open"), level).otherwise(F.col("cap").cast("double"))
    copies = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    return ranked.select("source_key", "source_size", target.alias("target"), copies.alias("copies")).withColumn(
        "need", F.when(F.col("source_size") > 0, F.col("target") - F.col("copies") * F.col("source_size")).otherwise(0.0)
    )


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(source_key, ..., copies, threshold): a document is taken once more if its place is below threshold.

    sized: (source_key, size, h). The state after each level: the prefix of the boundary bucket and what is
    still needed from it. At most 1,024 rows a source reach a window.
    """
    state = goals.withColumns({"prefix": F.lit(0).cast("long"), "left": F.col("need")})
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        cut = F.shiftright("h", shift)
        part = sized.withColumns({"prefix": F.shiftright(F.col("h"), shift + LEVEL_BITS), "bucket": cut})
        if level:
            part = part.join(small(state.select("source_key", "prefix")), ["source_key", "prefix"])
        sums = part.groupBy("source_key", "prefix", "bucket").agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("source_key", "prefix").orderBy("bucket"))
        sums = sums.withColumn("upto", upto)
        found = (
            state.drop("n").join(sums, ["source_key", "prefix"], "left")
            .groupBy("source_key", "source_size", "target", "copies", "need")
            .agg(
                F.min(F.when(F.col("upto") > F.col("left"), F.struct("bucket", "n", "upto"))).alias("b"),
                F.max("left").alias("left"),
                F.max("prefix").alias("prefix"),
            )
        )
        state = found.select(
            "source_key", "source_size", "target", "copies", "need",
            F.coalesce(F.col("b.bucket"), F.shiftleft(F.col("prefix"), LEVEL_BITS)).alias("prefix"),
            F.coalesce(F.col("left") - (F.col("b.upto") - F.col("b.n")), F.lit(0.0)).alias("left"),
            F.coalesce(F.col("b.n"), F.lit(0)).alias("n"),
        )
        state = settle(state, f"mix-level{level}")
    nearer = (F.col("left") * 2 > F.col("n")).cast("long")  # the last bucket, whole or not
    last = HASH_BITS - LEVEL_BITS * LEVELS
    return state.withColumn("threshold", F.shiftleft(F.col("prefix") + nearer, last)).drop("prefix", "left", "n")


def small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if it is small enough for one."""
    return F.broadcast(df) if df.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else df


def plan_mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source_key, size, h) of every document, and the plan of every source."""
    sized = settle(
        docs.select("doc_id", key_of(F.col("source")).alias("source_key"), n_words(F.col("text")).alias("size"), place(F.col("doc_id")).alias("h")),
        "mix-sizes",
    )
    goals = settle(targets(sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))), "mix-goals")
    return sized, thresholds(sized, goals)


def times_taken() -> Column:
    return F.col("copies") + (F.col("h") < F.col("threshold")).cast("long")


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    sized, plan = plan_mix(docs)
    return sized.join(small(plan), "source_key").select("doc_id", "size", "source_size", "target", (F.col("size") * times_taken()).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows that the mix takes, repeats as repeated rows, with the columns of docs."""
    _, plan = plan_mix(docs)
    key, h, n = (free_name(docs, x) for x in ("key", "h", "n"))
    plan = plan.select(F.col("source_key").alias(key), F.col("copies").alias(f"{n}c"), F.col("threshold").alias(f"{n}t"))
    rows = docs.withColumns({key: key_of(F.col("source")), h: place(F.col("doc_id"))}).join(small(plan), key)
    times = (F.col(f"{n}c") + (F.col(h) < F.col(f"{n}t")).cast("long")).cast("int")
    rows = rows.withColumn(n, times).filter(F.col(n) > 0)
    return rows.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])
