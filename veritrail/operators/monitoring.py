"""Throughput and lengths by event-time window, from partials that merge.

A partial is a row for each window and value of `by`: whole-number sums and a KLL quantile sketch of the response lengths, of some K numbers
whatever the number of rows. Partials of streams, of several logs or of smaller windows merge into those of larger ones: sums stay
exact, and a quantile's rank is off by at most ERROR of the rows, with a chance of 99 in 100, merged or not; with at most K rows it is exact.

A stream writes a window's partial once, when the watermark passes its end; rows that come later still are left out of it.

Edge cases: rows without an event time are in no window. A null length counts as a row, but not in sums or quantiles; a window of such rows alone has null quantiles. No rows give no windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veritrail.operators.gates import truncated

K = 800  #: size of a sketch
ERROR = 0.005  #: of ranks; some 2.3 / K ** 0.9 at K
SUMS = ("samples", "tokens", "truncated", "errors")


def partials(rows: DataFrame, every: str = "1 hour", by: Sequence[str] = ("task_kind",), at: str = "created_at") -> DataFrame:
    """rows, batch or stream -> (start, end, by, samples, tokens, truncated, errors, most_tokens, sketch)."""
    grouped = rows.groupBy(F.window(at, every), *by).agg(
        F.count("*").alias("samples"), F.coalesce(F.sum(F.col("response_tokens").cast("long")), F.lit(0)).alias("tokens"), F.count_if(truncated()).alias("truncated"),
        F.count("error_type").alias("errors"), F.max(F.col("response_tokens").cast("long")).alias("most_tokens"), F.kll_sketch_agg_bigint(F.col("response_tokens").cast("long"), K).alias("sketch"),
    )
    return grouped.select("window.start", "window.end", *by, *SUMS, "most_tokens", "sketch")


def merged(parts: DataFrame, every: str | None = None, by: Sequence[str] = ("task_kind",)) -> DataFrame:
    """Partials of the same windows as one each, or of the larger windows that they lie in."""
    if every:
        window = F.window("start", every)
        parts = parts.withColumn("w", window).withColumns({"start": F.col("w.start"), "end": F.col("w.end")})
    return parts.groupBy("start", "end", *by).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("most_tokens").alias("most_tokens"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def report(parts: DataFrame, by: Sequence[str] = ("task_kind",), quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Of merged partials: sums, rows and tokens a second, and lengths at quantiles."""
    seconds = F.unix_timestamp("end") - F.unix_timestamp("start")
    some = F.kll_sketch_get_n_bigint("sketch") > 0
    lengths = [F.when(some, F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q)))).alias(f"tokens_p{q * 100:g}".replace(".", "_")) for q in quantiles]
    return parts.select("start", "end", *by, *SUMS, "most_tokens", (F.col("samples") / seconds).alias("samples_per_second"), (F.col("tokens") / seconds).alias("tokens_per_second"), *lengths)


def start(rows: DataFrame, path: str, checkpoint: str, every: str = "1 hour", delay: str = "10 minutes", by: Sequence[str] = ("task_kind",), at: str = "created_at", trigger: dict | None = None) -> StreamingQuery:
    """Write the partials of a stream's windows to path, Parquet, each once its end is `delay` behind the newest row."""
    out = partials(rows.withWatermark(at, delay), every, by, at)
    return out.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
