"""Queries of training-data preparation in the core: evaluation items, weighted datasets and monitoring; and their SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.operators import contamination, exact, mixture, monitoring
from veritrail.plans import registry
from veritrail.sources import configs
from veritrail.sources.shared import new_path
from veritrail.streaming import gate as stream


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contamination_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stretch of a document that is taken from items, and which."""
    done = contamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    span = done.select("doc_id", F.inline("removed"))
    return span.select("doc_id", "start", "end", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


def contamination_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal matches with their places in document and item."""
    docs = table(spark, sf_dir, "documents")
    found = contamination.matches(docs.select(F.col("doc_id").alias("key"), "text"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("key").alias("doc_id"), "item_id", "start", "end", "item_start")


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its stretches of items."""
    done = contamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select("doc_id", F.size("removed").alias("n_spans"), F.sha2(F.encode("cleaned", "UTF-8"), 256).alias("cleaned_sha256"))


def exact_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly rounded sums and means by return flag."""
    columns = ("l_discount", "l_tax", "l_quantity")
    done = exact.sums(exact.partials(table(spark, sf_dir, "lineitem"), columns, ("l_returnflag",)), ("l_returnflag",))
    return done.select("l_returnflag", F.col("column").alias("name"), "n", "sum", "mean")


def streaming_gate_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions stay open; the rows come newest versions last, but for one in fifty, which is late unless its version is still open."""
    rows = registry.trajectories(spark, sf_dir).withColumns({"year": F.col("policy_version"), "policy_version": F.when(F.col("response_tokens") == 50, F.col("policy_version") - 4).otherwise(F.col("policy_version"))})
    path = new_path(spark, "versions")
    years = [r.year for r in rows.select("year").distinct().orderBy("year").collect()]  # a few
    for year in years:  # a file each, older ones first, as the stream takes them by time
        rows.filter(F.col("year") == year).drop("year").coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    state = new_path(spark, "gate-state")
    stream.start(source, state, new_path(spark, "gate-checkpoint"), keep=1).awaitTermination()
    report = registry.report_columns(stream.report(spark, state))
    return report.withColumn("late", F.lit(stream.late_rows(spark, state)).cast("bigint"))


def weighted(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    """Three tables written as datasets, with the weights and splits of a configuration file that names them."""
    path = new_path(spark, "datasets")
    split = lambda c: F.when(F.col(c) % 10 == 0, "test").otherwise("train").alias("split")
    table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("id"), split("o_orderkey")).write.parquet(f"{path}/orders.parquet")
    table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("id"), split("p_partkey")).write.json(f"{path}/part.jsonl")
    table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("id")).write.parquet(f"{path}/customer.parquet")
    names = {"orders.parquet": 3.0, "part.jsonl": 1.5, "customer.parquet": 0.5}
    config = {
        "name": "mixed", "platform": {"accelerator": "cuda", "nodes": 1, "gpus_per_node": 8, "container": "c", "account": "a", "partition": "p"}, "backend": {"repo_path": "r", "commit": "c"}, "model": {"name_or_path": "m"}, "task": {"kind": "math"},
        "datasets": [{"path": f"{path}/{n}", "weight": w} for n, w in names.items()], "rollout": {"engines": 4}, "training": {"learner_gpus_per_node": [4]}, "output": {"directory": "o", "rollout_directory": "r", "experiment_name": "e"},
    }
    spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(f"{path}/configuration")
    found = configs.read(spark, f"{path}/configuration", "yaml").filter(F.size("problems") == 0).first()
    sets = mixture.of_configuration(spark, found.datasets)
    return mixture.mixture(sets, F.md5(F.col("id").cast("string").cast("binary")), until).select("dataset", "dataset_row", "place", "id")


def dataset_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three datasets by weight, two of them by split, up to where one has no more."""
    return weighted(spark, sf_dir, "first")


def dataset_mixture_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same to the end of all."""
    return weighted(spark, sf_dir, "all")


EVERY = 30  #: days


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_shipdate").cast("timestamp").alias("created_at"), F.when(F.col("l_suppkey") % 3 == 0, "code").otherwise("math").alias("task_kind"), F.col("l_extendedprice").cast("bigint").alias("response_tokens"),
        F.lit(50_000).alias("max_response_tokens"), F.when(F.col("l_discount") > 0.095, "timeout").alias("error_type"))


def with_rank_errors(report: DataFrame, rows: DataFrame, every: str) -> DataFrame:
    """Whether each window's median and 90th percentile are within the sketch's error of the exact ranks."""
    named = rows.select(F.window("created_at", every)["start"].alias("start"), "task_kind", "response_tokens")
    ranks = named.join(report.select("start", "task_kind", "samples", "tokens_p50", "tokens_p90"), ["start", "task_kind"]).groupBy("start", "task_kind").agg(
        *[F.struct(F.count_if(F.col("response_tokens") < F.col(c)).alias("lo"), F.count_if(F.col("response_tokens") <= F.col(c)).alias("hi"), F.first("samples").alias("n")).alias(c) for c in ("tokens_p50", "tokens_p90")]
    )
    near = lambda c, q: (F.col(f"{c}.lo") <= F.ceil((q + monitoring.ERROR) * F.col(f"{c}.n"))) & (F.col(f"{c}.hi") >= F.floor((q - monitoring.ERROR) * F.col(f"{c}.n")))
    good = ranks.select("start", "task_kind", near("tokens_p50", 0.5).alias("p50_within"), near("tokens_p90", 0.9).alias("p90_within"))
    columns = ("task_kind", "samples", "tokens", "truncated", "errors", "most_tokens", F.round("tokens_per_second", 6).alias("tokens_per_second"), "p50_within", "p90_within")
    return report.join(good, ["start", "task_kind"]).select(F.unix_timestamp("start").alias("start"), *columns)


def monitoring_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of five days, stored, and merged into windows of thirty."""
    rows = shipped(spark, sf_dir)
    path = new_path(spark, "monitoring")
    monitoring.partials(rows, f"{EVERY // 6} days").write.parquet(path)
    report = monitoring.report(monitoring.merged(spark.read.parquet(path), f"{EVERY} days"))
    return with_rank_errors(report, rows, f"{EVERY} days")


def monitoring_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that a stream has closed: those that end twenty days before the newest row, or earlier."""
    path = new_path(spark, "shipped")
    shipped(spark, sf_dir).write.parquet(path)
    rows = spark.read.parquet(path)
    out = new_path(spark, "windows")
    monitoring.start(spark.readStream.schema(rows.schema).parquet(path), out, new_path(spark, "windows-checkpoint"), f"{EVERY} days", "20 days").awaitTermination()
    return with_rank_errors(monitoring.report(monitoring.merged(spark.read.parquet(out))), rows, f"{EVERY} days")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (contamination_spans, contamination_matches, decontaminated, exact_means, streaming_gate_closed, dataset_mixture, dataset_mixture_all, monitoring_windows, monitoring_stream)
}

#: All windows of both sides against each other by equality, without an index, rarity order or islands of the document.
_MATCHES = f"""d AS (SELECT doc_id, regexp_extract_all(lower(text), '{contamination.WORD}') AS w FROM documents),
  i AS (SELECT min(item_id) AS item_id, w FROM (SELECT item_id, regexp_extract_all(lower(text), '{contamination.WORD}') AS w FROM benchmark) x WHERE len(w) > 0 GROUP BY w),
  s AS (SELECT DISTINCT least({contamination.N}, len(w)) AS size FROM i),
  iw AS (SELECT item_id, size, p AS q, array_to_string(w[p + 1:p + size], ' ') AS gram FROM i JOIN s ON size = least({contamination.N}, len(w)), LATERAL unnest(range(len(w) - size + 1)) r(p)),
  dw AS (SELECT doc_id, size, p AS place, array_to_string(w[p + 1:p + size], ' ') AS gram FROM d, s, LATERAL unnest(range(greatest(0, len(w) - size + 1))) r(p)),
  rare AS (SELECT size, gram, count(*) <= {contamination.MOST} AS rare FROM iw GROUP BY ALL),
  j AS (SELECT doc_id, item_id, size, place, place - q AS diagonal, rare FROM dw JOIN iw USING (size, gram) JOIN rare USING (size, gram)),
  c AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id, item_id, size, diagonal ORDER BY place) AS chain FROM j),
  m AS (SELECT doc_id, item_id, CAST(min(place) AS INT) AS "start", CAST(max(place) + size AS INT) AS "end", CAST(min(place) - diagonal AS INT) AS item_start
    FROM c GROUP BY doc_id, item_id, size, diagonal, chain HAVING bool_or(rare))"""
_SPANS = f"""{_MATCHES}, o AS (SELECT *, max("end") OVER (PARTITION BY doc_id ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM m),
  n AS (SELECT *, sum(CASE WHEN "start" <= reached THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS span FROM o),
  z AS (SELECT doc_id, min("start") AS "start", max("end") AS "end", array_to_string(list_sort(list_distinct(list(item_id))), ',') AS items FROM n GROUP BY doc_id, span)"""

#: These columns are whole numbers of 2^-60, whose sums fit 128 bits: rounded to 53 bits, ties to even, by whole-number steps.
_EXACT = """v AS (SELECT l_returnflag, 'l_discount' AS name, l_discount AS x FROM lineitem UNION ALL SELECT l_returnflag, 'l_tax', l_tax FROM lineitem UNION ALL SELECT l_returnflag, 'l_quantity', l_quantity FROM lineitem),
  u AS (SELECT l_returnflag, name, count(x) AS n, sum(CAST(x * 1152921504606846976.0 AS HUGEINT)) AS s FROM v GROUP BY ALL),
  b AS (SELECT *, CAST(greatest(0, len(ltrim(bin(s), '0')) - 53) AS INT) AS k FROM u),
  h AS (SELECT *, s // p AS q, s % p AS r, p FROM (SELECT *, CAST(pow(2, k) AS HUGEINT) AS p FROM b) x),
  f AS (SELECT *, q + CASE WHEN 2 * r > p OR (2 * r = p AND q % 2 = 1) THEN 1 ELSE 0 END AS m FROM h),
  e AS (SELECT l_returnflag, name, n, CAST(CAST(m AS BIGINT) AS DOUBLE) * pow(2.0, k - 60) AS sum FROM f)"""

_MIXED = """s AS (SELECT 1 AS k, 'orders' AS dataset, o_orderkey AS id, 1 AS stride FROM orders WHERE o_orderkey % 10 > 0 UNION ALL SELECT 2, 'part', p_partkey, 2 FROM part WHERE p_partkey % 10 > 0 UNION ALL SELECT 3, 'customer', c_custkey, 6 FROM customer),
  i AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY md5(CAST(id AS VARCHAR))) - 1 AS dataset_row FROM s),
  t AS (SELECT *, (2 * dataset_row + 1) * stride AS time FROM i),
  m AS (SELECT dataset, k, dataset_row, time, row_number() OVER (ORDER BY time, k) - 1 AS place, id FROM t),
  o AS (SELECT k, (2 * count(*) + 1) * any_value(stride) AS time FROM s GROUP BY k)"""
_SECONDS = 86400 * EVERY
_WINDOWS = f"""SELECT CAST(floor(epoch(l_shipdate) / {_SECONDS}) * {_SECONDS} AS BIGINT) AS start, CASE WHEN l_suppkey % 3 = 0 THEN 'code' ELSE 'math' END AS task_kind, count(*) AS samples, CAST(sum(trunc(l_extendedprice)) AS BIGINT) AS tokens,
  count(*) FILTER (trunc(l_extendedprice) >= 50000) AS truncated, count(*) FILTER (l_discount > 0.095) AS errors, CAST(max(trunc(l_extendedprice)) AS BIGINT) AS most_tokens,
  round(sum(trunc(l_extendedprice)) / {_SECONDS}, 6) AS tokens_per_second, true AS p50_within, true AS p90_within FROM lineitem GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "dataset_mixture": f"WITH {_MIXED} SELECT dataset, dataset_row, place, id FROM m WHERE (time, k) < (SELECT min((time, k)) FROM o)",
    "dataset_mixture_all": f"WITH {_MIXED} SELECT dataset, dataset_row, place, id FROM m",
    "monitoring_windows": _WINDOWS,
    "monitoring_stream": f"SELECT * FROM ({_WINDOWS}) w WHERE start + {_SECONDS} <= (SELECT max(epoch(l_shipdate)) FROM lineitem) - 20 * 86400",
    "exact_means": f'WITH {_EXACT} SELECT l_returnflag, name, n, "sum", "sum" / n AS mean FROM e',
    "streaming_gate_closed": registry._report("WHERE NOT (CAST(l_quantity AS INT) = 50 AND year(l_shipdate) > (SELECT min(year(l_shipdate)) FROM lineitem))")
    .replace("year(l_shipdate) AS policy_version", "year(l_shipdate) - CASE WHEN CAST(l_quantity AS INT) = 50 THEN 4 ELSE 0 END AS policy_version")
    .replace("FROM a JOIN z ON true", ", (SELECT count(*) FROM lineitem WHERE CAST(l_quantity AS INT) = 50 AND year(l_shipdate) >= (SELECT min(year(l_shipdate)) FROM lineitem) + 1) AS late FROM a JOIN z ON true"),
    "contamination_matches": f"WITH {_MATCHES} SELECT * FROM m",
    "contamination_spans": f'WITH {_SPANS} SELECT doc_id, "start", "end", items FROM z',
    "decontaminated": f"""WITH {_SPANS}, t AS (SELECT doc_id, text, regexp_extract_all(text, '{contamination.SPACED_WORD}') AS w FROM documents),
      g AS (SELECT doc_id, count(*) AS n, list(range("start", "end")) AS gone FROM z GROUP BY doc_id),
      k AS (SELECT t.doc_id, text, n, list_filter(w, lambda x, p: NOT list_contains(flatten(gone), p - 1)) AS w FROM t JOIN g USING (doc_id)),
      e AS (SELECT doc_id, CAST(n AS INT) AS n_spans, concat(array_to_string(w, ''), regexp_extract(text, '[\\x20\\x09-\\x0D]*$')) AS cleaned FROM k)
      SELECT t.doc_id, coalesce(n_spans, 0) AS n_spans, sha256(coalesce(cleaned, text)) AS cleaned_sha256 FROM t LEFT JOIN e USING (doc_id)""",
}
