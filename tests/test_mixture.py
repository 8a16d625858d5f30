"""Weighted orders: no gap, weights kept by every prefix; and windows of throughput."""

import math

import pytest
from pyspark.sql import functions as F

from veritrail.operators import mixture, monitoring


def sets(spark, sizes, weights):
    return [mixture.Dataset(f"d{k}", spark.range(n).select("id", F.lit("x").alias("split"), F.lit(k).alias("place")), w) for k, (n, w) in enumerate(zip(sizes, weights, strict=True))]


@pytest.mark.parametrize(("sizes", "weights"), [((300, 200, 100), (3.0, 1.5, 0.5)), ((50, 50), (0.3333, 1.0)), ((40, 400, 7, 90), (1, 10, 0.2, 2.7)), ((20,), (1.0,)), ((30, 0), (1.0, 1.0))])
def test_prefixes(spark, sizes, weights):
    key = F.xxhash64("id")
    rows = mixture.mixture(sets(spark, sizes, weights), key, "all").orderBy("place").collect()
    assert [r.place for r in rows] == list(range(sum(sizes)))
    for k, n in enumerate(sizes):
        assert [r.dataset_row for r in rows if r.dataset == f"d{k}"] == list(range(n))
    first = mixture.mixture(sets(spark, sizes, weights), key).orderBy("place").collect()
    assert first == rows[: len(first)]
    have, total = [0] * len(sizes), sum(weights)
    for n, r in enumerate(first, 1):
        have[int(r.dataset[1:])] += 1
        assert all(abs(h - n * w / total) <= mixture.MOST_OFF * max(1, len(sizes) - 1) for h, w in zip(have, weights, strict=True))
    assert any(h == n for h, n in zip(have, sizes, strict=True))  # it ends as one has no more


def test_split_and_ties(spark):
    rows = spark.createDataFrame([(1, "a", "train"), (1, "b", "train"), (2, "c", "test")], "id long, text string, split string")
    got = mixture.mixture([mixture.Dataset("m", rows, split="train"), mixture.Dataset("n", rows, split="test")], F.col("id"), "all").collect()
    assert sorted((r.dataset, r.text) for r in got) == [("m", "a"), ("m", "b"), ("n", "c")] and sorted(r.place for r in got) == [0, 1, 2]
    with pytest.raises(ValueError):
        mixture.mixture([mixture.Dataset("m", rows, 0.00001)], F.col("id"))


def test_windows(spark):
    rows = [(f"2024-01-01 00:{m:02d}:00", "math", m * 10 if m % 7 else None, 300, "x" if m % 5 == 0 else None) for m in range(60)] + [(None, "math", 5, 300, None), ("2024-01-01 03:00:00", "code", None, 300, None)]
    df = spark.createDataFrame(rows, "at string, task_kind string, response_tokens int, max_response_tokens int, error_type string").withColumn("created_at", F.col("at").cast("timestamp"))
    parts = monitoring.partials(df, "10 minutes").unionByName(monitoring.partials(df, "5 minutes").limit(0))
    got = {r.task_kind: r for r in monitoring.report(monitoring.merged(parts, "1 hour")).collect()}
    lengths = sorted(m * 10 for m in range(60) if m % 7)
    m = got["math"]
    assert (m.samples, m.tokens, m.errors, m.most_tokens, m.truncated) == (60, sum(lengths), 12, 590, sum(x >= 300 for x in lengths))
    assert m.tokens_p50 == lengths[math.ceil(len(lengths) * 0.5) - 1] and m.tokens_per_second == sum(lengths) / 3600
    assert (got["code"].samples, got["code"].tokens, got["code"].tokens_p50) == (1, 0, None) and set(got) == {"math", "code"}
    assert monitoring.report(monitoring.merged(monitoring.partials(df.limit(0)))).count() == 0
