"""Exact sums against the standard library's, in any partitioning."""

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veritrail.operators import exact, gates

SCHEMA = "k int, x double, y double"


def sums(df, by=("k",)):
    return {(*[r[b] for b in by], r.column): (r.n, r.sum, r.mean) for r in exact.sums(exact.partials(df, ("x", "y"), by), by).collect()}


def test_three_tenths(spark):
    df = spark.createDataFrame([(1, 0.1, None)] * 3 + [(2, -0.0, 5e-324)], SCHEMA)
    assert sums(df) == {(1, "x"): (3, math.fsum([0.1] * 3), statistics.fmean([0.1] * 3)), (2, "x"): (1, 0.0, 0.0), (2, "y"): (1, 5e-324, 5e-324)}

    nearest = {r.column: r.nearest_mean for r in exact.sums(exact.partials(df.filter("k = 1"), ("x",))).collect()}
    assert nearest == {"x": 0.1}


def test_any_partitioning(spark):
    """Cancelling, tiny, huge and ordinary values: one result whatever the order, merged in one step or two."""
    r = random.Random(4)
    rows = [(k % 3, r.choice([1e300, -1e300, 1e16, 1.0, -1e16, 5e-324, 2.2e-308, 0.1]) * r.random(), r.uniform(-1, 1)) for k in range(4000)]
    want = {(g, c): [row[i] for row in rows if row[0] == g] for g in range(3) for c, i in (("x", 1), ("y", 2))}
    df = spark.createDataFrame(rows, SCHEMA)
    for n in (1, 3, 16):
        got = sums(df.repartition(n))
        assert {k: v[1] for k, v in got.items()} == {k: math.fsum(v) for k, v in want.items()}
        assert {k: v[2] for k, v in got.items()} == {k: math.fsum(v) / len(v) for k, v in want.items()}
    parts = exact.partials(df, ("x", "y"), ("k",))
    twice = exact.merged(parts.unionByName(parts), ("k",))
    assert {r.column: r.sum for r in exact.sums(twice.filter("k = 0"), ("k",)).collect()} == {c: 2 * math.fsum(want[0, c]) for c in ("x", "y")}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64).filter(lambda x: abs(x) < 1e305), min_size=1, max_size=40))
def test_fsum(spark, values):
    df = spark.createDataFrame([(1, x, None) for x in values], SCHEMA)
    assert sums(df)[1, "x"][1] == math.fsum(values)


@pytest.mark.parametrize(("odd", "want"), [([math.inf], math.inf), ([math.inf, -math.inf], math.nan), ([math.nan], math.nan), ([1.7e308, 1.7e308], math.inf), ([-1.7e308, -1.7e308], -math.inf)])
def test_not_finite(spark, odd, want):
    got = sums(spark.createDataFrame([(1, x, 1.0) for x in [*odd, 0.5]], SCHEMA))[1, "x"][1]
    assert got == want or math.isnan(got) and math.isnan(want)


def test_gate_means_are_exact(spark):
    base = spark.range(3).select(F.lit("t").alias("task_id"), F.lit("math").alias("task_kind"), F.lit(1).alias("policy_version"), F.lit(1).alias("learner_version"), F.lit(0.1).alias("reward"),
        F.lit(1).alias("response_tokens"), F.lit(2).alias("max_response_tokens"), F.lit(None).cast("string").alias("error_type"), F.lit(0.1).alias("entropy"))
    r = gates.gate_report(base).first()
    assert (r.mean_reward, r.mean_entropy) == (statistics.fmean([0.1] * 3),) * 2
    null = gates.gate_report(base.withColumn("task_kind", F.lit(None).cast("string")), by=("task_kind",)).first()
    assert (null.task_kind, null.mean_reward) == (None, r.mean_reward)
    assert exact.sums(exact.partials(base.limit(0), ("reward",))).count() == 0
