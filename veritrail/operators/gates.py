"""Health gates over trajectories, and what else is computed by reward group.

Groups are reduced to a few partial sums, then all groups to one row: one shuffle. Means rest on exact sums, which take
a scan of their two columns and move a row for each exponent and task; so a report has the same bits however rows are dealt out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.operators import exact
from veritrail.sources.shared import settle

GROUP = ("task_id", "policy_version")
MOST_SENT = 1_000_000  #: group rows that are broadcast


@dataclass(frozen=True)
class Limits:
    """Fixed default limits."""

    max_zero_std_fraction: float = 0.80
    max_truncation_fraction: float = 0.15
    max_error_fraction: float = 0.02
    max_policy_lag: int = 4
    min_mean_reward: float | None = None


def truncated() -> Column:
    return F.col("response_tokens") >= F.col("max_response_tokens")


def policy_lag() -> Column:
    return F.greatest(F.lit(0), F.col("learner_version") - F.col("policy_version")).cast("bigint")


def flags(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"truncated": truncated(), "policy_lag": policy_lag(), "is_error": F.col("error_type").isNotNull()})


def reward_groups(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row for each task and policy version, of whatever run, and each value of by."""
    return rows.groupBy(*by, *GROUP).agg(
        F.count("*").alias("samples"), F.min("reward").alias("min_reward"), F.max("reward").alias("max_reward"),
        F.count_if(truncated()).alias("truncated"), F.count_if(F.col("error_type").isNotNull()).alias("errors"), F.max(policy_lag()).alias("max_policy_lag"),
    )


MEANS = ("reward", "entropy")


def totals(groups: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums over groups; totals of disjoint sets of groups merge."""
    return groups.groupBy(*by).agg(
        F.sum("samples").alias("samples"), F.count("*").alias("n_groups"), F.count_if(F.col("min_reward") == F.col("max_reward")).alias("zero_groups"),
        F.sum("truncated").alias("truncated"), F.sum("errors").alias("errors"), F.max("max_policy_lag").alias("max_policy_lag"),
    )


def figures(sums: DataFrame, parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Totals and exact partials of MEANS, whole or in parts -> the report's figures; parts are a few rows, so the join sends them."""
    c = lambda k: F.coalesce(F.sum(k), F.lit(0))
    share = lambda k, n, other: F.coalesce(F.try_divide(F.sum(k).cast("double"), F.sum(n).cast("double")), F.lit(other))
    merged = sums.groupBy(*by).agg(
        c("samples").alias("samples"), share("zero_groups", "n_groups", 1.0).alias("zero_std_fraction"), share("truncated", "samples", 0.0).alias("truncation_fraction"),
        share("errors", "samples", 0.0).alias("error_fraction"), F.coalesce(F.max("max_policy_lag"), F.lit(0)).cast("bigint").alias("max_policy_lag"), c("n_groups").alias("n_groups"),
    )
    means = exact.means(parts, MEANS, by).select(F.struct(*by, F.lit(0).alias("all")).alias("key"), *[f"mean_{k}" for k in MEANS])
    joined = merged.withColumn("key", F.struct(*by, F.lit(0).alias("all"))).join(means, "key", "left").drop("key")
    return joined.withColumn("mean_reward", F.coalesce("mean_reward", F.lit(0.0)))


def checks(limits: Limits) -> list[tuple[str, Column, float]]:
    """(code, observed, limit) in their fixed order; a limit itself passes."""
    out = [
        ("zero_std", F.col("zero_std_fraction"), limits.max_zero_std_fraction),
        ("truncation", F.col("truncation_fraction"), limits.max_truncation_fraction),
        ("errors", F.col("error_fraction"), limits.max_error_fraction),
        ("policy_lag", F.col("max_policy_lag").cast("double"), float(limits.max_policy_lag)),
    ]
    if limits.min_mean_reward is not None:
        out.append(("mean_reward", F.col("mean_reward"), limits.min_mean_reward))
    return out


def with_failures(report: DataFrame, limits: Limits) -> DataFrame:
    """failures: struct(code, observed, limit) each, unrounded; passed: none, and at least one sample."""
    each = [F.when((x < m) if code == "mean_reward" else (x > m), F.struct(F.lit(code).alias("code"), x.alias("observed"), F.lit(float(m)).alias("limit"))) for code, x, m in checks(limits)]
    none = F.array(F.struct(F.lit("no_trajectories").alias("code"), F.lit(0.0).alias("observed"), F.lit(0.0).alias("limit")))
    failures = F.when(F.col("samples") == 0, none).otherwise(F.array_compact(F.array(*each)))
    return report.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0)


def gate_report(rows: DataFrame, limits: Limits | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The report: one row, or one for each value of by (columns of rows)."""
    return with_failures(figures(totals(reward_groups(rows, by), by), exact.partials(rows, MEANS, by), by), limits or Limits())


def failure_rows(report: DataFrame) -> DataFrame:
    return report.select(F.inline("failures"))


#: How failures read.
MESSAGES = {
    "no_trajectories": "no trajectories",
    "zero_std": "zero-std groups {observed:.3f} > {limit:.3f}",
    "truncation": "truncation {observed:.3f} > {limit:.3f}",
    "errors": "verifier errors {observed:.3f} > {limit:.3f}",
    "policy_lag": "policy lag {observed:.0f} > {limit:.0f}",
    "mean_reward": "mean reward {observed:.3f} < {limit:.3f}",
}


def messages(report_row) -> list[str]:  # noqa: ANN001
    """Of a collected report row; rounded as Python does, by the exact binary value."""
    return [MESSAGES[f["code"]].format(observed=f["observed"], limit=f["limit"]) for f in report_row["failures"]]


def sent(groups: DataFrame) -> DataFrame:
    """groups, written once; broadcast if they are MOST_SENT rows at most (some 50 MB), so that rows need not be shuffled, else joined by shuffling both."""
    groups = settle(groups, "groups")
    return F.broadcast(groups) if groups.count() <= MOST_SENT else groups


def active_sampling(rows: DataFrame) -> DataFrame:
    """Rows of groups whose rewards differ."""
    groups = rows.groupBy(*GROUP).agg(F.min("reward").alias("low"), F.max("reward").alias("high"))
    return rows.join(sent(groups.filter("low < high").select(*GROUP)), list(GROUP), "left_semi")


def centered_advantage(rows: DataFrame) -> DataFrame:
    """reward less the group's mean, by a partially aggregated mean and a join that Spark can split."""
    means = sent(rows.groupBy(*GROUP).agg(F.avg("reward").alias("mean_reward")))
    return rows.join(means, list(GROUP)).withColumn("advantage", F.col("reward") - F.col("mean_reward"))


def clip_reward(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def has_both_outcomes(rows: DataFrame) -> DataFrame:
    """Whether some trajectory has reward 0 and some reward 1."""
    return rows.agg((F.coalesce(F.bool_or(F.col("reward") == 0), F.lit(False)) & F.coalesce(F.bool_or(F.col("reward") == 1), F.lit(False))).alias("both_outcomes"))


def monitoring(rows: DataFrame) -> DataFrame:
    """Rewards, lengths and errors by kind of task."""
    return rows.groupBy("task_kind").agg(
        F.count("*").alias("samples"), F.avg("reward").alias("mean_reward"), F.round(F.avg("response_tokens"), 9).alias("mean_tokens"),
        F.max("response_tokens").cast("bigint").alias("max_tokens"), F.count("error_type").alias("errors"),
    )
