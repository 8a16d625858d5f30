"""Rules for trajectories and tasks, as predicates; broken rows are told apart, not dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.schemas import REQUIRED


def trajectory_rules(has: set[str]) -> list[tuple[str, Column]]:
    """(name, whether it is broken) for the columns that there are."""
    c = F.col
    reward = c("verifier.reward") if "verifier" in has else c("reward")
    out = [
        ("missing_field", F.exists(F.array(*[c(k).isNull() for k in REQUIRED if k in has]), lambda x: x)),
        ("reward_range", ~reward.between(0, 1) | F.isnan(reward)),
        ("task_kind", ~c("task_kind").isin("math", "code")),
        ("negative_version", (c("policy_version") < 0) | (c("learner_version") < 0)),
        ("negative_tokens", c("response_tokens") < 0),
        ("max_tokens", c("max_response_tokens") <= 0),
        ("entropy", (c("entropy") < 0) | F.isnan("entropy")),
    ]
    if "verifier" in has:
        out.append(("duration", (c("verifier.duration_seconds") < 0) | F.isnan("verifier.duration_seconds")))
    return [(name, F.coalesce(broken, F.lit(False))) for name, broken in out]


def broken_rules(rows: DataFrame) -> DataFrame:
    """rows with broken: names of the rules that each breaks."""
    each = [F.when(b, F.lit(name)) for name, b in trajectory_rules(set(rows.columns))]
    return rows.withColumn("broken", F.array_compact(F.array(*each)))


def broken_counts(rows: DataFrame) -> DataFrame:
    return broken_rules(rows).select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def safe_relative(path: Column) -> Column:
    """Not absolute, and no part of it is "..": it stays below its root."""
    return ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), "..")


def safe_name(name: Column) -> Column:
    """Usable as one directory name."""
    return (F.length(name) > 0) & ~name.contains("/") & ~name.isin(".", "..")


def task_rules(tasks: DataFrame) -> DataFrame:
    """tasks with broken: candidate path, kind, and what a task of that kind needs."""
    c = F.col
    each = {
        "kind": ~F.coalesce(c("kind").isin("math", "code"), F.lit(False)),
        "candidate_path": ~safe_relative(F.coalesce("candidate_path", F.lit("solution.py"))),
        "math_needs_truth": (c("kind") == "math") & c("ground_truth").isNull(),
        "code_needs_command": (c("kind") == "code") & (F.coalesce(F.size("test_command"), F.lit(0)) <= 0),
    }
    return tasks.withColumn("broken", F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in each.items()])))


def orphans(trajectories: DataFrame, tasks: DataFrame) -> DataFrame:
    """Trajectories of no known task."""
    return trajectories.join(tasks.select(F.col("id").alias("task_id")), "task_id", "left_anti")
