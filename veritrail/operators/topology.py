"""Run configurations: the rules they must meet, and the arithmetic of their layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A profile's columns; fixed defaults where there is one.
PROFILE = "name string, task_kind string, sandbox string, nodes bigint, gpus_per_node bigint, learner_gpus_per_node array<bigint>, sequence_parallel bigint, engines bigint, tensor_parallel bigint, unique_prompts bigint, samples_per_prompt bigint, async_steps bigint, max_prompt bigint, response_length bigint, per_turn bigint, pack_length bigint"


def total(x: str) -> Column:
    return F.aggregate(x, F.lit(0).cast("bigint"), lambda s, v: s + v)


def topology(profiles: DataFrame) -> DataFrame:
    capacity, learners = F.col("nodes") * F.col("gpus_per_node"), total("learner_gpus_per_node")
    rollout = F.col("engines") * F.col("tensor_parallel")
    columns = {
        "capacity": capacity, "learner_gpus": learners, "rollout_gpus": rollout, "spare_gpus": capacity - learners - rollout,
        "learner_nodes": F.size("learner_gpus_per_node").cast("bigint"), "rollout_engines": F.col("engines"),
        "tensor_parallel": F.col("tensor_parallel"), "data_parallel_ranks": F.floor(learners / F.col("sequence_parallel")),
        "samples_per_step": F.col("unique_prompts") * F.col("samples_per_prompt"),
    }
    return profiles.select("name", *[v.cast("bigint").alias(k) for k, v in columns.items()])


def rules() -> list[tuple[str, Column]]:
    """(name, whether it is broken) in the order in which they are looked at."""
    c = F.col
    learners = total("learner_gpus_per_node")
    return [
        ("range", (c("nodes") < 1) | (c("gpus_per_node") < 1) | (c("engines") < 1) | (c("tensor_parallel") < 1) | (c("samples_per_prompt") < 2) | (c("sequence_parallel") < 1)),
        ("kind", ~c("task_kind").isin("math", "code")),
        ("per_turn_exceeds_response", c("per_turn") > c("response_length")),
        ("pack_too_short", c("pack_length") < c("max_prompt") + c("response_length")),
        ("code_needs_sandbox", (c("task_kind") == "code") & c("sandbox").isNull()),
        ("math_forbids_sandbox", (c("task_kind") == "math") & c("sandbox").isNotNull()),
        ("more_learner_nodes_than_nodes", F.size("learner_gpus_per_node") > c("nodes")),
        ("learner_entry_out_of_range", ~F.forall("learner_gpus_per_node", lambda x: (x >= 1) & (x <= c("gpus_per_node")))),
        ("oversubscribed", learners + c("engines") * c("tensor_parallel") > c("nodes") * c("gpus_per_node")),
        ("learners_not_divisible", learners % c("sequence_parallel") != 0),
        ("too_few_samples", c("unique_prompts") * c("samples_per_prompt") < F.floor(learners / c("sequence_parallel"))),
        ("too_few_prompts", c("unique_prompts") < c("engines")),
        ("code_needs_async", (c("task_kind") == "code") & (c("async_steps") < 1)),
    ]


def violations(profiles: DataFrame) -> DataFrame:
    """profiles with violations: the names of all broken rules, the first one first."""
    return profiles.withColumn("violations", F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules()])))


def validate_summary(profiles: DataFrame) -> DataFrame:
    """Whether each profile is valid, its name and kind of task, and its layout."""
    layout = topology(profiles)
    marked = violations(profiles).select("name", (F.size("violations") == 0).alias("valid"), F.col("task_kind").alias("task"))
    return marked.join(layout.select("name", F.struct(*[c for c in layout.columns if c != "name"]).alias("topology")), "name")


def violation_rows(profiles: DataFrame) -> DataFrame:
    return violations(profiles).select("name", F.posexplode("violations").alias("position", "rule"))
