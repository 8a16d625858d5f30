"""Datasets of tasks: generated arithmetic, and code tasks packed from manifests."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.functions.answers import strip
from veritrail.operators.validation import safe_name, safe_relative

#: What packed rows say.
CODE_PROMPT = "Solve the coding task in the sandbox. Run tests, then submit when complete."
SANDBOX_ENV = "swerl_vanillux_sandbox"
TEST_SCRIPT = "test.sh"


def messages(content):  # noqa: ANN001, ANN201
    return F.array(F.struct(F.lit("user").alias("role"), content.alias("content")))


def math_smoke(spark: SparkSession, count: int = 64, dataset: str = "math_smoke") -> DataFrame:
    """n + (n + 1) for n from 1 to count; no rows for a count of 0 or less."""
    n = F.col("id")
    prompt = F.concat(F.lit("Compute "), n.cast("string"), F.lit(" + "), (n + 1).cast("string"), F.lit(". Give the final answer in \\boxed{}."))
    return spark.range(1, max(count, 0) + 1).select(messages(prompt).alias("messages"), (2 * n + 1).cast("string").alias("ground_truth"), F.lit(dataset).alias("dataset"))


def manifest_rules() -> list[tuple[str, str, Column]]:
    """(name, how it reads after an id, whether it is broken), in the order in which they are looked at."""
    names = F.concat(F.coalesce(F.map_keys("seed_files"), F.array().cast("array<string>")), F.coalesce(F.map_keys("test_files"), F.array().cast("array<string>")))
    return [
        ("unsafe_id", " is an unsafe task id", ~F.coalesce(safe_name(F.col("id")), F.lit(False))),
        ("no_test", f" has no test file {TEST_SCRIPT}", ~F.coalesce(F.map_contains_key("test_files", TEST_SCRIPT), F.lit(False))),
        ("outside", " has a file outside its root", ~F.forall(names, safe_relative)),
        ("count", " has a count below 1", (F.col("max_steps") < 1) | (F.col("copies") < 1)),
    ]


def with_defaults(manifests: DataFrame) -> DataFrame:
    return manifests.withColumns({"max_steps": F.coalesce("max_steps", F.lit(32).cast("bigint")), "copies": F.coalesce("copies", F.lit(1).cast("bigint"))})


def broken_manifests(manifests: DataFrame) -> DataFrame:
    """Manifests with defaults and broken: names of the rules that each breaks."""
    return with_defaults(manifests).withColumn("broken", F.array_compact(F.array(*[F.when(b, F.lit(name)) for name, _, b in manifest_rules()])))


def checked_manifests(manifests: DataFrame) -> DataFrame:
    """Manifests with defaults; one that can't be packed raises."""
    bad = F.lit(None).cast("string")
    for _, says, broken in reversed(manifest_rules()):
        bad = F.when(broken, F.raise_error(F.concat(F.coalesce("id", F.lit("null")), F.lit(says))).cast("string")).otherwise(bad)
    return with_defaults(manifests).withColumn("id", F.coalesce(bad, F.col("id")))


def code_rows(manifests: DataFrame, dataset: str = "code", env_name: str = SANDBOX_ENV) -> DataFrame:
    """copies rows for each manifest, numbered from 0."""
    env = F.struct("max_steps", F.lit(env_name).alias("env_name"), F.col("id").alias("task_id"), "image")
    each = checked_manifests(manifests).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
    return each.select(
        messages(F.lit(CODE_PROMPT)).alias("messages"), F.lit(dataset).alias("dataset"), F.concat_ws("-", "id", F.col("copy").cast("string")).alias("instance_id"),
        F.array(F.lit("bash")).alias("tools"), env.alias("env_config"),
    )


def file_rows(manifests: DataFrame) -> DataFrame:
    """(task_id, path, content) of every file of every task."""
    df = checked_manifests(manifests)
    line = lambda c: F.concat(strip(F.col(c)), F.lit("\n"))
    fixed = F.array(F.struct(F.lit("instruction.md").alias("path"), line("instruction").alias("content")), F.struct(F.lit("image.txt").alias("path"), line("image").alias("content")))
    of = lambda m, root: F.transform(F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:string>>")), lambda e: F.struct(F.concat(F.lit(root), e["key"]).alias("path"), e["value"].alias("content")))
    return df.select(F.col("id").alias("task_id"), F.inline(F.concat(fixed, of("seed_files", "environment/seeds/"), of("test_files", "tests/"))))


def write_task_tree(manifests: DataFrame, root: str) -> None:
    """Write the files of all tasks below root, a folder that all executors share."""

    def write(rows) -> None:  # noqa: ANN001
        top = Path(root).resolve()
        for r in rows:
            at = (top / r.task_id / r.path).resolve()
            if top / r.task_id not in at.parents:
                raise ValueError(f"{r.path} is outside its task")
            at.parent.mkdir(parents=True, exist_ok=True)
            at.write_text(r.content)

    Path(root).mkdir(parents=True, exist_ok=True)
    file_rows(manifests).foreachPartition(write)


def read_task_tree(spark: SparkSession, root: str) -> DataFrame:
    """(task_id, path, content) of the files below root."""
    files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    below = F.substring_index("file", f"{root.rstrip('/')}/", -1)
    return files.withColumn("below", below).select(F.substring_index("below", "/", 1).alias("task_id"), F.regexp_extract("below", r"^[^/]*/(.*)$", 1).alias("path"), F.col("value").alias("content"))
