"""Trajectory logs: JSON lines in, typed rows and rejects out; append, compaction and reports.

Typing is strict: a number in quotes or a fraction for a whole number rejects its line. Unknown fields reject it too.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritrail.operators.gates import policy_lag, truncated
from veritrail.operators.validation import broken_rules
from veritrail.schemas import REQUIRED, TRAJECTORY, TRAJECTORY_FIELDS, VERIFIER_FIELDS
from veritrail.sources.shared import exists, settle


def blank(text: Column) -> Column:
    return text.rlike(r"(?U)^[\s\x1c-\x1f\x85]*\z")


def parse(lines: DataFrame) -> DataFrame:
    """lines (value, ...) that aren't blank -> (..., value, row, reasons): the parsed row, and why it is rejected if it is."""
    text = F.col("value")
    row = F.from_json(text, TRAJECTORY, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"})
    raw, inner = F.from_json(text, "map<string,string>"), F.from_json(F.col("raw")["verifier"], "map<string,string>")
    keys = lambda x, known: F.size(F.array_except(F.map_keys(x), F.array(*map(F.lit, known)))) > 0
    lost = [F.col(f"row.{k}").isNull() & F.col("raw")[k].isNotNull() for k in TRAJECTORY_FIELDS]
    lost += [F.col(f"row.verifier.{k}").isNull() & F.col("inner")[k].isNotNull() for k in VERIFIER_FIELDS]
    missing = [F.col("raw")[k].isNull() for k in REQUIRED]
    df = lines.withColumns({"row": row, "raw": raw, "none": F.json_object_keys(text).isNull()}).withColumn("inner", inner)
    any_of = lambda xs: F.exists(F.array(*[F.coalesce(x, F.lit(False)) for x in xs]), lambda x: x)
    none = F.col("none")
    reasons = F.array_compact(
        F.array(
            F.when(none, F.lit("not_an_object")),
            F.when(keys(F.col("raw"), TRAJECTORY_FIELDS) | F.coalesce(keys(F.col("inner"), VERIFIER_FIELDS), F.lit(False)), F.lit("unknown_field")),
            F.when(~none & any_of(missing), F.lit("missing_field")),
            F.when(any_of(lost), F.lit("wrong_type")),
        )
    )
    return df.withColumn("reasons", reasons).drop("raw", "inner", "none")


def judge(lines: DataFrame) -> DataFrame:
    """lines (value, ...) -> (..., value, the row's columns, reasons): why a line is rejected, by its JSON or else by the rules.

    A generator makes the columns. A filter on plain ones would move below them and parse the line again for every field that it asks for, some ninety times in all.
    """
    parsed = parse(lines)
    checked = broken_rules(parsed.select("row.*", *[c for c in parsed.columns if c != "row"]))
    once = checked.withColumn("reasons", F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.col("broken"))).drop("broken")
    return once.select(F.inline(F.array(F.struct(*once.columns))))


def read_trajectories(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): typed rows with truncated and policy_lag; (file, value, reasons) of other lines.

    A path that isn't there has no rows. Blank lines are skipped.
    """
    if not exists(spark, path):
        lines = spark.createDataFrame([], "value string, file string")
    else:
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return split(lines, "file")


def split(lines: DataFrame, *kept: str) -> tuple[DataFrame, DataFrame]:
    """Lines (value, *kept) -> rows, and rejects (value, *kept, reasons)."""
    judged = judge(lines.filter(~blank(F.col("value"))))
    rejects = judged.filter(F.size("reasons") > 0).select(*kept, "value", "reasons")
    rows = judged.filter(F.size("reasons") == 0).drop("reasons", "value", *kept)
    rows = rows.withColumns({"created_at": F.coalesce("created_at", F.current_timestamp()), "metadata": F.coalesce("metadata", F.lit("{}"))})
    return rows.withColumns({"truncated": truncated(), "policy_lag": policy_lag()}), rejects


def numbered_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value, reasons) of all rejected lines of the files at path, blank lines counted, files cut anywhere.

    One scan writes each line's split of its file and its number within the task, a few bytes a line, with what is wrong
    with rejects. A line's place is then its distance from its split's first line, plus the lines of the file's splits before: a sum over
    one row for each split. What is written once doesn't depend on how a second scan would be cut.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, line long, value string, reasons array<string>")
    meta = lambda k: F.col(f"_metadata.{k}")
    lines = spark.read.text(path).select("value", meta("file_path").alias("file"), meta("file_block_start").alias("split"), F.monotonically_increasing_id().alias("number"))
    judged = judge(lines)
    bad = ~blank(F.col("value")) & (F.size("reasons") > 0)
    slim = judged.select("file", "split", "number", F.when(bad, F.col("value")).alias("value"), F.when(bad, F.col("reasons")).alias("reasons"))
    slim = settle(slim, "lines")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = slim.groupBy("file", "split").agg(F.min("number").alias("first"), F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    found = slim.filter(F.col("reasons").isNotNull()).join(splits, ["file", "split"])
    return found.select("file", (F.col("base") + F.col("number") - F.col("first") + 1).alias("line"), "value", "reasons")


def first_bad_line(spark: SparkSession, path: str) -> str | None:
    """"file:line" of the first rejected line of the first file that has one."""
    at = numbered_rejects(spark, path).agg(F.min(F.struct("file", "line")).alias("at")).first().at
    return at and f"{at.file}:{at.line}"


def read_strict(spark: SparkSession, path: str) -> DataFrame:
    """The rows; the first bad line raises with its place."""
    at = first_bad_line(spark, path)
    if at:
        raise ValueError(f"invalid trajectory at {at}")
    return read_trajectories(spark, path)[0]


def append(rows: DataFrame, path: str) -> None:
    """One more shard for each task, by Spark's commit protocol; computed columns are left out."""
    rows.drop("truncated", "policy_lag").write.mode("append").option("ignoreNullFields", "false").json(path)


def compact(spark: SparkSession, path: str, out: str, partitions: int | None = None) -> DataFrame:
    """Shards to Parquet, so that filters and columns are pushed into the scan."""
    rows, _ = read_trajectories(spark, path)
    (rows.repartition(partitions) if partitions else rows).drop("truncated", "policy_lag").write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Lines of any fields, inferred; blank lines are skipped and a path that isn't there raises."""
    return spark.read.json(path)


def read_completions(spark: SparkSession, path: str) -> DataFrame:
    """(path, completion): each file's whole text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("completion"))


def write_rows(rows: DataFrame, path: str) -> None:
    """Parquet if path ends so, else JSON lines with nulls kept; what was there is replaced."""
    writer = rows.write.mode("overwrite")
    writer.parquet(path) if path.endswith(".parquet") else writer.option("ignoreNullFields", "false").json(path)


def report_json(row) -> str:  # noqa: ANN001
    """A report row as JSON, indented, with sorted keys."""
    return json.dumps(row.asDict(recursive=True), indent=2, sort_keys=True, default=str)
