"""What the operators share: table access, the shared folder and common column expressions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.sources.shared import new_path, settle, shared_dir

__all__ = ["new_path", "settle", "shared_dir"]  # of the library, for all operators

#: Words are runs of anything but space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; such files are installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have, whatever its case."""
    have = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in have:
        name = f"_{name}"
    return name


def one_each(df: DataFrame, keys: list[str], other: list[str]) -> DataFrame:
    """One row of those with the same keys, without the keys' own columns: the first by its other columns' JSON; rows come grouped by keys."""
    row = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    order = F.to_json(F.struct(*(F.col(f"`{c}`") for c in other))) if other else F.lit("")
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*row), order).alias("_best"))
    return best.select(*(F.col(f"_best.`{c}`") for c in df.columns if c not in keys))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand Python few rows at a time, as texts may be long; a batch is some MB of ordinary documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python so many rows at a time in what runs inside, and as many as before after it."""
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    small_batches(spark, rows)
    try:
        yield
    finally:
        small_batches(spark, int(was))


def process_store() -> dict:
    """What a Python worker keeps from task to task; functions sent by value have no lasting globals."""
    import sys
    from types import ModuleType

    return sys.modules.setdefault("_veritrail_process_store", ModuleType("_veritrail_process_store")).__dict__
