"""Weighted datasets as one order of rows, every prefix of which keeps the weights.

Row i of a dataset of weight w stands at virtual time (2 i + 1) / 2 w (stride order), datasets with the same time in their given order. A row's place in the
whole order is the number of rows before it, which is arithmetic on its own number: so many of each dataset come before a time. So rows are numbered
within their datasets, from counts of the sorted partitions, and no row is moved to learn its place. Whole numbers throughout, so places are 0, 1, 2 ... without a gap.

Of the first n rows, each dataset has its share of n but for less than MOST_OFF rows for each further dataset, while none has run out. until="first" ends the order
where a row is due of a dataset that has no more; until="all" goes on with those that are left, in the same proportions.

Edge cases: an empty dataset's first row is due and missing. Weights are rounded to 1 / SCALE and must not be 0 then. Rows that are alike in the order's key stand in the order of their other columns; rows alike in all stand in any.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from veritrail.sources.shared import settle

SCALE = 10_000
MOST_OFF = 1


@dataclass(frozen=True)
class Dataset:
    name: str
    rows: DataFrame
    weight: float = 1.0
    split: str | None = None  #: rows whose column split says so; all, without it


def of_configuration(spark: SparkSession, datasets: Iterable[Row]) -> list[Dataset]:
    """The datasets (path, weight, split) of a configuration that configs.read() found whole: Parquet, or JSON lines, by the path's ending.

    A dataset without a column split is its train split. Each is called by the last part of its path, without the ending.
    """
    out = []
    for d in datasets:
        rows = spark.read.parquet(d.path) if d.path.rstrip("/").endswith(".parquet") else spark.read.json(d.path)
        if "split" not in rows.columns and d.split != "train":
            raise ValueError(f"{d.path} has no splits")
        out.append(Dataset(d.path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0], rows, d.weight, d.split if "split" in rows.columns else None))
    return out


def numbered(rows: DataFrame, key: Column) -> DataFrame:
    """rows with dataset_row: 0, 1, 2 ... in order of key, by counts of the sorted partitions."""
    ordered = rows.withColumn("_key", key).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    made = settle(ordered.repartitionByRange("_key", "_tie").sortWithinPartitions("_key", "_tie").withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    sizes = made.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))  # a row for each task
    bases = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_base"))
    out = made.withColumn("_part", part).join(F.broadcast(bases), "_part")
    return out.withColumn("dataset_row", F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_key", "_tie", "_at", "_part", "_base")


def before(number: Column, own: int, other: int, earlier: bool) -> Column:
    """How many rows of a dataset of weight other come before row number of one of weight own; earlier: at the same time too."""
    wide = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("decimal(24,0)")
    over = (2 * wide(number) + 1) * wide(other) - wide(own)  # j is before if 2 j own < over
    step = F.lit(2 * own).cast("decimal(24,0)")
    whole = F.floor((over - F.pmod(over, step)) / step).cast("bigint")  # an exact division
    return whole + 1 if earlier else whole + F.when(F.pmod(over, step) == 0, 0).otherwise(1)


def mixture(datasets: Sequence[Dataset], key: Column, until: str = "first") -> DataFrame:
    """(dataset, dataset_row, place, and the columns that all datasets have), to be sorted by place where order matters. key: the order of rows within a dataset, such as a hash of their id."""
    if until not in ("first", "all"):
        raise ValueError("until: first or all")
    weights = [round(d.weight * SCALE) for d in datasets]
    if min(weights) <= 0:
        raise ValueError("a weight is 0 or less")
    own = [d.rows if d.split is None else d.rows.filter(F.col("split") == d.split) for d in datasets]
    columns = [c for c in own[0].columns if all(c in d.columns for d in own) and c not in ("dataset", "dataset_row", "place")]
    rows = [numbered(d.select(*columns), key) for d in own]
    counts = [r.agg(F.coalesce(F.max("dataset_row") + 1, F.lit(0))).first()[0] for r in rows]
    out = None
    for k, r in enumerate(rows):
        place = F.lit(0).cast("bigint")
        for j, n in enumerate(counts):
            ahead = F.col("dataset_row") if j == k else F.greatest(F.lit(0), before(F.col("dataset_row"), weights[k], weights[j], j < k))
            place = place + F.least(ahead, F.lit(n).cast("bigint"))
        if until == "first":  # nothing stands behind a row that is due and missing
            for j, n in enumerate(counts):
                if j != k:
                    r = r.filter(before(F.col("dataset_row"), weights[k], weights[j], j < k) <= n)
        one = r.select(F.lit(datasets[k].name).alias("dataset"), "dataset_row", place.alias("place"), *columns)
        out = one if out is None else out.unionByName(one)
    return out
