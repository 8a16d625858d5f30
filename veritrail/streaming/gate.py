"""The gate as a stream: state by task and policy version, closed by version.

There is no watermark, as lateness is a number of policy versions. A micro-batch adds the partials of its groups and of the exact sums to its own
folder, split by version. Versions that are more than `keep` behind the newest one seen are closed: their partials are merged
once into running totals of a few rows, and their folders go. So what is kept and read is the groups of `keep` + 1 versions and one line of totals, however
long the stream runs. Rows of a closed version are too late: they are written to a folder of their own and counted, and are no part of the report.

A batch that runs again finds what was before it and writes the same: each row is counted once. What a batch closes is removed only when the next one
begins, which is after Spark has committed it.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veritrail.operators import exact
from veritrail.operators.gates import GROUP, MEANS, Limits, figures, reward_groups, totals, with_failures

MERGE = {"samples": F.sum, "min_reward": F.min, "max_reward": F.max, "truncated": F.sum, "errors": F.sum, "max_policy_lag": F.max}
GROUPS = "task_id string, samples bigint, min_reward double, max_reward double, truncated bigint, errors bigint, max_policy_lag bigint, batch bigint, policy_version bigint"
PARTS = "column string, exponent int, hi bigint, mid bigint, lo bigint, n bigint, odd double"
TOTALS = "samples bigint, n_groups bigint, zero_groups bigint, truncated bigint, errors bigint, max_policy_lag bigint"


@dataclass
class Place:
    """Where the stream stands after a batch: versions below floor are closed."""

    batch: int = -1
    newest: int | None = None
    floor: int | None = None
    late: int = 0


class State:
    """The folder of a stream's state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.of = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.of(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        at = self.of(f"{self.path}/{below}")
        return [f.getPath().getName() for f in self.files.listStatus(at)] if self.files.exists(at) else []

    def drop(self, below: str) -> None:
        self.files.delete(self.of(f"{self.path}/{below}"), True)

    def place(self, batch: int | None = None) -> Place:
        """After that batch, or the last one; before the first, nothing is closed."""
        known = sorted(int(n.split("=")[1]) for n in self.names("place") if "=" in n and self.files.exists(self.of(f"{self.path}/place/{n}/_SUCCESS")))
        known = [k for k in known if batch is None or k <= batch]
        return Place(**json.loads(self.spark.read.text(f"{self.path}/place/batch={known[-1]}").first().value)) if known else Place()

    def read(self, name: str, schema: str, place: Place) -> DataFrame:
        """Groups or sums of versions that are open after place."""
        if not self.names(name):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(f"{self.path}/{name}").filter(F.col("batch") <= place.batch)
        return found if place.floor is None else found.filter(~closes(place.floor))

    def closed(self, name: str, schema: str, place: Place) -> DataFrame:
        at = f"{name}/batch={place.batch}"
        return self.spark.read.schema(schema).parquet(f"{self.path}/{at}") if self.names(at) else self.spark.createDataFrame([], schema)


def closes(floor: int) -> Column:
    """Whether a row's version is closed; rows without a version never are."""
    return F.coalesce(F.col("policy_version") < floor, F.lit(False))


def version(folder: str) -> int | None:
    name, _, value = folder.partition("=")
    return int(value) if name == "policy_version" and value.lstrip("-").isdigit() else None


def merged(groups: DataFrame) -> DataFrame:
    return groups.groupBy(*GROUP).agg(*[f(k).alias(k) for k, f in MERGE.items()])


def start(rows: DataFrame, state: str, checkpoint: str, trigger: dict | None = None, keep: int | None = None) -> StreamingQuery:
    """rows: streaming, with the columns of reward_groups(). keep: versions behind the newest that stay open; by default all do."""

    def save(batch: DataFrame, batch_id: int) -> None:
        at = State(batch.sparkSession, state)
        before = at.place(batch_id - 1)
        if before.floor is not None:  # what was closed by a committed batch
            for name in ("groups", "sums"):
                for folder in at.names(name):
                    for split in at.names(f"{name}/{folder}"):
                        if (v := version(split)) is not None and v < before.floor:
                            at.drop(f"{name}/{folder}/{split}")
            for name in ("place", "closed", "closed_sums"):
                for folder in at.names(name):
                    if int(folder.split("=")[1]) < before.batch:
                        at.drop(f"{name}/{folder}")
        late = 0
        if before.floor is not None:
            batch.filter(closes(before.floor)).write.mode("overwrite").parquet(f"{state}/late/batch={batch_id}")
            late = batch.sparkSession.read.parquet(f"{state}/late/batch={batch_id}").count()
            batch = batch.filter(~closes(before.floor))
        reward_groups(batch).write.mode("overwrite").partitionBy("policy_version").parquet(f"{state}/groups/batch={batch_id}")
        exact.partials(batch, MEANS, ("policy_version",)).write.mode("overwrite").partitionBy("policy_version").parquet(f"{state}/sums/batch={batch_id}")
        seen = [v for split in at.names(f"groups/batch={batch_id}") if (v := version(split)) is not None]
        newest = max([*seen, *([before.newest] if before.newest is not None else [])], default=None)
        floor = before.floor if keep is None or newest is None else max(newest - keep, before.floor if before.floor is not None else newest - keep)
        now = Place(batch_id, newest, floor, before.late + late)
        if floor is not None:
            done = closes(floor)
            still_open = Place(batch_id, newest, before.floor)
            total = totals(merged(at.read("groups", GROUPS, still_open).filter(done))).select(*[c.split()[0] for c in TOTALS.split(", ")])
            columns = ("samples", "n_groups", "zero_groups", "truncated", "errors")
            both = total.unionByName(at.closed("closed", TOTALS, before)).agg(*[F.sum(c).alias(c) for c in columns], F.max("max_policy_lag").alias("max_policy_lag"))
            both.write.mode("overwrite").parquet(f"{state}/closed/batch={batch_id}")
            parts = at.read("sums", f"{PARTS}, batch bigint, policy_version bigint", still_open).filter(done).drop("batch", "policy_version")
            exact.merged(parts.unionByName(at.closed("closed_sums", PARTS, before))).write.mode("overwrite").parquet(f"{state}/closed_sums/batch={batch_id}")
        line = batch.sparkSession.createDataFrame([(json.dumps(asdict(now)),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{state}/place/batch={batch_id}")

    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def report(spark: SparkSession, state: str, limits: Limits | None = None) -> DataFrame:
    """The gate over all rows up to the last whole batch but the late ones; before the first, that of no rows."""
    at = State(spark, state)
    place = at.place()
    total = totals(merged(at.read("groups", GROUPS, place))).unionByName(at.closed("closed", TOTALS, place))
    parts = at.read("sums", f"{PARTS}, batch bigint, policy_version bigint", place).drop("batch", "policy_version").unionByName(at.closed("closed_sums", PARTS, place))
    return with_failures(figures(total, parts), limits or Limits())


def late_rows(spark: SparkSession, state: str) -> int:
    """How many rows came for a closed version, up to the last whole batch."""
    return State(spark, state).place().late
