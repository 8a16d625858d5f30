"""The streaming gate with versions that close, against the batch report of the rows that came in time."""

from pyspark.sql import functions as F

from veritrail.operators import gates
from veritrail.streaming import gate as stream

SCHEMA = "task_id string, task_kind string, reward double, policy_version bigint, learner_version bigint, response_tokens bigint, max_response_tokens bigint, error_type string, entropy double"


def made(version, k):
    return (f"t{k % 4}", "math", (k % 10) / 10, version, version + k % 3, k, 20, "x" if k % 7 == 0 else None, k / 10)


def test_closed_versions(spark, tmp_path):
    """Ten versions come one after the other, each with a few rows of older ones."""
    source, state = f"{tmp_path}/in", f"{tmp_path}/state"
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    in_time, late = [], 0
    for v in range(10):
        rows = [made(v, k) for k in range(30)] + [made(v - back, 99) for back in (1, 2, 3, 5) if v >= back]
        in_time += [r for r in rows if r[3] >= v - 3]
        late += sum(r[3] < v - 3 for r in rows)
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream.start(spark.readStream.schema(SCHEMA).parquet(source), state, f"{tmp_path}/ck", keep=2).awaitTermination()
        want = gates.gate_report(spark.createDataFrame(in_time, SCHEMA)).first()
        assert stream.report(spark, state).select(*want.asDict()).first() == want
    # a version closes after the batch in which it falls behind, so one that is 3 behind the newest before it is still taken
    assert stream.late_rows(spark, state) == late
    assert spark.read.parquet(f"{state}/late").count() == late
    kept = {int(p.name.split("=")[1]) for p in tmp_path.glob("state/groups/batch=*/policy_version=*")}
    assert min(kept) >= 6 and len(list(tmp_path.glob("state/place/batch=*"))) <= 3


def test_batch_again(spark, tmp_path):
    """A batch that was written but not committed runs again: nothing counts twice."""
    source, state = f"{tmp_path}/in", f"{tmp_path}/state"
    rows = [made(v, k) for v in range(5) for k in range(9)]
    for v in range(5):
        spark.createDataFrame([r for r in rows if r[3] == v], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    run = lambda: stream.start(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), state, f"{tmp_path}/ck", keep=1).awaitTermination()
    run()
    commits = sorted((tmp_path / "ck/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in [commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")]:
        p.unlink(missing_ok=True)
    run()
    want = gates.gate_report(spark.createDataFrame(rows, SCHEMA)).first()
    assert stream.report(spark, state).select(*want.asDict()).first() == want


def test_before_the_first_batch_and_without_a_version(spark, tmp_path):
    empty = stream.report(spark, f"{tmp_path}/none").first()
    assert (empty.samples, empty.passed, empty.failures[0].code) == (0, False, "no_trajectories")
    rows = [made(5, 1), made(9, 2), (*made(1, 3)[:3], None, *made(1, 3)[4:])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        stream.start(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/state", f"{tmp_path}/ck", keep=1).awaitTermination()
    assert stream.report(spark, f"{tmp_path}/state").first().samples == 3
    assert gates.reward_groups(spark.createDataFrame(rows, SCHEMA)).filter(F.col("policy_version").isNull()).count() == 1
