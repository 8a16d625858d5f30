"""Line numbers of rejects in files that are cut into many splits."""

import json

from pyspark.sql import functions as F

from veritrail.sources import trajectories as log

GOOD = json.dumps({"run_id": "r", "task_id": "t", "task_kind": "math", "prompt": "p", "completion": "c" * 40, "verifier": {"reward": 1.0, "passed": True, "verifier": "v", "reason": "x"},
    "policy_version": 1, "learner_version": 1, "response_tokens": 1, "max_response_tokens": 2})


def test_many_splits(spark, tmp_path):
    want = set()
    for f, end in (("a.jsonl", "\n"), ("b.jsonl", "\r\n"), ("c.jsonl", "\n")):
        lines = []
        for k in range(1, 400):
            bad = k % 97 == 0 or f == "b.jsonl" and k < 3
            lines.append("nonsense" if bad else "" if k % 5 == 0 else "  \t" if k % 31 == 0 else GOOD.replace("cccc", f"c{k}") if k % 7 else GOOD)
            if bad:
                want.add((f, k))
        (tmp_path / f).write_bytes((end.join(lines) + (end if f != "c.jsonl" else "")).encode())
    (tmp_path / "empty.jsonl").write_text("")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("9000", was):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = log.numbered_rejects(spark, str(tmp_path)).select(F.substring_index("file", "/", -1).alias("f"), "line", "value").collect()
            assert {(r.f, r.line) for r in got} == want and len(got) == len(want) and {r.value for r in got} == {"nonsense"}
            assert log.first_bad_line(spark, str(tmp_path)).endswith("a.jsonl:97")
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert log.numbered_rejects(spark, f"{tmp_path}/none").count() == 0
    assert log.first_bad_line(spark, f"{tmp_path}/empty.jsonl") is None
