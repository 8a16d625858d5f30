"""Headline queries of the core engine, timed; one JSON line."""

from __future__ import annotations

import json
import os
import time

from veritrail.plans.registry import QUERIES
from veritrail.session import local_session

HEADLINE = ("gate_report", "gate_report_by_kind", "reward_groups", "active_sampling", "centered_advantage", "extract_answers", "normalize_answers", "math_verify", "pack_code_rows", "pack_messages")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cpus, cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up: code is compiled once a session
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 4)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 4), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus}))


if __name__ == "__main__":
    main()
