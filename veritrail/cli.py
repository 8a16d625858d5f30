"""Commands: validate, topology, verify, gate, make-math and pack-code. They print JSON and end with 0, 1 (not passed) or 2 (wrong use or input)."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from veritrail.operators import datasets, gates, topology, verify
from veritrail.session import local_session
from veritrail.sources import archive, configs, objects, trajectories


def show(value: object) -> None:
    print(json.dumps(value, indent=2, sort_keys=True, default=str))


def only_config(path: str) -> dict:
    config = configs.load([path])[0]
    problems = configs.checked(config)[1]
    if problems:
        raise ValueError("; ".join(problems))
    return config


def only_row(rows: DataFrame, rejects: DataFrame) -> Row:
    """The one object of a file; what is wrong with it raises."""
    bad = rejects.first()
    if bad:
        raise ValueError("; ".join(bad.problems))
    found = rows.take(2)
    if len(found) != 1:
        raise ValueError("the file should hold one object")
    return found[0]


def only_profile(spark: SparkSession, path: str) -> DataFrame:
    rows = configs.read(spark, path)
    only_row(rows, rows.filter(F.size("problems") > 0))
    return rows


def validate(spark: SparkSession, args: argparse.Namespace) -> int:
    profile = only_profile(spark, args.config)
    broken = topology.violations(profile).first().violations
    if broken:
        raise ValueError("; ".join(broken))
    show(topology.validate_summary(profile).first().asDict(recursive=True))
    return 0


def layout(spark: SparkSession, args: argparse.Namespace) -> int:
    show(topology.topology(only_profile(spark, args.config)).first().asDict())
    return 0


def verify_one(spark: SparkSession, args: argparse.Namespace) -> int:
    tasks, rejects = objects.tasks(spark, args.task)
    kind = only_row(tasks, rejects).kind
    rows = tasks.crossJoin(trajectories.read_completions(spark, args.completion).select("completion"))  # one row each
    if args.runner == "local":
        runner: verify.SandboxRunner | None = verify.LocalRunner(trusted=True) if args.trusted else None
    else:
        runner = verify.ContainerRunner(args.image, args.program) if args.image else None
    if kind == "code" and runner is None:
        raise ValueError("code needs --image, or --runner local with --trusted")
    verifiers: dict[str, verify.Verifier] = {"math": verify.MathVerifier()}
    if runner:
        verifiers["code"] = verify.CodeVerifier(runner, args.timeout)
    result = verify.verify(rows, verifiers).first()
    show(result.asDict())
    return 0 if result.passed else 1


def gate(spark: SparkSession, args: argparse.Namespace) -> int:
    limits = configs.limits(only_config(args.config)) if args.config else gates.Limits()
    rows = trajectories.read_strict(spark, args.trajectories).select("*", "verifier.reward", "verifier.error_type")
    report = gates.gate_report(rows, limits).first()
    show(report.asDict(recursive=True) | {"failures": gates.messages(report)})
    return 0 if report.passed else 1


def make_math(spark: SparkSession, args: argparse.Namespace) -> int:
    trajectories.write_rows(datasets.math_smoke(spark, args.count), args.output)
    show({"dataset": args.output, "count": max(args.count, 0)})
    return 0


def pack_code(spark: SparkSession, args: argparse.Namespace) -> int:
    manifests = None
    for path in args.manifest:
        rows, rejects = objects.manifests(spark, path)
        if bad := rejects.first():
            raise ValueError(f"{bad.file}: " + "; ".join(bad.problems))
        manifests = rows if manifests is None else manifests.unionByName(rows)
    root = Path(args.output)
    datasets.code_rows(manifests).write.mode("overwrite").parquet(str(root / "train.parquet"))
    datasets.write_task_tree(manifests, str(root / "task-data"))
    archive.write(datasets.file_rows(manifests), str(root / "task-data.tar.gz"))
    show({"dataset": str(root / "train.parquet"), "task_data_dir": str(root / "task-data")})
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="veritrail", description=__doc__)
    commands = out.add_subparsers(required=True)
    for name, run, fields in (
        ("validate", validate, [("config", {})]),
        ("topology", layout, [("config", {})]),
        ("verify", verify_one, [("task", {}), ("completion", {}), ("--runner", {"choices": ("container", "local"), "default": "container"}), ("--trusted", {"action": "store_true"}), ("--image", {}), ("--program", {"default": "apptainer"}), ("--timeout", {"type": float, "default": verify.TIMEOUT})]),
        ("gate", gate, [("trajectories", {}), ("--config", {})]),
        ("make-math", make_math, [("output", {}), ("--count", {"type": int, "default": 64})]),
        ("pack-code", pack_code, [("manifest", {"nargs": "+"}), ("output", {})]),
    ):
        command = commands.add_parser(name)
        for field, options in fields:
            command.add_argument(field, **options)
        command.set_defaults(run=run)
    return out


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(arguments)  # ends with 2 on wrong use
    try:
        return args.run(spark or local_session(), args)
    except Exception as e:  # noqa: BLE001  what is wrong with an input is told, not traced
        print(f"{type(e).__name__}: {e}".splitlines()[0], file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
