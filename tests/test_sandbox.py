"""Sandboxes: bounded concurrency, resumed runs, and how a container is called."""

import json
import time
from pathlib import Path

import pytest

from veritrail.operators import verify

SCHEMA = "id string, kind string, candidate_path string, test_command array<string>, files map<string,string>, completion string"


def program(k, body, command=("python", "solution.py")):
    return (str(k), "code", None, list(command), {"b": "1", "a": "2"}, body)


def test_never_more_than_slots(spark, tmp_path):
    """Eight tasks at a time, two slots: the programs note when they begin and end."""
    body = f"import time, os\nbegan = time.time()\ntime.sleep(0.2)\nopen('{tmp_path}/' + str(os.getpid()), 'w').write(f'{{began}} {{time.time()}}')\n"
    rows = spark.createDataFrame([program(k, body + f"# {k}") for k in range(16)], SCHEMA).repartition(8)
    done = verify.code_verify(rows, verify.LimitedRunner(verify.LocalRunner(trusted=True), verify.Slots(2, f"test-{time.time_ns()}"))).collect()
    assert len(done) == 16 and all(r.passed for r in done)
    times = [tuple(map(float, p.read_text().split())) for p in tmp_path.iterdir()]
    most = max(sum(a <= t < b for a, b in times) for t, _ in times)
    assert len(times) == 16 and most <= 2
    with pytest.raises(ValueError):
        verify.Slots(0)


def test_killed_run_resumes(spark, tmp_path):
    """A run that fails in its second batch keeps the first; the next call runs the rest alone, and copies once."""
    marks, fuse = tmp_path / "marks", tmp_path / "fuse"
    marks.mkdir()
    fuse.write_text("")

    class Counting:
        def run(self, workspace, command, timeout):
            code = Path(workspace, "solution.py").read_text().strip()
            if len(list(marks.iterdir())) >= 5 and fuse.exists():
                raise KeyboardInterrupt  # not an error of the sandbox: the task dies
            (marks / f"{code[2:]}-{time.time_ns()}").write_text("")
            return verify.Execution(int(code == "# 5"), "", "", 0.0)

    rows = spark.createDataFrame([program(k, f"# {k % 8}") for k in range(24)], SCHEMA).coalesce(1)
    store = str(tmp_path / "store")
    with pytest.raises(Exception) as raised:  # noqa: B017, PT011  whatever Spark makes of it
        verify.verify_resumable(rows, Counting(), store, batch=1)
    kept = spark.read.parquet(store).count() if Path(store).exists() else 0
    assert kept <= 5 and (kept or "KeyboardInterrupt" not in str(raised.value)), str(raised.value)[:2000]
    fuse.unlink()
    before = len(list(marks.iterdir()))
    done = verify.verify_resumable(rows, Counting(), store, batch=3).collect()
    assert len(done) == 24 and {r.id for r in done if not r.passed} == {"5", "13", "21"}
    assert spark.read.parquet(store).count() == 8 and len(list(marks.iterdir())) == before + 8 - kept
    verify.verify_resumable(rows, Counting(), store).collect()
    assert len(list(marks.iterdir())) == before + 8 - kept  # nothing is left to run
    verify.verify_resumable(rows.limit(1), Counting(), store, name="other").collect()
    assert spark.read.parquet(store).count() == 9  # another image's results are its own


def test_errors_are_tried_again(spark, tmp_path):
    rows = spark.createDataFrame([program(1, "x", ("no-such-program",))], SCHEMA)
    for n in (1, 2):
        done = verify.verify_resumable(rows, verify.LocalRunner(trusted=True), str(tmp_path / "s")).collect()
        assert done[0].error_type == "sandbox_error" and spark.read.parquet(str(tmp_path / "s")).count() == n and len(done) == 1


def test_container_arguments(tmp_path, monkeypatch):
    """A program that writes down how it is called stands in for the container's."""
    fake = tmp_path / "fakebox"
    fake.write_text('#!/usr/bin/env python\nimport json, sys, os\nprint(json.dumps([sys.argv[1:], os.getcwd()]))\nsys.exit(3)\n')
    fake.chmod(0o755)
    monkeypatch.setenv("PATH", f"{tmp_path}:{__import__('os').environ['PATH']}")
    for contain in (True, False):
        done = verify.ContainerRunner("img.sif", "fakebox", contain).run("/w/s", ["bash", "t.sh"], 20)
        assert done.returncode == 3
        assert json.loads(done.stdout)[0] == ["exec", "--cleanenv", *["--containall"] * contain, "--bind", "/w/s:/workspace", "--pwd", "/workspace", "img.sif", "bash", "t.sh"]
