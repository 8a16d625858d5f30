"""Verification of completions: answers of math tasks, and code run against tests."""

from __future__ import annotations

import os
import shutil
import signal
import socket
import subprocess
import tempfile
import time
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass
from pathlib import Path
from random import random, sample
from threading import Thread
from typing import IO, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.functions.answers import extract_answer, extract_code, with_match
from veritrail.schemas import RESULT
from veritrail.sources.shared import exists, settle

CAPTURE = 32_000  #: characters kept of the end of a program's output
TIMEOUT = 120.0


def math_verify(rows: DataFrame) -> DataFrame:
    """rows (kind, ground_truth array, completion, ...) with a result: reward, passed, reason, extracted answer."""
    answer = extract_answer(F.col("completion"))
    bad = F.when(F.coalesce("kind", F.lit("")) != "math", F.raise_error("the math verifier needs a math task")).when(F.col("ground_truth").isNull(), F.raise_error("a math task needs a ground truth"))
    df = rows.withColumn("extracted_answer", F.coalesce(bad.cast("string"), answer))
    df = with_match(df, "extracted_answer", "ground_truth", "passed")
    return df.withColumns(
        {
            "reward": F.col("passed").cast("double"),
            "verifier": F.lit("math"),
            "reason": F.when(F.col("passed"), "answer matches the ground truth").otherwise("answer differs from the ground truth"),
            "error_type": F.lit(None).cast("string"),
        }
    )


@dataclass(frozen=True)
class Execution:
    returncode: int
    stdout: str
    stderr: str
    duration: float


class SandboxRunner(Protocol):
    """Runs a command in a workspace."""

    def run(self, workspace: str, command: list[str], timeout: float) -> Execution: ...


class LocalRunner:
    """No sandbox at all: only for trusted fixtures, and only if asked for by name."""

    def __init__(self, *, trusted: bool = False):
        if not trusted:
            raise ValueError("local execution is not isolated: pass trusted=True for trusted code")

    def run(self, workspace: str, command: list[str], timeout: float) -> Execution:
        return executed(command, timeout, workspace)


class ContainerRunner:
    """Runs the command in an image by a container program that is found on the executor."""

    def __init__(self, image: str, program: str = "apptainer", contain_all: bool = True):
        self.image, self.program, self.contain_all = image, program, contain_all

    def run(self, workspace: str, command: list[str], timeout: float) -> Execution:
        program = shutil.which(self.program)
        if not program:
            raise FileNotFoundError(f"{self.program} is not installed")
        flags = ["--cleanenv", *["--containall"] * self.contain_all, "--bind", f"{workspace}:/workspace", "--pwd", "/workspace"]
        return executed([program, "exec", *flags, self.image, *command], timeout, None)


class Slots:
    """At most so many sandboxes at a time on a machine, whatever the number of tasks and workers there.

    A lease is a bound local socket of the pool's name and a number, which has no file and ends with its process, however that ends.
    """

    def __init__(self, limit: int, pool: str = "sandbox"):
        if limit < 1:
            raise ValueError("limit: 1 or more")
        self.limit, self.pool = limit, pool

    @contextmanager
    def lease(self) -> Iterator[int]:
        """Waits for a free slot; gives its number."""
        while True:
            for k in sample(range(self.limit), self.limit):
                held = socket.socket(socket.AF_UNIX)
                try:
                    held.bind(f"\0veritrail-{self.pool}-{k}")
                except OSError:
                    held.close()
                    continue
                with held:
                    yield k
                return
            time.sleep(0.02 + 0.03 * random())


class LimitedRunner:
    """Runs what another runner does in one of some slots. Waiting is no part of the time that a program has."""

    def __init__(self, runner: SandboxRunner, slots: Slots):
        self.runner, self.slots = runner, slots

    def run(self, workspace: str, command: list[str], timeout: float) -> Execution:
        with self.slots.lease():
            return self.runner.run(workspace, command, timeout)


class Tail(Thread):
    """Drains a pipe and keeps its end."""

    def __init__(self, pipe: IO[bytes]):
        super().__init__(daemon=True)
        self.pipe, self.held = pipe, b""
        self.start()

    def run(self) -> None:
        while more := self.pipe.read1(1 << 16):
            self.held = (self.held + more)[-4 * CAPTURE :]

    def text(self) -> str:
        self.join(1)
        return self.held.decode("utf-8", "replace")[-CAPTURE:]


def executed(command: list[str], timeout: float, cwd: str | None) -> Execution:
    """In a session of its own, which is killed as a whole in the end, so that nothing that was started stays or holds a pipe."""
    began = time.monotonic()
    process = subprocess.Popen(command, cwd=cwd, stdin=subprocess.DEVNULL, stdout=subprocess.PIPE, stderr=subprocess.PIPE, start_new_session=True)
    out, err = Tail(process.stdout), Tail(process.stderr)
    try:
        code = process.wait(timeout)
    finally:
        with suppress(ProcessLookupError):
            os.killpg(process.pid, signal.SIGKILL)
        process.wait()
    return Execution(code, out.text(), err.text(), time.monotonic() - began)


def place(workspace: str, relative: str, content: str) -> None:
    """Write a file strictly below the workspace, links resolved."""
    root = Path(workspace).resolve()
    at = (root / relative).resolve()
    if root not in at.parents:
        raise ValueError(f"{relative} is outside the workspace")
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_text(content)


def judge(task: dict, code: str, runner: SandboxRunner, timeout: float) -> dict:
    """The result of one program; a timeout or a failing sandbox is a result too."""
    out = {"reward": 0.0, "passed": False, "verifier": "code", "reason": "", "extracted_answer": code, "stdout": "", "stderr": "", "duration_seconds": 0.0, "error_type": None}
    workspace = tempfile.mkdtemp(prefix="verify-")
    began = time.monotonic()
    try:
        for name, content in (task["files"] or {}).items():
            place(workspace, name, content)
        place(workspace, task["candidate_path"] or "solution.py", code)
        done = runner.run(workspace, list(task["test_command"]), timeout)
        passed = done.returncode == 0
        reason = "all tests passed" if passed else f"tests exited with {done.returncode}"
        return out | {"reward": float(passed), "passed": passed, "reason": reason, "stdout": done.stdout, "stderr": done.stderr, "duration_seconds": done.duration}
    except subprocess.TimeoutExpired:
        return out | {"reason": f"tests ran longer than {timeout:g} seconds", "error_type": "timeout", "duration_seconds": time.monotonic() - began}
    except Exception as e:  # noqa: BLE001  whatever the sandbox raises labels this row alone
        return out | {"reason": f"sandbox failed: {e}"[-CAPTURE:], "error_type": "sandbox_error", "duration_seconds": time.monotonic() - began}
    finally:
        shutil.rmtree(workspace, ignore_errors=True)


def code_verify(rows: DataFrame, runner: SandboxRunner, timeout: float = TIMEOUT, slots: int | None = None) -> DataFrame:
    """rows (id, kind, candidate_path, test_command, files, completion) -> (id, result columns).

    Programs run at least once; turn speculation off, and write the result before it is read twice. slots: programs at
    a time, by default as many as there are tasks.
    """
    checked = F.when(F.coalesce("kind", F.lit("")) != "code", F.raise_error("the code verifier needs a code task")).when(F.coalesce(F.size("test_command"), F.lit(0)) <= 0, F.raise_error("a code task needs a test command"))
    df = rows.select("id", "candidate_path", "test_command", F.map_entries("files").alias("files"), F.coalesce(checked.cast("string"), extract_code(F.col("completion"))).alias("code"))
    df = df.repartition(slots) if slots else df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ.setdefault("PYTHONDONTWRITEBYTECODE", "1")
        for batch in batches:
            results = []
            for r in batch.to_dict("records"):
                files = {e["key"]: e["value"] for e in (r["files"] if r["files"] is not None else [])}
                results.append({"id": r["id"]} | judge(r | {"files": files}, r["code"], runner, timeout))
            yield pd.DataFrame(results, columns=["id", *[c.split()[0] for c in RESULT.split(", ")]])

    return df.mapInPandas(run, f"id string, {RESULT}")


def program_key(name: str) -> Column:
    """What a run depends on, as one digest: its program, files in order of name, command, and the name of what runs it."""
    files = F.array_sort(F.map_entries(F.coalesce("files", F.create_map().cast("map<string,string>"))))
    return F.sha2(F.to_json(F.struct(F.lit(name).alias("by"), F.coalesce("candidate_path", F.lit("solution.py")).alias("at"), "test_command", files.alias("files"), extract_code(F.col("completion")).alias("code"))), 256)


def verify_resumable(rows: DataFrame, runner: SandboxRunner, store: str, name: str = "", timeout: float = TIMEOUT, slots: int | None = None, batch: int = 10_000, again: tuple[str, ...] = ("sandbox_error",)) -> DataFrame:
    """code_verify() with a table of results at store, by what a run depends on: equal programs run once, now and in later runs.

    name: of what runs them, such as the image; results of another one don't count. Programs without a result are run `batch` at a time, and each batch's results
    are committed before the next one begins, so a run that was killed goes on after its last whole batch. Results of the kinds in again are tried once more by the next call.
    A program has one result however often its row is there; where an earlier one was to be tried again, the last one counts.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("program", program_key(f"{name} {timeout:g}"))
    schema = f"program string, {RESULT}, batch long"

    def known() -> DataFrame:
        there = spark.createDataFrame([], schema) if not exists(spark, store) else spark.read.schema(schema).parquet(store)
        columns = [c.split()[0] for c in RESULT.split(", ")]
        return there.groupBy("program").agg(F.max_by(F.struct(*columns), "batch").alias("r")).select("program", "r.*")

    final = known().filter(~F.coalesce(F.col("error_type").isin(*again), F.lit(False))) if again else known()
    todo = keyed.join(final.select("program"), "program", "left_anti").groupBy("program").agg(F.first(F.struct("kind", "candidate_path", "test_command", F.map_entries("files").alias("files"), "completion")).alias("t"))
    todo = settle(todo.select(F.col("program").alias("id"), "t.*").withColumn("files", F.map_from_entries("files")), "programs")
    count = todo.count()
    parts = -(-count // batch)
    last = 0 if not exists(spark, store) else (spark.read.schema(schema).parquet(store).agg(F.max("batch")).first()[0] or 0)
    for k in range(parts):
        part = todo.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == k)
        done = code_verify(part, runner, timeout, slots).withColumnRenamed("id", "program").withColumn("batch", F.lit(last + k + 1).cast("long"))
        done.write.mode("append").parquet(store)
    return keyed.select("id", "program").join(known(), "program").drop("program")


class Verifier(Protocol):
    """Tasks with completions (id, kind, ground_truth, candidate_path, test_command, files, completion) -> (id, RESULT)."""

    def verify(self, rows: DataFrame) -> DataFrame: ...


class MathVerifier:
    def verify(self, rows: DataFrame) -> DataFrame:
        missing = {"stdout": F.lit("").alias("stdout"), "stderr": F.lit("").alias("stderr"), "duration_seconds": F.lit(0.0).alias("duration_seconds")}
        done = math_verify(rows)
        return done.select("id", *[missing.get(n, F.col(n)) for n in (c.split()[0] for c in RESULT.split(", "))])


class CodeVerifier:
    def __init__(self, runner: SandboxRunner, timeout: float = TIMEOUT, slots: int | None = None):
        self.runner, self.timeout, self.slots = runner, timeout, slots

    def verify(self, rows: DataFrame) -> DataFrame:
        return code_verify(rows, self.runner, self.timeout, self.slots)


def verify(rows: DataFrame, verifiers: dict[str, Verifier]) -> DataFrame:
    """Each row by the verifier of its kind; a kind without one, null too, raises. rows is read once for each verifier."""
    if not verifiers:
        raise ValueError("no verifiers")
    kind = F.coalesce("kind", F.lit("null"))
    unknown = F.when(~F.coalesce(F.col("kind").isin(*verifiers), F.lit(False)), F.raise_error(F.concat(F.lit("no verifier for tasks of kind "), kind)))
    rows = rows.withColumn("kind", F.coalesce(unknown.cast("string"), F.col("kind")))
    out = None
    for name, verifier in verifiers.items():
        done = verifier.verify(rows.filter(F.col("kind") == name))
        out = done if out is None else out.unionByName(done)
    return out
