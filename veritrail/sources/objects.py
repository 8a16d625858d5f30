"""Files of objects, YAML or JSON, one object or a list each: read by Spark from any store, parsed on executors, typed or rejected.

Every file is a row of Spark's whole-text reader, so files are spread over tasks and none reaches the driver; one file is parsed by
one task. What can't be parsed is a reject with its file, never a failed job. Fields are checked strictly: unknown, missing and
wrongly typed ones reject an object, each named.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.schemas import MANIFEST, TASK
from veritrail.sources.fields import MUST, section, string_map, strings, truths

OBJECTS = "file string, position bigint, value string, error string"


def parsed(text: str, yaml_form: bool) -> list[Any]:
    if yaml_form:
        import yaml

        found = yaml.safe_load(text)
    else:
        found = json.loads(text)
    return found if isinstance(found, list) else [found]


def read(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """(file, position, value, error) of every object below path; value: the object as JSON, or else error.

    form: "yaml", "json", or by each file's ending (.yaml and .yml: YAML, any other: JSON). Errors: unreadable (the whole file), not_an_object, wrong_type (a value
    that JSON doesn't have, such as a date). An empty file is one that holds null.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")

    def objects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for file, text in zip(batch["file"], batch["value"], strict=True):
                try:
                    found = parsed(text, form == "yaml" or form is None and file.lower().endswith((".yaml", ".yml")))
                except Exception:  # noqa: BLE001  whatever a parser raises on a bad file, that file alone is rejected
                    out.append((file, 0, None, "unreadable"))
                    continue
                for k, x in enumerate(found):
                    try:
                        value, error = (json.dumps(x, ensure_ascii=False, allow_nan=False), None) if isinstance(x, dict) else (None, "not_an_object")
                        if value is not None and not all(isinstance(key, str) for key in x):
                            value, error = None, "wrong_type"
                    except (TypeError, ValueError, RecursionError):
                        value, error = None, "wrong_type"
                    out.append((file, k, value, error))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OBJECTS.split(", ")])

    return files.mapInPandas(objects, OBJECTS)


#: Name, kind, default, least or the choices.
MANIFEST_FIELDS = {"id": (str, MUST), "instruction": (str, MUST), "image": (str, MUST), "seed_files": (string_map, {}), "test_files": (string_map, MUST), "max_steps": (int, 32, 1), "copies": (int, 1, 1)}
TASK_FIELDS = {
    "id": (str, MUST), "kind": (str, MUST, ("math", "code")), "prompt": (str, MUST), "ground_truth": (truths, None), "candidate_path": (str, "solution.py"), "test_command": (strings, None),
    "files": (string_map, {}), "metadata": (dict, {}),
}


def checked(objects: DataFrame, fields: dict[str, tuple], schema: str, null_allowed: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows of schema with file and position, rejects (file, position, value, problems))."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, problems = [], []
            for value, error in zip(batch["value"], batch["error"], strict=True):
                if error:
                    rows.append(None)
                    problems.append([error])
                    continue
                given = json.loads(value)
                filled, found = section(given, fields, "")
                found = [x.removeprefix(".") for x in found]
                found += [f"{k}: wrong_type" for k in fields if k in given and given[k] is None and k not in null_allowed and f"{k}: missing" not in found]
                if isinstance(filled.get("ground_truth"), str):
                    filled["ground_truth"] = [filled["ground_truth"]]
                if "metadata" in fields:
                    filled["metadata"] = json.dumps(filled["metadata"], ensure_ascii=False)
                rows.append(json.dumps(filled, ensure_ascii=False) if not found else None)
                problems.append(found)
            yield pd.DataFrame({"file": batch["file"], "position": batch["position"], "value": batch["value"], "row": rows, "problems": problems})

    done = objects.mapInPandas(check, "file string, position bigint, value string, row string, problems array<string>")
    good = done.filter(F.size("problems") == 0).select("file", "position", F.from_json("row", schema).alias("r")).select("file", "position", "r.*")
    return good, done.filter(F.size("problems") > 0).select("file", "position", "value", "problems")


def manifests(spark: SparkSession, path: str, form: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(manifests with defaults, rejects)."""
    return checked(read(spark, path, form), MANIFEST_FIELDS, MANIFEST)


def tasks(spark: SparkSession, path: str, form: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(tasks with defaults, rejects); a single ground truth becomes a list of one."""
    return checked(read(spark, path, form), TASK_FIELDS, TASK, ("ground_truth", "test_command"))
