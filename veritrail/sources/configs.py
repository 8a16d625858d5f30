"""Run configurations: files of nested sections, read and checked on executors -> one profile row each, and what is wrong with a file's fields."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.operators.gates import Limits
from veritrail.operators.topology import PROFILE
from veritrail.sources import objects
from veritrail.sources.fields import MUST, section, string_map, strings, whole_numbers

#: Fixed values by section and field: type, default, least, most or the choices. "+": above 0.
FIELDS: dict[str, dict[str, tuple]] = {
    "platform": {
        "accelerator": (str, MUST, ("rocm", "cuda")), "nodes": (int, MUST, 1), "gpus_per_node": (int, MUST, 1), "container": (str, MUST), "account": (str, MUST),
        "partition": (str, MUST), "qos": (str, None), "walltime": (str, "01:00:00"), "cpus_per_task": (int, 64, 1), "memory": (str, None), "modules": (strings, []),
        "binds": (strings, ["/scratch", "/project", "/flash", "/appl"]), "ray_port": (int, 6379, 1024, 65535), "network_interface": (str, None),
    },
    "backend": {"repo_path": (str, MUST), "commit": (str, MUST), "python": (str, "python"), "script": (str, "open_instruct/grpo_fast.py"), "extra_args": (strings, [])},
    "model": {"name_or_path": (str, MUST), "max_prompt_tokens": (int, 2048, 1), "response_tokens": (int, 8192, 1), "per_turn_tokens": (int, 4096, 1), "pack_length": (int, 10240, 1)},
    "task": {"kind": (str, MUST, ("math", "code")), "sandbox": (dict, None), "system_prompt_file": (str, None), "max_steps": (int, 1, 1), "pool_size": (int, 128, 1)},
    "rollout": {
        "engines": (int, MUST, 1), "tensor_parallel_size": (int, 1, 1), "unique_prompts": (int, 8, 1), "samples_per_prompt": (int, 16, 2), "temperature": (float, 1.0, "+"),
        "gpu_memory_utilization": (float, 0.8, "+", 1), "async_steps": (int, 1, 0), "active_sampling": (bool, True), "inflight_updates": (bool, True),
        "enable_prefix_caching": (bool, True), "enforce_eager": (bool, False), "gdn_prefill_backend": (str, "triton"),
    },
    "training": {
        "learner_gpus_per_node": (whole_numbers, MUST), "sequence_parallel_size": (int, 1, 1), "learning_rate": (float, 1e-6, "+"), "total_episodes": (int, 1024, 1), "epochs": (int, 1, 1),
        "deepspeed_stage": (int, 3, (2, 3)), "loss": (str, "dppo", ("grpo", "dppo")), "dppo_divergence_type": (str, "tv", ("tv", "kl", "js")), "dppo_divergence_threshold": (float, 0.1, "+"),
        "beta": (float, 0.0, 0), "seed": (int, 42), "save_freq": (int, 20, 0), "checkpoint_state_freq": (int, 10, 0), "gradient_checkpointing": (bool, True), "use_liger_loss": (bool, True),
    },
    "output": {"directory": (str, MUST), "rollout_directory": (str, MUST), "experiment_name": (str, MUST), "with_tracking": (bool, True), "wandb_mode": (str, "offline", ("online", "offline", "disabled"))},
    "gates": {"max_zero_std_fraction": (float, 0.80, 0, 1), "max_truncation_fraction": (float, 0.15, 0, 1), "max_error_fraction": (float, 0.02, 0, 1), "max_policy_lag": (int, 4, 0), "min_mean_reward": (float, None, 0, 1)},
}
DATASET = {"path": (str, MUST), "weight": (float, 1.0, "+"), "split": (str, "train")}
SANDBOX = {
    "backend": (str, "apptainer", ("apptainer", "prepared_apptainer", "docker")), "image": (str, MUST), "binary": (str, "singularity"), "fakeroot": (bool, False), "task_data_hf_repo": (str, None),
    "task_data_dir": (str, None), "test_timeout": (int, 600, 1), "command_timeout": (int, 120, 1), "cache_dir": (str, None), "tmp_dir": (str, None), "prepared_root": (str, None),
    "prepared_cache_dir": (str, None), "prepared_scratch_root": (str, None),
}
OWN = {"name": (str, MUST), "environment": (string_map, {})}
TOP = {"version", "name", "datasets", "environment", *FIELDS}


def checked(config: dict) -> tuple[dict, list[str]]:
    """All sections with defaults, and the problems of single fields; rules between fields are topology.violations()."""
    problems = [f"{k}: unknown_field" for k in config if k not in TOP]
    out = dict(config)
    if config.get("version", 1) != 1:
        problems.append("version: not_a_choice")
    problems += [p.removeprefix(".") for p in section({k: config[k] for k in OWN if k in config}, OWN, "")[1]]
    for name, fields in FIELDS.items():
        out[name], found = section(config.get(name) or {}, fields, name)
        problems += found
    if out["task"]["sandbox"]:
        out["task"]["sandbox"], found = section(out["task"]["sandbox"], SANDBOX, "task.sandbox")
        problems += found
    if not config.get("datasets"):
        problems.append("datasets: missing")
    elif not isinstance(config["datasets"], list):
        return out, [*problems, "datasets: wrong_type"]
    for k, d in enumerate(config.get("datasets") or []):
        problems += section(d, DATASET, f"datasets[{k}]")[1]
    return out, problems


def profile_row(config: dict) -> tuple:
    c, _ = checked(config)
    m, r, t = c["model"], c["rollout"], c["training"]
    sandbox = c["task"]["sandbox"]
    return (
        c.get("name"), c["task"]["kind"], sandbox and sandbox["backend"], c["platform"]["nodes"], c["platform"]["gpus_per_node"], t["learner_gpus_per_node"],
        t["sequence_parallel_size"], r["engines"], r["tensor_parallel_size"], r["unique_prompts"], r["samples_per_prompt"], r["async_steps"],
        m["max_prompt_tokens"], m["response_tokens"], m["per_turn_tokens"], m["pack_length"],
    )


def read(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """Every configuration below path with its profile's columns, its datasets and its problems (none: it is whole).

    Where there are problems, the columns are null. Values are checked on executors, file by file; see objects.read().
    """
    names = [c.split()[0] for c in PROFILE.split(", ")]

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, found = [], []
            for value, error in zip(batch["value"], batch["error"], strict=True):
                problems = [error] if error else checked(config := json.loads(value))[1]
                row = dict(zip(names, (None,) * len(names) if problems else profile_row(config), strict=True))
                datasets = None if problems else [section(d, DATASET, "")[0] | {"weight": float(d.get("weight", 1.0))} for d in config["datasets"]]
                out.append(json.dumps(row | {"datasets": datasets}, allow_nan=False) if not problems else "{}")
                found.append(problems)
            yield pd.DataFrame({"file": batch["file"], "position": batch["position"], "row": out, "problems": found})

    done = objects.read(spark, path, form).mapInPandas(check, "file string, position bigint, row string, problems array<string>")
    row = F.from_json("row", f"{PROFILE}, datasets array<struct<path:string,weight:double,split:string>>")
    return done.select("file", "position", row.alias("r"), "problems").select("file", "position", "r.*", "problems")


def load(paths: Iterable[str]) -> list[dict]:
    """Configurations of a few files, on the driver; read() is for many."""
    return [c for p in paths for c in objects.parsed(Path(p).read_text(), p.endswith((".yaml", ".yml")))]


def profiles(spark: SparkSession, configs: Iterable[dict]) -> DataFrame:
    """One row for each configuration, for topology() and violations()."""
    return spark.createDataFrame([profile_row(c) for c in configs], PROFILE)


def limits(config: dict) -> Limits:
    return Limits(**checked(config)[0]["gates"])
