"""Queries of files of objects: run configurations, tasks and manifests, written from the tables as YAML or JSON and read on executors; and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritrail.operators import datasets, topology
from veritrail.plans import registry
from veritrail.sources import configs, objects
from veritrail.sources.shared import new_path

#: A run for each customer; which rules it breaks depends on its key. {list} makes an array of two.
RUNS = """SELECT c_custkey AS k, concat('run-', CAST(c_custkey AS VARCHAR(20))) AS name, CASE WHEN c_custkey % 3 = 0 THEN 'code' ELSE 'math' END AS task_kind, c_custkey % 3 = 0 AND c_custkey % 19 > 0 OR c_custkey % 23 = 0 AS boxed,
  c_custkey % 4 + 1 AS nodes, CAST(8 AS BIGINT) AS g, {list}(c_custkey % 9 + 1, c_custkey % 5 + 1) AS l, c_custkey % 3 + 1 AS sp, c_custkey % 6 + 1 AS engines, c_custkey % 2 + 1 AS tp, c_custkey % 5 + 1 AS prompts, c_custkey % 4 + 2 AS samples,
  c_custkey % 2 AS async_steps, CASE WHEN c_custkey % 7 = 0 THEN 9000 ELSE 4096 END AS per_turn, CASE WHEN c_custkey % 10 = 0 THEN 9000 ELSE 10240 END AS pack FROM customer"""
#: divisor of the key, section, field, value as JSON, and the problem that it makes
FAULTS = (
    (29, "platform", "ray_port", "80", "platform.ray_port: out_of_range"), (31, "task", "kind", '"prose"', "task.kind: not_a_choice"), (37, "rollout", "temperature", "0", "rollout.temperature: out_of_range"),
    (41, "platform", "nodes", '"1"', "platform.nodes: wrong_type"), (43, "training", "extra", "1", "training.extra: unknown_field"), (47, "model", "name_or_path", "null", "model.name_or_path: missing"),
    (53, "gates", "max_error_fraction", "1.5", "gates.max_error_fraction: out_of_range"), (59, "training", "loss", '"ppo"', "training.loss: not_a_choice"), (61, "output", "directory", "7", "output.directory: wrong_type"),
    (67, "rollout", "active_sampling", '"yes"', "rollout.active_sampling: wrong_type"),
)
PER_FILE = 50


def as_list(rows: DataFrame, value: Column, key: str) -> DataFrame:
    """(value, of) with the brackets and commas of one JSON list for each value of of, in order of key."""
    order = Window.partitionBy("of").orderBy(key)
    first, last = F.row_number().over(order) == 1, F.lead(key).over(order).isNull()
    return rows.select("of", F.concat(F.when(first, "[").otherwise(","), value, F.when(last, "]").otherwise("")).alias("value"))


def run_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, value) of configurations as JSON."""
    df = registry.sql(spark, sf_dir, RUNS.format(list="array"), "customer")
    at = {("platform", "nodes"): "nodes", ("platform", "gpus_per_node"): "g", ("model", "per_turn_tokens"): "per_turn", ("model", "pack_length"): "pack", ("rollout", "engines"): "engines", ("rollout", "tensor_parallel_size"): "tp",
        ("rollout", "unique_prompts"): "prompts", ("rollout", "samples_per_prompt"): "samples", ("rollout", "async_steps"): "async_steps", ("training", "sequence_parallel_size"): "sp"}
    fields: dict[str, dict[str, Column]] = {s: {} for s in configs.FIELDS}
    for (s, f), c in at.items():
        fields[s][f] = F.col(c).cast("string")
    fields["training"]["learner_gpus_per_node"] = F.to_json("l")
    fields["task"] |= {"kind": F.concat(F.lit('"'), "task_kind", F.lit('"')), "sandbox": F.when(F.col("boxed"), '{"image": "i"}').otherwise("null")}
    for s, f in (("platform", "container"), ("platform", "account"), ("platform", "partition"), ("backend", "repo_path"), ("backend", "commit"), ("model", "name_or_path"), ("output", "directory"), ("output", "rollout_directory"), ("output", "experiment_name")):
        fields[s][f] = F.lit('"x"')
    fields["platform"]["accelerator"] = F.lit('"cuda"')
    for divisor, s, f, value, _ in FAULTS:
        fields[s][f] = F.when(F.col("k") % divisor == 0, F.lit(value)).otherwise(fields[s].get(f, F.lit(None).cast("string")))
    part = lambda f, v: F.concat(F.lit(f'"{f}": '), v)
    sections = [F.concat(F.lit(f'"{s}": {{'), F.array_join(F.array_compact(F.array(*[part(f, v) for f, v in each.items()])), ", "), F.lit("}")) for s, each in fields.items()]
    top = [F.concat(F.lit('"name": "'), "name", F.lit('"')), F.lit('"version": 1'), F.concat(F.lit('"datasets": [{"path": "d", "weight": '), F.col("sp").cast("string"), F.lit("}]"))]
    return df.select("k", F.concat(F.lit("{"), F.array_join(F.array(*top, *sections), ", "), F.lit("}")).alias("value"))


def runs_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of PER_FILE configurations each, every other file as a YAML list of flow mappings."""
    path = new_path(spark, "runs")
    rows = run_objects(spark, sf_dir).withColumn("of", F.floor(F.col("k") / PER_FILE))
    as_list(rows.filter("of % 2 = 0"), F.col("value"), "k").write.partitionBy("of").text(f"{path}/json")
    lines = rows.filter("of % 2 = 1").repartition("of").sortWithinPartitions("of", "k").select("of", F.concat(F.lit("- "), "value").alias("value"))
    lines.write.partitionBy("of").text(f"{path}/yaml")
    return configs.read(spark, f"{path}/json", "json").unionByName(configs.read(spark, f"{path}/yaml", "yaml"))


def config_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many configurations have each problem, and how many have none."""
    found = runs_read(spark, sf_dir).select(F.explode(F.when(F.size("problems") > 0, F.col("problems")).otherwise(F.array(F.lit("none")))).alias("problem"))
    return found.groupBy("problem").agg(F.count("*").alias("n"))


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_read(spark, sf_dir).filter(F.size("problems") == 0)


def config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole(spark, sf_dir)
    return rows.select("name", "task_kind", "sandbox", "nodes", "engines", "max_prompt", "response_length", "pack_length", F.col("datasets")[0]["weight"].alias("weight"), F.col("datasets")[0]["split"].alias("split"))


def config_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.topology(whole(spark, sf_dir))


def config_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.violation_rows(whole(spark, sf_dir))


def validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.validate_summary(whole(spark, sf_dir)).select("name", "valid", "task", "topology.capacity", "topology.spare_gpus", "topology.samples_per_step")


TASKS = """SELECT p_partkey AS k, CAST(floor(p_partkey / 50.0) AS BIGINT) AS of, concat('task-', CAST(p_partkey AS VARCHAR(20))) AS id, CASE WHEN p_partkey % 2 = 0 THEN 'math' ELSE 'code' END AS kind, p_name AS prompt,
  p_partkey % 3 AS truth, CAST(p_size AS VARCHAR(20)) AS size, p_partkey % 17 AS fault FROM part"""


def task_files(spark: SparkSession, sf_dir: str, form: str) -> tuple[DataFrame, DataFrame]:
    """Tasks of part: with no ground truth, a single one or several; one in seventeen has an unknown field, a wrong type, no prompt or a number for a file."""
    path = new_path(spark, "tasks")
    df = registry.sql(spark, sf_dir, TASKS, "part")
    truth = F.when(F.col("truth") == 1, F.concat(F.lit('"'), "size", F.lit('"'))).when(F.col("truth") == 2, F.concat(F.lit('["'), "size", F.lit('", "'), "size", F.lit('/1"]'))).otherwise(F.lit("null"))
    more = F.when(F.col("fault") == 1, ', "extra": 1').when(F.col("fault") == 2, ', "candidate_path": 5').when(F.col("fault") == 3, ', "files": {"a": 1}').otherwise("")
    named = F.to_json(F.struct("id", "kind", F.when(F.col("fault") != 4, F.col("prompt")).alias("prompt")))
    value = F.concat(F.lit('{"ground_truth": '), truth, more, F.lit(", "), F.substring(named, F.lit(2), F.lit(1 << 20)))
    if form == "json":
        as_list(df, value, "k").write.partitionBy("of").text(path)
    else:
        df.repartition("of").sortWithinPartitions("of", "k").select("of", F.concat(F.lit("- "), value).alias("value")).write.partitionBy("of").text(path)
    return objects.tasks(spark, path, form)


def tasks_scanned(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    rows, rejects = task_files(spark, sf_dir, form)
    good = rows.select("id", "kind", F.array_join("ground_truth", "|").alias("truths"), "candidate_path", F.lit(None).cast("string").alias("problems"))
    bad = rejects.select(F.get_json_object("value", "$.id").alias("id"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("truths"), F.lit(None).cast("string").alias("candidate_path"), F.array_join("problems", ",").alias("problems"))
    return good.unionByName(bad)


def task_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks_scanned(spark, sf_dir, "json")


def task_scan_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks_scanned(spark, sf_dir, "yaml")


def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of part as YAML files; one in thirteen has no test script, one in eleven is not an object."""
    path = new_path(spark, "manifests")
    df = registry.sql(spark, sf_dir, registry.MANIFESTS.replace(" FROM part", ", p_partkey AS k FROM part"), "part")
    files = {"seed_files": F.expr("map('a/b.py', instruction)"), "test_files": F.expr("map(if(k % 13 = 0, 'other.sh', 'test.sh'), 'exit 0')")}
    value = F.when(F.col("k") % 11 == 0, "just text").otherwise(F.to_json(F.struct("id", "instruction", "image", "max_steps", "copies", "seed_files", "test_files")))
    made = df.withColumns(files).select(F.floor(F.col("k") / PER_FILE).alias("of"), "k", F.concat(F.lit("- "), value).alias("value"))
    made.repartition("of").sortWithinPartitions("of", "k").select("of", "value").write.partitionBy("of").text(path)
    rows, rejects = objects.manifests(spark, path, "yaml")
    judged = datasets.broken_manifests(rows)
    good = datasets.code_rows(judged.filter(F.size("broken") == 0).drop("broken")).select("instance_id", "env_config.max_steps", "env_config.image")
    broken = judged.filter(F.size("broken") > 0).select(F.concat("id", F.lit(": "), F.array_join("broken", ",")).alias("instance_id"), "max_steps", "image")
    none = rejects.select(F.array_join("problems", ",").alias("instance_id"), F.lit(0).cast("bigint").alias("max_steps"), F.lit("").alias("image"))
    return good.unionByName(broken).unionByName(none)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (config_faults, config_scan, config_topology, config_violations, validate_summary, task_scan, task_scan_yaml, manifest_scan)
}

_P = f"""p AS (SELECT *, CASE WHEN boxed THEN 'apptainer' END AS sandbox, CAST(8192 AS BIGINT) AS response, CAST(2048 AS BIGINT) AS max_prompt FROM ({RUNS.format(list="list_value")}) r
  WHERE {" AND ".join(f"k % {d} > 0" for d, *_ in FAULTS)})"""
_VALID = " OR ".join(f"({w})" for _, w in registry._RULES)
_TASK = f"""WITH t AS ({TASKS}) SELECT id, CASE WHEN fault NOT IN (1, 2, 3, 4) THEN kind END AS kind, CASE WHEN fault NOT IN (1, 2, 3, 4) THEN CASE truth WHEN 1 THEN size WHEN 2 THEN concat(size, '|', size, '/1') END END AS truths,
  CASE WHEN fault NOT IN (1, 2, 3, 4) THEN 'solution.py' END AS candidate_path,
  CASE fault WHEN 1 THEN 'extra: unknown_field' WHEN 2 THEN 'candidate_path: wrong_type' WHEN 3 THEN 'files: wrong_type' WHEN 4 THEN 'prompt: missing' END AS problems FROM t"""

ORACLES: dict[str, str] = {
    "config_faults": "SELECT problem, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{p}' AS problem FROM customer WHERE c_custkey % {d} = 0" for d, *_, p in FAULTS)
    + f" UNION ALL SELECT 'none' FROM customer WHERE {' AND '.join(f'c_custkey % {d} > 0' for d, *_ in FAULTS)}) x GROUP BY problem",
    "config_scan": f"WITH {_P} SELECT name, task_kind, sandbox, nodes, engines, max_prompt, response AS response_length, CAST(pack AS BIGINT) AS pack_length, CAST(sp AS DOUBLE) AS weight, 'train' AS split FROM p",
    "config_topology": f"""WITH {_P} SELECT name, CAST(nodes * g AS BIGINT) AS capacity, CAST(list_sum(l) AS BIGINT) AS learner_gpus, CAST(engines * tp AS BIGINT) AS rollout_gpus,
      CAST(nodes * g - list_sum(l) - engines * tp AS BIGINT) AS spare_gpus, CAST(len(l) AS BIGINT) AS learner_nodes, CAST(engines AS BIGINT) AS rollout_engines,
      CAST(tp AS BIGINT) AS tensor_parallel, CAST(list_sum(l) // sp AS BIGINT) AS data_parallel_ranks, CAST(prompts * samples AS BIGINT) AS samples_per_step FROM p""",
    "config_violations": f"WITH {_P}, r AS (" + " UNION ALL ".join(f"SELECT name, {k} AS k, '{n}' AS rule FROM p WHERE {w}" for k, (n, w) in enumerate(registry._RULES)) + ") SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY k) - 1 AS INT) AS position, rule FROM r",
    "validate_summary": f"""WITH {_P} SELECT name, NOT coalesce({_VALID}, false) AS valid, task_kind AS task, CAST(nodes * g AS BIGINT) AS capacity,
      CAST(nodes * g - list_sum(l) - engines * tp AS BIGINT) AS spare_gpus, CAST(prompts * samples AS BIGINT) AS samples_per_step FROM p""",
    "task_scan": _TASK,
    "task_scan_yaml": _TASK,
    "manifest_scan": f"""WITH m AS ({registry.MANIFESTS.replace(" FROM part", ", p_partkey AS k FROM part")}), c AS (SELECT *, unnest(range(copies)) AS copy FROM m WHERE k % 13 > 0 AND k % 11 > 0)
      SELECT concat(id, '-', CAST(copy AS VARCHAR)) AS instance_id, max_steps, image FROM c UNION ALL SELECT concat(id, ': no_test'), max_steps, image FROM m WHERE k % 13 = 0 AND k % 11 > 0
      UNION ALL SELECT 'not_an_object', 0, '' FROM m WHERE k % 11 = 0""",
}
