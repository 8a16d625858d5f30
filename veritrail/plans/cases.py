"""Queries of readers, sinks, rules and verifiers, and their SQL: files are written from the tables and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.functions.answers import extract_answer
from veritrail.operators import datasets, gates, validation, verify
from veritrail.plans import registry
from veritrail.sources import archive
from veritrail.sources import trajectories as log
from veritrail.sources.shared import new_path, settle
from veritrail.streaming import gate as stream

#: One JSON line for each order; what is wrong with it depends on its key.
GOOD = """to_json(named_struct('run_id', 'r', 'task_id', concat('task-', CAST(o_custkey AS STRING)), 'task_kind', 'math', 'prompt', 'p', 'completion', o_orderpriority,
  'verifier', named_struct('reward', CAST(o_orderkey % 2 AS DOUBLE), 'passed', o_orderkey % 2 = 1, 'verifier', 'math', 'reason', 'as told', 'duration_seconds', CAST(0.5 AS DOUBLE)),
  'policy_version', o_custkey % 9, 'learner_version', o_orderkey % 11, 'response_tokens', o_orderkey % 50, 'max_response_tokens', 48, 'entropy', CAST(o_custkey % 4 AS DOUBLE), 'created_at', '2024-01-01T00:00:00Z'))"""
LINES = f"""
  SELECT o_orderkey AS id, CASE CAST(o_orderkey % 20 AS INT)
    WHEN 0 THEN concat('{{"extra": 1, ', substr(good, 2)) WHEN 1 THEN replace(good, '"prompt":"p",', '') WHEN 2 THEN replace(good, '"max_response_tokens":48', '"max_response_tokens":"48"')
    WHEN 3 THEN replace(good, '"reward":1.0', '"reward":1.5') WHEN 4 THEN replace(good, '"max_response_tokens":48', '"max_response_tokens":0')
    WHEN 5 THEN replace(good, '"duration_seconds":0.5', '"duration_seconds":-0.5') WHEN 6 THEN 'nonsense' WHEN 7 THEN '  '
    WHEN 8 THEN replace(good, '"reason":"as told"', '"reason":"as told","more":[1]') WHEN 9 THEN replace(good, '"task_kind":"math"', '"task_kind":"prose"') ELSE good END AS value
  FROM (SELECT o_orderkey, {GOOD} AS good FROM orders)"""
GOOD_ROWS = """SELECT concat('task-', CAST(o_custkey AS VARCHAR)) AS task_id, CAST(o_custkey % 9 AS BIGINT) AS policy_version, CAST(greatest(0, o_orderkey % 11 - o_custkey % 9) AS BIGINT) AS policy_lag,
  o_orderkey % 50 >= 48 AS truncated, CAST(o_orderkey % 2 AS DOUBLE) AS reward, o_orderpriority AS completion FROM orders WHERE o_orderkey % 20 >= 10"""


def log_path(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "log")
    registry.sql(spark, sf_dir, LINES, "orders").select("value").write.text(path)
    return path


def flat(rows: DataFrame) -> DataFrame:
    return rows.select("task_id", "policy_version", "policy_lag", "truncated", "verifier.reward", "completion")


def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(log.read_trajectories(spark, log_path(spark, sf_dir))[0])


def log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = log.read_trajectories(spark, log_path(spark, sf_dir))[1]
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def log_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that isn't there has no rows, beside one that is."""
    none, some = (log.read_trajectories(spark, p)[0] for p in (new_path(spark, "no-log"), log_path(spark, sf_dir)))
    return none.agg(F.count("*").alias("n")).crossJoin(some.agg(F.count("*").alias("n_there")))  # one row each


def monthly_log(spark: SparkSession, sf_dir: str) -> str:
    """A file for each month of orders, lines in order of the key."""
    path = new_path(spark, "log")
    lines = registry.sql(spark, sf_dir, f"SELECT id, value, date_format(o_orderdate, 'yyyy-MM') AS month FROM ({LINES}) x JOIN orders ON id = o_orderkey", "orders")
    lines.repartition("month").sortWithinPartitions("month", "id").select("value", "month").write.partitionBy("month").text(path)
    return path


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected line's number in its file."""
    found = log.numbered_rejects(spark, monthly_log(spark, sf_dir))
    return found.select(F.regexp_extract("file", r"month=([^/]+)/", 1).alias("month"), "line", F.array_join("reasons", ",").alias("reasons"))


def log_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file and number of the first bad line."""
    at = log.first_bad_line(spark, monthly_log(spark, sf_dir))
    return spark.createDataFrame([(at.split("month=")[1].split("/")[0], int(at.rsplit(":", 1)[1]))], "month string, line long")


def log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, compacted to Parquet and read back. The rows are written once, so that the second append doesn't parse the log again."""
    rows = settle(log.read_trajectories(spark, log_path(spark, sf_dir))[0], "rows")
    shards = new_path(spark, "shards")
    log.append(rows, shards)
    log.append(rows, shards)
    packed = log.compact(spark, shards, new_path(spark, "packed.parquet"))
    return packed.groupBy("task_id").agg(F.count("*").alias("n"), F.sum("verifier.reward").alias("reward"), F.sum("entropy").alias("entropy"))


def rows_back(spark: SparkSession, sf_dir: str, end: str) -> DataFrame:
    path = new_path(spark, "rows") + end
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("né-"), "c_name")).alias("c_name"), "c_acctbal")
    log.write_rows(rows, path)
    log.write_rows(rows, path)  # replaces what was there
    return (spark.read.parquet(path) if end == ".parquet" else log.read_jsonl(spark, path)).select("c_custkey", "c_name", "c_acctbal")


def rows_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_back(spark, sf_dir, ".parquet")


def rows_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_back(spark, sf_dir, ".jsonl")


TASKS = """SELECT concat('task-', CAST(p_partkey AS STRING)) AS id, CASE WHEN p_partkey % 7 = 0 THEN 'prose' WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'math' ELSE 'code' END AS kind, p_name AS prompt,
  CASE WHEN p_partkey % 5 = 0 THEN '../x.py' WHEN p_partkey % 11 = 0 THEN '/x.py' END AS candidate_path, p_partkey % 3 AS truth, p_size AS size FROM part"""


def task_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = registry.sql(spark, sf_dir, TASKS, "part")
    truth, command = F.when(F.col("truth") > 0, F.array(F.lit("1"))), F.when(F.col("truth") > 0, F.array(F.lit("true"))).otherwise(F.array().cast("array<string>"))
    broken = validation.task_rules(tasks.withColumns({"ground_truth": truth, "test_command": command}))
    return broken.select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


MANIFESTS = """SELECT CASE WHEN p_partkey % 6 = 0 THEN '..' ELSE concat('task-', CAST(p_partkey AS STRING)) END AS id, p_name AS instruction, 'image' AS image, p_partkey AS k, p_size AS max_steps FROM part"""


def broken_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = registry.sql(spark, sf_dir, MANIFESTS, "part")
    files = {"seed_files": F.create_map(F.when(F.col("k") % 5 == 0, F.lit("a/../../b")).otherwise(F.lit("a/b")), F.lit("x")), "test_files": F.create_map(F.when(F.col("k") % 4 == 0, F.lit("other.sh")).otherwise(F.lit("test.sh")), F.lit("x"))}
    made = df.withColumns(files | {"copies": (F.col("k") % 3).cast("bigint"), "max_steps": F.col("max_steps").cast("bigint")}).drop("k")
    return datasets.broken_manifests(made).select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


NATIONS = """SELECT concat('task-', CAST(n_nationkey AS VARCHAR(20))) AS id, concat(chr(10), ' ', chr(9), n_name, ' ', chr(13), chr(10), chr(10)) AS instruction, concat(chr(12), 'image', chr(9)) AS image, CAST(n_nationkey + 1 AS BIGINT) AS max_steps, CAST(2 AS BIGINT) AS copies FROM nation"""


def nation_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.sql(spark, sf_dir, NATIONS, "nation").withColumns({"seed_files": F.expr("map('d/a.py', instruction)"), "test_files": F.expr("map('test.sh', 'exit 0')")})


def tree(spark: SparkSession, sf_dir: str) -> str:
    root = new_path(spark, "task-tree").removeprefix("file://")
    datasets.write_task_tree(nation_manifests(spark, sf_dir), root)
    return root


def task_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.read_task_tree(spark, tree(spark, sf_dir))


def task_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a task for each part, as one archive, and its entries read back member by member."""
    manifests = registry.sql(spark, sf_dir, registry.MANIFESTS, "part").withColumns({"seed_files": F.expr("map('d/a.py', instruction)"), "test_files": F.expr("map('test.sh', 'exit 0')")})
    path = new_path(spark, "task-data") + ".tar.gz"
    return archive.read(spark, archive.write(datasets.file_rows(manifests), path), path)


def completion_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each nation, of several lines; the answer comes from the whole."""
    path = new_path(spark, "completions")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", F.concat(F.lit("First line\nAnswer: "), F.col("n_name"), F.lit("\nbye")).alias("value"))
    nations.repartition(F.col("n_nationkey")).write.partitionBy("n_nationkey").text(path)
    got = log.read_completions(spark, path)
    key = F.regexp_extract("path", r"n_nationkey=(\d+)/", 1).cast("int")
    return got.select(key.alias("n_nationkey"), extract_answer(F.col("completion")).alias("answer"), F.length("completion").alias("n_chars"))


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as JSON and back."""
    report = registry.report_columns(gates.gate_report(registry.trajectories(spark, sf_dir)))
    text = spark.createDataFrame([(log.report_json(report.first()),)], "value string")
    return text.select(F.from_json("value", report.schema).alias("r")).select("r.*")


def gate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = gates.gate_report(registry.trajectories(spark, sf_dir), registry.TIGHT).first()
    return spark.createDataFrame([(m,) for m in gates.messages(row)], "message string")


def streaming_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over a file stream; equal to the batch report."""
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    lines = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem*.parquet").option("recursiveFileLookup", True).parquet(sf_dir)
    rows = spark.sql(registry._braced(registry.TRAJECTORIES, ("lineitem",)), lineitem=lines)
    state = new_path(spark, "gate-state")
    query = stream.start(rows, state, new_path(spark, "gate-checkpoint"))
    query.awaitTermination()
    return registry.report_columns(stream.report(spark, state))


SEVERAL = """SELECT o_orderkey AS id, 'math' AS kind, CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN concat('<final>', CAST(o_custkey AS VARCHAR(20)), '/4</final>')
    WHEN 1 THEN concat('answer: ', CAST(o_custkey AS VARCHAR(20)), '.50') ELSE concat('It is{n}', CAST(o_custkey AS VARCHAR(20))) END AS completion, o_custkey AS c, CAST(o_orderkey % 4 AS INT) AS way FROM orders"""


def math_several_truths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No, one, two or three accepted answers; one is enough."""
    rows = registry.sql(spark, sf_dir, SEVERAL.replace("{n}", "\\n"), "orders")
    c = F.col("c").cast("string")
    half = F.concat("c", F.lit("+1/2"))
    truths = F.when(F.col("way") == 0, F.array().cast("array<string>")).when(F.col("way") == 1, F.array(c)).when(F.col("way") == 2, F.array(F.lit("x"), half)).otherwise(F.array(half, F.lit("-1"), F.concat(c, F.lit("/4"))))
    return verify.math_verify(rows.withColumn("ground_truth", truths)).select("id", "passed", "reward")


def deep_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to nine fractions in each other."""
    nested = F.aggregate(F.sequence(F.lit(1), (F.col("o_orderkey") % 9 + 1).cast("int")), F.col("o_custkey").cast("string"), lambda s, i: F.concat(F.lit("\\frac{"), s, F.lit("}{2}")))
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.lit("math").alias("kind"), F.concat(F.lit("\\boxed{"), nested, F.lit("}")).alias("completion"), F.array(F.concat(F.col("o_custkey").cast("string"), F.lit("/64"))).alias("ground_truth"))
    return verify.math_verify(df).select("id", "passed")


def case_folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters are compared folded, also those that fold to two."""
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    name = F.concat(F.lit("Straße "), F.col("c_mktsegment"))
    truth = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("STRASSE"), F.lower("c_mktsegment"))).otherwise(F.lit("strase"))
    return verify.math_verify(df.select(F.col("c_custkey").alias("id"), F.lit("math").alias("kind"), F.concat(F.lit("answer: "), name).alias("completion"), F.array(truth).alias("ground_truth"))).select("id", "passed")


TEST_FILE = "import solution\nassert solution.twice(KEY) == 2 * KEY\nprint('x' * 40000)\n"


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Math and code tasks by the verifiers of their kinds; each code runs in a workspace of its own."""
    key = F.col("n_nationkey").cast("string")
    way = F.col("n_nationkey") % 6
    body = F.when(way == 1, F.lit("def twice(x):\n    return x + 3\n")).when(way == 2, F.lit("import time\ntime.sleep(60)\n")).otherwise(F.lit("def twice(x):\n    return 2 * x\n"))
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        key.alias("id"), F.when(way == 0, "math").otherwise("code").alias("kind"), F.array(F.concat(key, F.lit("/1"))).alias("ground_truth"),
        F.when(way == 3, F.lit("../solution.py")).otherwise(F.lit("solution.py")).alias("candidate_path"), F.array(F.when(way == 4, F.lit("no-such-program")).otherwise(F.lit("python")), F.lit("check.py")).alias("test_command"),
        F.create_map(F.lit("check.py"), F.replace(F.lit(TEST_FILE), F.lit("KEY"), key)).alias("files"),
        F.when(way == 0, F.concat(F.lit("<final>"), key, F.lit("</final>"))).otherwise(F.concat(F.lit("Here:\n```python\n"), body, F.lit("```"))).alias("completion"),
    )
    done = verify.verify(rows, {"math": verify.MathVerifier(), "code": verify.CodeVerifier(verify.LocalRunner(trusted=True), timeout=5.0)})
    return done.select("id", "verifier", "passed", "reward", "error_type", F.length("stdout").alias("n_stdout"))


def no_container(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A container program that isn't there is a sandbox error of each row."""
    key = F.col("r_regionkey").cast("string")
    rows = spark.read.parquet(f"{sf_dir}/region.parquet").select(key.alias("id"), F.lit("code").alias("kind"), F.lit(None).cast("string").alias("candidate_path"), F.array(F.lit("true")).alias("test_command"), F.create_map(F.lit("a"), F.lit("b")).alias("files"), F.lit("x").alias("completion"))
    return verify.code_verify(rows, verify.ContainerRunner("image", "no-such-container-program")).select("id", "passed", "error_type")


def verified_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs of customers, many of them alike: half of the rows first, then all; each program has run once. At most two run at a time on a machine."""
    k = F.col("c_nationkey")
    body = F.concat(F.lit("def twice(x):\n    return "), F.when(k % 3 == 0, F.lit("x + 1")).otherwise(F.lit("2 * x")), F.lit("  # "), k.cast("string"))
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("code").alias("kind"), F.lit(None).cast("string").alias("candidate_path"), F.array(F.lit("python"), F.lit("check.py")).alias("test_command"),
        F.create_map(F.lit("check.py"), F.lit("import solution\nassert solution.twice(3) == 6\n")).alias("files"), body.alias("completion"),
    )
    store, runner = new_path(spark, "results"), verify.LimitedRunner(verify.LocalRunner(trusted=True), verify.Slots(2, "verified-again"))
    verify.verify_resumable(rows.filter("CAST(id AS BIGINT) % 2 = 0"), runner, store, batch=10)
    done = verify.verify_resumable(rows, runner, store, batch=10)
    runs = spark.read.parquet(store).count()
    return done.select("id", "passed", "reward", "error_type", F.lit(runs).cast("bigint").alias("runs"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        log_scan, log_rejects, log_missing, log_lines, log_strict, log_append, rows_parquet, rows_jsonl, task_rules, broken_manifests, task_tree, task_archive, completion_scan,
        report_json, gate_messages, streaming_gate, math_several_truths, deep_fractions, case_folding, verified, verified_again, no_container,
    )
}

_WAY = "CASE WHEN way = 1 THEN 'tests' WHEN way = 2 THEN 'timeout' WHEN way IN (3, 4) THEN 'sandbox_error' END"
_TREE = f"""m AS ({NATIONS}), f AS (SELECT id, 'instruction.md' AS path, concat(n_name, chr(10)) AS content FROM nation JOIN m ON id = concat('task-', CAST(n_nationkey AS VARCHAR)) UNION ALL SELECT id, 'image.txt', concat('image', chr(10)) FROM m
  UNION ALL SELECT id, 'environment/seeds/d/a.py', instruction FROM m UNION ALL SELECT id, 'tests/test.sh', 'exit 0' FROM m)"""

_LINES = """l AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) AS line, CASE CAST(o_orderkey % 20 AS INT) WHEN 0 THEN 'unknown_field'
  WHEN 8 THEN 'unknown_field' WHEN 1 THEN 'missing_field' WHEN 2 THEN 'wrong_type' WHEN 3 THEN 'reward_range' WHEN 4 THEN 'max_tokens' WHEN 5 THEN 'duration' WHEN 6 THEN 'not_an_object' WHEN 9 THEN 'task_kind' END AS reasons FROM orders)"""

ORACLES: dict[str, str] = {
    "log_scan": GOOD_ROWS,
    "log_rejects": """SELECT CASE CAST(o_orderkey % 20 AS INT) WHEN 0 THEN 'unknown_field' WHEN 8 THEN 'unknown_field' WHEN 1 THEN 'missing_field' WHEN 2 THEN 'wrong_type' WHEN 3 THEN 'reward_range' WHEN 4 THEN 'max_tokens'
      WHEN 5 THEN 'duration' WHEN 6 THEN 'not_an_object' ELSE 'task_kind' END AS reason, count(*) AS n FROM orders WHERE o_orderkey % 20 < 10 AND o_orderkey % 20 <> 7 GROUP BY 1""",
    "log_missing": "SELECT CAST(0 AS BIGINT) AS n, count(*) AS n_there FROM orders WHERE o_orderkey % 20 >= 10",
    "log_lines": f"""WITH {_LINES} SELECT * FROM l WHERE reasons IS NOT NULL""",
    "log_strict": f"""WITH {_LINES} SELECT month, line FROM l WHERE reasons IS NOT NULL ORDER BY month, line LIMIT 1""",
    "log_append": """SELECT concat('task-', CAST(o_custkey AS VARCHAR)) AS task_id, 2 * count(*) AS n, CAST(2 * sum(o_orderkey % 2) AS DOUBLE) AS reward, CAST(2 * sum(o_custkey % 4) AS DOUBLE) AS entropy
      FROM orders WHERE o_orderkey % 20 >= 10 GROUP BY o_custkey""",
    "rows_parquet": "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN concat('né-', c_name) END AS c_name, c_acctbal FROM customer",
    "rows_jsonl": "SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN concat('né-', c_name) END AS c_name, c_acctbal FROM customer",
    "task_rules": f"""WITH t AS ({TASKS.replace("STRING", "VARCHAR")}) SELECT rule, count(*) AS n FROM (SELECT 'kind' AS rule FROM t WHERE kind = 'prose' OR kind IS NULL UNION ALL SELECT 'candidate_path' FROM t WHERE candidate_path IS NOT NULL
      UNION ALL SELECT 'math_needs_truth' FROM t WHERE kind = 'math' AND truth = 0 UNION ALL SELECT 'code_needs_command' FROM t WHERE kind = 'code' AND truth = 0) x GROUP BY rule""",
    "broken_manifests": """SELECT rule, count(*) AS n FROM (SELECT 'unsafe_id' AS rule FROM part WHERE p_partkey % 6 = 0 UNION ALL SELECT 'no_test' FROM part WHERE p_partkey % 4 = 0
      UNION ALL SELECT 'outside' FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT 'count' FROM part WHERE p_partkey % 3 = 0 OR p_size < 1) x GROUP BY rule""",
    "task_tree": f"WITH {_TREE} SELECT id AS task_id, path, content FROM f",
    "task_archive": f"""WITH m AS ({registry.MANIFESTS}), d AS (SELECT id, unnest(['', '/environment', '/environment/seeds', '/environment/seeds/d', '/tests']) AS path FROM m)
      SELECT concat(id, path) AS name, CAST(0 AS BIGINT) AS size, true AS folder FROM d UNION ALL SELECT concat(id, '/environment/seeds/d/a.py'), CAST(strlen(instruction) AS BIGINT), false FROM m
      UNION ALL SELECT concat(id, '/tests/test.sh'), 6, false FROM m UNION ALL SELECT concat(id, '/instruction.md'), CAST(strlen(trim(instruction, concat(chr(9), chr(10), ' '))) AS BIGINT) + 1, false FROM m
      UNION ALL SELECT concat(id, '/image.txt'), CAST(strlen(image) AS BIGINT) - 1, false FROM m""",
    "completion_scan": "SELECT n_nationkey, n_name AS answer, CAST(length(n_name) + 24 AS INT) AS n_chars FROM nation",
    "report_json": registry._report(),
    "gate_messages": f"""WITH r AS ({registry._report()}) SELECT * FROM (
      SELECT printf('zero-std groups %.3f > %.3f', zero_std_fraction, {registry.TIGHT.max_zero_std_fraction}) AS message FROM r WHERE zero_std_fraction > {registry.TIGHT.max_zero_std_fraction}
      UNION ALL SELECT printf('truncation %.3f > %.3f', truncation_fraction, {registry.TIGHT.max_truncation_fraction}) FROM r WHERE truncation_fraction > {registry.TIGHT.max_truncation_fraction}
      UNION ALL SELECT printf('verifier errors %.3f > %.3f', error_fraction, {registry.TIGHT.max_error_fraction}) FROM r WHERE error_fraction > {registry.TIGHT.max_error_fraction}
      UNION ALL SELECT printf('policy lag %d > %d', max_policy_lag, {registry.TIGHT.max_policy_lag}) FROM r WHERE max_policy_lag > {registry.TIGHT.max_policy_lag}
      UNION ALL SELECT printf('mean reward %.3f < %.3f', mean_reward, {registry.TIGHT.min_mean_reward}) FROM r WHERE mean_reward < {registry.TIGHT.min_mean_reward}) x""",
    "streaming_gate": registry._report(),
    "math_several_truths": """WITH v AS (SELECT o_orderkey AS id, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN false WHEN 1 THEN o_orderkey % 3 = 2 OR o_orderkey % 3 = 0 AND o_custkey = 0 WHEN 2 THEN o_orderkey % 3 = 1
        ELSE o_orderkey % 3 <= 1 OR o_custkey = 0 END AS passed FROM orders) SELECT id, passed, CAST(passed AS INT) * 1.0e0 AS reward FROM v""",
    "deep_fractions": "SELECT o_orderkey AS id, o_orderkey % 9 + 1 = 6 OR o_custkey = 0 AS passed FROM orders",
    "case_folding": "SELECT c_custkey AS id, c_custkey % 2 = 0 AS passed FROM customer",
    "verified": f"""WITH n AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_nationkey % 6 AS way, {_WAY.replace("way", "n_nationkey % 6")} AS e FROM nation) SELECT id, CASE WHEN way = 0 THEN 'math' ELSE 'code' END AS verifier,
      way IN (0, 5) AS passed, CASE WHEN way IN (0, 5) THEN 1.0e0 ELSE 0.0e0 END AS reward, CASE WHEN e <> 'tests' THEN e END AS error_type, CASE WHEN way = 5 OR way = 1 AND id = '3' THEN 32000 ELSE 0 END AS n_stdout FROM n""",
    "verified_again": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_nationkey % 3 > 0 AS passed, CASE WHEN c_nationkey % 3 > 0 THEN 1.0e0 ELSE 0.0e0 END AS reward, CAST(NULL AS VARCHAR) AS error_type, (SELECT count(DISTINCT c_nationkey) FROM customer) AS runs FROM customer",
    "no_container": "SELECT CAST(r_regionkey AS VARCHAR) AS id, false AS passed, 'sandbox_error' AS error_type FROM region",
}
