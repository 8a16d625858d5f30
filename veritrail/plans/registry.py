"""Query and oracle registry of the core engine.

The tables hold no trajectories or answers, so queries derive them from lineitem, orders, part and conversations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.functions.answers import extract_answer, extract_code, with_normal
from veritrail.operators import datasets, gates, validation, verify

TRAJECTORIES = """
  SELECT concat('task-', CAST(l_partkey AS VARCHAR(20))) AS task_id, CASE WHEN l_suppkey % 3 = 0 THEN 'code' ELSE 'math' END AS task_kind,
         year(l_shipdate) AS policy_version, year(l_shipdate) + l_linenumber - 3 AS learner_version,
         CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS DOUBLE) AS reward, CAST(l_quantity AS INT) AS response_tokens, 48 AS max_response_tokens,
         CASE WHEN l_returnflag = 'R' AND l_discount > 0.095 THEN 'timeout' END AS error_type, CASE WHEN l_tax > 0 THEN l_tax END AS entropy
  FROM lineitem"""
BROKEN = """
  SELECT task_id, CASE WHEN response_tokens = 7 THEN 'prose' ELSE task_kind END AS task_kind,
         CASE WHEN response_tokens = 5 THEN -1 ELSE policy_version END AS policy_version, learner_version,
         CASE WHEN response_tokens = 3 THEN CAST(1.5 AS DOUBLE) ELSE reward END AS reward, CASE WHEN response_tokens = 9 THEN -9 ELSE response_tokens END AS response_tokens,
         CASE WHEN response_tokens = 11 THEN 0 ELSE max_response_tokens END AS max_response_tokens, CASE WHEN response_tokens = 13 THEN CAST(-1 AS DOUBLE) ELSE entropy END AS entropy
  FROM t"""
TIGHT = gates.Limits(0.2, 0.05, 0.01, 3, 0.7)
#: Four ways to give an answer, by order key; {b} is a backslash.
COMPLETIONS = """
  SELECT o_orderkey AS id, CASE CAST(o_orderkey % 5 AS INT)
    WHEN 0 THEN concat('First {b}boxed{{1}} then {b}boxed{{', CAST(o_custkey AS VARCHAR(20)), '}} done')
    WHEN 1 THEN concat('Think.', {n}, '<FINAL> ', CAST(o_custkey AS VARCHAR(20)), ' </final> end')
    WHEN 2 THEN concat('So the Final answer: ', CAST(o_custkey AS VARCHAR(20)), '/7', {n}, 'bye')
    WHEN 3 THEN concat('Just a line', {n}, CAST(o_custkey AS VARCHAR(20)), '.', {n}, ' ')
    ELSE concat('x {b}boxed{{{b}frac{{', CAST(o_custkey AS VARCHAR(20)), '}}{{4}}}}') END AS completion
  FROM orders"""
VERIFY = """
  SELECT o_orderkey AS id, 'math' AS kind,
    CASE CAST(o_orderkey % 4 AS INT)
      WHEN 0 THEN concat('{b}boxed{{', CAST(2 * o_custkey AS VARCHAR(20)), '/4}}')
      WHEN 1 THEN concat('answer = ', CAST(o_custkey AS VARCHAR(20)))
      WHEN 2 THEN concat('{b}boxed{{{b}frac{{', CAST(3 * o_custkey AS VARCHAR(20)), '}}{{6}}}}')
      ELSE concat('{b}boxed{{', CAST(o_custkey AS VARCHAR(20)), '.5}}') END AS completion,
    CASE WHEN o_orderkey % 3 = 0 THEN concat(CAST(o_custkey AS VARCHAR(20)), '/2') ELSE CAST(o_custkey AS VARCHAR(20)) END AS truth
  FROM orders"""
MANIFESTS = """
  SELECT concat('task-', CAST(p_partkey AS VARCHAR(20))) AS id, concat(chr(9), p_name, ' ', chr(10)) AS instruction, concat('image-', CAST(p_size AS VARCHAR(20)), chr(13), chr(10)) AS image,
         CAST(p_size + 1 AS BIGINT) AS max_steps, CAST(p_partkey % 3 + 1 AS BIGINT) AS copies FROM part"""


def sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    views = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    return spark.sql(text if not views else _braced(text, names), **views)


def _braced(text: str, names: tuple[str, ...]) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) ({'|'.join(names)})\b", r"\1 {\2}", text.replace("{", "{{").replace("}", "}}"))


def spark_text(text: str) -> str:
    return text.format(b="\\\\", n="chr(10)")


def duck_text(text: str) -> str:
    return text.format(b="\\", n="chr(10)")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, TRAJECTORIES, "lineitem")


def report_columns(df: DataFrame, *by: str) -> DataFrame:
    return df.select(*by, "samples", "mean_reward", "zero_std_fraction", "truncation_fraction", "error_fraction", "max_policy_lag", F.round("mean_entropy", 9).alias("mean_entropy"), "passed")


def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_columns(gates.gate_report(trajectories(spark, sf_dir)))


def gate_report_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_columns(gates.gate_report(trajectories(spark, sf_dir), by=("task_kind",)), "task_kind")


def gate_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_columns(gates.gate_report(trajectories(spark, sf_dir).filter(F.lit(False))))


def gate_failures_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.failure_rows(gates.gate_report(trajectories(spark, sf_dir), TIGHT))


def reward_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.reward_groups(trajectories(spark, sf_dir)).select("task_id", "policy_version", "samples", "min_reward", "max_reward", "truncated", "errors", "max_policy_lag")


def active_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.active_sampling(trajectories(spark, sf_dir)).select("task_id", "policy_version", "reward", "response_tokens")


def centered_advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.centered_advantage(trajectories(spark, sf_dir)).select("task_id", "policy_version", "reward", F.round("advantage", 9).alias("advantage"))


def trajectory_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.flags(trajectories(spark, sf_dir)).select("task_id", "policy_version", "learner_version", "truncated", "policy_lag", "is_error")


def monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.monitoring(trajectories(spark, sf_dir))


def clipped_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trajectories(spark, sf_dir)
    return df.select("task_id", gates.clip_reward(F.col("reward") * 3 - 1).alias("reward")).groupBy("task_id").agg(F.sum("reward").alias("reward"))


def smoke_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.has_both_outcomes(trajectories(spark, sf_dir))


def validate_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.broken_counts(spark.sql(_braced(BROKEN, ("t",)), t=trajectories(spark, sf_dir)))


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, spark_text(COMPLETIONS), "orders")


def extract_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).select("id", extract_answer(F.col("completion")).alias("answer"))


def normalize_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = completions(spark, sf_dir).select("id", extract_answer(F.col("completion")).alias("raw"))
    return with_normal(extracted, "raw", "answer").select("id", "answer")


def math_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, spark_text(VERIFY), "orders").withColumn("ground_truth", F.array("truth"))
    return verify.math_verify(rows).select("id", "passed", "reward")


def extract_code_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    fenced = F.concat(F.lit("text\n```\nls\n```\nthen\n```python\nprint("), key, F.lit(")\n```\nbye"))
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return df.select(F.col("o_orderkey").alias("id"), extract_code(F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit(" plain "), key)).otherwise(fenced)).alias("code"))


def tail_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.right("text", F.lit(verify.CAPTURE)).alias("tail"))


def math_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tasks as part has rows."""
    m = F.col("messages")[0]
    count = spark.read.parquet(f"{sf_dir}/part.parquet").count()
    return datasets.math_smoke(spark, count).select(m["role"].alias("role"), m["content"].alias("content"), "ground_truth", "dataset")


def pack_code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = sql(spark, sf_dir, MANIFESTS, "part").withColumns({"seed_files": F.expr("map('a.py', instruction)"), "test_files": F.expr("map('test.sh', 'exit 0')")})
    rows = datasets.code_rows(manifests)
    return rows.select("instance_id", "dataset", F.col("tools")[0].alias("tool"), "env_config.max_steps", "env_config.task_id", "env_config.image")


def pack_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = sql(spark, sf_dir, MANIFESTS, "part").withColumns({"seed_files": F.expr("map('a.py', instruction)"), "test_files": F.expr("map('test.sh', 'exit 0')")})
    return datasets.file_rows(manifests)


def pack_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return turns.select("conv_id", F.posexplode("m").alias("position", "t")).select("conv_id", F.col("position").cast("bigint").alias("position"), "t.role", F.col("t.text").alias("content"))


def orphan_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_size > 25").select(F.concat(F.lit("task-"), F.col("p_partkey").cast("string")).alias("id"))
    return validation.orphans(trajectories(spark, sf_dir), tasks).groupBy("task_id").agg(F.count("*").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        gate_report, gate_report_by_kind, gate_empty, gate_failures_long, reward_groups, active_sampling, centered_advantage, trajectory_flags, monitoring,
        clipped_reward, smoke_outcomes, validate_trajectories, extract_answers, normalize_answers, math_verify, extract_code_blocks, tail_capture, math_smoke,
        pack_code_rows, pack_files, pack_messages, orphan_trajectories,
    )
}


def _report(where: str = "", by: str = "", limits: gates.Limits | None = None) -> str:
    m = limits or gates.Limits()
    key, on = (f"{by}, ", f"USING ({by})") if by else ("", "ON true")
    group = f"GROUP BY {by}" if by else ""
    return f"""WITH t AS ({TRAJECTORIES} {where}),
  g AS (SELECT {key}task_id, policy_version, min(reward) = max(reward) AS z FROM t GROUP BY {key}task_id, policy_version),
  z AS (SELECT {key}coalesce(avg(CASE WHEN z THEN 1.0e0 ELSE 0.0e0 END), 1.0e0) AS zero_std_fraction FROM g {group}),
  a AS (SELECT {key}count(*) AS samples, coalesce(avg(reward), 0.0e0) AS mean_reward,
    coalesce(avg(CASE WHEN response_tokens >= max_response_tokens THEN 1.0e0 ELSE 0.0e0 END), 0.0e0) AS truncation_fraction,
    coalesce(avg(CASE WHEN error_type IS NOT NULL THEN 1.0e0 ELSE 0.0e0 END), 0.0e0) AS error_fraction,
    CAST(coalesce(max(greatest(0, learner_version - policy_version)), 0) AS BIGINT) AS max_policy_lag, round(avg(entropy), 9) AS mean_entropy FROM t {group})
  SELECT {key}samples, mean_reward, zero_std_fraction, truncation_fraction, error_fraction, max_policy_lag, mean_entropy,
    samples > 0 AND zero_std_fraction <= {m.max_zero_std_fraction} AND truncation_fraction <= {m.max_truncation_fraction} AND error_fraction <= {m.max_error_fraction} AND max_policy_lag <= {m.max_policy_lag} AS passed
  FROM a JOIN z {on}"""


_T = f"WITH t AS ({TRAJECTORIES})"
_BOX = r"CASE WHEN completion LIKE '%\boxed{%' THEN regexp_extract(completion, '.*\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}', 1, 's') END"
_ANSWER = rf"""coalesce({_BOX}, list_extract(regexp_extract_all(completion, '<final>\s*(.*?)\s*</final>', 1, 'is'), -1),
  trim(list_extract(regexp_extract_all(completion, '(?im)(?:final\s+answer|answer)\s*[:=]\s*(.+)$', 1), -1)),
  trim(list_extract(list_filter(string_split(completion, chr(10)), lambda x: trim(x) <> ''), -1)))"""
_NORMAL = rf"""regexp_replace(regexp_replace(regexp_replace(answer, '\\frac\{{([^{{}}]+)\}}\{{([^{{}}]+)\}}', '((\1)/(\2))', 'g'), '\s+', '', 'g'), '[.,;:]$', '')"""
_RULES = (
    ("range", "nodes < 1 OR g < 1 OR engines < 1 OR tp < 1 OR samples < 2 OR sp < 1"), ("kind", "task_kind NOT IN ('math', 'code')"),
    ("per_turn_exceeds_response", "per_turn > response"), ("pack_too_short", "pack < max_prompt + response"),
    ("code_needs_sandbox", "task_kind = 'code' AND sandbox IS NULL"), ("math_forbids_sandbox", "task_kind = 'math' AND sandbox IS NOT NULL"),
    ("more_learner_nodes_than_nodes", "len(l) > nodes"), ("learner_entry_out_of_range", "len(list_filter(l, lambda x: x < 1 OR x > g)) > 0"),
    ("oversubscribed", "list_sum(l) + engines * tp > nodes * g"), ("learners_not_divisible", "list_sum(l) % sp <> 0"), ("too_few_samples", "prompts * samples < list_sum(l) // sp"),
    ("too_few_prompts", "prompts < engines"), ("code_needs_async", "task_kind = 'code' AND async_steps < 1"),
)

ORACLES: dict[str, str] = {
    "gate_report": _report(),
    "gate_report_by_kind": _report(by="task_kind"),
    "gate_empty": _report("WHERE false"),
    "gate_failures_long": f"""WITH r AS ({_report()}) SELECT * FROM (
      SELECT 'zero_std' AS code, zero_std_fraction AS observed, CAST({TIGHT.max_zero_std_fraction} AS DOUBLE) AS "limit" FROM r
      UNION ALL SELECT 'truncation', truncation_fraction, CAST({TIGHT.max_truncation_fraction} AS DOUBLE) FROM r
      UNION ALL SELECT 'errors', error_fraction, CAST({TIGHT.max_error_fraction} AS DOUBLE) FROM r
      UNION ALL SELECT 'policy_lag', CAST(max_policy_lag AS DOUBLE), CAST({TIGHT.max_policy_lag} AS DOUBLE) FROM r) x WHERE observed > "limit"
      UNION ALL SELECT 'mean_reward', mean_reward, CAST({TIGHT.min_mean_reward} AS DOUBLE) FROM r WHERE mean_reward < {TIGHT.min_mean_reward}""",
    "reward_groups": f"""{_T} SELECT task_id, policy_version, count(*) AS samples, min(reward) AS min_reward, max(reward) AS max_reward,
      count(*) FILTER (response_tokens >= max_response_tokens) AS truncated, count(error_type) AS errors,
      CAST(max(greatest(0, learner_version - policy_version)) AS BIGINT) AS max_policy_lag FROM t GROUP BY ALL""",
    "active_sampling": f"""{_T}, g AS (SELECT task_id, policy_version FROM t GROUP BY ALL HAVING min(reward) < max(reward))
      SELECT task_id, policy_version, reward, response_tokens FROM t JOIN g USING (task_id, policy_version)""",
    "centered_advantage": f"{_T} SELECT task_id, policy_version, reward, round(reward - avg(reward) OVER (PARTITION BY task_id, policy_version), 9) AS advantage FROM t",
    "trajectory_flags": f"""{_T} SELECT task_id, policy_version, learner_version, response_tokens >= max_response_tokens AS truncated,
      CAST(greatest(0, learner_version - policy_version) AS BIGINT) AS policy_lag, error_type IS NOT NULL AS is_error FROM t""",
    "monitoring": f"""{_T} SELECT task_kind, count(*) AS samples, avg(reward) AS mean_reward, round(avg(response_tokens), 9) AS mean_tokens,
      CAST(max(response_tokens) AS BIGINT) AS max_tokens, count(error_type) AS errors FROM t GROUP BY task_kind""",
    "clipped_reward": f"{_T} SELECT task_id, sum(least(greatest(reward * 3 - 1, 0), 1)) AS reward FROM t GROUP BY task_id",
    "smoke_outcomes": f"{_T} SELECT bool_or(reward = 0) AND bool_or(reward = 1) AS both_outcomes FROM t",
    "validate_trajectories": f"""{_T}, b AS ({BROKEN}) SELECT rule, count(*) AS n FROM (
      SELECT 'reward_range' AS rule FROM b WHERE reward NOT BETWEEN 0 AND 1 UNION ALL SELECT 'task_kind' FROM b WHERE task_kind NOT IN ('math', 'code')
      UNION ALL SELECT 'negative_version' FROM b WHERE policy_version < 0 OR learner_version < 0 UNION ALL SELECT 'negative_tokens' FROM b WHERE response_tokens < 0
      UNION ALL SELECT 'max_tokens' FROM b WHERE max_response_tokens <= 0 UNION ALL SELECT 'entropy' FROM b WHERE entropy < 0) x GROUP BY rule""",
    "extract_answers": f"WITH c AS ({duck_text(COMPLETIONS)}) SELECT id, {_ANSWER} AS answer FROM c",
    "normalize_answers": f"WITH c AS ({duck_text(COMPLETIONS)}), a AS (SELECT id, {_ANSWER} AS answer FROM c) SELECT id, {_NORMAL} AS answer FROM a",
    "math_verify": """WITH v AS (SELECT o_orderkey AS id, CASE CAST(o_orderkey % 4 AS INT) WHEN 1 THEN 4 WHEN 3 THEN 4 ELSE 2 END * o_custkey + CASE WHEN o_orderkey % 4 = 3 THEN 2 ELSE 0 END AS four_times,
        CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 4 END * o_custkey AS truth FROM orders)
      SELECT id, four_times = truth AS passed, CASE WHEN four_times = truth THEN 1.0e0 ELSE 0.0e0 END AS reward FROM v""",
    "extract_code_blocks": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN concat('plain ', CAST(o_orderkey AS VARCHAR), chr(10))
      ELSE concat('print(', CAST(o_orderkey AS VARCHAR), ')', chr(10)) END AS code FROM orders""",
    "tail_capture": "SELECT doc_id, right(text, 32000) AS tail FROM documents",
    "math_smoke": """SELECT 'user' AS role, concat('Compute ', CAST(n AS VARCHAR), ' + ', CAST(n + 1 AS VARCHAR), '. Give the final answer in ', chr(92), 'boxed{}.') AS content,
      CAST(2 * n + 1 AS VARCHAR) AS ground_truth, 'math_smoke' AS dataset FROM range(1, (SELECT count(*) FROM part) + 1) r(n)""",
    "pack_code_rows": f"""WITH m AS ({MANIFESTS}), c AS (SELECT *, unnest(range(copies)) AS k FROM m)
      SELECT concat(id, '-', CAST(k AS VARCHAR)) AS instance_id, 'code' AS dataset, 'bash' AS tool, max_steps, id AS task_id, image FROM c""",
    "pack_files": f"""WITH m AS ({MANIFESTS}) SELECT concat('task-', CAST(p_partkey AS VARCHAR)) AS task_id, 'instruction.md' AS path, concat(p_name, chr(10)) AS content FROM part
      UNION ALL SELECT concat('task-', CAST(p_partkey AS VARCHAR)), 'image.txt', concat('image-', CAST(p_size AS VARCHAR), chr(10)) FROM part UNION ALL SELECT id, 'environment/seeds/a.py', instruction FROM m UNION ALL SELECT id, 'tests/test.sh', 'exit 0' FROM m""",
    "pack_messages": "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS position, role, text AS content FROM conversations",
    "orphan_trajectories": f"{_T} SELECT task_id, count(*) AS n FROM t WHERE task_id NOT IN (SELECT concat('task-', CAST(p_partkey AS VARCHAR)) FROM part WHERE p_size > 25) GROUP BY task_id",
}
