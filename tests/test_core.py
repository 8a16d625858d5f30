"""Cases of the survey's tables, and what it says no test of the original covers."""

import json
from fractions import Fraction

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veritrail.functions import answers
from veritrail.functions.rational import value_of
from veritrail.operators import datasets, gates, topology, validation, verify
from veritrail.sources import archive
from veritrail.sources import trajectories as log
from veritrail.streaming import gate as stream

GATE = "run_id string, task_id string, task_kind string, reward double, policy_version bigint, learner_version bigint, response_tokens bigint, max_response_tokens bigint, error_type string, entropy double"


def rows(spark, *items):
    full = [("r", t, "math", float(x), v, lv, n, 20, e, h) for t, x, v, lv, n, e, h in items]
    return spark.createDataFrame(full, GATE)


def report(spark, items, **limits):
    return gates.gate_report(rows(spark, *items), gates.Limits(**limits)).first()


def row(t, x, v=2, lv=3, n=10, e=None, h=0.5):
    return t, x, v, lv, n, e, h


def test_gate_mixed_passes(spark):
    r = report(spark, [row("a", 0), row("a", 1), row("b", 0), row("b", 1)])
    assert (r.samples, r.mean_reward, r.zero_std_fraction, r.max_policy_lag, r.mean_entropy, r.passed) == (4, 0.5, 0.0, 1, 0.5, True)


def test_gate_constant_fails(spark):
    r = report(spark, [row("a", 1), row("a", 1)], max_zero_std_fraction=0.5)
    assert not r.passed and r.failures[0].code == "zero_std" and gates.messages(r)[0].startswith("zero-std")


def test_gate_edges(spark):
    r = report(spark, [row("a", 1), row("a", 0, lv=0, n=20), row("a", 0, lv=6, e="", h=None)], max_truncation_fraction=1 / 3, max_error_fraction=1 / 3)
    assert r.passed and r.max_policy_lag == 4 and r.error_fraction == 1 / 3 and r.truncation_fraction == 1 / 3
    single = report(spark, [row("a", 1, h=None)])
    assert single.zero_std_fraction == 1.0 and single.mean_entropy is None
    empty = gates.gate_report(rows(spark, row("a", 1)).limit(0)).first()
    assert (empty.passed, empty.samples, empty.zero_std_fraction, empty.mean_reward, empty.mean_entropy) == (False, 0, 1.0, 0.0, None)
    assert gates.messages(empty) == ["no trajectories"]
    one = report(spark, [row(f"t{k}", k % 2, e="x" if k == 0 else None) for k in range(16)])
    assert "verifier errors 0.062 > 0.020" in gates.messages(one)
    low = report(spark, [row("a", 0), row("a", 1)], min_mean_reward=0.6)
    assert [f.code for f in low.failures] == ["mean_reward"]


def test_groups_ignore_run(spark):
    df = rows(spark, row("a", 1), row("a", 0)).withColumn("run_id", F.col("reward").cast("string"))
    assert gates.reward_groups(df).count() == 1 and gates.active_sampling(df).count() == 2
    assert sorted(r.advantage for r in gates.centered_advantage(df).collect()) == [-0.5, 0.5]


def test_streaming_equals_batch(spark, tmp_path):
    df = rows(spark, *[row(f"t{k % 5}", k % 2, n=k) for k in range(40)])
    df.repartition(4).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(GATE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = stream.start(source, f"{tmp_path}/state", f"{tmp_path}/ck")
    q.awaitTermination(60)
    assert stream.report(spark, f"{tmp_path}/state").first() == gates.gate_report(df).first()


EXTRACT = [
    ("a \\boxed{1} b \\boxed{2}", "2"), ("\\boxed{a{b}c} x", "a{b}c"), ("\\boxed{1} then \\boxed{2\nanswer: 5", "5"), ("x \\boxed{} y", ""), ("<final> 7 </FINAL>", "7"),
    ("answer:\n  42\nmore", "42"), ("Final Answer = 3/4  ", "3/4"), ("line one\n\n last \n \n", "last"), ("", ""), ("a\u2028b", "b"), ("xanswer: a\u0085b", "a\u0085b"),
]


def test_extract(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(EXTRACT)], "k int, t string")
    got = {r.k: r.a for r in df.select("k", answers.extract_answer(F.col("t")).alias("a")).collect()}
    assert [got[k] for k in range(len(EXTRACT))] == [e for _, e in EXTRACT]


def test_extract_code(spark):
    cases = [("```sh\nls\n```\nthen\n```python\nx\n```", "then\n"), ("a ```py\n1\n``` ```\n2\n```", "2\n"), ("  plain ", "plain\n")]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "k int, t string")
    got = {r.k: r.a for r in df.select("k", answers.extract_code(F.col("t")).alias("a")).collect()}
    assert [got[k] for k in range(3)] == [e for _, e in cases]


PAIRS = [
    ("0.75", "3/4", True), ("\\frac{3}{4}", "3/4", True), ("2**3", "8", True), ("-2", "-2", True), ("1 2", "12", True), ("1,000", "1000", False), ("7//2", "3", False),
    ("1/0", "3", False), ("2**0.5", "3", False), ("007", "7", False), ("\u2212 3", "-3", True), ("$5.$", "5", True), ("\\dfrac{\\frac{1}{2}}{3}", "1/6", True), ("9" * 513, "9" * 513, False),
    ("STRASSE", "stra\u00dfe", True), ("X^2", "x**2", True), ("\\left(1\\right)", "1", True), ("0.1", "1/10", True), ("", "", False), ("-2^2", "-4", True),
]


def test_math_verify(spark):
    df = spark.createDataFrame([(k, "math", f"\\boxed{{{a}}}", [b]) for k, (a, b, _) in enumerate(PAIRS)], "k int, kind string, completion string, ground_truth array<string>")
    got = {r.k: (r.passed, r.reward) for r in verify.math_verify(df).collect()}
    assert [got[k] for k in range(len(PAIRS))] == [(e, float(e)) for *_, e in PAIRS]
    empty = df.limit(1).withColumn("ground_truth", F.array().cast("array<string>"))
    assert verify.math_verify(empty).first().passed is False
    with pytest.raises(Exception, match="ground truth"):
        verify.math_verify(df.withColumn("ground_truth", F.lit(None).cast("array<string>"))).collect()


def test_hostile_numbers():
    assert value_of("(((9)**20)**20)**20") is None and value_of("(" * 250 + "1" + ")" * 250) is None and value_of("1e400") is None
    assert value_of("2**-1") == Fraction(1, 2) and value_of("-2**2") == -4 and value_of("2**3**2") == 512


@given(st.integers(-999, 999), st.integers(1, 999), st.integers(1, 99))
def test_equivalence_properties(a, b, k):
    x, y = f"{a}/{b}", f"{a * k}/{b * k}"
    assert answers.same_value(x, x) and answers.same_value(x, y) and answers.same_value(y, x)


LINE = {"run_id": "r", "task_id": "a", "task_kind": "math", "prompt": "p", "completion": "c", "verifier": {"reward": 1.0, "passed": True, "verifier": "math", "reason": "ok"}, "policy_version": 2, "learner_version": 1, "response_tokens": 10, "max_response_tokens": 10, "created_at": "2024-01-01T00:00:00Z"}


def test_log(spark, tmp_path):
    bad = [LINE | {"extra": 1}, LINE | {"max_response_tokens": 0}, LINE | {"response_tokens": "10"}, LINE | {"verifier": LINE["verifier"] | {"reward": 1.5}}, {k: v for k, v in LINE.items() if k != "prompt"}]
    (tmp_path / "a.jsonl").write_text("\n".join([json.dumps(LINE), " ", *map(json.dumps, bad), "nonsense"]) + "\n")
    good, rejects = log.read_trajectories(spark, f"{tmp_path}/a.jsonl")
    r = good.collect()
    assert len(r) == 1 and r[0].truncated and r[0].policy_lag == 0
    assert sorted(tuple(x.reasons)[0] for x in rejects.collect()) == ["max_tokens", "missing_field", "not_an_object", "reward_range", "unknown_field", "wrong_type"]
    assert log.first_bad_line(spark, f"{tmp_path}/a.jsonl").endswith("a.jsonl:3")
    with pytest.raises(ValueError, match="a.jsonl:3"):
        log.read_strict(spark, f"{tmp_path}/a.jsonl")
    assert log.read_trajectories(spark, f"{tmp_path}/none.jsonl")[0].count() == 0
    log.append(good, f"{tmp_path}/shards")
    log.append(good, f"{tmp_path}/shards")
    assert log.compact(spark, f"{tmp_path}/shards", f"{tmp_path}/packed.parquet").count() == 2


#: name, kind, sandbox, nodes, GPUs a node, learners on each node, sequence parallel, engines, tensor parallel, prompts, samples, async steps, prompt, response, per turn, pack
PROFILES = (
    ("math-smoke", "math", None, 1, 8, [4], 4, 4, 1, 4, 4, 1, 2048, 8192, 4096, 10240),
    ("code-smoke", "code", "apptainer", 1, 8, [4], 4, 4, 1, 4, 4, 1, 2048, 8192, 4096, 10240),
    ("code-4node", "code", "apptainer", 4, 8, [8, 8], 4, 16, 1, 16, 32, 4, 2048, 65536, 4096, 67584),
    ("too-many-engines", "math", None, 1, 8, [4], 4, 5, 1, 4, 4, 1, 2048, 8192, 4096, 10240),
    ("no-sandbox", "code", None, 1, 8, [4], 4, 4, 1, 4, 4, 0, 2048, 8192, 9000, 9000),
    ("odd-learners", "math", "docker", 1, 8, [3, 9], 2, 4, 1, 2, 2, 1, 2048, 8192, 4096, 10240),
)


def test_topology_and_rules(spark):
    p = spark.createDataFrame(PROFILES, topology.PROFILE)
    t = {r.name: r for r in topology.topology(p).collect()}
    assert all(t[n].spare_gpus == 0 for n in ("math-smoke", "code-smoke", "code-4node")) and t["code-4node"].data_parallel_ranks == 4 and t["code-4node"].samples_per_step == 512
    v = {r.name: r.violations for r in topology.violations(p).collect()}
    assert v["math-smoke"] == v["code-4node"] == [] and v["too-many-engines"] == ["oversubscribed", "too_few_prompts"] and "code_needs_sandbox" in v["no-sandbox"]


MANIFEST = ("add", "Add two.", "img ", {"a.py": "x"}, {"test.sh": "exit 0"}, 8, 4)


def test_datasets(spark, tmp_path):
    from veritrail.schemas import MANIFEST as SCHEMA

    assert [r.ground_truth for r in datasets.math_smoke(spark, 3).collect()] == ["3", "5", "7"] and datasets.math_smoke(spark, 0).count() == 0
    m = spark.createDataFrame([MANIFEST], SCHEMA)
    assert sorted(r.instance_id for r in datasets.code_rows(m).collect()) == [f"add-{k}" for k in range(4)]
    datasets.write_task_tree(m, f"{tmp_path}/tree")
    assert (tmp_path / "tree/add/tests/test.sh").read_text() == "exit 0" and (tmp_path / "tree/add/image.txt").read_text() == "img\n"
    archive.write(datasets.file_rows(m), f"{tmp_path}/tree.tar.gz")
    for bad in (("a/b", *MANIFEST[1:]), (*MANIFEST[:4], {"x": ""}, 8, 4), (*MANIFEST[:3], {"../x": ""}, *MANIFEST[4:])):
        with pytest.raises(Exception, match="unsafe|no test file|outside"):
            datasets.code_rows(spark.createDataFrame([bad], SCHEMA)).collect()


def test_code_verify(spark):
    with pytest.raises(ValueError):
        verify.LocalRunner()
    test = {"test_it.py": "from solution import add\nassert add(2, 3) == 5\n", "sleep.py": "import time; time.sleep(30)"}
    code = "```python\ndef add(a, b):\n    return a + b\n```"
    items = [("ok", "code", None, ["python", "test_it.py"], test, code), ("bad", "code", None, ["python", "test_it.py"], test, "add = print"), ("slow", "code", None, ["python", "sleep.py"], test, code), ("none", "code", None, ["no-such-program"], test, code), ("out", "code", "../x.py", ["true"], test, code)]
    df = spark.createDataFrame(items, "id string, kind string, candidate_path string, test_command array<string>, files map<string,string>, completion string")
    got = {r.id: (r.reward, r.error_type) for r in verify.code_verify(df, verify.LocalRunner(trusted=True), 5).collect()}
    assert got == {"ok": (1.0, None), "bad": (0.0, None), "slow": (0.0, "timeout"), "none": (0.0, "sandbox_error"), "out": (0.0, "sandbox_error")}


def test_task_rules(spark):
    df = spark.createDataFrame([("a", "math", "p", None, "../x", None, None, None), ("b", "code", "p", None, None, ["t"], None, None)], "id string, kind string, prompt string, ground_truth array<string>, candidate_path string, test_command array<string>, files map<string,string>, metadata string")
    assert {r.id: r.broken for r in validation.task_rules(df).collect()} == {"a": ["candidate_path", "math_needs_truth"], "b": []}


def test_deep_fractions(spark):
    deep = "2"
    for _ in range(30):
        deep = f"\\frac{{{deep}}}{{1}}"
    wide = "".join("\\dfrac{1}{2}+" for _ in range(20)) + "0"
    items = [(1, "math", f"\\boxed{{{deep}}}", ["2"]), (2, "math", f"\\boxed{{{wide}}}", ["10"]), (3, "math", "\\boxed{\\frac{1}{\\frac{}{2}}}", ["2"]), (4, "math", "<final>\\frac{1}2</final>", ["1/2"])]
    df = spark.createDataFrame(items, "k int, kind string, completion string, ground_truth array<string>")
    assert {r.k: r.passed for r in verify.math_verify(df).collect()} == {1: True, 2: True, 3: False, 4: False}


def test_programs_are_ended_as_a_whole(tmp_path):
    """A child that goes on and holds the pipes neither blocks the result nor stays; of much output the end is kept."""
    import time

    (tmp_path / "a.sh").write_text("sleep 50 & echo started; exit 3")
    began = time.monotonic()
    done = verify.LocalRunner(trusted=True).run(str(tmp_path), ["sh", "a.sh"], 20)
    assert (done.returncode, done.stdout) == (3, "started\n") and time.monotonic() - began < 10
    done = verify.LocalRunner(trusted=True).run(str(tmp_path), ["python", "-c", "print('a' * 3_000_000 + 'end')"], 20)
    assert len(done.stdout) == verify.CAPTURE and done.stdout.endswith("aend\n")
    import subprocess

    with pytest.raises(subprocess.TimeoutExpired):
        verify.LocalRunner(trusted=True).run(str(tmp_path), ["sh", "-c", "sleep 60 & sleep 60"], 0.5)


def test_verify_by_kind(spark):
    df = spark.createDataFrame([("a", "prose")], "id string, kind string")
    rows = df.selectExpr("*", "array('1') AS ground_truth", "'' AS candidate_path", "array('true') AS test_command", "map('a', 'b') AS files", "'1' AS completion")
    with pytest.raises(Exception, match="no verifier"):
        verify.verify(rows, {"math": verify.MathVerifier()}).collect()


def test_commands(spark, tmp_path, capsys):
    from tests.test_configs import CONFIG
    from veritrail import cli

    def run(*words):
        code = cli.main([str(w) for w in words], spark)
        out = capsys.readouterr().out
        return code, json.loads(out) if out else None

    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    assert run("validate", tmp_path / "c.json") == (0, {"name": "n", "valid": True, "task": "code", "topology": cli.topology.topology(cli.configs.profiles(spark, [CONFIG])).drop("name").first().asDict()})
    assert run("topology", tmp_path / "c.json")[1]["spare_gpus"] == 0 and run("topology", tmp_path / "none.json") == (2, None)
    (tmp_path / "t.json").write_text(json.dumps({"id": "t", "kind": "math", "prompt": "p", "ground_truth": "3/4"}, indent=2))
    for text, code in (("\\boxed{0.75}", 0), ("answer: 5", 1)):
        (tmp_path / "x.txt").write_text(text)
        assert run("verify", tmp_path / "t.json", tmp_path / "x.txt")[0] == code
    (tmp_path / "code.json").write_text(json.dumps({"id": "t", "kind": "code", "prompt": "p", "test_command": ["python", "solution.py"]}))
    assert run("verify", tmp_path / "code.json", tmp_path / "x.txt")[0] == 2 and run("verify", tmp_path / "code.json", tmp_path / "x.txt", "--runner", "local", "--trusted")[0] == 0
    (tmp_path / "log.jsonl").write_text("\n".join(json.dumps(LINE | {"response_tokens": 9, "verifier": LINE["verifier"] | {"reward": x}}) for x in (0.0, 1.0)))
    assert run("gate", tmp_path / "log.jsonl")[0] == 0 and run("gate", tmp_path / "none.jsonl") == (1, run("gate", tmp_path / "none.jsonl")[1])
    assert run("make-math", tmp_path / "m.parquet", "--count", 3)[0] == 0 and spark.read.parquet(f"{tmp_path}/m.parquet").count() == 3
    names = ("id", "instruction", "image", "seed_files", "test_files", "max_steps", "copies")
    (tmp_path / "manifest.json").write_text(json.dumps([dict(zip(names, MANIFEST, strict=True))]))
    assert run("pack-code", tmp_path / "manifest.json", tmp_path / "packed")[0] == 0 and (tmp_path / "packed/task-data.tar.gz").exists()


def test_shared_folder(spark, monkeypatch):
    from veritrail.sources import shared

    class Session:
        class conf:
            get = staticmethod(lambda key, other: None)

        class sparkContext:
            master = "spark://a:1"

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared.shared_dir(Session)
    Session.sparkContext.master = "local[2]"
    assert shared.shared_dir(Session) == shared.shared_dir(Session) and shared.shared_dir(Session).startswith("file:///")


def test_null_kinds_raise(spark):
    ok, null = ("a", "math", ["1"], None, ["true"], {}, "1"), ("b", None, ["1"], None, ["true"], {}, "1")
    schema = "id string, kind string, ground_truth array<string>, candidate_path string, test_command array<string>, files map<string,string>, completion string"
    df, runner = spark.createDataFrame([ok, null], schema), verify.LocalRunner(trusted=True)
    both = {"math": verify.MathVerifier(), "code": verify.CodeVerifier(runner)}
    assert verify.verify(spark.createDataFrame([ok], schema), both).first().passed
    for bad in (verify.verify(df, both), verify.verify(df, {"math": verify.MathVerifier()}), verify.math_verify(df), verify.code_verify(df.filter("kind IS NULL"), runner)):
        with pytest.raises(Exception, match="no verifier for tasks of kind null|needs a (math|code) task"):
            bad.collect()
    broken = validation.task_rules(df).collect()
    assert [r.broken for r in broken] == [[], ["kind"]]


def test_files_are_stripped(spark):
    made = spark.createDataFrame([("t", "\n  do it\x0b\n\n", " img\t", {}, {"test.sh": " x "}, 1, 1)], "id string, instruction string, image string, seed_files map<string,string>, test_files map<string,string>, max_steps bigint, copies bigint")
    assert {r.path: r.content for r in datasets.file_rows(made).collect()} == {"instruction.md": "do it\n", "image.txt": "img\n", "tests/test.sh": " x "}


def test_nan_duration(spark):
    df = spark.createDataFrame([("math", 0.5, 1, 1, 1, 2, 0.1, float("nan"))], "task_kind string, r double, policy_version long, learner_version long, response_tokens long, max_response_tokens long, entropy double, d double")
    df = df.withColumn("verifier", F.struct(F.col("r").alias("reward"), F.col("d").alias("duration_seconds"))).drop("r", "d")
    assert validation.broken_rules(df).first().broken == ["duration"]
