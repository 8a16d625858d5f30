"""Files of objects: YAML and JSON, good ones, odd ones and broken ones."""

import json

from veritrail import cli
from veritrail.sources import configs, objects

TASK = {"id": "t", "kind": "math", "prompt": "p", "ground_truth": "3/4"}


def problems(rejects):
    return {(r.file.rsplit("/", 1)[1], r.position): tuple(r.problems) for r in rejects.collect()}


def test_tasks(spark, tmp_path):
    made = {
        "one.yaml": "id: t\nkind: math\nprompt: |\n  two\n  lines\nground_truth: ['1', '2']\nmetadata: {a: [1, 2]}\n", "two.yml": json.dumps([TASK, TASK | {"id": "u", "files": {"a": "b"}}]), "three.json": json.dumps(TASK | {"ground_truth": None}),
        "date.yaml": "id: t\nkind: math\nprompt: p\nmetadata: {at: 2024-01-01}\n", "broken.yaml": "id: [", "broken.json": "{", "empty.yaml": "", "text.json": '"x"', "key.yaml": "1: x\n", "nan.json": '{"id": NaN}',
        "bad.json": json.dumps([{"id": 1, "kind": "prose", "extra": 0}, TASK | {"ground_truth": [1]}, TASK | {"files": None}]),
    }
    for name, text in made.items():
        (tmp_path / name).write_text(text)
    rows, rejects = objects.tasks(spark, str(tmp_path))
    got = {(r.file.rsplit("/", 1)[1], r.position): r for r in rows.collect()}
    assert set(got) == {("one.yaml", 0), ("two.yml", 0), ("two.yml", 1), ("three.json", 0)}
    one = got["one.yaml", 0]
    assert (one.prompt, one.ground_truth, json.loads(one.metadata), one.candidate_path, one.files) == ("two\nlines\n", ["1", "2"], {"a": [1, 2]}, "solution.py", {})
    assert got["two.yml", 1].files == {"a": "b"} and got["two.yml", 0].ground_truth == ["3/4"] and got["three.json", 0].ground_truth is None
    assert problems(rejects) == {
        ("date.yaml", 0): ("wrong_type",), ("broken.yaml", 0): ("unreadable",), ("broken.json", 0): ("unreadable",), ("text.json", 0): ("not_an_object",), ("key.yaml", 0): ("wrong_type",), ("nan.json", 0): ("wrong_type",),
        ("bad.json", 0): ("extra: unknown_field", "id: wrong_type", "kind: not_a_choice", "prompt: missing"), ("bad.json", 1): ("ground_truth: wrong_type",), ("bad.json", 2): ("files: wrong_type",),
    } | ({("empty.yaml", 0): ("not_an_object",)} if ("empty.yaml", 0) in problems(rejects) else {})


def test_commands_with_yaml(spark, tmp_path, capsys):
    (tmp_path / "t.yaml").write_text("id: t\nkind: math\nprompt: p\nground_truth: 3/4\n")
    (tmp_path / "bad.yaml").write_text("id: t\nkind: math\n")
    (tmp_path / "c.txt").write_text("so \\boxed{0.75}")
    assert cli.main(["verify", str(tmp_path / "t.yaml"), str(tmp_path / "c.txt")], spark) == 0
    assert json.loads(capsys.readouterr().out)["extracted_answer"] == "0.75"
    assert cli.main(["verify", str(tmp_path / "bad.yaml"), str(tmp_path / "c.txt")], spark) == 2
    assert "prompt: missing" in capsys.readouterr().err
    (tmp_path / "m.yaml").write_text("id: add\ninstruction: do it\nimage: img\ntest_files: {test.sh: exit 0}\ncopies: 2\n")
    assert cli.main(["pack-code", str(tmp_path / "m.yaml"), str(tmp_path / "out")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "out/train.parquet")).count() == 2


def test_configurations_that_are_not_sections(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("- {name: 5, platform: [1], datasets: {a: 1}, environment: {a: 1}}\n- just text\n")
    rows = {r.position: r for r in configs.read(spark, str(tmp_path)).collect()}
    assert rows[1].problems == ["not_an_object"] and rows[0].nodes is None
    assert {"name: wrong_type", "environment: wrong_type", "platform: wrong_type", "datasets: wrong_type"} <= set(rows[0].problems)
