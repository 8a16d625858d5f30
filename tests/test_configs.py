"""Configuration files: defaults, problems of fields, rules between fields."""

import json

from veritrail.operators import topology
from veritrail.sources import configs

CONFIG = {
    "version": 1, "name": "n", "platform": {"accelerator": "cuda", "nodes": 1, "gpus_per_node": 8, "container": "c", "account": "a", "partition": "p"},
    "backend": {"repo_path": "r", "commit": "c"}, "model": {"name_or_path": "m"}, "datasets": [{"path": "d"}], "task": {"kind": "code", "sandbox": {"image": "i"}},
    "rollout": {"engines": 4, "unique_prompts": 4, "samples_per_prompt": 4}, "training": {"learner_gpus_per_node": [4]}, "output": {"directory": "o", "rollout_directory": "r", "experiment_name": "e"},
}


def test_good(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    found = configs.load([f"{tmp_path}/c.json"])
    assert configs.checked(found[0])[1] == []
    p = configs.profiles(spark, found)
    assert topology.violations(p).first().violations == [] and topology.topology(p).first().spare_gpus == 0
    assert configs.limits(found[0]).max_policy_lag == 4


def test_problems():
    bad = json.loads(json.dumps(CONFIG))
    bad["extra"] = bad["platform"]["more"] = 1
    bad["platform"] |= {"nodes": "1", "ray_port": 80, "accelerator": "tpu"}
    bad["rollout"]["temperature"] = 0
    del bad["model"]["name_or_path"], bad["datasets"]
    assert configs.checked(bad)[1] == [
        "extra: unknown_field", "platform.more: unknown_field", "platform.accelerator: not_a_choice", "platform.nodes: wrong_type", "platform.ray_port: out_of_range",
        "model.name_or_path: missing", "rollout.temperature: out_of_range", "datasets: missing",
    ]
