"""Row types as Spark schemas."""

from __future__ import annotations

VERIFIER_FIELDS = {"reward": "double", "passed": "boolean", "verifier": "string", "reason": "string", "extracted_answer": "string", "stdout": "string", "stderr": "string", "duration_seconds": "double", "error_type": "string"}
VERIFIER = "struct<" + ",".join(f"{k}:{v}" for k, v in VERIFIER_FIELDS.items()) + ">"
TRAJECTORY_FIELDS = {
    "run_id": "string", "task_id": "string", "task_kind": "string", "prompt": "string", "completion": "string",
    "verifier": VERIFIER, "policy_version": "bigint", "learner_version": "bigint", "response_tokens": "bigint",
    "max_response_tokens": "bigint", "entropy": "double", "created_at": "timestamp", "metadata": "string",
}
TRAJECTORY = ", ".join(f"{k} {v}" for k, v in TRAJECTORY_FIELDS.items())
TASK = "id string, kind string, prompt string, ground_truth array<string>, candidate_path string, test_command array<string>, files map<string,string>, metadata string"
MANIFEST = "id string, instruction string, image string, seed_files map<string,string>, test_files map<string,string>, max_steps bigint, copies bigint"
MESSAGES = "array<struct<role:string,content:string>>"
RESULT = ", ".join(f"{k} {v}" for k, v in VERIFIER_FIELDS.items())
REQUIRED = ("run_id", "task_id", "task_kind", "prompt", "completion", "verifier", "policy_version", "learner_version", "response_tokens", "max_response_tokens")
