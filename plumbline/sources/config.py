"""YAML configuration with ${NAME} taken from the environment, and prompt files."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path


def expand(x):
    """${NAME} in every string of a nested value; unknown names stay."""
    if isinstance(x, dict):
        return {k: expand(v) for k, v in x.items()}
    if isinstance(x, list):
        return [expand(v) for v in x]
    return re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m[1], m[0]), x) if isinstance(x, str) else x


def load(path: str, required=()) -> dict:
    import yaml

    found = expand(yaml.safe_load(Path(path).read_text()) or {})
    if missing := [k for k in required if k not in found]:
        raise ValueError(f"{path}: missing {', '.join(missing)}")
    return found


def prompts(system_path: str, shots_path: str | None = None) -> tuple[str, list[dict]]:
    """The system text and the examples; examples that aren't JSON are appended to the text."""
    system = Path(system_path).read_text()
    if not shots_path:
        return system, []
    body = Path(shots_path).read_text()
    if shots_path.endswith(".jsonl"):
        return system, [json.loads(x) for x in body.splitlines() if x.strip()]
    if shots_path.endswith(".json"):
        return system, json.loads(body)
    return f"{system}\n{body}", []
