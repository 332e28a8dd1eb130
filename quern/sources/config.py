"""Configuration files: reading, merging, looking up and checking (on the driver)."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any


def load(path: str) -> dict[str, Any]:
    """A JSON or YAML file as a dict, without its top-level keys that begin with '_'."""
    with open(path, encoding="utf-8") as f:
        if path.lower().endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("reading YAML needs the yaml package") from e
            value = yaml.safe_load(f) or {}
        else:
            value = json.load(f)
    return {k: v for k, v in value.items() if not str(k).startswith("_")}


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """base with the values of over, dicts merged key by key."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def get(config: Mapping[str, Any], path: str, default: Any = None) -> Any:
    """The value at a dotted path."""
    value: Any = config
    for key in path.split("."):
        if not isinstance(value, Mapping) or key not in value:
            return default
        value = value[key]
    return value


def missing(config: Mapping[str, Any], paths: Iterable[str]) -> list[str]:
    """The dotted paths that a configuration lacks."""
    absent = object()
    return [p for p in paths if get(config, p, absent) is absent]


#: Options of the pipelines; the defaults are the reference behaviour.
DEFAULTS: dict[str, Any] = {
    "normalization": {"form": "NFC"},
    "deduplication": {"threshold": 0.8, "permutations": 128, "shingle": 3, "mode": "lsh"},
    "language_filter": {"keep": "en", "least_characters": 3},
    "safety": {"on_missing": "drop", "skip": False},
    "quality": {"least": 10, "shortest": None, "most": None},
    "split": {"ratio": 0.9},
    "posts": {"most": 4000, "decompose": True},
    "passages": {"least": 75, "most": 600, "target": 150, "overlap": 0.2, "per_book": 1000, "total": 5000},
}
