"""Job configuration. Every path comes from the caller; there are no built-in locations."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

from .schema import CONFIGURED_COLUMNS


def _build(cls, values: dict):
    known = {f.name for f in fields(cls)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown settings: {unknown}")
    return cls(**values)


@dataclass(frozen=True)
class TrainConfig:
    ok_path: str
    fault_path: str
    label_path: str
    model_root: str
    columns: Sequence[str] = field(default_factory=lambda: list(CONFIGURED_COLUMNS))
    ok_label: int = 0
    test_size: float = 0.01
    ok_out_days: int = 0
    fault_offsets: Sequence[int] = tuple(range(8))
    time_range: int = 7
    seed: int = 42
    rounds: int = 100

    @classmethod
    def from_dict(cls, values: dict) -> "TrainConfig":
        return _build(cls, values)


@dataclass(frozen=True)
class ScoreConfig:
    data_path: str
    model_root: str
    columns: Sequence[str] = field(default_factory=lambda: list(CONFIGURED_COLUMNS))
    time_range: int = 7
    threshold_1: float = 0.80
    threshold_2: float = 0.80

    @classmethod
    def from_dict(cls, values: dict) -> "ScoreConfig":
        return _build(cls, values)


def load_config(path: str) -> dict:
    """YAML where a YAML package is installed, else JSON."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading YAML needs the yaml package; use JSON instead") from missing
        return yaml.safe_load(text)
    return json.loads(text)
