"""The run configuration: a mapping over typed defaults. An unknown key, another type or a value out of range is refused."""

from __future__ import annotations

import copy
import json
import math
from dataclasses import dataclass
from pathlib import Path

from ..functions.strictjson import decode

# The settings and their defaults. Those of training are read and kept, so that one file serves both sides.
DEFAULTS = {
    "run_name": "check-sft",
    "seed": 42,
    "data": {
        "sources": ["training_files/annotations.json"],
        "catalog": "catalog/catalog.json",
        "language": "en",
        "prepared_dir": "build/data",
        "val_fraction": 0.2,
        "split_seed": 0,
        "near_duplicate_threshold": 0.38,
        "extra_groups": [],
    },
    "model": {"base_model": "base", "revision": None, "trust_remote_code": False},
    "lora": {"enabled": True, "r": 16, "alpha": 32, "dropout": 0.05, "target_modules": "all-linear"},
    "train": {
        "output_dir": "runs",
        "learning_rate": 2.0e-4,
        "num_train_epochs": 5,
        "max_steps": -1,
        "per_device_train_batch_size": 4,
        "gradient_accumulation_steps": 2,
        "max_seq_length": 1024,
        "warmup_ratio": 0.1,
        "weight_decay": 0.0,
        "lr_scheduler_type": "cosine",
        "logging_steps": 1,
        "precision": "auto",
        "gradient_checkpointing": False,
    },
    "inference": {"max_new_tokens": 64, "batch_size": 8},
    "smoke": {"example_ids": [], "num_examples": 8, "max_steps": 10},
}
NULLABLE = {"data.near_duplicate_threshold", "model.revision"}
NOT_EMPTY = {"data.sources", "lora.target_modules"}
TEXT_OR_LIST = {"lora.target_modules"}


@dataclass(frozen=True)
class Range:
    """From `low` to `high`, without the ends that are open; `also` is allowed besides."""

    low: float = 0
    high: float = math.inf
    low_open: bool = False
    high_open: bool = False
    also: float | None = None

    def holds(self, v) -> bool:
        above = v > self.low if self.low_open else v >= self.low
        return v == self.also or above and (v < self.high if self.high_open else v <= self.high)

    def __str__(self) -> str:
        more = f" or {self.also}" if self.also is not None else ""
        return f"in {'(' if self.low_open else '['}{self.low}, {self.high}{')' if self.high_open else ']'}{more}"


SHARE, PART, POSITIVE = Range(0, 1), Range(0, 1, high_open=True), Range(low_open=True)
RANGES = {
    "seed": Range(0, 2**32 - 1),
    "data": {"val_fraction": SHARE, "near_duplicate_threshold": SHARE},
    "lora": {"r": POSITIVE, "alpha": POSITIVE, "dropout": PART},
    "train": {
        **dict.fromkeys(("learning_rate", "num_train_epochs", "per_device_train_batch_size", "gradient_accumulation_steps", "max_seq_length", "logging_steps"), POSITIVE),
        "max_steps": Range(low_open=True, also=-1),
        "warmup_ratio": PART,
        "weight_decay": Range(high_open=True),
    },
    "inference": {"max_new_tokens": POSITIVE, "batch_size": POSITIVE},
    "smoke": {"num_examples": POSITIVE, "max_steps": POSITIVE},
}
#: Settings that decide which row is in which split.
SPLIT_KEYS = ("language", "val_fraction", "split_seed", "near_duplicate_threshold", "extra_groups")


def _text(v) -> bool:
    return isinstance(v, str) and bool(v.strip())


def _checked(path: str, default, value):
    def refuse(why: str):
        raise ValueError(f"config {path}: {why}, got {value!r}")

    if value is None:
        return None if path in NULLABLE else refuse("must not be null")
    kind = type(default) if default is not None else str
    if path in TEXT_OR_LIST and isinstance(value, list):
        kind = list
    if kind is float and type(value) is int:
        try:
            value = float(value)
        except OverflowError:
            raise ValueError(f"config {path}: too large") from None
    if type(value) is not kind:
        refuse(f"must be a {kind.__name__}")
    if kind is str and not value.strip():
        refuse("must not be blank")
    if kind is float and not math.isfinite(value):
        refuse("must be finite")
    if kind is list:
        if path in NOT_EMPTY and not value:
            refuse("must not be empty")
        group = lambda v: isinstance(v, list) and all(map(_text, v)) and len(set(v)) > 1
        if not all(map(group if path == "data.extra_groups" else _text, value)):
            refuse("holds an entry of another form")
    allowed = RANGES
    for part in path.split("."):
        allowed = allowed.get(part) if isinstance(allowed, dict) else None
    if isinstance(allowed, Range) and not allowed.holds(value):
        refuse(f"must be {allowed}")
    return value


def merged(given: dict, base: dict = DEFAULTS, path: str = "") -> dict:
    if not isinstance(given, dict):
        raise ValueError(f"config {path or 'file'}: must be a mapping")
    out = copy.deepcopy(base)
    for key, value in given.items():
        at = f"{path}.{key}".lstrip(".")
        if key not in base:
            raise ValueError(f"config {at}: unknown")
        out[key] = merged(value, base[key], at) if isinstance(base[key], dict) else _checked(at, base[key], value)
    return out


def recorded_problem(config) -> str | None:
    """Why a config that a run recorded cannot be used: a value that is refused, or a setting that it lacks, as today's
    defaults may not be what the run used."""
    if not isinstance(config, dict):
        return "config is no mapping"
    try:
        merged(config)
    except ValueError as e:
        return str(e)
    todo, lacking = [("", DEFAULTS, config)], []
    while todo:
        at, base, given = todo.pop()
        lacking += [at + k for k in base if k not in given]
        todo += [(f"{at}{k}.", v, given[k]) for k, v in base.items() if isinstance(v, dict) and k in given]
    return f"config lacks {sorted(lacking)}" if lacking else None


def load_config(path: str) -> dict:
    """A JSON file, or YAML where a YAML reader is installed; repeated keys are refused in both."""
    text = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix in (".yaml", ".yml"):
        import yaml

        class Strict(yaml.SafeLoader):
            pass

        def mapping(loader, node, deep=False):
            keys = [loader.construct_object(k, deep=True) for k, _ in node.value]
            if len({json.dumps(k, default=str) for k in keys}) < len(keys):
                raise ValueError(f"{path}: repeated key")
            return {k: loader.construct_object(v, deep=True) for k, (_, v) in zip(keys, node.value)}

        Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
        return merged(yaml.load(text, Loader=Strict) or {})  # noqa: S506
    return merged(decode(text) if text.strip() else {})
