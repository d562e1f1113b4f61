"""Layered model and run configuration, and sizing."""

from __future__ import annotations

import json
import os
import tomllib
import warnings
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

ENV_PREFIX = "LOAMWORKS_MODEL_"


@dataclass(frozen=True)
class ModelConfig:
    vocab_size: int
    context_length: int
    d_model: int
    d_ff: int
    num_layers: int
    num_heads: int
    norm_first: bool

    def head_dim(self) -> int | None:
        return self.d_model // self.num_heads if self.num_heads and self.d_model % self.num_heads == 0 else None

    def approx_parameter_count(self) -> int:
        d, f = self.d_model, self.d_ff
        layer = 4 * d * d + 4 * d + 4 * d + 2 * d * f + f + d
        return (self.vocab_size + self.context_length) * d + self.num_layers * layer + 2 * d


SIZES = {
    "gpt2-small": ModelConfig(16_000, 1024, 768, 3072, 12, 12, True),
    "debug-tiny": ModelConfig(16_000, 1024, 128, 512, 2, 2, True),
}


@dataclass(frozen=True)
class TrainingConfig:
    learning_rate: float = 3e-4
    weight_decay: float = 0.1
    batch_size: int = 32
    max_steps: int = 100_000
    warmup_steps: int = 2_000
    grad_clip: float | None = 1.0
    seed: int = 0


@dataclass(frozen=True)
class RunConfig:
    model: ModelConfig
    training: TrainingConfig = field(default_factory=TrainingConfig)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> RunConfig:
        d = json.loads(text)
        return RunConfig(ModelConfig(**d["model"]), TrainingConfig(**d["training"]))


def parse_env(prefix: str, pairs: Iterable[tuple[str, str]]) -> dict[str, object]:
    """Keys with the prefix, without it and in lower case; values as JSON, or as they are."""
    out: dict[str, object] = {}
    for k, v in pairs:
        if k.startswith(prefix):
            try:
                out[k[len(prefix) :].lower()] = json.loads(v)
            except ValueError:
                out[k[len(prefix) :].lower()] = v
    return out


def read_env() -> dict[str, object]:
    return parse_env(ENV_PREFIX, os.environ.items())


class LayeredConfig:
    """Layers of settings: later ones win field by field, unset fields never do."""

    def __init__(self) -> None:
        self.values: dict[str, object] = {}

    def merge(self, layer: dict[str, object]) -> LayeredConfig:
        known = {f.name for f in fields(ModelConfig)}
        for k in layer.keys() - known:
            warnings.warn(f"unknown setting {k} is ignored", stacklevel=2)
        self.values |= {k: v for k, v in layer.items() if v is not None and k in known}
        return self

    def with_defaults(self, base: ModelConfig) -> LayeredConfig:
        return self.merge(asdict(base))

    def with_file(self, path: str | Path) -> LayeredConfig:
        p = Path(path)
        if p.suffix not in (".toml", ".json", ".jsonc"):
            raise ValueError(f"unknown kind of configuration file: {p}")
        if not p.is_file():
            raise FileNotFoundError(f"no configuration file {p}")
        return self.merge(tomllib.loads(p.read_text()) if p.suffix == ".toml" else json.loads(p.read_text()))

    def with_optional_file(self, path: str | Path | None) -> LayeredConfig:
        return self.with_file(path) if path else self

    with_env = with_overrides = merge

    def extract(self, what: str = "model") -> ModelConfig:
        for f in fields(ModelConfig):
            v = self.values.get(f.name)
            kind = bool if f.name == "norm_first" else int
            if not isinstance(v, kind) or kind is int and (isinstance(v, bool) or v < 0):
                raise ValueError(f"invalid {what} configuration: {f.name} is {'missing' if v is None else f'not right: {v!r}'}")
        return ModelConfig(**self.values)


def load_model_config(base: ModelConfig, path: str | None, env: dict, flags: dict, tokenizer_vocab: int | None = None) -> ModelConfig:
    """Base, file, environment, flags; the vocabulary of a trained tokenizer stands above all."""
    config = LayeredConfig().with_defaults(base).with_optional_file(path).with_env(env).with_overrides(flags).extract()
    if tokenizer_vocab is not None and tokenizer_vocab != config.vocab_size:
        warnings.warn(f"the tokenizer's vocabulary of {tokenizer_vocab} replaces {config.vocab_size}", stacklevel=2)
        config = ModelConfig(**asdict(config) | {"vocab_size": tokenizer_vocab})
    return config


def resolved(base: Column, *layers: Column) -> Column:
    """A field of many runs at once: the last layer that sets it wins, an unset one never does."""
    return F.coalesce(*reversed(layers), base)


def env_setting(key: Column, value: Column, prefix: str = ENV_PREFIX) -> Column:
    """struct(key, value) of an environment variable, as ``parse_env``: value as JSON, null where the prefix is another's."""
    parsed = F.to_json(F.try_parse_json(value))
    text = F.regexp_replace(F.to_json(F.array(value)), r"^\[(.*)\]$", "$1")
    name = F.lower(F.substring(key, len(prefix) + 1, 10_000))
    return F.when(key.startswith(prefix), F.struct(name.alias("key"), F.coalesce(parsed, text).alias("value")))


_RUN = (("model", ModelConfig), ("training", TrainingConfig))
_KINDS = {"int": "bigint", "bool": "boolean", "float": "double", "float | None": "double"}


def run_json(settings: dict[str, Column]) -> Column:
    """The JSON of a run, as ``RunConfig.to_json`` nests it, from columns named as its fields; unnamed training fields have their defaults."""
    defaults = asdict(TrainingConfig())
    part = lambda kind: F.struct(*(settings.get(f.name, F.lit(defaults.get(f.name))).cast(_KINDS[f.type]).alias(f.name) for f in fields(kind)))
    return F.to_json(F.struct(*(part(kind).alias(name) for name, kind in _RUN)))


def run_of_json(text: Column) -> Column:
    """struct(model, training) of such JSON."""
    part = lambda kind: ", ".join(f"{f.name}: {_KINDS[f.type]}" for f in fields(kind))
    return F.from_json(text, ", ".join(f"{name} struct<{part(kind)}>" for name, kind in _RUN))


def head_dim(d_model: Column, heads: Column) -> Column:
    safe = F.when(heads > 0, heads)
    return F.when(d_model % safe == 0, (d_model / safe).cast("bigint"))


def approx_parameters(v: Column, ctx: Column, d: Column, f: Column, layers: Column) -> Column:
    return (v + ctx) * d + layers * (4 * d * d + 4 * d + 4 * d + 2 * d * f + f + d) + 2 * d
