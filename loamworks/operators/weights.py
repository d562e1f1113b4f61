"""Weights of a decoder as named tensors, and the safetensors files that hold them."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from ..staging import stage_path, write_file
from .config import ModelConfig

#: The format's names of the kinds of numbers read here.
KINDS = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "I64": "<i8", "I32": "<i4"}


def shapes(config: ModelConfig) -> dict[str, tuple[int, ...]]:
    """The tensors of a decoder: embeddings, per layer attention, feed-forward and two norms, a last norm, a head without bias."""
    v, d, f = config.vocab_size, config.d_model, config.d_ff
    out: dict[str, tuple[int, ...]] = {"embedding": (v, d)}
    for i in range(config.num_layers):
        for name in ("query", "key", "value", "output"):
            out |= {f"layers.{i}.{name}.weight": (d, d), f"layers.{i}.{name}.bias": (d,)}
        out |= {f"layers.{i}.up.weight": (d, f), f"layers.{i}.up.bias": (f,), f"layers.{i}.down.weight": (f, d), f"layers.{i}.down.bias": (d,)}
        out |= {f"layers.{i}.norm{k}.{x}": (d,) for k in (1, 2) for x in ("scale", "shift")}
    return out | {"norm.scale": (d,), "norm.shift": (d,), "head": (d, v)}


def count(config: ModelConfig) -> int:
    return sum(math.prod(s) for s in shapes(config).values())


def initial(config: ModelConfig, seed: int = 0) -> dict[str, np.ndarray]:
    """Untrained weights: normal embeddings, uniform matrices and biases within one over the root of their inputs, plain norms."""
    rng = np.random.default_rng(seed)
    out = {}
    for name, shape in shapes(config).items():
        if name == "embedding":
            made = rng.standard_normal(shape)
        elif name.endswith("scale"):
            made = np.ones(shape)
        elif name.endswith("shift"):
            made = np.zeros(shape)
        else:
            inputs = shape[0] if len(shape) == 2 else config.d_ff if ".down." in name else config.d_model
            made = rng.uniform(-1, 1, shape) / math.sqrt(inputs)
        out[name] = made.astype(np.float32)
    return out


def checked(tensors: dict[str, np.ndarray], config: ModelConfig) -> dict[str, np.ndarray]:
    """The tensors, if they are those of the configuration."""
    want = shapes(config)
    if missing := sorted(want.keys() - tensors.keys()):
        raise ValueError(f"weights lack {', '.join(missing[:5])}")
    for name, shape in want.items():
        if tensors[name].shape != shape:
            raise ValueError(f"{name} is {tensors[name].shape}, not {shape}")
    return {k: tensors[k] for k in want}


def to_bytes(tensors: dict[str, np.ndarray]) -> bytes:
    """A safetensors file."""
    names = {v: k for k, v in KINDS.items()}
    head, at, parts = {}, 0, []
    for name, t in tensors.items():
        data = np.ascontiguousarray(t)
        kind = data.dtype.newbyteorder("<").str
        head[name] = {"dtype": names[kind], "shape": list(t.shape), "data_offsets": [at, at + data.nbytes]}
        parts.append(data.astype(kind).tobytes())
        at += data.nbytes
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(parts)


def read(path: str) -> dict[str, np.ndarray]:
    """The tensors of a local file, mapped into memory: workers of one machine share its pages, and only what is used is read."""
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        head = json.loads(f.read(size))
    head.pop("__metadata__", None)
    out = {}
    for name, t in head.items():
        if t["dtype"] not in KINDS:
            raise ValueError(f"{name} holds {t['dtype']}, which is not read")
        kind, (a, b) = np.dtype(KINDS[t["dtype"]]), t["data_offsets"]
        if b - a != math.prod(t["shape"]) * kind.itemsize:
            raise ValueError(f"{name} has {b - a} bytes for {t['shape']}")
        empty = b == a
        out[name] = np.zeros(t["shape"], kind) if empty else np.memmap(path, kind, "r", 8 + size + a, tuple(t["shape"]))
    return out


def save(spark: SparkSession, tensors: dict[str, np.ndarray], path: str) -> None:
    """Writes a file whole, or not at all, to any file system that Spark writes to."""
    write_file(spark, path, to_bytes(tensors))


def shipped(spark: SparkSession, path: str) -> str:
    """Sends a file of any of Spark's file systems to every machine, once; ``local`` finds it there by the name given back."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def local(name: str) -> dict[str, np.ndarray]:
    return read(SparkFiles.get(name))


def staged_initial(spark: SparkSession, config: ModelConfig, seed: int = 0) -> str:
    """Untrained weights in a file of the shared folder."""
    path = f"{stage_path(spark)}.safetensors"
    save(spark, initial(config, seed), path)
    return path
