"""A decoder's forward pass in NumPy, spread over sequences by mapInArrow.

Weights come from a safetensors file, which is sent to each machine once and
mapped into the memory of its workers; without one they are untrained.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import weights as W
from .config import ModelConfig

#: Places of a padded batch of sequences, and places whose logits are held at a time: few, so that they stay in a core's cache.
BATCH_PLACES, LOGIT_PLACES = 1_024, 256
#: Logits of at most so much go into the exponential as they are.
SAFE_LOGIT = 60.0


class Decoder:
    def __init__(self, config: ModelConfig, seed: int = 0, tensors: dict[str, np.ndarray] | None = None):
        if config.head_dim() is None:
            raise ValueError("d_model must be divisible by num_heads")
        self.config, d = config, config.d_model
        self.tensors = W.checked(W.initial(config, seed) if tensors is None else tensors, config)
        pos, i = np.arange(config.context_length)[:, None], np.arange(d)[None, :]
        angle = pos / 10000.0 ** ((i - i % 2) / d)
        self.position = np.where(i % 2 == 0, np.sin(angle), np.cos(angle)).astype(np.float32)
        s = config.context_length
        self._later = np.where(np.tril(np.ones((s, s), bool)), np.float32(0), np.float32(-np.inf))
        self._share = np.full((d, 1), 1 / d, np.float32)

    def _norm(self, x: np.ndarray, name: str) -> np.ndarray:
        # Means as products: a reduction over so short an axis takes longer.
        x = x - x @ self._share
        x /= np.sqrt((x * x) @ self._share + np.float32(1e-5))
        x *= self.tensors[f"{name}.scale"]
        x += self.tensors[f"{name}.shift"]
        return x

    def _linear(self, x: np.ndarray, name: str) -> np.ndarray:
        y = x @ self.tensors[f"{name}.weight"]
        y += self.tensors[f"{name}.bias"]
        return y

    def _attend(self, x: np.ndarray, layer: str) -> np.ndarray:
        b, s, d = x.shape
        h = self.config.num_heads
        q, k, v = (self._linear(x, f"{layer}.{n}").reshape(b, s, h, d // h).transpose(0, 2, 1, 3) for n in ("query", "key", "value"))
        p = (q / np.float32(np.sqrt(d // h))) @ k.transpose(0, 1, 3, 2)
        p += self._later[:s, :s]
        p -= p.max(-1, keepdims=True)
        np.exp(p, out=p)
        made = p @ v
        made /= p @ np.ones((s, 1), np.float32)
        return self._linear(made.transpose(0, 2, 1, 3).reshape(b, s, d), f"{layer}.output")

    def _feed(self, x: np.ndarray, layer: str) -> np.ndarray:
        y = self._linear(x, f"{layer}.up")
        # A power takes many times as long as products.
        z = y * y
        z *= np.float32(0.7978845608 * 0.044715)
        z += np.float32(0.7978845608)
        z *= y
        np.tanh(z, out=z)
        z += 1
        z *= y
        z *= np.float32(0.5)
        return self._linear(z, f"{layer}.down")

    def hidden(self, tokens: np.ndarray) -> np.ndarray:
        """[batch, seq] ids to [batch, seq, d_model], what the head reads; no place sees a later one."""
        s = tokens.shape[1]
        if s > self.config.context_length:
            raise ValueError(f"sequence length {s} exceeds the context length {self.config.context_length}")
        x = self.tensors["embedding"][tokens] + self.position[:s]
        for i in range(self.config.num_layers):
            layer = f"layers.{i}"
            if self.config.norm_first:
                x = x + self._attend(self._norm(x, f"{layer}.norm1"), layer)
                x = x + self._feed(self._norm(x, f"{layer}.norm2"), layer)
            else:
                x = self._norm(x + self._attend(x, layer), f"{layer}.norm1")
                x = self._norm(x + self._feed(x, layer), f"{layer}.norm2")
        return self._norm(x, "norm")

    def forward(self, tokens: np.ndarray) -> np.ndarray:
        """[batch, seq] ids to [batch, seq, vocab] logits."""
        return self.hidden(tokens) @ self.tensors["head"]

    def losses(self, sequences: list[np.ndarray]) -> np.ndarray:
        """The summed next-token loss of each sequence of two ids or more; logits are held for a few places at a time."""
        out = np.zeros(len(sequences))
        head = self.tensors["head"]
        longest = float(np.sqrt(np.einsum("ij,ij->j", head, head).max(initial=0)))
        ones = np.ones(head.shape[1], np.float32)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            # Alike in length, filled up on the right, where no place before sees it.
            upto = at + 1
            while upto < len(order) and (upto - at + 1) * len(sequences[order[upto]]) <= BATCH_PLACES:
                upto += 1
            own = order[at:upto]
            sizes = np.array([len(sequences[i]) for i in own])
            tokens = np.zeros((len(own), sizes[-1]), np.int64)
            for k, i in enumerate(own):
                tokens[k, : sizes[k]] = sequences[i]
            made = self.hidden(tokens)
            row, place = np.nonzero(np.arange(sizes[-1])[None, :] < (sizes - 1)[:, None])
            x, target = made[row, place], tokens[row, place + 1]
            loss = np.empty(len(row))
            for a in range(0, len(row), LOGIT_PLACES):
                own_x = x[a : a + LOGIT_PLACES]
                z = own_x @ head
                # No logit exceeds the product of the lengths; if that is small, the largest need not be taken off.
                safe = longest * float(np.sqrt(np.einsum("ij,ij->i", own_x, own_x).max())) <= SAFE_LOGIT
                picked = z[np.arange(len(z)), target[a : a + LOGIT_PLACES]]
                if not safe:
                    top = z.max(-1, keepdims=True)
                    z -= top
                    picked = picked - top[:, 0]
                np.exp(z, out=z)
                loss[a : a + LOGIT_PLACES] = np.log((z @ ones).astype(np.float64)) - picked
            np.add.at(out, np.array(own)[row], loss)
            at = upto
        return out


def _decoder(config: ModelConfig, seed: int, name: str | None) -> Decoder:
    return Decoder(config, seed, W.local(name) if name else None)


def forward(sequences: DataFrame, config: ModelConfig, seed: int = 0, path: str | None = None) -> DataFrame:
    """(seq, tokens, logits) of sequences (seq, tokens), by the weights of a file or untrained ones."""
    name = W.shipped(sequences.sparkSession, path) if path else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _decoder(config, seed, name)
        for batch in batches:
            made = [model.forward(np.array([t]))[0].tolist() for t in batch.column(1).to_pylist()]
            logits = pa.array(made, pa.list_(pa.list_(pa.float32())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), logits], ["seq", "tokens", "logits"])

    return sequences.select("seq", "tokens").mapInArrow(run, "seq int, tokens array<int>, logits array<array<float>>")


def windows(docs: DataFrame, context: int, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, nth, tokens): ids cut into runs of at most context that share one id with the next, so every pair of neighbours is in one."""
    step = context - 1
    starts = F.sequence(F.lit(0), F.floor((F.size(ids) - 2) / step).cast("int"))
    # The runs are cut before the explode: a row of each run with all ids would cost the square of a text's length.
    runs = F.when(F.size(ids) > 1, F.transform(starts, lambda k: F.slice(ids, k * step + 1, F.lit(context))))
    return docs.select(*keep, F.posexplode(runs).alias("nth", "tokens"))


def next_token_losses(
    sequences: DataFrame, config: ModelConfig, path: str, tokens: str = "tokens", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """(keep, n, loss): the predicted places of each sequence of two ids or more, and their summed loss, by the weights of a file."""
    name = W.shipped(sequences.sparkSession, path)
    narrow = sequences.filter(F.size(tokens) > 1).select(*keep, tokens)
    kinds = dict(narrow.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _decoder(config, 0, name)
        for batch in batches:
            own = [x.values.to_numpy(zero_copy_only=False) for x in batch.column(len(keep))]
            n = np.array([len(x) - 1 for x in own], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(n), pa.array(model.losses(own))], [*keep, "n", "loss"]
            )

    return narrow.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", n long, loss double")
