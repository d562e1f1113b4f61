"""The decoder against a second form of it, written place by place; weights in files; losses over documents."""

import math
import time

import numpy as np
import pytest

from loamworks.operators import bpe, codec, model, weights
from loamworks.operators.config import SIZES, ModelConfig
from loamworks.plans import trained

SMALL = ModelConfig(53, 12, 8, 20, 2, 2, True)


def plain_logits(t, config, ids):
    """The logits after each of the ids, one place and one head at a time, in double precision."""
    t = {k: np.asarray(v, np.float64) for k, v in t.items()}
    d, h = config.d_model, config.num_heads
    norm = lambda x, n: (x - x.mean()) / math.sqrt(((x - x.mean()) ** 2).mean() + 1e-5) * t[n + ".scale"] + t[n + ".shift"]
    linear = lambda x, n: x @ t[n + ".weight"] + t[n + ".bias"]
    gelu = lambda y: 0.5 * y * (1 + np.tanh(math.sqrt(2 / math.pi) * (y + 0.044715 * y**3)))

    def attend(xs, n):
        q, k, v = ([linear(x, f"{n}.{w}") for x in xs] for w in ("query", "key", "value"))
        out = []
        for i in range(len(xs)):
            heads = []
            for a in range(0, d, d // h):
                part = slice(a, a + d // h)
                e = [math.exp(q[i][part] @ k[j][part] / math.sqrt(d // h)) for j in range(i + 1)]
                heads.append(sum(e[j] * v[j][part] for j in range(i + 1)) / sum(e))
            out.append(linear(np.concatenate(heads), f"{n}.output"))
        return out

    place = lambda p: np.array([math.sin(p / 10000 ** (i / d)) if i % 2 == 0 else math.cos(p / 10000 ** ((i - 1) / d)) for i in range(d)])
    xs = [t["embedding"][i] + place(p) for p, i in enumerate(ids)]
    for k in range(config.num_layers):
        n = f"layers.{k}"
        feed = lambda x, n=n: linear(gelu(linear(x, f"{n}.up")), f"{n}.down")
        if config.norm_first:
            xs = [x + y for x, y in zip(xs, attend([norm(x, f"{n}.norm1") for x in xs], n), strict=True)]
            xs = [x + feed(norm(x, f"{n}.norm2")) for x in xs]
        else:
            xs = [norm(x + y, f"{n}.norm1") for x, y in zip(xs, attend(xs, n), strict=True)]
            xs = [norm(x + feed(x), f"{n}.norm2") for x in xs]
    return [norm(x, "norm") @ t["head"] for x in xs]


def plain_loss(t, config, ids):
    made = plain_logits(t, config, ids)
    return sum(math.log(np.exp(z).sum()) - z[i] for z, i in zip(made, ids[1:], strict=False))


def odd_weights(config, seed):
    """Norms and biases that are not the plain ones."""
    r = np.random.default_rng(seed)
    return {k: (v + r.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in weights.initial(config, seed).items()}


@pytest.mark.parametrize("norm_first", [True, False])
def test_forward_and_losses(norm_first):
    config = ModelConfig(53, 12, 8, 20, 2, 2, norm_first)
    t = odd_weights(config, 1)
    own = model.Decoder(config, tensors=t)
    r = np.random.default_rng(2)
    sequences = [r.integers(0, 53, n) for n in (2, 12, 5, 5, 7, 2, 11)]
    for ids in sequences:
        assert np.allclose(own.forward(ids[None])[0], plain_logits(t, config, ids), atol=1e-4)
    for places, logits in ((8192, 1024), (20, 3)):
        model.BATCH_PLACES, model.LOGIT_PLACES = places, logits
        assert np.allclose(own.losses(sequences), [plain_loss(t, config, x) for x in sequences], atol=1e-3)
    model.BATCH_PLACES, model.LOGIT_PLACES = 8192, 1024
    with pytest.raises(ValueError, match="context"):
        own.losses([np.zeros(13, int)])


def test_files(spark, tmp_path):
    t = odd_weights(SMALL, 3) | {"extra": np.arange(3, dtype=np.float64), "none": np.zeros((0, 4), np.float16)}
    at = f"file://{tmp_path}/w.safetensors"
    weights.save(spark, t, at)
    back = weights.read(f"{tmp_path}/w.safetensors")
    assert back.keys() == t.keys() and all((np.asarray(back[k]) == t[k]).all() and back[k].dtype == t[k].dtype for k in t)
    assert weights.checked(back, SMALL).keys() == weights.shapes(SMALL).keys()
    with pytest.raises(ValueError, match="lack"):
        weights.checked({k: v for k, v in t.items() if k != "head"}, SMALL)
    with pytest.raises(ValueError, match="not"):
        weights.checked(t | {"head": t["head"].T}, SMALL)


def test_the_size_of_a_model():
    small = SIZES["gpt2-small"]
    assert 80e6 <= weights.count(small) <= 140e6
    # The estimate counts learnt positions in place of an untied head.
    assert weights.count(small) - small.approx_parameter_count() == (small.vocab_size - small.context_length) * small.d_model


def test_windows_hold_each_pair_once(spark):
    rows = [(n, list(range(n))) for n in (0, 1, 2, 4, 5, 7, 8, 20)]
    df = spark.createDataFrame(rows, "doc_id int, ids array<int>")
    got = {}
    for r in model.windows(df, 4).collect():
        assert 2 <= len(r.tokens) <= 4
        got.setdefault(r.doc_id, []).extend(zip(r.tokens, r.tokens[1:], strict=False))
    assert {k: sorted(v) for k, v in got.items()} == {n: [(i, i + 1) for i in range(n - 1)] for n in (2, 4, 5, 7, 8, 20)}


def test_loss_over_documents(spark, tmp_path):
    texts = ["the cat and the hat " * 9, "", None, "Déjà vu, 世界 it's", "x", "aaaa abab " * 40]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_predicted, r.loss) for r in trained.decoder_loss(spark, str(tmp_path)).collect()}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = bpe.Tokenizer(tuple(bpe.counted_merges(docs, trained.LOSS_MERGES)[0]))
    config = trained.loss_model(tokenizer.vocab_size())
    t, own, c = weights.initial(config, 0), codec.Codec(tokenizer), config.context_length
    total = 0.0
    for i, text in enumerate(texts):
        ids = own.encode(text or "")
        loss = sum(plain_loss(t, config, ids[a : a + c]) for a in range(0, max(len(ids) - 1, 0), c - 1))
        assert got[i][0] == max(len(ids) - 1, 0)
        assert got[i][1] == (pytest.approx(loss / got[i][0], abs=1e-3) if got[i][0] else None)
        total += loss
    # Untrained, it guesses about evenly.
    assert abs(total / sum(n for n, _ in got.values()) - math.log(tokenizer.vocab_size())) < 2


def test_losses_take_little_more_than_the_logits():
    """A power in the activation took more than half of the time."""
    config = ModelConfig(761, 128, 32, 64, 1, 2, True)
    made, r = model.Decoder(config), np.random.default_rng(1)
    sequences = [r.integers(0, 761, 128) for _ in range(160)]
    x = np.ones((256, 32), np.float32)

    def least(f):
        took = []
        for _ in range(4):
            t = time.process_time()
            f()
            took.append(time.process_time() - t)
        return min(took)

    logits = least(lambda: [np.exp(x @ made.tensors["head"]) for _ in range(80)])
    assert least(lambda: made.losses(sequences)) < 8 * logits


def test_losses_of_large_logits():
    config = ModelConfig(50, 16, 8, 16, 1, 2, True)
    tensors = weights.initial(config)
    tensors["head"] = tensors["head"] * np.float32(3000)
    made, tokens = model.Decoder(config, tensors=tensors), np.arange(10) * 3
    z = made.forward(tokens[None])[0].astype(np.float64)[:-1]
    assert z.max() > 100
    want = (np.log(np.exp(z - z.max(-1, keepdims=True)).sum(-1)) + z.max(-1) - z[np.arange(9), tokens[1:]]).sum()
    assert made.losses([tokens])[0] == pytest.approx(want, rel=1e-4)


def test_windows_do_not_carry_all_ids(spark):
    docs = spark.createDataFrame([(1, list(range(10))), (2, [5]), (3, [])], "doc_id long, ids array<int>")
    cut = model.windows(docs, 4)
    got = [(r.doc_id, r.nth, r.tokens) for r in cut.orderBy("doc_id", "nth").collect()]
    assert got == [(1, 0, [0, 1, 2, 3]), (1, 1, [3, 4, 5, 6]), (1, 2, [6, 7, 8, 9])]
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(" in plan and "sequence" in plan.split("posexplode(")[1].splitlines()[0]
