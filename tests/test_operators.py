import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamworks import cli
from loamworks.operators import bpe, codec, sequences
from loamworks.operators.config import SIZES, LayeredConfig, ModelConfig, RunConfig, load_model_config, parse_env
from loamworks.operators.model import Decoder, forward

TEXT = "The quick brown fox, 42 times! Déjà vu, привет, 世界 and emoji 🎉. It's what they're saying, isn't it? "
CASES = ["plain ascii text", "  spaces around  ", "line\nand\ttab", "é ñ привет 世界 🎉", "dash — “quotes” …!?", "", "<|bos|>a<|eos|><|pad|>b<|im_start|>"]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(TEXT,)] * 200, "text string").cache()


@pytest.fixture(scope="module")
def trained(corpus):
    return bpe.train(corpus, 2000)


def test_training(spark, corpus, trained, tmp_path):
    assert bpe.train(corpus, 320).vocab_size() == 320
    assert trained.vocab_size() > 256
    with pytest.raises(ValueError, match="too small"):
        bpe.train(corpus, 100)
    trained.save(str(tmp_path / "tokenizer.json"))
    assert bpe.Tokenizer.load(str(tmp_path / "tokenizer.json")) == trained
    assert bpe.vocab_size_from_file(str(tmp_path / "tokenizer.json")) == trained.vocab_size() == trained.vocab(spark).count()
    assert [trained.token_to_id(t) for t in bpe.SPECIAL_TOKENS] == [0, 1, 2, 3, 4]


def test_the_artifact_works_in_the_public_library(trained, tmp_path):
    from tokenizers import Tokenizer

    trained.save(str(tmp_path / "t.json"))
    other, own = Tokenizer.from_file(str(tmp_path / "t.json")), codec.Codec(trained)
    for t in [TEXT, *CASES]:
        assert other.encode(t, add_special_tokens=False).ids == own.encode(t)


def test_driver_and_dataframe_merges_agree(spark, corpus, trained):
    steps = bpe.first_merges(corpus, 6)
    assert [(l.lower(), r.lower()) for l, r, _ in steps] == [(a.hex(), b.hex()) for a, b in trained.merges[:6]]


def test_minimum_frequency_and_ties():
    assert bpe.learn_merges({b"ab": 1}, 9) == []
    assert bpe.learn_merges({b"cd": 2, b"ab": 2}, 1) == [(b"a", b"b")]
    assert bpe.learn_merges({b"aaaa": 2}, 9) == [(b"a", b"a"), (b"aa", b"aa")]


def test_codec(spark, trained):
    own = codec.Codec(trained)
    codec.verify_special_tokens(own)
    assert all(codec.round_trips(own, t) for t in [TEXT, *CASES])
    assert own.encode("<|bos|><|eos|>") == [1, 2]
    assert codec.chars_per_token(own, TEXT) > 1.5 and codec.chars_per_token(own, "") == 0.0
    df = spark.createDataFrame([(t,) for t in CASES] + [(None,)], "text string")
    rows = codec.decode(codec.encode(df, trained), trained).collect()
    assert all(r.text == r.decoded for r in rows)
    assert codec.report(trained, TEXT).round_trips


def test_same_symbol_from_two_merges():
    t = bpe.Tokenizer(((b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc")))
    assert t.vocab_size() == bpe.FLOOR + 3
    own = codec.Codec(t)
    assert own.decode(own.encode("abcabc")) == "abcabc"


def test_loss_and_guards(spark):
    z = [[1.0, 2.0, 3.0], [0.5, 0.0, -1.0], [9.0, 9.0, 9.0]]
    df = spark.createDataFrame([(z, [0, 2, 1])], "logits array<array<float>>, tokens array<int>")
    want = np.mean([math.log(sum(map(math.exp, z[i]))) - z[i][t] for i, t in ((0, 2), (1, 1))])
    assert math.isclose(sequences.next_token_loss(df).first().loss, want, rel_tol=1e-9)
    with pytest.raises(Exception, match="two tokens"):
        sequences.next_token_loss(spark.createDataFrame([(z, [0])], df.schema)).collect()
    short = spark.createDataFrame([([1],), ([1, 2, 3],)], "tokens array<int>")
    assert sequences.shift_pairs(short).collect() == [(1, 2), (2, 3)]
    assert sequences.within_context(short, 2).count() == 1


def test_model(spark):
    c = ModelConfig(97, 32, 16, 32, 2, 2, True)
    tokens = sequences.deterministic_tokens(spark, 2, 16, 97).groupBy((F.col("id") / 16).cast("int").alias("seq")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("id", "token"))), lambda x: x["token"].cast("int")).alias("tokens")
    )
    out = forward(tokens, c)
    logits = np.array(out.first().logits)
    assert logits.shape == (16, 97) and np.isfinite(logits).all()
    assert abs(sequences.next_token_loss(out).first().loss - math.log(97)) < 2
    m = Decoder(c)
    a, b = np.arange(8)[None] % 97, np.arange(8)[None] % 97
    b = b.copy()
    b[0, 7] = 50
    assert np.allclose(m.forward(a)[0, :7], m.forward(b)[0, :7])  # the future is not seen
    with pytest.raises(ValueError):
        m.forward(np.zeros((1, 33), int))
    vec = spark.createDataFrame([(0, 0, 5), (0, 1, 6)], "seq int, pos int, id int")
    table = spark.createDataFrame([(5, [1.0, 0.0]), (6, [0.0, 0.0])], "id int, vector array<double>")
    got = sequences.embed(vec, table).select("pos", sequences.positions(F.col("vector"), F.col("pos"), 2).alias("v")).orderBy("pos").collect()
    assert got[0].v == [1.0, 1.0] and np.allclose(got[1].v, [math.sin(1), math.cos(1)])


def test_config(tmp_path):
    base = SIZES["gpt2-small"]
    (tmp_path / "m.toml").write_text("d_model = 1024\nnum_heads = 16\nd_ff = 1408\n")
    env = parse_env("P_", [("P_D_FF", "1792"), ("P_NORM_FIRST", "true"), ("Q_X", "1")])
    assert env == {"d_ff": 1792, "norm_first": True} and parse_env("P_", [("P_D_FF", "wide")]) == {"d_ff": "wide"}
    c = load_model_config(base, str(tmp_path / "m.toml"), env, {"num_layers": 3})
    assert (c.d_model, c.num_heads, c.d_ff, c.num_layers, c.context_length) == (1024, 16, 1792, 3, 1024)
    assert load_model_config(base, None, {}, {"d_ff": 2560}).d_ff == 2560
    with pytest.warns(UserWarning, match="300"):
        assert load_model_config(base, None, {}, {"vocab_size": 7777}, 300).vocab_size == 300
    with pytest.raises(ValueError, match="invalid model configuration"):
        LayeredConfig().merge({"d_model": 768}).extract()
    with pytest.raises(FileNotFoundError):
        LayeredConfig().with_file(tmp_path / "no.toml")
    with pytest.raises(ValueError):
        LayeredConfig().with_file(tmp_path / "m.yaml")
    assert base.approx_parameter_count() == 98_130_432 and SIZES["debug-tiny"].approx_parameter_count() == 2_575_872
    assert ModelConfig(1, 1, 768, 1, 1, 7, True).head_dim() is None and ModelConfig(1, 1, 768, 1, 1, 0, True).head_dim() is None
    r = RunConfig(base)
    assert RunConfig.from_json(r.to_json()) == r


def test_cli(spark, tmp_path, capsys, monkeypatch):
    assert cli.main([]) == 0 and "usage" in capsys.readouterr().out
    (tmp_path / "c.txt").write_text((TEXT + "\n") * 50)
    out = str(tmp_path / "t.json")
    assert cli.main(["tokenizer", "--input", str(tmp_path / "c.txt"), "--output", out, "--vocab-size", "300"]) == 0
    assert bpe.vocab_size_from_file(out) == 300
    p = cli.parser()
    for bad in (["tokenizer"], ["tokenizer", "--input", "x", "--hf-repo", "y"], ["download"], ["generate"], ["train", "--size", "big"]):
        with pytest.raises(SystemExit):
            p.parse_args(bad)
    a = p.parse_args(["tokenizer", "--hf-repo", "o/r", "--hf-file", "a", "--hf-file", "b"])
    assert (a.hf_revision, a.text_field, a.vocab_size, a.min_frequency, a.hf_file) == ("main", "text", 16000, 2, ["a", "b"])
    with pytest.warns(UserWarning):
        assert cli.resolve_train(p.parse_args(["train", "--vocab-size", "7777", "--tokenizer", out]), {}).vocab_size == 300
    for argv in (["train"], ["generate", "Once"], ["serve"]):
        with pytest.raises(NotImplementedError):
            cli.main(argv)
    (tmp_path / "empty.txt").write_text("\n")
    with pytest.raises(ValueError):
        cli.main(["tokenizer", "--input", str(tmp_path / "empty.txt"), "--output", str(tmp_path / "no.json")])
    assert not (tmp_path / "no.json").exists()


def test_training_beyond_the_words_of_the_driver_is_whole(spark, monkeypatch):
    # "qz" occurs in rare words only, each once: together they outnumber every other pair.
    rare = [f"qz{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    texts = ["the cat and the hat " * 9, "aaaaaaa aaaa abab ababab " * 3, *rare]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = {r.w.encode(): r.n for r in bpe.word_counts(df).collect()}
    want = bpe.learn_merges(counts, 40)
    assert want[0] == (b"q", b"z")
    monkeypatch.setattr(bpe, "MOST_SYMBOLS", 100)
    assert bpe.train(df, bpe.FLOOR + 40).merges == tuple(want)


def test_decoding_ids_that_are_no_text(spark):
    from loamworks.operators import bpe, codec

    t = bpe.Tokenizer(())
    cases = [[5 + 0xC3], [5 + 0xE2, 5 + 0x82], [5 + 0x41, 5 + 0xFF, 5 + 0x42], []]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, ids array<int>")
    got = {r.i: r.decoded for r in codec.decode(rows, t).collect()}
    assert got == {i: codec.Codec(t).decode(c) for i, c in enumerate(cases)}
