import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from loamworks.operators import bpe, codec
from loamworks.plans import queries, trained

TEXTS = ["the cat and the hat " * 9, "", None, "Déjà vu, 世界 🎉 <|bos|> it's what they're saying", "aaaa abab " * 5]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("trained"))
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{out}/documents.parquet")
    return out


def test_trained_queries_equal_brute_force(spark, folder):
    texts = [t or "" for t in TEXTS]
    counts: dict[bytes, int] = {}
    for t in texts:
        for w in codec._WORDS.findall(t):
            counts[w.encode()] = counts.get(w.encode(), 0) + 1
    tokenizer = bpe.Tokenizer(tuple(bpe.learn_merges(counts, 300 - bpe.FLOOR)))
    own = codec.Codec(tokenizer)
    want = [own.encode(t) for t in texts]
    got = {r.doc_id: r for r in trained.trained_encode(spark, folder, 300).collect()}
    assert [(got[i].n_chars, got[i].ids) for i in range(len(texts))] == [(len(t), x) for t, x in zip(texts, want, strict=True)]
    back = {r.doc_id: (r.n_tokens, r.same) for r in trained.trained_decode(spark, folder, 300).collect()}
    assert back == {i: (len(x), True) for i, x in enumerate(want)}
    (r,) = trained.trained_report(spark, folder, 300).collect()
    assert (r.vocab_size, r.round_trips) == (tokenizer.vocab_size(), True)
    assert r.chars_per_token == sum(map(len, texts)) / sum(map(len, want))
    assert set(trained.queries()) <= set(__spark_entry__.queries())


def test_the_round_trip_goes_through_ids(spark, folder, monkeypatch):
    assert queries.round_trip(spark, folder).filter("not same").count() == 0
    monkeypatch.setattr(codec, "decode", lambda docs, tokenizer: docs.withColumn("decoded", F.lit("a fault of the tokenizer")))
    assert queries.round_trip(spark, folder).filter("same").count() == 0


def merged_plainly(parts: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    while found := [ranks[p] for p in zip(parts, parts[1:], strict=False) if p in ranks]:
        out: list[bytes] = []
        i = 0
        while i < len(parts):
            fits = i + 1 < len(parts) and ranks.get((parts[i], parts[i + 1])) == min(found)
            out.append(parts[i] + parts[i + 1] if fits else parts[i])
            i += 2 if fits else 1
        parts = out
    return parts


def test_merges_by_a_heap_equal_merges_round_by_round():
    own, rnd = codec.Codec(bpe.Tokenizer(())), random.Random(5)
    for _ in range(400):
        tokens, own.ranks = [b"a", b"b", b"c"], {}
        # Any order of merges, also those that no training gives: one token by two ways, a low rank that comes late.
        for _ in range(rnd.randint(0, 14)):
            pair = rnd.choice(tokens), rnd.choice(tokens)
            tokens.append(b"".join(pair))
            own.ranks.setdefault(pair, rnd.randint(0, 1 << 40))
        parts = [rnd.choice(tokens[:3]) for _ in range(rnd.choice([0, 1, 2, 5, 20, 60]))]
        assert own.merged(parts) == merged_plainly(parts, own.ranks)


def test_a_very_long_word_is_encoded_whole_and_not_remembered():
    own = codec.Codec(bpe.Tokenizer(tuple(bpe.learn_merges({b"abab" * 9: 3, b"abba": 2}, 8))))
    word = "ab" * 200_000
    began = time.process_time()
    assert own.decode(own.encode(word)) == word
    assert time.process_time() - began < 60
    assert not own.known


def test_batches_equal_texts_one_by_one(monkeypatch):
    """Chunks, reserved tokens, odd white space, long words; a table that is emptied often."""
    rnd = random.Random(6)
    parts = ["the", "cat", "it's", "été", "12", "...", "<|bos|>", "<|", "日本", "x" * 300, "\U0001f600"]
    gaps = [" ", " ", " ", "\n", "\t", "  ", " \n", "\xa0", "\xa0 ", " \xa0", "\u3000  ", "\x1c", "\x1c ", "\r\n", "\x85", ""]
    texts = ["".join(rnd.choice(parts) + rnd.choice(gaps) for _ in range(rnd.randint(0, 30))) for _ in range(300)] + ["", " ", "\n\n"]
    counts: dict[bytes, int] = {}
    for t in texts:
        for w in codec._WORDS.findall(t):
            counts[w.encode()] = counts.get(w.encode(), 0) + 1
    tokenizer = bpe.Tokenizer(tuple(bpe.learn_merges(counts, 150)))
    plain, own = codec.Codec(tokenizer), codec.Codec(tokenizer)
    monkeypatch.setattr(codec, "REMEMBERED", 60)
    for k in range(0, len(texts), 11):
        part = texts[k : k + 11]
        sizes, ids = own.encode_all(part)
        at = 0
        for t, n in zip(part, sizes.tolist(), strict=True):
            assert ids[at : at + n].tolist() == plain.encode(t), repr(t)
            at += n
        assert own.decode_all(sizes, ids) == part
    with pytest.raises(IndexError):
        own.decode_all(own.encode_all(["a"])[0], own.encode_all(["a"])[1] + 10**6)


def test_merges_of_many_words_at_once():
    rnd = random.Random(7)
    for _ in range(60):
        merges, tokens = [], [b"a", b"b", b"c"]
        for _ in range(rnd.randint(0, 14)):
            pair = rnd.choice(tokens), rnd.choice(tokens)
            tokens.append(b"".join(pair))
            merges.append(pair)
        own = codec.Codec(bpe.Tokenizer(tuple(merges)))
        words = ["".join(rnd.choice("abc") for _ in range(rnd.choice([0, 1, 2, 3, 9, 30]))).encode() for _ in range(40)] + [b"aaaaa", b"a" * 64]
        assert own.merge_all(words) == [[own.ids[p] for p in own.merged([bytes([b]) for b in w])] for w in words]
    assert codec.Codec(bpe.Tokenizer(())).merge_all([]) == []


def test_frequent_chunks_stay_and_the_rest_is_bounded(monkeypatch):
    monkeypatch.setattr(codec, "REMEMBERED", 100)
    own = codec.Codec(bpe.Tokenizer(()))
    for k in range(30):
        texts = ["often " * 5 + " ".join(f"u{k}x{i}" for i in range(40))] if k % 3 else [" ".join(f"v{k}x{i}" for i in range(70))]
        sizes, ids = own.encode_all(texts)
        assert own.decode_all(sizes, ids) == texts
        assert len(own.slots) <= 130 and own._met.n == own._at.n == own._size.n == len(own.slots)
    assert " often" in own.slots and codec.REMEMBERED_WORDS <= 100_000


def test_words_of_forgotten_chunks_are_not_merged_again():
    own = codec.Codec(bpe.Tokenizer(()))
    own.encode_all(["one two two"])
    own._forget()
    own.merge_all = lambda words: [] if not words else 1 / 0
    assert own.encode_all(["one two two"])[0].tolist() == [11]
