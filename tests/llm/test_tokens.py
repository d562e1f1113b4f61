import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from loamworks.llm import bpe, packing, sharding

SCHEMA = "doc_id long, text string, size string, part string, rank string, shard string, start string"
ODD = [
    "", "  ", "İstanbul ΣΑΣ ΟΔΟΣ. é é", "a<|endoftext|>b <|startoftext|><|endoftext|>", "\x00<|STARTOFTEXT|>",
    "don't we'll 12345 ½ ² \x1c\x1d x\x1fy", "日本語テキスト 中文 🎉🎉 ñandú", "a b　c d", "I'M THE ONE's", "🎉" * 50,
    "ﬁ ǅ ß ẞ", "́ á́ e ́", "antidisestablishmentarianism" * 40, "ab" * 5000, "﻿x ​ y",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def texts():
    r = random.Random(1)
    tokens = [t.replace("</w>", "") for t in list(bpe.encoder(bpe.vocabulary_path()).ids)[600:]]
    return ODD + ["".join(r.choice(tokens) for _ in range(r.randint(1, 5))) for _ in range(800)]


def rows_of(own):
    return [(i, t, "", "", "", "", "") for i, t in enumerate(own)]


def test_encoding_and_decoding_equal_the_library(spark, library):
    own = texts() + [None]
    df = spark.createDataFrame(rows_of(own), SCHEMA)
    ids = {r.doc_id: r.ids for r in bpe.encode(df).collect()}
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df)).collect()}
    marks = {r.doc_id: r for r in bpe.digests(df).collect()}
    for i, t in enumerate(own):
        e = library.encode(t or "", add_special_tokens=False).ids
        d = library.decode(e, skip_special_tokens=False)
        assert ids[i] == e and back[i] == d, t
        assert marks[i].n_tokens == len(e)
        assert marks[i].ids_sha256 == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
        assert marks[i].decoded_sha256 == hashlib.sha256(d.encode()).hexdigest()
    assert bpe.digests(df.limit(0)).count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    small, big = bpe.WordBpe(bpe.vocabulary_path()), bpe.encoder(bpe.vocabulary_path())
    for a in range(0, 200, 10):
        assert list(small.encode_texts(texts()[a : a + 10])) == list(big.encode_texts(texts()[a : a + 10]))


def test_long_chunks_are_encoded_whole_and_not_remembered(library):
    own = ["ab" * 700, "x " + "日本" * 300, "ab" * 700, "<|endoftext|>" + "c" * 300, "c" * 300 + " <|STARTOFTEXT|>" + "d" * 300]
    want = [library.encode(t, add_special_tokens=False).ids for t in own]
    table, ids = bpe.WordBpe(bpe.vocabulary_path()), packing.ChunkIds(bpe.vocabulary_path())
    for _ in range(2):
        assert [[int(x) for s, _ in t for x in s.split()] for t in table.encode_texts(own)] == want
        assert [np.frombuffer(x, "<u4").tolist() for x in ids.ids_of(own)] == want
    assert max(map(len, [*table.chunks, *ids.known, *ids.chunks])) <= bpe.LONGEST


def test_long_merging_equals_plain_merging():
    b = bpe.encoder(bpe.vocabulary_path())
    r = random.Random(3)
    for n in (65, 80, 200):
        s = b.symbols("".join(r.choice("abcaberstin") for _ in range(n)) + "</w>")
        whole, cut = b._merge_long(list(s)), list(s)
        while True:
            ranked = [(b.ranks[p], i) for i, p in enumerate(zip(cut, cut[1:], strict=False)) if p in b.ranks]
            if not ranked:
                break
            i = min(ranked)[1]
            cut[i : i + 2] = [cut[i] + cut[i + 1]]
        assert whole == cut


def test_packing(spark, library):
    own = texts()[:60] + ["word " * 500, None] * 3
    df = spark.createDataFrame(rows_of(own), SCHEMA).repartition(5)
    got = packing.pack(df, capacity=100).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(own)}
    seen, bins = {}, {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length <= 100 and r.start == 100 * r.piece
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == {i: len(x) for i, x in ids.items()}
    for b in bins.values():
        end = 0
        for o, n in sorted(b):
            assert o == end
            end += n
        assert end <= 100
    assert packing.pack(df.limit(0)).count() == 0


def test_patterns_use_all_counts_and_few_bins():
    r = random.Random(4)
    for k in range(30):
        counts = {n: r.randint(1, 400) for n in r.sample(range(1, 1025), r.randint(1, 300))}
        used, bins = {}, 0
        for times, lengths in packing.pack_counts(counts, 1024):
            assert sum(lengths) <= 1024 and times > 0
            bins += times
            for n in lengths:
                used[n] = used.get(n, 0) + times
        assert used == counts
        least = max(-(-sum(n * c for n, c in counts.items()) // 1024), sum(c for n, c in counts.items() if n > 512))
        assert bins <= 1.1 * least + 2, k


def test_shards(spark):
    r = random.Random(5)
    own = ["x" * r.randint(0, 60) for _ in range(700)] + ["same é text"] * 300 + [None, None, "", "y" * 2000]
    df = spark.createDataFrame(rows_of(own), SCHEMA)
    got = sharding.shard_by_bytes(df).collect()
    assert sorted(g.doc_id for g in got) == list(range(len(own)))
    sums = [0] * 16
    slots = [[] for _ in range(16)]
    for g in got:
        data = (own[g.doc_id] or "").encode()
        assert g.size == len(data) + 1 and g.text_crc32 == zlib.crc32(data) and g.law == "bytes" and g.grown_shard is None
        sums[g.shard] += g.size
        slots[g.shard].append(g.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert all(abs(s - sum(sums) / 16) <= 2001 for s in sums)
    assert sharding.shard_by_bytes(df.limit(0)).count() == 0


def test_words_are_merged_together_and_encoded_once(library, monkeypatch):
    r = random.Random(9)
    words = ["".join(r.choice("etaoinsrhl") for _ in range(r.randint(3, 14))) for _ in range(400)] + ["ab" * 100, "x" * 65, "y" * 64]
    one_by_one, encoded = [], []
    merge, encode_words = bpe.WordBpe.merge, bpe.WordBpe.encode_words
    monkeypatch.setattr(bpe.WordBpe, "merge", lambda self, s: one_by_one.append(len(s)) or merge(self, s))
    monkeypatch.setattr(bpe.WordBpe, "encode_words", lambda self, w: encoded.extend(w) or encode_words(self, w))
    own = bpe.WordBpe(bpe.vocabulary_path())
    for mark in ("", ",", ".", "***"):
        texts_ = [" ".join(w + mark for w in words)]
        got = [int(x) for s, _ in next(own.encode_texts(texts_)) for x in s.split()]
        assert got == library.encode(texts_[0], add_special_tokens=False).ids
    assert sorted(encoded) == sorted({*words, ",", ".", "***"})
    assert all(n > bpe.TOGETHER for n in one_by_one)
