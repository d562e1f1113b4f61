"""Counting quotient filters and exact dedup against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest

from loamworks.llm import quotient, registry

DOCS = "doc_id long, text string, fp string, sha string, t int, n int, rid long, block int"


def rows():
    r = random.Random(5)
    words = ["one", "two", "drei", "vier", "été", "日本"]
    text = lambda: r.choice([" ", "\n", "\t\r"]).join(r.choice(words) for _ in range(r.randint(1, 4)))
    out = [(i, text()) for i in range(400)]
    out += [(1000 + i, "the same  hot\ntext") for i in range(300)] + [(2000 + i, "the same\x0bhot text") for i in range(30)]
    out += [(None, "one two"), (None, "alone"), (None, "no id"), (None, "no id"), (7, "id twice"), (7, "id twice"), (7, "id  twice"), (8, "id twice")]
    out += [(3000, None), (2999, ""), (3001, " "), (3002, "\n\n"), (3003, "x" * 200_000), (3004, "x" * 200_000), (3005, "x" * 199_999 + "y")]
    return out


def expected(docs):
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = {}
    for i, t in docs:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for t, ids in groups.items():
        own = sorted(ids, key=lambda i: (i is None, i or 0))
        out += [(i, own[0], len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(own)]
    return out


def frame(spark, docs):
    return spark.createDataFrame([(*d, "f", "s", 1, 2, 3, 4) for d in docs], DOCS).repartition(5)


def check(found, docs):
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected(docs), key=repr)


def test_query(spark, tmp_path):
    frame(spark, rows()).write.parquet(str(tmp_path / "documents.parquet"))
    check(registry.queries()["op13_exact_dedup"](spark, str(tmp_path)), rows())


def test_no_rows(spark):
    check(quotient.exact_dedup(frame(spark, [])), [])


@pytest.mark.parametrize(("bits", "most"), [(4, 1 << 20), (12, 0), (64, 0)])
def test_unlike_texts_of_one_fingerprint_stay_apart(spark, monkeypatch, bits, most):
    """Few bits let texts collide; without a broadcast the texts are joined by a shuffle."""
    monkeypatch.setattr(quotient, "HOT_ROWS", 20)
    check(quotient.exact_dedup(frame(spark, rows()), bits=bits, block_rows=50, most_broadcast=most), rows())


@pytest.mark.parametrize(("bits", "blocks"), [(64, 1), (64, 37), (64, 70_000), (40, 8), (13, 16), (4, 16), (64, 2**40)])
def test_filters_keep_fingerprints_and_counts(bits, blocks):
    r = np.random.default_rng(bits + blocks)
    layout = quotient.Layout(blocks, bits)
    prints, counts = quotient.counted(r.integers(0, 1 << bits, 500, np.uint64, endpoint=False) if bits < 64 else r.integers(0, 2**64, 500, np.uint64))
    counts = counts * r.choice([1, 1, 2, 300, 2**40], len(counts))
    own = layout.block(prints)
    for block in np.unique(own)[:40].tolist():
        a, b = prints[own == block], counts[own == block]
        back = quotient.unpack(quotient.pack(a, b, layout), block, layout)
        assert (back[0] == a).all() and (back[1] == b).all()


def test_merged_filters_count_as_one_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(quotient, "_HELD", 64)  # partitions give several filters of a block
    r = random.Random(2)
    prints = [r.choice([-1, 0, 5, r.getrandbits(63), -r.getrandbits(63)]) for _ in range(2000)]
    layout = quotient.Layout(8)
    df = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(6)
    whole = quotient.merged(quotient.filters(df, layout), layout)
    got = {x.fp: x.n for x in quotient.repeated(whole, layout, least=1).collect()}
    assert got == {p: prints.count(p) for p in set(prints)}
    assert {x.fp for x in quotient.repeated(whole, layout).collect()} == {p for p in set(prints) if prints.count(p) > 1}
