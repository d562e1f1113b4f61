"""Training by hot fragments against the driver's loop over all words."""

import random

import pytest

from loamworks.operators import bpe, hot_merges


def table(spark, counts):
    rows = [(w, n) for w, n in counts.items()]
    return spark.createDataFrame(rows, "w string, n long").repartition(3)


def words(seed, letters, many, longest):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(1, longest))): r.choice([1, 1, 2, 3, 50]) for _ in range(many)}


# Few letters: runs of one symbol, one product by two ways, many ties.
CASES = [(words(1, "ab", 60, 14), 200), (words(2, "abcdefgh", 150, 9), 250), (words(3, "aé日 ", 80, 8), 200), ({"a": 5, "": 3}, 9), ({"aaaaaaa": 2}, 9), ({}, 3)]


@pytest.mark.parametrize(("counts", "target"), CASES)
@pytest.mark.parametrize(("first", "most_symbols"), [(2, 10**6), (8, 60), (4096, 10**6)])
def test_equal_merges(spark, monkeypatch, counts, target, first, most_symbols):
    monkeypatch.setattr(hot_merges, "HOT_PAIRS", first)
    monkeypatch.setattr(hot_merges, "_HELD", 20)
    want = bpe.learn_merges({w.encode(): n for w, n in counts.items()}, min(target, 25))
    assert hot_merges.spark_merges(table(spark, counts), min(target, 25), most_symbols=most_symbols) == want


def test_one_round_gives_many_merges(spark):
    counts, heard = words(4, "abcdefghijklmnop", 300, 9), []
    want = bpe.learn_merges({w.encode(): n for w, n in counts.items()}, 10_000)
    assert hot_merges.spark_merges(table(spark, counts), 10_000, told=heard.append) == want
    assert len(heard) <= 12 and len(want) > 100
    assert hot_merges.spark_merges(table(spark, counts), 10_000, min_frequency=40) == bpe.learn_merges({w.encode(): n for w, n in counts.items()}, 10_000, 40)


def test_too_many_pairs_of_one_count_are_merged_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(hot_merges, "MOST_HOT", 0)
    counts = words(5, "abc", 30, 6)
    want = bpe.learn_merges({w.encode(): n for w, n in counts.items()}, 6)
    assert hot_merges.spark_merges(table(spark, counts), 6) == want


def test_a_large_table_begins_with_few_hot_pairs(spark, monkeypatch):
    passes, fragments = [], hot_merges.fragments
    monkeypatch.setattr(hot_merges, "fragments", lambda w, hot: passes.append(len(hot)) or fragments(w, hot))
    monkeypatch.setattr(bpe, "MOST_SYMBOLS", 400)
    counts, r = words(6, "abcdefghijklmnop", 900, 9), random.Random(7)
    rows = [(" " * bool(w) + w,) for w, n in counts.items() for _ in range(n)]
    r.shuffle(rows)
    got, often = bpe.counted_merges(spark.createDataFrame(rows, "text string"), 12)
    kept = {}
    for (t,) in rows:
        kept[t.encode()] = kept.get(t.encode(), 0) + 1
    assert got == bpe.learn_merges(kept, 12) and len(often) == 12
    # The first pass over the words is for few hot pairs already, not for thousands that are then too many.
    assert passes[0] <= 2 * hot_merges.LEAST_HOT
    assert [hot_merges.first_hot(n, 10) for n in (None, 10, 20, 10**6)] == [4096, 4096, 1024, 16]
    assert [hot_merges.faster(n, 1024) for n in (0, 1, 2, 15, 16, 127, 128, 9999)] == [8, 8, 4, 4, 2, 2, 1, 1]
