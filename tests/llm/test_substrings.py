import random
from collections import Counter

from loamworks.llm.substrings import remove_repeats

SCHEMA = "doc_id long, text string, key string, n_words string, places string"


def brute(rows, width):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def check(spark, rows, width=35):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    got = remove_repeats(df, width=width).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows, width), key=str)


def corpus(seed, n=60, vocabulary=400):
    r = random.Random(seed)
    word = lambda: r.choice(["der", "the", "of"]) if r.random() < 0.3 else f"w{r.randrange(vocabulary)}"
    text = lambda n: [word() for _ in range(n)]
    passages = [text(r.randint(30, 80)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = text(r.randint(0, 120))
        for _ in range(r.randint(0, 3)):
            k = r.randint(0, len(t))
            p = list(r.choice(passages))
            if r.random() < 0.4:
                p[r.randrange(len(p))] = word()
            t[k:k] = p
        rows.append((i, r.choice([" ", "\n", "\t ", "\x0b"]).join(t)))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1)
    rows += [(100, None), (101, ""), (102, rows[3][1]), (103, rows[3][1]), (103, rows[3][1]), (None, rows[5][1])]
    rows += [(110, "und " * 300), (111, "a b " * 90), (112, "x y " * 40), (113, "é" * 5000)]
    check(spark, rows)


def test_a_window_repeated_inside_one_document(spark):
    p = " ".join(f"p{i}" for i in range(40))
    check(spark, [(1, f"{p} middle {p}"), (2, "nothing here " * 3)])


def test_short_windows_of_a_tiny_vocabulary(spark):
    check(spark, corpus(2, 40, 3), width=12)


def test_empty_table(spark):
    check(spark, [])
