"""The Merkle manifest against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loamworks.llm import merkle, registry

DOCS = "doc_id long, text string, lang string, source string, n_chars long, g string, idx int, n int, hash string, run int, left string, path string"


def rows():
    r = random.Random(3)
    text = lambda: "".join(r.choice("abc ABCÉé日\n") for _ in range(r.randint(0, 40)))
    out = [(i, text(), r.choice(["en", None]), "hot", i) for i in range(300)]
    out += [(1000 + i, text(), "en", f"s{i % 3}", None) for i in range(50)]
    out += [(i, text(), "en", None, 1) for i in range(2000, 2017)] + [(3000, "One", "en", "ö", 3), (3001, None, None, "Z", None)]
    out += [(5, "twice", "en", "hot", 1), (5, "twice", "en", "hot", 1), (5, "other", "en", "hot", 1), (None, "A", "en", "hot", 1), (None, None, None, None, None)]
    out += [(4000, "LONG " * 50_000, "en", "s1", 1), (4005, "", "en", "", 0)] + [(5000 + i, "U", "en", f"only{i:03}", 1) for i in range(40)]
    return out


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """The root of the nodes, and for each the (left, right) siblings of every level."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            steps[k].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
            at[k] = p // 16
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], steps


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d[3], []).append(d)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    found = {}
    for x in names:
        own = sorted(groups[x], key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
        found[x] = (own, *tree([leaf(*d) for d in own]))
    root, above = tree([found[x][1] for x in names])
    out = []
    for x, up in zip(names, above, strict=True):
        own, subroot, steps = found[x]
        for d, step in zip(own, steps, strict=True):
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            now = leaf(d[0], lowered(d[1]), *d[2:]) if hit else leaf(*d)
            for left, right in step + up:
                now = h(left, now, right)
            out.append((d[0], leaf(*d), subroot, root, h(*(a + b for a, b in step + up)), now, now == root))
    return out


def written(spark, tmp_path, docs):
    full = [(*d, "g", 1, 2, "h", 3, "l", "p") for d in docs]
    spark.createDataFrame(full, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return registry.queries()["op11_merkle"](spark, str(tmp_path))


def test_against_plain_python(spark, tmp_path):
    got = written(spark, tmp_path, rows())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(expected(rows()), key=repr)
    assert {r[-1] for r in got} == {True, False}


def test_totals_joined_by_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "MOST_TOTALS", 0)
    got = written(spark, tmp_path, rows())
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(rows()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_sizes_of_a_single_group(spark, tmp_path, n):
    docs = [(i, f"T{i}", "en", "s", i) for i in range(n)]
    got = written(spark, tmp_path, docs)
    assert sorted(map(tuple, got.collect())) == (sorted(expected(docs)) if docs else [])


def test_proofs_verify_alone(spark, tmp_path):
    """A path and a leaf give the root; a path of another row does not."""
    docs = spark.createDataFrame([d for d in rows() if d[0] is not None], "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.merkle_manifest(docs).withColumn("back", merkle.folded(F.col("leaf"), F.col("path")))
    assert found.filter("back <> root").count() == 0
    changed = found.withColumn("back", merkle.folded(F.sha2(F.lit("x"), 256), F.col("path")))
    assert changed.filter("back = root").count() == 0
