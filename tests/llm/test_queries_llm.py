"""The registered queries over a small folder, against plain Python over the same rows."""

import functools
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from loamworks.llm import fingerprints, langid, oracle, quality, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    r = random.Random(11)
    letters = {"en": "theandisofw", "de": "derunsichtöz"}
    words = {x: ["".join(r.choice(a) for _ in range(r.randint(2, 7))) for _ in range(300)] for x, a in letters.items()}
    text = lambda x, n: " ".join(r.choice(words[x]) for _ in range(n))
    out = [(i, text(x := r.choice(["en", "de"]), r.randint(3, 160)), x, "s", 1) for i in range(60)]
    passage = text("en", 50)
    out += [(100 + i, text("en", 30) + "\n" + passage + "\t" + text("en", 20 * i), "en", "s", 1) for i in range(5)]
    out += [(200 + i, out[3][1], out[3][2], "hot", 1) for i in range(6)]
    out += [(300, None, None, None, None), (301, "", "en", "s", 0), (302, " \n ", None, "s", 3), (303, "12 %% 34", "en", None, 8)]
    out += [(304, text("de", 9000), "de", "s", 1), (305, "x" * 20_000, "en", "s", 1), (306, "日本 \U0001f600 é\r\nz", None, "s", 1)]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows(), DOCS).coalesce(2).write.parquet(str(at / "documents.parquet"))
    labels = [(i, int(i % 4 > 0), 0) for i in range(60)] + [(None, 1, 0), (7, None, 0), (10**6, 0, 0)] + [(5, 1, 1)] * 40
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    return str(at)


def result(spark, folder, name):
    return registry.queries()[name](spark, folder).collect()


def payload(text):
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % 64 if raw else 64)


def test_op1(spark, folder):
    got = {r.doc_id: r for r in result(spark, folder, "op1_webp")}
    assert got.keys() == {x[0] for x in rows()}
    for i, text, *_ in rows():
        p, r = payload(text), got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len((text or "").encode()), len(p), hashlib.sha256(p).hexdigest())
        assert r.tail_crc32 == zlib.crc32(p[-64:])
    assert len({(got[i].media_sha256, got[i].media_bytes, got[i].feature) for i in (3, 200, 203, 205)}) == 1


def test_op2(spark, folder):
    got = {r.doc_id: r for r in result(spark, folder, "op2_langid")}
    for i, text, lang, *_ in rows():
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        if lang and i < 100:
            assert r.lang_pred == lang
    # The scores, by a sum over all segmentations of every word on its own.
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(langid.training(docs))
    known = langid.pieces(model.path)
    longest = max(map(len, known))

    @functools.cache
    def word(w):
        fore = [np.ones(len(model.languages))]
        for j, ends in enumerate(langid.lattice(w, known, longest)[1:], 1):
            fore.append(sum(fore[a] * (model.prob[p] if p >= 0 else langid.UNKNOWN) for a, p in ends))
        return np.log(fore[-1])

    for i, text, *_ in rows():
        if got[i].lang_pred != "und" and max(map(len, text.split())) < 90:
            v = sum(word(w) for w in text.lower().split())
            assert model.languages[int(v.argmax())] == got[i].lang_pred
            assert math.isclose(1 / np.exp(v - v.max()).sum(), got[i].score, rel_tol=1e-6)


def test_op3(spark, folder):
    t = Tokenizer.from_file(str(tokenizer_path("word_bpe_49k.json")))
    t.no_truncation()
    t.no_padding()
    got = {r.doc_id: r for r in result(spark, folder, "op3_bpe")}
    for i, text, *_ in rows():
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        assert tuple(got[i])[1:4] == want, i


def test_op4(spark, folder):
    own = sorted((int(hashlib.sha256((t or "").encode()).hexdigest()[:15], 16), i, t or "") for i, t, *_ in rows())
    total = sum(len(t.encode()) + 1 for *_, t in own)
    want, before, slots = {}, 0, Counter()
    for _, i, t in own:
        size = len(t.encode()) + 1
        shard = min(15, (2 * before + size) * 16 // (2 * total))
        want[i] = (size, zlib.crc32(t.encode()), "bytes", shard, slots[shard], None)
        slots[shard] += 1
        before += size
    assert {r.doc_id: tuple(r)[1:7] for r in result(spark, folder, "op4_sharding")} == want


def test_op6(spark, folder):
    got = result(spark, folder, "op6_quality")
    assert {r.doc_id for r in got} == {x[0] for x in rows()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    # The scores, from plain covariances and solved systems.
    texts = {i: t or "" for i, t, *_ in rows()}
    x = {i: np.array(quality.statistics(t)) for i, t in texts.items()}
    learnt = [(i, int(i % 4 > 0)) for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    parts = [np.array([x[i] for i, y in learnt if y == k]) for k in (0, 1)]
    cov = [np.cov(p.T, bias=True) for p in parts]
    n = [len(p) for p in parts]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    eye = np.eye(len(scale))
    odd = np.outer(scale, scale)

    def density(v, k):
        own = ((1 - quality.POOLED - quality.IDENTITY) * cov[k] + quality.POOLED * pooled) / odd + quality.IDENTITY * eye
        far = (v - parts[k].mean(0)) / scale
        return math.log(n[k] / sum(n)) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * far @ np.linalg.solve(own, far)

    for r in got:
        gap = np.clip(density(x[r.doc_id], 0) - density(x[r.doc_id], 1), -500, 500)
        assert math.isclose(1 / (1 + math.exp(gap)), r.score, rel_tol=1e-4, abs_tol=1e-9), r.doc_id


def test_op7(spark, folder):
    words = {i: WORD.findall(t or "") for i, t, *_ in rows()}
    seen = Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    want = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:4] for r in result(spark, folder, "op7_substrings")} == want


def test_op8(spark, folder):
    t = Tokenizer.from_file(str(tokenizer_path("word_bpe_49k.json")))
    t.no_truncation()
    t.no_padding()
    got = result(spark, folder, "op8_packing")
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    total = 0
    for i, text, *_ in rows():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in pieces] == [(k, 4096 * k) for k in range(-(-len(ids) // 4096))]
        for r in pieces:
            part = ids[r.start : r.start + 4096]
            assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert len(by_seq) <= -(-total // 4096) + 1


def test_op10(spark, folder):
    own = sorted(((i, t or "") for i, t, *_ in rows()), key=lambda x: -x[0])
    got = {r.doc_id: r for r in result(spark, folder, "op10_fingerprints")}
    for k, (i, t) in enumerate(own):
        after = own[(k + 1) % len(own)][1]
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        (a,), (b,), (c,) = (fingerprints.embed([x]) for x in (t, new, after))
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (fingerprints.as_text(len(t), a), fingerprints.as_text(len(new), b))
        assert got[i].near_edited == fingerprints.likeness(len(t), a, len(new), b)
        assert got[i].near_next == fingerprints.likeness(len(t), a, len(after), c)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_the_sql_gives_the_same(spark, folder, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.sql(oracle.SQL[name])
    names = want.columns
    got = registry.queries()[name](spark, folder).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)


def test_extra_columns_and_empty_tables(spark, tmp_path):
    """Clashing names change nothing; tables without rows give none."""
    docs = spark.createDataFrame([], DOCS + ", key long, part int, n long, shard int, text_crc32 long, score string, predicted string, lang_pred string, fp int, g int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "page_id long, url string, html string, text string, n_chars int, h long").write.parquet(str(tmp_path / "pages.parquet"))
    for name, query in registry.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert json.dumps(sorted(oracle.SQL)) == json.dumps(sorted(registry.oracle_sql()))
