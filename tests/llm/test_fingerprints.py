import hashlib
import random

import numpy as np

from loamworks.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, part string, rim string"


def plain(text):
    """The walk of one text, step by step, and its samples."""
    w, out, level = fp.walk(), [], fp.level_of(len(text))
    classes = fp._classes(text)
    for b in range(0, len(text), fp.BLOCK):
        c = [*classes[b : b + fp.BLOCK].tolist(), 255]
        at, written = 0, []
        reached = max(int(x) for x in w.level[: 2 * (len(c) - 1)])
        for j in range(fp.steps_for(len(c) - 1)):
            written.append(c[at])
            at += int(w.moves[j][c[at]])
            if w.level[j] >= min(level, reached):
                h = 0
                for x in written[-8:]:
                    h = (h << 4 ^ int(w.hash[x])) & 0xFFFFFFFF
                for x in written[:-8]:
                    pass
                full = 0
                for x in written:
                    full = (full << 4 ^ int(w.hash[x])) & 0xFFFFFFFF
                assert full == h
                out.append(full >> 24)
    return out


def test_lockstep_equals_step_by_step():
    r = random.Random(5)
    texts = ["", "a", "née 🎉", "x" * 300] + ["".join(r.choice("abcdé \n") for _ in range(r.randrange(700))) for _ in range(6)]
    for t, s in zip(texts, fp.embed(texts), strict=True):
        assert s.tolist() == plain(t)
        assert len(s) == len(fp.places(len(t), fp.level_of(len(t))))
        n, back = fp.parsed(fp.as_text(len(t), s))
        assert n == len(t) and (back == s).all()


def test_near_texts_are_near_and_far_texts_far():
    r = random.Random(6)
    base = "".join(r.choice("etaoin shrdlu") for _ in range(30_000))
    other = "".join(r.choice("etaoin shrdlu") for _ in range(29_000))
    few = list(base)
    for _ in range(10):
        few.insert(r.randrange(len(few)), "z")
    few = "".join(few)
    a, b, c = fp.embed([base, few, other])
    assert fp.likeness(len(base), a, len(base), a) == 1
    assert fp.likeness(len(base), a, len(few), b) > 0.6
    assert fp.likeness(len(base), a, len(other), c) < 0.1


def test_rows_and_their_order(spark):
    rows = [(i, "".join(random.Random(i).choice("abc d") for _ in range(37 * i % 190))) for i in range(50)]
    rows += [(60, None), (61, rows[7][1]), (None, "nobody")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(7)
    got = {r.doc_id: r for r in fp.fingerprints(df).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda x: -1 if x[0] is None else x[0], reverse=True)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        e = fp.edited(t or "", n or "")
        assert got[i].n_chars == len(t or "")
        assert got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        a, b, c = fp.embed([t or "", n or "", e])
        assert got[i].fingerprint == fp.as_text(len(t or ""), a)
        assert got[i].edited_fingerprint == fp.as_text(len(e), c)
        assert np.isclose(got[i].near_next, fp.likeness(len(t or ""), a, len(n or ""), b))
    assert got[61].fingerprint == got[7].fingerprint


def test_empty_and_single_tables(spark):
    assert fp.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    one = fp.fingerprints(spark.createDataFrame([(1, "alone", "", "")], SCHEMA)).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"aloal").hexdigest()


def test_near_pairs_finds_copies_and_near_copies(spark):
    r = random.Random(9)
    texts = ["".join(r.choice("etaoin shrdlu") for _ in range(3000)) for _ in range(20)]
    rows = list(enumerate(texts)) + [(100, texts[3]), (101, texts[4][:1500] + "!" + texts[4][1500:])]
    marks = spark.createDataFrame([(i, fp.as_text(len(t), s)) for (i, t), s in zip(rows, fp.embed([t for _, t in rows]), strict=True)], "doc_id long, fingerprint string")
    got = {(p.a, p.b) for p in fp.near_pairs(marks, 0.4).collect()}
    assert (3, 100) in got and all(a % 97 == b % 97 for a, b in got)


def marked(spark, rows):
    """(doc_id, fingerprint) of rows (id, text), and the fingerprints parsed."""
    samples = fp.embed([t for _, t in rows])
    marks = [(i, fp.as_text(len(t), s)) for (i, t), s in zip(rows, samples, strict=True)]
    return spark.createDataFrame(marks, "doc_id long, fingerprint string"), [(len(t), s) for (_, t), s in zip(rows, samples, strict=True)]


def test_near_pairs_finds_edits_at_the_start_the_middle_and_the_end(spark):
    r = random.Random(31)
    word = lambda n: "".join(r.choice("etaoin shrdlu") for _ in range(n))
    rows = []
    for i in range(30):
        base, at = word(20_000), (0, 9000, 17_000)[i % 3]
        rows += [(2 * i, base), (2 * i + 1, base[:at] + word(3000) + base[at + 3000 :])]
    marks, parsed = marked(spark, rows)
    want = {(j, i) for i in range(len(rows)) for j in range(i) if fp.likeness(*parsed[i], *parsed[j]) >= 0.75}
    assert {a // 2 % 3 for a, _ in want} == {0, 1, 2}
    assert {(p.a, p.b) for p in fp.near_pairs(marks, 0.75).collect()} == want


def test_near_pairs_beside_an_unlike_leader(spark, monkeypatch):
    # Bands of one place of few values: an unrelated document of the least id leads many of them.
    r = random.Random(8)
    word = lambda n: "".join(r.choice("ab") for _ in range(n))
    base = word(3000)
    rows = [(0, word(3000))] + [(i, base[:1500] + "!" * i + base[1500:]) for i in range(1, 5)] + [(9, base[:1500] + "!" + base[1500:])]
    samples = fp.embed([t for _, t in rows])
    ids = [*(i for i, _ in rows), None, 1]
    texts = [*(fp.as_text(len(t), s) for (_, t), s in zip(rows, samples, strict=True))]
    # A null id with the text of 2, and the id 1 again with another text.
    texts += [texts[2], texts[3]]
    marks = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, fingerprint string")
    leader = {}
    for i, t in zip(ids, texts, strict=True):
        if i is not None:
            leader[t] = min(leader.get(t, i), i)
    like = lambda x, y: fp.likeness(*fp.parsed(x), *fp.parsed(y))
    order = sorted(leader, key=lambda t: (leader[t], t))
    least = 0.05
    want = [(leader[x], leader[y]) for k, x in enumerate(order) for y in order[k + 1 :] if like(x, y) >= least]
    want += [(leader[t], i) for i, t in zip(ids, texts, strict=True) if i != leader[t]]
    assert (2, None) in want and (1, 1) in want and (1, 2) in want
    for cell in (fp.CELL, 2):
        monkeypatch.setattr(fp, "CELL", cell)
        got = [(p.a, p.b) for p in fp.near_pairs(marks, least, bands=64, bits=8).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_no_block_of_a_very_long_text_is_left_out():
    r = random.Random(12)
    blocks = ["".join(r.choices("etaoin shrdlu", k=fp.BLOCK)) for _ in range(600)]
    text = "".join(blocks) + "the end"
    (own,) = fp.embed([text])
    assert own.tolist() == plain(text)
    assert len(own) == len(fp.places(len(text), fp.level_of(len(text)))) >= len(blocks)
    for b in range(0, len(blocks), 100):
        # Every second block, or three of four, were not read: all of ten in a row are replaced here, each must differ.
        other = "".join([*blocks[:b], *("".join(r.choices("ETAOIN", k=fp.BLOCK)) for _ in range(10)), *blocks[b + 10 :]]) + "the end"
        (new,) = fp.embed([other])
        assert np.flatnonzero(own != new).tolist() == list(range(b, b + 10))


def test_near_pairs_on_the_fingerprints_of_documents(spark):
    r = random.Random(14)
    texts = ["".join(r.choice("etaoin shrdlu") for _ in range(r.randrange(200, 9000))) for _ in range(12)]
    rows = [*enumerate(texts), *((20 + i, t[:-20] + "#" * 20) for i, t in enumerate(texts[:6])), (40, texts[2]), (41, None), (42, "")]
    made = fp.fingerprints(spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA)).cache()
    mark = {m.doc_id: fp.parsed(m.fingerprint) for m in made.collect()}
    ids = sorted(mark)
    want = {(a, b) for a in ids for b in ids if a < b and fp.likeness(*mark[a], *mark[b]) >= 0.75} - {(22, 40)}
    assert {(2, 40), (41, 42), (2, 22)} <= want
    assert {(p.a, p.b) for p in fp.near_pairs(made).collect()} == want


def test_a_short_last_block_leaves_a_sample():
    long_ = "x" * (600 * fp.BLOCK)
    seen = set()
    for m in (1, 5, 40, 500, 1500, 2500, 4000):
        for tail in ("q" * m, "r" * m):
            (own,) = fp.embed([long_ + tail])
            n = len(long_) + m
            assert len(own) == len(fp.places(n, fp.level_of(n))) > 600
            seen.add((m, own.tobytes()))
        # The samples of a higher level are among those of a lower one, for each block.
        for level in range(fp._LEVELS):
            assert np.isin(fp.places(m, level + 1), fp.places(m, level)).all()
    assert len(seen) == 14
