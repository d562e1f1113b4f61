import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamworks.llm import langid, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string"


def segmentations(word, known):
    if not word:
        yield 1.0
    for i in range(1, len(word) + 1):
        if word[:i] in known:
            for p in segmentations(word[i:], known):
                yield known[word[:i]] * p


def test_forward_sums_all_segmentations(monkeypatch):
    names = [langid.START, langid.START + "a", "a", "b", "ab", "ba", "aba"]
    known = {p: i for i, p in enumerate(names)}
    prob = np.random.default_rng(1).random((len(names), 2)) / 3
    monkeypatch.setattr(langid, "pieces", lambda path: known)
    m = langid.Model(["x", "y"], np.log(prob), "")
    m._start()
    for n in range(1, 6):
        for w in map("".join, itertools.product("ab", repeat=n)):
            for k in (0, 1):
                whole = sum(segmentations(langid.START + w, {p: prob[i, k] for p, i in known.items()}))
                assert math.isclose(m.word(w)[k], math.log(whole), rel_tol=1e-9)
                assert math.isclose(m._long(w)[k], math.log(whole), rel_tol=1e-9)
            uses = dict.fromkeys(range(len(names)), 0.0)
            for p, v in langid._expected(w, prob[:, 0].tolist(), known, 4):
                uses[p] += v
            assert math.isclose(sum(v * len(names[p]) for p, v in uses.items()), n + 1, rel_tol=1e-9)


def words(lang, n, r):
    own = {"en": ["the", "and", "thing", "with", "there"], "de": ["der", "und", "nicht", "mit", "schön"]}[lang]
    return " ".join(r.choice(own) for _ in range(n))


def test_languages(spark):
    r = random.Random(2)
    rows = [(i, words(x, 12, r), x, "s", 1, "", "") for i in range(60) for x in ("en", "de")]
    rows += [(500, None, "en", "", 0, "", ""), (501, "", None, "", 0, "", ""), (502, "12 !? 3", "de", "", 0, "", "")]
    rows += [(None, words("de", 9, r), None, "", 0, "", ""), (503, "und" * 4000, None, "", 0, "", "")]
    df = spark.createDataFrame(rows, DOCS)
    got = langid.predict(df, langid.fit(langid.training(df)), keep=("lang",)).collect()
    assert len(got) == len(rows)
    for g in got:
        assert 0 <= g.score <= 1
        if g.doc_id in (500, 501, 502):
            assert (g.lang_pred, g.score) == ("und", 0.0)
        elif g.doc_id is not None and g.doc_id < 100:
            assert g.lang_pred == g.lang
    none = langid.predict(df, langid.fit(df.limit(0)))
    assert {x.lang_pred for x in none.collect()} == {"und"}
    assert langid.predict(df.limit(0), langid.fit(df.limit(0))).count() == 0


def test_density_difference_is_that_of_the_formula():
    rng = np.random.default_rng(3)
    d = len(quality.NAMES)
    x = [rng.normal(size=(200, d)), rng.normal(size=(300, d)) * 1.5 + 1]
    n = np.array([200.0, 300.0])
    m = quality.Model(n, np.stack([a.sum(0) for a in x]), np.stack([a.T @ a for a in x]))
    at = rng.normal(size=(5, d))
    logs = []
    cov = [np.cov(a.T, bias=True) for a in x]
    pooled = (cov[0] * 200 + cov[1] * 300) / 500
    s = 1 / np.sqrt(np.diag(pooled))
    for k in (0, 1):
        own = np.outer(s, s) * ((1 - quality.POOLED - quality.IDENTITY) * cov[k] + quality.POOLED * pooled) + quality.IDENTITY * np.eye(d)
        z = at * s - x[k].mean(0) * s
        logs.append(np.log(n[k] / 500) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(own), z))
    assert np.allclose(m.score(at), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_quality(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(200):
        good = i % 3 > 0
        t = words("en", 40, r) + "." if good else " ".join(f"X{r.randrange(99)}$$$" for _ in range(40))
        rows.append((i, t, "en", "s", 1, "", ""))
        labels.append((i, int(good), 0))
    labels += [(5000, None, 0), (None, 1, 0)]
    rows += [(900, None, None, None, None, "", ""), (901, "", "", "", 0, "", ""), (902, "A" * 200_000, "", "", 0, "", "")]
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {g.doc_id: g for g in quality.predict(df, quality.fit(df, quality.training(lab))).collect()}
    assert len(got) == len(rows) and all(0 <= g.score <= 1 for g in got.values())
    assert sum(got[i].predicted == (i % 3 > 0) for i in range(200)) >= 198
    assert got[900].score == got[901].score
    assert {g.score for g in quality.predict(df, quality.fit(df, lab.limit(0))).collect()} == {0.5}
    assert quality.predict(df.limit(0), quality.fit(df, lab)).count() == 0


@pytest.mark.parametrize("text", ["", " ", "\n\n", "a", "🎉"])
def test_statistics_of_tiny_texts(text):
    assert np.isfinite(quality.statistics(text)).all()


def test_language_without_spaces(spark):
    r = random.Random(4)
    own = {"aa": "eta", "zz": "ohi"}
    text = lambda x: "".join(r.choice(own[x]) for _ in range(300))
    rows = [(i, text(x), x, "s", 1, "", "") for i in range(20) for x in own]
    df = spark.createDataFrame(rows, DOCS)
    model = langid.fit(df)
    assert [model.predict(text(x))[0] for x in ("aa", "zz", "aa", "zz")] == ["aa", "zz", "aa", "zz"]


def test_words_whose_product_underflows(monkeypatch):
    known = {langid.START: 0, "a": 1, "b": 2}
    prob = np.array([[0.5, 0.5], [0.1, 0.2], [0.4, 0.3]])
    monkeypatch.setattr(langid, "pieces", lambda path: known)
    m = langid.Model(["x", "y"], np.log(prob), "")
    m._start()
    for word in ("~" * 60 + "a" * 30, "~" * 41 + "a" * 3, "~" * 94 + "b", "ab~"):
        for k in (0, 1):
            whole = sum(math.log(prob[known[c], k]) if c in known else math.log(langid.UNKNOWN) for c in langid.START + word)
            assert math.isclose(m.forward(["ab", word])[1][k], whole, rel_tol=1e-9)
    assert m.predict("~" * 60 + "a" * 30)[0] == "y"


def test_a_long_word_is_read_place_by_place():
    names = [langid.START, langid.START + "a", "a", "b", "ab", "ba", "aba"]
    known = {p: i for i, p in enumerate(names)}
    r = random.Random(6)
    word = "".join(r.choice("ab~") for _ in range(langid.LONG + 50))
    whole, at = langid.lattice(word, known, 3), langid._ends(word, known, 3)
    assert [at(j) for j in range(1, len(word) + 2)] == whole[1:]


def test_words_are_learnt_as_they_are_cut_for_scoring(spark):
    """No-break and ideographic blanks, and control characters that Python takes for white space."""
    text = "one\u00a0two\u3000three\x1cfour five\x85six\u2003seven"
    found = spark.createDataFrame([(text,)], "text string").select(F.explode(F.split(F.lower("text"), langid.WHITE)).alias("w"))
    assert [r.w for r in found.collect()] == langid.words_of(text)


def test_more_labels_than_the_sample_are_joined_by_a_shuffle(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"word {i} " * (i % 5 + 1) + "!" * (i % 3)) for i in range(60)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    want = {r.doc_id: r.score for r in quality.predict(df, quality.fit(df, lab)).collect()}
    counted = quality.fit(df, lab.union(lab).union(lab))
    monkeypatch.setattr(quality, "MOST_BROADCAST", 0)
    shuffled = quality.fit(df, lab)
    for model in (counted, shuffled):
        assert want == pytest.approx({r.doc_id: r.score for r in quality.predict(df, model).collect()})
