import random

import corpus_pipeline
from loamworks.staging import exists

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_planted_rows(spark, tmp_path):
    r = random.Random(8)
    vocabulary = {x: ["".join(r.choice(a) for _ in range(r.randint(2, 8))) for _ in range(600)] for x, a in (("en", "theandisofw"), ("de", "derunsichtöz"))}
    text = lambda x, n: ". ".join(" ".join(r.choice(vocabulary[x]) for _ in range(12)).capitalize() for _ in range(n)) + "."
    rows = [(i, text(x := r.choice(["en", "de"]), r.randint(4, 14)), x, "s", 1) for i in range(240)]
    junk = [(1000 + i, " ".join(w.upper() + "!!" for w in text("en", r.randint(4, 14)).split()), "en", "s", 1) for i in range(60)]
    labels = [(i, 1, 0) for i in range(240)] + [(1000 + i, 0, 0) for i in range(60)]
    passage = text("en", 6)
    extra = [(2000, rows[3][1], "en", "s", 1), (2001, rows[4][1] + " Extra word.", "en", "s", 1), (2001, rows[4][1] + " Extra word.", "en", "s", 1)]
    extra += [(2002, text("en", 5) + " " + passage, "en", "s", 1), (2003, text("en", 5) + " " + passage, "en", "s", 1)]
    extra += [(2004, None, None, None, None), (2005, "", "en", "s", 0), (2006, "123 456", "en", "s", 7), (None, text("de", 5), None, None, None)]
    spark.createDataFrame(rows + junk + extra, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS.replace(",", "").split()[::2], name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids.append({x.doc_id: x.text for x in docs.collect()})
    clean = set(range(240)) | {2000, 2001, 2002, 2003, None}
    assert not {2004, 2005, 2006} & ids[0].keys() and clean <= ids[0].keys()
    assert not {x[0] for x in junk} & ids[1].keys() and clean <= ids[1].keys()
    assert clean - ids[2].keys() == {2000, 2001} and len(ids[2]) == len(clean) - 2
    assert ids[3].keys() == ids[2].keys()
    assert passage in ids[2][2002] and "\n".join(ids[3].values()).count(passage) == 0
    assert ids[3][7] == rows[7][1]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {x.doc_id for x in packed.collect()} == ids[3].keys()


def test_empty_tables_clashing_columns_and_a_very_long_text(spark, tmp_path):
    """Names that stages use inside are no trouble; a text of a million characters is read whole; no rows give none."""
    more = ", __name string, __nth int, __id long, score string, predicted int, keep string, cid long, sequence_id long"
    r = random.Random(3)
    words = ["".join(r.choice("theandisofw") for _ in range(r.randint(2, 8))) for _ in range(500)]
    text = lambda n: ". ".join(" ".join(r.choice(words) for _ in range(12)).capitalize() for _ in range(n)) + "."
    rows = [(i, text(6), "en", "s", 1) for i in range(40)] + [(50, text(16_000), "en", "s", 1)]
    full = [(*x, "a", 1, 2, "b", 3, "c", 4, 5) for x in rows]
    labels = [(i, 1, 0) for i in range(30)]
    for name, docs, lab in (("none", [], []), ("some", full, labels)):
        at = str(tmp_path / name)
        spark.createDataFrame(docs, COLUMNS + more).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame(lab, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        got = corpus_pipeline.run(spark, at).collect()
        assert {x.doc_id for x in got} == {x[0] for x in docs}
    lengths = [x.length for x in got if x.doc_id == 50]
    assert len(lengths) > 50 and all(n == 4096 for n in sorted(lengths)[1:])


def test_tables_of_former_stages_are_deleted(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(9)], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    paths = []
    real = corpus_pipeline.staged

    def recording(df):
        out = real(df)
        paths.append(out.staged_path)
        return out

    monkeypatch.setattr(corpus_pipeline, "staged", recording)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(k), lambda s, docs, d: docs.filter("doc_id > 0")) for k in range(4)])
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert [exists(spark, p) for p in paths] == [False, False, True] and got.count() == 8
