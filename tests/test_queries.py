import duckdb
import pytest

from loamworks.plans import oracle, queries

SF = "/root/testdata/sf0.001"
ALL = queries.queries()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "events", "embeddings", "labels", "conversations", "orders", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ALL))
def test_spark_equals_sql(spark, duck, name):
    df = ALL[name](spark, SF)
    cols = sorted(df.columns)
    found = duck.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(str(tuple(r[names.index(c)] for c in cols)) for r in found.fetchall())
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == want


def test_report_trains_and_encodes_once(spark, monkeypatch):
    calls = []
    for module, name in ((queries.bpe, "counted_merges"), (queries.codec, "encode")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name, **b: calls.append(n) or f(*a, **b))
    queries.report(spark, "/root/testdata/sf0.001").collect()
    assert sorted(calls) == ["counted_merges", "encode"]
