"""Every catalogued query against its SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from driftscan import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def plain(d: pd.DataFrame) -> list:
    d = d[sorted(d.columns)]
    rows = [tuple("" if v is None or v is pd.NaT or v != v else round(float(v), 5) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in d.itertuples(index=False)]
    return sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    got, want = catalog.QUERIES[name](spark, sf).toPandas(), con.execute(catalog.ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", ["archive_scan", "archive_sample"])
def test_documents_of_one_archive_and_name(spark, tmp_path, name):
    """Numbers that are alike in all from which archives and names are made, the last first."""
    at = [(1 + k + 44_400 * again, f"text {k} {again}", "en") for again in (2, 1, 0) for k in range(30)]
    spark.createDataFrame(at, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert plain(catalog.QUERIES[name](spark, str(tmp_path)).toPandas()) == plain(c.execute(catalog.ORACLES[name]).fetchdf())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
