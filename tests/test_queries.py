"""Every core query runs; those with SQL agree with it on the smallest test data."""

import glob
import os

import duckdb
import pytest

from qirtas.plans import catalogue, retrieval

DATA = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sql, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name in catalogue.ORACLES:
        found = sql.execute(catalogue.ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in found.fetchall())
        assert got == want


LARGER = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test data")
@pytest.mark.parametrize("name", ["q_merged_topics", "q_merge_plan", "q_apply_merge"])
def test_merges_send_a_vector_once_to_a_block(spark, monkeypatch, name):
    """One block: every vector is sent once, where it reaches into nearly all cells."""
    from pyspark.sql.pandas.group_ops import PandasGroupedOpsMixin

    sent, real = [], PandasGroupedOpsMixin.applyInArrow
    monkeypatch.setattr(PandasGroupedOpsMixin, "applyInArrow", lambda self, *a: (sent.append(self._df.count()), real(self, *a))[1])
    df = catalogue.QUERIES[name](spark, LARGER)
    con = duckdb.connect()
    for f in glob.glob(f"{LARGER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    found = con.execute(catalogue.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(repr([plain(r[c]) for c in names]) for r in df.collect()) == sorted(repr([plain(v) for v in r]) for r in found.fetchall())
    assert sent == [con.execute("SELECT count(DISTINCT embedding) FROM topics WHERE " + retrieval._VALID).fetchone()[0]]
