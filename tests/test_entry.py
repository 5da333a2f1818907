"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

duckdb = pytest.importorskip("duckdb")

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
OWN = entry._own_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{name}')")
    return connection


def test_every_query_has_sql():
    assert set(OWN) == set(entry.base_sql()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_shared_folder_has_to_be_named(spark, monkeypatch):
    from cdcspark import session

    class Bare:
        class conf:
            @staticmethod
            def get(name, default):
                return default

        sparkContext = spark.sparkContext

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Bare)
    monkeypatch.setitem(session._chosen, spark.sparkContext.applicationId, "/some/where/")
    assert session.shared_dir(Bare) == "/some/where"


def test_entry_returns_rows(spark):
    assert entry.entry(spark).columns == ["k", "v"] and entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, db, name):
    got = entry.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert len(db.execute(entry.oracle_sql()[name]).description) == len(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr)
