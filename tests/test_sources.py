import pytest

from cdcspark.functions.lsn import LSN, OP, SYNC, ZERO_LSN, lsn_from_number, lsn_hex, pad_lsn, to_lsn
from cdcspark.sources.changes import (
    changes_between,
    changes_since,
    jdbc_changes_options,
    last_sync,
    max_lsn,
    min_lsn,
    resolve_capture_instance,
    resolve_change_table,
    with_change_tables,
)
from cdcspark.sources.snapshot import read_snapshot
from helpers import feed_of, position
from pyspark.sql import functions as F


def numbers(df):
    return sorted(int.from_bytes(r[LSN], "big") for r in df.collect())


def test_positions(spark):
    assert pad_lsn(None) == ZERO_LSN and pad_lsn(b"\x05") == position(5)
    with pytest.raises(ValueError):
        pad_lsn(bytes(11))
    row = spark.createDataFrame([(b"\x01\x02", bytes(11))], "a binary, b binary").select(
        to_lsn(F.col("a")).alias("a"), to_lsn(F.col("b")).alias("b"), lsn_hex(F.col("a")).alias("h"),
        lsn_from_number(F.lit(258)).alias("n"),
    ).first()
    assert bytes(row.a) == position(258) == bytes(row.n) and row.b is None and row.h == "0x0102"


def test_ranges(spark):
    feed = feed_of(spark, [(n, 4, 1, "v") for n in (1, 127, 128, 255, 256, 70000)])
    assert numbers(changes_since(feed, position(128))) == [255, 256, 70000]
    assert numbers(changes_since(feed, b"\x80")) == [255, 256, 70000]
    assert numbers(changes_since(feed, None, upto=position(255))) == [1, 127, 128, 255]
    assert numbers(changes_between(feed, position(127), position(256))) == [127, 128, 255, 256]
    assert changes_between(feed, None, None).isEmpty()
    assert (min_lsn(feed), max_lsn(feed)) == (position(1), position(70000))
    assert max_lsn(feed.limit(0)) is None


def test_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "feed")
    feed_of(spark, [(n, 4, 1, "v") for n in range(9)]).write.parquet(path)
    plan = changes_since(spark.read.parquet(path).select(OP, LSN, "k"), position(4))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan(`{LSN}`" in text and "v:string" not in text
    assert plan.count() == 4


def test_last_sync(spark):
    plain = spark.createDataFrame([(1,)], "k int")
    assert last_sync(plain) == ZERO_LSN
    stamped = spark.createDataFrame([(1, position(3)), (2, None)], f"k int, `{SYNC}` binary")
    assert last_sync(stamped) == position(3)
    assert last_sync(stamped.limit(0)) == ZERO_LSN


def test_change_table_names(spark):
    catalog = spark.createDataFrame(
        [("dbo_orders", "dbo", "orders"), ("custom", "sales", "items")],
        "capture_instance string, source_schema string, source_table string",
    )
    assert resolve_change_table(catalog, "orders") == "dbo_orders_CT"
    assert resolve_change_table(catalog, "items") is None
    assert resolve_capture_instance(catalog, "sales", "items") == "custom"
    assert resolve_capture_instance(catalog, "dbo", "items") is None
    tables = spark.createDataFrame([("orders",), ("items",)], "table_name string")
    got = {r.table_name: r.change_table for r in with_change_tables(tables, catalog).collect()}
    assert got == {"orders": "dbo_orders_CT", "items": None}


def test_snapshot_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    for fmt in ("parquet", "orc", "json"):
        path = str(tmp_path / fmt)
        df.write.format(fmt).save(path)
        got = read_snapshot(spark, fmt, {"path": path}, columns=["k", "v"])
        assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, None)]
    path = str(tmp_path / "csv")
    df.write.option("header", True).csv(path)
    got = read_snapshot(spark, "csv", {"path": path, "header": "true"}, columns=["k"])
    assert got.columns == ["k"] and got.count() == 2
    df.createOrReplaceTempView("snap")
    assert read_snapshot(spark, "table", {"name": "snap"}, columns=["v"]).columns == ["v"]


def test_partitioning_is_for_jdbc(spark):
    with pytest.raises(ValueError):
        read_snapshot(spark, "parquet", {"path": "x"}, partitioning={"partitionColumn": "k"})
    with pytest.raises(ValueError, match="needs"):
        read_snapshot(spark, "jdbc", {"url": "jdbc:none"}, partitioning={"partitionColumn": "k"})


def test_jdbc_change_statement():
    got = jdbc_changes_options(
        {"url": "u"}, "cdc.dbo_t_CT", ["id", "v"], b"\x01", upto=position(258), sequence=True,
        partitioning={"partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3},
    )
    assert got["dbtable"] == (
        "(SELECT [__$operation], [__$start_lsn], [__$seqval], [id], [v] FROM cdc.dbo_t_CT "
        "WHERE [__$start_lsn] > 0x00000000000000000001 AND [__$start_lsn] <= 0x00000000000000000102) changes"
    )
    assert got["numPartitions"] == "3" and got["url"] == "u"
    plain = jdbc_changes_options({}, "feed", ["id"], None, dialect="standard")["dbtable"]
    assert plain.endswith("WHERE \"__$start_lsn\" > X'00000000000000000000') changes")
