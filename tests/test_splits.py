"""Every row lies in exactly one range, in Spark and by the statements."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from cdcspark.sources.splits import Splits, boundary_statement, plan_splits, splits_of_bounds
from cdcspark.sources.tables import JdbcSource

ROWS = [None, "", "a", "a'b", "a\\", "B", "b", "é", "zz"]


def table(spark, seed=1, n=400):
    draw = random.Random(seed)
    rows = [
        (
            draw.choice([None, *range(5)]), draw.choice(ROWS), draw.choice([None, Decimal("1.50"), Decimal("-2.25")]),
            draw.choice([None, dt.date(2024, 1, 1), dt.date(2023, 5, 6)]), draw.choice([None, b"\x00", b"\xff\x01"]), i,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "a int, b string, c decimal(10,2), d date, e binary, i int")


def numbers(df, splits):
    """Per row its range by number, by conditions and by statements."""
    by_condition = F.concat_ws(",", *[F.when(splits.condition(i), F.lit(str(i))) for i in range(len(splits))])
    by_text = F.concat_ws(",", *[F.when(F.expr(s), F.lit(str(i))) for i, s in enumerate(splits.statements(dialect="spark"))])
    return [tuple(r) for r in df.select(splits.number_of().cast("string"), by_condition, by_text).collect()]


@pytest.mark.parametrize("keys", [["i"], ["a"], ["b"], ["a", "b"], ["b", "a", "i"], ["c", "d"], ["e", "b"], ["d", "e", "c"]])
def test_each_row_is_in_one_range(spark, keys):
    df = table(spark)
    splits = plan_splits(df, keys, 7)
    found = numbers(df, splits)
    assert len(splits) > 1 and all(a == b == c for a, b, c in found)
    assert {int(a) for a, _, _ in found} == set(range(len(splits)))


def test_ranges_are_about_even(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    splits = plan_splits(df, ["k"], 10)
    sizes = [r["count"] for r in df.groupBy(splits.number_of().alias("n")).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 3_000


def test_few_keys_make_few_ranges(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(2,)] * 3 + [(None,)], "k int")
    splits = plan_splits(df, ["k"], 8)
    assert len(splits) <= 3 and all(a == b == c for a, b, c in numbers(df, splits))
    assert len(plan_splits(df.limit(0), ["k"], 8)) == 1
    assert plan_splits(df.limit(0), ["k"], 8).statements() == ["1 = 1"]
    with pytest.raises(ValueError):
        plan_splits(df, ["k"], 0)


def test_condition_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("v", F.lit("x")).write.parquet(path)
    df = spark.read.parquet(path)
    splits = Splits(("id",), ("bigint",), (("100",), ("500",)))
    part = df.where(splits.condition(1))
    assert "GreaterThanOrEqual(id,100)" in part._jdf.queryExecution().executedPlan().toString()
    assert part.count() == 400


def test_statements_of_dialects():
    splits = Splits(("a", "b"), ("int", "string"), (("3", "x'y"), ("7", None)))
    assert splits.statements(collation="Latin1_General_BIN2") == [
        "([a] IS NULL OR [a] < 3 OR ([a] = 3 AND ([b] COLLATE Latin1_General_BIN2 IS NULL OR [b] COLLATE Latin1_General_BIN2 < N'x''y')))",
        "([a] > 3 OR ([a] = 3 AND [b] COLLATE Latin1_General_BIN2 >= N'x''y')) AND ([a] IS NULL OR [a] < 7)",
        "[a] >= 7",
    ]
    assert Splits(("k",), ("binary",), (("00FF",),)).statements(dialect="standard") == ["(\"k\" IS NULL OR \"k\" < X'00FF')", "\"k\" >= X'00FF'"]


def test_boundaries_of_a_database(spark):
    df = table(spark, 5, 300)
    df.createOrReplaceTempView("bounded")
    text = boundary_statement("bounded", ["a", "i"], 6, dialect="spark")
    splits = splits_of_bounds(spark.sql(text), ["a", "i"])
    assert len(splits) == 6 and all(a == b == c for a, b, c in numbers(df, splits))
    sizes = [r["count"] for r in df.groupBy(splits.number_of().alias("n")).count().collect()]
    assert max(sizes) <= 51
    assert boundary_statement("dbo.t", ["k"], 4) == (
        "SELECT [k] FROM (SELECT [k], ROW_NUMBER() OVER (ORDER BY [k]) AS place, COUNT(*) OVER () AS total FROM dbo.t) numbered "
        "WHERE place > 1 AND (place - 1) * 4 % total < 4"
    )


def test_a_database_scan_has_a_task_per_range(spark, monkeypatch):
    seen = {}

    def jdbc(self, url, table, predicates=None, properties=None):
        seen.update(url=url, table=table, predicates=predicates)
        return spark.range(3)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    splits = Splits(("a", "b"), ("int", "int"), (("3", "1"),))
    source = JdbcSource({"url": "jdbc:x", "user": "u"}, splits={"orders": splits})
    assert source.snapshot(spark, "orders").count() == 3
    assert seen["url"] == "jdbc:x" and seen["table"] == "dbo.orders" and seen["predicates"] == splits.statements()


def test_a_database_plans_its_ranges(spark, monkeypatch):
    from cdcspark.sources import tables

    asked = []

    def read(session, fmt, options, **more):
        asked.append(options["query"])
        return spark.createDataFrame([(5,), (9,)], "k int")

    monkeypatch.setattr(tables, "read_snapshot", read)
    found = JdbcSource({"url": "jdbc:x"}).planned(spark, "orders", ["k"], 3)
    assert found.bounds == (("5",), ("9",)) and asked == [boundary_statement("dbo.orders", ["k"], 3)]


def test_stored_and_read_again():
    splits = Splits(("a", "b"), ("int", "string"), (("3", None), ("4", "x")))
    assert Splits.of(splits.stored()) == splits
