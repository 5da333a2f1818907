"""Comparing by ranges finds what comparing by key finds, and reads less."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from cdcspark.operators import ranges
from cdcspark.operators.feed import reconcile
from cdcspark.operators.ranges import DatabaseEnd, FrameEnd, portable_hash, reconcile_ends, reconcile_ranges
from cdcspark.sources.splits import Splits

SCHEMA = "a int, b string, v int, w double"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def base(n=600, seed=1):
    draw = random.Random(seed)
    return [(draw.choice([None, *range(20)]), draw.choice([None, "x", "y'", "z"]) , i % 7, i / 4) for i in range(n)]


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_reconcile(spark, seed):
    draw = random.Random(seed)
    rows = base(seed=seed)
    other = list(rows)
    for _ in range({1: 3, 2: 40, 3: 0}[seed]):
        i = draw.randrange(len(other))
        what = draw.random()
        if what < 0.3:
            other.pop(i)
        elif what < 0.6:
            other[i] = (*other[i][:2], 99, None)
        else:
            other.append((draw.choice([None, 5, 77]), "x", 1, 1.0))
    source, target = table(spark, rows), table(spark, other)
    levels = []
    got = reconcile_ranges(source, target, ["a", "b"], parts=8, fanout=3, leaf_rows=20, on_level=levels.append)
    assert shown(got) == shown(reconcile(source, target, ["a", "b"]).where("status <> 'equal'"))
    assert levels[0].rows >= len(rows) and all(x.differing <= x.ranges for x in levels)
    if seed == 3:
        assert levels == [ranges.Level(levels[0].ranges, len(rows), 0, 0)]


def test_only_ranges_that_differ_are_read(spark):
    rows = [(i, "k", i % 5, 0.5) for i in range(20_000)]
    other = [(i, k, -1 if i in (4_321, 4_330) else v, w) for i, k, v, w in rows if i != 4_325]
    source, target = table(spark, rows).cache(), table(spark, other).cache()
    read, levels = [], []

    class Counted(FrameEnd):
        def rows(self, splits, active):
            found = super().rows(splits, active)
            read.append(found.count())
            return found

    hashed = ranges.row_hash(source.columns)
    got = reconcile_ends(
        Counted(source, hashed), Counted(target, hashed), source, ["a"], parts=20, fanout=10, leaf_rows=30, on_level=levels.append
    )
    assert [(r.a, r.status) for r in got.orderBy("a").collect()] == [(4_321, "different"), (4_325, "missing"), (4_330, "different")]
    assert len(levels) == 3 and [x.differing for x in levels][0] == 1 and max(read) < 60
    # A level looks at the ranges of the one before it only.
    assert levels[1].rows == levels[0].differing_rows < 2_500


def test_many_differences_are_not_cut_further(spark):
    rows = base(400)
    levels = []
    got = reconcile_ranges(table(spark, rows), table(spark, [(a, b, v + 1, w) for a, b, v, w in rows]), ["a"], parts=5, leaf_rows=1, on_level=levels.append)
    assert len(levels) == 1 and got.count() == 21


def test_types_of_both_sides_are_brought_together(spark):
    source = spark.range(100).select(F.col("id").alias("k"), F.col("id").cast("int").alias("v"))
    target = spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("v"))
    assert reconcile_ranges(source, target, ["k"], parts=4).isEmpty()
    assert reconcile_ranges(source, target.where("k <> '50'"), ["k"], parts=4).count() == 1


def test_one_side_is_empty(spark):
    full, none = table(spark, base(50)), table(spark, [])
    for a, b, status in ((full, none, "missing"), (none, full, "extra")):
        got = reconcile_ranges(a, b, ["a", "b"], parts=4)
        assert {r.status for r in got.collect()} == {status} and shown(got) == shown(reconcile(a, b, ["a", "b"]))
    assert reconcile_ranges(none, none, ["a"]).isEmpty()


def test_a_database_adds_up_its_own_ranges(spark, monkeypatch):
    rows = [(i, "k'" if i % 3 else None, i % 5, None) for i in range(300)]
    source = table(spark, rows)
    table(spark, [r for r in rows if r[0] != 123]).createOrReplaceTempView("replica")
    asked = []

    def read(session, fmt, options):
        asked.append(options["query"])
        return spark.sql(options["query"])

    def jdbc(self, url, name, predicates=None, properties=None):
        asked.extend(predicates)
        return spark.sql(f"SELECT * FROM {name} WHERE " + " OR ".join(f"({p})" for p in predicates))

    monkeypatch.setattr(ranges, "read_snapshot", read)
    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    columns = ["a", "b", "v"]
    end = DatabaseEnd(spark, {"url": "jdbc:x"}, "replica", columns, dialect="spark")
    here = FrameEnd(source.select(*columns), portable_hash(columns))
    got = reconcile_ends(here, end, source, ["a"], columns=columns, parts=6, leaf_rows=60)
    assert [tuple(r) for r in got.collect()] == [(123, 1, 0, "missing")]
    assert sum(q.startswith("SELECT number, COUNT(*)") for q in asked) == 1 and len(asked) == 2


def test_statements_of_databases():
    splits = Splits(("k",), ("int",), (("5",),))
    end = DatabaseEnd(None, {}, "dbo.t", ["k", "d"], texts={"d": "CONVERT(VARCHAR(10), [d], 23)"})
    assert end.checksum_statement(splits, [1, 0]) == (
        "SELECT number, COUNT(*) AS n, SUM(hash) AS total FROM (SELECT CASE WHEN ([k] IS NULL OR [k] < 5) THEN 0 WHEN [k] >= 5 THEN 1 END AS number, "
        "CAST(CONVERT(BIGINT, SUBSTRING(HASHBYTES('MD5', CONCAT(COALESCE('=' + CONVERT(VARCHAR(MAX), [k]), '-'), '|', "
        "COALESCE('=' + CONVERT(VARCHAR(10), [d], 23), '-'))), 1, 8)) / 16 & 0xFFFFFFFFFFFFFFF AS DECIMAL(38, 0)) AS hash FROM dbo.t) hashed "
        "WHERE number IS NOT NULL GROUP BY number"
    )
    mysql = DatabaseEnd(None, {}, "t", ["k"], dialect="mysql").hashed()
    assert mysql == "CAST(CONV(SUBSTRING(MD5(COALESCE(CONCAT('=', CAST(`k` AS CHAR)), '-')), 1, 15), 16, 10) AS DECIMAL(38, 0))"
