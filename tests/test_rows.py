import pytest

from cdcspark.functions.lsn import LSN, OP
from cdcspark.operators.quarantine import REASON, quarantine_split, with_reason
from cdcspark.operators.rows import delete_by_key, sample_one, thin_rows, update_by_key
from helpers import position
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

ROWS = [(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (2, 1, None)]


def table(spark):
    return spark.createDataFrame(ROWS, "a int, b int, v string")


def test_update_by_composite_key(spark):
    got = update_by_key(table(spark), {"a": 1, "b": 2}, {"v": "new"})
    assert [tuple(r) for r in got.collect()] == [(1, 1, "a"), (1, 2, "new"), (None, 1, "c"), (2, 1, None)]
    assert update_by_key(table(spark), {"a": None}, {"v": "x"}).where("v = 'x'").isEmpty()
    cleared = update_by_key(table(spark), {"a": 1, "b": 1}, {"v": None})
    assert cleared.where("a = 1 and b = 1").first().v is None
    with pytest.raises(ValueError):
        update_by_key(table(spark), {"a": 1}, {"nope": 1})


def test_delete_by_composite_key(spark):
    left = delete_by_key(table(spark), {"a": 1, "b": 2})
    assert [tuple(r) for r in left.collect()] == [ROWS[0], ROWS[2], ROWS[3]]
    assert delete_by_key(table(spark), {"a": None}).count() == 4
    with pytest.raises(ValueError):
        delete_by_key(table(spark), {})


def test_thinning(spark):
    many = spark.range(10_000)
    assert thin_rows(many, 0, seed=1).count() == 10_000 and thin_rows(many, 100, seed=1).count() == 0
    assert 6_700 < thin_rows(many, 30, seed=1).count() < 7_300
    assert 6_800 < thin_rows(many, 30, by="id").count() < 7_200
    # The draw does not hang on the last digits of a key.
    hundreds = spark.range(0, 100_000, 100)
    assert 970 < thin_rows(hundreds, 1, by="id").count() < 1_000
    assert sorted(map(tuple, thin_rows(many, 30, by="id").collect())) == sorted(map(tuple, thin_rows(many.repartition(7), 30, by="id").collect()))
    assert thin_rows(many.selectExpr("if(id < 9000, null, cast(id as string)) s"), 0, by="s").count() == 10_000
    with pytest.raises(ValueError):
        thin_rows(many, 101)


def test_one_row(spark):
    many = spark.range(1000)
    assert sample_one(many, seed=3).count() == 1
    assert sample_one(many.limit(0)).count() == 0
    assert len({sample_one(many, seed=s).first().id for s in range(5)}) > 1
    assert "TakeOrderedAndProject" in sample_one(many)._jdf.queryExecution().executedPlan().toString()


def test_quarantine(spark):
    wanted = StructType([
        StructField("k", IntegerType()), StructField("v", DoubleType()), StructField("w", StringType(), False),
    ])
    feed = spark.createDataFrame(
        [
            (2, position(1), "1", "1.5", "w"),
            (9, position(2), "1", "1.5", "w"),
            (None, position(3), "1", "1.5", "w"),
            (4, b"\x01", "1", "1.5", "w"),
            (4, None, "1", "1.5", "w"),
            (4, position(6), None, "1.5", "w"),
            (4, position(7), "x", "1.5", "w"),
            (1, position(8), "1", "much", None),
            (4, position(8), "1", "much", "w"),
            (4, position(9), "1", None, "w"),
            (4, position(10), "1", "2", None),
        ],
        f"`{OP}` int, `{LSN}` binary, k string, v string, w string",
    )
    good, bad = quarantine_split(feed, wanted, ["k"])
    assert [(r.k, r.v) for r in good.collect()] == [(1, 1.5), (1, None), (1, None)]
    assert dict(good.dtypes)["v"] == "double" and dict(bad.dtypes)["v"] == "string"
    assert [r[REASON] for r in bad.collect()] == [
        "unknown operation", "unknown operation", "bad log position", "bad log position", "null key k",
        "k is not int", "v is not double", "w may not be null",
    ]
    lenient = with_reason(feed, wanted, ["k"], other_ops="ignore")
    assert lenient.where(f"`{REASON}` is null").count() == 5
    assert with_reason(feed, wanted, ["k"], null_keys="ignore").where(f"`{REASON}` is null").count() == 4
