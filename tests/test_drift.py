"""Changes of structure: what they are, and tables that follow them."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from cdcspark.functions.lsn import LSN, OP
from cdcspark.jobs import TableJob, incremental_sync
from cdcspark.plans.drift import SchemaRefused, column_changes, drift, widened_types
from cdcspark.plans.schema import describe
from cdcspark.sinks.store import Store
from helpers import position


def schema(text) -> StructType:
    return _parse_datatype_string(text)


def test_lattice():
    found = widened_types()
    assert found["tinyint"] == ["smallint", "int", "float", "bigint", "double"] and found["int"] == ["bigint", "double"]
    # Nothing widens into itself, and no two types into each other.
    assert all(k not in v for k, v in found.items())
    assert not any(a in found.get(b, []) for a, into in found.items() for b in into)


@pytest.mark.parametrize(
    "old, new, want",
    [
        ("int", "bigint", "widened"), ("bigint", "int", "narrowed"), ("int", "double", "widened"), ("bigint", "double", "narrowed"),
        ("smallint", "float", "widened"), ("int", "float", "narrowed"), ("date", "timestamp_ntz", "widened"), ("timestamp_ntz", "date", "narrowed"),
        ("decimal(10,2)", "decimal(12,2)", "widened"), ("decimal(10,2)", "decimal(12,4)", "widened"), ("decimal(10,2)", "decimal(11,3)", "widened"),
        ("decimal(10,2)", "decimal(10,3)", "narrowed"), ("decimal(10,2)", "decimal(9,2)", "narrowed"), ("decimal(10,2)", "double", "narrowed"),
        ("int", "decimal(10,0)", "widened"), ("int", "decimal(11,2)", "narrowed"), ("bigint", "decimal(19,0)", "widened"),
        ("double", "string", "widened"), ("binary", "string", "narrowed"), ("string", "int", "narrowed"), ("boolean", "int", "narrowed"),
        ("double", "double", "same"),
    ],
)
def test_verdict_on_types(spark, old, new, want):
    (found,) = column_changes(spark.range(0), schema(f"a {old}"), schema(f"a {new}"))
    assert (found.verdict, found.old, found.new) == (want, old, new)


def test_columns_that_come_and_go(spark):
    found = column_changes(spark.range(0), schema("a int, b int not null, c int, d int"), schema("d int not null, e string, b int, a int"))
    assert [(c.name, c.verdict) for c in found] == [("d", "refuses nulls"), ("e", "added"), ("b", "allows nulls"), ("a", "same"), ("c", "dropped")]


def test_many_tables_at_once(spark):
    def info(rows):
        return spark.createDataFrame(rows, "table string, COLUMN_NAME string, DATA_TYPE string, IS_NULLABLE string")

    old = info([("t", "a", "int", "YES"), ("u", "a", "int", "YES"), ("u", "b", "date", "NO")])
    new = info([("t", "a", "bigint", "YES"), ("u", "a", "int", "NO"), ("u", "c", "float", "YES")])
    assert sorted(tuple(r) for r in drift(old, new, ["table"]).select("table", "column_name", "verdict").collect()) == [
        ("t", "a", "widened"), ("u", "a", "refuses nulls"), ("u", "b", "dropped"), ("u", "c", "added"),
    ]


@pytest.fixture
def store(spark, tmp_path):
    found = Store(spark, str(tmp_path / "store"), buckets=4)
    found.full_load("t", spark.createDataFrame([(i, i * 10, f"n{i}") for i in range(20)], "k int, v int, name string"), position(5), keys=["k"])
    return found


def files_of(store):
    return sorted(store.read("t").inputFiles())


def test_rows_stay_where_they_are(spark, store):
    before = files_of(store)
    store.evolve("t", schema("k int, v double, extra date"))
    assert store.read("t", with_sync=False).dtypes == [("k", "int"), ("v", "double"), ("extra", "date")]
    assert files_of(store) == before and store.watermark("t") == position(5)
    store.append("t", spark.createDataFrame([(50, 0.5, None)], "k int, v double, extra date"))
    store.evolve("t", schema("k int, v string, extra timestamp_ntz"))
    got = sorted(tuple(r) for r in store.read("t", with_sync=False).collect())
    # Cast from what the files hold, not from what they were cast to before.
    assert got == sorted([(i, f"{i * 10}", None) for i in range(20)] + [(50, "0.5", None)])
    assert len(store.current("t").schemas) == 2


def test_a_name_that_comes_again_is_a_new_column(spark, store):
    store.evolve("t", schema("k int, v int"))
    store.append("t", spark.createDataFrame([(50, 1)], "k int, v int"))
    store.evolve("t", schema("k int, v int, name string"))
    assert {r.name for r in store.read("t").collect()} == {None}
    store.append("t", spark.createDataFrame([(51, 1, "now")], "k int, v int, name string"))
    assert {r.name for r in store.read("t").collect()} == {None, "now"}


def test_a_wider_key_moves_rows_to_other_buckets(spark, store):
    before = files_of(store)
    store.evolve("t", schema("k bigint, v int, name string"))
    assert files_of(store) != before and store.current("t").layouts == {}
    feed = spark.createDataFrame([(4, position(6), 3, 0, "x"), (1, position(7), 4, 0, "y")], f"`{OP}` int, `{LSN}` binary, k long, v int, name string")
    store.replay("t", feed, position(7))
    got = {r.k: r.name for r in store.read("t").collect()}
    assert len(got) == 19 and got[3] == "x" and 4 not in got and store.read("t").count() == 19


def test_replays_rewrite_touched_buckets_only(spark, store):
    store.evolve("t", schema("k int, v bigint, name string, w int"))
    feed = spark.createDataFrame([(4, position(6), 3, 2**40, "x", 7)], f"`{OP}` int, `{LSN}` binary, k int, v long, name string, w int")
    store.replay("t", feed, position(6))
    assert set(store.current("t").layouts.values()) == {0}
    rows = {r.k: (r.v, r.name, r.w) for r in store.read("t").collect()}
    assert rows[3] == (2**40, "x", 7) and rows[4] == (40, "n4", None) and len(rows) == 20
    store.full_load("t", store.read("t", with_sync=False), position(6))
    assert store.current("t").layouts == {} and store.read("t").count() == 20


def test_what_would_lose_values_is_refused(spark, store):
    for text in ("k int, v smallint, name string", "v int, name string", "k int, v int, name int"):
        with pytest.raises(SchemaRefused, match="loaded again"):
            store.evolve("t", schema(text))
    number = store.current("t").number
    store.evolve("t", schema("k int not null, v int, name string"))
    # The rows may hold nulls, so the table still allows them; nothing changed.
    assert store.current("t").number == number


def test_a_job_follows_its_source(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    first = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "id int, amount int, old string")
    store.full_load("t", first.select(F.col("id").alias("k"), F.col("amount").alias("v"), F.col("old").alias("o")), position(1), keys=["k"])
    now = {"info": first, "feed": None}
    feed = f"`{OP}` int, `{LSN}` binary, id int, amount {{}}, {{}}"
    job = TableJob(
        "t", store, None, lambda s, p: now["feed"], keys=["k"], columns=[("k", "id"), ("v", "amount"), ("o", "old"), ("n", "new")],
        information_schema=lambda s: describe(now["info"]), on_drift="evolve",
    )
    now["feed"] = spark.createDataFrame([(4, position(2), 1, 5, "c")], feed.format("int", "old string"))
    assert incremental_sync(job).updates == 1
    now["info"] = spark.createDataFrame([], "id int, amount bigint, new date")
    # This feed has neither the dropped column nor, yet, the added one.
    now["feed"] = spark.createDataFrame([(4, position(3), 2, 2**35, "z")], feed.format("bigint", "other string"))
    assert incremental_sync(job).updates == 1
    assert store.read("t", with_sync=False).columns == ["k", "v", "n"]
    assert sorted(tuple(r) for r in store.read("t", with_sync=False).collect()) == [(1, 5, None), (2, 2**35, None)]
    now["info"] = spark.createDataFrame([], "id int, amount string, new int")
    assert "SchemaRefused" in incremental_sync(job, stop_on_error=False).error
    job.information_schema = None
    assert "LookupError" in incremental_sync(job, stop_on_error=False).error
