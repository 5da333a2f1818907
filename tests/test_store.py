import os

import pytest

from cdcspark import files
from cdcspark.functions.lsn import OP, SYNC, ZERO_LSN
from cdcspark.sinks.store import Store
from cdcspark.sinks.target import Batch, CommitConflict
from helpers import FEED, TABLE, feed_of, position, random_log, random_target, replay, rows_of


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), buckets=8)


def test_load_read_replace(spark, store):
    first = [(k, f"a{k}") for k in range(100)] + [(None, "n")]
    store.full_load("t", spark.createDataFrame(first, TABLE), position(5))
    assert rows_of(store.read("t")) == sorted(first, key=repr)
    assert {bytes(r[SYNC]) for r in store.read("t").select(SYNC).distinct().collect()} == {position(5)}
    assert store.read("t", with_sync=False).columns == ["k", "v"]
    store.full_load("t", spark.createDataFrame([(1, "b")], TABLE), position(9))
    assert rows_of(store.read("t")) == [(1, "b")] and store.watermark("t") == position(9)
    store.clear("t")
    assert store.read("t").isEmpty() and store.watermark("t") == position(9)
    store.append("t", spark.createDataFrame([(4, "c"), (4, "c")], TABLE))
    assert rows_of(store.read("t")) == [(4, "c"), (4, "c")]
    assert store.current("t").number == 4


def test_load_keeps_declared_keys_and_rules(spark, store):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    declared = StructType([StructField("k", IntegerType(), False), StructField("v", StringType(), False)])
    store.create_if_absent("t", declared, keys=["k", "v"])
    store.full_load("t", spark.createDataFrame([(1, "a")], TABLE), None)
    assert store.current("t").keys == ["k", "v"] and store.current("t").columns == declared
    store.full_load("u", spark.range(3).selectExpr("id k", "'x' v"), None)
    assert all(f.nullable for f in store.current("u").columns)


def test_create_if_absent(spark, store):
    schema = spark.createDataFrame([], TABLE).schema
    assert store.watermark("t") == ZERO_LSN and not store.exists("t")
    assert store.create_if_absent("t", schema, keys=["k"])
    assert not store.create_if_absent("t", schema)
    assert store.read("t").isEmpty() and store.read("t").columns == ["k", "v", SYNC]
    with pytest.raises(LookupError):
        store.read("unknown")


@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
def test_replay_matches_one_by_one(spark, store, mode):
    target = random_target(21, unique=mode != "bag")
    log = random_log(21)
    store.full_load("t", spark.createDataFrame(target, TABLE), ZERO_LSN, keys=["k"])
    early, late = [e for e in log if e[0] <= 150], [e for e in log if e[0] > 150]
    store.replay("t", feed_of(spark, early), position(150), mode=mode)
    store.replay("t", feed_of(spark, late), position(300), mode=mode)
    assert rows_of(store.read("t")) == replay(target, log, mode)


def test_only_touched_buckets_are_rewritten(spark, store):
    store.full_load("t", spark.createDataFrame([(k, "a") for k in range(200)], TABLE), ZERO_LSN, keys=["k"])
    before = store.current("t")
    after = store.replay("t", feed_of(spark, [(1, 4, 7, "b")]), position(1))
    (old,), (new,) = before.folders, [c for c in after.folders if c not in before.folders]
    assert len(after.folders[new]) == 1 and len(after.folders[old]) == len(before.folders[old]) - 1
    assert store.read("t").where("v = 'b'").count() == 1 and store.read("t").count() == 200


def test_emptied_bucket_stays_empty(spark, store):
    store.full_load("t", spark.createDataFrame([(k, "a") for k in range(40)], TABLE), ZERO_LSN, keys=["k"])
    store.replay("t", feed_of(spark, [(n + 1, 1, n, None) for n in range(40)]), position(40))
    assert store.read("t").isEmpty() and store.current("t").folders == {}


def test_a_read_of_a_replicated_table_shuffles_nothing(spark, store):
    target, log = random_target(22), random_log(22, nulls=False)
    store.full_load("t", spark.createDataFrame(target, TABLE), ZERO_LSN, keys=["k"])
    for lo, hi in ((0, 90), (90, 200), (200, 300)):
        store.replay("t", feed_of(spark, [e for e in log if lo < e[0] <= hi]), position(hi))
        assert rows_of(store.read("t")) == replay(target, [e for e in log if e[0] <= hi], "upsert")
    assert "Exchange" not in store.read("t")._jdf.queryExecution().executedPlan().toString()
    some = store.read("t", buckets=[0, 1, 2, 3]).count() + store.read("t", buckets=[4, 5, 6, 7]).count()
    assert some == store.read("t").count()


@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
def test_keys_of_another_width_find_their_rows(spark, store, mode):
    """Buckets are hashed in the table's types, not in the feed's."""
    store.full_load("t", spark.range(50).selectExpr("id as k", "'a' as v"), ZERO_LSN, keys=["k"])
    store.replay("t", feed_of(spark, [(n + 1, 4, n, "b") for n in range(50)]), position(50), mode=mode)
    assert sorted((r.k, r.v) for r in store.read("t").collect()) == [(n, "b") for n in range(50)]
    store.append("t", spark.createDataFrame([(99, "c")], TABLE))
    store.replay("t", feed_of(spark, [(51, 1, 99, None)]), position(51), mode=mode)
    assert store.read("t").count() == 50
    with pytest.raises(Exception, match="a value of k is no bigint"):
        store.append("t", spark.createDataFrame([("x", "c")], "k string, v string"))


def test_rows_are_edited_in_their_bucket(spark, store):
    store.full_load("t", spark.createDataFrame([(k, f"a{k % 2}") for k in range(100)], TABLE), position(3), keys=["k"])
    before = store.current("t")
    after = store.update_rows("t", {"k": 7}, {"v": "z"})
    (new,) = [c for c in after.folders if c not in before.folders]
    assert len(after.folders[new]) == 1 and after.position == position(3)
    assert dict(rows_of(store.read("t")))[7] == "z" and store.read("t").count() == 100
    store.update_rows("t", {"v": "a0"}, {"v": None})
    assert store.read("t").where("v is null").count() == 50
    store.delete_rows("t", {"k": 7})
    store.delete_rows("t", {"k": None})
    assert 7 not in dict(rows_of(store.read("t"))) and store.read("t").count() == 99


def test_crash_before_the_version_file(spark, store, monkeypatch):
    store.full_load("t", spark.createDataFrame([(1, "a")], TABLE), position(1), keys=["k"])
    feed = feed_of(spark, [(2, 4, 1, "b")])

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(files, "create_text", dies)
        with pytest.raises(OSError):
            store.replay("t", feed, position(2))
        with pytest.raises(OSError):
            store.full_load("t", spark.createDataFrame([(9, "z")], TABLE), position(9))
    assert rows_of(store.read("t")) == [(1, "a")] and store.watermark("t") == position(1)
    store.replay("t", feed, position(2))
    assert rows_of(store.read("t")) == [(1, "b")] and store.watermark("t") == position(2)


def test_second_writer_is_refused(spark, store):
    base = store.full_load("t", spark.createDataFrame([(1, "a")], TABLE), position(1), keys=["k"])
    store.replay("t", feed_of(spark, [(2, 4, 1, "b")]), position(2))
    with pytest.raises(CommitConflict):
        store.commit("t", None, position(3), buckets=(), base=base)
    assert rows_of(store.read("t")) == [(1, "b")]


def test_reader_keeps_its_version(spark, store):
    store.full_load("t", spark.createDataFrame([(1, "a")], TABLE), position(1), keys=["k"])
    old = store.read("t")
    store.replay("t", feed_of(spark, [(2, 4, 1, "b")]), position(2))
    assert rows_of(old) == [(1, "a")] and rows_of(store.read("t")) == [(1, "b")]


def test_prune(spark, store):
    store.full_load("t", spark.createDataFrame([(k, "a") for k in range(50)], TABLE), ZERO_LSN, keys=["k"])
    for n in range(1, 4):
        store.full_load("t", spark.createDataFrame([(k, f"b{n}") for k in range(50)], TABLE), position(n))
    store.replay("t", feed_of(spark, [(4, 4, 1, "c")]), position(4))
    assert store.prune("t", hours=1) == 0 and len(store._numbers("t")) == 5
    kept = store.read("t", version=store._version("t", 4))
    assert store.prune("t", keep=2) == 3
    assert store.prune("t", keep=2) == 0
    assert len(os.listdir(f"{store.path}/t/data")) == 2 and store._numbers("t") == [4, 5]
    assert kept.where("v = 'b3'").count() == 50
    got = dict(rows_of(store.read("t")))
    assert got[1] == "c" and got[2] == "b3" and len(got) == 50


def test_large_bucket_is_split_over_files(spark, store):
    """One key holds nearly all rows: adaptive execution writes its bucket with several tasks."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "64kb")
    try:
        rows = spark.range(0, 100_000, 1, 8).selectExpr("cast(if(id % 50 = 0, id, 7) as int) k", "uuid() v")
        store.full_load("t", rows, ZERO_LSN, keys=["k"])
    finally:
        spark.conf.unset(name)
    (commit,) = store.current("t").folders
    sizes = {}
    for folder, _, names in os.walk(f"{store.path}/t/data/__commit={commit}"):
        sizes[os.path.basename(folder)] = len([n for n in names if n.endswith(".parquet")])
    assert max(sizes.values()) > 3
    assert store.read("t").count() == 100_000


def test_rejected_changes_belong_to_the_commit(spark, store, monkeypatch):
    store.full_load("t", spark.createDataFrame([(1, "a")], TABLE), ZERO_LSN, keys=["k"])
    bad = spark.createDataFrame([(4, position(1), 1, "x")], FEED)
    assert store.quarantined("t") is None
    with monkeypatch.context() as m:
        m.setattr(files, "create_text", lambda *_: False)
        with pytest.raises(CommitConflict):
            store.advance("t", position(1), rejected=bad)
    assert store.quarantined("t") is None
    store.advance("t", position(1), rejected=bad, batch=Batch("q", 4, position(0)))
    store.advance("t", position(2), rejected=bad)
    store.full_load("t", spark.createDataFrame([(2, "b")], TABLE), position(3))
    assert store.quarantined("t").where(f"`{OP}` = 4").count() == 2


def test_batches_are_remembered(spark, store):
    store.full_load("t", spark.createDataFrame([(1, "a")], TABLE), ZERO_LSN, keys=["k"])
    assert store.current("t").last_batch("q") is None
    store.advance("t", position(1), batch=Batch("q", 4, position(0)))
    store.advance("t", position(2))
    assert store.current("t").last_batch("q") == Batch("q", 4, position(0))
