import pytest

from cdcspark.functions.lsn import LSN, OP, SEQ, ZERO_LSN
from cdcspark.operators import skew
from cdcspark.operators.apply import (
    apply_changes,
    expand_key_changes,
    last_changes,
    merge_last,
    new_watermark,
    watermark_after,
)
from cdcspark.operators.feed import net_changes
from helpers import FEED, TABLE, feed_of, position, random_log, random_target, replay, rows_of


@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_one_by_one(spark, mode, seed):
    target = random_target(seed, unique=mode != "bag")
    log = random_log(seed)
    got = apply_changes(spark.createDataFrame(target, TABLE), feed_of(spark, log), keys=["k"], mode=mode)
    assert rows_of(got) == replay(target, log, mode)


@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
def test_hot_key_split_keeps_result(spark, mode, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    target = random_target(9, unique=mode != "bag")
    log = random_log(9)
    table, feed = spark.createDataFrame(target, TABLE), feed_of(spark, log)
    hot = skew.hot_keys(feed.where("k is not null"), ["k"], share=0.1, min_rows=5)
    assert len(hot) == 1
    got = apply_changes(table, feed, keys=["k"], mode=mode, hot=hot)
    assert rows_of(got) == replay(target, log, mode)
    if mode != "upsert":
        # Found without being told: the plan gets a second, broadcast branch.
        found = apply_changes(table, feed, keys=["k"], mode=mode)
        assert "isin" in found._jdf.queryExecution().analyzed().toString().lower().replace(" in (", " isin (")
        assert rows_of(found) == replay(target, log, mode)


@pytest.mark.parametrize("keys", [["k"], None])
@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
def test_a_feed_of_another_width_meets_the_same_keys(spark, mode, keys):
    """The target's keys are wider than the feed's, and some of them are split off as hot."""
    target, log = random_target(9, unique=mode != "bag"), random_log(9)
    table = spark.createDataFrame(target, "k long, v string")
    hot = [r[0] for r in table.where("k in (7, 8)").select(skew.key_hash(["k"])).distinct().collect()]
    for split in (hot, []):
        got = apply_changes(table, feed_of(spark, log), keys=keys, mode=mode, hot=split)
        assert rows_of(got) == replay(target, log, mode)


def test_a_value_that_does_not_fit_raises(spark):
    table = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(Exception, match="a value of v is no int"):
        apply_changes(table, feed_of(spark, [(1, 4, 1, "x")]), keys=["k"]).collect()


@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
def test_empty_sides(spark, mode):
    target, log = random_target(4), random_log(4)
    empty_table, empty_feed = spark.createDataFrame([], TABLE), spark.createDataFrame([], FEED)
    assert rows_of(apply_changes(empty_table, feed_of(spark, log), keys=["k"], mode=mode)) == replay([], log, mode)
    same = apply_changes(spark.createDataFrame(target, TABLE), empty_feed, keys=["k"], mode=mode)
    assert rows_of(same) == sorted(target, key=repr)


def test_upsert_twice_is_once_and_split_is_whole(spark):
    target, log = random_target(5), random_log(5, nulls=False)
    table, feed = spark.createDataFrame(target, TABLE), feed_of(spark, log)
    once = apply_changes(table, feed, keys=["k"])
    assert rows_of(apply_changes(once, feed, keys=["k"])) == rows_of(once)
    for cut in (1, 77, 300):
        early = feed_of(spark, [e for e in log if e[0] <= cut])
        late = spark.createDataFrame([(o, position(n), k, v) for n, o, k, v in log if n > cut], FEED)
        assert rows_of(apply_changes(apply_changes(table, early, keys=["k"]), late, keys=["k"])) == rows_of(once)


def test_composite_key_and_first_column_key(spark):
    table = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "a int, b int, v string")
    feed = spark.createDataFrame(
        [(4, position(1), 1, 2, "B"), (1, position(2), 2, 1, None), (2, position(3), 3, 3, "n")],
        f"`{OP}` int, `{LSN}` binary, a int, b int, v string",
    )
    for mode in ("upsert", "strict", "bag"):
        got = apply_changes(table, feed, keys=["a", "b"], mode=mode)
        assert sorted(map(tuple, got.collect())) == [(1, 1, "a"), (1, 2, "B"), (3, 3, "n")]
    first = apply_changes(table, feed, mode="bag")
    assert sorted(map(tuple, first.collect())) == [(1, 2, "B"), (1, 2, "B"), (3, 3, "n")]


def test_key_only_table(spark):
    table = spark.createDataFrame([(1,), (2,)], "k int")
    feed = spark.createDataFrame([(1, position(1), 1), (2, position(2), 5)], f"`{OP}` int, `{LSN}` binary, k int")
    for mode in ("upsert", "strict", "bag"):
        assert sorted(r[0] for r in apply_changes(table, feed, keys=["k"], mode=mode).collect()) == [2, 5]


def test_ties_need_a_sequence(spark):
    table = spark.createDataFrame([(1, "a")], TABLE)
    rows = [(4, position(1), 1, "x", 1), (4, position(1), 1, "y", 2)]
    feed = spark.createDataFrame(rows, f"{FEED}, `{SEQ}` int")
    for mode in ("upsert", "strict", "bag"):
        assert rows_of(apply_changes(table, feed, keys=["k"], mode=mode)) == [(1, "y")]
        with pytest.raises(Exception, match="share a log position"):
            apply_changes(table, feed.drop(SEQ), keys=["k"], mode=mode).collect()
    with pytest.raises(Exception, match="share a log position"):
        net_changes(feed.drop(SEQ), ["k"]).collect()
    repeated = feed.drop(SEQ).where("v = 'x'")
    assert rows_of(apply_changes(table, repeated.union(repeated), keys=["k"])) == [(1, "x")]


def test_insert_and_delete_at_one_position_are_ambiguous(spark):
    feed = feed_of(spark, [(1, 1, 1, "a"), (1, 2, 1, "b")])
    table = spark.createDataFrame([(1, "a")], TABLE)
    for mode in ("upsert", "strict", "bag"):
        with pytest.raises(Exception, match="share a log position"):
            apply_changes(table, feed, keys=["k"], mode=mode).collect()
        got = apply_changes(table, feed, keys=["k"], mode=mode, order_by=[LSN, OP])
        assert rows_of(got) == [(1, "b")]


def test_null_update_value_is_kept(spark):
    table = spark.createDataFrame([(1, "a")], TABLE)
    for mode in ("upsert", "strict", "bag"):
        feed = feed_of(spark, [(1, 4, 1, "x"), (2, 4, 1, None)])
        assert rows_of(apply_changes(table, feed, keys=["k"], mode=mode)) == [(1, None)]


def test_key_change_moves_the_row(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], TABLE)
    feed = spark.createDataFrame(
        [(4, position(1), 9, "a9", 1), (4, position(2), 2, "b2", 2), (1, position(3), 9, "a9", None)],
        f"{FEED}, old_k int",
    )
    moved = expand_key_changes(feed, ["k"], {"k": "old_k"})
    assert moved.count() == 4
    for mode in ("upsert", "strict", "bag"):
        before_delete = moved.where(f"`{LSN}` <= X'{position(2).hex()}'")
        assert rows_of(apply_changes(table, before_delete, keys=["k"], mode=mode)) == [(2, "b2"), (9, "a9")]
        assert rows_of(apply_changes(table, moved, keys=["k"], mode=mode)) == [(2, "b2")]


def test_net_changes_have_the_same_effect(spark):
    for seed in (11, 12):
        target = random_target(seed)
        present = {k for k, _ in target}
        log, alive = [], set(present)
        for n, op, k, v in sorted(random_log(seed, nulls=False)):
            if op == 2 and k not in alive:
                alive.add(k)
            elif op == 1 and k in alive:
                alive.remove(k)
            elif op != 4 or k not in alive:
                continue
            log.append((n, op, k, v))
        feed = feed_of(spark, log)
        net = net_changes(feed, ["k"])
        assert net.count() == net.select("k").distinct().count()
        table = spark.createDataFrame(target, TABLE)
        assert rows_of(apply_changes(table, net, keys=["k"], mode="strict")) == replay(target, log, "strict")
        assert {(r["k"], r[OP]) for r in net.collect()} == {
            (k, 1 if k not in alive else 4 if k in present else 2)
            for k in {e[2] for e in log}
            if k in alive or k in present
        }


def test_watermark(spark):
    feed = feed_of(spark, [(3, 2, 1, "a"), (300, 3, 1, "a")])
    assert new_watermark(feed, None) == position(300)
    assert new_watermark(feed, position(70000)) == position(70000)
    assert new_watermark(feed.limit(0), None) == ZERO_LSN
    assert bytes(watermark_after(feed, b"\x01").first()[0]) == position(300)


def test_upsert_plan_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("cast(id as int) k", "cast(id as string) v").write.parquet(path)
    spark.createDataFrame([(4, position(1), 5, "x")], FEED).write.parquet(str(tmp_path / "f"))
    plan = apply_changes(
        spark.read.parquet(path), spark.read.parquet(str(tmp_path / "f")), keys=["k"]
    )._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hot_rows_leave_the_shuffle(spark):
    """A third of the target has one key: those rows meet a broadcast of one row, in place."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(3000).selectExpr("cast(if(id % 3 = 0, -1, id) as int) k", "'t' v")
        feed = feed_of(spark, [(n, 4, n % 40 - 1, f"v{n}") for n in range(1, 100)])
        hot = skew.hot_keys(target, ["k"], share=0.1, min_rows=100)
        assert len(hot) == 1
        got = apply_changes(target, feed, keys=["k"], mode="bag", hot=hot)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
        assert got.where("k = -1 and v = 'v80'").count() == 1000 and got.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_adaptive_execution_splits_a_hot_target_key(spark, tmp_path):
    """Where the last changes are a written table, as in the store, its keys need not be unique in the target."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        target = spark.range(0, 120_000, 1, 8).selectExpr("cast(if(id % 3 = 0, -1, id) as int) k", "uuid() v")
        feed = feed_of(spark, [(n, 1, n, None) for n in range(1, 100)])
        last_changes(feed, ["k"], columns=["k", "v"]).write.parquet(str(tmp_path / "last"))
        got = merge_last(target, spark.read.parquet(str(tmp_path / "last")), ["k"])
        rows = got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == 120_000 - 66
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
