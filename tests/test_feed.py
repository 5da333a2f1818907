import pytest

from cdcspark.functions.lsn import LSN, OP, SYNC
from cdcspark.operators.apply import apply_changes
from cdcspark.operators.feed import (
    capture_changes,
    change_counts,
    change_report,
    net_changes,
    pair_status,
    reconcile,
    reconcile_counts,
    stamped,
)
from cdcspark.sources.changes import lsn_range
from helpers import TABLE, feed_of, position, rows_of
from pyspark.sql import functions as F


def test_counts_and_report(spark):
    feed = feed_of(spark, [(5, 2, 1, "a"), (6, 4, 1, "b"), (9, 4, 2, "c"), (7, 3, 1, "x")])
    assert {tuple(r) for r in change_counts(feed).collect()} == {(2, 1), (4, 2), (3, 1)}
    report = change_report(feed).first()
    assert (report.changes, report.inserts, report.updates, report.deletes) == (4, 1, 2, 0)
    assert (bytes(report.min_lsn), bytes(report.max_lsn)) == (position(5), position(9))
    empty = lsn_range(feed.limit(0)).first()
    assert empty.min_lsn is None and empty.max_lsn is None


def test_net_changes_cases(spark):
    feed = feed_of(spark, [
        (1, 2, 1, "a"), (2, 1, 1, None),                    # came and went
        (3, 2, 2, "b"), (4, 4, 2, "bb"),                    # new, changed since
        (5, 1, 3, None), (6, 2, 3, "c"),                    # replaced
        (7, 4, 4, "d"), (8, 1, 4, "gone"),                  # went
        (9, 4, 5, "e"), (10, 4, 5, None),                   # changed twice, last to null
        (11, 2, None, "n"), (12, 3, 6, "other"),            # an insert without key passes, other codes have no effect
        (13, 4, None, "m"), (14, 1, None, None),            # no key, nothing to change
    ])
    got = {(r[OP], r["k"], r["v"], bytes(r[LSN])) for r in net_changes(feed, ["k"]).collect()}
    assert got == {
        (2, 2, "bb", position(4)), (4, 3, "c", position(6)), (1, 4, "gone", position(8)), (4, 5, None, position(10)),
        (2, None, "n", position(11)),
    }


def test_reconcile_statuses_with_nulls_and_repeats(spark):
    source = spark.createDataFrame(
        [(1, "a"), (2, None), (3, "c"), (4, "x"), (4, "x"), (5, "p"), (5, "q"), (None, "z"), (7, "m")], TABLE
    )
    target = spark.createDataFrame(
        [(1, "a"), (2, "b"), (4, "x"), (4, "y"), (5, "q"), (5, "p"), (None, "z"), (8, "w"), (7, "m"), (7, "m")], TABLE
    )
    got = {r.k: (r.source_rows, r.target_rows, r.status) for r in reconcile(source, target, ["k"]).collect()}
    assert got == {
        1: (1, 1, "equal"), 2: (1, 1, "different"), 3: (1, 0, "missing"), 4: (2, 2, "different"),
        5: (2, 2, "equal"), None: (1, 1, "equal"), 8: (0, 1, "extra"), 7: (1, 2, "different"),
    }
    counts = {r.status: r.n_keys for r in reconcile_counts(reconcile(source, target, ["k"])).collect()}
    assert counts == {"equal": 3, "different": 3, "missing": 1, "extra": 1}
    whole = {r.status: r.n_keys for r in reconcile_counts(reconcile(source, target)).collect()}
    assert whole == {"equal": 4, "different": 2, "missing": 2, "extra": 3}


def test_reconcile_tells_swapped_nulls_apart(spark):
    schema = "k int, a string, b string"
    source = spark.createDataFrame([(1, None, "x")], schema)
    target = spark.createDataFrame([(1, "x", None)], schema)
    assert reconcile(source, target, ["k"]).first().status == "different"


def test_columns_may_have_any_name(spark):
    schema = "first int, status string, deleted string"
    before = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema)
    after = spark.createDataFrame([(1, "a", "z"), (3, "c", None)], schema)
    with pytest.raises(ValueError, match="prefix"):
        reconcile(before, after)
    counts = reconcile_counts(reconcile(before, after, prefix="p_"), prefix="p_")
    assert {r.status: r.n_keys for r in counts.collect()} == {"missing": 2, "extra": 2}
    for keys in (["first"], ["first", "status"]):
        found = capture_changes(before, after, keys, batch=1)
        for mode in ("upsert", "strict", "bag"):
            got = apply_changes(before, found, keys=keys, mode=mode)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, after.collect()), key=repr)
        assert net_changes(found, keys).count() == 3


def test_reconcile_ignores_column_order_sync_and_number_width(spark):
    source = spark.createDataFrame([(1, 5)], "k int, v int")
    target = stamped(spark.createDataFrame([(5, 1)], "v bigint, k bigint"), F.lit(b"\x01"))
    assert SYNC in target.columns
    assert reconcile(source, target, ["k"]).first().status == "equal"


def test_captured_changes_lead_to_the_later_state(spark):
    schema = "a int, b int, v string"
    before = spark.createDataFrame([(1, 1, "x"), (1, 2, None), (2, 1, "z"), (None, 1, "n")], schema)
    after = spark.createDataFrame([(1, 1, "x"), (1, 2, "now"), (3, 3, None), (None, 1, "n2")], schema)
    found = capture_changes(before, after, ["a", "b"], batch=9)
    assert {(r[OP], r["a"], r["b"], r["v"], bytes(r[LSN])) for r in found.collect()} == {
        (4, 1, 2, "now", position(9)), (1, 2, 1, "z", position(9)), (2, 3, 3, None, position(9)),
        (4, None, 1, "n2", position(9)),
    }
    keyed = "a is not null"
    got = apply_changes(before.where(keyed), found.where(keyed), keys=["a", "b"], mode="strict")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, after.where(keyed).collect()))
    assert capture_changes(after, after, ["a", "b"], batch=1).isEmpty()


def test_capture_needs_unique_keys(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "a")], TABLE)
    with pytest.raises(Exception, match="not unique"):
        capture_changes(twice, twice, ["k"], batch=1).collect()


def test_reconcile_compares_in_a_type_that_holds_both_sides(spark):
    def status(left, left_type, right, right_type):
        source = spark.createDataFrame([(1, left)], f"k int, v {left_type}")
        target = spark.createDataFrame([(1, right)], f"k long, v {right_type}")
        return reconcile(source, target, ["k"]).first().status

    assert status(1, "int", 1.5, "double") == "different" and status(1, "int", 1.0, "double") == "equal"
    assert status(None, "int", "abc", "string") == "different" and status(7, "int", "7", "string") == "equal"
    assert status("x", "string", None, "int") == "different" and status(None, "int", None, "string") == "equal"
    assert status(3, "int", 3, "bigint") == "equal" and status(2**40, "bigint", 0, "int") == "different"


def test_capture_runs_nothing_and_leaves_nothing(spark, tmp_path):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], TABLE)
    after = spark.createDataFrame([(2, "c"), (3, "d"), (None, "n")], TABLE)
    found = capture_changes(before, after, ["k"], batch=1)
    assert sorted((r[OP], r.k, r.v) for r in found.collect()) == [(1, 1, "a"), (2, 3, "d"), (4, 2, "c")]


def test_pair_status(spark):
    spark.range(3).createOrReplaceTempView("here")
    got = [tuple(r) for r in pair_status(spark, [("here", "nowhere")]).collect()]
    assert got == [(0, "source", "here", True, 3), (0, "target", "nowhere", False, None)]
    assert pair_status(spark, []).count() == 0


def test_stamp_replaces_an_older_position(spark):
    once = stamped(spark.createDataFrame([(1, "a")], TABLE), F.lit(position(1)))
    again = stamped(once, F.lit(position(2)))
    assert again.columns == ["k", "v", SYNC] and bytes(again.first()[SYNC]) == position(2)
    assert rows_of(again) == [(1, "a")]
