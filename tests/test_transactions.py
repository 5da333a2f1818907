"""Transactions in pieces and out of order, held until they can be replayed."""

import random

import pytest
from pyspark.errors import StreamingQueryException

from cdcspark.functions.lsn import END, LSN, OP, SEQ, TX_CHANGES, TX_PREVIOUS
from cdcspark.jobs import TableJob
from cdcspark.sinks.store import Store
from cdcspark.sources.changes import stream_changes
from cdcspark.streaming.transactions import run_transactions, transaction_ends, whole_upto
from helpers import position, random_log, random_target, replay, rows_of

SCHEMA = f"`{OP}` int, `{LSN}` binary, `{SEQ}` long, k int, v string, `{TX_CHANGES}` long, `{TX_PREVIOUS}` binary"


def change(tx, seq, op, k, v):
    return (op, position(tx), seq, k, v, None, None)


def end(tx, n, previous):
    return (END, position(tx), None, None, None, n, position(previous))


def transactions(log, size=4, step=10):
    """The log in transactions of ``size`` changes whose positions lie ``step`` apart."""
    ordered, rows, previous = sorted(log), [], 0
    for first in range(0, len(ordered), size):
        tx, part = (first // size + 1) * step, ordered[first : first + size]
        rows += [change(tx, n, op, k, v) for n, op, k, v in part] + [end(tx, len(part), previous)]
        previous = tx
    return rows


@pytest.mark.parametrize(
    "rows, base, want",
    [
        ([change(5, 1, 2, 1, "a"), end(5, 1, 0)], 0, 5),
        ([change(5, 1, 2, 1, "a"), end(5, 2, 0)], 0, 0),
        ([change(5, 1, 2, 1, "a")], 0, 0),
        ([end(5, 1, 0)], 0, 0),
        # One transaction before it has not come at all.
        ([change(9, 1, 2, 1, "a"), end(9, 1, 5)], 0, 0),
        ([change(9, 1, 2, 1, "a"), end(9, 1, 5)], 5, 9),
        ([change(9, 1, 2, 1, "a"), end(9, 1, 5)], 7, 9),
        ([change(9, 1, 2, 1, "a"), end(9, 1, 5), change(5, 1, 2, 1, "a"), end(5, 1, 0), change(12, 1, 2, 1, "a")], 0, 9),
        ([change(9, 1, 2, 1, "a"), end(9, 1, 5), change(5, 1, 2, 1, "a"), change(12, 1, 2, 1, "a"), end(12, 1, 9)], 0, 0),
        # Transactions without changes of this table, and ends that come twice.
        ([end(3, 0, 0), end(3, 0, 0), end(4, 0, 3)], 0, 4),
        ([], 6, 6),
    ],
)
def test_how_far_transactions_are_whole(spark, rows, base, want):
    assert whole_upto(spark.createDataFrame(rows, SCHEMA), position(base)) == position(want)


def stream_parts(spark, tmp_path, job, parts, **options):
    landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "query")
    moved = []
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        query = run_transactions(
            stream_changes(spark, landed, SCHEMA, max_files=1), job, checkpoint=checkpoint, trigger={"availableNow": True}, **options
        )
        query.awaitTermination()
        moved.append(int.from_bytes(job.store.current("t").position, "big"))
    return moved


def target(spark, tmp_path, rows, mode="upsert", **options):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    store.full_load("t", spark.createDataFrame(rows, "k int, v string"), None, keys=["k"])
    return TableJob("t", store, None, None, keys=["k"], mode=mode, order_by=[LSN, SEQ], retain_hours=None, **options)


@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
def test_any_order_gives_the_same_table(spark, tmp_path, mode):
    log, rows = random_log(5, events=80, nulls=False), random_target(5, unique=mode != "bag")
    feed = transactions(log)
    draw = random.Random(4)
    draw.shuffle(feed)
    job = target(spark, tmp_path, rows, mode)
    # Some changes come twice.
    stream_parts(spark, tmp_path, job, [feed[:30], feed[30:60] + feed[10:20], feed[60:]])
    assert rows_of(job.store.read("t", with_sync=False)) == replay(rows, log, mode)
    assert job.store.quarantined("t") is None and job.store.current("t").position == position(200)


def test_what_is_whole_is_not_held(spark, tmp_path):
    log = [(n, 2, n, f"v{n}") for n in range(1, 13)]
    feed = transactions(log)
    job = target(spark, tmp_path, [])
    # Transactions at 10, 20 and 30, each four changes and an end.
    moved = stream_parts(spark, tmp_path, job, [feed[:7], feed[10:15], feed[8:10], feed[7:8]])
    assert moved == [10, 10, 10, 30]
    assert rows_of(job.store.read("t", with_sync=False)) == [(n, f"v{n}") for n in sorted(range(1, 13), key=lambda n: repr((n, "")))]


def test_what_comes_after_a_whole_transaction_is_late(spark, tmp_path):
    job = target(spark, tmp_path, [], on_error="quarantine")
    first = [change(10, 1, 2, 1, "a"), end(10, 1, 0)]
    moved = stream_parts(spark, tmp_path, job, [first, [change(10, 2, 4, 1, "late"), change(20, 3, 2, 2, "b"), end(20, 1, 10)]])
    assert moved == [10, 20] and rows_of(job.store.read("t", with_sync=False)) == [(1, "a"), (2, "b")]
    assert [r.v for r in job.store.quarantined("t").collect()] == ["late"]


def test_a_query_that_dies_goes_on(spark, tmp_path):
    log = random_log(6, events=48, nulls=False)
    feed = transactions(log)
    random.Random(1).shuffle(feed)
    job = target(spark, tmp_path, [])
    count = []

    def dies(done):
        count.append(done)
        if len(count) in (1, 3):
            raise RuntimeError("killed")

    parts = [feed[:20], feed[20:40], feed[40:]]
    for i in range(3):
        spark.createDataFrame(parts[i], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))
    for _ in range(3):
        stream = stream_changes(spark, str(tmp_path / "landed"), SCHEMA, max_files=1)
        query = run_transactions(stream, job, checkpoint=str(tmp_path / "query"), trigger={"availableNow": True}, on_batch=dies)
        try:
            query.awaitTermination()
            break
        except StreamingQueryException:
            pass
    assert rows_of(job.store.read("t", with_sync=False)) == replay([], log, "upsert")


def test_errors(spark, tmp_path):
    job = target(spark, tmp_path, [])
    with pytest.raises(ValueError, match="no columns"):
        run_transactions(spark.readStream.format("rate").load(), job, checkpoint=str(tmp_path / "c"))
    too_many = [change(10, 1, 2, 1, "a"), change(10, 2, 2, 2, "b"), end(10, 1, 0)]
    with pytest.raises(StreamingQueryException, match="more changes than its end says"):
        stream_parts(spark, tmp_path, job, [too_many])
    other = target(spark, tmp_path / "o", [])
    with pytest.raises(StreamingQueryException, match="wait for a transaction"):
        stream_parts(spark, tmp_path / "o", other, [[change(10, i, 2, i, "a") for i in range(5)]], most_held=4)


def test_ends_of_a_whole_feed(spark):
    feed = spark.createDataFrame([change(3, 1, 2, 1, "a"), change(3, 2, 2, 2, "b"), change(8, 3, 2, 3, "c")], SCHEMA)
    got = sorted(tuple(r) for r in transaction_ends(feed.select(OP, LSN, SEQ, "k", "v")).collect())
    assert got == [(END, position(3), 2, None), (END, position(8), 1, position(3))]
