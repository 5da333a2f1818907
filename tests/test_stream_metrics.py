"""What a listener reports of micro-batches."""

import time

import pytest
from pyspark.errors import StreamingQueryException

from cdcspark import jobs
from cdcspark.jobs import METRICS, TableJob
from cdcspark.sinks.store import Store
from cdcspark.sources.changes import stream_changes
from cdcspark.streaming import metrics
from cdcspark.streaming.metrics import StreamMetrics, observed, run_reported
from helpers import FEED, feed_of, position


@pytest.fixture
def listener(spark, tmp_path):
    found = StreamMetrics(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(found)
    yield found
    spark.streams.removeListener(found)


def until(condition, seconds=30):
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if condition():
            return
        time.sleep(0.1)
    raise AssertionError("it did not come")


def job_of(spark, tmp_path, **options):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    store.full_load("t", spark.createDataFrame([(1, "a")], "k int, v string"), None, keys=["k"])
    return TableJob("t", store, None, None, keys=["k"], retain_hours=None, **options)


def land(spark, tmp_path, *log):
    feed_of(spark, log).coalesce(1).write.mode("append").parquet(str(tmp_path / "landed"))


def reported(spark, listener):
    rows = spark.read.schema(METRICS).parquet(listener.path).collect()
    return sorted((r.table_name, r.phase, r.inserts, r.updates, r.deletes, r.ignored, int.from_bytes(r.watermark, "big")) for r in rows)


def test_a_row_per_batch(spark, tmp_path, listener):
    rows = []
    listener.on_row = rows.append
    land(spark, tmp_path, (1, 2, 5, "x"), (2, 4, 1, "b"), (3, 7, 1, "?"))
    land(spark, tmp_path, (4, 1, 5, None), (5, None, 1, "?"))
    job = job_of(spark, tmp_path)
    stream = stream_changes(spark, str(tmp_path / "landed"), FEED, max_files=1)
    run_reported(stream, job, listener, checkpoint=str(tmp_path / "query"), trigger={"availableNow": True}).awaitTermination()
    until(lambda: len(rows) == 2)
    assert reported(spark, listener) == [("t", "stream", 0, 0, 1, 1, 5), ("t", "stream", 1, 1, 0, 1, 3)]
    assert all(r.seconds >= 0 and r.started.year > 2000 for r in rows)


def test_queries_that_are_not_watched_are_not_reported(spark, tmp_path, listener):
    land(spark, tmp_path, (1, 2, 5, "x"))
    stream = observed(stream_changes(spark, str(tmp_path / "landed"), FEED))
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "q")).trigger(availableNow=True).start()
    query.awaitTermination()
    until(lambda: listener._waiting)
    assert not (tmp_path / "metrics").exists()
    # Watched afterwards, it is.
    listener.watch(query, "late")
    assert reported(spark, listener) == [("late", "stream", 1, 0, 0, 0, 1)]


def test_a_row_that_cannot_be_written_waits(spark, tmp_path, listener, monkeypatch):
    def fails(*_):
        raise OSError("no space")

    monkeypatch.setattr(metrics, "save_metrics", fails)
    land(spark, tmp_path, (1, 2, 5, "x"))
    stream = stream_changes(spark, str(tmp_path / "landed"), FEED)
    job = job_of(spark, tmp_path)
    run_reported(stream, job, listener, checkpoint=str(tmp_path / "query"), trigger={"availableNow": True}).awaitTermination()
    until(lambda: listener._waiting)
    assert job.store.watermark("t") == position(1)
    monkeypatch.setattr(metrics, "save_metrics", jobs.save_metrics)
    listener.flush()
    assert len(reported(spark, listener)) == 1 and not listener._waiting


def test_a_query_that_fails_is_noted(spark, tmp_path, listener):
    land(spark, tmp_path, (1, 4, None, "x"))
    stream = stream_changes(spark, str(tmp_path / "landed"), FEED)
    query = run_reported(stream, job_of(spark, tmp_path), listener, checkpoint=str(tmp_path / "query"), trigger={"availableNow": True})
    with pytest.raises(StreamingQueryException, match="rejected"):
        query.awaitTermination()
    until(lambda: str(query.id) in listener.errors)
