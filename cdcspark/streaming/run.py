"""Replay as a continuous query."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cdcspark.jobs import Metrics, TableJob, incremental_sync, run_cycle
from cdcspark.operators.feed import change_report

# Time between two cycles, and between two looks of the monitor.
DEFAULT_INTERVAL = "15 seconds"
MONITOR_INTERVAL = "10 seconds"


def run_stream(
    feed: DataFrame,
    job: TableJob,
    *,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    on_batch: Callable[[Metrics], None] | None = None,
) -> StreamingQuery:
    """Apply a streaming change feed to a table.

    Each micro-batch commits its rows, its rejected changes and its number
    together. The number, under the name of the checkpoint, is how a batch that
    comes again after a failure is recognised, so every change counts once.
    Changes of one transaction may come in several batches. What comes after a
    higher position was committed is too late to be put in order: it fails the
    query, or goes to quarantine. A new checkpoint starts over: changes up to
    the position the table has then are known and dropped.
    """

    def batch(changes: DataFrame, number: int) -> None:
        done = incremental_sync(job, feed=changes, batch=(checkpoint, number))
        if on_batch:
            on_batch(done)

    writer = feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": DEFAULT_INTERVAL})).start()


def run_every(
    spark: SparkSession, work: Callable[[], None], *, checkpoint: str, interval: str = DEFAULT_INTERVAL
) -> StreamingQuery:
    """Run batch work again and again; a clock stream sets the pace. Stop it with ``query.stop()``."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    writer = clock.writeStream.foreachBatch(lambda _, __: work()).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval).start()


def run_continuous(
    jobs: Sequence[TableJob],
    *,
    checkpoint: str,
    interval: str = DEFAULT_INTERVAL,
    on_cycle: Callable[[list[Metrics]], None] | None = None,
) -> StreamingQuery:
    """Poll the change tables of all jobs, for sources that do not stream: one batch replay per table and cycle."""

    def cycle() -> None:
        done = run_cycle(jobs)
        if on_cycle:
            on_cycle(done)

    return run_every(jobs[0].spark, cycle, checkpoint=checkpoint, interval=interval)


def run_monitor(
    spark: SparkSession,
    open_feed: Callable[[SparkSession], DataFrame],
    *,
    checkpoint: str,
    on_report: Callable[[Row], None],
    interval: str = MONITOR_INTERVAL,
) -> StreamingQuery:
    """Report on the whole retained range of a change table again and again, applying nothing."""

    def look() -> None:
        on_report(change_report(open_feed(spark)).first())

    return run_every(spark, look, checkpoint=checkpoint, interval=interval)
