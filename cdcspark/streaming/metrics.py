"""Metrics of running streams: one row per micro-batch, in the table that cycles are reported in.

What a micro-batch holds is counted on the way by an observation on the stream, so nothing is read twice. A listener gets the
counts with the batch's progress and appends them to the metrics table; it can also be asked while the query runs.
"""

from __future__ import annotations

import threading
import traceback
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cdcspark.functions.lsn import APPLIED_OPS, DELETE, INSERT, LSN, OP, UPDATE
from cdcspark.jobs import Metrics, TableJob, save_metrics
from cdcspark.operators.apply import _c
from cdcspark.streaming.run import run_stream

#: Name of the observation, and what rows of streams have as their phase.
OBSERVED, PHASE = "cdc_changes", "stream"


def observed(feed: DataFrame, name: str = OBSERVED) -> DataFrame:
    """The stream with counts of its changes per micro-batch."""
    op = _c(OP)
    known = F.coalesce(op.isin(*APPLIED_OPS), F.lit(False))
    return feed.observe(
        name,
        F.count(F.lit(1)).alias("n"),
        F.count_if(op == INSERT).alias("inserts"),
        F.count_if(op == UPDATE).alias("updates"),
        F.count_if(op == DELETE).alias("deletes"),
        F.count_if(~known).alias("ignored"),
        F.max(F.hex(_c(LSN))).alias("high"),
    )


class StreamMetrics(StreamingQueryListener):
    """Appends a row per finished micro-batch of some queries to the metrics table at ``path``.

    ``tables`` gives the table that each query fills, by the query's id (see ``watch``). What an observed query did before it was
    watched is reported when it is. Micro-batches without changes are
    not reported. A row that cannot be written is kept for the next time; a listener that fails must not stop a query.
    The rows' ``watermark`` is the highest position the micro-batch held, and ``rejected`` is left to the target's own counts.
    """

    def __init__(self, spark: SparkSession, path: str, *, on_row: Callable[[Metrics], None] | None = None):
        self.spark, self.path, self.on_row = spark, path, on_row
        self.tables: dict[str, str] = {}
        self.errors: dict[str, str] = {}
        self._waiting: list[tuple[str, Metrics]] = []
        self._lock = threading.Lock()

    def watch(self, query: StreamingQuery, table: str) -> StreamingQuery:
        """Report on a query from now on, and on what it has done so far."""
        with self._lock:
            self.tables[str(query.id)] = table
        self.flush()
        return query

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(OBSERVED)
        if counts is None or not counts["n"]:
            return
        with self._lock:
            self._waiting.append((str(progress.id), batch_metrics("", progress, counts)))
        self.flush()

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors[str(event.id)] = event.exception
        self.flush()

    def flush(self) -> None:
        """Write the rows that wait, of queries that are watched."""
        with self._lock:
            ready = [(query, row) for query, row in self._waiting if query in self.tables]
            if not ready:
                return
            for query, row in ready:
                row.table = self.tables[query]
            try:
                save_metrics(self.spark, [row for _, row in ready], self.path)
            except Exception:
                traceback.print_exc()
                return
            self._waiting = [x for x in self._waiting if x not in ready]
        for _, row in ready:
            if self.on_row:
                self.on_row(row)


def batch_metrics(table: str, progress, counts: Row | Mapping) -> Metrics:
    """A metrics row of one micro-batch from its progress and its observed counts."""
    started = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
    return Metrics(
        table, PHASE, inserts=counts["inserts"], updates=counts["updates"], deletes=counts["deletes"], ignored=counts["ignored"],
        watermark=bytes.fromhex(counts["high"]) if counts["high"] else None, seconds=round(progress.batchDuration / 1000, 2), started=started,
    )


def run_reported(
    feed: DataFrame, job: TableJob, listener: StreamMetrics, *, checkpoint: str, run: Callable[..., StreamingQuery] = run_stream, **options
) -> StreamingQuery:
    """``run_stream``, or another way to run a feed, with its micro-batches reported by a listener that was added to the session."""
    return listener.watch(run(observed(feed), job, checkpoint=checkpoint, **options), job.table)
