"""Cycles after which all tables agree: every table ends at one barrier position, or the cut does not move.

Tables of one source share its log. A replay of each by itself leaves them at different positions, so an order may be there whose
customer is not. A consistent cycle asks all sources how far they are, takes the least of these positions as the barrier,
replays every table up to it and no further, and declares the versions that came of it a cut (see ``Store.publish_cut``). A table
that fails, or a source that is behind, leaves the cut before in force; the next cycle goes on from where each table is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from cdcspark.functions.lsn import ZERO_LSN
from cdcspark.jobs import Metrics, TableJob, incremental_sync, initial_sync, run_tables
from cdcspark.sinks.store import Cut, Store
from cdcspark.sources.changes import max_lsn

#: Why a cycle made no new cut.
FAILED, AHEAD = "a table failed", "a table is ahead of the barrier"


@dataclass
class CutResult:
    """Outcome of a consistent cycle: the cut in force after it, the barrier, and what held the cut back, if anything did."""

    cut: Cut | None
    barrier: bytes
    metrics: list[Metrics]
    held_back: str | None = None


def reached_by(job: TableJob) -> bytes:
    """How far a job's source is; the end of its change table if the source does not know the log's."""
    if job.position:
        return job.position(job.spark) or ZERO_LSN
    feed = job.changes(job.spark, ZERO_LSN)
    return (max_lsn(feed) if feed is not None else None) or ZERO_LSN


def consistent_cycle(
    jobs: Sequence[TableJob],
    *,
    group: str = "all",
    position: Callable[[SparkSession], bytes | None] | None = None,
    at_once: int = 4,
) -> CutResult:
    """Bring all tables to the least position that all sources have reached, and cut there.

    ``position`` tells how far the log of all tables goes, where one is kept for them together; without it each job is
    asked. A change table as files only knows its own last change, so there a table that rests holds the barrier back till
    it changes again, unless ``position`` is given. Tables that were never loaded are loaded first.
    """
    store = _store(jobs)
    spark = store.spark
    loaded = run_tables(jobs, lambda job: [initial_sync(job, stop_on_error=False)], at_once=at_once)
    if any(m.error for m in loaded):
        return CutResult(store.current_cut(group), ZERO_LSN, loaded, FAILED)
    # Asked for after the loads, so no table is ahead of a barrier its own load has passed.
    barrier = (position(spark) or ZERO_LSN) if position else min(reached_by(job) for job in jobs)

    def to_barrier(job: TableJob) -> list[Metrics]:
        if store.current(job.table).position > barrier:
            return [Metrics(job.table, "ahead", watermark=store.current(job.table).position)]
        return [incremental_sync(job, upto=barrier, stop_on_error=False)]

    done = run_tables(jobs, to_barrier, at_once=at_once)
    versions = {job.table: store.current(job.table) for job in jobs}
    if any(m.error for m in done):
        return CutResult(store.current_cut(group), barrier, done, FAILED)
    if any(v.position != barrier for v in versions.values()):
        return CutResult(store.current_cut(group), barrier, done, AHEAD)
    return CutResult(store.publish_cut(versions, group=group), barrier, done)


def _store(jobs: Sequence[TableJob]) -> Store:
    stores = {id(job.store): job.store for job in jobs}
    if len(stores) != 1 or not hasattr(jobs[0].store, "publish_cut"):
        raise ValueError("the tables of a cut are in one store that keeps versions")
    return jobs[0].store
