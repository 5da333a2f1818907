"""First load of a table that goes on changing, range by range of its key.

Every range is read between two positions of the log: one asked for before its scan, one after it. Keys that no change between the
two concerns stood still, so their rows are the source's at both positions. What the others become is for
the log to say:

* ``upsert``: the range stands for the position before its scan. All later changes are replayed, so they win over the rows read.
* ``strict`` and ``bag`` count on each change being applied once. The keys that moved are read again between the second position and a
  third, and so on until none moves; parts that stood still earlier are brought to the range's position from the log.

The positions have to be those of the tables: where a capture process fills the change table a little later, ``job.position`` has to
wait till it has caught up with the log, or a change may be seen by a scan and replayed after the range's position.

A range is one commit to the load's own files. A job that dies goes on with the next range. When all are there, one
replay brings each range from its own position to the same last one and puts the whole table in force.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cdcspark.functions.lsn import LSN, ZERO_LSN
from cdcspark.jobs import Metrics, TableJob, judge, not_aside, rejected_of, stage
from cdcspark.operators.apply import _c, apply_changes
from cdcspark.operators.quarantine import REASON, cast_to
from cdcspark.plans.mapping import project_mapped, table_columns
from cdcspark.plans.schema import translate_schema
from cdcspark.session import scratch, written
from cdcspark.sinks.store import Load
from cdcspark.sources.changes import changes_since, max_lsn, misplaced
from cdcspark.sources.splits import Splits, plan_splits

#: How often keys that move are read again before the load gives up.
ROUNDS = 20


class UnsettledKeys(RuntimeError):
    """Some keys changed during every reading, so no position is known that their rows stand for."""


def load_in_chunks(job: TableJob, metrics: Metrics) -> None:
    """Load a job's table range by range, going on where an earlier run ended."""
    spark, store = job.spark, job.store
    if not hasattr(store, "begin_load"):
        raise TypeError(f"{type(store).__name__} cannot take a table in parts; load it as a whole")
    load = store.load_in_progress(job.table)
    if load is not None and behind(job, load):
        store.abandon_load(job.table)
        load = None
    metrics.phase = "initial" if load is None else "continued"
    load = load or begin(job)
    splits = Splits.of(load.plan)
    for number in range(load.done, len(splits)):
        with scratch(spark, "chunk") as path:
            rows, position = read_range(job, splits, number, path)
            load = store.load_part(job.table, load, rows, position)
    metrics.loaded = load.rows
    finish(job, load, splits, metrics)


def reached(job: TableJob) -> bytes:
    """How far the source's log goes."""
    found = job.position(job.spark) if job.position else max_lsn(opened(job, ZERO_LSN))
    floor = job.retained_from(job.spark) if job.retained_from else None
    return max(found or ZERO_LSN, floor or ZERO_LSN)


def opened(job: TableJob, position: bytes) -> DataFrame:
    feed = job.changes(job.spark, position)
    if feed is None:
        raise LookupError(f"{job.table} has no change table")
    return feed


def behind(job: TableJob, load: Load) -> bool:
    """The log no longer covers what the first ranges need."""
    floor = job.retained_from(job.spark) if job.retained_from else None
    return floor is not None and any(bytes.fromhex(p) < floor for p in load.positions)


def _mapped(job: TableJob, source: DataFrame) -> list[tuple[str, str]]:
    return list(job.columns or [(c, c) for c in table_columns(source)])


def _source_keys(job: TableJob, columns: Sequence[tuple[str, str]], keys: Sequence[str] | None) -> list[str]:
    """The source's names of the key columns."""
    names = dict(columns)
    return [names[k] for k in keys or [columns[0][0]]]


def begin(job: TableJob) -> Load:
    """Plan the ranges and note them, so that a later run has the same ones."""
    spark = job.spark
    opened(job, ZERO_LSN)
    source = job.snapshot(spark)
    columns = _mapped(job, source)
    keys = list(job.keys or [columns[0][0]])
    splits = job.chunks(spark) if callable(job.chunks) else plan_splits(source, _source_keys(job, columns, keys), job.chunks)
    info = job.information_schema(spark) if job.information_schema else None
    if info is None:
        schema = StructType([StructField(f.name, f.dataType) for f in project_mapped(source, columns).schema.fields])
    else:
        known = {f.name: f for f in translate_schema(info)}
        schema = StructType([StructField(t, known[s].dataType, known[s].nullable, known[s].metadata) for t, s in columns if s in known])
    return job.store.begin_load(job.table, schema, splits.stored(), keys=keys)


def read_range(job: TableJob, splits: Splits, number: int, path: str) -> tuple[DataFrame, bytes]:
    """Rows of a range, under the target's names, and the position they stand for."""
    spark, inside = job.spark, splits.condition(number)
    low = reached(job)
    source = job.snapshot(spark).where(inside)
    columns = _mapped(job, source)
    if job.mode == "upsert":
        return project_mapped(source, columns), low
    keys = _source_keys(job, columns, job.keys)
    settled: list[DataFrame] = []
    turns: list[tuple[bytes, DataFrame]] = []
    moving = None
    for turn in range(ROUNDS):
        if moving is not None:
            source = _joined(job.snapshot(spark).where(inside), moving, keys, "left_semi")
        # The scan runs here, between the two positions.
        rows = written(source, "rows", path=f"{path}/rows-{turn}")
        high = max(reached(job), low)
        changes = _in_range(changes_since(opened(job, low), low, upto=high), splits, number)
        if moving is not None:
            changes = _joined(changes, moving, keys, "left_semi")
        moved = written(changes.select(*[_c(k) for k in keys]).distinct(), "moved", path=f"{path}/moved-{turn}")
        settled.append(_joined(rows, moved, keys, "left_anti"))
        turns.append((high, moved))
        moving, low = moved, high
        if moved.isEmpty():
            return _brought_together(job, splits, number, settled, turns, columns, keys), turns[max(len(turns) - 2, 0)][0]
    raise UnsettledKeys(f"keys of {job.table} changed during each of {ROUNDS} readings; load it from a fixed point in time")


def _brought_together(
    job: TableJob, splits: Splits, number: int, settled: list[DataFrame], turns: list[tuple[bytes, DataFrame]],
    columns: Sequence[tuple[str, str]], keys: list[str],
) -> DataFrame:
    """Parts that stood still at different positions, all at that of the last but one; the last part stands for it as it is."""
    target_keys = list(job.keys or [columns[0][0]])
    last = turns[max(len(turns) - 2, 0)][0]
    out = None
    for turn, rows in enumerate(settled):
        position, moved = turns[turn]
        part = project_mapped(rows, columns)
        if position < last:
            later = _in_range(changes_since(opened(job, position), position, upto=last), splits, number)
            later = _joined(later, moved, keys, "left_anti")
            if turn:
                later = _joined(later, turns[turn - 1][1], keys, "left_semi")
            judged = judge(job, later, part.schema, target_keys)
            good = cast_to(judged.where(F.col(REASON).isNull()).drop(REASON), part.schema)
            part = apply_changes(part, good, keys=target_keys, order_by=job.order_by, mode=job.mode, hot=())
        out = part if out is None else out.unionByName(part)
    return out


def _in_range(changes: DataFrame, splits: Splits, number: int) -> DataFrame:
    return changes.where(splits.number_of() == number)


def _joined(df: DataFrame, some: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is, or is not, among some; a null key is a key like others."""
    types = dict(df.dtypes)
    names = some.select(*[_c(k).try_cast(types[k]).alias(f"__key_{i}") for i, k in enumerate(keys)])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & _c(k).eqNullSafe(F.col(f"__key_{i}"))
    return df.join(names, match, how)


def finish(job: TableJob, load: Load, splits: Splits, metrics: Metrics) -> None:
    """Replay what each range lacks and put the table in force."""
    spark, store = job.spark, job.store
    positions = [bytes.fromhex(p) for p in load.positions]
    upper = max(reached(job), *positions)
    lowest = min(positions)
    source = opened(job, lowest)
    fresh = changes_since(source, lowest, upto=upper)
    own = F.get(F.array(*[F.lit(p) for p in positions]), splits.number_of())
    fresh = fresh.where(_c(LSN) > own)
    if job.check_positions and not misplaced(source).select(_c(LSN)).isEmpty():
        fresh = misplaced(fresh, others=True).unionByName(misplaced(source))
    schema = StructType.fromJson(json.loads(load.schema))
    with scratch(spark, "changes") as path:
        staged, counts = stage(spark, judge(job, fresh, schema, load.keys), path)
        metrics.inserts, metrics.updates, metrics.deletes = counts["ins"], counts["upd"], counts["del"]
        metrics.ignored, metrics.rejected = counts["other"], counts["bad"]
        rejected = rejected_of(job, staged, counts["bad"]) if counts["bad"] else None
        if rejected is not None and store.exists(job.table):
            rejected = not_aside(store, job.table, rejected)
        good = None
        if counts["n"] > counts["bad"]:
            good = cast_to(staged.where(F.col(REASON).isNull()).drop(REASON), schema)
        state = store.finish_load(job.table, load, good, upper, mode=job.mode, order_by=job.order_by, rejected=rejected)
    metrics.watermark = state.position
