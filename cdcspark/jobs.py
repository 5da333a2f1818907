"""Jobs over configured tables: first load, replay, cycles and their metrics."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cdcspark.functions.lsn import DELETE, INSERT, LSN, LSN_BYTES, OP, SEQ, SYNC, UPDATE, ZERO_LSN, lsn_literal
from cdcspark.operators.apply import _c
from cdcspark.operators.quarantine import BAD_POSITION, LATE, REASON, cast_to, with_reason
from cdcspark.plans.mapping import mapped_tables, project_mapped, table_columns
from cdcspark.plans.schema import translate_schema
from cdcspark.session import scratch, written
from cdcspark.sinks.target import Batch, State, Target
from cdcspark.sources.changes import changes_since, max_lsn, misplaced
from cdcspark.sources.splits import Splits
from cdcspark.sources.tables import Source

METRICS = (
    "table_name string, phase string, started timestamp, seconds double, loaded bigint, inserts bigint, "
    "updates bigint, deletes bigint, ignored bigint, rejected bigint, watermark binary, error string"
)


class RejectedChanges(RuntimeError):
    """Some changes cannot be applied and the job does not allow setting them aside."""


@dataclass
class TableJob:
    """What to replicate into one target table.

    ``snapshot(spark)`` opens the source table. ``changes(spark, position)``
    opens its change table; it may use the position to read less, rows up to
    it are dropped in any case. ``columns`` lists (target column, source
    column); without it all source columns are taken under their own names.

    ``position(spark)`` tells how far the source's log goes. It is asked before
    the scan and before each read, which then goes up to it and no further, so
    a transaction is read whole, and the target's position moves on over ranges
    without changes. ``retained_from(spark)`` tells the oldest position the change
    table still covers; a target behind it is loaded anew.
    ``information_schema(spark)`` describes the source table; with it the
    target is created, and its types and rules are the source's.

    ``on_error`` is ``fail`` or ``quarantine``: changes that cannot be applied
    are set aside by the commit that passes them. Changes whose own position is
    missing or malformed can never be passed and are set aside at once;
    looking for them among old changes costs a scan of the feed's position column
    per cycle, which ``check_positions=False`` saves where the source cannot
    hold such. Versions that were replaced more than ``retain_hours`` ago are
    removed, and a read that takes longer fails; None keeps all.

    ``on_drift="evolve"`` asks for the source's structure before each replay and lets the
    target follow it (see ``Store.evolve``); without it the target keeps its own.

    ``chunks`` makes the first load go range by range of the key (see
    ``cdcspark.chunks``): a number of ranges, or a function that plans them.
    """

    table: str
    store: Target
    snapshot: Callable[[SparkSession], DataFrame]
    changes: Callable[[SparkSession, bytes], DataFrame | None]
    keys: Sequence[str] | None = None
    columns: Sequence[tuple[str, str]] | None = None
    mode: str = "upsert"
    order_by: Sequence[str] | None = None
    position: Callable[[SparkSession], bytes | None] | None = None
    retained_from: Callable[[SparkSession], bytes | None] | None = None
    information_schema: Callable[[SparkSession], DataFrame | None] | None = None
    on_error: str = "fail"
    check_positions: bool = True
    retain_hours: float | None = 24
    chunks: int | Callable[[SparkSession], Splits] | None = None
    on_drift: str = "ignore"

    @property
    def spark(self) -> SparkSession:
        return self.store.spark


@dataclass
class Metrics:
    """Outcome of one job, one row of the metrics table."""

    table: str
    phase: str
    loaded: int = 0
    inserts: int = 0
    updates: int = 0
    deletes: int = 0
    ignored: int = 0
    rejected: int = 0
    watermark: bytes | None = None
    error: str | None = None
    seconds: float = 0.0
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))

    def row(self) -> tuple:
        return (
            self.table, self.phase, self.started, self.seconds, self.loaded, self.inserts, self.updates,
            self.deletes, self.ignored, self.rejected, self.watermark, self.error,
        )


def jobs_from_mapping(
    mapping: DataFrame, store: Target, source: Source, *, keys: Mapping[str, Sequence[str]] | None = None, **options
) -> list[TableJob]:
    """One job per target of a mapping (see ``load_mapping``).

    ``keys`` names each target's key columns; without them the first mapped
    column is the key. ``options`` go to every job.
    """
    return [
        _job(store, source, target, origin, columns, keys, options)
        for target, (origin, columns) in mapped_tables(mapping).items()
    ]


def jobs_from_tables(
    tables: DataFrame, store: Target, source: Source, *, keys: Mapping[str, Sequence[str]] | None = None, **options
) -> list[TableJob]:
    """One job per table of a list (see ``load_table_list``), all columns under their own names."""
    names = [r["table_name"] for r in tables.orderBy("pos").collect()]
    return [_job(store, source, name, name, None, keys, options) for name in names]


def _job(store, source, target, origin, columns, keys, options) -> TableJob:
    return TableJob(
        target,
        store,
        lambda spark: source.snapshot(spark, origin),
        lambda spark, position: source.changes(spark, origin, position),
        keys=(keys or {}).get(target),
        columns=columns,
        **{
            "position": lambda spark: source.position(spark, origin),
            "retained_from": lambda spark: source.retained_from(spark, origin),
            "information_schema": lambda spark: source.information_schema(spark, origin),
            "check_positions": getattr(source, "check_positions", True),
            **options,
        },
    )


def create_from_schema(
    store: Target,
    table: str,
    info: DataFrame,
    *,
    keys: Sequence[str] | None = None,
    columns: Sequence[tuple[str, str]] | None = None,
) -> StructType | None:
    """Create the target, if it is absent, from its source's information schema.

    ``columns`` picks and renames as in a job. Returns the target's schema,
    None if the source has no such table.
    """
    try:
        schema = translate_schema(info)
    except LookupError:
        return None
    if columns:
        known = {f.name: f for f in schema}
        missing = [source for target, source in columns if target != SYNC and source not in known]
        if missing:
            raise LookupError(f"{table} is mapped from columns the source lacks: {', '.join(missing)}")
        picked = [(target, known[source]) for target, source in columns if target != SYNC]
        schema = StructType([StructField(t, f.dataType, f.nullable, f.metadata) for t, f in picked])
    store.create_if_absent(table, schema, keys=keys)
    return schema


def metrics_table(spark: SparkSession, metrics: Sequence[Metrics]) -> DataFrame:
    return spark.createDataFrame([m.row() for m in metrics], METRICS)


def save_metrics(spark: SparkSession, metrics: Sequence[Metrics], path: str) -> None:
    """Append the outcome of a cycle to a table of all cycles."""
    metrics_table(spark, metrics).coalesce(1).write.mode("append").parquet(path)


def _timed(metrics: Metrics, work: Callable[[], None], stop_on_error: bool) -> Metrics:
    begin = time.monotonic()
    try:
        work()
    except Exception as problem:  # one table's failure is reported, the others go on
        if stop_on_error:
            raise
        metrics.error = f"{type(problem).__name__}: {str(problem).splitlines()[0] if str(problem) else ''}"
    metrics.seconds = round(time.monotonic() - begin, 2)
    return metrics


def initial_sync(job: TableJob, *, full_refresh: bool = False, stop_on_error: bool = True) -> Metrics:
    """Load the whole source table, unless the target was loaded before.

    The log position is taken before the scan: changes made during the scan
    are replayed afterwards instead of being lost. It is the source's own, so a
    table that never changed starts where the log is, not at its beginning.
    ``bag`` counts an insert seen by both the scan and the replay twice, so it
    needs a scan of a fixed point in time, a source at rest, or ``job.chunks``.
    """
    metrics = Metrics(job.table, "initial")

    def work() -> None:
        spark, store = job.spark, job.store
        if store.exists(job.table) and not full_refresh and not store.is_new(job.table):
            metrics.phase, metrics.watermark = "resumed", store.current(job.table).position
            return
        if job.chunks is not None:
            from cdcspark.chunks import load_in_chunks

            load_in_chunks(job, metrics)
            return
        feed = job.changes(spark, ZERO_LSN)
        if feed is None:
            raise LookupError(f"{job.table} has no change table")
        floor = job.retained_from(spark) if job.retained_from else None
        reached = job.position(spark) if job.position else max_lsn(feed)
        position = max(floor or ZERO_LSN, reached or ZERO_LSN)
        info = job.information_schema(spark) if job.information_schema else None
        schema = None
        if info is not None:
            schema = create_from_schema(store, job.table, info, keys=job.keys, columns=job.columns)
        source = job.snapshot(spark)
        columns = job.columns or [(c, c) for c in table_columns(source)]
        state = store.full_load(job.table, project_mapped(source, columns), position, keys=job.keys, schema=schema)
        metrics.loaded, metrics.watermark = state.written, position

    return _timed(metrics, work, stop_on_error)


def incremental_sync(
    job: TableJob,
    *,
    feed: DataFrame | None = None,
    batch: tuple[str, int] | None = None,
    upto: bytes | None = None,
    whole: bool = False,
    stop_on_error: bool = True,
) -> Metrics:
    """Replay the changes after the target's position and commit both together.

    The new part of the feed is read once and written to the shared folder with
    a verdict on each change; every later step reads that copy. No new changes:
    the rows stay as they are, and the position moves on to the source's.

    ``feed`` is a stream's micro-batch and ``batch`` its query and number. A
    micro-batch the target already holds is skipped. Of the others, changes up
    to the position the target had when the query first came are dropped as
    known, later ones are applied even if their position was reached before, as
    one transaction may come in several parts, and those below it are too late
    and count as rejected.
    """
    metrics = Metrics(job.table, "incremental")

    def work() -> None:
        base = follow_drift(job) if job.on_drift == "evolve" else job.store.current(job.table)
        metrics.watermark = base.position
        upper, mine = None, None
        if feed is None:
            floor = job.retained_from(job.spark) if job.retained_from else None
            if floor is not None and base.position < floor:
                again = initial_sync(job, full_refresh=True)
                metrics.phase, metrics.loaded, metrics.watermark = "reloaded", again.loaded, again.watermark
                return
            reached = upto if upto is not None else job.position(job.spark) if job.position else None
            upper = None if reached is None else max(reached, base.position)
            source = job.changes(job.spark, base.position)
            if source is None:
                metrics.phase = "not captured"
                return
            fresh = changes_since(source, base.position, upto=upper)
            if job.check_positions and not misplaced(source).select(_c(LSN)).isEmpty():
                fresh = misplaced(fresh, others=True).unionByName(misplaced(source))
        else:
            source, late_below = feed, None
            if batch is not None:
                known = base.last_batch(batch[0])
                if known and known.number >= batch[1]:
                    metrics.phase = "repeated"
                    return
                mine = Batch(*batch, known.floor if known else base.position)
                floor, late_below = mine.floor, base.position
            else:
                floor = base.position
            fresh = source.where((_c(LSN) > lsn_literal(floor)) | misplaced())
        judged = judge(job, fresh, base.columns, base.keys)
        if mine:
            passed = _c(LSN) <= lsn_literal(late_below) if whole else _c(LSN) < lsn_literal(late_below)
            late = F.col(REASON).isNull() & passed
            judged = judged.withColumn(REASON, F.when(late, F.lit(LATE)).otherwise(F.col(REASON)))
        with scratch(job.spark, "changes") as path:
            staged, counts = stage(job.spark, judged, path)
            replay(base, staged, counts, upper, mine)

    def replay(base: State, staged: DataFrame, counts: dict, upper: bytes | None, mine: Batch | None) -> None:
        metrics.inserts, metrics.updates, metrics.deletes = counts["ins"], counts["upd"], counts["del"]
        metrics.ignored, metrics.rejected = counts["other"], counts["bad"]
        # A micro-batch never comes again, and up to ``upper`` everything was read: all that is rejected goes aside now.
        whole = upper is not None or mine is not None
        position = upper or max(base.position, bytes.fromhex(counts["reached" if mine else "high"] or ""))
        rejected = None
        if counts["bad"]:
            bad = rejected_of(job, staged, counts["bad"])
            # Without an upper end later ones are read again with the next cycle.
            rejected = bad if whole else bad.where((F.col(REASON) == BAD_POSITION) | (_c(LSN) <= lsn_literal(position)))
            if mine is None:
                rejected = not_aside(job.store, job.table, rejected)
            if rejected.isEmpty():
                rejected = None
        if counts["n"] > counts["bad"]:
            good = cast_to(staged.where(F.col(REASON).isNull()).drop(REASON), base.columns)
            state = job.store.replay(
                job.table, good, position, mode=job.mode, order_by=job.order_by, rejected=rejected, batch=mine
            )
        elif rejected is not None or position > base.position:
            state = job.store.advance(job.table, position, rejected=rejected, batch=mine)
        else:
            return
        metrics.watermark = state.position
        if job.retain_hours is not None:
            job.store.prune(job.table, hours=job.retain_hours)

    return _timed(metrics, work, stop_on_error)


def follow_drift(job: TableJob) -> State:
    """Bring the target to the structure the source has now, and return it."""
    store = job.store
    if not hasattr(store, "evolve"):
        raise TypeError(f"{type(store).__name__} cannot change a table's structure")
    info = job.information_schema(job.spark) if job.information_schema else None
    if info is None:
        raise LookupError(f"{job.table}: the source does not tell its structure")
    known = {f.name: f for f in translate_schema(info)}
    # Of mapped columns those that the source still has.
    columns = [(t, s) for t, s in job.columns if s in known] if job.columns else [(n, n) for n in known]
    fields = [StructField(t, known[s].dataType, known[s].nullable, known[s].metadata) for t, s in columns]
    return store.evolve(job.table, StructType(fields))


def judge(job: TableJob, fresh: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """Changes under the target's column names, each with the reason against it."""
    columns = job.columns or [(c, c) for c in schema.names]
    if job.on_drift == "evolve":
        # Changes from before a column came, or after it went, do not have it.
        columns = [(t, s) for t, s in columns if t in schema.names]
        for target, source in columns:
            if source not in fresh.columns:
                fresh = fresh.withColumn(source, F.lit(None).cast(schema[target].dataType))
    order = [c for c in job.order_by or () if c in fresh.columns]
    extra = [c for c in (SEQ, *order) if c in fresh.columns and c not in (OP, LSN, *schema.names)]
    fresh = project_mapped(fresh, columns, keep=[OP, LSN, *dict.fromkeys(extra)])
    null_keys = "ignore" if job.mode == "bag" else "reject"
    return with_reason(fresh, schema, keys, other_ops="ignore", null_keys=null_keys)


def rejected_of(job: TableJob, staged: DataFrame, n: int) -> DataFrame:
    """The changes with a reason against them; an error if the job does not set them aside."""
    bad = staged.where(F.col(REASON).isNotNull())
    if job.on_error != "quarantine":
        # As many rows as the table has columns, at most.
        found = sorted(tuple(r) for r in bad.groupBy(REASON).count().collect())
        reasons = ", ".join(f"{reason} ({n})" for reason, n in found)
        raise RejectedChanges(f"{n} changes of {job.table} rejected: {reasons}")
    return bad


def not_aside(store: Target, table: str, rejected: DataFrame) -> DataFrame:
    """Without changes of a bad position that are aside already: polling meets them in every cycle."""
    held = store.quarantined(table)
    if held is None:
        return rejected
    columns = [c for c in rejected.columns if c in held.columns]

    def mark(df: DataFrame) -> Column:
        return F.sha2(F.to_json(F.struct(*[_c(c).cast("string").alias(c) for c in columns])), 256)

    known = held.where(F.col(REASON) == BAD_POSITION).select(mark(held).alias("__mark")).distinct()
    marked = rejected.withColumn("__mark", F.when(F.col(REASON) == BAD_POSITION, mark(rejected)))
    return marked.join(known, "__mark", "left_anti").drop("__mark")


def stage(spark: SparkSession, judged: DataFrame, path: str) -> tuple[DataFrame, dict]:
    """Write the judged changes once, counting on the way."""
    fine, op = F.col(REASON).isNull(), _c(OP)
    placed = F.octet_length(_c(LSN)) == LSN_BYTES
    seen = Observation()
    counted = judged.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.count_if(fine & (op == INSERT)).alias("ins"),
        F.count_if(fine & (op == UPDATE)).alias("upd"),
        F.count_if(fine & (op == DELETE)).alias("del"),
        F.count_if(fine & ~F.coalesce(op.isin(INSERT, UPDATE, DELETE), F.lit(False))).alias("other"),
        F.count_if(~fine).alias("bad"),
        F.max(F.when(fine, F.hex(_c(LSN)))).alias("high"),
        F.max(F.when(placed, F.hex(_c(LSN)))).alias("reached"),
    )
    staged = written(counted, "changes", reader=spark, path=path)
    return staged, seen.get


def run_tables(
    jobs: Sequence[TableJob], work: Callable[[TableJob], list[Metrics]], *, at_once: int = 4
) -> list[Metrics]:
    """Run one function per table, a few tables at a time, each in its own scheduler pool.

    The tasks of all tables share the cluster; a thread here only waits.
    """
    if not jobs:
        return []
    spark = jobs[0].spark

    def one(job: TableJob) -> list[Metrics]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", job.table)
        try:
            return work(job)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(jobs)))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(one), job) for job in jobs]
        return [m for f in futures for m in f.result()]


def run_cycle(jobs: Sequence[TableJob], *, at_once: int = 4) -> list[Metrics]:
    """One replay of every table; a failing table is reported and does not stop the others."""
    return run_tables(jobs, lambda job: [incremental_sync(job, stop_on_error=False)], at_once=at_once)


def run_once(
    jobs: Sequence[TableJob], *, full_refresh: bool = False, stop_on_error: bool = False, at_once: int = 4
) -> list[Metrics]:
    """First load where needed, then one replay, for every table."""

    def both(job: TableJob) -> list[Metrics]:
        first = initial_sync(job, full_refresh=full_refresh, stop_on_error=stop_on_error)
        if first.error:
            return [first]
        return [first, incremental_sync(job, stop_on_error=stop_on_error)]

    return run_tables(jobs, both, at_once=at_once)
