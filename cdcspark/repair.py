"""Changes that were set aside, repaired and put back in their place.

A repaired change comes after changes that were replayed without it. It may only count if nothing newer touched its key;
else the key already has a later state, and the change is outdated. The store notes the last position of every key it
changes while something is set aside. What happened to a key before that is asked of the change table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark.functions.lsn import LSN, OP, SEQ, lsn_literal
from cdcspark.jobs import TableJob
from cdcspark.operators.apply import _c
from cdcspark.operators.quarantine import REASON, cast_to, with_reason
from cdcspark.plans.mapping import project_mapped
from cdcspark.session import scratch, written
from cdcspark.sinks.store import Version, last_positions
from cdcspark.sources.changes import changes_since, misplaced

#: Tells a rejected change through its repair.
REJECT = "__$reject"


@dataclass(frozen=True)
class Repair:
    """How many of the changes set aside were applied, how many were outdated, and how many stay."""

    applied: int = 0
    outdated: int = 0
    remaining: int = 0


def replay_quarantine(job: TableJob, repair: Callable[[DataFrame], DataFrame]) -> Repair:
    """Offer all changes set aside to ``repair`` and apply those it mends.

    ``repair`` takes and returns rows under the target's column names, as they came, with their reason and ``__$reject``,
    which has to stay. Rows that it leaves out, or that are still no proper changes, stay aside as they were. It may return rows unchanged:
    one that only came too late has nothing to mend. Applied and outdated ones leave the quarantine by the commit
    that applies the former, so a run that dies has done nothing.

    A change is outdated if a later one of its key was applied, or if the whole table was loaded at its position or later. Of two
    at one position, without sequence numbers to tell, the one already applied counts as later.
    """
    store, spark = job.store, job.spark
    if not hasattr(store, "settle"):
        raise TypeError(f"{type(store).__name__} does not note which keys its commits change")
    held = store.quarantined(job.table)
    if held is None:
        return Repair()
    base = store.current(job.table)
    with scratch(spark, "repair") as path:
        held = written(held.drop("commit").withColumn(REJECT, F.expr("uuid()")), "held", path=f"{path}/held")
        offered = repair(held)
        if REJECT not in offered.columns:
            raise ValueError(f"a repair keeps the column {REJECT}")
        judged = _judged(job, offered, base)
        good = written(judged.where(F.col(REASON).isNull()).drop(REASON), "good", path=f"{path}/good")
        verdicts = written(_with_newer(job, good, held, base), "verdicts", path=f"{path}/verdicts")
        fresh = verdicts.where("NOT newer").drop("newer")
        applied, mended = fresh.count(), good.count()
        remaining = held.join(good.select(REJECT), REJECT, "left_anti").drop(REJECT)
        left = remaining.count()
        if mended:
            store.settle(
                job.table, fresh.drop(REJECT) if applied else None, remaining if left else None, mode=job.mode, order_by=job.order_by
            )
    return Repair(applied, mended - applied, left)


def _judged(job: TableJob, offered: DataFrame, base: Version) -> DataFrame:
    """The repaired changes judged like any others; they have the target's names already. One returned twice counts once."""
    kept = offered.drop(REASON).dropDuplicates([REJECT])
    null_keys = "ignore" if job.mode == "bag" else "reject"
    judged = with_reason(kept, base.columns, base.keys, other_ops="ignore", null_keys=null_keys)
    return cast_to(judged, base.columns)


def _with_newer(job: TableJob, good: DataFrame, held: DataFrame, base: Version) -> DataFrame:
    """Changes with whether something newer touched their key."""
    touched = job.store.touched(job.table)
    early = _before_tracking(job, good, held, base)
    if early is not None:
        touched = early if touched is None else last_positions(touched.unionByName(early), base.keys, applied=False)
    loaded = _c(LSN) <= lsn_literal(bytes.fromhex(base.loaded))
    if touched is None:
        return good.withColumn("newer", loaded)
    names = [_c(k).alias(f"__key_{i}") for i, k in enumerate(base.keys)]
    last = touched.select(*names, _c(LSN).alias("__last"), _c(SEQ).cast("long").alias("__seq"))
    # A null key is no key: nothing else concerns such a row.
    on = [_c(k) == F.col(f"__key_{i}") for i, k in enumerate(base.keys)]
    own = _c(SEQ).cast("long") if SEQ in good.columns else F.lit(None).cast("long")
    later = (F.col("__last") > _c(LSN)) | ((F.col("__last") == _c(LSN)) & F.coalesce(F.col("__seq") >= own, F.lit(True)))
    joined = good.join(last, on, "left")
    return joined.select(*[_c(c) for c in good.columns], (loaded | F.coalesce(later, F.lit(False))).alias("newer"))


def _before_tracking(job: TableJob, good: DataFrame, held: DataFrame, base: Version) -> DataFrame | None:
    """Last positions of keys from the change table, for changes older than what the store noted.

    The change table has those set aside too; they were not applied and do not count.
    """
    since = bytes.fromhex(base.tracked) if base.tracked else base.position
    first = good.where(_c(LSN) < lsn_literal(since)).agg(F.min(_c(LSN)).alias("lsn")).first()["lsn"]
    if first is None:
        return None
    floor = job.retained_from(job.spark) if job.retained_from else None
    feed = job.changes(job.spark, bytes(first)) if job.changes else None
    if feed is None or (floor is not None and floor > bytes(first)):
        raise LookupError(f"the change table of {job.table} does not go back to {bytes(first).hex()}; load the table again")
    columns = job.columns or [(c, c) for c in base.columns.names]
    picked = [(t, s) for t, s in columns if t in base.keys]
    extra = [SEQ] if SEQ in feed.columns else []
    part = project_mapped(misplaced(changes_since(feed, bytes(first), upto=since), others=True), picked, keep=[OP, LSN, *extra])
    part = cast_to(part, base.columns)
    marks = [*base.keys, LSN, *[c for c in extra if c in held.columns]]
    names = cast_to(held.select(*[_c(c) for c in marks]), base.columns).distinct()
    names = names.select(*[_c(c).alias(f"__aside_{i}") for i, c in enumerate(marks)])
    match = F.lit(True)
    for i, c in enumerate(marks):
        match = match & _c(c).eqNullSafe(F.col(f"__aside_{i}"))
    return last_positions(part.join(names, match, "left_anti"), base.keys)
