"""Replay a change feed on a target as one set-based job.

The three modes give the result of replaying the changes one by one in log
order, expressed with aggregates that combine before the shuffle, so a key with
very many changes never has to be sorted or collected in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcspark.functions.lsn import APPLIED_OPS, DELETE, INSERT, LSN, OP, SEQ, SYNC, UPDATE, lsn_literal, pad_lsn
from cdcspark.operators.skew import hot_keys, lookup_join

MODES = ("upsert", "strict", "bag")
_POS, _ROW, _HASH = "__pos", "__row", "__hash"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def data_columns(df: DataFrame) -> list[str]:
    """Columns of a table without the sync column, in order."""
    return [c for c in df.columns if c != SYNC]


def to_types(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``df`` that ``schema`` has too, in its types; a value that does not fit raises an error.

    Keys are hashed and compared by type, so this comes before anything else.
    Other columns stay.
    """
    have, wanted = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in schema.fields}

    def column(name: str) -> Column:
        kind = wanted.get(name, have[name])
        if kind == have[name]:
            return _c(name)
        cast = _c(name).try_cast(kind)
        lost = _c(name).isNotNull() & cast.isNull()
        return F.when(lost, F.raise_error(f"a value of {name} is no {kind}")).otherwise(cast).alias(name)

    return df.select(*[column(c) for c in df.columns])


def order_columns(changes: DataFrame, order_by: Sequence[str] | None) -> list[str]:
    if order_by:
        return list(order_by)
    return [LSN, SEQ] if SEQ in changes.columns else [LSN]


def has_key(keys: Sequence[str]) -> Column:
    """True where no key column is null: ``= NULL`` matches nothing."""
    present = _c(keys[0]).isNotNull()
    for k in keys[1:]:
        present = present & _c(k).isNotNull()
    return present


def is_applied() -> Column:
    return _c(OP).isin(*APPLIED_OPS)


def positioned(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys, operation, position, row hash and row image of every change."""
    image = F.struct(*[_c(c) for c in columns])
    return changes.select(
        *[_c(k) for k in keys],
        _c(OP).alias(OP),
        F.struct(*[_c(c) for c in order]).alias(_POS),
        F.xxhash64(_c(OP), *[_c(c) for c in columns], *[_c(c).isNull() for c in columns]).alias(_HASH),
        image.alias(_ROW),
    )


def _entry(*extra: str) -> Column:
    return F.struct(_c(_POS), _c(_HASH), *[_c(e) for e in extra])


def _twin() -> Column:
    """Mirror of an entry: among equal positions it ranks the hashes the other way."""
    return F.struct(_c(_POS), F.bitwise_not(_c(_HASH)).alias(_HASH))


def _checked(value: Column, ambiguous: Column, what: str) -> Column:
    message = f"two different changes of one key share a log position ({what}); name a sequence column in order_by"
    return F.when(F.coalesce(ambiguous, F.lit(False)), F.raise_error(message)).otherwise(value)


def _disagree(best: str, twin: str) -> Column:
    """Two entries at the same best position hold different rows."""
    return _c(best)[_HASH] != F.bitwise_not(_c(twin)[_HASH])


def last_changes(
    changes: DataFrame, keys: Sequence[str], *, columns: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """The last applied change of each key: ``__$operation`` and the row image.

    ``max`` over (position, hash, image) merges in the map tasks, so each task
    sends at most one row per key. Exact repeats of a change are harmless;
    different changes at one position raise an error.
    """
    order = order_columns(changes, order_by)
    rest = [c for c in columns if c not in keys]
    events = positioned(changes.where(is_applied() & has_key(keys)), keys, rest or keys, order)
    best = events.groupBy(*[_c(k) for k in keys]).agg(
        F.max(_entry(OP, _ROW)).alias("__best"), F.max(_twin()).alias("__twin")
    )
    checked = _checked(F.col("__best"), _disagree("__best", "__twin"), "last change")
    return best.select(*[_c(k) for k in keys], checked.alias("__best")).select(
        f"__best.`{OP}`", *[_c(c) if c in keys else F.col(f"__best.{_ROW}.`{c}`") for c in columns]
    )


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    *,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    mode: str = "upsert",
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Target rows after replaying ``changes`` (operation, position, columns).

    ``mode``

    * ``upsert``: the last change of a key wins. Replaying twice, or replaying
      changes the target already holds, gives the same rows.
    * ``strict``: an insert counts only if the key is absent, an update or
      delete only if it is present. For targets with a unique key.
    * ``bag``: no unique key. Inserts always append, an update sets every row
      of the key, a delete drops them all.

    ``keys=None`` takes the first column. ``order_by`` defaults to the log
    position and, if there is one, the sequence column. Rows with a null key:
    inserts append, updates and deletes match nothing. Other operation codes
    change nothing.

    Keys and data of the changes are brought to the target's types first; a
    value that does not fit raises an error.

    ``hot`` lists hashes of hot keys (see ``hot_keys``); left out, ``strict``
    looks for them among the inserts, ``bag`` and first-column keys among the
    target rows too. That look runs a job when this function is called.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    columns = data_columns(target)
    guessed = keys is None
    keys = [columns[0]] if guessed else list(keys)
    order = order_columns(changes, order_by)
    target = target.select(*[_c(c) for c in columns])
    changes = to_types(changes, target.schema)
    if mode == "bag":
        return _apply_bag(target, changes, keys, columns, order, hot)
    if mode == "strict":
        kept = _apply_strict(target, changes, keys, columns, order, hot)
    else:
        if hot is None:
            hot = hot_keys(target, keys) if guessed else ()
        kept = merge_last(target, last_changes(changes, keys, columns=columns, order_by=order), keys, hot=hot)
    orphans = changes.where((_c(OP) == INSERT) & ~has_key(keys)).select(*[_c(c) for c in columns])
    return kept.unionByName(orphans)


def merge_last(target: DataFrame, last: DataFrame, keys: Sequence[str], *, hot: Sequence[int] = ()) -> DataFrame:
    """Replace the target rows of changed keys by their last image.

    ``last`` has one row per key. The anti join only looks at its keys: if they
    are few the planner broadcasts them and the target is not shuffled.
    """
    columns = data_columns(target)
    changed = last.select(*[_c(k) for k in keys])
    untouched = lookup_join(target.select(*[_c(c) for c in columns]), changed, keys, "left_anti", hot)
    return untouched.select(*[_c(c) for c in columns]).unionByName(
        last.where(_c(OP) != DELETE).select(*[_c(c) for c in columns])
    )


def _key_fates(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: position of the last delete and the last update with its image."""
    is_update = _c(OP) == UPDATE
    return (
        events.groupBy(*[_c(k) for k in keys])
        .agg(
            F.max(F.when(_c(OP) == DELETE, _c(_POS))).alias("__deleted"),
            F.max(F.when(is_update, _entry(_ROW))).alias("__updated"),
            F.max(F.when(is_update, _twin())).alias("__twin"),
        )
        .select(
            *[_c(k) for k in keys],
            "__deleted",
            _checked(F.col("__updated"), _disagree("__updated", "__twin"), "last update").alias("__updated"),
        )
    )


def _survivors(
    births: DataFrame, fates: DataFrame, keys: Sequence[str], hot: Sequence[int]
) -> DataFrame:
    """Rows born after the key's last delete, each with its value at the end of the log.

    ``births`` have a position, or none if they were there before the log.
    """
    joined = lookup_join(births, fates, keys, "left", hot)
    tied = (F.col(_POS) == F.col("__deleted")) | (F.col(_POS) == F.col("__updated")[_POS])
    later = F.col("__updated").isNotNull() & (F.col(_POS).isNull() | (F.col("__updated")[_POS] > F.col(_POS)))
    value = F.when(later, F.col("__updated")[_ROW]).otherwise(F.col(_ROW))
    return joined.where(F.col("__deleted").isNull() | (F.col(_POS) >= F.col("__deleted"))).select(
        *[_c(k) for k in keys],
        _POS,
        F.col("__deleted").isNull().alias("__never_deleted"),
        _checked(value, tied, "insert").alias(_ROW),
    )


def _old_rows(target: DataFrame, keys: Sequence[str], columns: Sequence[str], inserts: DataFrame) -> DataFrame:
    """Target rows as births without a position."""
    return target.select(
        *[_c(k) for k in keys],
        F.lit(None).cast(inserts.schema[_POS].dataType).alias(_POS),
        F.struct(*[_c(c) for c in columns]).alias(_ROW),
    )


def _apply_bag(target, changes, keys, columns, order, hot) -> DataFrame:
    events = positioned(changes.where(is_applied()), keys, columns, order)
    fates = _key_fates(events.where((_c(OP) != INSERT) & has_key(keys)), keys)
    inserts = events.where(_c(OP) == INSERT).select(*[_c(k) for k in keys], _POS, _ROW)
    births = _old_rows(target, keys, columns, inserts).unionByName(inserts)
    if hot is None:
        hot = hot_keys(births, keys)
    return _survivors(births, fates, keys, hot).select(f"{_ROW}.*")


def _apply_strict(target, changes, keys, columns, order, hot) -> DataFrame:
    """Only the first birth after a key's last delete counts.

    A target row is the first birth of its key, so it stays unless the key was
    deleted. Of the inserts the first one after the last delete counts, where
    the target row is not still there. The target is read twice, the second
    time its keys only.
    """
    events = positioned(changes.where(is_applied() & has_key(keys)), keys, columns, order)
    inserts = events.where(_c(OP) == INSERT).select(*[_c(k) for k in keys], _POS, _ROW)
    if hot is None:
        hot = hot_keys(inserts, keys)
    fates = _key_fates(events.where(_c(OP) != INSERT), keys)
    kept = _survivors(_old_rows(target, keys, columns, inserts), fates, keys, ())
    born = _survivors(inserts, fates, keys, hot).withColumn(_HASH, F.xxhash64(F.col(_ROW)))
    first = born.groupBy(*[_c(k) for k in keys]).agg(
        F.min(_entry(_ROW)).alias("__first"), F.min(_twin()).alias("__twin"), F.max("__never_deleted").alias("__never_deleted")
    )
    new = first.select(
        *[_c(k) for k in keys],
        "__never_deleted",
        _checked(F.col("__first"), _disagree("__first", "__twin"), "insert").alias("__first"),
    )
    on = [F.col(f"__there_{i}") == _c(k) for i, k in enumerate(keys)]
    names = [_c(k).alias(f"__there_{i}") for i, k in enumerate(keys)]
    there = target.select(*names).join(inserts.select(*[_c(k) for k in keys]).distinct(), on, "left_semi")
    new = new.join(there, [*on, F.col("__never_deleted")], "left_anti")
    return kept.select(f"{_ROW}.*").unionByName(new.select(f"__first.{_ROW}.*"))


def expand_key_changes(changes: DataFrame, keys: Sequence[str], before: Mapping[str, str]) -> DataFrame:
    """Turn an update that moves a row to another key into delete plus insert.

    ``before`` names, per key column, the column with the value before the
    update. Without it such an update would leave the old row behind.
    """
    columns = [c for c in changes.columns if c not in before.values()]
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~_c(k).eqNullSafe(_c(before[k]))
    moved = (_c(OP) == UPDATE) & moved

    def image(op: Column, source: Mapping[str, str]) -> Column:
        return F.struct(*[(op.cast("int") if c == OP else _c(source.get(c, c))).alias(c) for c in columns])

    now = image(F.when(moved, F.lit(INSERT)).otherwise(_c(OP)), {})
    gone = image(F.lit(DELETE), {k: before[k] for k in keys})
    return changes.select(F.explode(F.when(moved, F.array(gone, now)).otherwise(F.array(now))).alias("e")).select("e.*")


def new_watermark(changes: DataFrame, old: bytes | None) -> bytes:
    """Position after a replay: the larger of the old one and the changes' highest."""
    high = changes.agg(F.max(_c(LSN)).alias("high")).first()["high"]
    return max(pad_lsn(old), pad_lsn(high))


def watermark_after(changes: DataFrame, old: bytes | None) -> DataFrame:
    """``new_watermark`` as a one-row table, for use inside a larger query."""
    return changes.agg(F.greatest(lsn_literal(old), F.coalesce(F.max(_c(LSN)), lsn_literal(None))).alias(SYNC))
