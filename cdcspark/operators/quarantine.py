"""Separate changes that can be applied from those that cannot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcspark.functions.lsn import APPLIED_OPS, DELETE, LSN, LSN_BYTES, OP
from cdcspark.operators.apply import _c

REASON = "__$reason"

#: Reasons that concern the position: missing or malformed, or passed by a stream before.
BAD_POSITION, LATE = "bad log position", "late log position"


def _cast(name: str, wanted: str) -> Column:
    return _c(name).try_cast(wanted)


def with_reason(
    changes: DataFrame,
    schema: StructType,
    keys: Sequence[str] = (),
    *,
    other_ops: str = "reject",
    null_keys: str = "reject",
) -> DataFrame:
    """Every change with the first reason against it, or null.

    Checked in this order: operation code, width of the position, null key,
    each column's cast to the target type, each column that may not be null. Of
    a delete only the key counts. ``other_ops="ignore"`` lets unknown operation
    codes pass, as a replay applies nothing for them; ``null_keys="ignore"``
    is for targets without a unique key.
    """
    verdict = None if other_ops == "ignore" else "unknown operation"
    reason = F.when(~F.coalesce(_c(OP).isin(*APPLIED_OPS), F.lit(False)), F.lit(verdict).cast("string"))
    width = F.octet_length(_c(LSN).cast("binary"))
    reason = reason.when(F.coalesce(width != LSN_BYTES, F.lit(True)), F.lit(BAD_POSITION))
    if null_keys != "ignore":
        for k in keys:
            reason = reason.when(_c(k).isNull(), F.lit(f"null key {k}"))
    have = dict(changes.dtypes)
    for f in schema.fields:
        wanted = f.dataType.simpleString()
        counts = F.lit(True) if f.name in keys else _c(OP) != DELETE
        if have[f.name] != wanted:
            lost = counts & _c(f.name).isNotNull() & _cast(f.name, wanted).isNull()
            reason = reason.when(lost, F.lit(f"{f.name} is not {wanted}"))
        if not f.nullable and f.name not in keys:
            reason = reason.when(counts & _c(f.name).isNull(), F.lit(f"{f.name} may not be null"))
    return changes.withColumn(REASON, reason)


def cast_to(changes: DataFrame, schema: StructType) -> DataFrame:
    """Bring the data columns to the target's types; other columns stay."""
    have = dict(changes.dtypes)
    wanted = {f.name: f.dataType.simpleString() for f in schema.fields}
    return changes.select(
        *[_cast(c, wanted[c]).alias(c) if wanted.get(c, have[c]) != have[c] else _c(c) for c in changes.columns]
    )


def quarantine_split(
    changes: DataFrame, schema: StructType, keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(changes cast to the target's types, rejected changes as they came with a reason)."""
    judged = with_reason(changes, schema, keys)
    good = cast_to(judged.where(F.col(REASON).isNull()).drop(REASON), schema)
    return good, judged.where(F.col(REASON).isNotNull())
