"""Moved keys in the difference of two snapshots: a row that went and one that came with the same content are one row under another key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcspark.functions.lsn import DELETE, INSERT, LSN, OP, SEQ, UPDATE, row_hash
from cdcspark.operators.apply import _c
from cdcspark.sources.splits import Splits, plan_splits

#: Columns with the key a moved row had before.
BEFORE = "__$before_"

#: Ranges of the key within which rows of one content are numbered.
RANGES = 64


def capture_moves(
    changes: DataFrame, keys: Sequence[str], *, columns: Sequence[str] | None = None, ranges: int = RANGES
) -> DataFrame:
    """A feed of captured changes whose deletes and inserts of equal content are updates that move a key.

    Equal content means equal values in ``columns``, by default all but the keys; nulls are equal. Where several rows that went and several that
    came have one content, they are paired in the order of their keys, the first with the first, and what is left on one side stays
    as it was. A move carries the new row, and the old key under ``__$before_<key>``; these columns are null in other changes, so
    ``expand_key_changes`` with them gives the replay its delete and insert back. Updates pass as they are.

    ``changes`` is read several times and has one row per key and kind, as ``capture_changes`` gives it. Rows are numbered
    per content and range of the key, so a content that very many rows have is spread over tasks.
    """
    keys = list(keys)
    columns = list(columns or [c for c in changes.columns if c not in (OP, LSN, SEQ, *keys)])
    if not columns:
        raise ValueError("without a column beside the key there is no content to compare")
    names = [c for c in changes.columns if c not in (OP, *keys)]
    before = [F.lit(None).cast(dict(changes.dtypes)[k]).alias(f"{BEFORE}{k}") for k in keys]
    splits = plan_splits(changes, keys, ranges)
    gone, come = (_numbered(changes.where(_c(OP) == op), keys, columns, splits) for op in (DELETE, INSERT))
    old = gone.select(
        F.col("__content").alias("__old_content"), F.col("__place").alias("__old_place"), *[_c(k).alias(f"{BEFORE}{k}") for k in keys],
        *[_c(c).alias(f"__old_{c}") for c in names],
    )
    same = _all([_c(c).eqNullSafe(F.col(f"`__old_{c}`")) for c in columns])
    on = (F.col("__content") == F.col("__old_content")) & (F.col("__place") == F.col("__old_place")) & same
    # The content is compared too, so rows that only share a hash stay apart.
    both = come.join(old, on, "full")
    here, there = F.col("__content").isNotNull(), F.col("__old_content").isNotNull()
    rows = both.select(
        F.when(here & there, UPDATE).when(here, INSERT).otherwise(DELETE).alias(OP),
        *[F.when(here, _c(k)).otherwise(F.col(f"`{BEFORE}{k}`")).alias(k) for k in keys],
        *[F.when(here, _c(c)).otherwise(F.col(f"`__old_{c}`")).alias(c) for c in names],
        *[F.when(here & there, F.col(f"`{BEFORE}{k}`")).alias(f"{BEFORE}{k}") for k in keys],
    )
    other = changes.where(~_c(OP).isin(DELETE, INSERT)).select("*", *before)
    return other.unionByName(rows.select(*[_c(c) for c in other.columns]))


def _all(conditions: Sequence[Column]) -> Column:
    found = conditions[0]
    for c in conditions[1:]:
        found = found & c
    return found


def _numbered(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], splits: Splits) -> DataFrame:
    """Rows with a hash of their content and their place, by key, among those of one content.

    The place is that inside a range of the key plus the rows of the ranges before it; of these there is one count per
    content and range.
    """
    marked = rows.withColumn("__content", row_hash(list(columns))).withColumn("__range", splits.number_of())
    sizes = marked.groupBy("__content", "__range").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy("__content").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__content", "__range", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__content", "__range").orderBy(*[_c(k).asc_nulls_first() for k in keys])
    placed = marked.withColumn("__row", F.row_number().over(inside)).join(starts, ["__content", "__range"])
    return placed.withColumn("__place", F.col("__start") + F.col("__row")).drop("__range", "__row", "__start")
