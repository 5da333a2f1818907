"""What became of a table's structure, and whether the target can follow without being loaded again.

Types form a lattice: a type widens into another if that one holds all its values. Columns may be added, dropped and widened, and
may begin or cease to allow nulls. A column of a type that does not hold the old one's values is narrowed, and refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from cdcspark.plans.schema import spark_type

ADDED, DROPPED, WIDENED, NARROWED, RELAXED, TIGHTENED, SAME = (
    "added", "dropped", "widened", "narrowed", "allows nulls", "refuses nulls", "same"
)

#: The verdict that no target can follow without losing values. A target may go on to allow nulls that the source refuses.
REFUSED = (NARROWED,)

#: Each type and what it widens into in one step; decimals and text come on top of it.
STEPS = {
    "tinyint": ["smallint"],
    "smallint": ["int", "float"],
    "int": ["bigint", "double"],
    "bigint": [],
    "float": ["double"],
    "date": ["timestamp_ntz"],
}

#: Digits before the point that whole numbers need.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


class SchemaRefused(RuntimeError):
    """A change of structure that would lose values."""


@dataclass(frozen=True)
class ColumnChange:
    name: str
    verdict: str
    old: str | None
    new: str | None


def widened_types() -> dict[str, list[str]]:
    """For each type of ``STEPS`` all it widens into, over any number of steps."""
    found: dict[str, list[str]] = {}
    for kind in STEPS:
        reached, todo = [], list(STEPS[kind])
        while todo:
            step = todo.pop(0)
            if step not in reached:
                reached.append(step)
                todo += STEPS.get(step, [])
        found[kind] = reached
    return found


def widens(old: str, new: str) -> Column:
    """Whether the type in column ``old`` widens into that in column ``new`` (type names as DDL); all types widen into text but binary."""
    first, second = F.col(old), F.col(new)
    holds = F.lit(False)
    for kind, into in widened_types().items():
        holds = holds | ((first == kind) & second.isin(*into)) if into else holds
    pattern = r"^decimal\((\d+),(\d+)\)$"

    def digits(column: Column, group: int) -> Column:
        return F.regexp_extract(column, pattern, group).try_cast("int")

    places, scale = digits(second, 1) - digits(second, 2), digits(second, 2)
    old_places = digits(first, 1) - digits(first, 2)
    whole = F.lit(None).cast("int")
    for kind, n in _DIGITS.items():
        whole = F.when(first == kind, n).otherwise(whole)
    decimal = F.coalesce(whole <= places, F.lit(False)) | F.coalesce((old_places <= places) & (digits(first, 2) <= scale), F.lit(False))
    text = (second == "string") & (first != "binary")
    return (first != second) & (holds | (second.rlike(pattern) & decimal) | text)


def drift(old: DataFrame, new: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column of two information schemas what became of it: ``column_name``, ``verdict``, ``old_type``, ``new_type``.

    ``by`` names columns that tell tables apart, to compare many at once. Columns are matched by name.
    """

    def side(info: DataFrame, mark: str) -> DataFrame:
        return info.select(
            *[F.col(b) for b in by], F.col("COLUMN_NAME").alias("column_name"), spark_type(info).alias(f"{mark}_type"),
            (F.col("IS_NULLABLE") != "NO").alias(f"{mark}_null"),
        )

    both = side(old, "old").join(side(new, "new"), [*by, "column_name"], "full")
    return both.select(*by, "column_name", verdict().alias("verdict"), "old_type", "new_type")


def verdict() -> Column:
    """The verdict on rows (old_type, old_null, new_type, new_null)."""
    return (
        F.when(F.col("old_type").isNull(), ADDED)
        .when(F.col("new_type").isNull(), DROPPED)
        .when((F.col("old_type") != F.col("new_type")) & ~widens("old_type", "new_type"), NARROWED)
        .when(F.col("old_null") & ~F.col("new_null"), TIGHTENED)
        .when(F.col("old_type") != F.col("new_type"), WIDENED)
        .when(~F.col("old_null") & F.col("new_null"), RELAXED)
        .otherwise(SAME)
    )


def column_changes(df: DataFrame, old: StructType, new: StructType) -> list[ColumnChange]:
    """The same for two schemas, in the new one's order and then the dropped columns; ``df`` lends its session."""
    before, after = {f.name: f for f in old}, {f.name: f for f in new}
    names = [*after, *[n for n in before if n not in after]]
    rows = []
    for i, n in enumerate(names):
        a, b = before.get(n), after.get(n)
        rows.append((i, n, _ddl(a), a.nullable if a else None, _ddl(b), b.nullable if b else None))
    schema = "pos int, name string, old_type string, old_null boolean, new_type string, new_null boolean"
    judged = df.sparkSession.createDataFrame(rows, schema).select("pos", "name", verdict().alias("verdict"), "old_type", "new_type")
    return [ColumnChange(r["name"], r["verdict"], r["old_type"], r["new_type"]) for r in judged.orderBy("pos").collect()]


def _ddl(f: StructField | None) -> str | None:
    return None if f is None else _name(f.dataType)


def _name(kind: DataType) -> str:
    return f"decimal({kind.precision},{kind.scale})" if isinstance(kind, DecimalType) else kind.simpleString()


def followed(changes: Sequence[ColumnChange], keys: Sequence[str]) -> list[ColumnChange]:
    """The changes a target has to follow; an error names those it cannot."""
    bad = [c for c in changes if c.verdict in REFUSED or (c.verdict == DROPPED and c.name in keys)]
    if bad:
        told = ", ".join(f"{c.name} {c.verdict} ({c.old} to {c.new})" for c in bad)
        raise SchemaRefused(f"the table has to be loaded again: {told}")
    return [c for c in changes if c.verdict != SAME]
