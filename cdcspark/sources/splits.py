"""Ranges of a key that together hold every row of a table exactly once.

A scan is split, or done chunk by chunk, along bounds of its key: one column or several, of any ordered type, with or without
nulls. Keys are ordered column by column, nulls first. A range goes from its lower bound, included, to its upper
bound, excluded; the first has no lower and the last no upper one. The two conditions at a bound are each other's complement for every
key, under any order the database gives its texts, so no row falls between two ranges or into both.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the sketch per range asked for. A bound is off by about 1 / sqrt(rows of the sketch) of the table.
SKETCH_ROWS = 100

#: Most rows of a sketch; they come to the driver.
SKETCH_LIMIT = 200_000

# How databases quote names, write binary literals and mark texts.
_QUOTES = {"sqlserver": "[{}]", "standard": '"{}"', "spark": "`{}`"}
_BINARY = {"sqlserver": "0x{}", "standard": "X'{}'", "spark": "X'{}'"}
_TEXT = {"sqlserver": "N'{}'", "standard": "'{}'", "spark": "'{}'"}
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "decimal", "float", "double")

Bound = tuple[str | None, ...]


@dataclass(frozen=True)
class Splits:
    """Key columns, their types and the ascending bounds between ranges; a bound is a tuple of values as text, null is None.

    ``n`` bounds make ``n`` + 1 ranges.
    """

    keys: tuple[str, ...]
    types: tuple[str, ...]
    bounds: tuple[Bound, ...]

    def __len__(self) -> int:
        return len(self.bounds) + 1

    def stored(self) -> dict:
        """For a JSON file; ``Splits.of`` reads it back."""
        return {"keys": list(self.keys), "types": list(self.types), "bounds": [list(b) for b in self.bounds]}

    @classmethod
    def of(cls, stored: Mapping) -> Splits:
        return cls(tuple(stored["keys"]), tuple(stored["types"]), tuple(tuple(b) for b in stored["bounds"]))

    # -- in Spark -----------------------------------------------------------

    def _value(self, column: int, text: str | None) -> Column:
        kind = self.types[column]
        if text is None:
            return F.lit(None).cast(kind)
        return F.unhex(F.lit(text)) if kind == "binary" else F.lit(text).cast(kind)

    def _reached(self, bound: Bound) -> Column:
        """True for keys at or behind a bound, false or null for the others."""
        found: Column | None = None
        for i in range(len(bound) - 1, -1, -1):
            key, value = F.col(f"`{self.keys[i]}`"), self._value(i, bound[i])
            if bound[i] is None:
                # Everything is behind a null but a null, for which the next column decides.
                found = None if found is None else key.isNotNull() | found
            elif found is None:
                found = key >= value
            else:
                found = (key > value) | ((key == value) & found)
        return F.lit(True) if found is None else found

    def _before(self, bound: Bound) -> Column:
        """True for keys before a bound, false or null for the others."""
        found: Column = F.lit(False)
        for i in range(len(bound) - 1, -1, -1):
            key, value = F.col(f"`{self.keys[i]}`"), self._value(i, bound[i])
            if bound[i] is None:
                found = key.isNull() & found
            else:
                found = key.isNull() | (key < value) | ((key == value) & found)
        return found

    def condition(self, number: int) -> Column:
        """What a row of range ``number`` fulfils; comparisons with literals, so they reach the scan."""
        return self.between(number, number)

    def between(self, first: int, last: int) -> Column:
        """What a row of one of the ranges from ``first`` to ``last`` fulfils."""
        parts = []
        if first > 0:
            parts.append(self._reached(self.bounds[first - 1]))
        if last < len(self.bounds):
            parts.append(self._before(self.bounds[last]))
        found = F.lit(True)
        for part in parts:
            found = found & part
        return found

    def number_of(self) -> Column:
        """The range of a row, for rows of all ranges at once; a key that does not fit its type counts as null."""
        key = F.struct(*[F.col(f"`{k}`").try_cast(t).alias(k) for k, t in zip(self.keys, self.types)])
        if not self.bounds:
            return F.lit(0)

        def reached(some: Sequence[Bound]) -> Column:
            return F.array(*[F.struct(*[self._value(i, v).alias(k) for i, (k, v) in enumerate(zip(self.keys, b))]) for b in some])

        # First among every so many bounds, then among those in between, so that a row is compared with few of them.
        step = max(1, math.isqrt(len(self.bounds)))
        behind = lambda b: b <= key
        passed = F.size(F.filter(reached(self.bounds[step - 1 :: step]), behind)) * step
        return passed + F.size(F.filter(F.slice(reached(self.bounds), passed + 1, F.lit(step)), behind))

    # -- in a database --------------------------------------------------------

    def _literal(self, column: int, text: str, dialect: str) -> str:
        kind = self.types[column]
        if kind == "binary":
            return _BINARY[dialect].format(text)
        if kind.startswith(_NUMBERS):
            return text
        if dialect == "spark":
            quoted = text.replace("\\", "\\\\").replace("'", "\\'")
            return f"'{quoted}'" if kind == "string" else f"CAST('{quoted}' AS {kind})"
        return (_TEXT[dialect] if kind == "string" else "'{}'").format(text.replace("'", "''"))

    def statement(self, number: int, *, dialect: str = "sqlserver", collation: str | None = None) -> str:
        """The condition of range ``number`` as SQL.

        ``collation`` is put behind text columns; name a binary one where Spark and the database must agree on the
        range of a key, as in a load by chunks. A plain scan does not need it.
        """

        def name(i: int) -> str:
            quoted = _QUOTES[dialect].format(self.keys[i])
            return f"{quoted} COLLATE {collation}" if collation and self.types[i] == "string" else quoted

        def reached(bound: Bound) -> str:
            found = ""
            for i in range(len(bound) - 1, -1, -1):
                if bound[i] is None:
                    found = f"({name(i)} IS NOT NULL OR {found})" if found else ""
                else:
                    value = self._literal(i, bound[i], dialect)
                    found = f"({name(i)} > {value} OR ({name(i)} = {value} AND {found}))" if found else f"{name(i)} >= {value}"
            return found

        def before(bound: Bound) -> str:
            found = ""
            for i in range(len(bound) - 1, -1, -1):
                if bound[i] is None:
                    # Nothing is before a null.
                    found = f"({name(i)} IS NULL AND {found})" if found else ""
                else:
                    value = self._literal(i, bound[i], dialect)
                    more = f" OR ({name(i)} = {value} AND {found})" if found else ""
                    found = f"({name(i)} IS NULL OR {name(i)} < {value}{more})"
            return found or "1 = 0"

        parts = []
        if number > 0:
            parts.append(reached(self.bounds[number - 1]))
        if number < len(self.bounds):
            parts.append(before(self.bounds[number]))
        return " AND ".join(p for p in parts if p) or "1 = 1"

    def statements(self, *, dialect: str = "sqlserver", collation: str | None = None) -> list[str]:
        return [self.statement(i, dialect=dialect, collation=collation) for i in range(len(self))]


def _as_text(column: str, kind: str) -> Column:
    value = F.col(f"`{column}`")
    return F.hex(value) if kind == "binary" else value.cast("string")


def key_texts(keys: Sequence[str], kinds: Sequence[str]) -> list[Column]:
    """The key columns' values in the form that bounds have."""
    return [_as_text(k, t).alias(f"k{i}") for i, (k, t) in enumerate(zip(keys, kinds))]


def sketched(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Keys of at most ``rows`` rows, drawn evenly: those whose hash is least.

    Each task keeps so many rows and no more, whatever the table's size; a sketch of a table's parts is the same as that of
    the whole. The hash is of a key and its place, so a key that many rows have is drawn as often as its share.
    """
    order = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.monotonically_increasing_id())
    return df.select(*[F.col(f"`{k}`") for k in keys], order.alias("__order")).orderBy("__order").limit(rows).drop("__order")


def plan_splits(df: DataFrame, keys: Sequence[str], parts: int, *, sketch_rows: int = SKETCH_ROWS) -> Splits:
    """At most ``parts`` ranges of about as many rows each, from a sketch of the key columns.

    One pass over the key columns; nothing is shuffled but the sketch. A key that holds more than a range's share of the rows gets
    one range, and there are fewer ranges.
    """
    if parts < 1:
        raise ValueError("a table has at least one range")
    types = dict(df.dtypes)
    kinds = tuple(types[k] for k in keys)
    wanted = min(parts * sketch_rows, SKETCH_LIMIT)
    drawn = sketched(df, keys, wanted)
    # Sorted by Spark, whose order of keys is the one the conditions have.
    ordered = drawn.orderBy(*[F.col(f"`{k}`").asc_nulls_first() for k in keys])
    rows = [tuple(r) for r in ordered.select(*key_texts(keys, kinds)).collect()]
    return _bounds(rows, parts, keys, kinds)


def _bounds(rows: Sequence[Bound], parts: int, keys: Sequence[str], kinds: Sequence[str]) -> Splits:
    """Quantiles of sorted keys, each once; the least key is no bound, as nothing is before it."""
    found: list[Bound] = []
    for i in range(1, parts):
        at = i * len(rows) // parts
        if at < len(rows) and rows[at] != rows[0] and (not found or rows[at] != found[-1]):
            found.append(rows[at])
    return Splits(tuple(keys), tuple(kinds), tuple(found))


def boundary_statement(table: str, keys: Sequence[str], parts: int, *, dialect: str = "sqlserver") -> str:
    """Keys that cut a table into ``parts`` ranges, as the database finds them along an index; no row leaves it but these."""
    names = ", ".join(_QUOTES[dialect].format(k) for k in keys)
    return (
        f"SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS place, COUNT(*) OVER () AS total "
        f"FROM {table}) numbered WHERE place > 1 AND (place - 1) * {parts} % total < {parts}"
    )


def splits_of_bounds(bounds: DataFrame, keys: Sequence[str]) -> Splits:
    """Ranges from the rows of a ``boundary_statement``."""
    types = dict(bounds.dtypes)
    kinds = tuple(types[k] for k in keys)
    ordered = bounds.select(*[F.col(f"`{k}`") for k in keys]).distinct().orderBy(*[F.col(f"`{k}`").asc_nulls_first() for k in keys])
    rows = ordered.select(*key_texts(keys, kinds)).collect()
    # A key of nulls only has nothing before it.
    return Splits(tuple(keys), kinds, tuple(tuple(r) for r in rows if any(v is not None for v in r)))
