"""Comparing two tables by checksums of key ranges, so that only ranges that differ are looked into.

Both ends add up a hash of their rows per range of the key. Where count and sum agree the range is equal. The others are cut into smaller
ranges and compared again, until what is left is small; only those rows are then read and compared key by key. An end in a
database adds up by itself: of a table with few differences, some kilobytes per level and the rows of a few ranges leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark.functions.lsn import row_hash
from cdcspark.operators.apply import _c, data_columns
from cdcspark.operators.feed import EQUAL, _common, reconcile
from cdcspark.sources.snapshot import read_snapshot
from cdcspark.sources.splits import Bound, Splits, key_texts, plan_splits, sketched

#: Ranges of the first level, and of a range that differs, on the next.
PARTS, FANOUT = 256, 16

#: Ranges with so many rows, on the larger side, are read instead of being cut further.
LEAF_ROWS = 100_000


@dataclass(frozen=True)
class Level:
    """What one level of a comparison looked at: ranges and rows on the source's side, of these the ones that differ."""

    ranges: int
    rows: int
    differing: int
    differing_rows: int


class End(Protocol):
    """A table on one side of a comparison."""

    def checksums(self, splits: Splits, active: Sequence[int]) -> DataFrame:
        """Rows (number, n, total) of the active ranges that are not empty."""

    def rows(self, splits: Splits, active: Sequence[int]) -> DataFrame:
        """The rows of the active ranges."""


def inside(splits: Splits, active: Sequence[int]) -> Column:
    """Rows of some ranges; neighbouring ranges are one condition, so it is short and reaches the scan."""
    found = F.lit(False)
    for first, last in _stretches(active):
        found = found | splits.between(first, last)
    return found


def _stretches(active: Sequence[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for number in sorted(active):
        if out and out[-1][1] == number - 1:
            out[-1][1] = number
        else:
            out.append([number, number])
    return [(a, b) for a, b in out]


def portable_hash(columns: Sequence[str]) -> Column:
    """A row's hash that databases can compute too: 60 bits of the MD5 of its values' texts, nulls marked."""
    texts = [F.coalesce(F.concat(F.lit("="), _c(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts).cast("binary")), 1, 15), 16, 10).cast("bigint")


@dataclass
class FrameEnd:
    """A table that Spark reads."""

    df: DataFrame
    hashed: Column

    def checksums(self, splits: Splits, active: Sequence[int]) -> DataFrame:
        rows = self.df.where(inside(splits, active)).select(
            splits.number_of().alias("number"), self.hashed.cast("decimal(26,0)").alias("hash")
        )
        return rows.groupBy("number").agg(F.count(F.lit(1)).alias("n"), F.sum("hash").alias("total"))

    def rows(self, splits: Splits, active: Sequence[int]) -> DataFrame:
        return self.df.where(inside(splits, active))


# 60 bits of an MD5 as a number, and a value's text, by database.
_HASHES = {
    "sqlserver": "CAST(CONVERT(BIGINT, SUBSTRING(HASHBYTES('MD5', {}), 1, 8)) / 16 & 0xFFFFFFFFFFFFFFF AS DECIMAL(38, 0))",
    "mysql": "CAST(CONV(SUBSTRING(MD5({}), 1, 15), 16, 10) AS DECIMAL(38, 0))",
    "spark": "CAST(CONV(SUBSTRING(MD5({}), 1, 15), 16, 10) AS DECIMAL(38, 0))",
}
_TEXTS = {"sqlserver": "CONVERT(VARCHAR(MAX), {})", "mysql": "CAST({} AS CHAR)", "spark": "CAST({} AS STRING)"}
_NAMES = {"sqlserver": "[{}]", "mysql": "`{}`", "spark": "`{}`"}


@dataclass
class DatabaseEnd:
    """A table of a database that adds up its own ranges; compare it with a ``FrameEnd`` of ``portable_hash`` or another such end.

    ``texts`` gives the SQL for columns whose text the database would write in another way than Spark does (dates, fractions).
    ``collation`` is a binary one for text keys, so that both ends agree on the range of a key.
    """

    spark: SparkSession
    options: Mapping[str, str]
    table: str
    columns: Sequence[str]
    dialect: str = "sqlserver"
    texts: Mapping[str, str] = field(default_factory=dict)
    collation: str | None = None

    def hashed(self) -> str:
        parts = []
        for c in self.columns:
            text = self.texts.get(c) or _TEXTS[self.dialect].format(_NAMES[self.dialect].format(c))
            parts.append(f"COALESCE(CONCAT('=', {text}), '-')" if self.dialect != "sqlserver" else f"COALESCE('=' + {text}, '-')")
        joined = ", '|', ".join(parts)
        return _HASHES[self.dialect].format(f"CONCAT({joined})" if len(parts) > 1 else parts[0])

    def _statement(self, splits: Splits, number: int) -> str:
        return splits.statement(number, dialect=self.dialect, collation=self.collation)

    def checksum_statement(self, splits: Splits, active: Sequence[int]) -> str:
        cases = " ".join(f"WHEN {self._statement(splits, i)} THEN {i}" for i in sorted(active))
        return (
            f"SELECT number, COUNT(*) AS n, SUM(hash) AS total FROM (SELECT CASE {cases} END AS number, {self.hashed()} AS hash "
            f"FROM {self.table}) hashed WHERE number IS NOT NULL GROUP BY number"
        )

    def checksums(self, splits: Splits, active: Sequence[int]) -> DataFrame:
        found = read_snapshot(self.spark, "jdbc", {**self.options, "query": self.checksum_statement(splits, active)})
        return found.select(F.col("number").cast("int"), F.col("n").cast("bigint"), F.col("total").cast("decimal(38,0)"))

    def rows(self, splits: Splits, active: Sequence[int]) -> DataFrame:
        reader = self.spark.read.options(**{k: v for k, v in self.options.items() if k != "url"})
        predicates = [self._statement(splits, i) for i in sorted(active)]
        return reader.jdbc(self.options["url"], self.table, predicates=predicates)


def reconcile_ranges(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    columns: Sequence[str] | None = None,
    parts: int = PARTS,
    fanout: int = FANOUT,
    leaf_rows: int = LEAF_ROWS,
    on_level: Callable[[Level], None] | None = None,
) -> DataFrame:
    """The keys that ``reconcile`` does not find equal, with the same columns.

    Runs one small aggregate per level when it is called; the result then reads the ranges that differ.
    """
    columns = list(columns or data_columns(source))
    left, right = _common(source, target, list(dict.fromkeys([*keys, *columns])))
    hashed = row_hash(columns)
    return reconcile_ends(
        FrameEnd(left, hashed), FrameEnd(right, hashed), left, keys, columns=columns, parts=parts, fanout=fanout, leaf_rows=leaf_rows,
        on_level=on_level,
    )


def reconcile_ends(
    source: End,
    target: End,
    sample: DataFrame,
    keys: Sequence[str],
    *,
    columns: Sequence[str] | None = None,
    parts: int = PARTS,
    fanout: int = FANOUT,
    leaf_rows: int = LEAF_ROWS,
    on_level: Callable[[Level], None] | None = None,
) -> DataFrame:
    """``reconcile_ranges`` of any two ends. ``sample`` has the keys that ranges are cut by, such as a replica that Spark reads."""
    splits = plan_splits(sample, keys, parts)
    active = list(range(len(splits)))
    while True:
        found = _differing(source, target, splits, active)
        differing = [r["number"] for r in found if r["differs"]]
        rows = {r["number"]: max(r["n"], r["m"]) for r in found}
        total, left = sum(rows.values()), sum(rows[i] for i in differing)
        if on_level:
            on_level(Level(len(active), total, len(differing), left))
        # Cutting further pays while it leaves out at least half of what would be read.
        if not differing or left <= leaf_rows or left * 2 > total:
            break
        finer, inner = _cut(sample, keys, splits, differing, fanout)
        if len(inner) == len(differing):
            break
        splits, active = finer, inner
    if not differing:
        return reconcile(sample.limit(0), sample.limit(0), keys, columns=columns)
    compared = reconcile(source.rows(splits, differing), target.rows(splits, differing), keys, columns=columns)
    return compared.where(F.col("status") != EQUAL)


def _differing(source: End, target: End, splits: Splits, active: Sequence[int]) -> list:
    """Per active range its rows on both sides and whether it differs; as many rows as there are ranges come to the driver."""
    theirs = target.checksums(splits, active).select("number", F.col("n").alias("m"), F.col("total").alias("other"))
    both = source.checksums(splits, active).join(theirs, "number", "full")
    differs = ~(F.col("n").eqNullSafe(F.col("m")) & F.col("total").eqNullSafe(F.col("other")))
    return both.select("number", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("m", F.lit(0)).alias("m"), differs.alias("differs")).collect()


def _cut(sample: DataFrame, keys: Sequence[str], splits: Splits, ranges: Sequence[int], fanout: int) -> tuple[Splits, list[int]]:
    """Each of some ranges cut into about ``fanout``, and the numbers of what comes of them; what lies between stays as it is."""
    drawn = sketched(sample.where(inside(splits, ranges)), keys, len(ranges) * fanout * 20)
    drawn = drawn.select(splits.number_of().alias("number"), *[_c(k) for k in keys]).orderBy("number", *[_c(k).asc_nulls_first() for k in keys])
    held: dict[int, list[Bound]] = {}
    for row in drawn.select("number", *key_texts(keys, splits.types)).collect():
        held.setdefault(row[0], []).append(tuple(row)[1:])
    bounds: list[Bound] = []
    inner: list[int] = []

    def reach(bound: Bound) -> None:
        if not bounds or bounds[-1] != bound:
            bounds.append(bound)

    for number in sorted(ranges):
        if number > 0:
            reach(splits.bounds[number - 1])
        first = len(bounds)
        own = held.get(number, [])
        for i in range(1, fanout):
            at = i * len(own) // fanout
            if at < len(own) and own[at] != own[0]:
                reach(own[at])
        inner += range(first, len(bounds) + 1)
        if number < len(splits.bounds):
            reach(splits.bounds[number])
    return Splits(splits.keys, splits.types, tuple(bounds)), inner
