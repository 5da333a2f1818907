"""Where source tables and their change tables are opened by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark.functions.lsn import LSN, OP, SEQ
from cdcspark.plans.schema import describe
from cdcspark.sources.changes import (
    capture_name,
    jdbc_changes_options,
    jdbc_position_statement,
    misplaced,
    resolve_change_table,
)
from cdcspark.sources.snapshot import read_snapshot
from cdcspark.sources.splits import Splits, boundary_statement, splits_of_bounds


class Source(Protocol):
    """Opens a table, and its changes after a position; no change table gives None.

    ``position`` is how far the log goes, None if nothing is known of it.
    ``retained_from`` is the oldest position the change table still covers,
    None if nothing is ever removed from it. ``information_schema`` has a row per
    column of the table, None if there is no such table.
    """

    def snapshot(self, spark: SparkSession, table: str) -> DataFrame: ...

    def changes(self, spark: SparkSession, table: str, position: bytes) -> DataFrame | None: ...

    def position(self, spark: SparkSession, table: str) -> bytes | None: ...

    def retained_from(self, spark: SparkSession, table: str) -> bytes | None: ...

    def information_schema(self, spark: SparkSession, table: str) -> DataFrame | None: ...


@dataclass
class FileSource:
    """Tables landed as files: ``<path>/<table>`` and ``<path>/<schema>_<table>_CT``.

    With ``split_transactions`` the files of one transaction may land one after
    the other: the highest position seen may then be incomplete, and reads end
    at the one before it.
    """

    path: str
    fmt: str = "parquet"
    schema: str = "dbo"
    options: Mapping[str, str] = field(default_factory=dict)
    split_transactions: bool = False

    def _open(self, spark: SparkSession, name: str) -> DataFrame:
        return read_snapshot(spark, self.fmt, {**self.options, "path": f"{self.path.rstrip('/')}/{name}"})

    def snapshot(self, spark: SparkSession, table: str) -> DataFrame:
        return self._open(spark, table)

    def _opened(self, spark: SparkSession, name: str) -> DataFrame | None:
        try:
            return self._open(spark, name)
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def changes(self, spark: SparkSession, table: str, position: bytes) -> DataFrame | None:
        return self._opened(spark, f"{capture_name(table, self.schema)}_CT")

    def position(self, spark: SparkSession, table: str) -> bytes | None:
        """Highest position of the landed feed; a scan of its position column."""
        feed = self.changes(spark, table, b"")
        if feed is None:
            return None
        placed = misplaced(feed, others=True).select(F.col(LSN).cast("binary").alias("lsn"))
        if not self.split_transactions:
            found = placed.agg(F.max("lsn").alias("lsn")).first()["lsn"]
        else:
            two = placed.distinct().orderBy(F.desc("lsn")).limit(2).collect()
            found = two[1]["lsn"] if len(two) == 2 else None
        return None if found is None else bytes(found)

    def retained_from(self, spark: SparkSession, table: str) -> bytes | None:
        return None

    def information_schema(self, spark: SparkSession, table: str) -> DataFrame | None:
        """From the files' own schema."""
        found = self._opened(spark, table)
        return None if found is None else describe(found)


@dataclass
class JdbcSource:
    """Tables of a database with change tables, read over JDBC.

    ``options`` are Spark's JDBC options (url, user, password, driver …); they
    are handed to the reader only. ``partitioning`` gives, per table, the
    column and bounds that split its scan, and that of its changes, over tasks.
    ``splits`` gives ranges of a table's key instead (see ``planned``): its scan
    then has a task per range, whatever the key's columns and types.
    """

    options: Mapping[str, str]
    schema: str = "dbo"
    change_schema: str = "cdc"
    dialect: str = "sqlserver"
    partitioning: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    splits: Mapping[str, Splits] = field(default_factory=dict)
    #: The position column is a NOT NULL column of ten bytes there, so no change can lack its place.
    check_positions: bool = False

    def __repr__(self) -> str:
        return f"JdbcSource(schema={self.schema!r})"

    def snapshot(self, spark: SparkSession, table: str) -> DataFrame:
        name = f"{self.schema}.{table}"
        if table in self.splits:
            reader = spark.read.options(**{k: v for k, v in self.options.items() if k != "url"})
            return reader.jdbc(self.options["url"], name, predicates=self.splits[table].statements(dialect=self.dialect))
        return read_snapshot(spark, "jdbc", {**self.options, "dbtable": name}, partitioning=self.partitioning.get(table))

    def planned(self, spark: SparkSession, table: str, keys: Sequence[str], parts: int) -> Splits:
        """Ranges of about as many rows each; the database counts along its index and sends the bounds only."""
        statement = boundary_statement(f"{self.schema}.{table}", keys, parts, dialect=self.dialect)
        return splits_of_bounds(read_snapshot(spark, "jdbc", {**self.options, "query": statement}), keys)

    def changes(self, spark: SparkSession, table: str, position: bytes) -> DataFrame | None:
        catalog = read_snapshot(spark, "jdbc", {**self.options, "dbtable": f"{self.change_schema}.change_tables"})
        name = resolve_change_table(catalog, table, schema=self.schema)
        if name is None:
            return None
        full = f"{self.change_schema}.{name}"
        known = read_snapshot(spark, "jdbc", {**self.options, "dbtable": full}).columns
        columns = [c for c in known if not c.startswith("__$")]
        if not {OP, LSN} <= set(known):
            raise ValueError(f"{full} has no operation or position column")
        options = jdbc_changes_options(
            self.options, full, columns, position, sequence=SEQ in known, dialect=self.dialect,
            partitioning=self.partitioning.get(table),
        )
        return read_snapshot(spark, "jdbc", options)

    def _scalar(self, spark: SparkSession, statement: str) -> bytes | None:
        found = read_snapshot(spark, "jdbc", {**self.options, "query": statement}).first()
        return None if found is None or found[0] is None else bytes(found[0])

    def position(self, spark: SparkSession, table: str) -> bytes | None:
        """One value the database computes; no change is read for it."""
        full = f"{self.change_schema}.{capture_name(table, self.schema)}_CT"
        return self._scalar(spark, jdbc_position_statement(full, dialect=self.dialect))

    def _columns_statement(self, table: str) -> str:
        names = "COLUMN_NAME, DATA_TYPE, CHARACTER_MAXIMUM_LENGTH, NUMERIC_PRECISION, NUMERIC_SCALE, IS_NULLABLE, ORDINAL_POSITION"
        quoted = [x.replace("'", "''") for x in (self.schema, table)]
        return (
            f"SELECT {names} FROM INFORMATION_SCHEMA.COLUMNS WHERE TABLE_SCHEMA = '{quoted[0]}' AND TABLE_NAME = '{quoted[1]}'"
        )

    def information_schema(self, spark: SparkSession, table: str) -> DataFrame | None:
        return read_snapshot(spark, "jdbc", {**self.options, "query": self._columns_statement(table)})

    def _lowest_statement(self, table: str) -> str:
        return f"SELECT sys.fn_cdc_get_min_lsn('{capture_name(table, self.schema)}') AS min_lsn"

    def retained_from(self, spark: SparkSession, table: str) -> bytes | None:
        """Asked of the database where it keeps a retention period; other dialects have no such function."""
        if self.dialect != "sqlserver":
            return None
        return self._scalar(spark, self._lowest_statement(table))
