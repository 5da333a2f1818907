"""Targets in a relational database.

Rows travel through Spark's JDBC writer only: a full load into the table, the last
change of each key into a staging table. One transaction then moves the staged
changes over as two set-based statements and enters the new position; a driver
connection (any DB-API driver) runs it. A job that dies before it leaves the table
and its position as they were, and the next run stages again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcspark.functions.lsn import DELETE, OP, SYNC, ZERO_LSN, lsn_literal, pad_lsn
from cdcspark.operators.apply import _c, data_columns, last_changes, to_types
from cdcspark.operators.quarantine import REASON
from cdcspark.sinks.target import Batch, CommitConflict, Position
from cdcspark.sources.snapshot import read_snapshot


def jdbc_load(df: DataFrame, options: Mapping[str, str], table: str, lsn: bytes, *, batch: int = 10_000) -> None:
    """Replace a database table by a snapshot; every row carries the position."""
    jdbc_write(df.withColumn(SYNC, lsn_literal(lsn)), options, table, replace=True, batch=batch)


def jdbc_append(df: DataFrame, options: Mapping[str, str], table: str, *, batch: int = 10_000) -> None:
    jdbc_write(df, options, table, replace=False, batch=batch)


def jdbc_write(df: DataFrame, options: Mapping[str, str], table: str, *, replace: bool, batch: int = 10_000) -> None:
    """Spark's JDBC writer; ``replace`` truncates first and keeps the table's definition."""
    writer = df.write.format("jdbc").options(**options).options(dbtable=table, batchsize=str(batch), truncate="true")
    writer.mode("overwrite" if replace else "append").save()


class Statements:
    """The SQL a target runs, with names quoted and values as marks."""

    def __init__(self, *, quote: str = "`", mark: str = "%s", positions: str = "cdc_positions"):
        self.quote, self.mark, self.positions = quote, mark, positions

    def name(self, text: str) -> str:
        return f"{self.quote}{text.replace(self.quote, self.quote * 2)}{self.quote}"

    def staging(self, table: str) -> str:
        return f"{table}__staging"

    def delete(self, table: str, keys: Sequence[str]) -> str:
        """Rows of all staged keys go."""
        t, s = self.name(table), self.name(self.staging(table))
        match = " AND ".join(f"s.{self.name(k)} = {t}.{self.name(k)}" for k in keys)
        return f"DELETE FROM {t} WHERE EXISTS (SELECT 1 FROM {s} s WHERE {match})"

    def insert(self, table: str, columns: Sequence[str]) -> str:
        """Staged keys that were not deleted come back with their last image."""
        listed = ", ".join(self.name(c) for c in [*columns, SYNC])
        s = self.name(self.staging(table))
        return f"INSERT INTO {self.name(table)} ({listed}) SELECT {listed} FROM {s} WHERE {self.name(OP)} <> {DELETE}"

    def enter(self) -> str:
        """A table's new position, under the next number; a second writer of the same number meets the primary key."""
        names = ", ".join(self.name(c) for c in Position.COLUMNS)
        return f"INSERT INTO {self.name(self.positions)} ({names}) VALUES ({', '.join([self.mark] * len(Position.COLUMNS))})"

    def newest(self, table: str) -> str:
        names = ", ".join(self.name(c) for c in Position.COLUMNS)
        p, literal = self.name(self.positions), table.replace("'", "''")
        return (
            f"SELECT {names} FROM {p} WHERE {self.name('table_name')} = '{literal}' AND {self.name('number')} = "
            f"(SELECT MAX({self.name('number')}) FROM {p} WHERE {self.name('table_name')} = '{literal}')"
        )

    def create_positions(self) -> str:
        kinds = {"table_name": "varchar(255)", "number": "bigint", "lsn": "varchar(20)", "table_keys": "varchar(4000)", "batches": "varchar(4000)"}
        columns = ", ".join(f"{self.name(c)} {kinds[c]} NOT NULL" for c in Position.COLUMNS)
        return (
            f"CREATE TABLE IF NOT EXISTS {self.name(self.positions)} ({columns}, "
            f"PRIMARY KEY ({self.name('table_name')}, {self.name('number')}))"
        )


class DatabaseTarget:
    """Tables of a database as a target of jobs, in mode ``upsert``.

    ``options`` are Spark's JDBC options, ``connect`` opens a DB-API connection for
    the transaction. The position table must exist (``create_positions`` makes it).
    Replays are staged with as many connections as ``connections`` at a time.
    """

    def __init__(
        self, spark: SparkSession, options: Mapping[str, str], connect: Callable[[], Any], *, connections: int = 32,
        statements: Statements | None = None, read: Callable[..., DataFrame] = read_snapshot,
        write: Callable[..., None] = jdbc_write,
    ):
        self.spark, self.options, self.connect, self.connections = spark, dict(options), connect, connections
        self.sql, self._read, self._write = statements or Statements(), read, write

    def __repr__(self) -> str:
        return "DatabaseTarget()"

    def create_positions(self) -> None:
        self._transaction([(self.sql.create_positions(), ())])

    def _transaction(self, steps: Sequence[tuple[str, Sequence[Any]]]) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement, values in steps:
                cursor.execute(statement, tuple(values))
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _query(self, statement: str) -> DataFrame:
        return self._read(self.spark, "jdbc", {**self.options, "query": statement})

    def _entry(self, table: str) -> Position | None:
        found = self._query(self.sql.newest(table)).collect()
        return Position.of(found[0].asDict()) if found else None

    def exists(self, table: str) -> bool:
        return self._entry(table) is not None

    def current(self, table: str) -> Position:
        entry = self._entry(table)
        if entry is None:
            raise LookupError(f"table {table} has not been created")
        entry.columns = StructType([f for f in self.read(table).schema if f.name != SYNC])
        return entry

    def is_new(self, table: str) -> bool:
        entry = self.current(table)
        return entry.number == 1 and entry.position == ZERO_LSN

    def read(self, table: str) -> DataFrame:
        return self._read(self.spark, "jdbc", {**self.options, "dbtable": table})

    def create_if_absent(self, table: str, schema: StructType, *, keys: Sequence[str] | None = None) -> bool:
        if self.exists(table):
            return False
        empty = self.spark.createDataFrame([], schema).withColumn(SYNC, lsn_literal(None))
        self._write(empty, self.options, table, replace=True)
        first = Position(1, ZERO_LSN, list(keys or schema.names[:1]))
        self._transaction([(self.sql.enter(), first.row(table))])
        return True

    def full_load(
        self, table: str, df: DataFrame, lsn: bytes | None, *, keys: Sequence[str] | None = None, schema: StructType | None = None
    ) -> Position:
        """Not one transaction: until the position is entered the table is being loaded, and a run that dies is loaded again."""
        df = df.select(*[_c(c) for c in data_columns(df)])
        old = self._entry(table)
        loaded = Position((old.number if old else 0) + 1, pad_lsn(lsn), list(keys or (old and old.keys) or df.columns[:1]))
        loaded.columns = schema or df.schema
        rows = to_types(df, loaded.columns).withColumn(SYNC, lsn_literal(lsn))
        self._write(rows.coalesce(self.connections), self.options, table, replace=True)
        loaded.written = self.read(table).count()
        self._transaction([(self.sql.enter(), loaded.row(table))])
        return loaded

    def replay(
        self, table: str, changes: DataFrame, lsn: bytes, *, mode: str = "upsert", order_by: Sequence[str] | None = None,
        rejected: DataFrame | None = None, batch: Batch | None = None,
    ) -> Position:
        if mode != "upsert":
            raise ValueError("database tables are replayed on in mode upsert: staged are the last images of the keys")
        state = self.current(table)
        names = state.columns.names
        last = last_changes(to_types(changes, state.columns), state.keys, columns=names, order_by=order_by)
        staged = last.withColumn(SYNC, lsn_literal(lsn)).coalesce(self.connections)
        self._write(staged, self.options, self.sql.staging(table), replace=True)
        self._set_aside(table, rejected, state)
        after = state.after(lsn, batch)
        self._commit([
            (self.sql.delete(table, state.keys), ()), (self.sql.insert(table, names), ()), (self.sql.enter(), after.row(table)),
        ], table, after)
        return after

    def advance(
        self, table: str, lsn: bytes, *, rejected: DataFrame | None = None, batch: Batch | None = None
    ) -> Position:
        state = self.current(table)
        self._set_aside(table, rejected, state)
        after = state.after(lsn, batch)
        self._commit([(self.sql.enter(), after.row(table))], table, after)
        return after

    def _commit(self, steps: list, table: str, after: Position) -> None:
        try:
            self._transaction(steps)
        except Exception as problem:
            newest = self._entry(table)
            if newest and newest.number >= after.number:
                raise CommitConflict(f"position {after.number} of {table} was entered by another job") from problem
            raise

    def _set_aside(self, table: str, rejected: DataFrame | None, state: Position) -> None:
        """Rejected changes as text, marked with the commit they belong to; without it they are not shown."""
        if rejected is None:
            return
        shown = F.to_json(F.struct(*[_c(c).cast("string").alias(c) for c in rejected.columns if c != REASON]))
        rows = rejected.select(
            F.lit(state.number + 1).cast("long").alias("number"), F.lit(state.lsn).alias("lsn"), _c(REASON).alias(REASON),
            shown.alias("change"),
        )
        self._write(rows, self.options, f"{table}__quarantine", replace=False)

    def quarantined(self, table: str) -> DataFrame | None:
        name = f"{table}__quarantine"
        try:
            found = self._read(self.spark, "jdbc", {**self.options, "dbtable": name})
        except Exception:  # drivers differ in how they say that a table is absent
            return None
        return found.where(F.col("number") <= self.current(table).number).drop("number", "lsn").dropDuplicates()

    def prune(self, table: str, *, keep: int = 2, hours: float = 0) -> int:
        """Old rows are the database's own business."""
        return 0
