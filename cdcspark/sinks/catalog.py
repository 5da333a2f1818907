"""Replay into catalog tables that support ``MERGE INTO`` (row-level table formats)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cdcspark.functions.lsn import DELETE, OP, SYNC, ZERO_LSN, lsn_literal, pad_lsn
from cdcspark.operators.apply import _c, data_columns, last_changes, to_types
from cdcspark.sinks.target import Batch, Position


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge_statement(table: str, changes: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """One statement that deletes, updates and inserts by key."""
    match = " AND ".join(f"t.{quoted(k)} = c.{quoted(k)}" for k in keys)
    values = [*columns, SYNC]
    return (
        f"MERGE INTO {table} t USING {changes} c ON {match}\n"
        f"WHEN MATCHED AND c.{quoted(OP)} = {DELETE} THEN DELETE\n"
        f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.{quoted(c)} = c.{quoted(c)}' for c in values)}\n"
        f"WHEN NOT MATCHED AND c.{quoted(OP)} <> {DELETE} THEN INSERT ({', '.join(map(quoted, values))}) "
        f"VALUES ({', '.join('c.' + quoted(c) for c in values)})"
    )


def merge_into(table: str, last: DataFrame, keys: Sequence[str], columns: Sequence[str], lsn: bytes) -> None:
    """Merge the last change of each key into a catalog table; changed rows carry the position in their sync column."""
    spark = last.sparkSession
    view = f"changes_{uuid.uuid4().hex}"
    last.withColumn(SYNC, lsn_literal(lsn)).createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(table, view, keys, columns))
    finally:
        spark.catalog.dropTempView(view)


class CatalogTarget:
    """Tables of a catalog as a target of jobs, in mode ``upsert``.

    The position of each table is the newest row of ``positions``, a table of the
    same catalog that is appended to after the rows were merged. A job that dies
    between the two merges the same changes again, which changes nothing, as the
    last image of a key wins. ``using`` is the format new tables are created with.
    Rejected changes go to ``<table>__quarantine`` before the merge, marked with
    the position they were set aside at; those of a run that did not reach its
    end are not shown.
    """

    def __init__(self, spark: SparkSession, database: str, *, using: str, positions: str = "cdc_positions"):
        self.spark, self.database, self.using = spark, database, using
        self.positions = self._name(positions)

    def _name(self, table: str) -> str:
        return f"{self.database}.{quoted(table)}"

    # The five things that are asked of the catalog.

    def _there(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def _open(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def _create(self, name: str, schema: StructType) -> None:
        self.spark.createDataFrame([], schema).writeTo(name).using(self.using).create()

    def _append(self, name: str, df: DataFrame) -> None:
        df.writeTo(name).append()

    def _replace(self, name: str, df: DataFrame, where: Column) -> None:
        df.writeTo(name).overwrite(where)

    def exists(self, table: str) -> bool:
        return self._there(self._name(table)) and self._entry(table) is not None

    def _entry(self, table: str) -> Position | None:
        if not self._there(self.positions):
            return None
        found = self._open(self.positions).where(F.col("table_name") == table)
        newest = found.orderBy(F.desc("number")).limit(1).collect()
        return Position.of(newest[0].asDict()) if newest else None

    def current(self, table: str) -> Position:
        entry = self._entry(table)
        if entry is None:
            raise LookupError(f"table {table} has not been created")
        schema = self._open(self._name(table)).schema
        entry.columns = StructType([f for f in schema if f.name != SYNC])
        return entry

    def is_new(self, table: str) -> bool:
        entry = self.current(table)
        return entry.number == 1 and entry.position == ZERO_LSN

    def _publish(self, table: str, entry: Position) -> Position:
        row = self.spark.createDataFrame([entry.row(table)], Position.SCHEMA)
        if not self._there(self.positions):
            self._create(self.positions, row.schema)
        self._append(self.positions, row)
        return entry

    def create_if_absent(self, table: str, schema: StructType, *, keys: Sequence[str] | None = None) -> bool:
        if self.exists(table):
            return False
        if not self._there(self._name(table)):
            self._create(self._name(table), StructType([*schema.fields, StructField(SYNC, BinaryType())]))
        self._publish(table, Position(1, ZERO_LSN, list(keys or schema.names[:1])))
        return True

    def full_load(
        self, table: str, df: DataFrame, lsn: bytes | None, *, keys: Sequence[str] | None = None, schema: StructType | None = None
    ) -> Position:
        df = df.select(*[_c(c) for c in data_columns(df)])
        self.create_if_absent(table, schema or df.schema, keys=keys)
        state = self.current(table)
        rows = to_types(df, state.columns).withColumn(SYNC, lsn_literal(lsn))
        self._replace(self._name(table), rows, F.lit(True))
        loaded = Position(state.number + 1, pad_lsn(lsn), list(keys or state.keys), columns=state.columns)
        loaded.written = self._open(self._name(table)).count()
        return self._publish(table, loaded)

    def replay(
        self, table: str, changes: DataFrame, lsn: bytes, *, mode: str = "upsert", order_by: Sequence[str] | None = None,
        rejected: DataFrame | None = None, batch: Batch | None = None,
    ) -> Position:
        if mode != "upsert":
            raise ValueError("catalog tables are replayed on in mode upsert: a merge that runs twice must change nothing")
        state = self.current(table)
        names = state.columns.names
        last = last_changes(to_types(changes, state.columns), state.keys, columns=names, order_by=order_by)
        self._set_aside(table, rejected, state)
        merge_into(self._name(table), last, state.keys, names, pad_lsn(lsn))
        return self._publish(table, state.after(lsn, batch))

    def advance(
        self, table: str, lsn: bytes, *, rejected: DataFrame | None = None, batch: Batch | None = None
    ) -> Position:
        state = self.current(table)
        self._set_aside(table, rejected, state)
        return self._publish(table, state.after(lsn, batch))

    def _set_aside(self, table: str, rejected: DataFrame | None, state: Position) -> None:
        if rejected is None:
            return
        name = self._name(f"{table}__quarantine")
        marked = rejected.withColumn("__commit", F.lit(state.number + 1).cast("long"))
        if not self._there(name):
            self._create(name, marked.schema)
        # What an earlier, unfinished run of this commit left is replaced.
        self._replace(name, marked, F.col("__commit") == state.number + 1)

    def quarantined(self, table: str) -> DataFrame | None:
        name = self._name(f"{table}__quarantine")
        if not self._there(name):
            return None
        return self._open(name).where(F.col("__commit") <= self.current(table).number).drop("__commit")

    def read(self, table: str) -> DataFrame:
        return self._open(self._name(table))

    def prune(self, table: str, *, keep: int = 2, hours: float = 0) -> int:
        """Old snapshots are the table format's own business."""
        return 0
