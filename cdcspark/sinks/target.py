"""What a job needs of the place it replicates into.

``Store`` (parquet folders), ``CatalogTarget`` (tables with ``MERGE INTO``) and
``DatabaseTarget`` (relational databases) all offer it, so one job serves all
three.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, ClassVar, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cdcspark.functions.lsn import pad_lsn


class CommitConflict(RuntimeError):
    """Another job committed to the table first."""


@dataclass(frozen=True)
class Batch:
    """A stream's micro-batch, and the position its table had before the stream's first one."""

    query: str
    number: int
    floor: bytes


@dataclass
class Position:
    """A row of a position table: how far a table is, for targets that keep it in a table of its own."""

    number: int
    position: bytes
    keys: list[str]
    batches: dict[str, list] = field(default_factory=dict)
    columns: StructType = field(default_factory=StructType)
    written: int = 0

    COLUMNS: ClassVar[tuple[str, ...]] = ("table_name", "number", "lsn", "table_keys", "batches")
    SCHEMA: ClassVar[str] = "table_name string, number long, lsn string, table_keys string, batches string"

    @property
    def lsn(self) -> str:
        return self.position.hex()

    @classmethod
    def of(cls, row: Mapping[str, Any]) -> Position:
        row = {k.lower(): v for k, v in row.items()}
        return cls(int(row["number"]), bytes.fromhex(row["lsn"]), json.loads(row["table_keys"]), json.loads(row["batches"]))

    def row(self, table: str) -> tuple:
        return (table, self.number, self.lsn, json.dumps(self.keys), json.dumps(self.batches))

    def after(self, lsn: bytes, batch: Batch | None) -> Position:
        """The next commit's row."""
        batches = dict(self.batches)
        if batch is not None:
            batches[batch.query] = [batch.number, batch.floor.hex()]
        return Position(self.number + 1, pad_lsn(lsn), list(self.keys), batches, self.columns)

    def last_batch(self, query: str) -> Batch | None:
        if query not in self.batches:
            return None
        number, floor = self.batches[query]
        return Batch(query, number, bytes.fromhex(floor))


class State(Protocol):
    """A table as its last commit left it; ``written`` counts the rows that commit wrote."""

    position: bytes
    columns: StructType
    keys: list[str]
    written: int

    def last_batch(self, query: str) -> Batch | None: ...


class Target(Protocol):
    """Tables that can be loaded, replayed on and asked for their position.

    ``full_load``, ``replay`` and ``advance`` commit rows, position, rejected
    changes and the stream's micro-batch so that a job that dies on the way can
    simply be run again.
    """

    spark: SparkSession

    def exists(self, table: str) -> bool: ...

    def current(self, table: str) -> State: ...

    def is_new(self, table: str) -> bool: ...

    def create_if_absent(self, table: str, schema: StructType, *, keys: Sequence[str] | None = None) -> bool: ...

    def full_load(
        self, table: str, df: DataFrame, lsn: bytes | None, *, keys: Sequence[str] | None = None, schema: StructType | None = None
    ) -> State: ...

    def replay(
        self, table: str, changes: DataFrame, lsn: bytes, *, mode: str = "upsert", order_by: Sequence[str] | None = None,
        rejected: DataFrame | None = None, batch: Batch | None = None,
    ) -> State: ...

    def advance(
        self, table: str, lsn: bytes, *, rejected: DataFrame | None = None, batch: Batch | None = None
    ) -> State: ...

    def quarantined(self, table: str) -> DataFrame | None: ...

    def prune(self, table: str, *, keep: int = 2, hours: float = 0) -> int: ...
