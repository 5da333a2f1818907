"""A change table as a stream whose offsets are log positions.

``position_stream`` makes a streaming DataFrame of a log. Its offset is ``{"lsn": "<hex>"}``, kept in the query's checkpoint: a
query that is stopped or killed goes on behind the last position it planned, whatever files or rows the log consists of by
then. A micro-batch holds whole transactions, and about as many changes as are admitted at once; its tasks share the range among
them.

The log is asked for positions on the driver and read in the tasks, both in Python processes without a session, so a
log is described by a small object that is sent there: ``FileLog`` for landed parquet files, ``DatabaseLog`` for a change table
behind any driver of Python's database interface.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from cdcspark import files
from cdcspark.functions.lsn import LSN, LSN_BYTES, ZERO_LSN, pad_lsn
from cdcspark.sources.changes import BINARY_LITERAL

#: Changes of a micro-batch, and of a task, about.
ADMITTED, PER_TASK = 10_000_000, 250_000

#: Rows fetched from a database at once.
FETCHED = 10_000


class Log(Protocol):
    """What a stream asks of a change table. Ranges leave out their lower end and take in their upper one."""

    def highest(self) -> bytes | None:
        """How far the log goes; None if it is empty."""

    def admitted(self, low: bytes, high: bytes, most: int) -> bytes:
        """A position behind ``low``, ``high`` at most, up to which there are about ``most`` changes."""

    def pieces(self, low: bytes, high: bytes, most: int) -> list[Any]:
        """The range in pieces of about ``most`` changes, each of which one task reads."""

    def read(self, piece: Any, schema: pa.Schema) -> Iterator[pa.RecordBatch]: ...


# -- landed files -----------------------------------------------------------------


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a qualified address."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def _landed(path: str) -> bool:
    """Not hidden, and not in a folder of files that are still being written; the rule is the one Spark reads by."""
    return not any(part.startswith(".") or (part.startswith("_") and "=" not in part) for part in path.split("/"))


@dataclass
class FileLog:
    """Parquet files of a folder, which land in log order and are not changed afterwards.

    Files' footers say which positions their row groups hold, so only row groups of the range are read, and a file's footer is read
    once per process. With ``split_transactions`` the highest position may still be incomplete, and the stream ends before it
    till a higher one lands. Changes without a proper position are not part of the log and are passed over.
    """

    uri: str
    split_transactions: bool = False
    _known: dict[str, list[tuple[int, bytes, bytes, int]]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"uri": self.uri, "split_transactions": self.split_transactions, "_known": {}}

    def _groups(self) -> list[tuple[str, int, bytes, bytes, int]]:
        """File, row group, its least and highest position and its rows, in log order."""
        system, root = _opened(self.uri)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        names = [f.path for f in found if f.is_file and f.path.endswith(".parquet") and _landed(f.path.removeprefix(root))]
        for name in names:
            if name not in self._known:
                self._known[name] = list(_footer(system, name))
        rows = [(name, *group) for name in names for group in self._known[name]]
        return sorted(rows, key=lambda g: (g[2], g[3], g[0], g[1]))

    def highest(self) -> bytes | None:
        groups = self._groups()
        top = max((g[3] for g in groups), default=None)
        if top is None or not self.split_transactions:
            return top
        below = [g[3] for g in groups if g[3] < top]
        for name, group, least, high, _ in groups:
            if high == top and least < top:
                below.append(max(p for p in _positions(name, group, self.uri) if p < top))
        return max(below, default=None)

    def admitted(self, low: bytes, high: bytes, most: int) -> bytes:
        """Counts by row group; only of the one in which the count is reached, and of those begun before, positions are read."""
        left = most
        for name, group, least, top, rows in sorted(self._groups(), key=lambda g: (g[3], g[2], g[0], g[1])):
            if top <= low or least > high:
                continue
            if least > low and top <= high and rows < left:
                left -= rows
                continue
            inside = sorted(p for p in _positions(name, group, self.uri) if low < p <= high)
            if len(inside) >= left:
                return inside[left - 1]
            left -= len(inside)
        return high

    def pieces(self, low: bytes, high: bytes, most: int) -> list[Any]:
        out: list[Any] = []
        size = 0
        for name, group, least, top, rows in self._groups():
            if top <= low or least > high:
                continue
            if not out or size + rows > most:
                out.append((low, high, []))
                size = 0
            out[-1][2].append((name, group))
            size += rows
        return out

    def read(self, piece: Any, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        low, high, groups = piece
        system, _ = _opened(self.uri)
        for name, group in groups:
            with system.open_input_file(name) as source, pq.ParquetFile(source) as file:
                for batch in file.iter_batches(row_groups=[group], columns=schema.names, use_threads=False):
                    position = batch.column(LSN).cast(pa.binary())
                    inside = pc.and_(pc.equal(pc.binary_length(position), LSN_BYTES), pc.and_(pc.greater(position, low), pc.less_equal(position, high)))
                    kept = pa.Table.from_batches([batch.filter(inside)]).select(schema.names).cast(schema)
                    yield from kept.to_batches()


def _footer(system: fs.FileSystem, name: str) -> Iterator[tuple[int, bytes, bytes, int]]:
    with system.open_input_file(name) as source, pq.ParquetFile(source) as file:
        meta = file.metadata
        at = [i for i in range(meta.num_columns) if meta.schema.column(i).path == LSN]
        if not at:
            raise ValueError(f"{name} has no column {LSN}")
        for group in range(meta.num_row_groups):
            stats, rows = meta.row_group(group).column(at[0]).statistics, meta.row_group(group).num_rows
            if stats is not None and stats.has_min_max and len(stats.min) == len(stats.max) == LSN_BYTES and not stats.null_count:
                yield group, stats.min, stats.max, rows
            else:
                held = _own_positions(file, group)
                if held:
                    yield group, min(held), max(held), rows


def _own_positions(file: pq.ParquetFile, group: int) -> list[bytes]:
    column = file.read_row_group(group, columns=[LSN], use_threads=False).column(0).to_pylist()
    return [p for p in column if p is not None and len(p) == LSN_BYTES]


def _positions(name: str, group: int, uri: str) -> list[bytes]:
    system, _ = _opened(uri)
    with system.open_input_file(name) as source, pq.ParquetFile(source) as file:
        return _own_positions(file, group)


# -- a change table in a database -----------------------------------------------------


@dataclass
class DatabaseLog:
    """A change table read with a driver of Python's database interface.

    ``connect`` opens a connection and is sent to the tasks; it should look credentials up there. Every statement names the
    range by literals. ``highest_statement`` overrides how the end of the log is asked for, such as by a function of the
    database that also knows of transactions that did not touch the table.
    """

    connect: Callable[[], Any]
    table: str
    dialect: str = "sqlserver"
    highest_statement: str | None = None

    def _name(self, column: str) -> str:
        return f"[{column}]" if self.dialect == "sqlserver" else f'"{column}"'

    def _range(self, low: bytes, high: bytes) -> str:
        position, literal = self._name(LSN), BINARY_LITERAL[self.dialect]
        return f"{position} > {literal.format(low.hex().upper())} AND {position} <= {literal.format(high.hex().upper())}"

    def _rows(self, statement: str) -> Iterator[list[tuple]]:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(statement)
            while rows := cursor.fetchmany(FETCHED):
                yield rows
        finally:
            connection.close()

    def highest(self) -> bytes | None:
        statement = self.highest_statement or f"SELECT MAX({self._name(LSN)}) FROM {self.table}"
        value = next(self._rows(statement))[0][0]
        return None if value is None else bytes(value)

    def _every(self, low: bytes, high: bytes, most: int) -> str:
        """Positions of every ``most``-th change of a range."""
        position = self._name(LSN)
        return (
            f"SELECT {position} FROM (SELECT {position}, ROW_NUMBER() OVER (ORDER BY {position}) AS place FROM {self.table} "
            f"WHERE {self._range(low, high)}) numbered WHERE place % {most} = 0"
        )

    def admitted(self, low: bytes, high: bytes, most: int) -> bytes:
        position = self._name(LSN)
        found = next(self._rows(f"SELECT MIN({position}) FROM ({self._every(low, high, most)}) every_one"))[0][0]
        return high if found is None else bytes(found)

    def pieces(self, low: bytes, high: bytes, most: int) -> list[Any]:
        cuts = sorted({bytes(row[0]) for rows in self._rows(self._every(low, high, most)) for row in rows} - {high})
        ends = [low, *cuts, high]
        return list(zip(ends[:-1], ends[1:]))

    def read(self, piece: Any, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        names = ", ".join(self._name(n) for n in schema.names)
        for rows in self._rows(f"SELECT {names} FROM {self.table} WHERE {self._range(*piece)}"):
            columns = [pa.array(list(values), f.type) for values, f in zip(zip(*rows), schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


# -- the stream ---------------------------------------------------------------------


class Piece(InputPartition):
    def __init__(self, piece: Any):
        self.piece = piece


class PositionReader(DataSourceStreamReader):
    """Plans micro-batches by position. ``start`` is where the query's last batch ended, None if there was none."""

    def __init__(self, log: Log, schema: StructType, start: bytes | None, first: bytes, admitted: int, per_task: int):
        self.log, self.schema, self.first = log, schema, first
        self.reached, self.most, self.per_task = start, admitted, per_task

    def initialOffset(self) -> dict:
        self.reached = self.first
        return {"lsn": self.first.hex()}

    def latestOffset(self) -> dict:
        low = self.first if self.reached is None else self.reached
        high = self.log.highest()
        if high is None or high <= low:
            return {"lsn": low.hex()}
        return {"lsn": self.log.admitted(low, high, self.most).hex()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, high = bytes.fromhex(start["lsn"]), bytes.fromhex(end["lsn"])
        # A batch that was planned is done before the next one is; the one after begins where it ends.
        self.reached = max(high, self.reached or high)
        return [Piece(p) for p in self.log.pieces(low, high, self.per_task)] if low < high else []

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition.piece, to_arrow_schema(self.schema))


def planned_position(spark: SparkSession, checkpoint: str) -> bytes | None:
    """Where the last planned micro-batch of a query ends, by its checkpoint; None if it has planned none."""
    folder = f"{checkpoint.rstrip('/')}/offsets"
    numbers = [int(n) for n in files.names_in(spark, folder) if n.isdigit()]
    if not numbers:
        return None
    # One line per source, behind the version and the batch's settings.
    text = files.read_text(spark, f"{folder}/{max(numbers)}").splitlines()
    return bytes.fromhex(json.loads(text[-1])["lsn"])


def position_stream(
    spark: SparkSession,
    log: Log,
    schema: StructType | str,
    *,
    checkpoint: str,
    since: bytes | None = None,
    admitted: int = ADMITTED,
    per_task: int = PER_TASK,
) -> DataFrame:
    """Changes of a log as a stream, from the position the query at ``checkpoint`` has reached.

    ``schema`` names the columns to read, ``__$operation`` and ``__$start_lsn`` among them. A new query begins behind ``since``,
    such as the position of a loaded table. About ``admitted`` changes make up a micro-batch, and whole transactions always; a
    transaction of more is one micro-batch. One stream is for one query: give the same ``checkpoint`` to it.
    """
    schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    if LSN not in schema.names:
        raise ValueError(f"the schema has no column {LSN}")
    start, first = planned_position(spark, checkpoint), pad_lsn(since or ZERO_LSN)
    name = "log_positions"

    class Positions(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return schema

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return PositionReader(log, schema, start, first, admitted, per_task)

    spark.dataSource.register(Positions)
    return spark.readStream.format(name).load()


def file_log(spark: SparkSession, path: str, *, split_transactions: bool = False) -> FileLog:
    """A folder of landed changes; a path without scheme is one of Spark's default file system."""
    return FileLog(files.qualified(spark, path), split_transactions)
