"""Target tables as versioned parquet folders; data and log position change together.

Layout of one table::

    <root>/<table>/data/__commit=<id>/__bucket=<n>/*.parquet
    <root>/<table>/commits/<version>.json
    <root>/<table>/quarantine/commit=<id>/*.parquet
    <root>/<table>/touched/commit=<id>/*.parquet
    <root>/<table>/loads/<step>.json
    <root>/__cuts/<group>/<number>.json

A version file names the folders that make up the table, the log position they
stand for, the folders of rejected changes and the last micro-batch of each
stream. A commit writes new folders first and the next version file last;
readers follow the highest version, so they never see half a change, and a job
that dies in between leaves the old version in force.

Rows are spread over buckets by key hash. A replay rewrites the buckets that
hold changed keys and refers to the others where they are. Tables whose buckets
are all touched by every replay belong into a row-level table format (see
``sinks.catalog``).

A load that comes in parts keeps its own files, one per part, until all parts are there; readers see the version before it
till then.

A cut names one version of each table of a group, all at one log position. It is written when all tables have got there, so
who opens the tables by their newest cut sees them agree with each other.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, fields
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cdcspark import files
from cdcspark.functions.lsn import LSN, SEQ, SYNC, ZERO_LSN, lsn_literal, pad_lsn
from cdcspark.operators.apply import _c, apply_changes, data_columns, is_applied, to_types
from cdcspark.operators.rows import delete_by_key, update_by_key
from cdcspark.plans.drift import WIDENED, column_changes, followed
from cdcspark.sinks.target import Batch, CommitConflict

COMMIT, BUCKET, CUTS = "__commit", "__bucket", "__cuts"

#: Cuts of a group that stay readable: the newest, and the one before it for readers still at work.
KEPT_CUTS = 2


@dataclass
class Version:
    """Content of a version file.

    ``batches`` has, per stream, its last micro-batch and the position the
    table had before its first one. ``schemas`` are earlier structures, and ``layouts`` says which
    folders have one of them. ``loaded`` is the position of the last full load. While
    changes are set aside, ``touched`` are folders with the last position of every key changed after ``tracked``. ``written`` is the number of rows this
    commit wrote; it is not stored.
    """

    number: int
    lsn: str
    schema: str
    keys: list[str]
    buckets: int
    folders: dict[str, list[int]] = field(default_factory=dict)
    partial: list[str] = field(default_factory=list)
    quarantine: list[str] = field(default_factory=list)
    batches: dict[str, list] = field(default_factory=dict)
    load: str = ""
    schemas: list[str] = field(default_factory=list)
    layouts: dict[str, int] = field(default_factory=dict)
    loaded: str = ZERO_LSN.hex()
    touched: list[str] = field(default_factory=list)
    tracked: str = ""
    written: int = 0

    @classmethod
    def read(cls, text: str) -> Version:
        return _from_json(cls, text)

    def text(self) -> str:
        return json.dumps({k: v for k, v in asdict(self).items() if k != "written"})

    def next(self, lsn: bytes | None = None) -> Version:
        """A copy to be committed after this one."""
        new = Version.read(self.text())
        new.number += 1
        if lsn is not None:
            new.lsn = pad_lsn(lsn).hex()
        return new

    def drop_buckets(self, gone: set[int]) -> None:
        """Leave out some buckets of every folder."""
        for commit, numbers in list(self.folders.items()):
            rest = [b for b in numbers if b not in gone]
            if len(rest) == len(numbers):
                continue
            del self.folders[commit]
            if rest:
                self.folders[commit] = rest
                if commit not in self.partial:
                    self.partial.append(commit)
        self.partial = [c for c in self.partial if c in self.folders]
        self.layouts = {c: n for c, n in self.layouts.items() if c in self.folders}

    def note(self, batch: Batch | None) -> None:
        """Remember that a stream's micro-batch is in this version."""
        if batch is not None:
            self.batches[batch.query] = [batch.number, batch.floor.hex()]

    def last_batch(self, query: str) -> Batch | None:
        if query not in self.batches:
            return None
        number, floor = self.batches[query]
        return Batch(query, number, bytes.fromhex(floor))

    @property
    def position(self) -> bytes:
        return bytes.fromhex(self.lsn)

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _from_json(cls: type, text: str):
    stored = json.loads(text)
    return cls(**{f.name: stored[f.name] for f in fields(cls) if f.name in stored})


@dataclass
class Load:
    """State of a load in parts: its ranges of the key, and of the parts done the position each stands for and its folder.

    ``plan`` is what the loader needs to find the ranges again; the store only keeps it.
    """

    id: str
    schema: str
    keys: list[str]
    buckets: int
    plan: dict[str, Any]
    positions: list[str] = field(default_factory=list)
    folders: dict[str, list[int]] = field(default_factory=dict)
    rows: int = 0

    @property
    def done(self) -> int:
        return len(self.positions)


@dataclass(frozen=True)
class Cut:
    """Versions of several tables that stand for one log position."""

    number: int
    lsn: str
    versions: dict[str, int]

    @property
    def position(self) -> bytes:
        return bytes.fromhex(self.lsn)


class Store:
    """Tables under ``path``, a folder all executors share.

    ``buckets`` is set when a table is first loaded. Choose it so that a bucket
    is a few GB: a replay rewrites whole buckets.
    """

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # -- versions ---------------------------------------------------------

    def _commits(self, table: str) -> str:
        return f"{self.path}/{table}/commits"

    def _data(self, table: str) -> str:
        return f"{self.path}/{table}/data"

    def _numbers(self, table: str) -> list[int]:
        names = files.names_in(self.spark, self._commits(table))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def exists(self, table: str) -> bool:
        return bool(self._numbers(table))

    def current(self, table: str) -> Version:
        numbers = self._numbers(table)
        if not numbers:
            raise LookupError(f"table {table} has not been created")
        return self._version(table, numbers[-1])

    def _version(self, table: str, number: int) -> Version:
        return Version.read(files.read_text(self.spark, f"{self._commits(table)}/{number:010d}.json"))

    def _publish(self, table: str, version: Version) -> Version:
        name = f"{self._commits(table)}/{version.number:010d}.json"
        if not files.create_text(self.spark, name, version.text()):
            raise CommitConflict(f"version {version.number} of {table} was committed by another job")
        return version

    def is_new(self, table: str) -> bool:
        """Made by ``create_if_absent`` and never loaded."""
        version = self.current(table)
        return version.number == 1 and not version.folders and version.position == ZERO_LSN

    def watermark(self, table: str) -> bytes:
        """Log position of the table, the start of the log if it was never loaded."""
        return self.current(table).position if self.exists(table) else ZERO_LSN

    # -- reading ----------------------------------------------------------

    def _rows(self, table: str, version: Version, buckets: Iterable[int] | None) -> DataFrame:
        """Rows of the table's folders, all or some buckets.

        A commit of which every bucket is wanted is named by its folder, so a
        table of many buckets does not need a path for each.
        """
        root, wanted = self._data(table), None if buckets is None else set(buckets)
        by_layout: dict[int | None, list[str]] = {}
        for commit, numbers in version.folders.items():
            folders = by_layout.setdefault(version.layouts.get(commit), [])
            if wanted is None and commit not in version.partial:
                folders.append(f"{root}/{COMMIT}={commit}")
            else:
                numbers = [b for b in numbers if wanted is None or b in wanted]
                folders += [f"{root}/{COMMIT}={commit}/{BUCKET}={b}" for b in numbers]
        parts = []
        for layout, folders in by_layout.items():
            if folders:
                schema = version.columns if layout is None else StructType.fromJson(json.loads(version.schemas[layout]))
                part = self.spark.read.schema(schema).option("basePath", root).parquet(*folders).drop(COMMIT, BUCKET)
                parts.append(part if layout is None else in_layout(part, version.columns))
        if not parts:
            return self.spark.createDataFrame([], version.columns)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def read(
        self,
        table: str,
        *,
        with_sync: bool = True,
        buckets: Iterable[int] | None = None,
        version: Version | None = None,
    ) -> DataFrame:
        """The table at its current version, by default with the sync column."""
        version = version or self.current(table)
        df = self._rows(table, version, None if buckets is None else sorted(set(buckets)))
        return df.withColumn(SYNC, lsn_literal(version.position)) if with_sync else df

    # -- cuts -----------------------------------------------------------------

    def _cut_numbers(self, group: str) -> list[int]:
        names = files.names_in(self.spark, f"{self.path}/{CUTS}/{group}")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def current_cut(self, group: str = "all") -> Cut | None:
        """The newest cut of a group of tables, None if there is none yet."""
        numbers = self._cut_numbers(group)
        if not numbers:
            return None
        return _from_json(Cut, files.read_text(self.spark, f"{self.path}/{CUTS}/{group}/{numbers[-1]:010d}.json"))

    def publish_cut(self, versions: Mapping[str, Version], *, group: str = "all") -> Cut:
        """Declare versions of several tables, all at one position, to belong together."""
        positions = {v.lsn for v in versions.values()}
        if len(positions) != 1:
            raise ValueError("the versions of a cut stand for one position")
        before = self.current_cut(group)
        cut = Cut(before.number + 1 if before else 1, positions.pop(), {t: v.number for t, v in versions.items()})
        if before and (cut.lsn, cut.versions) == (before.lsn, before.versions):
            return before
        if not files.create_text(self.spark, f"{self.path}/{CUTS}/{group}/{cut.number:010d}.json", json.dumps(asdict(cut))):
            raise CommitConflict(f"cut {cut.number} of {group} was made by another job")
        for number in self._cut_numbers(group)[:-KEPT_CUTS]:
            files.remove(self.spark, f"{self.path}/{CUTS}/{group}/{number:010d}.json")
        return cut

    def read_cut(self, group: str = "all", *, cut: Cut | None = None, with_sync: bool = True) -> dict[str, DataFrame]:
        """All tables of a group as they were at one position, by default that of the newest cut."""
        cut = cut or self.current_cut(group)
        if cut is None:
            raise LookupError(f"there is no cut of {group} yet")
        return {t: self.read(t, with_sync=with_sync, version=self._version(t, n)) for t, n in cut.versions.items()}

    def _oldest_in_cuts(self, table: str) -> int | None:
        """The lowest version of a table that a kept cut names."""
        found = []
        for group in files.names_in(self.spark, f"{self.path}/{CUTS}"):
            for number in self._cut_numbers(group):
                cut = _from_json(Cut, files.read_text(self.spark, f"{self.path}/{CUTS}/{group}/{number:010d}.json"))
                found += [cut.versions[table]] if table in cut.versions else []
        return min(found, default=None)

    # -- writing ----------------------------------------------------------

    def create_if_absent(self, table: str, schema: StructType, *, keys: Sequence[str] | None = None) -> bool:
        """Create an empty table; False if it is already there."""
        if self.exists(table):
            return False
        columns = [f.name for f in schema.fields]
        self._publish(table, Version(1, ZERO_LSN.hex(), schema.json(), list(keys or columns[:1]), self.buckets))
        return True

    def full_load(
        self,
        table: str,
        df: DataFrame,
        lsn: bytes | None,
        *,
        keys: Sequence[str] | None = None,
        schema: StructType | None = None,
    ) -> Version:
        """Replace the whole table by ``df`` at log position ``lsn``.

        Keys default to those the table has, else to the first column. ``schema``
        declares the columns' types and rules; without it they are those of
        ``df``, and columns may be null unless the table was created
        otherwise: what Spark infers for ``df`` is no rule for later changes.
        """
        df = df.select(*[_c(c) for c in data_columns(df)])
        old = self.current(table) if self.exists(table) else None
        if schema is None:
            schema = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
            if old and [(f.name, f.dataType) for f in old.columns] == [(f.name, f.dataType) for f in schema]:
                schema = old.columns
        keys = list(keys or (old and old.keys) or df.columns[:1])
        version = Version(old.number + 1 if old else 1, pad_lsn(lsn).hex(), schema.json(), keys, self.buckets)
        version.loaded = version.lsn
        if old:
            version.quarantine = list(old.quarantine)
        self._write(table, df, version)
        return self._publish(table, version)

    def commit(
        self,
        table: str,
        df: DataFrame | None,
        lsn: bytes,
        *,
        buckets: Iterable[int],
        base: Version,
        rejected: DataFrame | None = None,
        batch: Batch | None = None,
        touched: DataFrame | None = None,
    ) -> Version:
        """Replace the given buckets by ``df``; the others and their files stay.

        ``base`` is the version ``df`` was computed from. A bucket that ``df``
        has no rows for becomes empty. ``rejected`` changes are set aside and
        ``batch`` is remembered by the same commit. ``touched`` has the last position
        of each key it changes; it is kept while changes are set aside.
        """
        gone = set(buckets)
        version = base.next(lsn)
        version.drop_buckets(gone)
        version.note(batch)
        if not base.quarantine:
            version.touched, version.tracked = [], base.lsn if rejected is not None else ""
        if touched is not None and (base.quarantine or rejected is not None):
            folder = f"commit={_commit_id(version)}"
            touched.write.parquet(f"{self._touched(table)}/{folder}")
            version.touched.append(folder)
        if rejected is not None:
            folder = f"commit={uuid.uuid4().hex}"
            rejected.write.parquet(f"{self._aside(table)}/{folder}")
            version.quarantine.append(folder)
        if df is not None and gone:
            self._write(table, df, version)
        return self._publish(table, version)

    def evolve(self, table: str, schema: StructType) -> Version:
        """Give the table another structure; rows keep their files and are read in the new one.

        Added columns are null in rows written before, dropped ones are not read any more, widened ones are cast. A change
        that would lose values raises ``SchemaRefused``. A widened key moves rows between buckets, so then, and only then, the
        table is written anew. The position stays.
        """
        base = self.current(table)
        before = {f.name: f for f in base.columns}
        changes = followed(column_changes(self.spark.range(0), base.columns, schema), base.keys)
        # What may be null in rows already there may be so in the table.
        schema = StructType([
            StructField(f.name, f.dataType, f.nullable or f.name not in before or before[f.name].nullable, f.metadata) for f in schema
        ])
        if schema == base.columns:
            return base
        version = base.next()
        version.schema = schema.json()
        if any(c.verdict == WIDENED and c.name in base.keys for c in changes):
            rows = in_layout(self._rows(table, base, None), schema)
            version.folders, version.partial, version.schemas, version.layouts = {}, [], [], {}
            self._write(table, rows, version)
            return self._publish(table, version)
        version.layouts = {commit: version.layouts.get(commit, len(version.schemas)) for commit in version.folders}
        # A dropped column is gone for good, also if one of its name comes later.
        kept = {f.name for f in schema}
        version.schemas = [
            StructType([f for f in StructType.fromJson(json.loads(s)) if f.name in kept]).json() for s in [*version.schemas, base.schema]
        ]
        return self._publish(table, version)

    # -- loading in parts ---------------------------------------------------

    def _loads(self, table: str) -> str:
        return f"{self.path}/{table}/loads"

    def _steps(self, table: str) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names_in(self.spark, self._loads(table)) if n.endswith(".json") and not n.startswith("."))

    def _publish_load(self, table: str, load: Load) -> Load:
        name = f"{self._loads(table)}/{load.done:010d}.json"
        if not files.create_text(self.spark, name, json.dumps(asdict(load))):
            raise CommitConflict(f"part {load.done} of the load of {table} was written by another job")
        return load

    def load_in_progress(self, table: str) -> Load | None:
        """The load that was begun and not finished; what one left behind that did finish is removed."""
        steps = self._steps(table)
        if not steps:
            return None
        load = _from_json(Load, files.read_text(self.spark, f"{self._loads(table)}/{steps[-1]:010d}.json"))
        if self.exists(table) and self.current(table).load == load.id:
            files.remove(self.spark, self._loads(table))
            return None
        return load

    def begin_load(self, table: str, schema: StructType, plan: Mapping[str, Any], *, keys: Sequence[str] | None = None) -> Load:
        """Start to load a table in parts. The version in force, if there is one, stays so until ``finish_load``."""
        columns = [f.name for f in schema.fields]
        load = Load(uuid.uuid4().hex, schema.json(), list(keys or columns[:1]), self.buckets, dict(plan))
        return self._publish_load(table, load)

    def abandon_load(self, table: str) -> None:
        """Forget a load; its folders go with the next ``prune`` that finds them old."""
        files.remove(self.spark, self._loads(table))

    def load_part(self, table: str, load: Load, df: DataFrame, lsn: bytes) -> Load:
        """Add the next part, whose rows stand for position ``lsn``. A job that dies before the end has added nothing."""
        number = self.current(table).number + 1 if self.exists(table) else 1
        part = Version(number, pad_lsn(lsn).hex(), load.schema, load.keys, load.buckets)
        self._write(table, df.select(*[_c(c) for c in part.columns.names]), part)
        new = _from_json(Load, json.dumps(asdict(load)))
        new.positions.append(part.lsn)
        new.folders.update(part.folders)
        new.rows += part.written
        return self._publish_load(table, new)

    def finish_load(
        self,
        table: str,
        load: Load,
        changes: DataFrame | None,
        lsn: bytes,
        *,
        mode: str = "upsert",
        order_by: Sequence[str] | None = None,
        rejected: DataFrame | None = None,
    ) -> Version:
        """Replay ``changes`` on the loaded rows and put both in force at position ``lsn``, in one commit.

        ``changes`` holds for every part what came after its position. Quarantined changes of the table stay.
        """
        old = self.current(table) if self.exists(table) else None
        base = Version(
            old.number if old else 0, min([pad_lsn(lsn).hex(), *load.positions]), load.schema, load.keys, load.buckets,
            dict(load.folders), [], list(old.quarantine) if old else [], {}, load.id, loaded=pad_lsn(lsn).hex(),
        )
        if changes is None:
            version = self.commit(table, None, lsn, buckets=(), base=base, rejected=rejected)
        else:
            version = self.replay(table, changes, lsn, mode=mode, order_by=order_by, rejected=rejected, base=base)
        files.remove(self.spark, self._loads(table))
        return version

    def clear(self, table: str) -> Version:
        """Empty the table; the log position stays."""
        version = self.current(table).next()
        version.folders, version.partial = {}, []
        return self._publish(table, version)

    def append(self, table: str, df: DataFrame) -> Version:
        """Add rows without looking at those already there; the log position stays."""
        version = self.current(table).next()
        self._write(table, df.select(*[_c(c) for c in version.columns.names]), version)
        return self._publish(table, version)

    def replay(
        self,
        table: str,
        changes: DataFrame,
        lsn: bytes,
        *,
        mode: str = "upsert",
        order_by: Sequence[str] | None = None,
        rejected: DataFrame | None = None,
        batch: Batch | None = None,
        base: Version | None = None,
    ) -> Version:
        """Apply changes to the buckets they touch and commit them with their position.

        ``changes`` is read several times, so it should be a written table. Keys
        and data are brought to the table's types first; a value that does not
        fit raises an error. ``base`` is the version to start from, by default the current one.
        """
        base = base or self.current(table)
        changes = to_types(changes, base.columns)
        bucket = bucket_of(base.keys, base.buckets)
        # At most one number per bucket reaches the driver.
        touched = [r[0] for r in changes.where(is_applied()).select(bucket.alias("b")).distinct().collect()]
        result = None
        if touched:
            target = self.read(table, with_sync=False, buckets=touched, version=base)
            result = apply_changes(target, changes, keys=base.keys, order_by=order_by, mode=mode)
        last = last_positions(changes, base.keys) if touched else None
        return self.commit(table, result, lsn, buckets=touched, base=base, rejected=rejected, batch=batch, touched=last)

    def touched(self, table: str) -> DataFrame | None:
        """Keys changed since the first of the changes now set aside, with the last position of each; None if there are none."""
        version = self.current(table)
        if not version.touched:
            return None
        folders = [f"{self._touched(table)}/{f}" for f in version.touched]
        found = self.spark.read.option("mergeSchema", "true").option("basePath", self._touched(table)).parquet(*folders)
        return last_positions(found.drop("commit"), version.keys, applied=False)

    def settle(
        self,
        table: str,
        repaired: DataFrame | None,
        remaining: DataFrame | None,
        *,
        mode: str = "upsert",
        order_by: Sequence[str] | None = None,
    ) -> Version:
        """Apply repaired changes and leave ``remaining`` aside, in one commit; the position stays."""
        base = self.current(table).next()
        base.number -= 1
        base.quarantine = []
        if remaining is not None:
            folder = f"commit={uuid.uuid4().hex}"
            remaining.write.parquet(f"{self._aside(table)}/{folder}")
            base.quarantine.append(folder)
        if repaired is None:
            return self.commit(table, None, base.position, buckets=(), base=base)
        return self.replay(table, repaired, base.position, mode=mode, order_by=order_by, base=base)

    def advance(
        self, table: str, lsn: bytes, *, rejected: DataFrame | None = None, batch: Batch | None = None
    ) -> Version:
        """Move the position on over a range without changes that apply; rows and files stay."""
        return self.commit(table, None, lsn, buckets=(), base=self.current(table), rejected=rejected, batch=batch)

    def update_rows(self, table: str, key: Mapping[str, Any], values: Mapping[str, Any]) -> Version:
        """Set fields of the rows with the given (composite) key; the log position stays."""
        return self._edit(table, key, lambda rows: update_by_key(rows, key, values))

    def delete_rows(self, table: str, key: Mapping[str, Any]) -> Version:
        """Delete the rows with the given (composite) key; the log position stays."""
        return self._edit(table, key, lambda rows: delete_by_key(rows, key))

    def _edit(self, table: str, key: Mapping[str, Any], change: Callable[[DataFrame], DataFrame]) -> Version:
        """Rewrite the one bucket of a table key, or all buckets if the given key is another one."""
        base = self.current(table)
        if set(key) == set(base.keys) and None not in key.values():
            types = {f.name: f.dataType for f in base.columns}
            one = self.spark.range(1).select(*[F.lit(key[k]).cast(types[k]).alias(k) for k in base.keys])
            buckets = [one.select(bucket_of(base.keys, base.buckets)).first()[0]]
        else:
            buckets = sorted({b for numbers in base.folders.values() for b in numbers})
        rows = change(self.read(table, with_sync=False, buckets=buckets, version=base))
        return self.commit(table, rows, base.position, buckets=buckets, base=base)

    def _write(self, table: str, df: DataFrame, version: Version) -> None:
        """Write rows by bucket and enter their folder into the version.

        The rebalance hint brings a bucket's rows together and lets adaptive
        execution split one that is too large for a task.
        """
        commit, seen = _commit_id(version), Observation()
        folder = f"{self._data(table)}/{COMMIT}={commit}"
        spread = to_types(df, version.columns).withColumn(BUCKET, bucket_of(version.keys, version.buckets)).hint("rebalance", F.col(BUCKET))
        spread.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(BUCKET).parquet(folder)
        prefix = f"{BUCKET}="
        held = [int(n[len(prefix):]) for n in files.names_in(self.spark, folder) if n.startswith(prefix)]
        if held:
            version.folders[commit], version.written = sorted(held), seen.get["n"]

    def _aside(self, table: str) -> str:
        return f"{self.path}/{table}/quarantine"

    def _touched(self, table: str) -> str:
        return f"{self.path}/{table}/touched"

    def quarantined(self, table: str) -> DataFrame | None:
        """Rejected changes of all commits, None if there are none."""
        folders = [f"{self._aside(table)}/{f}" for f in self.current(table).quarantine]
        if not folders:
            return None
        return self.spark.read.option("mergeSchema", "true").option("basePath", self._aside(table)).parquet(*folders)

    def prune(self, table: str, *, keep: int = 2, hours: float = 0) -> int:
        """Remove folders and version files that only old versions refer to.

        The last ``keep`` versions stay, and those that were current within the
        last ``hours``, so a reader may take that long; one that takes longer
        finds its files gone and fails. Versions from the oldest one a cut names on stay. Returns the number of folders removed. A folder belongs to every version from its own number
        until it is replaced, so the oldest kept version tells which earlier
        ones are still in use; folders with later numbers, also those of jobs
        still at work, are left alone.
        """
        made = files.entries(self.spark, self._commits(table))
        numbers = self._numbers(table)
        old = numbers[: -max(keep, 1)]
        limit = time.time() - hours * 3600
        # A version was current until its successor was made.
        while old and hours and made[f"{numbers[len(old)]:010d}.json"] > limit:
            old.pop()
        in_cuts = self._oldest_in_cuts(table) if old else None
        while old and in_cuts is not None and numbers[len(old)] > in_cuts:
            old.pop()
        if not old:
            return 0
        oldest = self._version(table, numbers[len(old)])
        loading = self.load_in_progress(table)
        in_use = set(oldest.folders) | set(loading.folders if loading else ())
        removed = 0
        root = self._data(table)
        for name in files.names_in(self.spark, root):
            commit = name.partition("=")[2]
            if name.startswith(f"{COMMIT}=") and commit not in in_use and int(commit[:10]) <= oldest.number:
                files.remove(self.spark, f"{root}/{name}")
                removed += 1
        in_use = set(oldest.touched) | set(self.current(table).touched)
        for name in files.names_in(self.spark, self._touched(table)):
            if name not in in_use and int(name.partition("=")[2][:10]) <= oldest.number:
                files.remove(self.spark, f"{self._touched(table)}/{name}")
        for n in old:
            files.remove(self.spark, f"{self._commits(table)}/{n:010d}.json")
        return removed


def last_positions(changes: DataFrame, keys: Sequence[str], *, applied: bool = True) -> DataFrame:
    """Per key the position, and sequence number if there is one, of its last change; summed up before the shuffle."""
    sequence = _c(SEQ) if SEQ in changes.columns else F.lit(None).cast("long").alias(SEQ)
    rows = changes.where(is_applied()) if applied else changes
    last = rows.groupBy(*[_c(k) for k in keys]).agg(F.max(F.struct(_c(LSN).alias(LSN), sequence)).alias("__last"))
    return last.select(*[_c(k) for k in keys], F.col(f"__last.`{LSN}`").alias(LSN), F.col(f"__last.`{SEQ}`").alias(SEQ))


def in_layout(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows of an earlier structure in a later one."""
    have = dict(rows.dtypes)
    return rows.select(*[
        (_c(f.name) if have[f.name] == f.dataType.simpleString() else _c(f.name).cast(f.dataType)).alias(f.name)
        if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def _commit_id(version: Version) -> str:
    return f"{version.number:010d}-{uuid.uuid4().hex}"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[_c(k) for k in keys]), F.lit(buckets)).cast("int")
