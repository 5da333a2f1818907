"""One job over all kinds of targets; catalogs and databases are small stand-ins that record what they are told."""

import json
import re

import pytest
from pyspark.sql import functions as F

from cdcspark.functions.lsn import LSN, OP, SYNC
from cdcspark.jobs import TableJob, incremental_sync, initial_sync
from cdcspark.operators.quarantine import REASON
from cdcspark.sinks import catalog
from cdcspark.sinks.catalog import CatalogTarget, merge_statement
from cdcspark.sinks.database import DatabaseTarget, Statements
from cdcspark.sinks.store import Store
from cdcspark.sinks.target import CommitConflict, Position
from helpers import TABLE, feed_of, position, random_log, random_target, replay, rows_of


class Tables(dict):
    """Rows by table name, with their schema."""

    def put(self, name, df, replace=True):
        rows = [tuple(r) for r in df.collect()]
        old = [] if replace or name not in self else self[name][1]
        self[name] = (df.schema, old + rows)

    def frame(self, spark, name):
        schema, rows = self[name]
        return spark.createDataFrame(rows, schema)


class Catalog(CatalogTarget):
    def __init__(self, spark, *args, **options):
        super().__init__(spark, *args, **options)
        self.tables, self.steps = Tables(), []

    def _there(self, name):
        return name in self.tables

    def _open(self, name):
        return self.tables.frame(self.spark, name)

    def _create(self, name, schema):
        self.tables[name] = (schema, [])

    def _append(self, name, df):
        self.steps.append(f"append {name}")
        self.tables.put(name, df, replace=False)

    def _replace(self, name, df, where):
        self.steps.append(f"replace {name}")
        kept = self._open(name).where(~where)
        self.tables.put(name, kept.unionByName(df))


@pytest.fixture
def merges(monkeypatch):
    """What a MERGE does, on a stand-in's rows."""
    targets = []

    def merge(table, last, keys, columns, lsn):
        target = targets[-1]
        target.steps.append(f"merge {table}")
        target.merged(table, last, keys, columns, lsn)

    def merged(self, table, last, keys, columns, lsn):
        old = self._open(table).join(last.select(*keys), keys, "left_anti").select(*columns, F.col(f"`{SYNC}`"))
        new = last.where(F.col(OP) != 1).select(*columns).withColumn(SYNC, F.lit(lsn))
        self.tables.put(table, old.unionByName(new))

    monkeypatch.setattr(Catalog, "merged", merged, raising=False)
    monkeypatch.setattr(catalog, "merge_into", merge)
    return targets


class Database:
    """Knows the statements of ``Statements`` by their form; a failing one leaves everything as it was."""

    def __init__(self):
        self.tables, self.log, self.fail_at = Tables(), [], None
        self.tables["cdc_positions"] = (Position.SCHEMA, [])

    def write(self, df, options, table, *, replace, batch=0):
        self.log.append(f"{'replace' if replace else 'append'} {table}")
        self.tables.put(table, df, replace)

    def read(self, spark, fmt, options):
        if "dbtable" in options:
            return self.tables.frame(spark, options["dbtable"])
        name = re.search(r"= '([^']*)' AND", options["query"])[1]
        rows = sorted(r for r in self.tables["cdc_positions"][1] if r[0] == name)
        return spark.createDataFrame(rows[-1:], Position.SCHEMA)

    def connect(self):
        return Connection(self)


class Connection:
    def __init__(self, database):
        self.database, self.open = database, Tables(database.tables)

    def cursor(self):
        return self

    def execute(self, statement, values):
        db = self.database
        db.log.append(statement)
        if db.fail_at and db.fail_at in statement:
            raise OSError("connection lost")
        table = re.search(r"(?:FROM|INTO) `([^`]*)`", statement)[1]
        schema, rows = self.open[table]
        if table == "cdc_positions":
            if any(r[:2] == values[:2] for r in rows):
                raise ValueError("duplicate primary key")
            self.open[table] = (schema, [*rows, values])
            return
        staged_schema, staged = self.open[f"{table}__staging"]
        at = staged_schema.names.index
        if statement.startswith("DELETE"):
            keys = re.findall(r"s\.`([^`]*)` =", statement)
            gone = {tuple(r[at(k)] for k in keys) for r in staged}
            self.open[table] = (schema, [r for r in rows if tuple(r[schema.names.index(k)] for k in keys) not in gone])
        else:
            self.open[table] = (schema, rows + [tuple(r[at(c)] for c in schema.names) for r in staged if r[at(OP)] != 1])

    def commit(self):
        self.database.tables.update(self.open)

    def rollback(self):
        self.open = None

    def close(self):
        pass


@pytest.fixture(params=["store", "catalog", "database"])
def target(request, spark, tmp_path, merges):
    if request.param == "store":
        return Store(spark, str(tmp_path / "store"), buckets=4)
    if request.param == "catalog":
        merges.append(Catalog(spark, "cat.db", using="some"))
        return merges[-1]
    db = Database()
    made = DatabaseTarget(spark, {"url": "x", "password": "hidden"}, db.connect, read=db.read, write=db.write)
    made.db = db
    return made


def job_for(target, rows, log, **more):
    return TableJob(
        "t", target, lambda s: s.createDataFrame(rows, TABLE), lambda s, _: feed_of(s, log), keys=["k"],
        position=lambda _: position(max([0, *(e[0] for e in log)])), **more,
    )


def test_the_same_job_over_every_target(spark, target):
    rows, log = random_target(41), sorted(random_log(41, nulls=False))
    seen = log[:0]
    job = job_for(target, rows, seen)
    first = initial_sync(job)
    assert (first.loaded, first.watermark) == (len(rows), position(0)) and initial_sync(job).phase in ("resumed", "initial")
    for part in (log[:100], log[100:150], [], log[150:]):
        seen += part
        done = incremental_sync(job)
        top = max([0, *(e[0] for e in seen)])
        assert done.error is None and done.watermark == position(top) == target.current("t").position
        assert rows_of(target.read("t").select("k", "v")) == replay(rows, seen, "upsert")
    assert target.quarantined("t") is None


def test_rejected_changes_over_every_target(spark, target):
    log = [(1, 4, 1, "b"), (2, 4, None, "c"), (3, 4, 2, "d")]
    job = job_for(target, [(1, "a")], [], on_error="quarantine")
    initial_sync(job)
    job = job_for(target, [], log, on_error="quarantine")
    done = incremental_sync(job)
    assert (done.updates, done.rejected, done.watermark) == (2, 1, position(3))
    assert rows_of(target.read("t").select("k", "v")) == [(1, "b"), (2, "d")]
    assert [r[REASON] for r in target.quarantined("t").collect()] == ["null key k"]
    log.append((4, 1, None, None))
    assert incremental_sync(job).watermark == position(4) and target.quarantined("t").count() == 2


def test_stream_batches_over_every_target(spark, target):
    initial_sync(job_for(target, [(1, "a")], []))
    job = job_for(target, [], [])
    part = feed_of(spark, [(1, 4, 1, "b")])
    assert incremental_sync(job, feed=part, batch=("q", 0)).updates == 1
    assert incremental_sync(job, feed=feed_of(spark, [(1, 4, 1, "x")]), batch=("q", 0)).phase == "repeated"
    assert incremental_sync(job, feed=feed_of(spark, [(1, 2, 2, "c")]), batch=("q", 1)).inserts == 1
    assert rows_of(target.read("t").select("k", "v")) == [(1, "b"), (2, "c")]


@pytest.mark.parametrize("lost_at", ["DELETE", "INSERT INTO `t`", "INSERT INTO `cdc_positions`"])
def test_a_crash_inside_the_transaction_changes_nothing(spark, lost_at):
    db = Database()
    target = DatabaseTarget(spark, {}, db.connect, read=db.read, write=db.write)
    initial_sync(job_for(target, [(1, "a")], []))
    job = job_for(target, [], [(1, 4, 1, "b"), (2, 2, 2, "c")])
    db.fail_at = lost_at
    with pytest.raises(OSError):
        incremental_sync(job)
    assert rows_of(target.read("t").select("k", "v")) == [(1, "a")] and target.current("t").position == position(0)
    db.fail_at, db.log = None, []
    incremental_sync(job)
    assert rows_of(target.read("t").select("k", "v")) == [(1, "b"), (2, "c")] and target.current("t").position == position(2)
    assert [s.split(" (")[0] for s in db.log] == [
        "replace t__staging", "DELETE FROM `t` WHERE EXISTS", "INSERT INTO `t`", "INSERT INTO `cdc_positions`",
    ]


def test_a_crash_before_staging_or_a_second_writer(spark):
    db = Database()
    target = DatabaseTarget(spark, {"password": "hidden"}, db.connect, read=db.read, write=db.write)
    initial_sync(job_for(target, [(1, "a")], []))
    state = target.current("t")
    target.advance("t", position(5))
    stale = state.after(position(6), None)
    with pytest.raises(CommitConflict):
        target._commit([(target.sql.enter(), stale.row("t"))], "t", stale)
    assert target.current("t").position == position(5) and "hidden" not in repr(target)
    with pytest.raises(ValueError, match="upsert"):
        target.replay("t", feed_of(spark, []), position(6), mode="bag")


def test_rows_come_before_the_position_in_a_catalog(spark, merges):
    target = Catalog(spark, "cat.db", using="some")
    merges.append(target)
    initial_sync(job_for(target, [(1, "a")], []))
    target.steps.clear()
    log = [(1, 4, 1, "b")]
    publish = target._publish

    def lost(*_):
        raise OSError("lost")

    target._publish = lost
    with pytest.raises(OSError):
        incremental_sync(job_for(target, [], log))
    assert target.current("t").position == position(0) and target.steps == ["merge cat.db.`t`"]
    target._publish = publish
    incremental_sync(job_for(target, [], log))
    assert target.steps[1:] == ["merge cat.db.`t`", "append cat.db.`cdc_positions`"]
    assert rows_of(target.read("t").select("k", "v")) == [(1, "b")]


def test_statements():
    sql = Statements(quote='"', mark="?")
    assert sql.delete("t", ["a", 'b"c']) == (
        'DELETE FROM "t" WHERE EXISTS (SELECT 1 FROM "t__staging" s WHERE s."a" = "t"."a" AND s."b""c" = "t"."b""c")'
    )
    assert sql.insert("t", ["a", "v"]) == (
        f'INSERT INTO "t" ("a", "v", "{SYNC}") SELECT "a", "v", "{SYNC}" FROM "t__staging" WHERE "{OP}" <> 1'
    )
    assert sql.enter().endswith("VALUES (?, ?, ?, ?, ?)") and "PRIMARY KEY" in sql.create_positions()
    assert "'o''x'" in sql.newest("o'x")


def test_positions_survive_a_round_trip():
    entry = Position(3, position(7), ["a", "b"], {"q": [4, "00" * 10]})
    again = Position.of(dict(zip(Position.COLUMNS, entry.row("t"), strict=True)))
    assert (again.number, again.position, again.keys, again.batches) == (3, position(7), ["a", "b"], {"q": [4, "00" * 10]})
    assert json.loads(entry.row("t")[3]) == ["a", "b"] and LSN


def test_merge_statement_is_valid_sql(spark):
    text = merge_statement("cat.db.t", "changes", ["a", "b`c"], ["a", "b`c", "v"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    assert plan.nodeName() == "MergeIntoTable"
