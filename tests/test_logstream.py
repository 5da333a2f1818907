"""A change table as a stream of positions: planning, reading, killed and resumed queries."""

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cdcspark.functions.lsn import LSN, OP, SEQ
from cdcspark.jobs import TableJob
from cdcspark.sinks.store import Store
from cdcspark.sources.logstream import DatabaseLog, FileLog, PositionReader, file_log, planned_position, position_stream
from cdcspark.streaming.run import run_stream
from helpers import FEED, feed_of, position, random_log, random_target, replay, rows_of


def landed(spark, tmp_path, *parts):
    path = str(tmp_path / "log")
    for part in parts:
        feed_of(spark, part).coalesce(1).write.mode("append").parquet(path)
    return path


def changes(numbers):
    return [(n, 4, n % 7, f"v{n}") for n in numbers]


def numbers_of(log, low, high, most=1000):
    schema = pa.schema([(OP, pa.int32()), (LSN, pa.binary()), ("k", pa.int32())])
    pieces = log.pieces(position(low), position(high), most)
    found = [b for p in pieces for b in log.read(p, schema)]
    assert all(b.schema == schema for b in found)
    return sorted(int.from_bytes(x, "big") for b in found for x in b.column(1).to_pylist()), len(pieces)


def test_files_are_read_by_range(spark, tmp_path):
    log = file_log(spark, landed(spark, tmp_path, changes(range(1, 11)), changes(range(11, 21)), changes([21, 21, 22])))
    assert log.uri.startswith("file:/") and log.highest() == position(22)
    assert numbers_of(log, 0, 22) == ([*range(1, 21), 21, 21, 22], 1)
    assert numbers_of(log, 5, 12, most=10) == (list(range(6, 13)), 2)
    assert numbers_of(log, 10, 20) == (list(range(11, 21)), 1)
    assert numbers_of(log, 22, 40) == ([], 0)
    assert log.admitted(position(0), position(22), 4) == position(4)
    assert log.admitted(position(0), position(22), 13) == position(13)
    # Of a transaction either all changes are admitted or none.
    assert log.admitted(position(20), position(22), 1) == position(21)
    assert log.admitted(position(0), position(22), 99) == position(22)


def test_overlapping_and_odd_files(spark, tmp_path):
    path = landed(spark, tmp_path, changes([1, 9]), changes([2, 8]), changes([3, 10]))
    spark.createDataFrame([(4, None, 1, "x"), (4, b"\x05", 1, "x"), (4, position(5), 1, "y")], FEED).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([(4, None, 1, "x")], FEED).coalesce(1).write.mode("append").parquet(path)
    log = file_log(spark, path)
    assert log.highest() == position(10) and numbers_of(log, 0, 10) == ([1, 2, 3, 5, 8, 9, 10], 1)
    low, seen = 0, []
    while low < 10:
        high = int.from_bytes(log.admitted(position(low), position(10), 2), "big")
        assert high > low
        seen += numbers_of(log, low, high)[0]
        low = high
    assert seen == [1, 2, 3, 5, 8, 9, 10]


def test_a_transaction_that_may_be_incomplete_waits(spark, tmp_path):
    path = landed(spark, tmp_path, changes([1, 2, 3]))
    assert FileLog(file_log(spark, path).uri, split_transactions=True).highest() == position(2)
    feed_of(spark, changes([3])).coalesce(1).write.mode("append").parquet(path)
    assert FileLog(file_log(spark, path).uri, split_transactions=True).highest() == position(2)
    feed_of(spark, changes([4])).coalesce(1).write.mode("append").parquet(path)
    assert FileLog(file_log(spark, path).uri, split_transactions=True).highest() == position(3)
    only = str(tmp_path / "one")
    feed_of(spark, changes([1])).write.parquet(only)
    assert FileLog(file_log(spark, only).uri, split_transactions=True).highest() is None


def test_files_still_being_written_are_not_there(spark, tmp_path):
    import shutil
    from pathlib import Path

    path = landed(spark, tmp_path, changes([1, 2]))
    (file,) = Path(path).glob("part-*.parquet")
    for folder in ("_temporary/0/task", ".hidden", "day=1"):
        (Path(path) / folder).mkdir(parents=True)
        shutil.copy(file, Path(path) / folder / "part-9.parquet")
    shutil.copy(file, Path(path) / "_draft.parquet")
    assert numbers_of(file_log(spark, path), 0, 9) == ([1, 1, 2, 2], 1)


def test_no_files_and_no_position_column(spark, tmp_path):
    assert file_log(spark, str(tmp_path / "none")).highest() is None
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="no column"):
        file_log(spark, str(tmp_path / "other")).highest()
    with pytest.raises(ValueError, match="no column"):
        position_stream(spark, file_log(spark, str(tmp_path / "none")), "k int", checkpoint=str(tmp_path / "c"))


class Rows:
    """Stand-in for a connection: answers the statements a log makes from rows in memory."""

    def __init__(self, rows, asked):
        self.rows, self.asked = sorted(rows), asked

    def cursor(self):
        return self

    def close(self):
        self.asked.append("closed")

    def execute(self, statement):
        self.asked.append(statement)
        low, high = (int(x[:20], 16) for x in statement.split("0x")[1:3]) if "0x" in statement else (None, None)
        inside = [r for r in self.rows if low is not None and low < r[0] <= high]
        if "place % " in statement:
            every = int(statement.rsplit("% ", 1)[1].split(" ")[0])
            found = [(position(r[0]),) for i, r in enumerate(inside, 1) if i % every == 0]
            self.found = [(min(found)[0] if found else None,)] if "MIN(" in statement else found
        elif "MAX(" in statement:
            self.found = [(position(max(self.rows)[0]) if self.rows else None,)]
        else:
            self.found = [(4, position(n), k) for n, k in inside]

    def fetchmany(self, n):
        out, self.found = self.found[:n], self.found[n:]
        return out


def test_statements_of_a_database_log():
    asked = []
    rows = [(n, n * 10) for n in (1, 2, 3, 3, 3, 7, 9)]
    log = DatabaseLog(lambda: Rows(rows, asked), "cdc.dbo_t_CT")
    assert log.highest() == position(9)
    assert log.admitted(position(0), position(9), 2) == position(2) and log.admitted(position(2), position(9), 3) == position(3)
    assert log.admitted(position(3), position(9), 5) == position(9)
    pieces = log.pieces(position(0), position(9), 3)
    assert pieces == [(position(0), position(3)), (position(3), position(7)), (position(7), position(9))]
    schema = pa.schema([(OP, pa.int32()), (LSN, pa.binary()), ("k", pa.int64())])
    found = [r for p in pieces for b in log.read(p, schema) for r in b.to_pylist()]
    assert [(int.from_bytes(r[LSN], "big"), r["k"]) for r in found] == rows
    assert asked[0] == "SELECT MAX([__$start_lsn]) FROM cdc.dbo_t_CT" and asked[-2] == (
        "SELECT [__$operation], [__$start_lsn], [k] FROM cdc.dbo_t_CT WHERE [__$start_lsn] > 0x00000000000000000007 "
        "AND [__$start_lsn] <= 0x00000000000000000009"
    )
    assert asked.count("closed") == len(asked) / 2
    assert DatabaseLog(lambda: Rows([], asked), "t", dialect="standard").highest() is None


def test_planning_without_a_query(spark, tmp_path):
    log = file_log(spark, landed(spark, tmp_path, changes(range(1, 11))))
    fresh = PositionReader(log, None, None, position(2), 3, 100)
    assert fresh.initialOffset() == {"lsn": position(2).hex()}
    end = fresh.latestOffset()
    assert end == {"lsn": position(5).hex()} == fresh.latestOffset()
    assert len(fresh.partitions({"lsn": position(2).hex()}, end)) == 1 and fresh.partitions(end, end) == []
    assert fresh.latestOffset() == {"lsn": position(8).hex()}
    # A reader that goes on after a restart knows where its query was.
    assert PositionReader(log, None, position(9), position(2), 3, 100).latestOffset() == {"lsn": position(10).hex()}
    assert PositionReader(log, None, position(10), position(2), 3, 100).latestOffset() == {"lsn": position(10).hex()}


class Killed(Exception):
    pass


def run(spark, job, log, checkpoint, schema, watch=None, **options):
    stream = position_stream(spark, log, schema, checkpoint=checkpoint, **options)
    query = run_stream(stream, job, checkpoint=checkpoint, trigger={"processingTime": "0 seconds"}, on_batch=watch)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


@pytest.mark.parametrize("mode", ["upsert", "bag"])
def test_killed_and_resumed(spark, tmp_path, mode):
    log, rows = random_log(11, events=120, nulls=False), random_target(11, unique=mode == "upsert")
    ordered = sorted(log)
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    store.full_load("t", spark.createDataFrame(rows, "k int, v string"), None, keys=["k"])
    job = TableJob("t", store, None, None, keys=["k"], mode=mode, retain_hours=None)
    path, checkpoint = landed(spark, tmp_path, ordered[:40], ordered[40:80]), str(tmp_path / "query")
    source, done = file_log(spark, path), []

    def dies(metrics):
        done.append(metrics)
        # The batch is committed to the table, but not to the query's checkpoint: it comes again.
        if len(done) == 2:
            raise Killed

    with pytest.raises(StreamingQueryException):
        run(spark, job, source, checkpoint, FEED, dies, admitted=25)
    assert planned_position(spark, checkpoint) == position(50) == store.current("t").position
    feed_of(spark, ordered[80:]).coalesce(1).write.mode("append").parquet(path)
    run(spark, job, source, checkpoint, FEED, done.append, admitted=25)
    assert rows_of(store.read("t", with_sync=False)) == replay(rows, log, mode)
    assert [m.phase for m in done[:3]] == ["incremental", "incremental", "repeated"] and len(done) == 6
    assert planned_position(spark, checkpoint) == position(120)


def test_begins_behind_a_loaded_table(spark, tmp_path):
    path = landed(spark, tmp_path, changes(range(1, 31)))
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    store.full_load("t", spark.createDataFrame([(i, "old") for i in range(7)], "k int, v string"), position(28), keys=["k"])
    job, done = TableJob("t", store, None, None, keys=["k"], retain_hours=None), []
    run(spark, job, file_log(spark, path), str(tmp_path / "query"), FEED, done.append, since=position(28))
    assert rows_of(store.read("t", with_sync=False)) == sorted([(i, "old") for i in range(7) if i not in (1, 2)] + [(1, "v29"), (2, "v30")])
    assert sum(m.updates for m in done) == 2


def test_types_and_sequence_columns(spark, tmp_path):
    rows = spark.range(1, 6).select(
        F.lit(2).alias(OP), F.unhex(F.lpad(F.hex("id"), 20, "0")).alias(LSN), F.col("id").alias(SEQ),
        F.col("id").cast("decimal(10,2)").alias("d"), F.timestamp_seconds(F.col("id")).alias("t"), F.lit(None).cast("string").alias("s"),
    )
    rows.write.parquet(str(tmp_path / "log"))
    stream = position_stream(spark, file_log(spark, str(tmp_path / "log")), rows.schema, checkpoint=str(tmp_path / "query"))
    query = stream.writeStream.format("memory").queryName("typed").option("checkpointLocation", str(tmp_path / "query")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(map(tuple, spark.table("typed").collect())) == sorted(map(tuple, rows.collect()))
