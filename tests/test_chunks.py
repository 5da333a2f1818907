"""First loads by ranges of the key, with a source that changes at every look, and restarts."""

import random

import pytest

from cdcspark import chunks
from cdcspark.functions.lsn import LSN, OP
from cdcspark.jobs import TableJob, incremental_sync, initial_sync
from cdcspark.sinks.store import Store
from cdcspark.sources.splits import Splits
from helpers import TABLE, feed_of, position, random_log, random_target, replay, rows_of


class Source:
    """Rows and log in plain Python; ``pace(look)`` says by how many changes the log moves at each look."""

    def __init__(self, spark, rows, log, mode, pace):
        self.spark, self.rows, self.mode, self.pace = spark, rows, mode, pace
        self.log = sorted(log, key=lambda e: e[0])
        self.at, self.look, self.scans = 0, 0, 0

    def move(self):
        self.look += 1
        self.at = min(self.at + self.pace(self.look), len(self.log))

    def snapshot(self, spark):
        self.move()
        self.scans += 1
        return spark.createDataFrame(replay(self.rows, self.log[: self.at], self.mode), TABLE)

    def position(self, spark):
        self.move()
        return position(self.log[self.at - 1][0] if self.at else 0)

    def changes(self, spark, since):
        return feed_of(spark, self.log[: self.at])


def job_of(spark, tmp_path, source, mode, **options):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    splits = Splits(("k",), ("int",), (("8",), ("20",), ("33",)))
    options = {"chunks": lambda _: splits, **options}
    return TableJob("t", store, source.snapshot, source.changes, keys=["k"], mode=mode, position=source.position, retain_hours=None, **options)


@pytest.mark.parametrize("mode", ["upsert", "strict", "bag"])
@pytest.mark.parametrize("seed", [1, 2])
def test_changes_land_all_the_time(spark, tmp_path, mode, seed):
    log = random_log(seed, events=200, keys=40, nulls=mode == "bag")
    rows = random_target(seed, unique=mode != "bag")
    draw = random.Random(seed)
    # The log rests now and then, or no key would ever stand still.
    source = Source(spark, rows, log, mode, lambda look: draw.choice([0, 3, 9]) if look % 7 < 5 else 0)
    job = job_of(spark, tmp_path, source, mode)
    done = initial_sync(job)
    assert done.error is None and done.phase == "initial"
    source.at = len(log)
    incremental_sync(job)
    assert rows_of(job.store.read("t", with_sync=False)) == replay(rows, log, mode)
    assert job.store.load_in_progress("t") is None


class Stop(Exception):
    pass


@pytest.mark.parametrize("mode", ["upsert", "bag"])
def test_goes_on_after_every_range(spark, tmp_path, mode, monkeypatch):
    log = random_log(3, events=150, nulls=False)
    rows = random_target(3, unique=mode != "bag")
    source = Source(spark, rows, log, mode, lambda look: 4 if look % 6 < 3 else 0)
    job = job_of(spark, tmp_path, source, mode)
    real = Store.load_part
    phases, parts = [], []

    def stops(self, table, load, df, lsn):
        if len(parts) < 2 * load.done + 1 and len(parts) % 2 == 0:
            # Once before the part is there, once after.
            parts.append("before")
            raise Stop
        found = real(self, table, load, df, lsn)
        parts.append("after")
        raise Stop

    monkeypatch.setattr(Store, "load_part", stops)
    for _ in range(8):
        with pytest.raises(Stop):
            initial_sync(job)
        assert not job.store.exists("t")
        phases.append(job.store.load_in_progress("t").done)
    assert phases == [0, 1, 1, 2, 2, 3, 3, 4]
    scans = source.scans
    done = initial_sync(job)
    assert done.phase == "continued" and source.scans == scans
    source.at = len(log)
    incremental_sync(job)
    assert rows_of(job.store.read("t", with_sync=False)) == replay(rows, log, mode)


def test_old_version_stays_until_the_end(spark, tmp_path, monkeypatch):
    source = Source(spark, [(1, "a"), (30, "b")], [(5, 4, 1, "x")], "upsert", lambda look: 0)
    job = job_of(spark, tmp_path, source, "upsert")
    initial_sync(job)
    before = rows_of(job.store.read("t", with_sync=False))
    source.rows = [(1, "new"), (9, "new")]
    real = Store.finish_load
    monkeypatch.setattr(Store, "finish_load", lambda *a, **k: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        initial_sync(job, full_refresh=True)
    assert rows_of(job.store.read("t", with_sync=False)) == before
    # Nothing of the load is removed with old versions.
    job.store.prune("t", keep=1)
    monkeypatch.setattr(Store, "finish_load", real)
    initial_sync(job, full_refresh=True)
    assert rows_of(job.store.read("t", with_sync=False)) == [(1, "new"), (9, "new")]


def test_a_load_that_ended_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    from cdcspark import files

    source = Source(spark, [(1, "a")], [], "upsert", lambda look: 0)
    job = job_of(spark, tmp_path, source, "upsert")
    real = files.remove
    monkeypatch.setattr(files, "remove", lambda spark, name: None if name.endswith("/loads") else real(spark, name))
    initial_sync(job)
    monkeypatch.setattr(files, "remove", real)
    assert job.store._steps("t") and job.store.load_in_progress("t") is None and not job.store._steps("t")


def test_a_key_that_never_rests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chunks, "ROUNDS", 3)
    log = [(n, 2, 7, f"v{n}") for n in range(1, 90)]
    job = job_of(spark, tmp_path, Source(spark, [], log, "bag", lambda look: 1), "bag")
    with pytest.raises(chunks.UnsettledKeys):
        initial_sync(job)
    # upsert needs no rest.
    other = job_of(spark, tmp_path / "u", Source(spark, [], log, "upsert", lambda look: 1), "upsert")
    initial_sync(other)
    held = other.store.current("t").position
    assert rows_of(other.store.read("t", with_sync=False)) == [(7, f"v{int.from_bytes(held, 'big')}")]


def test_a_load_behind_the_retained_log_starts_over(spark, tmp_path, monkeypatch):
    source = Source(spark, [(1, "a"), (25, "b")], [(n, 4, 1, f"v{n}") for n in range(1, 30)], "upsert", lambda look: 1)
    floor = [position(0)]
    job = job_of(spark, tmp_path, source, "upsert", retained_from=lambda _: floor[0])
    real = Store.finish_load
    monkeypatch.setattr(Store, "finish_load", lambda *a, **k: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        initial_sync(job)
    monkeypatch.setattr(Store, "finish_load", real)
    floor[0] = position(20)
    source.at = 20
    assert initial_sync(job).phase == "initial"
    source.at = len(source.log)
    incremental_sync(job)
    assert rows_of(job.store.read("t", with_sync=False)) == [(1, "v29"), (25, "b")]


def test_mapped_columns_rejected_changes_and_planned_ranges(spark, tmp_path):
    log = spark.createDataFrame(
        [(4, position(1), 2, "7"), (4, position(2), 3, "no number"), (2, None, 9, "1"), (2, position(3), None, "1")],
        f"`{OP}` int, `{LSN}` binary, k int, v string",
    )
    rows = spark.createDataFrame([(i, i * 10) for i in range(10)], "k int, v int")
    asked = iter([position(0)] * 3 + [position(3)] * 20)
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    job = TableJob(
        "t", store, lambda s: rows, lambda s, p: log, keys=["id"], columns=[("id", "k"), ("amount", "v")], chunks=3,
        position=lambda _: next(asked), on_error="quarantine",
    )
    done = initial_sync(job)
    assert (done.loaded, done.updates, done.rejected) == (10, 1, 3)
    assert sorted(tuple(r) for r in store.read("t", with_sync=False).collect()) == sorted([(i, i * 10) for i in range(10) if i != 2] + [(2, 7)])
    assert store.quarantined("t").count() == 3 and store.current("t").position == position(3)
    strict = TableJob("t", Store(spark, str(tmp_path / "s2"), buckets=3), lambda s: rows, lambda s, p: log, keys=["id"],
                      columns=[("id", "k"), ("amount", "v")], chunks=2, position=lambda _: position(3))
    with pytest.raises(RuntimeError, match="rejected"):
        initial_sync(strict)


def test_other_targets_take_whole_tables_only(spark, tmp_path):
    job = TableJob("t", object(), None, None, chunks=2)
    with pytest.raises(TypeError, match="in parts"):
        chunks.load_in_chunks(type("J", (), {"spark": spark, "store": job.store, "table": "t"})(), None)
