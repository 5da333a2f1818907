"""Tables that agree at one position, whatever single tables do."""

import pytest

from cdcspark.cuts import AHEAD, FAILED, consistent_cycle
from cdcspark.functions.lsn import SYNC
from cdcspark.jobs import TableJob, incremental_sync
from cdcspark.sinks.store import Store
from cdcspark.sinks.target import CommitConflict
from helpers import FEED, TABLE, feed_of, position, rows_of


class Log:
    """One log for several tables; each table's source may be behind it, or down."""

    def __init__(self, spark):
        self.spark, self.rows, self.at, self.down = spark, {}, {}, set()

    def job(self, store, table, **options):
        self.rows[table], self.at[table] = [], 0

        def changes(spark, since):
            if table in self.down:
                raise RuntimeError("down")
            return feed_of(spark, [r for r in self.rows[table] if r[0] <= self.at[table]]) if self.rows[table] else spark.createDataFrame([], FEED)

        def snapshot(spark):
            held = [(k, v) for n, _, k, v in self.rows[table] if n <= self.at[table]]
            return spark.createDataFrame([(0, "first"), *held], TABLE)

        options = {"position": lambda _: position(self.at[table]), "retain_hours": 0, **options}
        return TableJob(table, store, snapshot, changes, keys=["k"], **options)

    def write(self, table, *numbers):
        self.rows[table] += [(n, 2, n, f"{table}{n}") for n in numbers]


@pytest.fixture
def two(spark, tmp_path):
    store, log = Store(spark, str(tmp_path / "store"), buckets=3), Log(spark)
    jobs = [log.job(store, "a"), log.job(store, "b")]
    log.write("a", 1, 3, 5, 8)
    log.write("b", 2, 3, 6, 9)
    return store, log, jobs


def seen(store, **options):
    return {t: [r[0] for r in rows_of(df)] for t, df in store.read_cut(with_sync=False, **options).items()}


def test_the_least_position_is_the_barrier(two):
    store, log, jobs = two
    with pytest.raises(LookupError):
        store.read_cut()
    first = consistent_cycle(jobs)
    assert first.cut.number == 1 and seen(store) == {"a": [0], "b": [0]}
    log.at.update(a=8, b=4)
    done = consistent_cycle(jobs)
    assert (done.barrier, done.cut.position, done.held_back) == (position(4), position(4), None)
    assert seen(store) == {"a": [0, 1, 3], "b": [0, 2, 3]}
    assert {bytes(r[SYNC]) for df in store.read_cut().values() for r in df.collect()} == {position(4)}
    # Nothing new: the same cut.
    assert consistent_cycle(jobs).cut == done.cut
    log.at["b"] = 9
    assert consistent_cycle(jobs).barrier == position(8) and seen(store) == {"a": [0, 1, 3, 5, 8], "b": [0, 2, 3, 6]}


def test_a_failing_table_holds_the_cut_back(two):
    store, log, jobs = two
    log.at.update(a=3, b=3)
    cut = consistent_cycle(jobs).cut
    log.at.update(a=6, b=6)
    log.down.add("b")
    for _ in range(3):
        done = consistent_cycle(jobs)
        assert done.held_back == FAILED and done.cut == cut and [m.error is None for m in done.metrics] == [True, False]
    assert [r[0] for r in rows_of(store.read("a", with_sync=False))] == [0, 1, 3, 5]
    # Old versions are removed at once here, but not those of the cut.
    assert seen(store) == {"a": [0, 1, 3], "b": [0, 2, 3]}
    log.down.clear()
    log.at.update(a=8, b=9)
    assert consistent_cycle(jobs).held_back is None and seen(store) == {"a": [0, 1, 3, 5, 8], "b": [0, 2, 3, 6]}
    assert seen(store, cut=cut) == {"a": [0, 1, 3], "b": [0, 2, 3]}


def test_versions_go_when_no_cut_names_them(two):
    store, log, jobs = two
    for at in (1, 2, 3, 5, 6, 8):
        log.at.update(a=at, b=at)
        consistent_cycle(jobs)
    kept = store._cut_numbers("all")
    assert len(kept) == 2
    for table in ("a", "b"):
        store.prune(table, keep=1)
        assert store._numbers(table)[0] == store._oldest_in_cuts(table) and len(store._numbers(table)) <= 3


def test_a_table_ahead_of_the_barrier(two):
    store, log, jobs = two
    log.at.update(a=3, b=3)
    cut = consistent_cycle(jobs).cut
    log.at.update(a=8, b=5)
    incremental_sync(jobs[0])
    done = consistent_cycle(jobs)
    assert done.held_back == AHEAD and done.cut == cut and {m.phase for m in done.metrics} == {"ahead", "incremental"}
    log.at["b"] = 9
    assert consistent_cycle(jobs).barrier == position(8) and seen(store)["b"] == [0, 2, 3, 6]


def test_a_log_position_for_all_tables(two):
    store, log, jobs = two
    for job in jobs:
        job.position = None
    log.at.update(a=8, b=9)
    # Without it the change tables' ends count: 8 and 9.
    assert consistent_cycle(jobs).barrier == position(8)
    assert consistent_cycle(jobs, position=lambda _: position(20)).cut.position == position(20)
    assert seen(store) == {"a": [0, 1, 3, 5, 8], "b": [0, 2, 3, 6, 9]}


def test_groups_and_refusals(spark, tmp_path, two):
    store, log, jobs = two
    consistent_cycle(jobs[:1], group="one")
    assert set(store.read_cut("one")) == {"a"} and store.current_cut() is None
    other = Log(spark).job(Store(spark, str(tmp_path / "other")), "c")
    with pytest.raises(ValueError, match="one store"):
        consistent_cycle([jobs[0], other])
    log.at.update(a=3, b=5)
    for job in jobs:
        consistent_cycle([job], group=job.table)
    with pytest.raises(ValueError, match="one position"):
        store.publish_cut({t: store.current(t) for t in ("a", "b")})


def test_two_writers_of_a_cut(two, monkeypatch):
    store, _, jobs = two
    consistent_cycle(jobs)
    from cdcspark.sinks import store as module

    monkeypatch.setattr(module.files, "create_text", lambda *a: False)
    versions = {t: store.current(t).next(position(7)) for t in ("a", "b")}
    with pytest.raises(CommitConflict):
        store.publish_cut(versions)
