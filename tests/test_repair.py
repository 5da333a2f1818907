"""Changes set aside come back in their place, or not at all."""

import random

import pytest
from pyspark.sql import functions as F

from cdcspark.functions.lsn import LSN, OP, SEQ
from cdcspark.jobs import TableJob, incremental_sync
from cdcspark.operators.quarantine import REASON
from cdcspark.repair import REJECT, Repair, replay_quarantine
from cdcspark.sinks.store import Store
from helpers import feed_of, position, random_log, random_target, replay, rows_of


class Case:
    """A table of numbers, and a feed of texts of which some are none."""

    def __init__(self, spark, tmp_path, rows=(), mode="upsert", **options):
        self.spark, self.log, self.at = spark, [], 0
        self.store = Store(spark, str(tmp_path / "store"), buckets=3)
        self.store.full_load("t", spark.createDataFrame(list(rows), "k int, v int"), None, keys=["k"])
        self.job = TableJob(
            "t", self.store, None, lambda s, p: self.feed(), keys=["k"], mode=mode, on_error="quarantine",
            position=lambda _: position(self.at), **options,
        )

    def feed(self):
        return feed_of(self.spark, [e for e in self.log if e[0] <= self.at])

    def cycle(self, *log):
        self.log += log
        self.at = max([self.at, *[e[0] for e in log]])
        return incremental_sync(self.job)

    def rows(self):
        return rows_of(self.store.read("t", with_sync=False))

    def aside(self):
        held = self.store.quarantined("t")
        return [] if held is None else sorted(r.v for r in held.collect())


def mend(rows):
    return rows.where("v LIKE 'bad %'").withColumn("v", F.substring("v", 5, 9))


def test_applied_only_if_nothing_newer_touched_the_key(spark, tmp_path):
    case = Case(spark, tmp_path, [(1, 0), (2, 0), (3, 0)])
    case.cycle((1, 4, 1, "bad 10"), (2, 4, 2, "bad 20"), (3, 4, 2, "21"), (4, 4, 3, "hopeless"), (5, 2, 4, "bad 40"))
    case.cycle((6, 1, 4, None), (7, 4, 9, "90"))
    assert case.rows() == [(1, 0), (2, 21), (3, 0), (9, 90)] and case.aside() == ["bad 10", "bad 20", "bad 40", "hopeless"]
    assert replay_quarantine(case.job, mend) == Repair(applied=1, outdated=2, remaining=1)
    assert case.rows() == [(1, 10), (2, 21), (3, 0), (9, 90)] and case.aside() == ["hopeless"]
    assert case.store.watermark("t") == position(7)
    # What was applied counts as touched: an older one that is mended later does not undo it.
    case.cycle((8, 4, 3, "31"))
    assert replay_quarantine(case.job, lambda rows: rows.withColumn("v", F.lit("30"))) == Repair(0, 1, 0)
    assert case.rows()[2] == (3, 31) and case.aside() == [] and case.store.current("t").touched == []
    assert replay_quarantine(case.job, mend) == Repair()


def test_random_logs_end_as_if_nothing_had_been_wrong(spark, tmp_path):
    draw = random.Random(7)
    log = [(n, op, k, str(n)) for n, op, k, _ in sorted(random_log(7, events=120, nulls=False))]
    case = Case(spark, tmp_path, [(k, -k) for k, _ in random_target(7)])
    start = case.rows()
    broken = [(n, op, k, f"bad {v}" if draw.random() < 0.3 else v) for n, op, k, v in log]
    for first in range(0, 120, 30):
        case.cycle(*broken[first : first + 30])
        if first == 60:
            replay_quarantine(case.job, lambda rows: mend(rows).where("k % 2 = 0"))
    replay_quarantine(case.job, mend)
    want = replay([(k, str(v)) for k, v in start], log, "upsert")
    assert case.rows() == sorted(((k, int(v)) for k, v in want), key=repr) and case.aside() == []


def test_a_load_is_newer_than_what_came_before_it(spark, tmp_path):
    case = Case(spark, tmp_path, [(1, 0)])
    case.cycle((1, 4, 1, "bad 10"), (2, 4, 2, "5"))
    case.store.full_load("t", spark.createDataFrame([(1, 77)], "k int, v int"), position(2), keys=["k"])
    assert replay_quarantine(case.job, mend) == Repair(0, 1, 0) and case.rows() == [(1, 77)]


def test_late_changes_of_a_stream_find_their_place(spark, tmp_path):
    case = Case(spark, tmp_path, [(1, 0), (2, 0)])
    case.log = [(n, 4, k, v) for n, k, v in ((5, 1, "15"), (6, 3, "36"), (3, 1, "13"), (4, 2, "24"))]
    case.at = 6
    for number, part in enumerate((case.log[:2], case.log[2:])):
        incremental_sync(case.job, feed=feed_of(spark, part), batch=("q", number))
    assert case.rows() == [(1, 15), (2, 0), (3, 36)] and case.aside() == ["13", "24"]
    # They are older than the first note of touched keys, so the change table is asked.
    assert replay_quarantine(case.job, lambda rows: rows) == Repair(1, 1, 0)
    assert case.rows() == [(1, 15), (2, 24), (3, 36)]


def test_a_change_table_that_does_not_go_back(spark, tmp_path):
    case = Case(spark, tmp_path, [(1, 0)])
    for number, part in enumerate(([(5, 4, 1, "15")], [(3, 4, 1, "13")])):
        incremental_sync(case.job, feed=feed_of(spark, part), batch=("q", number))
    case.job.retained_from = lambda _: position(4)
    with pytest.raises(LookupError, match="does not go back"):
        replay_quarantine(case.job, lambda rows: rows)
    assert case.rows() == [(1, 15)] and case.aside() == ["13"]


def test_same_position_with_and_without_a_sequence(spark, tmp_path):
    rows = [(1, 1, "bad 1"), (2, 1, "2"), (3, 2, "5"), (4, 2, "bad 6")]
    for sequence in (True, False):
        store = Store(spark, str(tmp_path / f"s{sequence}"), buckets=3)
        store.full_load("t", spark.createDataFrame([(1, 0), (2, 0)], "k int, v int"), None, keys=["k"])
        feed = spark.createDataFrame([(4, position(9), s, k, v) for s, k, v in rows], f"`{OP}` int, `{LSN}` binary, `{SEQ}` long, k int, v string")
        feed = feed if sequence else feed.drop(SEQ)
        job = TableJob("t", store, None, lambda s, p: feed, keys=["k"], on_error="quarantine", position=lambda _: position(9))
        incremental_sync(job)
        got = replay_quarantine(job, mend)
        # Without a sequence nobody knows which came first, and what is there stays.
        assert got == (Repair(1, 1, 0) if sequence else Repair(0, 2, 0))
        assert rows_of(store.read("t", with_sync=False)) == ([(1, 2), (2, 6)] if sequence else [(1, 2), (2, 5)])


def test_bag_and_null_keys(spark, tmp_path):
    case = Case(spark, tmp_path, [(1, 0), (1, 0)], mode="bag")
    case.cycle((1, 2, None, "bad 7"), (2, 2, 1, "bad 8"), (3, 2, None, "9"), (4, 4, 2, "bad 3"))
    assert replay_quarantine(case.job, mend) == Repair(3, 0, 0)
    assert case.rows() == sorted([(1, 0), (1, 0), (1, 8), (None, 7), (None, 9)], key=repr)


def test_what_a_repair_may_do(spark, tmp_path):
    case = Case(spark, tmp_path, [(1, 0)])
    case.cycle((1, 4, 1, "bad 10"), (2, 4, 2, "bad 20"))
    with pytest.raises(ValueError, match="keeps the column"):
        replay_quarantine(case.job, lambda rows: rows.drop(REJECT))
    # Rows that come back twice count once; those still wrong stay with their reason.
    assert replay_quarantine(case.job, lambda rows: mend(rows.where("k = 1")).unionByName(mend(rows.where("k = 1")))) == Repair(1, 0, 1)
    assert replay_quarantine(case.job, lambda rows: rows) == Repair(0, 0, 1)
    (left,) = case.store.quarantined("t").collect()
    assert (left.v, left[REASON], REJECT in left.asDict()) == ("bad 20", "v is not int", False)
    with pytest.raises(TypeError, match="does not note"):
        replay_quarantine(TableJob("t", type("T", (), {"spark": spark})(), None, None), mend)


def test_old_notes_are_pruned(spark, tmp_path):
    from cdcspark import files

    case = Case(spark, tmp_path, [(1, 0)], retain_hours=None)
    case.cycle((1, 4, 1, "bad 10"), (2, 4, 2, "5"))
    for n in range(3, 6):
        case.cycle((n, 4, n, str(n)))
    folder = f"{case.store.path}/t/touched"
    assert len(files.names_in(spark, folder)) == 4 == len(case.store.current("t").touched)
    replay_quarantine(case.job, mend)
    case.cycle((9, 4, 9, "9"))
    case.cycle((10, 4, 9, "10"))
    case.store.prune("t", keep=1)
    assert files.names_in(spark, folder) == []
