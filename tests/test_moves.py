"""Deletes and inserts of one content become moves; replayed, they do what the captured changes do."""

import random
from collections import defaultdict

import pytest

from cdcspark.functions.lsn import DELETE, INSERT, LSN, OP, UPDATE
from cdcspark.operators import moves
from cdcspark.operators.apply import apply_changes, expand_key_changes
from cdcspark.operators.feed import capture_changes
from cdcspark.operators.moves import BEFORE, capture_moves
from helpers import position

FEED = f"`{OP}` int, `{LSN}` binary, k int, v string, w int"


def feed(spark, rows):
    return spark.createDataFrame([(op, position(1), k, v, w) for op, k, v, w in rows], FEED)


def shown(df):
    return sorted(((r[OP], r["k"], r["v"], r["w"], r[f"{BEFORE}k"]) for r in df.collect()), key=repr)


def brute(rows):
    gone, come, out = defaultdict(list), defaultdict(list), []
    for op, k, v, w in rows:
        if op == DELETE:
            gone[v, w].append(k)
        elif op == INSERT:
            come[v, w].append(k)
        else:
            out.append((op, k, v, w, None))
    for content in {*gone, *come}:
        old, new = sorted(gone[content]), sorted(come[content])
        n = min(len(old), len(new))
        out += [(UPDATE, b, *content, a) for a, b in zip(old, new)]
        out += [(DELETE, k, *content, None) for k in old[n:]] + [(INSERT, k, *content, None) for k in new[n:]]
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 5])
def test_equals_brute_force(spark, ranges):
    draw = random.Random(2)
    rows = [
        (draw.choice([DELETE, INSERT, INSERT, UPDATE]), k, draw.choice([None, "", "a", "b"]), draw.choice([None, 0, 1]))
        for k in draw.sample(range(-500, 500), 300)
    ]
    # One content has a third of all.
    rows += [(op, 1000 + i, "hot", 0) for i, op in enumerate([DELETE, INSERT] * 70 + [DELETE] * 9)]
    assert shown(capture_moves(feed(spark, rows), ["k"], ranges=ranges)) == brute(rows)


def test_equal_hashes_are_not_equal_content(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(moves, "row_hash", lambda columns: F.lit(1).cast("long"))
    rows = [(DELETE, 1, "a", 0), (INSERT, 2, "b", 0)]
    assert shown(capture_moves(feed(spark, rows), ["k"])) == brute(rows)


def test_replayed_moves_give_the_later_snapshot(spark):
    draw = random.Random(3)
    before = [(k, draw.choice("ab"), draw.randrange(3)) for k in range(60)]
    after = [(k + 100 if k % 4 == 0 else k, v, w + (k % 7 == 0)) for k, v, w in before if k % 9] + [(500, "a", 1)]
    old, new = (spark.createDataFrame(r, "k int, v string, w int") for r in (before, after))
    captured = capture_changes(old, new, ["k"], batch=1)
    found = capture_moves(captured, ["k"])
    assert found.where(f"`{BEFORE}k` IS NOT NULL").count() > 5
    plain = expand_key_changes(found.withColumn(f"{BEFORE}k", moves.F.coalesce(f"`{BEFORE}k`", "k")), ["k"], {"k": f"{BEFORE}k"})
    got = apply_changes(old, plain, keys=["k"], mode="strict")
    assert sorted(map(tuple, got.collect())) == sorted(after)


def test_composite_keys_and_chosen_columns(spark):
    rows = [(DELETE, position(1), 1, "x", 5), (INSERT, position(2), 2, "x", 6), (INSERT, position(2), 1, "y", 5)]
    df = spark.createDataFrame(rows, FEED)
    got = capture_moves(df, ["k", "v"], columns=["w"])
    assert [(r[OP], r.k, r.v, r.w, r[f"{BEFORE}k"], r[f"{BEFORE}v"], bytes(r[LSN])) for r in got.orderBy("k", "v").collect()] == [
        (UPDATE, 1, "y", 5, 1, "x", position(2)), (INSERT, 2, "x", 6, None, None, position(2)),
    ]
    with pytest.raises(ValueError, match="no content"):
        capture_moves(df.select(OP, LSN, "k"), ["k"])


def test_nothing_captured(spark):
    assert shown(capture_moves(feed(spark, []), ["k"])) == []
