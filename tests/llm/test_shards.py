import random
import zlib

import pytest

from cdcspark.llm import shards


def check(rows, got, n=16):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n for r in got)
    for s in range(n):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    text = dict(rows)
    home = {}
    for r in got:
        assert home.setdefault(text[r.doc_id] or "", r.shard) == r.shard
    return [sum(r.size for r in got if r.shard == s) for s in range(n)]


def test_near_equal_bytes_and_groups_whole(docs, monkeypatch):
    monkeypatch.setattr(shards, "SLICE_ROWS", 300)
    r = random.Random(3)
    texts = ["".join(r.choice("abcdé") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    rows = [(i, r.choice(texts[:5]) if r.random() < 0.1 else texts[i % 1500]) for i in range(4000)]
    sizes = check(rows, shards.shard(docs(rows)).collect())
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 16


def test_a_group_of_a_third_of_all_rows_stays_whole(docs):
    rows = [(i, "same text") for i in range(400)] + [(i, f"text number {i}") for i in range(400, 1200)]
    sizes = sorted(check(rows, shards.shard(docs(rows)).collect()))
    assert sizes[-1] == 4000 and sizes[-2] - sizes[0] <= 0.05 * sizes[0]


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "x" * 100_000), (4, "y")]
    check(rows, shards.shard(docs(rows)).collect())
    repeated = shards.shard(docs([(None, "a"), (5, "b"), (5, "b"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.size) for r in repeated) == [(0, 1), (0, 2), (5, 2), (5, 2)]
    assert len({(r.shard, r.slot) for r in repeated}) == 4
    assert shards.shard(docs([])).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_decreasing_takes_the_tightest_bin(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 50) for _ in range(300)]
    free, want = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, b) for b, room in enumerate(free) if room >= sizes[i]]
        if fits:
            b = min(fits)[1]
        else:
            b = len(free)
            free.append(100)
        free[b] -= sizes[i]
        want[i] = b
    assert shards.best_fit_decreasing(sizes, 100) == want


def test_the_tree_stays_balanced():
    tree = None
    for i in range(1000):
        tree = shards._with(tree, (i, 0))
    assert tree.height <= 12
    for i in range(0, 1000, 2):
        tree = shards._without(tree, (i, 0))
    assert tree.height <= 12 and shards._tightest(tree, 500) == (501, 0) and shards._tightest(tree, 1000) is None
