"""Periodic runs of words, by Lyndon roots.

The first phase of Baier's suffix sorter groups positions by words that grow while the groups are taken from the largest to the
smallest; when it ends, the word of a position's group is the longest Lyndon word that starts there. Done under an order of
the words and under its reverse, that gives every run's root. Roots are extended to both sides by the longest common extensions of a position
and the one a period later, which a table of doubled ranks answers exactly.

A run long enough repeats each of its short windows, so stretches of a text without repeated windows are left out first: no
run reaches into them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import bounded_batches, buffers, mixed, row_blocks, text_bytes

#: A run has at least so many words, and so many times its period.
MIN_WORDS, MIN_TIMES = 24, 3

#: Bytes of text looked at together; a longer text is looked at alone.
CHUNK_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)

RUNS = "array<struct<start: long, length: long, period: long>>"


def lyndon_array(ranks: list[int]) -> list[int]:
    """For every place the length of the longest Lyndon word that starts there; ``ranks`` are 0 to their number less one.

    Groups are taken from the largest. A place of the group continues the word of the nearest place before it that lies
    in a smaller group; as many copies of the group's word as follow that place without a gap are added to its word at once. Places
    with more copies make a larger group. Every place is taken once and moves as often as words are added to it.
    """
    n, top = len(ranks), max(ranks, default=-1) + 1
    group, size = list(ranks), [1] * top
    members: list[set[int]] = [set() for _ in range(top)]
    for i, r in enumerate(ranks):
        members[r].add(i)
    below, above = list(range(-1, top - 1)), [*range(1, top), -1]
    done, before = bytearray(top), [-1] * n
    now = top - 1
    while now >= 0:
        done[now] = 1
        copies: dict[int, int] = {}
        own = members[now]
        for i in sorted(own) if len(own) > 1 else own:
            j = i - 1
            while j >= 0 and done[group[j]]:
                j = before[j]
            before[i] = j
            if j >= 0:
                copies[j] = copies.get(j, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, k in copies.items():
            moves.setdefault((group[j], k), []).append(j)
        length = size[now]
        # More copies first, so each new group comes to lie directly above what it leaves.
        for old, k in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            places = moves[old, k]
            if len(places) == len(members[old]):
                size[old] += k * length
                continue
            new = len(size)
            members[old].difference_update(places)
            members.append(set(places))
            size.append(size[old] + k * length)
            done.append(0)
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
            for j in places:
                group[j] = new
        now = below[now]
    return [size[g] for g in group]


class Extensions:
    """Longest common extensions of two places of a sequence, to the right and to the left, for many pairs at once.

    Level k numbers the stretches of 2^k elements, equal ones alike; levels end where no two are equal.
    """

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.n, self.levels = n, []
        rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        step = 1
        while len(rank):
            self.levels.append(rank.astype(np.int32))
            if step >= n:
                break
            pair = rank[:-step] * (n + 1) + rank[step:]
            values, rank = np.unique(pair, return_inverse=True)
            if len(values) == len(pair):
                break
            step *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many elements from ``i`` on equal those from ``j`` on."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank, step = self.levels[k], 1 << k
            # A stretch may be taken more than once at the top level only.
            while True:
                at, other = i + out, j + out
                inside = (at < len(rank)) & (other < len(rank))
                same = inside & (rank[np.where(inside, at, 0)] == rank[np.where(inside, other, 0)])
                out += same * step
                if k < len(self.levels) - 1 or not same.any():
                    break
        return out

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many elements before ``i`` equal those before ``j``."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank, step = self.levels[k], 1 << k
            while True:
                at, other = i - out - step, j - out - step
                inside = (at >= 0) & (other >= 0) & (at < len(rank)) & (other < len(rank))
                same = inside & (rank[np.where(inside, at, 0)] == rank[np.where(inside, other, 0)])
                out += same * step
                if k < len(self.levels) - 1 or not same.any():
                    break
        return out


def _stretches(ids: np.ndarray, starts: np.ndarray, window: int, least: int) -> list[tuple[int, int]]:
    """Ranges of at least ``least`` words, each inside one document, all of whose windows occur elsewhere in the document too."""
    if len(ids) < least:
        return []
    n = len(ids) - window + 1
    doc = np.searchsorted(starts, np.arange(len(ids)), side="right")
    keys = np.zeros(n, np.uint64)
    for k in range(window):
        keys = keys * _STEP + mixed(ids[k : k + n].astype(np.uint64) + np.uint64(1))
    keys = mixed(keys + doc[:n].astype(np.uint64) * _STEP)
    # Windows over a border of two documents are none; windows that only share a hash are let through.
    whole = doc[:n] == doc[window - 1 :]
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = whole & (times[number] > 1)
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = last + window - 1
    # Where a document ends, windows over the border cut the stretches already.
    long = ends - first >= least
    return list(zip(first[long].tolist(), ends[long].tolist()))


def find_runs(ids: np.ndarray, starts: np.ndarray, least: int = MIN_WORDS, times: int = MIN_TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs in documents whose words' numbers stand one behind the other.

    ``starts`` are the documents' first places. A run lies in one document, has its smallest period, at least ``least`` words
    and ``times`` (3 or more) periods, and cannot be made longer. Sorted by start, then period.
    """
    parts, roots, at, origin = [], [], 0, []
    for number, (a, b) in enumerate(_stretches(ids, starts, least // times, least)):
        own = ids[a:b]
        rank = np.unique(own, return_inverse=True)[1]
        most = int(rank.max())
        lengths = np.array([lyndon_array(rank.tolist()), lyndon_array((most - rank).tolist())])
        place = np.broadcast_to(np.arange(b - a), lengths.shape)
        fits = lengths * times <= b - a
        roots.append(np.unique(np.stack([place[fits] + at, lengths[fits]], 1), axis=0))
        # A number of its own behind each stretch keeps extensions inside.
        parts += [own, np.array([-1 - number])]
        origin.append((at, a - at))
        at += b - a + 1
    if not parts:
        return np.zeros((0, 3), np.int64)
    extend = Extensions(np.concatenate(parts))
    i, period = np.concatenate(roots).T
    start = i - extend.left(i, i + period)
    length = i + period + extend.right(i, i + period) - start
    keep = (length >= least) & (length >= times * period)
    found = np.unique(np.stack([start, length, period], 1)[keep], axis=0)
    firsts, shift = np.array(origin).T
    found[:, 0] += shift[np.searchsorted(firsts, found[:, 0], side="right") - 1]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapse_runs(
    documents: DataFrame,
    *,
    least: int = MIN_WORDS,
    times: int = MIN_TIMES,
    before: Callable[[int, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per row of a table (doc_id, text): doc_id, n_words, runs and the text with one period of each run.

    Words are what white space (space, tab to carriage return) parts, in whole texts. ``runs`` has (start, length, period) of all runs, in
    words, by start, then period. A word that any run holds behind its first period is dropped, and the others are joined
    by a space. ``before`` may put other words in place of a document's own. Null, empty and wordless texts have no words,
    no runs and an empty text; so has none a text shorter than a run. Rows without doc_id go through as they are, without ``before``. Rows
    that repeat each other each get their result. An empty table gives no rows. A text is handled whole, in time in proportion to its length but
    for sorting.
    """

    def block(doc_ids: list[int | None], raw: bytes, offsets: np.ndarray) -> tuple[list, list, list]:
        texts = [raw[offsets[i] : offsets[i + 1]].split() for i in range(len(doc_ids))]
        if before:
            texts = [w if d is None else before(d, w) for d, w in zip(doc_ids, texts)]
        number = defaultdict(count().__next__)
        sizes = np.array([len(w) for w in texts], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        # Texts too short for a run are not looked at.
        long = np.flatnonzero(sizes >= least)
        ids = [np.fromiter(map(number.__getitem__, texts[i]), np.int64, len(texts[i])) for i in long]
        firsts = np.concatenate([[0], np.cumsum(sizes[long])])
        found = find_runs(np.concatenate([np.empty(0, np.int64), *ids]), firsts[:-1], least, times)
        owner = np.searchsorted(firsts, found[:, 0], side="right") - 1
        runs: list[list] = [[] for _ in texts]
        for x, (start, length, period) in zip(owner.tolist(), found.tolist()):
            runs[long[x]].append((start - int(firsts[x]), length, period))
        kept = []
        for words, own in zip(texts, runs):
            if own:
                stays = np.ones(len(words), bool)
                for start, length, period in own:
                    stays[start + period : start + length] = False
                words = [words[i] for i in np.flatnonzero(stays)]
            kept.append(b" ".join(words))
        return np.diff(starts).tolist(), runs, kept

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            for a, b in row_blocks(offsets, CHUNK_BYTES):
                own = offsets[a : b + 1]
                doc_ids = batch.column(0).slice(a, b - a)
                sizes, runs, kept = block(doc_ids.to_pylist(), raw[own[0] : own[-1]].tobytes(), own - own[0])
                runs = [[{"start": s, "length": n, "period": p} for s, n, p in x] for x in runs]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "text"],
                )

    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), text_bytes().alias("raw"))
    return rows.mapInArrow(work, f"doc_id long, n_words long, runs {RUNS}, text string")
