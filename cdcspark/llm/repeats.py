"""Removal of repeated passages: every byte covered by a string of ``DEPTH`` bytes that also starts earlier.

A suffix array cut off at ``DEPTH`` would sort all suffixes by their first ``DEPTH`` bytes; suffixes in one group start the same
string. The groups are made here by most significant digits first, and a suffix leaves the sort as soon as its
group has no other member:

1. Whole texts: only the first of equal texts goes on, the others are repeats from end to end.
2. The digit that stands for a string is the least hash among its ``SEED``-byte parts. Neighbouring strings mostly share it, so a
   text becomes runs of strings with one digit, about one run per 34 bytes. One pass over all digits leaves the runs
   whose digit occurs again.
3. Only those runs are sent, as text, to the bucket of their digit. There their strings are sorted by the hash of
   their first half, then by that of all ``DEPTH`` bytes. All but the earliest of a group are repeats.

Digits are counted inside each batch before they are sent, so a passage in a third of all documents is one entry per batch.
Runs of digits that occur ``HOT_RUNS`` times or more are not sent to one bucket: their strings are reduced to one per batch and
go to buckets by their own hashes.

Answers to the runs of a file go to a folder named after the file; the task that reads the file again fetches its own.
So texts are never shuffled: a copy of them is written once to the shared folder, and every pass scans that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark import files
from cdcspark.llm.common import BATCH_BYTES, arrow_folder, bounded_batches, buffers, mixed, row_blocks, text_bytes
from cdcspark.session import fresh_dir, written

#: Bytes of the strings, and of the parts of them whose least hash is the first digit.
DEPTH, SEED = 100, 32

#: Bytes of text whose runs one bucket stands for, and bytes of text handled at once.
BUCKET_BYTES, CHUNK_BYTES = 8 << 20, 1 << 20

#: Digits with as many runs are hot.
HOT_RUNS = 2_000

_random = np.random.Generator(np.random.PCG64(100))
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        for base in (_BASE, _INVERSE):
            x = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            x[0] = 1
            _powers.append(np.multiply.accumulate(x))
    return _powers[0][:n], _powers[1][:n]


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all stretches of ``width`` values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def runs(raw: np.ndarray, offsets: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts with one digit: first start, end (exclusive), digit, and whether strings of a run may be equal.

    Starts count through all rows; no string crosses a row's end; rows in ``skip`` have none.
    """
    n = len(raw)
    none = np.empty(0, np.int64)
    if n < DEPTH:
        return none, none, none.astype(np.uint64), none.astype(bool)
    up, down = _power(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=sums[1:])
    seeds = mixed((sums[SEED:] - sums[:-SEED]) * down[: n + 1 - SEED])
    width = DEPTH - SEED + 1
    digits = _least(seeds, width)
    # A start is valid if its row has DEPTH bytes from there.
    first, last = offsets[:-1], np.maximum(offsets[1:] - DEPTH + 1, offsets[:-1])
    first, last = first[~skip], last[~skip]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    valid = np.cumsum(edge)[: len(digits)] > 0
    fresh = np.ones(len(digits), bool)
    fresh[1:] = (digits[1:] != digits[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(valid & fresh)
    over = np.ones(len(digits), bool)
    over[:-1] = (digits[1:] != digits[:-1]) | ~valid[1:]
    ends = np.flatnonzero(valid & over) + 1
    values = digits[starts]
    # Equal strings of one run have the digit at different places.
    again = ends - starts > width
    for i in range(0, len(starts), 1 << 14):
        at = slice(i, i + (1 << 14))
        places = np.arange(width)
        head = seeds[starts[at][:, None] + places] == values[at][:, None]
        tail = seeds[ends[at][:, None] - 1 + places] == values[at][:, None]
        left = starts[at] + head.argmax(axis=1)
        right = ends[at] - 1 + width - 1 - tail[:, ::-1].argmax(axis=1)
        again[at] |= left != right
    return starts, ends, values, again


def _window_hashes(buffer: np.ndarray, at: np.ndarray, first: int, last: int, seed: np.ndarray | None = None) -> np.ndarray:
    """Hash of bytes ``first`` to ``last`` after each place (a multiple of 4 bytes); ``buffer`` has 8 bytes to spare."""
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer.tobytes(), 0, (1,))
    out = np.zeros(len(at), np.uint64) if seed is None else seed
    i = first
    while i < last:
        word = words[at + i]
        if last - i < 8:
            word = word & np.uint64((1 << (8 * (last - i))) - 1)
        out = mixed((out ^ word) * _BASE + np.uint64(i + 1))
        i += 8
    return out


def _several(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(values), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _later(hashes: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which strings are not the earliest of their hash; exact ties of rank and start are the same string."""
    order = np.lexsort((start, rank, hashes))
    h, r, s = hashes[order], rank[order], start[order]
    head = np.ones(len(h), bool)
    head[1:] = h[1:] != h[:-1]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))
    out = np.zeros(len(h), bool)
    out[order] = (r != r[lead]) | (s != s[lead])
    return out


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of stretches, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; their types are known to the reader."""
    head = np.array([len(x.tobytes()) for x in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *(x.tobytes() for x in arrays)]))


def _unpacked(packed: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    ends = 8 * len(kinds) + np.cumsum(sizes)
    return [np.frombuffer(raw[e - s : e], kind) for e, s, kind in zip(ends, sizes, kinds, strict=True)]


class _Answers:
    """What was written about a file's rows, fetched once per file. A file of which nothing was found has no folder of its own."""

    def __init__(self, folder: str):
        self.fs, self.folder = arrow_folder(folder)
        if self.fs.get_file_info(self.folder).type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"{folder} is not there, though a pass was to leave its findings in it")
        self.file, self.table = None, None

    def of(self, file: str) -> pa.Table | None:
        if file != self.file:
            path = f"{self.folder}/file={file}"
            there = self.fs.get_file_info(path).type != pafs.FileType.NotFound
            names = [f.path for f in self.fs.get_file_info(pafs.FileSelector(path))] if there else []
            tables = [pq.ParquetFile(self.fs.open_input_file(n)).read() for n in sorted(names) if n.endswith(".parquet")]
            self.file, self.table = file, pa.concat_tables(tables) if tables else None
        return self.table


def _by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Batches cut where the first column, the file, changes."""
    for batch in batches:
        if batch.num_rows:
            names = batch.column(0).to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield names[a], batch.slice(a, b - a)


def _write_by_file(df: DataFrame, path: str) -> None:
    """A folder per file the rows speak of; rows of one file come from one task."""
    df.repartition("file").write.partitionBy("file").option("compression", "zstd").parquet(path)


DIGITS = "bucket int, file string, digits binary"
RUNS = "bucket int, file string, kind int, payload binary"
SPANS = "file string, spans binary"


def _copies(rows: DataFrame) -> DataFrame:
    """Rows (file, row) whose text, of at least ``DEPTH`` bytes, some row of a smaller doc_id has too."""
    keys = ["n", "h1", "h2"]
    narrow = rows.select("file", "row", "doc_id", F.octet_length("raw").alias("n"), F.xxhash64("raw").alias("h1"), F.xxhash64(F.lit(7), "raw").alias("h2"))
    narrow = narrow.where(F.col("n") >= DEPTH)
    # Summed up per task: a text with a third of all rows is one row of each.
    order = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")
    first = narrow.groupBy(*keys).agg(F.min(order).alias("first"), F.max(order).alias("last"))
    first = first.where(~F.col("first").eqNullSafe(F.col("last"))).select(*keys, F.col("first.doc_id").alias("first_id"))
    # Written, so the join knows its size, and has an exchange of its own that adaptive execution can split.
    first = written(first, "repeats-first")
    return narrow.join(first, keys).where(~F.col("doc_id").eqNullSafe(F.col("first_id"))).select("file", "row")


def _digits_of(batches: Iterator[pa.RecordBatch], buckets: int, copies: str) -> Iterator[pa.RecordBatch]:
    answers = _Answers(copies)
    for file, batch in _by_file(batches):
        skip = _skipped(answers.of(file), batch)
        raw, offsets = buffers(batch.column(3))
        found, counts = [], []
        for a, b in row_blocks(offsets, CHUNK_BYTES):
            own = offsets[a : b + 1]
            _, _, values, again = runs(raw[own[0] : own[-1]], own - own[0], skip[a:b])
            found.append(values)
            counts.append(1 + again)
        values, place = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_inverse=True)
        count = np.minimum(np.bincount(place, np.concatenate([np.empty(0), *counts]), len(values)), 1 << 20).astype(np.uint32)
        yield _dealt(values % np.uint64(buckets), buckets, lambda at: (file, _packed(values[at], count[at])), ["file", "digits"])


def _dealt(bucket: np.ndarray, buckets: int, made, names: list[str]) -> pa.RecordBatch:
    """A row per bucket in use, of what ``made`` gives for its members."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1).astype(bucket.dtype))
    rows = [(i, *made(order[ends[i] : ends[i + 1]])) for i in range(buckets) if ends[i] < ends[i + 1]]
    columns = list(zip(*rows, strict=True)) or [()] * (len(names) + 1)
    kinds = {"file": pa.string(), "kind": pa.int32()}
    arrays = [pa.array(columns[0], pa.int32()), *(pa.array(c, kinds.get(n, pa.binary())) for n, c in zip(names, columns[1:], strict=True))]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *names])


def _skipped(copies: pa.Table | None, batch: pa.RecordBatch) -> np.ndarray:
    """Which of the batch's rows are copies of earlier texts."""
    rows = batch.column(1).to_numpy(zero_copy_only=False)
    return np.isin(rows, copies.column("row").to_numpy()) if copies is not None else np.zeros(len(rows), bool)


def _occurring_again(table: pa.Table) -> pa.Table:
    """Of each batch's digits in a bucket, those that occur again anywhere, and which of them are hot."""
    parts = [_unpacked(x.as_py(), "u8", "u4") for x in table["digits"]]
    values = np.concatenate([p[0] for p in parts])
    distinct, place = np.unique(values, return_inverse=True)
    total = np.bincount(place, np.concatenate([p[1] for p in parts]), len(distinct))[place]
    ends = np.cumsum([0, *(len(p[0]) for p in parts)])
    packed = []
    for a, b in zip(ends, ends[1:], strict=False):
        several = total[a:b] > 1
        packed.append(_packed(values[a:b][several], (total[a:b][several] >= HOT_RUNS).astype(np.uint8)))
    return pa.table({"file": table["file"], "digits": pa.array(packed, pa.binary())})


def _runs_of(batches: Iterator[pa.RecordBatch], buckets: int, copies: str, digits: str) -> Iterator[pa.RecordBatch]:
    flags, answers = _Answers(copies), _Answers(digits)
    known_file, known, hot = None, None, None
    for file, batch in _by_file(batches):
        if file != known_file:
            table = answers.of(file)
            parts = [_unpacked(x.as_py(), "u8", "u1") for x in table["digits"]] if table is not None else []
            known = np.concatenate([np.empty(0, np.uint64), *(p[0] for p in parts)])
            hot = np.concatenate([np.empty(0, np.uint8), *(p[1] for p in parts)])
            known, first = np.unique(known, return_index=True)
            known_file, hot = file, hot[first] > 0
        skip = _skipped(flags.of(file), batch)
        rows = batch.column(1).to_numpy(zero_copy_only=False)
        ids = batch.column(2)
        # Null ids come first; texts of one id are told apart by their hashes.
        named = np.array(ids.is_valid())
        numbers = np.where(named, ids.fill_null(0).to_numpy(zero_copy_only=False), np.iinfo(np.int64).min)
        raw, offsets = buffers(batch.column(3))
        texts = batch.column(4).to_numpy(zero_copy_only=False)
        cold, warm = [], []
        for a, b in row_blocks(offsets, CHUNK_BYTES):
            own = offsets[a : b + 1]
            starts, ends, values, _ = runs(raw[own[0] : own[-1]], own - own[0], skip[a:b])
            at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
            kept = known[at] == values if len(known) else np.zeros(len(values), bool)
            is_hot = kept & hot[at] if len(known) else kept
            for out, chosen in ((cold, kept & ~is_hot), (warm, is_hot)):
                out.append((starts[chosen] + own[0], ends[chosen] + own[0], values[chosen]))
        starts, ends, values = (np.concatenate(x) for x in zip(*cold, strict=True))
        if len(starts):
            doc = np.searchsorted(offsets, starts, side="right") - 1

            def payload(at: np.ndarray) -> tuple:
                docs, own = np.unique(doc[at], return_inverse=True)
                count = (ends[at] - starts[at]).astype(np.int32)
                text = raw[_ragged(starts[at], count + DEPTH - 1)]
                return file, 0, _packed(rows[docs], numbers[docs], texts[docs], own.astype(np.int32), (starts[at] - offsets[doc[at]]).astype(np.int32), count, text)

            yield _dealt(values % np.uint64(buckets), buckets, payload, ["file", "kind", "payload"])
        starts, ends, _ = (np.concatenate(x) for x in zip(*warm, strict=True))
        if len(starts):
            yield from _hot_strings(file, raw, offsets, rows, numbers, texts, starts, ends, buckets)


def _hot_strings(file, raw, offsets, rows, numbers, texts, starts, ends, buckets) -> Iterator[pa.RecordBatch]:
    """The strings of hot runs: the earliest of each in this batch goes to the bucket of its hash, the others are repeats."""
    at = _ragged(starts, ends - starts)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    hashes = _window_hashes(padded, at, 0, DEPTH)
    doc = np.searchsorted(offsets, at, side="right") - 1
    start = at - offsets[doc]
    rank = _ranks(numbers, texts)[doc]
    later = _later(hashes, rank, start)
    spans = _merged(rows[doc[later]], start[later], start[later] + DEPTH)
    if len(spans[0]):
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(rows[0]) % buckets], pa.int32()), pa.array([file]), pa.array([2], pa.int32()), pa.array([_packed(*spans)], pa.binary())],
            ["bucket", "file", "kind", "payload"],
        )
    lead = np.flatnonzero(~later)

    def payload(chosen: np.ndarray) -> tuple:
        own = lead[chosen]
        docs, place = np.unique(doc[own], return_inverse=True)
        return file, 1, _packed(rows[docs], numbers[docs], texts[docs], place.astype(np.int32), start[own].astype(np.int32), hashes[own])

    yield _dealt(hashes[lead] % np.uint64(buckets), buckets, payload, ["file", "kind", "payload"])


def _ranks(numbers: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Dense ranks of documents by id, then by the hash of their text."""
    pairs = np.empty(len(numbers), [("id", np.int64), ("text", np.int64)])
    pairs["id"], pairs["text"] = numbers, texts
    return np.unique(pairs, return_inverse=True)[1]


def _merged(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of a row made one, by row and start."""
    if not len(rows):
        return rows.astype(np.int64), starts.astype(np.int64), ends.astype(np.int64)
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order].astype(np.int64), starts[order].astype(np.int64), ends[order].astype(np.int64)
    # Rows are laid out one behind the other, so one running maximum serves all.
    step = int(ends.max()) + 2
    dense = np.unique(rows, return_inverse=True)[1] * step
    reach = np.maximum.accumulate(dense + ends)
    head = np.ones(len(rows), bool)
    head[1:] = dense[1:] + starts[1:] > reach[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(rows)) - 1
    return rows[first], starts[first], reach[last] - dense[last]


def _repeated(table: pa.Table) -> pa.Table:
    """Spans of the strings in a bucket that are not the earliest of their group, for each payload's file."""
    files_, kinds, payloads = table["file"].to_pylist(), table["kind"].to_pylist(), table["payload"].to_pylist()
    out_files, out_spans, parts, texts = [], [], [], []
    size = 0
    for i, (kind, payload) in enumerate(zip(kinds, payloads, strict=True)):
        if kind == 2:
            out_files.append(files_[i])
            out_spans.append(payload)
        elif kind == 0:
            rows, numbers, hashes, own, start, count, text = _unpacked(payload, "i8", "i8", "i8", "i4", "i4", "i4", "u1")
            parts.append((i, rows, numbers, hashes, own, start, count, size))
            texts.append(text)
            size += len(text)
        else:
            rows, numbers, hashes, own, start, digest = _unpacked(payload, "i8", "i8", "i8", "i4", "i4", "u8")
            parts.append((i, rows, numbers, hashes, own, start, digest, -1))
    if parts:
        ends = np.cumsum([0, *(len(p[1]) for p in parts)])
        rank = _ranks(np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]))
        buffer = np.concatenate([*texts, np.zeros(8, np.uint8)])
        source, row, order, start, digest = [], [], [], [], []
        for (i, rows, _, _, own, begin, more, at), first in zip(parts, ends[:-1], strict=True):
            if at >= 0:
                lengths = more + DEPTH - 1
                where = _ragged(at + np.cumsum(lengths) - lengths, more)
                half = _window_hashes(buffer, where, 0, DEPTH // 2 // 8 * 8)
                each = np.repeat(np.arange(len(own)), more)
                begin = _ragged(begin.astype(np.int64), more)
                own, more = own[each], (where, half)
            source.append(np.full(len(own), i, np.int32))
            row.append(rows[own])
            order.append(rank[first + own])
            start.append(begin)
            digest.append(more)
        cold = [d for d in digest if isinstance(d, tuple)]
        # The first half is the next digit; strings alone with theirs are done.
        alive = _several(np.concatenate([np.empty(0, np.uint64), *(d[1] for d in cold)]))
        whole, at = [], 0
        for d in digest:
            if isinstance(d, tuple):
                kept = np.flatnonzero(alive[at : at + len(d[0])])
                at += len(d[0])
                whole.append((kept, _window_hashes(buffer, d[0][kept], DEPTH // 2 // 8 * 8, DEPTH, d[1][kept])))
            else:
                whole.append((np.arange(len(d)), d))
        pick = lambda x: np.concatenate([v[k] for v, (k, _) in zip(x, whole, strict=True)])
        source, row, order, start = pick(source), pick(row), pick(order), pick(start)
        later = _later(np.concatenate([h for _, h in whole]), order, start)
        source, row, start = source[later], row[later], start[later]
        by_source = np.argsort(source, kind="stable")
        cuts = np.searchsorted(source[by_source], np.arange(len(files_) + 1))
        for i in range(len(files_)):
            at = by_source[cuts[i] : cuts[i + 1]]
            if len(at):
                out_files.append(files_[i])
                out_spans.append(_packed(*_merged(row[at], start[at], start[at].astype(np.int64) + DEPTH)))
    return pa.table({"file": pa.array(out_files, pa.string()), "spans": pa.array(out_spans, pa.binary())})


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch], copies: str, spans: str, with_text: bool) -> Iterator[pa.RecordBatch]:
    flags, answers = _Answers(copies), _Answers(spans)
    known_file, known = None, None
    for file, batch in _by_file(batches):
        if file != known_file:
            table = answers.of(file)
            parts = [_unpacked(x.as_py(), "i8", "i8", "i8") for x in table["spans"]] if table is not None else []
            known = _merged(*(np.concatenate([np.empty(0, np.int64), *(p[i] for p in parts)]) for i in range(3)))
            known_file = file
        skip = _skipped(flags.of(file), batch)
        rows = batch.column(1).to_numpy(zero_copy_only=False)
        first, last = np.searchsorted(known[0], rows), np.searchsorted(known[0], rows, side="right")
        sizes, removed, counts, hashes, left = [], [], [], [], []
        for i, text in enumerate(batch.column(3).to_pylist()):
            own = [(0, len(text))] if skip[i] else list(zip(known[1][first[i] : last[i]].tolist(), known[2][first[i] : last[i]].tolist(), strict=True))
            kept, at = [], 0
            for s, e in own:
                kept.append(text[at:s])
                at = e
            kept = b"".join([*kept, text[at:]])
            sizes.append(len(text))
            removed.append(len(text) - len(kept))
            counts.append(len(own))
            hashes.append(hashlib.sha256(kept).hexdigest())
            left.append(kept)
        arrays = [batch.column(2), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts)), pa.array(hashes, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            arrays.append(pa.array(left, pa.binary()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(arrays, names)


def remove_repeats(documents: DataFrame, bucket_bytes: int = BUCKET_BYTES, with_text: bool = False) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    A byte goes if a string of ``DEPTH`` bytes that covers it also starts earlier: in a smaller doc_id, or earlier in the same
    document. Strings are judged on the texts as they come in. Null text is empty; texts under ``DEPTH`` bytes lose
    nothing; null ids come before all others. Rows that repeat id and text are the same document, with the same result each; rows
    that repeat an id with other texts are ordered by a hash of the text. Equality is that of 64-bit hashes of the strings.
    ``bucket_bytes`` is the text one bucket of digits stands for; raise it with the corpus, so buckets times batches stay few.
    """
    spark = documents.sparkSession
    # What a batch sends to a bucket is one row, so batches are larger here.
    bounded_batches(spark, 2 * BATCH_BYTES)
    base = files.qualified(spark, fresh_dir(spark, "repeats"))
    documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("raw")).write.parquet(f"{base}/texts")
    rows = spark.read.parquet(f"{base}/texts").select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), "doc_id", "raw"
    )
    total = rows.agg(F.sum(F.octet_length("raw").cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    copies, digits, spans = f"{base}/copies", f"{base}/digits", f"{base}/spans"
    _write_by_file(_copies(rows), copies)
    found = rows.mapInArrow(lambda x: _digits_of(x, buckets, copies), DIGITS)
    _write_by_file(found.groupBy("bucket").applyInArrow(_occurring_again, "file string, digits binary"), digits)
    sent = rows.withColumn("text_hash", F.xxhash64("raw")).mapInArrow(lambda x: _runs_of(x, buckets, copies, digits), RUNS)
    _write_by_file(sent.groupBy("bucket").applyInArrow(_repeated, SPANS), spans)
    files.remove(spark, digits)
    return rows.mapInArrow(lambda x: _cut(x, copies, spans, with_text), RESULT + (", kept binary" if with_text else ""))
