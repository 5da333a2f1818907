"""Packing of tokenised documents into sequences of a fixed length, by swap-based local search.

Tokenising: the vocabulary's merges stay inside words, so each distinct run of characters between white space is
tokenised once by the library and looked up afterwards. Texts where that could differ (special tokens, characters whose
form depends on their neighbours, separators that libraries read differently) go through the library whole.

Packing: pieces are dealt evenly into blocks of bounded size, whatever their ids or lengths are. In a block, best fit
decreasing gives a first packing; then the search takes documents out of the emptiest bins by moves, one-for-one and
two-for-one exchanges that raise the sum of squared fills, until the bins are as few as the tokens allow or nothing helps.
Blocks are independent, so the work is linear in the corpus, and a lost block is packed again with the same result.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import bounded_batches
from cdcspark.session import written

LENGTH = 4096
END_ID = 1

#: Pieces of a block, on average.
BLOCK_PIECES = 30_000

#: Exchanges tried per block, and bins in a row that no exchange helped before the search ends.
STEPS, PATIENCE = 4_000, 40

#: Longest part of a text that is handled at once (it is cut at white space only).
PART_CHARS = 1 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Places(dict):
    """Numbers of words in order of appearance; ``new`` lists those seen since it was last emptied."""

    def __init__(self):
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self.chars += len(word)
        self[word] = found = len(self)
        return found


class WordTokenizer:
    """Ids of texts under a vocabulary file whose merges never cross white space (see the module's text)."""

    #: The separators that only Python takes for white space, and letters with a lower case that depends on others.
    UNUSUAL = re.compile("[\x1c-\x1fİΣ]")
    #: Words and characters of them that are remembered; beyond that, the later half is forgotten.
    MOST_WORDS, MOST_CHARS = 500_000, 16 << 20
    #: Words tokenised in one call.
    CALL_WORDS = 10_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        self.places = _Places()
        self.flat = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def _learn(self) -> None:
        new, found, lengths = self.places.new, [self.flat], []
        for i in range(0, len(new), self.CALL_WORDS):
            ids = [x.ids for x in self.whole.encode_batch_fast(new[i : i + self.CALL_WORDS], add_special_tokens=False)]
            lengths += map(len, ids)
            found.append(np.fromiter(chain.from_iterable(ids), np.uint32))
        self.flat = np.concatenate(found)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        self.places.new = []

    def _forget(self) -> None:
        """Keeps the words seen first, which are the frequent ones."""
        chars, kept = 0, []
        for word in self.places:
            chars += len(word)
            if len(kept) >= self.MOST_WORDS // 2 or chars > self.MOST_CHARS // 2:
                break
            kept.append(word)
        self.places = _Places()
        self.places.update(zip(kept, range(len(kept)), strict=True))
        self.ends = self.ends[: len(kept) + 1].copy()
        self.flat = self.flat[: self.ends[-1]].copy()
        self.places.chars = sum(map(len, kept))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; new words of all of them are tokenised together."""
        if len(self.places) > self.MOST_WORDS or self.places.chars > self.MOST_CHARS:
            self._forget()
        found = [[self._part(x) for x in _parts(text)] for text in texts]
        if self.places.new:
            self._learn()
        return [np.concatenate([np.empty(0, np.uint32), *map(self._looked_up, parts)]) for parts in found]

    def _part(self, text: str) -> np.ndarray:
        """Places of the part's words, or its ids if it has to be tokenised whole."""
        if "<|" in text or self.UNUSUAL.search(text) or not unicodedata.is_normalized("NFC", text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        words = text.lower().split()
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def _looked_up(self, at: np.ndarray) -> np.ndarray:
        if at.dtype == np.uint32 or not len(at):
            return at.astype(np.uint32)
        begin = self.ends[at]
        lengths = self.ends[at + 1] - begin
        total = np.cumsum(lengths)
        return self.flat[np.repeat(begin - total + lengths, lengths) + np.arange(total[-1])]


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str, most_words: int = WordTokenizer.MOST_WORDS) -> WordTokenizer:
    """One per worker process, so tasks go on with the words that earlier ones met."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    found = _loaded[path]
    found.MOST_WORDS, found.MOST_CHARS = most_words, 32 * most_words
    return found


def _parts(text: str) -> Iterator[str]:
    """The text cut at white space into parts of about ``PART_CHARS``."""
    cut = re.compile("[ \n]")
    first = 0
    while len(text) - first > PART_CHARS:
        found = cut.search(text, first + PART_CHARS)
        if not found:
            break
        yield text[first : found.start()]
        first = found.start()
    yield text[first:]


def tokenize(
    documents: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False,
    most_words: int = WordTokenizer.MOST_WORDS,
) -> DataFrame:
    """Pieces of at most ``length`` ids of every document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    Each document is its ids and then ``end_id``; null or empty text is ``end_id`` alone. Only longer documents are
    cut. Columns other than doc_id and text are ignored; repeated rows give repeated pieces. ``tokenizer`` is the path of a
    vocabulary file that every executor has; ``most_words`` bounds the words a worker remembers, and so its memory.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, most_words)
        for batch in batches:
            rows: list[tuple] = []
            kept: list[np.ndarray] = []
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc_id, own_ids in zip(batch.column(0).to_pylist(), words.ids(texts), strict=True):
                ids = np.append(own_ids, np.uint32(end_id))
                for piece, start in enumerate(range(0, len(ids), length)):
                    own = ids[start : start + length].astype("<u4")
                    rows.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
                    if with_ids:
                        kept.append(own)
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in kept], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    bounded_batches(documents.sparkSession)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices; each size enters the fullest bin that still takes it."""
    room = 0  # bit r is set if a bin with r free places exists
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fits = room >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            own = free[left].pop()
            if not free[left]:
                room &= ~(1 << left)
        else:
            left, own = capacity, len(bins)
            bins.append([])
        bins[own].append(i)
        if left > size:
            free[left - size].append(own)
            room |= 1 << (left - size)
    return bins


def improve(sizes: list[int], bins: list[list[int]], capacity: int, steps: int = STEPS, patience: int = PATIENCE) -> list[list[int]]:
    """The same items in as few or fewer bins, by exchanges between underfull bins that raise the sum of squared fills.

    The emptiest bin gives: an item moves to another bin, or one or two of its items change places with one smaller item
    there. Every exchange makes another bin fuller than the emptiest was, so the search ends by itself; ``steps`` and
    ``patience`` bound its effort, not what is packed.
    """
    size = np.array(sizes, np.int64)
    least = -(-int(size.sum()) // capacity)
    full = [b for b in bins if sum(sizes[i] for i in b) == capacity]
    open_bins = [list(b) for b in bins if sum(sizes[i] for i in b) < capacity]
    fill = np.array([sum(sizes[i] for i in b) for b in open_bins], np.int64)
    own = np.full(len(sizes), -1)
    for b, items in enumerate(open_bins):
        own[items] = b
    stuck: set[int] = set()
    empty = 0
    for _ in range(steps):
        if len(bins) - empty <= least or len(stuck) >= patience:
            break
        order = np.argsort(fill, kind="stable")
        w = next((int(b) for b in order if fill[b] > 0 and int(b) not in stuck), None)
        if w is None:
            break
        items = np.flatnonzero((own >= 0) & (own != w))
        places = own[items]
        room = capacity - fill[places]
        best = (0, None, None, None)
        mine = open_bins[w]
        singles = [(sizes[i], (i,)) for i in mine]
        pairs = [(sizes[i] + sizes[j], (i, j)) for k, i in enumerate(mine[:12]) for j in mine[k + 1 : 12]]
        for total, out in singles:
            gain = np.where((capacity - fill >= total) & (fill > 0), total * (fill - fill[w] + total), 0)
            gain[w] = 0
            b = int(gain.argmax())
            if gain[b] > best[0]:
                best = (int(gain[b]), out, b, None)
        for total, out in singles + pairs:
            if not len(items):
                break
            delta = total - size[items]
            gain = np.where((delta > 0) & (delta <= room), delta * (fill[places] - fill[w] + delta), 0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (int(gain[k]), out, int(places[k]), int(items[k]))
        gain, out, b, back = best
        if not gain:
            stuck.add(w)
            continue
        stuck.clear()
        for i in out:
            open_bins[w].remove(i)
            open_bins[b].append(i)
            own[i] = b
        if back is not None:
            open_bins[b].remove(back)
            open_bins[w].append(back)
            own[back] = w
        for x in (w, b):
            fill[x] = sum(sizes[i] for i in open_bins[x])
        empty += not open_bins[w]
        if fill[b] == capacity:
            own[open_bins[b]] = -1
    return full + [b for b in open_bins if b]


def pack(pieces: DataFrame, length: int = LENGTH, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """``pieces`` (column length, at most ``length``) with sequence_id and offset, gapless from 0 in every sequence.

    An empty table gives an empty one. Lengths over ``length`` raise an error.
    """
    held = written(pieces, "pieces")
    rows = held.count()
    blocks = max(1, -(-rows // block_pieces))
    # The number of a row in its file part: rows are dealt in turn, so equal keys cannot meet in one block.
    dealt = held.withColumn("_block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)))

    def work(block: pa.Table) -> pa.Table:
        sizes = block["length"].to_pylist()
        if max(sizes) > length:
            raise ValueError(f"a piece is longer than {length}")
        bins = improve(sizes, best_fit_decreasing(sizes, length), length)
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        first = block["_block"][0].as_py() << 32
        for b, items in enumerate(bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = first + b, at
                at += sizes[i]
        block = block.drop_columns(["_block"])
        return block.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("_block").applyInArrow(work, schema)
