"""Spelling variants: words one edit apart, found by products of letter-count matrices.

Words lie in blocks by length and, within a length, by how many of their letters fall into each of a few groups. One
replaced, inserted or deleted letter moves a word to the same block or to one of few neighbours, so only those meet. For two blocks a
product of their letter-count matrices gives all squared distances at once; pairs at most two apart are then verified letter by letter, inside
the same task. No pair of words leaves it but those that are near.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import Workspace, bounded_batches, buffers, text_bytes
from cdcspark.session import written

#: Words that count have this many letters and occurrences.
MIN_LETTERS, MIN_COUNT = 5, 3

#: A form has at least so many times the occurrences of the word.
FORM_TIMES = 2

#: One in so many runs of a document loses a letter.
DAMAGED = 97

#: Letters after A-Z were lower-cased, and the groups they fall into.
FIRST, LAST, GROUPS = "a", "ÿ", 6

#: Words and letters of a block; a fuller block is dealt into several by hash.
BLOCK_WORDS, BLOCK_LETTERS = 512, 16_384

#: Blocks whose letters and counts a task remembers; blocks that meet the same one come one after the other.
REMEMBERED = 16

#: Letters of text looked at together; a longer run of letters is taken whole.
SLICE = 1 << 20

_RUN = re.compile("[a-zÀ-ÿ]+")
_BREAK = re.compile("[^a-zÀ-ÿ]")


def _slices(text: str) -> Iterator[str]:
    """The text in parts that end between runs of letters."""
    at = 0
    while len(text) - at > SLICE:
        found = _BREAK.search(text, at + SLICE)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """Words of a text whose A-Z are lower-cased, with how often each occurs; one in ``DAMAGED`` of its distinct runs lacks a letter."""
    counts: Counter[str] = Counter()
    for part in _slices(text):
        counts.update(_RUN.findall(part))
    if doc_id is None:
        yield from counts.items()
        return
    start, crc = zlib.crc32(b"%d:" % doc_id), zlib.crc32
    for word, n in counts.items():
        h = crc(word.encode(), start)
        if h % DAMAGED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def vocabulary_of(documents: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """Rows (word, n) of all words of at least ``min_letters`` letters and ``min_count`` occurrences; counts are summed before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            data, counts = raw.tobytes().lower(), Counter()
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                for word, n in words_of(doc_id, data[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")):
                    if len(word) >= min_letters:
                        counts[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    bounded_batches(documents.sparkSession)
    found = documents.select(F.col("doc_id").cast("long"), text_bytes().alias("raw")).mapInArrow(work, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _letters() -> list[str]:
    return [chr(c) for c in (*range(ord(FIRST), ord("z") + 1), *range(0xC0, ord(LAST) + 1))]


def _cell():
    """How many letters of a word are in each group."""
    groups = ["".join(c for c in _letters() if ord(c) % GROUPS == g) for g in range(GROUPS)]
    return F.array(*[F.char_length("word") - F.char_length(F.translate("word", letters, "")) for letters in groups])


def _meeting():
    """The blocks that a word's block meets, those of more letters and, of as many, one of each two."""
    moves = [()]
    moves += [((g, 1),) for g in range(GROUPS)]
    moves += [((g, -1), (h, 1)) for g in range(GROUPS) for h in range(g + 1, GROUPS)]
    own = [F.get("cell", F.lit(g)) for g in range(GROUPS)]
    return F.array(*[F.array(*[own[g] + dict(move).get(g, 0) for g in range(GROUPS)]) for move in moves])


class Block:
    """Words with one number of letters: their code points, and how often each letter is in each word."""

    def __init__(self, words: list[str]):
        longest = max(map(len, words))
        self.codes = np.array(words, f"U{longest}").view(np.uint32).reshape(len(words), longest)
        self.letters = longest
        place = np.where(self.codes >= 0xC0, self.codes - 0xC0 + 26, self.codes - ord(FIRST)).astype(np.int64)
        width = 26 + 64
        counts = np.bincount((np.arange(len(words))[:, None] * width + place).ravel(), minlength=len(words) * width)
        self.counts = counts.reshape(len(words), width).astype(np.float32)
        self.used = self.counts.any(0)
        self.half = (self.counts**2).sum(1, keepdims=True) / 2


def near_pairs(left: Block, right: Block, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``left`` and ``right`` of all words that one edit takes into each other; of one block, each pair once.

    The words of ``right`` have as many letters as those of ``left`` or one more.
    """
    used = left.used | right.used
    one, other = np.ones_like(left.half), np.ones_like(right.half)
    # The squares are two more columns, so the product is minus half the squared distance; halves are exact in float32.
    a = np.hstack([left.counts[:, used], -left.half, one])
    b = np.hstack([right.counts[:, used], other, -right.half])
    close = np.flatnonzero((a @ b.T).ravel() >= -1)
    x, y = close // len(b), close % len(b)
    if same:
        x, y = x[x < y], y[x < y]
    ok, n = np.zeros(len(x), bool), left.letters
    # A bounded number of pairs at a time, so that their letters stay small.
    step = max(1, (1 << 20) // n)
    for first in range(0, len(x), step):
        part = slice(first, first + step)
        u, v = left.codes[x[part]], right.codes[y[part]]
        if right.letters == n:
            ok[part] = (u != v).sum(1) == 1
        else:
            ahead = np.logical_and.accumulate(u == v[:, :n], axis=1).sum(1)
            behind = np.logical_and.accumulate((u == v[:, 1:])[:, ::-1], axis=1).sum(1)
            ok[part] = ahead + behind >= n
    return x[ok], y[ok]


def near_words(vocabulary: DataFrame, space: Workspace) -> DataFrame:
    """Rows (a, na, b, nb): every two words (word, n) that differ by one inserted, deleted or replaced letter, once."""
    placed = vocabulary.select("word", "n", _cell().alias("cell"))
    words, letters = F.count(F.lit(1)) / BLOCK_WORDS, F.sum(F.char_length("word")) / BLOCK_LETTERS
    sizes = placed.groupBy("cell").agg(F.ceil(F.greatest(words, letters)).alias("parts"))
    dealt = placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")))
    blocks = dealt.groupBy("cell", "part").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("ns"))
    blocks = space.written(blocks, "blocks")
    left = blocks.select(F.explode(_meeting()).alias("meets"), "cell", "part", "words", "ns")
    right = blocks.select(
        F.col("cell").alias("meets"), F.col("part").alias("other"), F.col("words").alias("words2"), F.col("ns").alias("ns2")
    )
    own = F.col("cell") == F.col("meets")
    met = left.join(right, "meets").where(~own | (F.col("part") <= F.col("other")))
    met = met.select(
        "words", "ns", "words2", "ns2", (own & (F.col("part") == F.col("other"))).alias("same"),
        F.concat_ws(" ", F.concat_ws(",", F.col("meets").cast("array<string>")), "other").alias("id"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Block] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                words, ns, words2, ns2 = (batch.column(c)[r].values for c in range(4))
                key = batch.column(5)[r].as_py()
                if key not in known:
                    if len(known) == REMEMBERED:
                        known.clear()
                    known[key] = Block(words2.to_pylist())
                same = batch.column(4)[r].as_py()
                x, y = near_pairs(known[key] if same else Block(words.to_pylist()), known[key], same)
                if len(x):
                    x, y = pa.array(x), pa.array(y)
                    yield pa.RecordBatch.from_arrays([words.take(x), ns.take(x), words2.take(y), ns2.take(y)], ["a", "na", "b", "nb"])

    bounded_batches(vocabulary.sparkSession)
    return met.mapInArrow(work, "a string, na long, b string, nb long")


def _roots(forms: DataFrame, space: Workspace) -> DataFrame:
    """Rows (word, root) of a table (word, form): the last form along the way.

    A form occurs at least twice as often as its word, so no way leads back, and it has at most as many steps as the
    largest count has binary digits. Each round doubles the steps taken.
    """
    ways = space.written(forms.select("word", F.col("form").alias("root")), "ways-0")
    turn = 0
    while True:
        turn += 1
        ahead = ways.select(F.col("word").alias("at"), F.col("root").alias("next"))
        joined = ways.join(ahead, F.col("root") == F.col("at"), "left")
        ways = space.written(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"ways-{turn}")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def spelling_variants(documents: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """Per word of a table (doc_id, text): word, form, root, n, n_near and form_n.

    Words are runs of letters (a-z after A-Z were lower-cased, and U+00C0 to U+00FF) of whole texts; a null text has none. One
    in ``DAMAGED`` distinct runs of a document, told by a checksum of its id and the run, loses a letter first. Texts without an id
    lose none. Rows that repeat each other count each. Words with fewer letters or occurrences are not returned. The form
    is the near word of most occurrences, the smallest of several, if it has ``FORM_TIMES`` the word's own. An empty table gives no rows.
    """
    space = Workspace(documents.sparkSession, "spelling")
    vocabulary = space.written(vocabulary_of(documents, min_letters, min_count), "vocabulary")
    pairs = near_words(vocabulary, space)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    # A word that many are near to is summed up before the shuffle.
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), F.col("b").alias("word"))).alias("best")
    )
    named = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n")
    )
    enough = F.col("form_n") >= FORM_TIMES * F.col("n")
    named = space.written(
        named.withColumn("form", F.when(enough, F.col("form"))).withColumn("form_n", F.when(enough, F.col("form_n"))), "named"
    )
    roots = _roots(named.where("form IS NOT NULL"), space)
    result = named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
    result = written(result, "spelling-variants")
    space.remove()
    return result
