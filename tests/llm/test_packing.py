import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cdcspark.llm import packing
from cdcspark.llm.common import vocabulary

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary("word_bpe_49k.json")
WHOLE = tokenizers.Tokenizer.from_file(PATH)
WORDS = packing.WordTokenizer(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aE'sΣ .,é\n\t\x1c\x85 <|>endoftx", max_size=40))
def test_ids_are_the_librarys(text):
    assert WORDS.ids([text])[0].tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_long_texts_and_forgotten_words(monkeypatch):
    monkeypatch.setattr(packing, "PART_CHARS", 50)
    words = packing.WordTokenizer(PATH)
    words.MOST_WORDS = 20
    r = random.Random(2)
    texts = [" ".join(r.choice(["don't", "naïve", "x" * 70, "é", "<|endoftext|>", "Σας"]) + str(r.randrange(90)) for _ in range(60)) for _ in range(30)]
    for i in range(0, 30, 3):
        assert [x.tolist() for x in words.ids(texts[i : i + 3])] == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts[i : i + 3]]


def test_pieces_and_sequences(docs):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "gamma,"]) for _ in range(r.choice([1, 30, 700])))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "word " * 9000), (502, "word " * 9000), (None, "x")]
    got = packing.pack(packing.tokenize(docs(rows), PATH), block_pieces=60).collect()
    want = []
    for i, text in rows:
        ids = [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(i, p, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, want))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 4096


def test_no_documents(docs):
    assert packing.pack(packing.tokenize(docs([]), PATH)).collect() == []


def test_ids_can_be_kept(docs):
    row = packing.tokenize(docs([(1, "hello world")]), PATH, with_ids=True).first()
    assert row.ids == [*WHOLE.encode("hello world", add_special_tokens=False).ids, 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=80))
def test_search_never_needs_more_bins(sizes):
    first = packing.best_fit_decreasing(sizes, 100)
    better = packing.improve(sizes, first, 100)
    assert sorted(i for b in better for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in better) and len(better) <= len(first)
    assert len(better) >= -(-sum(sizes) // 100)


def test_search_empties_bins_that_best_fit_leaves():
    r = random.Random(1)
    sizes = [r.randint(1300, 2100) for _ in range(3000)]
    first = packing.best_fit_decreasing(sizes, 4096)
    assert len(packing.improve(sizes, first, 4096)) < len(first)
