"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from cdcspark.llm import spelling


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for word in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    words = brute_words(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 2 * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def found(spark, docs, rows):
    return {tuple(r) for r in spelling.spelling_variants(docs(rows)).collect()}


def near_texts(seed, n):
    """Texts of words and their edits, some very frequent, with anagrams among them."""
    draw = random.Random(seed)
    letters = "abcdeéÿÀß"
    stems = ["".join(draw.choices(letters, k=draw.randint(5, 9))) for _ in range(25)]
    stems += ["".join(draw.sample(s, len(s))) for s in stems[:10]]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randint(0, 60)):
            w = stems[min(int(draw.expovariate(0.2)), len(stems) - 1)]
            if draw.random() < 0.4:
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice(letters) + w[at:], w[:at] + draw.choice(letters) + w[at + 1 :]])
            words.append(w.upper() if draw.random() < 0.1 else w)
        rows.append((i, draw.choice([" ", ", ", "1", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("block", [512, 3])
def test_equals_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    rows = near_texts(12, 60)
    rows += [(None, "wörter ohne namen " * 5), (None, None), (99, ""), (100, None), (101, "1 2 3"), *rows[:5], (4, rows[7][1])]
    assert found(spark, docs, rows) == brute(rows)


def test_forms_ties_and_roots(spark, docs):
    text = " ".join(["house"] * 40 + ["hause"] * 12 + ["hausa"] * 4 + ["haues"] * 4 + ["horse"] * 40 + ["hoise"] * 5 + ["mouse"] * 39)
    rows = [(None, text)]
    got = {r[0]: r for r in found(spark, docs, rows)}
    assert {tuple(r) for r in got.values()} == brute(rows)
    # horse and house are as frequent: the smaller is the form. hausa leads to house over hause.
    assert got["hoise"][1] == "horse" and got["hausa"][1:3] == ("hause", "house") and got["house"][1] is None


def test_long_texts_and_long_words(spark, docs, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 50)
    long = "x" * 400
    rows = [(1, "abcde " * 5_000 + "abcdé " * 100), (2, f"{long} " * 3 + f"{long}y " * 9 + "." * 500)]
    assert found(spark, docs, rows) == brute(rows)


def test_a_hot_cell_is_dealt_into_blocks():
    draw = random.Random(5)
    words = sorted({"".join(draw.choices("ae", k=10)) for _ in range(400)})
    block = spelling.Block(words)
    x, y = spelling.near_pairs(block, block, True)
    assert {(words[i], words[j]) for i, j in zip(x, y)} == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_empty_table(spark, docs):
    assert found(spark, docs, []) == set()
