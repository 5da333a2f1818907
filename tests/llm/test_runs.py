"""Runs of words against the definition."""

import random
from hashlib import sha256

import numpy as np
import pytest

from cdcspark.llm import runs
from cdcspark.llm.queries import _looped


def brute_runs(words, least=24, times=3):
    """For every period the longest stretches that keep it, those with a smaller period left out."""
    n, out = len(words), []
    for p in range(1, n // times + 1):
        s = 0
        while s + p < n:
            if words[s] != words[s + p]:
                s += 1
                continue
            e = s + p
            while e < n and words[e] == words[e - p]:
                e += 1
            own = words[s:e]
            if e - s >= max(least, times * p) and not any(own[q:] == own[:-q] for q in range(1, p)):
                out.append((s, e - s, p))
            s = e - p + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_lyndon(x):
    """The next smaller suffix ends the longest Lyndon word."""
    n = len(x)
    return [next((j for j in range(i + 1, n) if x[j:] < x[i:]), n) - i for i in range(n)]


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def loops(draw, size, letters):
    """Words with stretches that repeat, inside each other too."""
    x = [draw.choice(letters) for _ in range(size)]
    for _ in range(draw.randint(0, 3)):
        p = draw.randint(1, 12)
        at = draw.randint(0, len(x))
        x[at:at] = (x[at : at + p] or ["q"]) * draw.randint(2, 12)
    return x


def test_lyndon_arrays():
    draw = random.Random(1)
    for _ in range(1500):
        k = draw.randint(1, 4)
        x = [draw.randrange(k) for _ in range(draw.randint(0, 40))]
        x = [sorted(set(x)).index(v) for v in x]
        if draw.random() < 0.5:
            x = x * draw.randint(1, 4)
        assert runs.lyndon_array(x) == brute_lyndon(x)


def test_extensions():
    draw = np.random.Generator(np.random.PCG64(2))
    for n in (1, 2, 3, 17, 64, 200):
        x = np.tile(draw.integers(0, 3, max(n // 3, 1)), 4)[:n]
        i, j = draw.integers(0, len(x) + 1, (2, 300))
        i, j = np.minimum(i, j), np.maximum(i, j)
        i, j = i[i < j], j[i < j]
        ext = runs.Extensions(x)
        right = [next((k for k in range(len(x) - b) if x[a + k] != x[b + k]), len(x) - b) for a, b in zip(i, j)]
        left = [next((k for k in range(a) if x[a - 1 - k] != x[b - 1 - k]), a) for a, b in zip(i, j)]
        assert ext.right(i, j).tolist() == right and ext.left(i, j).tolist() == left


@pytest.mark.parametrize("letters", ["ab", "abcd", "abcdefghijklmnop"])
def test_runs_of_many_documents(letters):
    draw = random.Random(len(letters))
    texts = [loops(draw, draw.randint(0, 80), letters) for _ in range(120)]
    number = {c: i for i, c in enumerate(letters + "q")}
    starts = np.cumsum([0, *map(len, texts)])
    found = runs.find_runs(np.array([number[w] for t in texts for w in t]), starts[:-1])
    want = [(s + a, n, p) for t, a in zip(texts, starts) for s, n, p in brute_runs(t)]
    assert list(map(tuple, found.tolist())) == want and len(want) > 20


def test_other_limits():
    draw = random.Random(9)
    for _ in range(200):
        x = loops(draw, draw.randint(0, 40), "abc")
        ids = np.array([ord(c) for c in x], np.int64)
        assert list(map(tuple, runs.find_runs(ids, np.array([0]), 9, 4).tolist())) == brute_runs(x, 9, 4)


def test_collapsed_texts(spark, docs):
    draw = random.Random(3)
    rows = [(i, " ".join(loops(draw, draw.randint(0, 90), ["é", "B", "b", "x y", "z z", ""]))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " \t\n"), (None, "a " * 30), (None, None), (63, "\t".join("ab" * 20)), *rows[:5], (3, "other text")]
    got = sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in runs.collapse_runs(docs(rows)).collect() if r.doc_id is not None)
    want = []
    for doc_id, text in rows:
        words = (text or "").replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        if doc_id is not None:
            want.append((doc_id, len(words), brute_runs(words), collapsed(words, brute_runs(words))))
    assert got == sorted(want)
    nameless = [r.text for r in runs.collapse_runs(docs(rows)).where("doc_id IS NULL").collect()]
    assert sorted(nameless) == ["", "a"]


def test_a_long_text(spark, docs):
    draw = random.Random(4)
    words = [f"w{draw.randrange(3000)}" for _ in range(60_000)]
    words[20_000:20_000] = words[500:700] * 40
    words += ["la"] * 100_000
    (row,) = runs.collapse_runs(docs([(1, " ".join(words))])).collect()
    assert [(r.start, r.length, r.period) for r in row.runs] == [(20_000, 8_000, 200), (68_000, 100_000, 1)]
    assert len(row.text.split(" ")) == 60_000 + 200 + 1


def test_query_equals_brute_force(spark, tmp_path, docs):
    draw = random.Random(6)
    rows = [(i, " ".join(loops(draw, draw.randint(0, 200), "abcdefgh"))) for i in range(150)] + [(150, None), (151, "")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    from cdcspark.llm.queries import op11_lyndon_runs

    got = {r.doc_id: tuple(r)[1:] for r in op11_lyndon_runs(spark, str(tmp_path)).collect()}
    want = {}
    for doc_id, text in rows:
        words = [w.decode() for w in _looped(doc_id, (text or "").encode().split())]
        found = brute_runs(words)
        best = (None,) * 4
        for s, n, p in found:
            if best[0] is None or n * best[2] > best[1] * p:
                best = (s, n, p, 1000 * n // p)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        want[doc_id] = (len(found), *best, sha256(lines.encode()).hexdigest(), sha256(collapsed(words, found).encode()).hexdigest())
    assert got == want and sum(w[0] > 0 for w in want.values()) > 20


def test_loops_of_the_contract():
    from zlib import crc32

    doc_id = next(i for i in range(1000) if crc32(str(i).encode()) % 10 == 0)
    h, words = crc32(str(doc_id).encode()), [b"%d" % i for i in range(100)]
    a = h // 10 % 100
    p = 1 + (100 - a) // (3 + h // 10 % 8)
    assert _looped(doc_id, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(100)]
    assert _looped(doc_id, []) == [] and _looped(next(i for i in range(99) if crc32(str(i).encode()) % 10), words) == words


def test_empty_table(spark, docs):
    assert runs.collapse_runs(docs([])).collect() == []
