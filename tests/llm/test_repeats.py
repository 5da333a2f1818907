import hashlib
import random

import pytest

from cdcspark.llm import repeats


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        hit = [False] * len(raw)
        for s in range(len(raw) - repeats.DEPTH + 1):
            part = raw[s : s + repeats.DEPTH]
            if part in seen:
                hit[s : s + repeats.DEPTH] = [True] * repeats.DEPTH
            seen.add(part)
        kept = bytes(b for b, h in zip(raw, hit, strict=True) if not h)
        spans = sum(h and not (k and hit[k - 1]) for k, h in enumerate(hit))
        out[i] = (len(raw), sum(hit), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df, **options).collect()}


def corpus(seed, size):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    passage = [" ".join(word() for _ in range(40)) for _ in range(4)]
    rows = []
    for i in range(size):
        kind = r.random()
        if kind < 0.2 and rows:
            text = r.choice(rows)[1]
        elif kind < 0.4 and rows:
            text = r.choice(rows)[1]
            at = r.randrange(len(text) + 1)
            text = text[:at] + r.choice("xyz") + text[at:]
        else:
            text = " ".join(word() for _ in range(r.choice([2, 30, 90])))
            if r.random() < 0.6:
                text += r.choice(passage)[r.randrange(20) :] + word()
            if r.random() < 0.1:
                text += "la " * 90
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("hot", [3, 2000])
def test_equals_brute_force(docs, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_RUNS", hot)
    rows = corpus(hot, 160)
    assert found(docs(rows), bucket_bytes=8_000) == brute(rows)


def test_the_order_of_ids_decides_not_that_of_rows(docs):
    a, b = "x" * 40 + "the passage " * 12, "the passage " * 12 + "y" * 40
    rows = [(9, a), (2, b)]
    assert found(docs(rows).repartition(2)) == brute(rows)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "a" * 99), (4, "a" * 99), (5, "b" * 100), (6, "b" * 100), (7, "c" * 500), (8, "é" * 60)]
    assert found(docs(rows)) == brute(rows)
    assert repeats.remove_repeats(docs([])).collect() == []


def test_null_ids_come_first_and_repeated_rows_agree(docs):
    text = " ".join(map(str, range(100)))
    got = repeats.remove_repeats(docs([(None, text), (4, text), (4, text), (5, "z" + text), (5, "z" + text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (4, 289), (4, 289), (5, 289), (5, 289)]


def test_a_very_long_text(docs, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 10_000)
    r = random.Random(1)
    text = "".join(r.choice("abcd") for _ in range(150_000))
    rows = [(1, text), (2, "q" + text[70_000:70_300])]
    got = found(docs(rows))
    assert got[1][1] == 0 and got[2][:3] == (301, 300, 1)


def test_the_kept_bytes_can_be_asked_for(docs):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    got = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(docs([(1, text), (2, "new " + text + " end")]), with_text=True).collect()}
    assert got == {1: text.encode(), 2: b"new  end"}


def test_findings_that_are_not_there_are_an_error(tmp_path):
    import pytest

    (tmp_path / "found").mkdir()
    assert repeats._Answers(f"file:{tmp_path}/found").of("part-0") is None
    with pytest.raises(FileNotFoundError, match="is not there"):
        repeats._Answers(f"file:{tmp_path}/lost")
    with pytest.raises(ValueError, match="full address"):
        repeats._Answers(str(tmp_path / "found"))
