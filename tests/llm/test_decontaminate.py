import random
import re

import pytest

from cdcspark.llm import common, decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items):
    out = []
    for i, text in documents:
        own, hit, found = words(text), set(), set()
        for item, passage in items:
            w = words(passage)
            size = min(13, len(w))
            windows = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
            for k in range(len(own) - size + 1 if w else 0):
                if tuple(own[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found.add(item)
        out.append((i, len(own), len(hit), sorted(str(f) for f in found if f is not None), len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def bench(spark, items):
    return spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, len int")


def found(documents, benchmark):
    rows = decontaminate.contamination(documents, benchmark).collect()
    assert all(r.n_items == len(r["items"]) for r in rows)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows), key=repr)


@pytest.fixture(params=[common.BROADCAST_ROWS, 0], ids=["broadcast", "shuffle"])
def joins(request, monkeypatch):
    """Both ways to meet the benchmark."""
    monkeypatch.setattr(decontaminate, "small", lambda df, rows: common.small(df, rows, request.param))


def test_equals_brute_force(spark, docs, joins):
    r = random.Random(4)
    vocabulary = ["a", "b", "c", "É", "é", "x1", "ZZ", "日本"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([13, 14, 20, 40])))) for i in range(12)]
    items += [(50, "A b, c! a"), (51, "rare"), (52, None), (53, "... !!"), (5, "other text of an item that has its id twice a b c d e f")]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for i in range(80)]
    for i in range(80, 140):
        w = words(r.choice(items[:12])[1])
        a = r.randrange(len(w))
        rows.append((i, "pre " * r.randint(0, 300) + "-".join(w[a : a + r.randint(1, 40)]).upper().replace("É", "É") + " post" * r.randint(0, 9)))
    assert found(docs(rows), bench(spark, items)) == brute(rows, items)


def test_odd_rows(spark, docs):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, "!!"), (4, item), (4, item), (None, item), (5, "x " * 100_000 + item)]
    assert found(docs(rows), bench(spark, [(7, item), (None, item)])) == brute(rows, [(7, item)])
    assert found(docs([]), bench(spark, [(7, item)])) == []
    assert found(docs(rows), bench(spark, [])) == brute(rows, [])
    assert found(docs(rows), bench(spark, [(1, None), (2, "--")])) == brute(rows, [])


def test_documents_go_or_lose_their_spans(spark, docs):
    item = " ".join(f"w{i}" for i in range(13))
    rows = [(1, f"before, {item}! after"), (2, "clean"), (3, None), (4, "x " * 400 + item)]
    benchmark = bench(spark, [(7, item)])
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs(rows), benchmark).collect()) == [2, 3, 4]
    got = {r.doc_id: r.text for r in decontaminate.remove_spans(docs(rows), benchmark).collect()}
    assert got == {1: "before after", 2: "clean", 3: None, 4: "x " * 399 + "x"} or got[1] == "before! after"
