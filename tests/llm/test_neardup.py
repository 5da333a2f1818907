import random
import re

from cdcspark.llm import neardup
from cdcspark.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}


def corpus(seed, size):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = "this passage stands in very many of the documents here"
    rows, bases = [], []
    for i in range(size):
        kind = r.random()
        if kind < 0.45 and bases:
            words = list(r.choice(bases[:3] if kind < 0.3 else bases))
            for _ in range(r.randint(0, max(1, len(words) // 12))):
                words[r.randrange(len(words))] = r.choice(vocabulary)
        else:
            words = [r.choice(vocabulary) for _ in range(r.choice([1, 3, 5, 8, 40, 120]))]
            bases.append(words)
        text = " ".join(words)
        rows.append((i, text + ("\n" + line if r.random() < 0.3 else "")))
    return rows


def test_equals_brute_force(docs):
    for seed in (1, 2):
        rows = corpus(seed, 260)
        assert found(docs(rows)) == brute(rows)


def near_copies(size, words=120, seed=5):
    """One group: a text with one to three words changed."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(size):
        own = list(base)
        for _ in range(r.randint(1, 3)):
            own[r.randrange(words)] = f"c{r.randrange(100_000)}"
        rows.append((i, " ".join(own)))
    return rows


def test_links_do_not_grow_with_the_square_of_a_group(docs, monkeypatch):
    rows, fed, compared = near_copies(3_200), [], []
    real, real_compared = neardup.components, neardup._compared

    def counted(links):
        fed.append(links.count())
        return real(links)

    def counted_pairs(pairs, sets, percent):
        compared.append(pairs.count())
        return real_compared(pairs, sets, percent)

    monkeypatch.setattr(neardup, "components", counted)
    monkeypatch.setattr(neardup, "_compared", counted_pairs)
    got = found(docs(rows))
    assert all(v[1] == 0 for v in got.values()) and len(fed) >= 2
    assert sum(fed) <= 3 * len(rows) and sum(compared) <= 12 * len(rows)


def test_open_parts_meet_in_rounds(docs, monkeypatch):
    # Few are compared at first, so the later rounds have work to do.
    monkeypatch.setattr(neardup, "MEETINGS", (1, 2, None))
    rows = corpus(8, 200) + [(1000 + i, t) for i, t in near_copies(60, words=40)]
    assert found(docs(rows)) == brute(rows)


def test_rows_that_go(docs, spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(1, "a"), (1, "b"), (2, None), (3, ""), (None, "a"), (4, "x"), (4, "x")]
    gone = spark.createDataFrame([(1, "b"), (2, ""), (4, "x"), (9, "a")], "doc_id long, text string")
    gone = gone.select("doc_id", F.xxhash64("text").alias("text_hash"))
    for bits in (64, neardup.FILTER_BITS):
        monkeypatch.setattr(neardup, "FILTER_BITS", bits)
        left = neardup.without_rows(docs(rows), gone)
        assert left.columns == docs(rows).columns
        assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([(1, "a"), (3, ""), (None, "a")], key=repr)


def test_a_chain_of_copies_is_one_component(docs):
    words = [f"x{i}" for i in range(100)]
    rows = [(i, " ".join(words[:60] + [f"y{j}" for j in range(i * 2)])) for i in range(12)]
    assert found(docs(rows)) == brute(rows)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "ÉTÉ a b c d"), (7, "été a b c d"), (8, "one two three")]
    assert found(docs(rows)) == {
        1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), 6: (1, 6, True), 7: (1, 7, True), 8: (1, 8, True),
    }


def test_a_very_long_text(docs):
    text = " ".join(f"w{i % 50_000}" for i in range(400_000))
    assert found(docs([(1, text), (2, text + " end"), (3, "w1 w2")])) == {1: (50_000, 1, True), 2: (50_001, 1, False), 3: (1, 3, True)}


def test_rows_without_id_and_repeated_rows(docs):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (None, "f g h i j"), (None, None)]
    got = sorted((tuple(r) for r in neardup.near_duplicates(docs(rows)).collect()), key=repr)
    assert got == sorted([(None, 1, 7, False), (7, 1, 7, True), (7, 1, 7, True), (None, 1, None, True), (None, 0, None, True)], key=repr)


def test_no_documents(docs):
    assert neardup.near_duplicates(docs([])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
