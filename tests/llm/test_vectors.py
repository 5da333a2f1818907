import math
import numpy as np
import pytest

from cdcspark.llm import vectors


def rows_of(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, links string")


def brute(ids, x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(label, np.where(link, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            break
        label = new
    return {int(ids[i]): (int(link[i].sum()), int(ids[label[i]]), bool(label[i] == i)) for i in range(len(x))}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()}


@pytest.fixture
def cloud():
    r = np.random.default_rng(5)
    base = r.normal(size=(300, 16))
    near = base[r.integers(0, 40, 300)] + r.normal(size=(300, 16)) * 0.12
    many = base[7] + r.normal(size=(200, 16)) * 0.2
    return np.concatenate([base, near, many, np.repeat(base[3:4], 150, axis=0)]).astype(np.float32).astype(float)


def test_all_links_of_probed_lists_are_found(spark, cloud, monkeypatch):
    monkeypatch.setattr(vectors, "PER_LIST", 40)
    monkeypatch.setattr(vectors, "PROBES", 100)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 64)
    df = rows_of(spark, [(i, v.tolist()) for i, v in enumerate(cloud)])
    assert found(df) == brute(np.arange(len(cloud)), cloud)


def test_recall_with_few_probes(spark, cloud, monkeypatch):
    monkeypatch.setattr(vectors, "PER_LIST", 20)
    got, want = found(rows_of(spark, [(i, v.tolist()) for i, v in enumerate(cloud)])), brute(np.arange(len(cloud)), cloud)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(x[0] for x in got.values()) >= 0.95 * sum(x[0] for x in want.values())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1e-30, 0.0]),
            (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0, 0.0]), (11, [1.0, 0.0]), (None, [0.0, 2.0]), (12, [0.0, 1.0])]
    got = sorted((tuple(r) for r in vectors.near_vectors(rows_of(spark, rows, "double")).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 10)]
    assert got == sorted([*alone, (7, 3, 7, True), (8, 3, 7, False), (11, 3, 7, False), (11, 3, 7, False), (None, 1, 12, False), (12, 1, 12, True)], key=repr)


def test_no_vectors(spark):
    assert vectors.near_vectors(rows_of(spark, [])).collect() == []
    assert found(rows_of(spark, [(1, None)])) == {1: (0, 1, True)}


def test_stored_errors_bound_table_distances():
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 12))
    index = vectors.fit(x / np.linalg.norm(x, axis=1, keepdims=True), 4)
    residual = r.normal(size=(200, 12))
    codes, error = index.encode(residual)
    query = r.normal(size=(50, 12))
    true = np.linalg.norm(query[:, None] - residual[None], axis=2)
    assert (np.sqrt(index.table_distances(query, codes)) - error <= true + 1e-9).all()


def test_lengths_do_not_matter(spark):
    angle = math.acos(0.95)
    near, far = [math.cos(angle * 0.999), math.sin(angle * 0.999)], [math.cos(angle * 1.001 + math.pi / 2), math.sin(angle * 1.001 + math.pi / 2)]
    rows = [(1, [1e200, 0.0]), (2, [1.0, 0.0]), (3, [1e-200, 0.0]), (4, [1e300 * x for x in near]), (5, [1e-300 * x for x in far]), (6, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (0, 5), 6: (4, 1)}
