"""The registered queries and the pipeline on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cdcspark.llm import decontaminate, packing, pii
from cdcspark.llm.queries import QUERIES, SQL
from cdcspark.session import fresh_dir

from .test_decontaminate import brute as hits
from .test_neardup import brute as groups

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF_DIR}/{name}')")
    return connection


def test_all_are_registered():
    assert len([n for n in QUERIES if n.startswith("op")]) == 13
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_cover_their_table(spark, name):
    table = "pages" if name.startswith("op6") else "documents"
    rows = QUERIES[name](spark, SF_DIR)
    key = "page_id" if table == "pages" else "doc_id"
    want = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in rows.select(key).collect()} == want


def test_held_out_accuracy(spark):
    found = QUERIES["op2_nearest_centroid"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            kept.append({r.doc_id: r.text for r in docs.collect()})
    # Every text here has letters and one of the labelled languages.
    assert kept[1] == kept[0]
    assert set(kept[2]) == {i for i, (_, _, first) in groups(list(kept[1].items())).items() if first}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert set(kept[3]) == {row[0] for row in hits(list(kept[2].items()), items) if not row[4]}
    assert kept[4] == {i: pii.masked_text(t, pii.all_spans(t)[1]) for i, t in kept[3].items()}
    words = packing.WordTokenizer(packing_path := corpus_pipeline.vocabulary("word_bpe_49k.json"))
    lengths = {i: len(x) + 1 for i, x in zip(kept[4], words.ids(list(kept[4].values())), strict=True)}
    assert packing_path and {i: sum(r.length for r in docs.collect() if r.doc_id == i) for i in lengths} == lengths
    assert decontaminate.WINDOW == 13


def test_stages_take_odd_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, lang_pred string"
    words = " ".join(f"word{i % 37}" for i in range(300))
    rows = [
        (None, None, None, None, None, 1, "x", "y"), (1, None, "en", "s", 0, 1, "x", "y"), (2, "", "en", None, 0, 1, "x", "y"),
        (3, words, "en", "s", 1, 1, "x", "y"), (3, words, "en", "s", 1, 1, "x", "y"), (None, words, None, "s", None, 1, "x", "y"),
        (4, "word9 word8 word a@b.cd", None, "s", 3, 1, "x", "y"), (5, "123 456", "de", "s", 3, None, None, None),
        (6, words * 200, "en", "s", 1, 1, "x", "y"),
    ]
    for given in (rows, []):
        docs, seen = spark.createDataFrame(given, schema), []
        for name, stage in corpus_pipeline.STAGES:
            path = fresh_dir(spark, name)
            stage(spark, docs, SF_DIR).write.parquet(path)
            docs = spark.read.parquet(path)
            seen.append(docs)
        if not given:
            assert all(d.count() == 0 for d in seen)
            continue
        # Texts without letters go; of the near copies the row without an id stays, as nothing names it.
        assert sorted((r.doc_id or 0) for r in seen[0].collect()) == [0, 3, 3, 4, 6]
        assert {r.lang for r in seen[0].collect()} == {"en"}
        assert sorted((r.doc_id or 0) for r in seen[2].collect()) == [0, 3, 3, 4]
        assert [r.text for r in seen[3].collect() if r.doc_id == 4] == ["word9 word8 word <email>"]
        assert {r.n_chars for r in seen[3].collect()} == {len(words), len("word9 word8 word <email>")}


def test_a_copy_takes_no_other_text_of_its_id_along(spark):
    copied, other = (" ".join(f"{w}{i}" for i in range(60)) for w in ("word", "term"))
    rows = [(1, copied, "en", "s", 1), (5, copied, "en", "s", 1), (5, other, "en", "s", 1), (6, copied + " end", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_copies(spark, docs, SF_DIR)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, copied), (5, other)]
