import zlib

import pytest
from pyspark.sql import functions as F

from cdcspark.llm import langid

TEXTS = {
    "en": "the weather is nice today and we will walk along the river with our friends through the old town",
    "de": "das wetter ist heute schön und wir gehen mit unseren freunden am fluss entlang durch die alte stadt",
    "fr": "il fait beau aujourd'hui et nous marchons le long de la rivière avec nos amis dans la vieille ville",
}


@pytest.fixture
def labelled(spark):
    rows = []
    for lang, text in TEXTS.items():
        words = text.split()
        rows += [(len(rows) + i, " ".join(words[i % 7 :] + words[: i % 7]) * (1 + i % 3), lang) for i in range(40)]
    return spark.createDataFrame([(*r, "s", 0.5, True) for r in rows], "doc_id long, text string, lang string, source string, score double, rejected boolean")


def test_held_out_rows_are_told_apart(spark, labelled):
    found = {r.doc_id: r for r in langid.identify(labelled).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    right = {r.doc_id: r.lang for r in labelled.collect()}
    assert all(r.lang_pred == right[i] and 0 < r.score <= 1 and not r.rejected for i, r in found.items())


def test_odd_texts(spark, labelled):
    model = langid.train(labelled)
    rows = [(1, None), (2, ""), (3, "123 !!! 456"), (4, "Это русский текст, и его здесь никто не ждал"), (5, "the river and the town"), (5, "the river and the town"),
            (6, TEXTS["de"] * 30_000)]
    found = langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(by_id[i].rejected and by_id[i].score == 0 for i in (1, 2, 3))
    assert by_id[4].rejected and by_id[4].lang_pred in TEXTS
    assert by_id[5].lang_pred == "en" and not by_id[5].rejected and len(found) == 7
    assert by_id[6].lang_pred == "de" and not by_id[6].rejected


def test_long_texts_are_read_whole(monkeypatch):
    text = "der fluss " * 500 + "the river " * 4000
    whole = langid.counted(text)[0].tolist()
    monkeypatch.setattr(langid, "PART_CHARS", 1000)
    assert set(whole) == set(langid.counted(text)[0].tolist())


def test_the_sample_is_bounded_and_the_same_again(spark, labelled):
    one = sorted(map(tuple, langid.sample(labelled, 5).collect()))
    assert one == sorted(map(tuple, langid.sample(labelled.repartition(7), 5).collect()))
    assert len(one) == 15


def test_nothing_to_learn_from(spark, labelled):
    empty = labelled.where("false")
    assert langid.identify(empty).collect() == []
    unlabelled = labelled.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
