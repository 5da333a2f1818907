import gzip
import hashlib
import os

import pytest

from cdcspark.llm import warc
from cdcspark.session import fresh_dir

SCHEMA = "page_id long, url string, html string, digest string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equal_payloads_are_revisits_of_the_largest_id(spark):
    long, short = "é" * 500, "x" * 999
    found = by_id(warc.archived_pages(spark, pages(spark, [
        (1, "http://a/1", long), (2, "http://a/2", long), (3, None, long), (4, "http://a/4", short), (5, "u", short), (6, "u", None), (7, "u", ""),
    ])))
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert found == [
        (1, 1000, sha(long), "revisit", 3), (2, 1000, sha(long), "revisit", 3), (3, 1000, sha(long), "response", None),
        (4, 999, sha(short), "response", None), (5, 999, sha(short), "response", None),
        (6, 0, sha(""), "response", None), (7, 0, sha(""), "response", None),
    ]


def test_null_ids_and_repeated_rows(spark):
    text = "z" * 2000
    found = by_id(warc.archived_pages(spark, pages(spark, [(None, "u", text), (5, "u", text), (5, "u", text)])))
    assert [(r[0], r[3], r[4]) for r in found] == [(5, "response", None), (5, "response", None), (None, "revisit", 5)]


def test_payloads_that_look_like_archives_come_back_whole(spark):
    odd = ["WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n\r\n", "\n", "a\r", "line\nline\r\n", "\r\n\r\nWARC/1.0\r\n", "x" * 300_000 + "\r\n\r\n"]
    source, target = fresh_dir(spark, "w"), fresh_dir(spark, "w")
    warc.write_archives(pages(spark, [(i, "u\r\nX: y", t) for i, t in enumerate(odd)]), source)
    index = warc.normalise(spark, source, target)
    rows = warc.read_records(index, target, with_payload=True).collect()
    assert {r.record_id: bytes(r.payload).decode() for r in rows} == {f"<urn:page:{i}>": t for i, t in enumerate(odd)}
    assert {r.uri for r in rows} == {"u X: y"}


def test_every_record_is_a_member_at_its_offset(spark):
    source, target = fresh_dir(spark, "w"), fresh_dir(spark, "w")
    warc.write_archives(pages(spark, [(i, "u", f"page {i}\n" * 50) for i in range(40)]), source)
    index = [r.asDict() for r in warc.normalise(spark, source, target).collect()]
    assert len(index) == 40
    for name in {r["file"] for r in index}:
        raw = open(os.path.join(target, "archives", name), "rb").read()
        own = sorted((r for r in index if r["file"] == name), key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == len(raw)
        assert all(gzip.decompress(raw[r["offset"] : r["offset"] + r["length"]]).startswith(b"WARC/1.0\r\n") for r in own)
    before = b"".join(gzip.open(os.path.join(source, n)).read() for n in sorted(os.listdir(source)) if n.endswith(".gz"))
    after = b"".join(gzip.open(os.path.join(target, "archives", n)).read() for n in os.listdir(os.path.join(target, "archives")) if n.endswith(".gz"))
    assert sorted(before.split(b"WARC/1.0")) == sorted(after.split(b"WARC/1.0"))


def test_a_damaged_payload_is_found(spark):
    source, target = fresh_dir(spark, "w"), fresh_dir(spark, "w")
    rows = warc.record_bytes(warc.with_revisits(pages(spark, [(1, "u", "abc")])).replace({hashlib.sha1(b"abc").hexdigest(): "0" * 40}, subset=["digest"]))
    rows.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(source)
    index = warc.normalise(spark, source, target)
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(index, target).collect()


def test_no_pages(spark):
    assert warc.archived_pages(spark, pages(spark, [])).collect() == []


def test_a_path_without_scheme_is_one_of_sparks_file_system(spark, tmp_path, monkeypatch):
    from cdcspark import files
    from cdcspark.llm.common import arrow_folder

    asked = []
    real = files.qualified
    monkeypatch.setattr(files, "qualified", lambda session, name: asked.append(name) or real(session, name))
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    warc.write_archives(pages, source)
    assert warc.read_records(warc.normalise(spark, source, target), target).count() == 1 and asked == [target, target]
    for address in (f"file:{target}", f"file://{target}"):
        assert arrow_folder(address)[1] == target
    with pytest.raises(ValueError, match="full address"):
        arrow_folder(target)
