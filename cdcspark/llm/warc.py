"""WARC archives: writing them as whole-file gzip streams, and a normaliser that makes them seekable.

``write_archives`` lets Spark's own text writer produce one gzip stream per task, the kind of archive that can only be
read from its start. ``normalise`` inflates each such stream once, line by line in Spark's reader, writes every record as
a gzip member of its own and keeps a sidecar index (file, offset, length, headers) as Parquet. ``read_records`` then
fetches members by offset, so one archive can be read by many tasks.

Memory is bounded by the largest record. A task that runs again writes the same bytes to a draft of its own and renames
it over the same name. Files are reached through Arrow's file systems from the address Spark uses.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark import files
from cdcspark.llm.common import arrow_folder, bounded_batches, text_bytes
from cdcspark.session import fresh_dir, written

#: Payloads shorter than this are stored each time.
REVISIT_BYTES = 1000

#: End of a record, and of the lines of its headers.
_GAP, _LINE = "\r\n\r\n", "\r\n"

_LEVEL = 4


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Rows (page_id, url, payload, digest, record_type, refers_to): of equal long payloads, all but one are revisits.

    The row with the largest page_id is the response; payloads under ``least`` bytes are all responses. Null html is an
    empty payload. A row without page_id is a revisit where another row has the payload and an id, else a response;
    rows that repeat the largest page_id are responses each.
    """
    raw = text_bytes("html")
    rows = pages.select("page_id", "url", raw.alias("payload"), F.sha1(raw).alias("digest"))
    # One narrow row per payload that repeats; written, so the planner knows its size when it joins.
    again = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(
        F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")
    )
    again = written(again.where("n > 1 AND response_id IS NOT NULL").select(F.col("digest").alias("again"), "response_id"), "warc-again")
    rows = rows.join(again, F.col("digest") == F.col("again"), "left")
    is_revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return rows.select(
        "page_id", "url", "payload", "digest",
        F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, F.col("response_id")).alias("refers_to"),
    )


def _header(name: str, value: Column) -> Column:
    """A header line, left out where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_LINE)), F.lit(""))


def record_bytes(rows: DataFrame) -> DataFrame:
    """One WARC record per row of ``with_revisits``, without the gap that ends it. Line ends in urls become spaces."""
    revisit = F.col("record_type") == "revisit"
    size = F.octet_length("payload").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(_GAP)
    )
    block = F.concat(http.cast("binary"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        _header("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_LINE),
    )
    # The text writer puts out a string's bytes as they are.
    return rows.select(F.concat(head.cast("binary"), block).cast("string").alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """The pages as WARC archives, each one gzip stream."""
    records = record_bytes(with_revisits(pages))
    records.write.option("compression", "gzip").option("lineSep", _GAP).text(path)


class _Records:
    """Whole records out of lines that come in the order of an archive."""

    def __init__(self) -> None:
        self.lines: list[bytes] = []
        self.missing = -1  # bytes of the block still to come; below 0 while the headers are read
        self.length = 0

    def add(self, line: bytes) -> bytes | None:
        """A line without its line feed; gives a record, without the gap after it, once it is whole."""
        if self.missing < 0:
            if not self.lines and line in (b"\r", b""):
                return None
            self.lines.append(line + b"\n")
            name, _, value = line.partition(b":")
            if name.lower() == b"content-length":
                self.length = int(value)
            elif line in (b"\r", b""):
                self.missing = self.length
                return self._end() if self.length == 0 else None
            return None
        self.lines.append(line + b"\n")
        self.missing -= len(line) + 1
        return self._end() if self.missing <= 0 else None

    def _end(self) -> bytes:
        whole = b"".join(self.lines)
        # The last line of a block may run on into the gap.
        over = -self.missing if self.missing < 0 else 0
        self.lines, self.missing = [], -1
        return whole[: len(whole) - over]


def parse_headers(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return fields, block


INDEX = "file string, offset long, length long, record_type string, record_id string, uri string, refers_to string, digest string"


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites every archive under ``source`` with a member per record under ``target``; returns the index.

    Each archive is inflated once, as a stream. The index is written to ``target``/index and read back. A path without
    scheme is one of Spark's default file system, for Spark and for the tasks that write members.
    """
    target = files.qualified(spark, target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = arrow_folder(f"{target}/archives")
        fs.create_dir(folder, recursive=True)
        file, out, draft, offset, records = None, None, "", 0, _Records()

        def close() -> None:
            out.close()
            fs.move(draft, posixpath.join(folder, file))

        for batch in batches:
            rows: list[tuple] = []
            for address, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name = hashlib.sha1(address.encode()).hexdigest()[:16] + ".warc.gz"
                if name != file:
                    if out:
                        close()
                    file, offset, records = name, 0, _Records()
                    draft = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")
                    out = fs.open_output_stream(draft)
                record = records.add(line.as_py())
                if record is None:
                    continue
                packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(record + _GAP.encode()) + packer.flush()
                out.write(member)
                fields, _ = parse_headers(record)
                names = ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest")
                rows.append((file, offset, len(member), *map(fields.get, names)))
                offset += len(member)
            yield _batch(rows, INDEX)
        if out:
            close()

    bounded_batches(spark)
    lines = spark.read.option("lineSep", "\n").text(source)
    # The order of lines in a file is the reader's; a gzip file is never split.
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    lines.mapInArrow(work, INDEX).write.parquet(f"{target}/index")
    return spark.read.schema(INDEX).parquet(f"{target}/index")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.strip().split(" ") for x in schema.split(",")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


RECORDS = "record_type string, record_id string, uri string, refers_to string, digest string, payload_bytes long, payload_digest string"


def read_records(index: DataFrame, target: str, with_payload: bool = False) -> DataFrame:
    """Every record the index lists, fetched by offset and length, and its payload measured.

    Of a revisit, which holds no payload, the payload's size and digest are those its headers state.
    """
    target = files.qualified(index.sparkSession, target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = arrow_folder(f"{target}/archives")
        file, stream = None, None
        for batch in batches:
            rows: list[tuple] = []
            for name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if name != file:
                    file, stream = name, fs.open_input_file(posixpath.join(folder, name))
                stream.seek(offset)
                record = zlib.decompress(stream.read(length), 31)
                fields, block = parse_headers(record[: -len(_GAP)])
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(re.search(rb"content-length: *(\d+)", http, re.I)[1])
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] != "revisit":
                    size, found = len(payload), hashlib.sha1(payload).hexdigest()
                    if found != digest:
                        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
                names = ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to")
                rows.append((*map(fields.get, names), digest, size, digest, *([payload] if with_payload else [])))
            yield _batch(rows, RECORDS + (", payload binary" if with_payload else ""))

    return index.select("file", "offset", "length").mapInArrow(work, RECORDS + (", payload binary" if with_payload else ""))


def page_number(urn: str) -> Column:
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The pages written to archives, normalised and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    source, target = fresh_dir(spark, "warc-streams"), fresh_dir(spark, "warc")
    write_archives(pages, source)
    index = normalise(spark, source, target)
    records = read_records(index, target)
    return records.select(
        page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number("refers_to").alias("refers_to"),
    )
