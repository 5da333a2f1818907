import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, TimestampNTZType

from cdcspark.functions.lsn import LSN, OP, SEQ, SYNC
from cdcspark.plans.mapping import (
    captured_columns,
    load_mapping,
    load_table_list,
    mapped_tables,
    mapping_verdict,
    parse_mapping,
    parse_pairs,
    parse_table_list,
    project_mapped,
    source_tables,
    table_columns,
)
from cdcspark.plans.schema import SOURCE_TYPE, describe, ensure_sync_column, translate_schema, translate_types
from helpers import FEED, feed_of

INFO = (
    "COLUMN_NAME string, DATA_TYPE string, CHARACTER_MAXIMUM_LENGTH int, IS_NULLABLE string, "
    "NUMERIC_PRECISION int, NUMERIC_SCALE int"
)


def entry(column, table):
    return {"campoOrigem": column, "tabelaOrigem": table}


def test_mapping_file(spark, tmp_path):
    document = {
        "people": {SYNC: {}, "name": entry("NOME", "PESSOA"), "id": entry("COD", "PESSOA")},
        "stock": {"sku": entry("CODIGO", "ESTOQUE"), SYNC: {}, "left": entry("SALDO", "ESTOQUE")},
    }
    path = tmp_path / "map.json"
    path.write_text(json.dumps(document, indent=2))
    rows = load_mapping(spark, str(path))
    assert mapped_tables(rows) == {
        "people": ("PESSOA", [("name", "NOME"), ("id", "COD")]),
        "stock": ("ESTOQUE", [("sku", "CODIGO"), ("left", "SALDO")]),
    }
    found = {r.target: (r.source_table, r.n_sources, r.n_columns) for r in source_tables(rows).collect()}
    assert found == {"people": ("PESSOA", 1, 2), "stock": ("ESTOQUE", 1, 2)}


def test_mapping_of_two_sources_is_refused(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text(json.dumps({"t": {"a": entry("A", "X"), "b": entry("B", "Y")}}))
    with pytest.raises(Exception, match="two source tables"):
        mapped_tables(load_mapping(spark, str(path)))
    with pytest.raises(ValueError, match="two source tables"):
        mapped_tables(parse_mapping(spark.read.text(str(path), wholetext=True), strict=False))


@pytest.mark.parametrize("text,verdict", [
    ("{ broken", "unreadable"), ("[1]", "unreadable"), (None, "unreadable"), ("{}", "no targets"),
    ('{"t": {}}', "a target without columns"), ('{"t": {"__$last_sync": {}}}', "a target without columns"),
    ('{"t": {"a": {}}}', "an entry without a source"), ('{"t": {"a": {"campoOrigem": "A"}}}', "an entry without a source"),
])
def test_a_mapping_out_of_order_stops(spark, text, verdict):
    documents = spark.createDataFrame([(text,)], "value string")
    assert documents.select(mapping_verdict()).first()[0] == verdict
    with pytest.raises(Exception, match=verdict):
        mapped_tables(parse_mapping(documents))


def test_entries_without_a_source_stop_a_loose_reading_too(spark):
    text = json.dumps({"t": {"a": entry("A", "X"), "b": {}}})
    rows = parse_mapping(spark.createDataFrame([(text,)], "value string"), strict=False)
    with pytest.raises(ValueError, match="no source for b"):
        mapped_tables(rows)
    with pytest.raises(ValueError, match="no targets"):
        mapped_tables(rows.limit(0))


def test_table_list(spark, tmp_path):
    path = tmp_path / "tables.json"
    path.write_text('{"tabelas": [\n"a",\n"b"]}')
    assert [r.table_name for r in load_table_list(spark, str(path)).orderBy("pos").collect()] == ["a", "b"]
    for text, verdict in [('{"other": 1}', "no list"), ('{"tabelas": []}', "no tables"), ("{", "unreadable"), ('{"tabelas": [""]}', "without a name")]:
        path.write_text(text)
        with pytest.raises(Exception, match=verdict):
            load_table_list(spark, str(path)).collect()
        assert parse_table_list(spark.read.text(str(path), wholetext=True), strict=False).where("table_name <> ''").isEmpty()


def test_pairs(spark):
    texts = spark.createDataFrame([("a,b; c , d ;broken",)], "value string")
    with pytest.raises(Exception, match="half a pair"):
        parse_pairs(texts).collect()
    assert [(r.source_name, r.target_name) for r in parse_pairs(texts, strict=False).collect()] == [("a", "b"), ("c", "d")]
    whole = spark.createDataFrame([("a,b; c , d ;",)], "value string")
    assert [(r.source_name, r.target_name) for r in parse_pairs(whole).collect()] == [("a", "b"), ("c", "d")]


def test_projection_keeps_mapping_order(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "`A.1` int, B string, C double")
    got = project_mapped(df, [("c", "C"), (SYNC, "B"), ("a", "A.1")], keep=["B"])
    assert got.columns == ["B", "c", "a"] and tuple(got.first()) == ("x", 2.0, 1)


def test_captured_columns(spark):
    feed = feed_of(spark, [(1, 2, 1, "a")])
    assert captured_columns(feed, "v").columns == [OP, LSN, "v"]
    assert captured_columns(feed, ["k", "v"]).columns == [OP, LSN, "k", "v"]
    assert FEED.startswith("`" + OP)
    sequenced = feed.withColumn(SEQ, F.lit(1))
    assert captured_columns(sequenced, "v").columns == [OP, LSN, SEQ, "v"]


def test_types(spark):
    info = spark.createDataFrame(
        [
            ("a", "varchar", 50, "NO", None, None),
            ("b", "nvarchar", None, "YES", None, None),
            ("c", "varchar", -1, "YES", None, None),
            ("d", "decimal", None, "YES", 18, 4),
            ("e", "numeric", None, "YES", None, None),
            ("f", "datetime", None, "YES", None, None),
            ("g", "bit", None, "NO", None, None),
            ("h", "bigint", None, "YES", None, None),
            ("i", "time", None, "YES", None, None),
            (SYNC, "varbinary", None, "YES", None, None),
        ],
        INFO,
    )
    declared = [r.declared_type for r in translate_types(info).collect()]
    assert declared[:8] == [
        "varchar(50)", "nvarchar(255)", "text", "decimal(18,4)", "numeric", "DATETIME", "TINYINT(1)", "bigint",
    ]
    schema = translate_schema(info)
    assert schema.names == list("abcdefghi")
    assert [f.nullable for f in schema][:3] == [False, True, True]
    assert schema["d"].dataType == DecimalType(18, 4) and schema["e"].dataType == DecimalType(38, 18)
    assert schema["f"].dataType == TimestampNTZType() and schema["i"].dataType == StringType()


def test_unknown_table_and_type(spark):
    with pytest.raises(LookupError):
        translate_schema(spark.createDataFrame([], INFO))
    odd = spark.createDataFrame([("a", "HierarchyID", None, "YES", None, None), ("b", "VARCHAR", 7, "YES", None, None)], INFO)
    schema = translate_schema(odd)
    assert schema["a"].dataType == StringType() and schema["a"].metadata == {SOURCE_TYPE: "HierarchyID"}
    assert [r.declared_type for r in translate_types(odd).collect()] == ["hierarchyid", "varchar(7)"]


def test_a_table_describes_itself(spark):
    df = spark.sql("SELECT 1 AS a, 2L AS b, 1.5BD AS c, 'x' AS d, true AS e, current_date() AS f, X'00' AS g, 1.5D AS h")
    schema = translate_schema(describe(df))
    assert [f.dataType for f in schema] == [f.dataType for f in df.schema]


def test_sync_column(spark):
    plain = spark.createDataFrame([(1,)], "k int")
    assert dict(ensure_sync_column(plain).dtypes)[SYNC] == "binary"
    text = spark.createDataFrame([(1, "ab")], f"k int, `{SYNC}` string")
    assert bytes(ensure_sync_column(text).first()[SYNC]) == b"ab"
    done = ensure_sync_column(plain)
    assert ensure_sync_column(done) is done
    assert table_columns(done) == ["k"]
