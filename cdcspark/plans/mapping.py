"""Which target column comes from which source column: configuration as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark.functions.lsn import LSN, OP, SEQ, SYNC

# Field names of the configuration files.
SOURCE_COLUMN_FIELD = "campoOrigem"
SOURCE_TABLE_FIELD = "tabelaOrigem"
TABLE_LIST_FIELD = "tabelas"

MAPPING_TYPE = f"map<string,map<string,struct<{SOURCE_COLUMN_FIELD}:string,{SOURCE_TABLE_FIELD}:string>>>"
TABLE_LIST_TYPE = f"struct<{TABLE_LIST_FIELD}:array<string>>"


def _mapped_from(entry: Column) -> tuple[Column, Column]:
    return entry[SOURCE_COLUMN_FIELD], entry[SOURCE_TABLE_FIELD]


def mapping_verdict(column: str | Column = "value") -> Column:
    """What is wrong with a mapping document, ``ok`` if nothing is.

    One rule for all readers: every target has a mapped column, every entry but
    the sync column names a source column and a source table, and all
    entries of a target name the same table.
    """
    text = F.col(column) if isinstance(column, str) else column
    parsed = F.from_json(text, MAPPING_TYPE)
    entries = F.transform(
        F.map_values(parsed), lambda t: F.filter(F.map_entries(t), lambda e: e["key"] != SYNC)
    )
    empty = F.exists(entries, lambda t: t.isNull() | (F.size(t) == 0))
    lacking = F.exists(entries, lambda t: F.exists(t, lambda e: _lacks(e["value"])))
    mixed = F.exists(entries, lambda t: F.size(F.array_distinct(F.transform(t, lambda e: _mapped_from(e["value"])[1]))) > 1)
    return (
        F.when(parsed.isNull(), "unreadable")
        .when(F.size(parsed) == 0, "no targets")
        .when(empty, "a target without columns")
        .when(lacking, "an entry without a source")
        .when(mixed, "a target with two source tables")
        .otherwise("ok")
    )


def _lacks(entry: Column) -> Column:
    source_column, source_table = _mapped_from(entry)
    return entry.isNull() | source_column.isNull() | source_table.isNull()


def table_list_verdict(column: str | Column = "value") -> Column:
    """What is wrong with a table-list document, ``ok`` if nothing is."""
    text = F.col(column) if isinstance(column, str) else column
    parsed = F.from_json(text, TABLE_LIST_TYPE)
    names = parsed[TABLE_LIST_FIELD]
    # A text that is no JSON object gives a struct of nulls; a parse as a map tells it from a missing list.
    readable = F.from_json(text, "map<string,string>").isNotNull()
    return (
        F.when(~F.coalesce(readable, F.lit(False)), "unreadable")
        .when(names.isNull(), "no list")
        .when(F.size(names) == 0, "no tables")
        .when(F.exists(names, lambda n: n.isNull() | (F.trim(n) == "")), "a table without a name")
        .otherwise("ok")
    )


def pairs_verdict(column: str | Column = "value") -> Column:
    """What is wrong with a text of pairs, ``ok`` if nothing is; an empty part behind the last ``;`` is none."""
    text = F.col(column) if isinstance(column, str) else column
    half = F.exists(_pair_texts(text), lambda p: (F.size(F.split(p, ",")) != 2) | F.exists(F.split(p, ","), lambda n: F.trim(n) == ""))
    return F.when(text.isNull() | (F.size(_pair_texts(text)) == 0), "no pairs").when(half, "half a pair").otherwise("ok")


def _pair_texts(text: Column) -> Column:
    return F.filter(F.split(text, ";"), lambda p: F.trim(p) != "")


def _judged(df: DataFrame, column: str, verdict: Column, strict: bool, what: str) -> DataFrame:
    """``df`` with its text column, where ``strict`` a text that is not in order raises an error."""
    if not strict:
        return df
    message = F.concat(F.lit(f"{what}: "), verdict)
    return df.withColumn(column, F.when(verdict == "ok", F.col(column)).otherwise(F.raise_error(message)))


def parse_mapping(df: DataFrame, column: str = "value", *, keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Mapping documents in a text column → one row per target column.

    ``target, pos, target_col, source_col, source_table``, in document order;
    the sync column is left out wherever it stands. ``keep`` carries other
    columns of ``df`` along. A document that is not in order (see
    ``mapping_verdict``) raises an error, or, not ``strict``, gives what it has.
    """
    df = _judged(df, column, mapping_verdict(column), strict, "mapping document")
    targets = df.select(*keep, F.explode(F.from_json(F.col(column), MAPPING_TYPE)).alias("target", "columns"))
    rows = targets.select(*keep, "target", F.posexplode("columns").alias("pos", "target_col", "origin"))
    source_column, source_table = _mapped_from(F.col("origin"))
    return rows.where(F.col("target_col") != SYNC).select(
        *keep, "target", "pos", "target_col", source_column.alias("source_col"), source_table.alias("source_table")
    )


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Read a mapping file from any file system Spark can reach."""
    return parse_mapping(spark.read.text(path, wholetext=True))


def source_tables(mapping: DataFrame, *, by: Sequence[str] = ("target",)) -> DataFrame:
    """Source table of each target, from its first mapped column.

    ``n_sources`` above one marks a mapping that mixes tables, which no single
    feed can serve; a strict reading does not let it through.
    """
    return mapping.groupBy(*by).agg(
        F.min_by("source_table", F.when(F.col("source_table").isNotNull(), F.col("pos"))).alias("source_table"),
        F.count_distinct("source_table").alias("n_sources"),
        F.count(F.lit(1)).alias("n_columns"),
    )


def mapped_tables(mapping: DataFrame) -> dict[str, tuple[str, list[tuple[str, str]]]]:
    """Work items of a mapping file: target → (source table, [(target column, source column)]).

    A configuration file is small, so its rows may come to the driver. Entries
    without a source and targets of two source tables raise an error here too,
    for mappings that were not read strictly.
    """
    items: dict[str, tuple[str, list[tuple[str, str]]]] = {}
    for row in mapping.orderBy("target", "pos").collect():
        if row["source_col"] is None or row["source_table"] is None:
            raise ValueError(f"mapping of {row['target']} has no source for {row['target_col']}")
        source, columns = items.setdefault(row["target"], (row["source_table"], []))
        if row["source_table"] != source:
            raise ValueError(f"mapping of {row['target']} names two source tables: {source}, {row['source_table']}")
        columns.append((row["target_col"], row["source_col"]))
    if not items:
        raise ValueError("the mapping has no targets")
    return items


def parse_table_list(df: DataFrame, column: str = "value", *, keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Table-list documents → one row per table.

    A document that is not in order (see ``table_list_verdict``) raises an
    error, or, not ``strict``, gives what it has, which may be nothing.
    """
    df = _judged(df, column, table_list_verdict(column), strict, "table list")
    parsed = F.from_json(F.col(column), TABLE_LIST_TYPE)[TABLE_LIST_FIELD]
    return df.select(*keep, F.posexplode(parsed).alias("pos", "table_name"))


def load_table_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_table_list(spark.read.text(path, wholetext=True))


def parse_pairs(df: DataFrame, column: str = "value", *, keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """``"a,b;c,d"`` → one row per (source, target) pair.

    A text that is not in order (see ``pairs_verdict``) raises an error, or, not
    ``strict``, gives its whole pairs.
    """
    df = _judged(df, column, pairs_verdict(column), strict, "table pairs")
    pairs = df.select(*keep, F.posexplode(_pair_texts(F.col(column))).alias("pos", "pair"))
    part = F.split(F.col("pair"), ",")
    return pairs.where(F.size(part) >= 2).select(
        *keep, "pos", F.trim(part[0]).alias("source_name"), F.trim(part[1]).alias("target_name")
    )


def table_columns(df: DataFrame) -> list[str]:
    """Column names in order, without the sync column."""
    return [c for c in df.columns if c != SYNC]


def project_mapped(df: DataFrame, columns: Sequence[tuple[str, str]], *, keep: Sequence[str] = ()) -> DataFrame:
    """Select source columns under their target names, in mapping order.

    ``columns`` lists (target column, source column). ``keep`` names columns
    that pass unchanged in front, such as operation and position of a feed.
    """
    picked: list[Column] = [F.col(f"`{c}`") for c in keep]
    picked += [F.col(f"`{source}`").alias(target) for target, source in columns if target != SYNC]
    return df.select(*picked)


def captured_columns(feed: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Limit a change feed to operation, position and the captured columns.

    ``columns`` is a list or a comma-separated text. The sequence column stays
    if there is one: without it changes of one position have no order.
    """
    names = [c.strip() for c in columns.split(",")] if isinstance(columns, str) else list(columns)
    front = [OP, LSN, *([SEQ] if SEQ in feed.columns else [])]
    return feed.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*front, *names])])
