"""Change tables: finding them, reading a range, reading as a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcspark.functions.lsn import LSN, LSN_BYTES, OP, SEQ, SYNC, ZERO_LSN, lsn_literal, pad_lsn


def capture_name(table: str | Column, schema: str = "dbo") -> str | Column:
    """Fixed naming rule of capture instances: schema, underscore, table."""
    if isinstance(table, str):
        return f"{schema}_{table}"
    return F.concat(F.lit(f"{schema}_"), table)


def resolve_change_table(change_tables: DataFrame, table: str, *, schema: str = "dbo") -> str | None:
    """Name of the change table of a source table, ``None`` if it is not captured."""
    found = change_tables.where(F.col("capture_instance") == capture_name(table, schema)).first()
    return f"{found['capture_instance']}_CT" if found else None


def resolve_capture_instance(change_tables: DataFrame, schema: str, table: str) -> str | None:
    """Capture instance by source schema and source table."""
    found = change_tables.where((F.col("source_schema") == schema) & (F.col("source_table") == table)).first()
    return found["capture_instance"] if found else None


def with_capture_instances(tables: DataFrame, change_tables: DataFrame) -> DataFrame:
    """``resolve_capture_instance`` for many (source_schema, source_table) rows, null where a table is not captured."""
    known = change_tables.select("source_schema", "source_table", "capture_instance").distinct()
    return tables.join(known, ["source_schema", "source_table"], "left")


def with_change_tables(tables: DataFrame, change_tables: DataFrame, *, schema: str = "dbo") -> DataFrame:
    """Many source tables at once: adds ``change_table``, null where a table is not captured."""
    known = change_tables.select(F.col("capture_instance")).distinct()
    return (
        tables.withColumn("capture_instance", capture_name(F.col("table_name"), schema))
        .join(known.withColumn("captured", F.lit(True)), "capture_instance", "left")
        .withColumn("change_table", F.when(F.col("captured"), F.concat("capture_instance", F.lit("_CT"))))
        .drop("captured", "capture_instance")
    )


def changes_since(feed: DataFrame, wm: bytes | None, *, upto: bytes | None = None) -> DataFrame:
    """Changes after a position, which itself is excluded, optionally up to and including another.

    The bounds are literals, so a landed feed skips row groups by them. Changes
    without a proper position have no place in the log: see ``misplaced``.
    """
    later = feed.where(F.col(LSN) > lsn_literal(wm))
    return later if upto is None else later.where(F.col(LSN) <= lsn_literal(upto))


def misplaced(feed: DataFrame | None = None, *, others: bool = False) -> DataFrame | Column:
    """Changes whose position is missing or has not ten bytes, or all others; without a feed, the condition."""
    raw = F.col(LSN).cast("binary")
    odd = raw.isNull() | (F.octet_length(raw) != LSN_BYTES)
    if feed is None:
        return odd
    return feed.where(~odd if others else odd)


def changes_between(feed: DataFrame, lo: bytes | None, hi: bytes | None) -> DataFrame:
    """All changes of a range, both ends included; no range means no changes yet."""
    if lo is None or hi is None:
        return feed.limit(0)
    return feed.where(F.col(LSN).between(lsn_literal(lo), lsn_literal(hi)))


def lsn_range(feed: DataFrame) -> DataFrame:
    """First and last position of a feed, nulls if it is empty."""
    return feed.agg(F.min(F.col(LSN)).alias("min_lsn"), F.max(F.col(LSN)).alias("max_lsn"))


def min_lsn(feed: DataFrame) -> bytes | None:
    found = lsn_range(feed).first()["min_lsn"]
    return None if found is None else bytes(found)


def max_lsn(feed: DataFrame) -> bytes | None:
    found = lsn_range(feed).first()["max_lsn"]
    return None if found is None else bytes(found)


def last_sync_of(df: DataFrame) -> DataFrame:
    """Highest sync position found in a table's rows, the start of the log if there is none."""
    return df.agg(F.coalesce(F.max(F.col(f"`{SYNC}`")), F.lit(ZERO_LSN)).alias(SYNC))


def last_sync(df: DataFrame) -> bytes:
    if SYNC not in df.columns:
        return ZERO_LSN
    return pad_lsn(last_sync_of(df).first()[SYNC])


# How databases write a binary literal.
BINARY_LITERAL = {"sqlserver": "0x{}", "standard": "X'{}'"}


def jdbc_position_statement(change_table: str, *, dialect: str = "sqlserver") -> str:
    """One value: how far the log goes, of the database itself where it can tell, else of the change table."""
    if dialect == "sqlserver":
        return "SELECT sys.fn_cdc_get_max_lsn() AS max_lsn"
    return f'SELECT MAX("{LSN}") AS max_lsn FROM {change_table}'


def jdbc_changes_options(
    options: Mapping[str, str],
    change_table: str,
    columns: Sequence[str],
    wm: bytes | None,
    *,
    upto: bytes | None = None,
    sequence: bool = False,
    dialect: str = "sqlserver",
    partitioning: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Options for reading a change table over JDBC with the bound inside the statement.

    The bound is part of the subquery the database runs, so it does not depend
    on which comparisons Spark can push down.
    """
    literal = BINARY_LITERAL[dialect]
    quote = "[{}]" if dialect == "sqlserver" else '"{}"'
    names = [OP, LSN, *([SEQ] if sequence else []), *columns]
    picked = ", ".join(quote.format(n) for n in names)
    position = quote.format(LSN)
    where = f"{position} > {literal.format(pad_lsn(wm).hex().upper())}"
    if upto is not None:
        where += f" AND {position} <= {literal.format(pad_lsn(upto).hex().upper())}"
    statement = f"(SELECT {picked} FROM {change_table} WHERE {where}) changes"
    return {**options, "dbtable": statement, **{k: str(v) for k, v in (partitioning or {}).items()}}


def stream_changes(
    spark: SparkSession, path: str, schema: StructType | str, *, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Landed change files as a stream. Files must land in log order; a transaction may come in several of them."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
