"""Table structure taken over from the source's information schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType, _parse_datatype_string

from cdcspark.functions.lsn import SYNC

# Source type names by the Spark type that holds them.
TEXT_TYPES = ["varchar", "nvarchar", "char", "nchar"]
DECIMAL_TYPES = ["decimal", "numeric"]
PLAIN_TYPES = {
    "int": "int",
    "bigint": "bigint",
    "smallint": "smallint",
    "tinyint": "smallint",
    "float": "double",
    "real": "float",
    "bit": "boolean",
    "date": "date",
    "datetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz",
    "smalldatetime": "timestamp_ntz",
    "time": "string",
    "text": "string",
    "ntext": "string",
    "binary": "binary",
    "varbinary": "binary",
    "blob": "binary",
    "image": "binary",
    "rowversion": "binary",
    "timestamp": "binary",
    "money": "decimal(19,4)",
    "smallmoney": "decimal(10,4)",
    "uniqueidentifier": "string",
    "datetimeoffset": "timestamp",
    "xml": "string",
}

# Source type names for the Spark types of landed files.
LANDED_TYPES = {
    "int": "int", "bigint": "bigint", "smallint": "smallint", "tinyint": "smallint", "float": "real", "double": "float",
    "boolean": "bit", "date": "date", "timestamp": "datetimeoffset", "timestamp_ntz": "datetime2", "string": "varchar",
    "binary": "varbinary",
}

#: Where a column's source type is kept when its values are held as text for want of a better type.
SOURCE_TYPE = "source_type"
DEFAULT_PRECISION, DEFAULT_SCALE = 38, 18

INFORMATION_SCHEMA = (
    "COLUMN_NAME string, DATA_TYPE string, CHARACTER_MAXIMUM_LENGTH int, NUMERIC_PRECISION int, NUMERIC_SCALE int, "
    "IS_NULLABLE string, ORDINAL_POSITION int"
)


def spark_type(info: DataFrame) -> Column:
    """Spark type, as DDL text, for rows of an information schema; values of unknown types are held as text.

    Decimals keep precision and scale where the information schema has them.
    Time of day is kept as ``HH:mm:ss`` text.
    """
    kind = F.lower(F.col("DATA_TYPE"))
    known = F.when(kind.isin(*TEXT_TYPES), F.lit("string"))
    if {"NUMERIC_PRECISION", "NUMERIC_SCALE"} <= set(info.columns):
        digits = F.coalesce(F.col("NUMERIC_PRECISION").cast("int"), F.lit(DEFAULT_PRECISION))
        scale = F.coalesce(F.col("NUMERIC_SCALE").cast("int"), F.lit(DEFAULT_SCALE))
        decimal = F.format_string("decimal(%d,%d)", digits, scale)
    else:
        decimal = F.lit(f"decimal({DEFAULT_PRECISION},{DEFAULT_SCALE})")
    known = known.when(kind.isin(*DECIMAL_TYPES), decimal)
    for name, held_by in PLAIN_TYPES.items():
        known = known.when(kind == name, F.lit(held_by))
    return known.otherwise(F.when(kind.isNotNull(), F.lit("string")))


def declared_type(info: DataFrame) -> Column:
    """Column type for the DDL of a relational target.

    Type names are read without regard to case, here as for ``spark_type``, and
    given in lower case. Text keeps its length and gets 255 without one, ``datetime`` and ``bit``
    get the target's names, other types pass by name. A length of -1 (no limit) becomes
    ``text``; decimals keep precision and scale if known.
    """
    kind = F.lower(F.col("DATA_TYPE"))
    length = F.col("CHARACTER_MAXIMUM_LENGTH").cast("int")
    text = F.when(length == -1, F.lit("text")).otherwise(
        F.concat(kind, F.lit("("), F.coalesce(F.nullif(length, F.lit(0)), F.lit(255)).cast("string"), F.lit(")"))
    )
    declared = F.when(kind.isin(*TEXT_TYPES), text).when(kind == "datetime", "DATETIME").when(kind == "bit", "TINYINT(1)")
    if {"NUMERIC_PRECISION", "NUMERIC_SCALE"} <= set(info.columns):
        sized = F.col("NUMERIC_PRECISION").isNotNull() & F.col("NUMERIC_SCALE").isNotNull()
        with_size = F.format_string(
            "%s(%d,%d)", kind, F.col("NUMERIC_PRECISION").cast("int"), F.col("NUMERIC_SCALE").cast("int")
        )
        declared = declared.when(kind.isin(*DECIMAL_TYPES) & sized, with_size)
    return declared.otherwise(kind)


def translate_types(info: DataFrame) -> DataFrame:
    """Information schema with ``spark_type``, ``declared_type`` and ``nullable`` added."""
    return info.select(
        "*",
        spark_type(info).alias("spark_type"),
        declared_type(info).alias("declared_type"),
        (F.col("IS_NULLABLE") == "YES").alias("nullable"),
    )


def describe(df: DataFrame) -> DataFrame:
    """An information schema of a DataFrame's own columns; types without a source name keep Spark's."""
    rows = []
    for i, f in enumerate(df.schema.fields, 1):
        kind, precision, scale = f.dataType.simpleString(), None, None
        if isinstance(f.dataType, DecimalType):
            kind, precision, scale = "decimal", f.dataType.precision, f.dataType.scale
        length = -1 if kind == "string" else None
        rows.append((f.name, LANDED_TYPES.get(kind, kind), length, precision, scale, "YES" if f.nullable else "NO", i))
    return df.sparkSession.createDataFrame(rows, INFORMATION_SCHEMA)


def translate_schema(info: DataFrame) -> StructType:
    """Schema of one table from its information-schema rows.

    Rows keep their order, or follow ``ORDINAL_POSITION`` if there is one. No
    rows means the source has no such table.
    """
    rows = translate_types(info)
    if "ORDINAL_POSITION" in info.columns:
        rows = rows.orderBy("ORDINAL_POSITION")
    fields = []
    for row in rows.select("COLUMN_NAME", "DATA_TYPE", "spark_type", "nullable").collect():
        if row["COLUMN_NAME"] == SYNC:
            continue
        if row["spark_type"] is None:
            raise ValueError(f"column {row['COLUMN_NAME']} has no type")
        kept = {SOURCE_TYPE: row["DATA_TYPE"]} if row["spark_type"] == "string" else None
        fields.append(StructField(row["COLUMN_NAME"], _parse_datatype_string(row["spark_type"]), row["nullable"], kept))
    if not fields:
        raise LookupError("the table is not in the source's information schema")
    return StructType(fields)


def ensure_sync_column(df: DataFrame) -> DataFrame:
    """Add the sync column if it is missing, make it binary if it is not."""
    if SYNC not in df.columns:
        return df.withColumn(SYNC, F.lit(None).cast("binary"))
    if dict(df.dtypes)[SYNC] != "binary":
        return df.withColumn(SYNC, F.col(f"`{SYNC}`").cast("binary"))
    return df
