"""Scans of source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONING = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_snapshot(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    *,
    columns: Sequence[str] | None = None,
    partitioning: Mapping[str, object] | None = None,
) -> DataFrame:
    """Scan a whole table: ``jdbc``, ``table`` (catalog) or any file format.

    ``columns`` reaches the scan as a projection. ``partitioning`` splits a JDBC scan
    over tasks (``partitionColumn, lowerBound, upperBound, numPartitions``);
    without it a database table is read by a single task. Options may hold
    credentials and are never logged.
    """
    if partitioning and fmt != "jdbc":
        raise ValueError("partitioning applies to jdbc scans; files are split by Spark")
    if fmt == "table":
        df = spark.table(options["name"])
    else:
        reader = spark.read.format(fmt).options(**{k: v for k, v in options.items() if k != "path"})
        if partitioning:
            missing = [p for p in PARTITIONING if p not in partitioning]
            if missing:
                raise ValueError(f"partitioning needs {missing}")
            reader = reader.options(**{k: str(v) for k, v in partitioning.items()})
        df = reader.load(options["path"]) if "path" in options else reader.load()
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
