"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cdcspark import files

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.scheduler.mode": "FAIR",
    # Noting the call site of every column expression doubles the time to build a replay's plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: Shared folders chosen by callers, for sessions whose settings name none.
_chosen: dict[str, str] = {}


def build_session(app: str = "cdcspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster settings win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_shared_dir(spark: SparkSession, path: str) -> None:
    """The shared folder of a session that has no ``spark.checkpoint.dir``; the setting wins where there is one."""
    _chosen[spark.sparkContext.applicationId] = path


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else what ``use_shared_dir`` was given."""
    found = spark.conf.get("spark.checkpoint.dir", None) or _chosen.get(spark.sparkContext.applicationId)
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return found.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/cdcspark/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A path under the shared folder that is removed when the block ends."""
    path = fresh_dir(spark, purpose)
    try:
        yield path
    finally:
        files.remove(spark, path)


def written(
    df: DataFrame, purpose: str, *, reader: SparkSession | None = None, path: str | None = None
) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, so a lost executor repeats a file read and not the whole
    job, and gives the planner the real size, so it broadcasts a small result
    and shuffles a large one. ``reader`` is the session that goes on with the
    copy, by default the one of ``df``. ``path`` is for copies their writer
    removes; others stay, as checkpoints do.
    """
    spark = reader or df.sparkSession
    path = path or fresh_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
