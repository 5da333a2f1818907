"""Transactions put together in a stream whose changes come late or out of order.

A feed in which each transaction ends with a row of its own (operation ``END``: how many changes it has, and the position
of the transaction before it) may arrive in any order and in any number of pieces. What arrives is held until the transaction is
whole and all before it have been replayed; then it is replayed in log order. So nothing is too late but what comes for a
transaction that was whole without it.

What is held is a table beside the query's checkpoint, written anew with each micro-batch before the target's commit. A
micro-batch that comes again starts from the table that the one before it left.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdcspark import files
from cdcspark.functions.lsn import END, LSN, OP, SEQ, TX_CHANGES, TX_PREVIOUS, lsn_literal
from cdcspark.jobs import Metrics, TableJob, incremental_sync
from cdcspark.operators.apply import _c
from cdcspark.session import scratch, written
from cdcspark.sources.changes import misplaced
from cdcspark.streaming.run import DEFAULT_INTERVAL


class TransactionError(RuntimeError):
    """A transaction has more changes than its end says, or more is held than allowed."""


def run_transactions(
    feed: DataFrame,
    job: TableJob,
    *,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    on_batch: Callable[[Metrics], None] | None = None,
    most_held: int | None = None,
) -> StreamingQuery:
    """Apply a streaming feed with transaction ends to a table, each transaction whole and in log order.

    With a sequence column a change that arrives twice counts once. ``most_held`` ends the query with an error when more rows than that
    wait for others; without it a transaction that never becomes whole holds back all after it.
    """
    missing = {OP, LSN, TX_CHANGES, TX_PREVIOUS} - set(feed.columns)
    if missing:
        raise ValueError(f"the feed has no columns {sorted(missing)}")
    held = f"{checkpoint.rstrip('/')}/held"

    def batch(changes: DataFrame, number: int) -> None:
        spark, base = job.spark, job.store.current(job.table)
        known = base.last_batch(checkpoint)
        if known and known.number >= number:
            return
        before = f"{held}/{number - 1}"
        if files.names_in(spark, before):
            changes = changes.unionByName(changes.sparkSession.read.schema(changes.schema).parquet(before))
        with scratch(spark, "arrived") as path:
            arrived = written(changes, "arrived", reader=spark, path=path)
            if SEQ in arrived.columns:
                # Ends have no sequence number; the operation tells them from changes.
                once = misplaced(arrived, others=True).dropDuplicates([LSN, SEQ, OP])
                arrived = once.unionByName(misplaced(arrived))
            upto = whole_upto(arrived, base.position)
            inside = _c(LSN) <= lsn_literal(upto)
            rest = misplaced(arrived, others=True).where(~inside)
            rest.write.mode("overwrite").parquet(f"{held}/{number}")
            if most_held is not None and rest.count() > most_held:
                raise TransactionError(f"more than {most_held} changes wait for a transaction behind position {upto.hex()}")
            done = incremental_sync(job, feed=arrived.where(inside | misplaced()), batch=(checkpoint, number), whole=True)
        files.remove(spark, f"{held}/{number - 2}")
        if on_batch:
            on_batch(done)

    writer = feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": DEFAULT_INTERVAL})).start()


def whole_upto(arrived: DataFrame, position: bytes) -> bytes:
    """The position up to which all transactions behind ``position`` are whole, ``position`` itself if the next one is not.

    Only counts per transaction are shuffled, summed before that, and two values come to the driver.
    """
    later = misplaced(arrived, others=True).where(_c(LSN) > lsn_literal(position))
    is_end = F.coalesce(_c(OP) == END, F.lit(False))
    parts = later.groupBy(_c(LSN).alias("lsn")).agg(
        F.count_if(~is_end).alias("n"),
        F.max(F.when(is_end, _c(TX_CHANGES))).alias("changes"),
        F.max(F.when(is_end, _c(TX_PREVIOUS))).alias("previous"),
    )
    ends = parts.where("changes IS NOT NULL").select(F.col("lsn").alias("there"))
    linked = parts.join(ends, F.col("previous") == F.col("there"), "left")
    follows = F.coalesce(F.col("previous") <= lsn_literal(position), F.lit(True)) | F.col("there").isNotNull()
    over = F.col("n") > F.col("changes")
    message = F.concat(F.lit("more changes than its end says at position "), F.hex(F.col("lsn")))
    whole = F.when(over, F.raise_error(message)).otherwise(F.coalesce(F.col("n") == F.col("changes"), F.lit(False)) & follows)
    judged = linked.select("lsn", whole.cast("boolean").alias("whole"))
    # Whole ones below the least one that is not.
    first = judged.agg(F.min(F.when(~F.col("whole"), F.col("lsn"))).alias("open"), F.max("lsn").alias("top")).first()
    if first["top"] is None:
        return position
    if first["open"] is None:
        return bytes(first["top"])
    below = parts.where(F.col("lsn") < F.lit(bytes(first["open"]))).agg(F.max("lsn").alias("lsn")).first()["lsn"]
    return position if below is None else bytes(below)


def transaction_ends(feed: DataFrame) -> DataFrame:
    """The rows that end each transaction of a feed that is known to be whole, to go with its changes.

    For sources that can list their transactions: the list, one row per transaction, is sorted in one task.
    """
    sizes = misplaced(feed, others=True).groupBy(_c(LSN).alias(LSN)).agg(F.count(F.lit(1)).alias(TX_CHANGES))
    return sizes.select(
        F.lit(END).alias(OP), _c(LSN), _c(TX_CHANGES), F.lag(_c(LSN)).over(Window.orderBy(_c(LSN))).alias(TX_PREVIOUS)
    )
