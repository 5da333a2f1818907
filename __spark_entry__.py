"""Registered queries and the SQL each one must agree with."""

from __future__ import annotations

import functools
import importlib.util
import os
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from cdcspark import cuts, files
from cdcspark import fixtures as fx
from cdcspark import jobs as jb
from cdcspark import repair as rp
from cdcspark.functions.lsn import LSN, OP, SEQ, SYNC, lsn_from_number, lsn_hex, to_lsn
from cdcspark.operators import apply as ap
from cdcspark.operators import feed as fd
from cdcspark.operators import moves as mv
from cdcspark.operators import quarantine as qr
from cdcspark.operators import ranges as rg
from cdcspark.operators import rows as rw
from cdcspark.operators.skew import hot_keys
from cdcspark.plans import drift as dr
from cdcspark.plans import mapping as mp
from cdcspark.plans import schema as sc
from cdcspark.session import fresh_dir, use_shared_dir, written
from cdcspark.sinks.store import Store
from cdcspark.sources import changes as ch
from cdcspark.sources import logstream as ls
from cdcspark.sources import splits as sp
from cdcspark.sources.snapshot import read_snapshot
from cdcspark.sources.tables import FileSource
from cdcspark.streaming.metrics import StreamMetrics, run_reported
from cdcspark.streaming.run import run_stream
from cdcspark.streaming.transactions import run_transactions
from oracles import oracle_sql as base_sql

Query = Callable[[SparkSession, str], DataFrame]

#: Data of ``entry``.
ENTRY_DIR = "/root/testdata/sf0.001"

#: Shared folder for sessions that name none in ``spark.checkpoint.dir`` (one machine, as in tests).
SHARED_DIR = os.environ.get("CDCSPARK_SHARED_DIR") or os.path.join(tempfile.gettempdir(), "cdcspark-shared")

#: The corpus operators are optional: without their folder everything else still works.
_found = importlib.util.find_spec("cdcspark.llm")
HAS_LLM = _found is not None and _found.origin is not None

ACCOUNT = StructType([StructField("k", LongType()), StructField("v", DoubleType())])


def _half(spark: SparkSession, sf_dir: str) -> bytes:
    """Position in the middle of the log."""
    top = fx.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return (top // 2 + 1).to_bytes(10, "big")


def _shown(feed: DataFrame) -> DataFrame:
    return feed.select(F.col(OP).alias("op"), lsn_hex(F.col(LSN)).alias("lsn"), "k", "v")


# -- configuration and schema -------------------------------------------------


def mapping_rows(spark, sf_dir):
    return mp.parse_mapping(fx.mapping_documents(spark, sf_dir), keep=["doc"])


def mapping_source_tables(spark, sf_dir):
    rows = mp.parse_mapping(fx.mapping_documents(spark, sf_dir), keep=["doc"])
    return mp.source_tables(rows, by=["doc", "target"])


def table_list(spark, sf_dir):
    """Documents without a list are passed over on request."""
    return mp.parse_table_list(fx.table_list_documents(spark, sf_dir), keep=["doc"], strict=False)


def table_pairs(spark, sf_dir):
    return mp.parse_pairs(fx.pair_texts(spark, sf_dir), keep=["doc"])


def type_translation(spark, sf_dir):
    return sc.translate_types(fx.information_schema(spark, sf_dir)).select(
        F.col("COLUMN_NAME").alias("column_name"), "spark_type", "declared_type", "nullable"
    )


def ensure_sync(spark, sf_dir):
    """Once added, once cast from text."""
    added = sc.ensure_sync_column(fx.accounts(spark, sf_dir))
    texts = fx.accounts(spark, sf_dir).withColumn(SYNC, F.col("k").cast("string"))
    cast = sc.ensure_sync_column(texts)
    both = added.unionByName(cast)
    return both.select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def created_table(spark, sf_dir):
    """A table made from its source's information schema, then filled."""
    source, _ = _landing(spark, sf_dir)
    store = Store(spark, fresh_dir(spark, "created"), buckets=8)
    schema = jb.create_from_schema(store, "accounts", source.information_schema(spark, "accounts"))
    if schema is None or not store.is_new("accounts"):
        raise AssertionError("the table was not created")
    store.append("accounts", fx.accounts(spark, sf_dir))
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def configuration_verdicts(spark, sf_dir):
    """What is wrong with each configuration text."""
    return fx.configuration_texts(spark, sf_dir).select(
        "doc", mp.mapping_verdict("mapping").alias("mapping"), mp.table_list_verdict("tables").alias("tables"),
        mp.pairs_verdict("pairs").alias("pairs"),
    )


def captured_columns(spark, sf_dir):
    feed = fx.events_feed(spark, sf_dir).withColumn("w", F.lit(1))
    return _shown(mp.captured_columns(feed, "k,v"))


# -- reading ------------------------------------------------------------------


def snapshot_projection(spark, sf_dir):
    columns = [("id", "o_orderkey"), ("client", "o_custkey"), ("state", "o_orderstatus"), ("total", "o_totalprice")]
    source = read_snapshot(spark, "parquet", {"path": f"{sf_dir}/orders.parquet"}, columns=[s for _, s in columns])
    return mp.project_mapped(source, columns)


def snapshot_all_columns(spark, sf_dir):
    source = read_snapshot(spark, "parquet", {"path": f"{sf_dir}/customer.parquet"})
    return source.select(*mp.table_columns(source))


def split_ranges(spark, sf_dir):
    """Ranges of two composite keys of the lines, one with texts and nulls, each row counted under every range's SQL."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_tax") != 0.08, F.col("l_returnflag")).alias("flag"), "l_partkey"
    )
    shown = lines
    for name, keys in (("key", ["l_orderkey", "l_linenumber"]), ("flag", ["flag", "l_partkey"])):
        splits = sp.plan_splits(lines, keys, 12)
        held = [F.when(F.expr(text), 1).otherwise(0) for text in splits.statements(dialect="spark")]
        same = functools.reduce(lambda a, b: a | b, [splits.condition(i) & (splits.number_of() == i) for i in range(len(splits))])
        # Six standard deviations of a quantile of the sketch, at most.
        share = lines.groupBy(splits.number_of().alias("n")).agg(F.count(F.lit(1)).alias("rows")).agg(
            (F.max("rows") <= 2.5 * F.sum("rows") / 12).alias(f"{name}_even")
        )
        shown = shown.select("*", sum(held, F.lit(0)).alias(f"by_{name}"), same.alias(f"{name}_same")).crossJoin(share)
    return shown


def change_tables(spark, sf_dir):
    """Which customers' tables are captured: those of a name some supplier shares."""
    tables = fx.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table_name")
    )
    catalog = fx.table(spark, sf_dir, "supplier").select(
        ch.capture_name(F.concat(F.lit("t"), F.col("s_suppkey").cast("string"))).alias("capture_instance")
    )
    return ch.with_change_tables(tables, catalog)


def capture_instances(spark, sf_dir):
    """Capture instances by source schema and table: the orders' customers against the suppliers' catalog."""
    tables = fx.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("source_schema"), F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("source_table")
    )
    segments = F.when(F.col("s_nationkey") < 12, "BUILDING").otherwise("MACHINERY")
    catalog = fx.table(spark, sf_dir, "supplier").select(
        segments.alias("source_schema"), F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("source_table"),
    ).withColumn("capture_instance", F.concat_ws("_", "source_schema", "source_table"))
    return ch.with_capture_instances(tables, catalog)


def _landed(spark, sf_dir) -> DataFrame:
    """The events' feed as files, so that a bound on the position reaches the row groups."""
    path = fresh_dir(spark, "landed-feed")
    fx.events_feed(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def changes_since(spark, sf_dir):
    return _shown(ch.changes_since(_landed(spark, sf_dir), _half(spark, sf_dir)))


def empty_range(spark, sf_dir):
    """A feed without a range has no changes; the whole range has all."""
    feed = fx.events_feed(spark, sf_dir)
    count = F.count(F.lit(1)).alias("changes")
    none = ch.changes_between(feed, None, None).agg(count).select(F.lit("none").alias("of"), "changes")
    whole = ch.changes_between(feed, ch.min_lsn(feed), ch.max_lsn(feed)).agg(count).select(F.lit("whole").alias("of"), "changes")
    return none.unionByName(whole)


def position_cast(spark, sf_dir):
    """Positions of any width brought to ten bytes."""
    events = fx.table(spark, sf_dir, "events")
    return events.select("event_id", lsn_hex(to_lsn(F.unhex(F.hex("event_id")))).alias("lsn"))


def changes_between(spark, sf_dir):
    """The whole retained range, as a monitor reads it."""
    feed = fx.events_feed(spark, sf_dir)
    ends = ch.lsn_range(feed).first()
    return _shown(ch.changes_between(feed, ends["min_lsn"], ends["max_lsn"]))


def lsn_range(spark, sf_dir):
    return ch.lsn_range(fx.events_feed(spark, sf_dir)).select(
        lsn_hex(F.col("min_lsn")).alias("min_lsn"), lsn_hex(F.col("max_lsn")).alias("max_lsn")
    )


def last_sync(spark, sf_dir):
    stamped = fd.stamped(fx.accounts(spark, sf_dir), lsn_from_number(F.col("k")))
    return ch.last_sync_of(stamped).select(F.hex(F.col(f"`{SYNC}`")).alias("last_sync"))


# -- writing and replay -------------------------------------------------------


def stamp_sync(spark, sf_dir):
    position = ch.max_lsn(fx.events_feed(spark, sf_dir))
    stamped = fd.stamped(fx.accounts(spark, sf_dir), F.lit(position))
    return stamped.select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def _apply(mode, target=fx.accounts) -> Query:
    def run(spark, sf_dir):
        return ap.apply_changes(target(spark, sf_dir), fx.events_feed(spark, sf_dir), keys=["k"], mode=mode)

    return run


def apply_since(spark, sf_dir):
    """Only the second half of the log, on the whole target."""
    feed = ch.changes_since(_landed(spark, sf_dir), _half(spark, sf_dir))
    return ap.apply_changes(fx.accounts(spark, sf_dir), feed, keys=["k"], mode="strict")


def apply_mixed_types(spark, sf_dir):
    """Feeds of narrower types than the target's, with some keys split off as hot, in all modes."""
    feed = fx.events_feed(spark, sf_dir).withColumn("k", F.col("k").cast("int"))
    parts = []
    for mode, target in (("upsert", fx.accounts), ("strict", fx.accounts), ("bag", fx.quantities)):
        rows = target(spark, sf_dir)
        hot = hot_keys(rows.unionByName(feed.select(F.col("k").cast("long"), "v")), ["k"], share=0.002, min_rows=1)
        parts.append(ap.apply_changes(rows, feed, mode=mode, hot=hot).select(F.lit(mode).alias("mode"), "k", "v"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def apply_composite(spark, sf_dir):
    """Key of two columns, several changes per position ordered by sequence columns."""
    lines = fx.table(spark, sf_dir, "lineitem")
    feed = lines.select(
        F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "R", 1).otherwise(4).alias(OP),
        lsn_from_number(F.unix_date(F.col("l_shipdate").cast("date"))).alias(LSN),
        F.col("l_linenumber").alias("s1"), F.col("l_partkey").alias("s2"), F.col("l_orderkey").alias("s3"),
        F.col("l_extendedprice").alias("s4"),
        F.col("l_suppkey").alias("supp"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("v"),
    )
    # Not every part has each supplier, so the target starts without some keys of the feed.
    target = fx.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % F.lit(100)).alias("supp"), F.col("p_partkey").alias("part"),
        F.col("p_retailprice").alias("v"),
    )
    return ap.apply_changes(
        target, feed, keys=["supp", "part"], order_by=[LSN, "s1", "s2", "s3", "s4"], mode="strict"
    )


def insert_rows(spark, sf_dir):
    """Plain inserts: the feed's new rows behind the table's own."""
    store = Store(spark, fresh_dir(spark, "insert"), buckets=8)
    store.full_load("t", fx.accounts(spark, sf_dir), None)
    store.append("t", fx.events_feed(spark, sf_dir).where(F.col(OP) == 2).select("k", "v"))
    return store.read("t", with_sync=False)


def clear_and_reload(spark, sf_dir):
    """Emptied, then filled with the later state: nothing of the first load is left."""
    store = Store(spark, fresh_dir(spark, "reload"), buckets=8)
    store.full_load("t", fx.table(spark, sf_dir, "customer"), None)
    store.clear("t")
    if not store.read("t").isEmpty():
        raise AssertionError("a cleared table has rows")
    store.full_load("t", fx.later_customers(spark, sf_dir), None)
    return store.read("t", with_sync=False)


def new_watermark(spark, sf_dir):
    feed = fx.events_feed(spark, sf_dir)
    return ap.watermark_after(feed, b"\x01").select(F.hex(F.col(f"`{SYNC}`")).alias("watermark"))


def key_changes(spark, sf_dir):
    """Updates that move an account: the old key goes, the new one stays."""
    feed = fx.events_feed(spark, sf_dir).withColumn("old_k", F.when(F.col("v") < 20, F.col("k") + 7).otherwise(F.col("k")))
    moved = ap.expand_key_changes(feed, ["k"], {"k": "old_k"})
    return _shown(moved)


def quarantine_split(spark, sf_dir):
    good, bad = qr.quarantine_split(fx.raw_feed(spark, sf_dir), ACCOUNT, ["k"])
    usable = good.select(
        F.col(OP).alias("op"), F.hex(F.col(LSN)).alias("lsn"), "k", "v", F.lit(None).cast("string").alias("reason")
    )
    return usable.unionByName(
        bad.select(
            F.col(OP).alias("op"), F.hex(F.col(LSN)).alias("lsn"), "k", F.lit(None).cast("double").alias("v"),
            F.col(qr.REASON).alias("reason"),
        )
    )


def change_counts(spark, sf_dir):
    return fd.change_counts(fx.raw_feed(spark, sf_dir))


def change_report(spark, sf_dir):
    report = fd.change_report(fx.events_feed(spark, sf_dir))
    return report.withColumn("min_lsn", lsn_hex(F.col("min_lsn"))).withColumn("max_lsn", lsn_hex(F.col("max_lsn")))


def update_by_key(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return rw.update_by_key(lines, {"l_linenumber": 3, "l_returnflag": "A"}, {"l_quantity": 0})


def delete_by_key(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return rw.delete_by_key(lines, {"l_linenumber": 3, "l_returnflag": "A"})


def thin_rows(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return rw.thin_rows(orders, 30, by="o_orderkey")


def thin_rows_random(spark, sf_dir):
    """A random draw keeps rows of the table, each once, and about as many as asked for."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    kept = rw.thin_rows(orders, 30, seed=7)
    n, m = F.col("n"), F.col("m")
    sizes = kept.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("d")).crossJoin(
        orders.agg(F.count(F.lit(1)).alias("m"))
    )
    strange = kept.join(orders, "o_orderkey", "left_anti").agg(F.count(F.lit(1)).alias("strange"))
    # Six standard deviations of a draw of m with 0.7.
    near = F.abs(n - 0.7 * m) <= 6 * F.sqrt(m * 0.7 * 0.3) + 1
    return sizes.crossJoin(strange).select(
        (F.col("strange") == 0).alias("members"), (n == F.col("d")).alias("once"), near.alias("about_as_many")
    )


def sample_one(spark, sf_dir):
    """One row, and one of the table's."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    one = rw.sample_one(orders, seed=7)
    members = one.join(orders, ["o_orderkey", "o_totalprice"], "left_semi")
    return one.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(members.agg((F.count(F.lit(1)) == 1).alias("member")))


def stored_update(spark, sf_dir):
    """The same edit committed to a stored table."""
    store = _stored_lines(spark, sf_dir)
    store.update_rows("lines", {"l_linenumber": 3, "l_returnflag": "A"}, {"l_quantity": 0})
    return store.read("lines", with_sync=False)


def stored_delete(spark, sf_dir):
    store = _stored_lines(spark, sf_dir)
    store.delete_rows("lines", {"l_linenumber": 3, "l_returnflag": "A"})
    return store.read("lines", with_sync=False)


def _stored_lines(spark, sf_dir) -> Store:
    store = Store(spark, fresh_dir(spark, "edited"), buckets=8)
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    store.full_load("lines", lines, None, keys=["l_orderkey", "l_linenumber"])
    return store


# -- feeds and comparisons ----------------------------------------------------


def net_changes(spark, sf_dir):
    return _shown(fd.net_changes(fx.events_feed(spark, sf_dir), ["k"]))


def net_changes_without_key(spark, sf_dir):
    """Inserts without a key pass a net feed as they are."""
    return _shown(fd.net_changes(fx.keyless_feed(spark, sf_dir), ["k"]))


def reconcile_mixed_types(spark, sf_dir):
    source, target = fx.retyped_customers(spark, sf_dir)
    return fd.reconcile(source, target, ["k"])


def capture_changes(spark, sf_dir):
    found = fd.capture_changes(
        fx.table(spark, sf_dir, "customer"), fx.later_customers(spark, sf_dir), ["c_custkey"], batch=77
    )
    return found.select(
        F.col(OP).alias("op"), lsn_hex(F.col(LSN)).alias("lsn"),
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
    )


def capture_then_apply(spark, sf_dir):
    """Replaying the captured changes on the earlier snapshot gives the later one."""
    before = fx.table(spark, sf_dir, "customer")
    found = fd.capture_changes(before, fx.later_customers(spark, sf_dir), ["c_custkey"], batch=1)
    return ap.apply_changes(before, found, keys=["c_custkey"], mode="strict")


def capture_moves(spark, sf_dir):
    """Customers under new keys: of many with one content, paired by key; some only left or only came."""
    columns = ["c_custkey", "c_nationkey", "c_mktsegment"]
    before = fx.table(spark, sf_dir, "customer").select(*columns)
    found = fd.capture_changes(before, fx.moved_customers(spark, sf_dir).select(*columns), ["c_custkey"], batch=5)
    moves = mv.capture_moves(written(found, "captured"), ["c_custkey"])
    return moves.select(F.col(OP).alias("op"), lsn_hex(F.col(LSN)).alias("lsn"), *columns, F.col(f"{mv.BEFORE}c_custkey").alias("before"))


def reconcile_status(spark, sf_dir):
    source, target = fx.table(spark, sf_dir, "orders"), fx.lagging_orders(spark, sf_dir)
    return fd.reconcile_counts(fd.reconcile(source, target, ["o_orderkey"]))


def reconcile_keys(spark, sf_dir):
    source, target = fx.table(spark, sf_dir, "orders"), fx.lagging_orders(spark, sf_dir)
    return fd.reconcile(source, target, ["o_orderkey"])


def reconcile_ranges(spark, sf_dir):
    """The keys that are not equal, found by ranges: once with differences all over the table, once with few in one place."""
    orders = fx.table(spark, sf_dir, "orders")
    levels = []
    all_over = rg.reconcile_ranges(orders, fx.lagging_orders(spark, sf_dir), ["o_orderkey"], parts=32)
    place = rg.reconcile_ranges(
        orders, fx.nearly_orders(spark, sf_dir), ["o_orderkey"], parts=32, fanout=8, leaf_rows=10, on_level=levels.append
    )
    if len(levels) < 2 or levels[-1].differing_rows * 8 > levels[0].rows:
        raise AssertionError(f"few rows were to be read: {levels}")
    return all_over.select(F.lit("all over").alias("differences"), "*").unionByName(place.select(F.lit("one place").alias("differences"), "*"))


def reconcile_repeated_keys(spark, sf_dir):
    source, target = fx.table(spark, sf_dir, "lineitem"), fx.lagging_lineitem(spark, sf_dir)
    return fd.reconcile(source, target, ["l_orderkey", "l_linenumber"])


def reconcile_whole_rows(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    source = fx.table(spark, sf_dir, "lineitem").select(*columns)
    return fd.reconcile(source, fx.lagging_lineitem(spark, sf_dir).select(*columns))


def pair_status(spark, sf_dir):
    pairs = mp.parse_pairs(spark.createDataFrame([("orders,lineitem;customer,no_such_table",)], "value string"))
    return fd.pair_status(spark, pairs, read=lambda session, name: fx.table(session, sf_dir, name))


# -- jobs ---------------------------------------------------------------------


def _events_since(sf_dir: str):
    return lambda spark, position: fx.events_feed(spark, sf_dir)


def _job(spark, sf_dir, store, table, mode, snapshot, **more) -> jb.TableJob:
    """Loads ``snapshot`` at the start of the log, so the whole feed is replayed."""
    store.full_load(table, snapshot(spark, sf_dir), None, keys=["k"])
    return jb.TableJob(
        table, store, lambda s: snapshot(s, sf_dir), _events_since(sf_dir), keys=["k"], mode=mode, **more
    )


def initial_sync(spark, sf_dir):
    """First load through a mapping; the position is the feed's last."""
    store = Store(spark, fresh_dir(spark, "initial"), buckets=8)
    job = jb.TableJob(
        "clients", store, lambda s: fx.table(s, sf_dir, "customer"), _events_since(sf_dir), keys=["id"],
        columns=[("id", "c_custkey"), ("name", "c_name"), ("balance", "c_acctbal")],
    )
    jb.initial_sync(job)
    return store.read("clients").select("id", "name", "balance", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def chunked_initial_sync(spark, sf_dir):
    """First loads by ranges of the key, while changes land before, during and after every reading."""
    parts = []
    for mode, target in (("upsert", fx.accounts), ("strict", fx.accounts), ("bag", fx.quantities)):
        store = Store(spark, fresh_dir(spark, "chunked"), buckets=8)
        source = fx.GrowingSource(spark, sf_dir, target, mode, lambda: store.load_in_progress("t"))
        job = jb.TableJob("t", store, source.snapshot, source.changes, keys=["k"], mode=mode, position=source.position, chunks=3)
        _without_errors([jb.initial_sync(job)])
        source.land_all()
        _without_errors([jb.incremental_sync(job)])
        parts.append(store.read("t").select(F.lit(mode).alias("mode"), "k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def incremental_sync(spark, sf_dir):
    store = Store(spark, fresh_dir(spark, "incremental"), buckets=8)
    job = _job(spark, sf_dir, store, "accounts", "strict", fx.accounts)
    jb.incremental_sync(job)
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def full_load(spark, sf_dir):
    store = Store(spark, fresh_dir(spark, "load"), buckets=8)
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    store.full_load("lineitem", lines, b"\x2a", keys=["l_orderkey"])
    return store.read("lineitem").withColumn("sync", F.hex(F.col(f"`{SYNC}`"))).drop(SYNC)


def multi_table_cycle(spark, sf_dir):
    """Three tables in one cycle, one of them broken: the others still arrive."""
    store = Store(spark, fresh_dir(spark, "cycle"), buckets=8)
    tables = [
        _job(spark, sf_dir, store, "a_upsert", "upsert", fx.accounts),
        _job(spark, sf_dir, store, "b_bag", "bag", fx.quantities),
    ]

    def fails(_spark, _position):
        raise RuntimeError("source is down")

    broken = _job(spark, sf_dir, store, "c_broken", "upsert", fx.accounts)
    broken.changes = fails
    done = {m.table: m for m in jb.run_cycle([*tables, broken])}
    if done["a_upsert"].error or done["b_bag"].error or not done["c_broken"].error:
        raise AssertionError(f"unexpected outcome: {done}")
    parts = [
        store.read(name).select(F.lit(name).alias("table_name"), "k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))
        for name in ("a_upsert", "b_bag", "c_broken")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def consistent_cycle(spark, sf_dir):
    """Two tables and a slow one: what a reader of the newest cut sees after each of three cycles, the second of which fails."""
    store = Store(spark, fresh_dir(spark, "cuts"), buckets=8)
    top, half = ch.max_lsn(fx.events_feed(spark, sf_dir)), _half(spark, sf_dir)
    reached = {"a_upsert": top, "b_bag": top, "c_slow": half}
    jobs = [
        _job(spark, sf_dir, store, "a_upsert", "upsert", fx.accounts, retain_hours=0),
        _job(spark, sf_dir, store, "b_bag", "bag", fx.quantities, retain_hours=0),
        _job(spark, sf_dir, store, "c_slow", "strict", fx.accounts, retain_hours=0),
    ]
    for job in jobs:
        job.position = functools.partial(lambda table, _: reached[table], job.table)
    works, parts = jobs[2].changes, []

    def fails(_spark, _position):
        raise RuntimeError("source is down")

    for cycle, at, changes in ((1, half, works), (2, top, fails), (3, top, works)):
        reached["c_slow"], jobs[2].changes = at, changes
        done = cuts.consistent_cycle(jobs)
        if (done.held_back is None) != (cycle != 2) or done.barrier != at:
            raise AssertionError(f"unexpected outcome: {done}")
        for name, rows in sorted(store.read_cut().items()):
            rows = written(rows, "cut")
            parts.append(rows.select(F.lit(cycle).alias("cycle"), F.lit(name).alias("table_name"), "k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync")))
    return functools.reduce(DataFrame.unionByName, parts)


def deferred_replay(spark, sf_dir):
    """The two halves of the log, replayed one after the other."""
    return _replayed(spark, sf_dir, lambda part: part)


def folded_replay(spark, sf_dir):
    """The same, each half folded to the last change of a key first."""
    return _replayed(spark, sf_dir, lambda part: ap.last_changes(part, ["k"], columns=["k", "v", LSN]))


def _replayed(spark, sf_dir, prepared):
    store = Store(spark, fresh_dir(spark, "halves"), buckets=8)
    store.full_load("t", fx.accounts(spark, sf_dir), None, keys=["k"])
    feed, half = fx.events_feed(spark, sf_dir), _half(spark, sf_dir)
    top = ch.max_lsn(feed)
    for part, position in ((ch.changes_since(feed, None, upto=half), half), (ch.changes_since(feed, half), top)):
        store.replay("t", prepared(part), position)
    return store.read("t").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def evolved_table(spark, sf_dir):
    """A column widened, one added and one dropped between two replays; a narrowed one is refused. No row is loaded again."""
    store = Store(spark, fresh_dir(spark, "evolved"), buckets=8)
    customers = fx.table(spark, sf_dir, "customer")
    rows = customers.select(
        F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("int").alias("v"), F.col("c_name").alias("note"), F.col("c_mktsegment").alias("seg")
    )
    store.full_load("accounts", rows, None, keys=["k"])
    half, feed = _half(spark, sf_dir), fx.events_feed(spark, sf_dir)
    events = fx.table(spark, sf_dir, "events").select(lsn_from_number(F.col("event_id") + 1).alias(LSN), F.col("event_type").alias("note"))
    late = feed.join(events, LSN).withColumn("w", F.col("v") + 1)
    early = late.withColumn("v", F.floor("v").cast("int")).withColumn("seg", F.lit("new")).drop("w")
    info = {"at": rows}
    job = jb.TableJob(
        "accounts", store, lambda s: rows, lambda s, p: early if info["at"] is rows else late, keys=["k"], on_drift="evolve",
        position=lambda _: half if info["at"] is rows else ch.max_lsn(feed), information_schema=lambda s: sc.describe(info["at"]),
    )
    _without_errors([jb.incremental_sync(job)])
    info["at"] = late.select("k", "v", "note", "w")
    _without_errors([jb.incremental_sync(job)])
    info["at"] = late.select("k", F.col("v").cast("int"), "note", "w")
    refused = jb.incremental_sync(job, stop_on_error=False)
    if not (refused.error or "").startswith("SchemaRefused"):
        raise AssertionError(f"a narrowed column was to be refused: {refused}")
    return store.read("accounts").select("k", "v", "note", "w", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def schema_drift(spark, sf_dir):
    """Two states of a table's structure compared, a column per part: what each column became."""
    before = fx.information_schema(spark, sf_dir)
    return dr.drift(before, fx.later_information_schema(spark, sf_dir))


def idle_table(spark, sf_dir):
    """A table without changes, of whose log the beginning is gone: loaded once, then only its position moves."""
    store = Store(spark, fresh_dir(spark, "idle"), buckets=8)
    top, half = ch.max_lsn(fx.events_feed(spark, sf_dir)), _half(spark, sf_dir)
    reached = [half]
    job = jb.TableJob(
        "accounts", store, lambda s: fx.accounts(s, sf_dir), lambda s, p: fx.events_feed(s, sf_dir).limit(0), keys=["k"],
        position=lambda _: reached[-1], retained_from=lambda _: half,
    )
    done = [jb.initial_sync(job), jb.incremental_sync(job)]
    reached.append(top)
    done += [jb.incremental_sync(job), jb.incremental_sync(job)]
    shown = jb.metrics_table(spark, done).select("phase", "loaded", F.hex("watermark").alias("watermark"))
    return shown.unionByName(store.read("accounts").agg(F.count(F.lit(1)).alias("loaded")).select(
        F.lit("rows").alias("phase"), "loaded", F.lit(top.hex().upper()).alias("watermark")
    ))


def bad_positions(spark, sf_dir):
    """Changes without a proper position are set aside once, the others are replayed."""
    store = Store(spark, fresh_dir(spark, "displaced"), buckets=8)
    store.full_load("accounts", fx.accounts(spark, sf_dir).withColumn("n", F.lit(None).cast("long")), None, keys=["k"])
    job = jb.TableJob(
        "accounts", store, lambda s: fx.accounts(s, sf_dir), lambda s, p: fx.displaced_feed(s, sf_dir), keys=["k"],
        on_error="quarantine",
    )
    _without_errors([jb.incremental_sync(job), jb.incremental_sync(job)])
    rows = store.read("accounts").select(F.lit("row").alias("part"), "k", "v", "n", F.lit(None).cast("string").alias("reason"))
    aside = store.quarantined("accounts").select(F.lit("aside").alias("part"), "k", "v", "n", F.col(qr.REASON).alias("reason"))
    return rows.unionByName(aside)


def replay_quarantine(spark, sf_dir):
    """Views come with a value that is no number and are set aside; mended later, they count where nothing newer touched their key."""
    store = Store(spark, fresh_dir(spark, "repaired"), buckets=8)
    store.full_load("accounts", fx.accounts(spark, sf_dir), None, keys=["k"])
    half, feed = _half(spark, sf_dir), fx.unreadable_feed(spark, sf_dir)
    reached = [half]
    job = jb.TableJob(
        "accounts", store, lambda s: fx.accounts(s, sf_dir), lambda s, p: feed, keys=["k"], on_error="quarantine", position=lambda _: reached[-1]
    )
    _without_errors([jb.incremental_sync(job)])
    reached.append(ch.max_lsn(feed))
    _without_errors([jb.incremental_sync(job)])
    done = rp.replay_quarantine(job, lambda rows: rows.withColumn("v", F.regexp_replace("v", "^about ", "")))
    if done.remaining or not done.applied or not done.outdated or store.quarantined("accounts") is not None:
        raise AssertionError(f"unexpected outcome: {done}")
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def _landing(spark, sf_dir):
    """Accounts and the first half of their log as files; the rest can be landed later."""
    folder, feed, half = fresh_dir(spark, "landing"), fx.events_feed(spark, sf_dir), _half(spark, sf_dir)
    fx.accounts(spark, sf_dir).write.parquet(f"{folder}/accounts")
    log = f"{folder}/dbo_accounts_CT"
    ch.changes_since(feed, None, upto=half).write.parquet(log)
    return FileSource(folder), lambda: ch.changes_since(feed, half).write.mode("append").parquet(log)


def mapping_driven_sync(spark, sf_dir):
    """From a mapping document to a replicated table: load, then one cycle after more changes came."""
    source, more = _landing(spark, sf_dir)
    text = (
        '{"clients": {"__$last_sync": {}, "id": {"campoOrigem": "k", "tabelaOrigem": "accounts"}, '
        '"balance": {"campoOrigem": "v", "tabelaOrigem": "accounts"}}}'
    )
    mapping = mp.parse_mapping(spark.createDataFrame([(text,)], "value string"))
    store = Store(spark, fresh_dir(spark, "mapped"), buckets=8)
    jobs = jb.jobs_from_mapping(mapping, store, source, keys={"clients": ["id"]})
    jb.run_once(jobs, stop_on_error=True)
    more()
    _without_errors(jb.run_cycle(jobs))
    return store.read("clients").select("id", "balance", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def table_list_sync(spark, sf_dir):
    """The same from a list of tables, in mode strict, on a target created from the source's columns."""
    source, more = _landing(spark, sf_dir)
    tables = mp.parse_table_list(spark.createDataFrame([('{"tabelas": ["accounts"]}',)], "value string"))
    store = Store(spark, fresh_dir(spark, "listed"), buckets=8)
    store.create_if_absent("accounts", ACCOUNT)
    jobs = jb.jobs_from_tables(tables, store, source, mode="strict")
    jb.run_once(jobs, stop_on_error=True)
    more()
    _without_errors(jb.run_cycle(jobs))
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def _without_errors(done):
    failed = [m for m in done if m.error]
    if failed:
        raise AssertionError(f"failed: {failed}")


def cycle_metrics(spark, sf_dir):
    """Counts a replay reports; times differ per run and are left out."""
    store = Store(spark, fresh_dir(spark, "metrics"), buckets=8)
    job = _job(spark, sf_dir, store, "accounts", "upsert", fx.accounts)
    done = [jb.incremental_sync(job), jb.incremental_sync(job)]
    shown = jb.metrics_table(spark, done)
    return shown.select(
        "table_name", "phase", "inserts", "updates", "deletes", "ignored", "rejected",
        F.hex("watermark").alias("watermark"),
    )


def stream_apply(spark, sf_dir):
    """The log lands in two parts; a query is run, stopped and resumed on them."""
    store = Store(spark, fresh_dir(spark, "stream"), buckets=8)
    store.full_load("accounts", fx.accounts(spark, sf_dir), None, keys=["k"])
    feed, half = fx.events_feed(spark, sf_dir), _half(spark, sf_dir)
    landed, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "query")
    job = jb.TableJob("accounts", store, lambda s: fx.accounts(s, sf_dir), _events_since(sf_dir), keys=["k"])
    for part in (feed.where(F.col(LSN) <= F.lit(half)), feed.where(F.col(LSN) > F.lit(half))):
        part.write.mode("append").parquet(landed)
        stream = ch.stream_changes(spark, landed, feed.schema)
        query = run_stream(stream, job, checkpoint=checkpoint, trigger={"availableNow": True})
        query.awaitTermination()
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def stream_same_position(spark, sf_dir):
    """Transactions of ten changes each; one of them comes in two files, and so in two micro-batches."""
    feed = fx.transaction_feed(spark, sf_dir)
    top = feed.agg(F.max(F.col(SEQ))).first()[0]
    cut = top // 20 * 10 + 4
    store = _streamed(spark, sf_dir, feed, [F.col(SEQ) <= cut, F.col(SEQ) > cut], order_by=[LSN, SEQ])
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def stream_out_of_order(spark, sf_dir):
    """Transactions whose changes come in pieces, out of order: held until they are whole, none set aside."""
    store = Store(spark, fresh_dir(spark, "ordered"), buckets=8)
    store.full_load("accounts", fx.accounts(spark, sf_dir), None, keys=["k"])
    feed = written(fx.ended_feed(spark, sf_dir), "ended")
    landed, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "query")
    job = jb.TableJob(
        "accounts", store, lambda s: fx.accounts(s, sf_dir), _events_since(sf_dir), keys=["k"], order_by=[LSN, SEQ], on_error="quarantine"
    )
    moved = []
    for part in range(5):
        feed.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(landed)
        stream = ch.stream_changes(spark, landed, feed.drop("part").schema, max_files=1)
        run_transactions(stream, job, checkpoint=checkpoint, trigger={"availableNow": True}).awaitTermination()
        moved.append(store.current("accounts").position)
    if len(set(moved)) < 4:
        raise AssertionError(f"the position was to move with the parts: {moved}")
    aside = store.quarantined("accounts")
    n = 0 if aside is None else aside.count()
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"), F.lit(n).cast("long").alias("set_aside"))


def stream_quarantine(spark, sf_dir):
    """Rejected changes of every micro-batch are set aside with its commit."""
    feed, half = fx.keyless_feed(spark, sf_dir), _half(spark, sf_dir)
    store = _streamed(spark, sf_dir, feed, [F.col(LSN) <= F.lit(half), F.col(LSN) > F.lit(half)], on_error="quarantine")
    rows = store.read("accounts").select(F.lit("row").alias("part"), F.lit(None).cast("string").alias("lsn"), "k", "v")
    aside = store.quarantined("accounts").select(F.lit("aside").alias("part"), F.hex(F.col(LSN)).alias("lsn"), "k", "v")
    return rows.unionByName(aside)


class _Killed(RuntimeError):
    """What ends a query in the middle of its work."""


def stream_by_position(spark, sf_dir):
    """The log as a stream by position: a query dies after two micro-batches, more lands, and another goes on from its checkpoint."""
    store = Store(spark, fresh_dir(spark, "positions"), buckets=8)
    store.full_load("accounts", fx.accounts(spark, sf_dir), None, keys=["k"])
    feed, half = fx.events_feed(spark, sf_dir), _half(spark, sf_dir)
    job = jb.TableJob("accounts", store, lambda s: fx.accounts(s, sf_dir), _events_since(sf_dir), keys=["k"])
    landed, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "query")
    log, admitted = ls.file_log(spark, landed), feed.count() // 5 + 1
    seen = []

    def dies(done):
        seen.append(done)
        if len(seen) == 2:
            raise _Killed

    for part, watch in ((feed.where(F.col(LSN) <= F.lit(half)), dies), (feed.where(F.col(LSN) > F.lit(half)), seen.append)):
        part.repartition(3).write.mode("append").parquet(landed)
        stream = ls.position_stream(spark, log, feed.schema, checkpoint=checkpoint, admitted=admitted, per_task=admitted // 3 + 1)
        query = run_stream(stream, job, checkpoint=checkpoint, trigger={"processingTime": "0 seconds"}, on_batch=watch)
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            if watch is not dies:
                raise
        finally:
            query.stop()
    if len(seen) < 5:
        raise AssertionError(f"the log was to come in at least five micro-batches, not {len(seen)}")
    return store.read("accounts").select("k", "v", F.hex(F.col(f"`{SYNC}`")).alias("sync"))


def stream_metrics(spark, sf_dir):
    """What a listener reported of a stream's micro-batches: one per file here, three files."""
    store = Store(spark, fresh_dir(spark, "reported"), buckets=8)
    store.full_load("accounts", fx.accounts(spark, sf_dir), None, keys=["k"])
    feed, half = fx.raw_feed(spark, sf_dir).where("k IS NOT NULL"), _half(spark, sf_dir)
    feed = feed.where(F.octet_length(F.col(LSN)) == 10).withColumn("v", F.coalesce(F.col("v").try_cast("double"), F.lit(0.0)))
    landed, checkpoint, table = (fresh_dir(spark, name) for name in ("landed", "query", "stream-metrics"))
    job = jb.TableJob("accounts", store, lambda s: fx.accounts(s, sf_dir), _events_since(sf_dir), keys=["k"])
    listener = StreamMetrics(spark, table)
    spark.streams.addListener(listener)
    try:
        for part in (F.col(LSN) <= F.lit(half), F.col(LSN) > F.lit(half)):
            feed.where(part).coalesce(1).write.mode("append").parquet(landed)
            stream = ch.stream_changes(spark, landed, feed.schema, max_files=1)
            run_reported(stream, job, listener, checkpoint=checkpoint, trigger={"availableNow": True}).awaitTermination()
            _reported(listener, table, store.watermark("accounts"))
    finally:
        spark.streams.removeListener(listener)
    rows = spark.read.schema(jb.METRICS).parquet(table)
    return rows.select("table_name", "phase", "inserts", "updates", "deletes", "ignored", F.hex("watermark").alias("watermark"))


def _reported(listener, path, position, seconds=60):
    """Wait till the listener, which hears of a micro-batch a little later, has written a row of the position."""
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        listener.flush()
        if files.names_in(listener.spark, path):
            found = listener.spark.read.schema(jb.METRICS).parquet(path).where(F.col("watermark") == F.lit(position))
            if not found.isEmpty():
                return
        time.sleep(0.2)
    raise AssertionError("the listener did not report")


def _streamed(spark, sf_dir, feed, parts, **options) -> Store:
    """Accounts after a stream over files that land one part after the other."""
    store = Store(spark, fresh_dir(spark, "stream"), buckets=8)
    store.full_load("accounts", fx.accounts(spark, sf_dir), None, keys=["k"])
    landed, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "query")
    job = jb.TableJob("accounts", store, lambda s: fx.accounts(s, sf_dir), _events_since(sf_dir), keys=["k"], **options)
    for part in parts:
        feed.where(part).coalesce(1).write.mode("append").parquet(landed)
        stream = ch.stream_changes(spark, landed, feed.schema, max_files=1)
        run_stream(stream, job, checkpoint=checkpoint, trigger={"availableNow": True}).awaitTermination()
    return store


def _prepared(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not spark.conf.get("spark.checkpoint.dir", None):
            use_shared_dir(spark, SHARED_DIR)
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession, sf_dir: str = ENTRY_DIR) -> DataFrame:
    """Changes after a position, replayed on the target in log order."""
    return _prepared(apply_since)(spark, sf_dir)


def queries() -> dict[str, Query]:
    found = dict(_own_queries())
    if HAS_LLM:
        import corpus_pipeline
        from cdcspark.llm.queries import QUERIES

        found |= QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _prepared(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    found = dict(base_sql())
    if HAS_LLM:
        import corpus_pipeline
        from cdcspark.llm.queries import SQL

        found |= SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _own_queries() -> dict[str, Query]:
    return {
        "mapping_rows": mapping_rows,
        "mapping_source_tables": mapping_source_tables,
        "configuration_verdicts": configuration_verdicts,
        "table_list": table_list,
        "table_pairs": table_pairs,
        "type_translation": type_translation,
        "ensure_sync": ensure_sync,
        "created_table": created_table,
        "captured_columns": captured_columns,
        "snapshot_projection": snapshot_projection,
        "snapshot_all_columns": snapshot_all_columns,
        "split_ranges": split_ranges,
        "change_tables": change_tables,
        "capture_instances": capture_instances,
        "changes_since": changes_since,
        "empty_range": empty_range,
        "position_cast": position_cast,
        "changes_between": changes_between,
        "lsn_range": lsn_range,
        "last_sync": last_sync,
        "stamp_sync": stamp_sync,
        "apply_strict": _apply("strict"),
        "apply_upsert": _apply("upsert"),
        "apply_bag": _apply("bag", fx.quantities),
        "apply_since": apply_since,
        "apply_composite": apply_composite,
        "apply_mixed_types": apply_mixed_types,
        "insert_rows": insert_rows,
        "clear_and_reload": clear_and_reload,
        "new_watermark": new_watermark,
        "key_changes": key_changes,
        "quarantine_split": quarantine_split,
        "change_counts": change_counts,
        "change_report": change_report,
        "update_by_key": update_by_key,
        "delete_by_key": delete_by_key,
        "thin_rows": thin_rows,
        "thin_rows_random": thin_rows_random,
        "sample_one": sample_one,
        "stored_update": stored_update,
        "stored_delete": stored_delete,
        "net_changes": net_changes,
        "net_changes_without_key": net_changes_without_key,
        "capture_changes": capture_changes,
        "capture_then_apply": capture_then_apply,
        "capture_moves": capture_moves,
        "reconcile_status": reconcile_status,
        "reconcile_keys": reconcile_keys,
        "reconcile_ranges": reconcile_ranges,
        "reconcile_repeated_keys": reconcile_repeated_keys,
        "reconcile_whole_rows": reconcile_whole_rows,
        "reconcile_mixed_types": reconcile_mixed_types,
        "pair_status": pair_status,
        "full_load": full_load,
        "initial_sync": initial_sync,
        "chunked_initial_sync": chunked_initial_sync,
        "incremental_sync": incremental_sync,
        "multi_table_cycle": multi_table_cycle,
        "consistent_cycle": consistent_cycle,
        "deferred_replay": deferred_replay,
        "folded_replay": folded_replay,
        "mapping_driven_sync": mapping_driven_sync,
        "table_list_sync": table_list_sync,
        "cycle_metrics": cycle_metrics,
        "stream_apply": stream_apply,
        "stream_by_position": stream_by_position,
        "stream_same_position": stream_same_position,
        "stream_out_of_order": stream_out_of_order,
        "stream_metrics": stream_metrics,
        "stream_quarantine": stream_quarantine,
        "evolved_table": evolved_table,
        "schema_drift": schema_drift,
        "idle_table": idle_table,
        "bad_positions": bad_positions,
        "replay_quarantine": replay_quarantine,
    }
