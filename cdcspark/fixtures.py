"""Change feeds, configuration texts and second snapshots derived from the test tables.

Everything here is a projection of whole tables, so its size follows theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark.functions.lsn import DELETE, END, INSERT, LSN, OP, SEQ, TX_CHANGES, TX_PREVIOUS, UPDATE, lsn_from_number
from cdcspark.operators.apply import apply_changes
from cdcspark.plans.mapping import SOURCE_COLUMN_FIELD, SOURCE_TABLE_FIELD, TABLE_LIST_FIELD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def operation(event_type="event_type"):
    return F.when(F.col(event_type) == "signup", INSERT).when(F.col(event_type) == "error", DELETE).otherwise(UPDATE)


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a change of account ``user_id * 20``; half of these are no customers yet."""
    return table(spark, sf_dir, "events").select(
        operation().alias(OP),
        lsn_from_number(F.col("event_id") + 1).alias(LSN),
        (F.col("user_id") * 20).alias("k"),
        F.col("value").alias("v"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))


def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows per key, as in a table without a unique key."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("v"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed with text values, some of them unusable: views carry JSON, clicks a short position."""
    number = F.col("event_id") + 1
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "purchase", 7).otherwise(operation()).alias(OP),
        F.when(F.col("event_type") == "click", F.unhex(F.hex(number))).otherwise(lsn_from_number(number)).alias(LSN),
        F.when(F.col("props") != '{"k": 1}', F.col("user_id")).alias("k"),
        F.when(F.col("event_type") == "view", F.col("props")).otherwise(F.col("value").cast("string")).alias("v"),
    )


def later_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers after some time: one segment left, another doubled, some balances changed."""
    now = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    changed = now.withColumn(
        "c_acctbal", F.when(F.col("c_nationkey") < 5, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    )
    joined = now.where(F.col("c_mktsegment") == "MACHINERY").withColumn("c_custkey", -F.col("c_custkey") - 1)
    return changed.unionByName(joined)


def moved_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers after some time: one segment has other keys, another left in part, some came with the content of some that left."""
    now = table(spark, sf_dir, "customer")
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    stay = now.where(~segment.isin("MACHINERY", "BUILDING") | ((segment == "BUILDING") & (key % 3 == 0)))
    stay = stay.withColumn("c_nationkey", F.when((segment == "AUTOMOBILE") & (key % 5 == 0), F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")))
    moved = now.where(segment == "MACHINERY").withColumn("c_custkey", -key - 1)
    new = now.where((segment == "BUILDING") & (key % 2 == 0)).withColumn("c_custkey", key + 10_000_000)
    return stay.unionByName(moved).unionByName(new)


def lagging_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that misses urgent orders, has some never deleted and some outdated."""
    now = table(spark, sf_dir, "orders")
    behind = now.where(F.col("o_orderpriority") != "1-URGENT").withColumn(
        "o_orderstatus", F.when(F.col("o_totalprice") > 400000, "O").otherwise(F.col("o_orderstatus"))
    )
    stale = now.where(F.col("o_orderpriority") == "5-LOW").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return behind.unionByName(stale)


def nearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, but for some in one small stretch of keys that are missing, outdated or not deleted."""
    now = table(spark, sf_dir, "orders")
    top = now.agg(F.max("o_orderkey")).first()[0]
    here = F.col("o_orderkey").between(top // 3, top // 3 + top // 100)
    stale = now.where(here & (F.col("o_orderpriority") == "5-LOW"))
    behind = now.where(~here | (F.col("o_orderpriority") != "1-URGENT")).withColumn(
        "o_orderstatus", F.when(here & (F.col("o_orderpriority") == "2-HIGH"), "?").otherwise(F.col("o_orderstatus"))
    )
    # A second row of the same key.
    return behind.unionByName(stale)


def lagging_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = table(spark, sf_dir, "lineitem")
    return now.where(F.col("l_tax") != 0.08).withColumn(
        "l_quantity", F.when(F.col("l_discount") == 0.1, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )


def mapping_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mapping document per customer: three columns, the empty sync entry first."""
    origin = (
        f'{{"{SOURCE_COLUMN_FIELD}": "%s", "{SOURCE_TABLE_FIELD}": "src_%s"}}'
    )
    entries = '"__$last_sync": {}, "id": ' + origin + ', "balance": ' + origin + ', "label": ' + origin
    text = F.format_string(
        '{"tgt_%s": {' + entries + "}}",
        F.col("c_custkey").cast("string"),
        F.lit("c_custkey"), F.col("c_mktsegment"),
        F.lit("c_acctbal"), F.col("c_mktsegment"),
        F.col("c_name"), F.col("c_mktsegment"),
    )
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), text.alias("value"))


def table_list_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table list per part; documents of small parts lack the list."""
    name = F.when(F.col("p_size") > 5, TABLE_LIST_FIELD).otherwise("other")
    text = F.format_string('{"%s": ["%s", "t_%s"]}', name, F.col("p_type"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc"), text.alias("value"))


def pair_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("src_"), F.col("o_orderkey").cast("string"), F.lit(",dst_"), F.col("o_orderstatus"),
                    F.lit(";"), F.col("o_orderpriority"), F.lit(",copy"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), text.alias("value"))


def information_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column description per part."""
    size = F.col("p_size")
    kind = (
        F.when(size < 5, "varchar").when(size < 10, "nchar").when(size < 15, "decimal").when(size < 20, "datetime")
        .when(size < 25, "bit").when(size < 30, "BigInt").when(size < 35, "float").when(size < 38, "date")
        .when(size < 40, "money").when(size < 42, "uniqueidentifier").when(size < 43, "datetimeoffset")
        .when(size < 44, "image").when(size < 45, "time").when(size < 47, "xml").otherwise("geometry")
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("COLUMN_NAME"),
        kind.alias("DATA_TYPE"),
        F.when(size < 3, -1).when(size < 7, size * 10).cast("int").alias("CHARACTER_MAXIMUM_LENGTH"),
        F.when(F.col("p_type") == "ECONOMY", "NO").otherwise("YES").alias("IS_NULLABLE"),
        F.when(size == 12, 18).cast("int").alias("NUMERIC_PRECISION"),
        F.when(size == 12, 4).cast("int").alias("NUMERIC_SCALE"),
    )


def later_information_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column descriptions after some time: some gone, some new, some of other types, some that refuse nulls now."""
    info, kind = information_schema(spark, sf_dir), F.lower(F.col("DATA_TYPE"))
    number = F.regexp_extract("COLUMN_NAME", r"(\d+)", 1).cast("long")
    now = (
        F.when(kind == "decimal", "numeric").when(kind == "bigint", F.when(number % 2 == 0, "decimal").otherwise("int"))
        .when(kind == "date", F.when(number % 2 == 0, "datetime2").otherwise("int")).when(kind == "float", F.when(number % 2 == 0, "real").otherwise("varchar"))
        .when(kind == "image", "varchar").otherwise(F.col("DATA_TYPE"))
    )
    changed = info.where(number % 7 != 0).select(
        "COLUMN_NAME", now.alias("DATA_TYPE"), "CHARACTER_MAXIMUM_LENGTH",
        F.when(number % 5 == 0, "NO").when(number % 5 == 1, "YES").otherwise(F.col("IS_NULLABLE")).alias("IS_NULLABLE"),
        F.when(kind == "bigint", F.when(number % 4 == 0, 22).otherwise(20)).otherwise(F.col("NUMERIC_PRECISION") + F.when(number % 2 == 0, 1).otherwise(0))
        .cast("int").alias("NUMERIC_PRECISION"),
        F.when(kind == "bigint", 3).otherwise(F.col("NUMERIC_SCALE") + 1).cast("int").alias("NUMERIC_SCALE"),
    )
    new = info.where(number % 7 == 0).withColumn("COLUMN_NAME", F.concat(F.lit("x"), "COLUMN_NAME"))
    return changed.unionByName(new)


def keyless_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' feed, some changes without a key."""
    events = table(spark, sf_dir, "events")
    return events.select(
        operation().alias(OP), lsn_from_number(F.col("event_id") + 1).alias(LSN),
        F.when(F.col("props") != '{"k": 1}', F.col("user_id") * 20).alias("k"), F.col("value").alias("v"),
    )


def unreadable_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' feed with values as text, those of views in words."""
    value = F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        operation().alias(OP), lsn_from_number(F.col("event_id") + 1).alias(LSN), (F.col("user_id") * 20).alias("k"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("about "), value)).otherwise(value).alias("v"),
    )


def displaced_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' feed; clicks have no position, views one of two bytes."""
    number = F.col("event_id") + 1
    position = F.when(F.col("event_type") == "view", F.unhex(F.lit("00FF"))).when(
        F.col("event_type") != "click", lsn_from_number(number)
    )
    return table(spark, sf_dir, "events").select(
        operation().alias(OP), position.alias(LSN), (F.col("user_id") * 20).alias("k"), F.col("value").alias("v"), number.alias("n")
    )


def transaction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' feed in transactions of ten changes, told apart by the sequence column."""
    return table(spark, sf_dir, "events").select(
        operation().alias(OP), lsn_from_number(F.floor(F.col("event_id") / 10) + 1).alias(LSN), F.col("event_id").alias(SEQ),
        (F.col("user_id") * 20).alias("k"), F.col("value").alias("v"),
    )


class GrowingSource:
    """A table and its log, both further on at every look: the table shows the log up to the position it has reached.

    ``progress`` tells which part of a load is at work; the log moves ``STEPS`` times in each and then waits for the next.
    """

    STEPS, PARTS = 5, 3

    def __init__(self, spark: SparkSession, sf_dir: str, target: Callable, mode: str, progress: Callable):
        self.rows, self.feed, self.mode, self.progress = target(spark, sf_dir), events_feed(spark, sf_dir), mode, progress
        self.top = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] + 1
        self.looks: dict[int, int] = {}
        self.ticks = 0

    def _reached(self) -> bytes:
        number = min(self.top * self.ticks // (self.STEPS * self.PARTS + 2), self.top)
        return number.to_bytes(10, "big")

    def _look(self) -> None:
        state = self.progress()
        part = state.done if state else -1
        self.looks[part] = self.looks.get(part, 0) + 1
        if part < 0 or self.looks[part] <= self.STEPS:
            self.ticks += 1

    def land_all(self) -> None:
        self.ticks = self.top

    def position(self, spark: SparkSession) -> bytes:
        self._look()
        return self._reached()

    def snapshot(self, spark: SparkSession) -> DataFrame:
        self._look()
        landed = self.feed.where(F.col(LSN) <= F.lit(self._reached()))
        return apply_changes(self.rows, landed, keys=["k"], mode=self.mode, hot=())

    def changes(self, spark: SparkSession, position: bytes) -> DataFrame:
        return self.feed.where(F.col(LSN) <= F.lit(self._reached()))


def ended_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in transactions with a row that ends each, and the part (0 to 4) each row arrives in.

    Half of a transaction's rows, its end among them or not, come one part later than the other half, so in every part but the first there are
    changes below positions that came before.
    """
    feed = transaction_feed(spark, sf_dir)
    top = feed.agg(F.max(F.col(SEQ))).first()[0] // 10 + 1
    number = F.floor(F.col("event_id") / 10) + 1
    sizes = table(spark, sf_dir, "events").groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias(TX_CHANGES))
    ends = sizes.select(
        F.lit(END).alias(OP), lsn_from_number(F.col("number")).alias(LSN), F.lit(None).cast("long").alias(SEQ), F.lit(None).cast("long").alias("k"),
        F.lit(None).cast("double").alias("v"), F.col(TX_CHANGES), lsn_from_number(F.col("number") - 1).alias(TX_PREVIOUS),
    )
    both = feed.select("*", F.lit(None).cast("long").alias(TX_CHANGES), F.lit(None).cast("binary").alias(TX_PREVIOUS)).unionByName(ends)
    at = F.conv(F.hex(F.col(LSN)), 16, 10).cast("long")
    late = F.pmod(F.xxhash64(F.col(LSN), F.coalesce(F.col(SEQ), F.lit(-1))), F.lit(2))
    return both.withColumn("part", F.least(F.floor(at * 4 / (top + 1)) + late, F.lit(4)).cast("int"))


def configuration_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer a mapping, a table list and a text of pairs, many of them not in order."""
    n, key = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    good = f'{{"{SOURCE_COLUMN_FIELD}": "c", "{SOURCE_TABLE_FIELD}": "a"}}'
    other = f'{{"{SOURCE_COLUMN_FIELD}": "c", "{SOURCE_TABLE_FIELD}": "b"}}'
    mapping = (
        F.when(n < 4, F.lit("{ not json")).when(n < 8, F.lit("{}")).when(n < 12, F.concat(F.lit('{"t'), key, F.lit('": {"__$last_sync": {}}}')))
        .when(n < 16, F.concat(F.lit('{"t'), key, F.lit(f'": {{"x": {{}}, "y": {good}}}}}')))
        .when(n < 20, F.concat(F.lit('{"t'), key, F.lit(f'": {{"x": {other}, "y": {good}}}}}')))
        .otherwise(F.concat(F.lit('{"t'), key, F.lit(f'": {{"__$last_sync": {{}}, "y": {good}}}}}')))
    )
    tables = (
        F.when(n < 4, F.lit("[1")).when(n < 8, F.lit('{"other": []}')).when(n < 12, F.lit(f'{{"{TABLE_LIST_FIELD}": []}}'))
        .when(n < 16, F.lit(f'{{"{TABLE_LIST_FIELD}": ["a", " "]}}')).otherwise(F.concat(F.lit(f'{{"{TABLE_LIST_FIELD}": ["t'), key, F.lit('"]}')))
    )
    pairs = F.when(n < 5, F.lit(" ")).when(n < 10, F.lit("a,b;c")).when(n < 15, F.lit("a,")).otherwise(F.concat(key, F.lit(",b;")))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc"), mapping.alias("mapping"), tables.alias("tables"), pairs.alias("pairs")
    )


def retyped_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same rows with other types on each side; some values differ by what a cast would lose."""
    rows = table(spark, sf_dir, "customer")
    source = rows.select(
        F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("int").alias("a"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("int")).alias("b"),
    )
    target = rows.select(
        F.col("c_custkey").cast("string").alias("k"),
        (F.col("c_nationkey") + F.when(F.col("c_nationkey") < 5, 0.5).otherwise(0.0)).cast("double").alias("a"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("string")).otherwise("abc").alias("b"),
    )
    return source, target
