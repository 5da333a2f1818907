"""Sharding by best-fit-decreasing bin packing of indivisible groups.

A group is all documents with one text. Its bytes are summed with partial aggregates, so a text with a third of all rows is
one row per task. Groups above a small share of a shard are packed one by one; their number is bounded by that share, so
they may visit the driver. All smaller groups are hashed into parcels, a bounded number too, and a parcel is packed like
a group. Best fit uses a balanced tree of the bins' free room.

Documents are never shuffled with their texts: each finds its shard by a lookup in the bounded table of units.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import text_bytes
from cdcspark.session import written

SHARDS = 16

#: Parcels per shard that small groups are hashed into; a group larger than a shard's ``1 / OWN_SHARE`` is a unit of its own.
PARCELS, OWN_SHARE = 1024, 1024

#: Documents numbered by one task.
SLICE_ROWS = 50_000


@dataclass
class _Node:
    """A node of a tree balanced by heights, ordered by (free room, bin)."""

    key: tuple[int, int]
    left: _Node | None = None
    right: _Node | None = None
    height: int = field(default=1)


def _height(node: _Node | None) -> int:
    return node.height if node else 0


def _lifted(node: _Node, side: str, other: str) -> _Node:
    """The child on ``side`` becomes the root."""
    child = getattr(node, side)
    setattr(node, side, getattr(child, other))
    setattr(child, other, node)
    node.height = 1 + max(_height(node.left), _height(node.right))
    child.height = 1 + max(_height(child.left), _height(child.right))
    return child


def _balanced(node: _Node) -> _Node:
    node.height = 1 + max(_height(node.left), _height(node.right))
    for side, other in (("left", "right"), ("right", "left")):
        child = getattr(node, side)
        if _height(child) > _height(getattr(node, other)) + 1:
            if _height(getattr(child, other)) > _height(getattr(child, side)):
                setattr(node, side, _lifted(child, other, side))
            return _lifted(node, side, other)
    return node


def _with(node: _Node | None, key: tuple[int, int]) -> _Node:
    if node is None:
        return _Node(key)
    if key < node.key:
        node.left = _with(node.left, key)
    else:
        node.right = _with(node.right, key)
    return _balanced(node)


def _without(node: _Node, key: tuple[int, int]) -> _Node | None:
    if key < node.key:
        node.left = _without(node.left, key)
    elif key > node.key:
        node.right = _without(node.right, key)
    elif node.left is None or node.right is None:
        return node.left or node.right
    else:
        least = node.right
        while least.left:
            least = least.left
        node.key = least.key
        node.right = _without(node.right, least.key)
    return _balanced(node)


def _tightest(node: _Node | None, size: int) -> tuple[int, int] | None:
    """The least free room that takes ``size``."""
    found = None
    while node:
        if node.key[0] >= size:
            found, node = node.key, node.left
        else:
            node = node.right
    return found


def _roomiest(node: _Node) -> tuple[int, int]:
    while node.right:
        node = node.right
    return node.key


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size; a size over the capacity has a bin of its own. Bins are numbered as they are opened."""
    tree: _Node | None = None
    bins, opened = [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = _tightest(tree, sizes[i])
        if found is None:
            room, own = capacity, opened
            opened += 1
        else:
            room, own = found
            tree = _without(tree, found)
        bins[i] = own
        if room > sizes[i]:
            tree = _with(tree, (room - sizes[i], own))
    return bins


def near_equal(sizes: list[int], shards: int) -> list[int]:
    """Best fit decreasing into ``shards`` bins whose capacity is an equal share, so that all come out nearly as large.

    A size above the share of what is left has a bin alone, and the others share the rest. A size that no bin takes any more
    goes to the roomiest one; sizes come in falling order, so these are the smallest.
    """
    bins = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    total, first, alone = sum(sizes), 0, 0
    while first < len(order) and alone < shards - 1 and sizes[order[first]] * (shards - alone) >= total:
        bins[order[first]] = alone
        total -= sizes[order[first]]
        first, alone = first + 1, alone + 1
    share = -(-total // (shards - alone))
    tree: _Node | None = None
    for b in range(alone, shards):
        tree = _with(tree, (share, b))
    for i in order[first:]:
        room, b = found = _tightest(tree, sizes[i]) or _roomiest(tree)
        bins[i] = b
        tree = _with(_without(tree, found), (room - sizes[i], b))
    return bins


def _fingerprint(raw: Column) -> Column:
    return F.xxhash64(raw, F.octet_length(raw))


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document's shard and place, so that shards hold nearly equal bytes and equal texts stay together.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law ("bytes"), shard, slot (gapless from 0 in
    each shard, by doc_id) and grown_shard (null). Null text counts as empty, and such rows form one group; null ids come
    first in a shard; repeated rows have a slot each; an empty table gives an empty one. A group above an equal share
    stays whole and fills a shard alone, the other shards are even among themselves.
    """
    spark = documents.sparkSession
    raw = text_bytes()
    rows = documents.select(
        F.col("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        _fingerprint(raw).alias("_group"),
    )
    rows = written(rows, "shard-rows")
    groups = rows.groupBy("_group").agg(F.sum("size").alias("bytes"))
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    bar = max(1, (total or 0) // (shards * OWN_SHARE))
    parcels = shards * PARCELS
    parcel = F.pmod(F.xxhash64("_group"), F.lit(parcels))
    large = groups.where(F.col("bytes") >= bar).select(F.col("_group").alias("unit"), "bytes", F.lit(True).alias("own"))
    # Small ones by parcel: no more rows than parcels, whatever the number of groups.
    little = groups.where(F.col("bytes") < bar).groupBy(parcel.alias("unit")).agg(F.sum("bytes").alias("bytes"))
    units = large.unionByName(little.withColumn("own", F.lit(False))).orderBy("own", "unit").collect()
    bins = near_equal([u["bytes"] for u in units], shards)
    placed = [(u["unit"], u["own"], b) for u, b in zip(units, bins, strict=True)]
    table = F.broadcast(spark.createDataFrame(placed, "unit long, own boolean, shard int"))
    alone = table.where("own").select(F.col("unit").alias("_group"), F.col("shard").alias("_alone"))
    in_parcel = table.where("not own").select(F.col("unit").alias("_parcel"), F.col("shard").alias("_shared"))
    found = rows.join(F.broadcast(alone), "_group", "left").withColumn("_parcel", parcel)
    found = found.join(F.broadcast(in_parcel), "_parcel", "left")
    found = found.select("doc_id", "size", "text_crc32", F.coalesce("_alone", "_shared").alias("shard"))
    return numbered(found, count).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def numbered(rows: DataFrame, count: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``rows`` (with doc_id and shard) with slot: places in each shard, gapless from 0.

    Rows are dealt into slices in turn, each slice of a shard is numbered by itself from where the slices before
    it end, so no task sorts more than about ``slice_rows`` rows.
    """
    slices = max(1, -(-count // slice_rows))
    dealt = rows.withColumn("_slice", F.pmod(F.monotonically_increasing_id(), F.lit(slices)).cast("int"))
    held = written(dealt, "shard-places")
    counts = held.groupBy("shard", "_slice").count()
    ends = counts.select(
        "shard", "_slice", (F.expr("sum(count) OVER (PARTITION BY shard ORDER BY _slice)") - F.col("count")).alias("_before")
    )
    place = F.expr("row_number() OVER (PARTITION BY shard, _slice ORDER BY doc_id, text_crc32, size)")
    return held.join(ends, ["shard", "_slice"]).withColumn("slot", (place - 1 + F.col("_before")).cast("long")).drop("_slice", "_before")
