"""Hot keys: find them cheaply and keep them out of shuffles.

A key that holds a large share of the rows would put that share into one
shuffle task. Joins that look up one row per key therefore split such keys off:
their few lookup rows are broadcast (their number is bounded by construction)
and the hot rows are not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of the rows, so there are at most 1 / HOT_SHARE
# of them; below HOT_ROWS rows one task handles a key with ease.
HOT_SHARE = 0.001
HOT_ROWS = 2_000_000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hot_keys(
    df: DataFrame, keys: Sequence[str], *, share: float | None = None, min_rows: int | None = None
) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows.

    One pass over the key columns into a frequent-items sketch; tasks merge
    sketches of fixed size, no rows are shuffled. It runs when this function is
    called. The answer only steers the join, it never changes a result:
    both ways need the two sides' keys in one type (see ``to_types``).
    """
    share, min_rows = share or HOT_SHARE, HOT_ROWS if min_rows is None else min_rows
    most = int(1 / share)
    sketch = F.call_function("approx_top_k", key_hash(keys), F.lit(most), F.lit(max(10_000, 10 * most)))
    found = df.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    floor = max(min_rows, found["n"] * share)
    return [item["item"] for item in found["top"] or [] if item["count"] > floor]


def lookup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot: Sequence[int] = ()
) -> DataFrame:
    """Join with a ``right`` that has at most one row per key.

    Without hot keys this is a plain join and the planner picks the strategy.
    With hot keys the rows are split by key: cold ones join as usual, hot ones
    meet a broadcast in place. It holds at most ``len(hot)`` rows, 1,000 at the
    default share, each as wide as a row of ``right``.
    """
    on = list(keys)
    if not hot:
        return left.join(right, on, how)
    is_hot = key_hash(keys).isin(*hot)
    cold = left.where(~is_hot).join(right.where(~is_hot), on, how)
    warm = left.where(is_hot).join(F.broadcast(right.where(is_hot)), on, how)
    return cold.unionByName(warm)
