"""Changes to single rows by key, and random thinning."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcspark.operators.apply import _c


def key_match(key: Mapping[str, Any]) -> Column:
    """All key columns equal; a null on either side matches nothing."""
    if not key:
        raise ValueError("a key needs at least one column")
    match = F.lit(True)
    for name, value in key.items():
        match = match & (_c(name) == F.lit(value))
    return F.coalesce(match, F.lit(False))


def update_by_key(df: DataFrame, key: Mapping[str, Any], values: Mapping[str, Any]) -> DataFrame:
    """Set fields of the rows with the given (composite) key."""
    types = dict(df.dtypes)
    unknown = set(values) - set(types)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    hit = key_match(key)
    return df.select(
        *[
            F.when(hit, F.lit(values[c]).cast(types[c])).otherwise(_c(c)).alias(c) if c in values else _c(c)
            for c in df.columns
        ]
    )


def delete_by_key(df: DataFrame, key: Mapping[str, Any]) -> DataFrame:
    return df.where(~key_match(key))


def thin_rows(df: DataFrame, percent: float, *, seed: int | None = None, by: str | None = None) -> DataFrame:
    """Delete each row with a probability of ``percent``.

    With ``by``, a column of any type, the draw is a fixed function of its text
    form, so the same rows go on every run and after a lost task; null counts
    as empty text.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent lies between 0 and 100")
    if by is not None:
        digits = F.substring(F.md5(F.coalesce(_c(by).cast("string"), F.lit("")).cast("binary")), 1, 12)
        draw = F.conv(digits, 16, 10).cast("double") / F.lit(float(16**12))
        return df.where(draw >= percent / 100.0)
    return df.where(F.rand(seed) >= percent / 100.0)


def sample_one(df: DataFrame, *, seed: int | None = None) -> DataFrame:
    """One random row: each task keeps its best draw, one small merge follows."""
    return df.orderBy(F.rand(seed)).limit(1)
