"""Transforms of change feeds and comparisons of two tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark.functions.lsn import DELETE, INSERT, LSN, OP, SYNC, UPDATE, lsn_from_number, row_hash
from cdcspark.operators.apply import (
    _c,
    _checked,
    _disagree,
    _entry,
    _twin,
    data_columns,
    has_key,
    is_applied,
    order_columns,
    positioned,
)
MISSING, EXTRA, DIFFERENT, EQUAL = "missing", "extra", "different", "equal"


def change_counts(changes: DataFrame) -> DataFrame:
    """Number of changes per operation code."""
    return changes.groupBy(_c(OP).alias("operation")).agg(F.count(F.lit(1)).alias("changes"))


def change_report(feed: DataFrame) -> DataFrame:
    """One row about a range of changes: counts per operation, first and last position."""
    op = _c(OP)
    return feed.agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_if(op == INSERT).alias("inserts"),
        F.count_if(op == UPDATE).alias("updates"),
        F.count_if(op == DELETE).alias("deletes"),
        F.min(_c(LSN)).alias("min_lsn"),
        F.max(_c(LSN)).alias("max_lsn"),
    )


def net_changes(feed: DataFrame, keys: Sequence[str], *, order_by: Sequence[str] | None = None) -> DataFrame:
    """One change per key with the effect of all its changes.

    Insert … delete cancels out, insert … update is an insert of the last
    image, delete … insert is an update, anything else ends as its last change.
    Inserts with a null key concern no key and pass as they are.
    """
    order = order_columns(feed, order_by)
    columns = [c for c in feed.columns if c not in (OP, *order) and c not in keys]
    events = positioned(feed.where(is_applied() & has_key(keys)), keys, [*columns, *order], order)
    ends = events.groupBy(*[_c(k) for k in keys]).agg(
        F.min(_entry(OP)).alias("__first"),
        F.min(_twin()).alias("__first_twin"),
        F.max(_entry(OP, "__row")).alias("__last"),
        F.max(_twin()).alias("__last_twin"),
    )
    ends = ends.select(
        *[_c(k) for k in keys],
        _checked(F.col("__first"), _disagree("__first", "__first_twin"), "first change").alias("__first"),
        _checked(F.col("__last"), _disagree("__last", "__last_twin"), "last change").alias("__last"),
    )
    first, last = F.col("__first")[OP], F.col("__last")[OP]
    born = first == INSERT
    op = F.when(last == DELETE, DELETE).when(born, INSERT).otherwise(UPDATE)
    keyless = feed.where((_c(OP) == INSERT) & ~has_key(keys))
    net = ends.where(~(born & (last == DELETE))).select(
        op.alias(OP), *[F.col(f"__last.__row.`{c}`") for c in order if c != OP], *[_c(k) for k in keys],
        *[F.col(f"__last.__row.`{c}`") for c in columns],
    )
    return net.unionByName(keyless.select(*[_c(c) for c in net.columns]))


def _common(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables with each column in a type that holds the values of both sides.

    That is the wider one as Spark sees it (a whole number meets a fraction as a
    double); where one side is text, or no such type exists, the text forms
    are compared. Nothing is cast to a narrower type, so no value becomes null.
    """
    left, right = dict(source.dtypes), dict(target.dtypes)

    def kind(name: str) -> str | None:
        if left[name] == right[name]:
            return None
        if "string" in (left[name], right[name]):
            return "string"
        try:
            return source.select(_c(name)).limit(0).union(target.select(_c(name)).limit(0)).dtypes[0][1]
        except AnalysisException:
            return "string"

    kinds = {c: kind(c) for c in columns}

    def side(df: DataFrame) -> DataFrame:
        return df.select(*[_c(c).cast(kinds[c]).alias(c) if kinds[c] else _c(c) for c in columns])

    return side(source), side(target)


def _sides(source: DataFrame, target: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Both tables reduced to key, side and row hash; the target's hash counts negative.

    The hash is held in a decimal, so the sum over a group of any size fits.
    """

    def side(df: DataFrame, mark: int) -> DataFrame:
        weight = row_hash(list(columns)).cast("decimal(26,0)")
        return df.select(
            *[_c(k) for k in keys], F.lit(mark).alias("__side"), (weight if mark > 0 else -weight).alias("__weight")
        )

    source, target = _common(source, target, list(dict.fromkeys([*keys, *columns])))
    return side(source, 1).unionByName(side(target, -1))


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] | None = None,
    *,
    columns: Sequence[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Compare two tables key by key: rows per side and a status.

    ``missing`` in the target, ``extra`` in the target, ``different`` or
    ``equal``. Repeated keys are compared as a group, without pairing their
    rows. Only the key, two counts and the sum of 64-bit row hashes are
    shuffled, summed in the map tasks first, so the cost does not grow with
    row width or with the size of a group. Without ``keys`` whole rows are
    compared. Where a column's types differ, values are compared in a type that
    holds both. ``prefix`` goes before the names of the three added columns.
    """
    columns = list(columns or data_columns(source))
    keys = list(keys) if keys else columns
    source_rows, target_rows, status = (prefix + n for n in ("source_rows", "target_rows", "status"))
    if {source_rows, target_rows, status} & set(keys):
        raise ValueError("a compared column has the name of an added one; give a prefix")
    compared = [c for c in columns if c not in keys] or keys
    both = _sides(source, target, compared, keys)
    side = F.col("__side")
    sums = both.groupBy(*[_c(k) for k in keys]).agg(
        F.count_if(side == 1).alias(source_rows),
        F.count_if(side == -1).alias(target_rows),
        F.sum("__weight").alias("__balance"),
    )
    verdict = (
        F.when(_c(target_rows) == 0, MISSING)
        .when(_c(source_rows) == 0, EXTRA)
        .when((_c(source_rows) == _c(target_rows)) & (F.col("__balance") == 0), EQUAL)
        .otherwise(DIFFERENT)
    )
    return sums.select(*[_c(k) for k in keys], _c(source_rows), _c(target_rows), verdict.alias(status))


def reconcile_counts(compared: DataFrame, *, prefix: str = "") -> DataFrame:
    """Keys and rows per status of a ``reconcile`` result."""
    return compared.groupBy(_c(prefix + "status").alias("status")).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(_c(prefix + "source_rows")).alias("source_rows"),
        F.sum(_c(prefix + "target_rows")).alias("target_rows"),
    )


def capture_changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], *, batch: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """Changes that lead from one snapshot to the next, as a feed.

    The snapshots are compared by hash first (see ``reconcile``), then full rows
    are taken for the changed keys only. Keys must be unique in both
    snapshots. All changes carry position ``batch``. Nothing runs before the
    result is used.
    """
    keys = list(keys)
    columns = list(columns or data_columns(after))
    compared = reconcile(before, after, keys, columns=columns, prefix="__")
    status = F.col("__status")
    repeated = (F.col("__source_rows") > 1) | (F.col("__target_rows") > 1)
    unique = F.when(repeated, F.raise_error("the key is not unique in a snapshot")).otherwise(status)
    op = F.when(status == MISSING, DELETE).when(status == EXTRA, INSERT).otherwise(UPDATE)
    changed = compared.withColumn("__status", unique).where(status != EQUAL).select(
        *[_c(k).alias(f"__key_{i}") for i, k in enumerate(keys)], op.alias(OP)
    )

    def rows(df: DataFrame, is_after: bool) -> DataFrame:
        types = dict(after.dtypes)
        picked = [_c(c).cast(types[c]).alias(c) if dict(df.dtypes)[c] != types[c] else _c(c) for c in columns]
        return df.select(*picked, F.lit(is_after).alias("__after"))

    # A delete takes the row from before, the others the row from after: one join serves both.
    both = rows(after, True).unionByName(rows(before, False))
    body = both.join(changed, _on(keys) & (F.col("__after") == (_c(OP) != DELETE)), "inner")
    return body.select(_c(OP), lsn_from_number(F.lit(batch)).alias(LSN), *[_c(c) for c in columns])


def _on(keys: Sequence[str]) -> Column:
    match = _c(keys[0]).eqNullSafe(F.col("__key_0"))
    for i, k in enumerate(keys[1:], 1):
        match = match & _c(k).eqNullSafe(F.col(f"__key_{i}"))
    return match


def pair_status(
    spark: SparkSession,
    pairs: Sequence[tuple[str, str]] | DataFrame,
    *,
    read: Callable[[SparkSession, str], DataFrame] | None = None,
) -> DataFrame:
    """For each configured (source, target) pair and side: does it exist, how many rows.

    ``read`` opens a table by name and defaults to ``spark.table``; a name it
    cannot open, whatever the reason, is reported as absent. ``pairs`` come from
    ``parse_pairs`` or a list.
    """
    read = read or (lambda session, name: session.table(name))
    if isinstance(pairs, DataFrame):
        pairs = [(r["source_name"], r["target_name"]) for r in pairs.orderBy("pos").collect()]
    schema = "pair int, side string, table_name string, present boolean, n_rows bigint"
    parts = []
    for i, pair in enumerate(pairs):
        for side, name in zip(("source", "target"), pair):
            try:
                counted = read(spark, name).agg(F.count(F.lit(1)).alias("n_rows"))
            except (AnalysisException, Py4JError, OSError):
                counted = spark.range(1).select(F.lit(None).cast("bigint").alias("n_rows"))
            parts.append(
                counted.select(
                    F.lit(i).alias("pair"), F.lit(side).alias("side"), F.lit(name).alias("table_name"),
                    F.col("n_rows").isNotNull().alias("present"), "n_rows",
                )
            )
    if not parts:
        return spark.createDataFrame([], schema)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def stamped(df: DataFrame, position: Column) -> DataFrame:
    """All rows with one sync position, the last column."""
    return df.select(*[_c(c) for c in data_columns(df)], position.cast("binary").alias(SYNC))
