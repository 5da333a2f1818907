"""Near-duplicate vectors by an inverted file with product-quantised residuals and exact cosine rerank.

Equal vectors are one class. Coarse centroids and sub-space codebooks are fitted on a bounded sample of the classes; every class
is then put into its nearest list and kept as a code of its residual, with the exact error of that code. Every class also
probes the ``PROBES`` nearest lists. In a list, distances come from lookup tables of the query's residual; the
stored error makes them a lower bound, so no pair in a probed list is lost. What is left is confirmed by cosine in
double precision.

Two vectors close together have nearly the same order of centroids, so a pair is missed only if neither probes the
other's list. Lists are cut into blocks of bounded size, and a task compares one block of queries with one of a list. It
gives link counts per class and a spanning forest of the links it saw, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import bounded_batches
from cdcspark.llm.components import components
from cdcspark.session import written

COSINE = 0.95

#: Vectors the index is fitted on; vectors of a list on average; most lists; lists a query probes.
SAMPLE, PER_LIST, MOST_LISTS, PROBES = 16_384, 256, 4_096, 12

#: Sub-spaces of a code and codewords of each.
SUBSPACES, CODEWORDS = 8, 256

#: Rows of a block of a list, and of a block of its queries.
BLOCK_ROWS = 2_048


@dataclass
class Index:
    """Coarse centroids and, per sub-space (its dimensions), the codewords of residuals."""

    coarse: np.ndarray
    dims: list[np.ndarray]
    words: list[np.ndarray]

    def nearest(self, unit: np.ndarray, k: int) -> np.ndarray:
        """The k nearest lists of each row, nearest first; ties go to the lower list."""
        far = _square(unit, self.coarse)
        k = min(k, len(self.coarse))
        some = np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1)
        order = np.argsort(np.take_along_axis(far, some, axis=1), axis=1, kind="stable")
        return np.take_along_axis(some, order, axis=1)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance of each residual from what its code stands for."""
        codes = np.empty((len(residual), len(self.dims)), np.uint8)
        off = np.zeros(len(residual))
        for s, (dims, words) in enumerate(zip(self.dims, self.words, strict=True)):
            far = _square(residual[:, dims], words)
            codes[:, s] = far.argmin(axis=1)
            off += ((residual[:, dims] - words[codes[:, s]]) ** 2).sum(axis=1)
        return codes, np.sqrt(off)

    def table_distances(self, residual: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of query residuals from coded ones, one lookup per sub-space."""
        out = np.zeros((len(residual), len(codes)))
        for s, (dims, words) in enumerate(zip(self.dims, self.words, strict=True)):
            out += _square(residual[:, dims], words)[:, codes[:, s]]
        return out


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1), 0)


def _means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means; starts from rows spread evenly over the sample, which is in the order of a hash."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = np.concatenate([_square(x[i : i + 4096], centres).argmin(axis=1) for i in range(0, len(x), 4096)])
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        used = count > 0
        centres[used] = total[used] / count[used, None]
    return centres


def fit(unit: np.ndarray, lists: int) -> Index:
    """An index of unit vectors."""
    coarse = _means(unit, lists)
    own = np.concatenate([_square(unit[i : i + 4096], coarse).argmin(axis=1) for i in range(0, len(unit), 4096)])
    residual = unit - coarse[own]
    dims = [d for d in np.array_split(np.arange(unit.shape[1]), min(SUBSPACES, unit.shape[1]))]
    return Index(coarse, dims, [_means(residual[:, d], CODEWORDS) for d in dims])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one: exact, and squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -exponent)


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


INDEXED = "cid long, copies long, vector array<double>, lists array<int>, codes binary, error double"
FOUND = "cid long, other long, links long"


def _indexed(batches: Iterator[pa.RecordBatch], index: Index, dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = _unit(_matrix(batch.column(2), dim))
        lists = index.nearest(unit, PROBES)
        codes, error = index.encode(unit - index.coarse[lists[:, 0]])
        ends = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * lists.shape[1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(lists.reshape(-1).astype(np.int32))),
             pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
            ["cid", "copies", "vector", "lists", "codes", "error"],
        )


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, least id of its part) that join what the matrix of links joins."""
    rows, columns = np.nonzero(links)
    ids, place = np.unique(np.concatenate([left[rows], right[columns]]), return_inverse=True)
    a, b = place[: len(rows)], place[len(rows) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return ids, ids[label]
        label = new


def _search(key: tuple, members: pa.Table, queries: pa.Table, index: Index, dim: int, cosine: float) -> pa.Table:
    """Links between a block of a list and a block of the classes that probe it.

    Of a pair that both ends would find, the one of the smaller id counts it for both.
    """
    none = pa.table({n: pa.array([], pa.int64()) for n in ("cid", "other", "links")})
    if not members.num_rows or not queries.num_rows:
        return none
    own_list = key[0].as_py()
    reach = np.sqrt(2 - 2 * cosine) + 1e-6
    x, y = _matrix(queries["vector"], dim), _matrix(members["vector"], dim)
    codes = np.frombuffer(b"".join(members["codes"].to_pylist()), np.uint8).reshape(len(y), -1)
    error, qid, mid = members["error"].to_numpy(), queries["cid"].to_numpy(), members["cid"].to_numpy()
    home = queries["home"].to_numpy()
    probed = members["lists"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    residual = _unit(x) - index.coarse[own_list]
    x, y = _scaled(x), _scaled(y)
    weight, other = queries["copies"].to_numpy(), members["copies"].to_numpy()
    pairs = []
    for i in range(0, len(x), 512):
        part = slice(i, i + 512)
        near = np.sqrt(index.table_distances(residual[part], codes)) - error <= reach
        a, b = np.nonzero(near)
        # The member finds the query too if it probes the query's own list: then the smaller id does it.
        both = (probed[b] == home[part][a][:, None]).any(axis=1)
        keep = (qid[part][a] != mid[b]) & (~both | (qid[part][a] < mid[b]))
        a, b = a[keep] + i, b[keep]
        dots = np.concatenate([np.empty(0), *(np.einsum("ij,ij->i", x[a[k : k + 65536]], y[b[k : k + 65536]]) for k in range(0, len(a), 65536))])
        sure = dots >= cosine * np.sqrt((x * x).sum(axis=1))[a] * np.sqrt((y * y).sum(axis=1))[b]
        pairs.append((a[sure], b[sure]))
    a, b = (np.concatenate(z) for z in zip(*pairs, strict=True))
    if not len(a):
        return none
    links = np.zeros((len(x), len(y)), bool)
    links[a, b] = True
    ids, least = _forest(links, qid, mid)
    for_queries = np.bincount(a, other[b], len(x)).astype(np.int64)
    for_members = np.bincount(b, weight[a], len(y)).astype(np.int64)
    counts = [for_queries[for_queries > 0], for_members[for_members > 0], np.zeros(len(ids), np.int64)]
    who = [qid[for_queries > 0], mid[for_members > 0], ids]
    return pa.table({
        "cid": np.concatenate(who), "other": np.concatenate([who[0], who[1], least]), "links": np.concatenate(counts),
    })


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``embeddings`` (vec_id, embedding): vec_id, n_links, component_id and kept.

    Links have a cosine of at least ``cosine``; n_links counts the other rows linked directly, component_id is the least
    vec_id reachable (itself included), kept says that it is the row's own. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, nor do vectors of different lengths with each other. Rows that
    repeat a vector are linked; rows without id count as links and keep a null component where no row of theirs has an id.
    """
    spark = embeddings.sparkSession
    bounded_batches(spark)
    whole = F.col("embedding").cast("array<double>")
    good = F.coalesce(
        (F.size(whole) > 0) & ~F.exists(whole, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists(whole, lambda v: v != 0), F.lit(False),
    )
    vector = F.when(good, whole)
    rows = embeddings.select("vec_id", vector.alias("vector"), F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(5), vector).alias("h2"))
    rows = written(rows, "vectors")
    classes = rows.where("vector IS NOT NULL").groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"), F.first("vector").alias("vector")
    )
    classes = written(classes.select(F.monotonically_increasing_id().alias("cid"), "*", F.size("vector").alias("dim")), "vector-classes")
    # Vectors of one length are one index; lengths are few.
    found = None
    for dim, n in classes.groupBy("dim").count().orderBy("dim").collect():
        part = _links(classes.where(F.col("dim") == dim), dim, n, cosine)
        found = part if found is None else found.unionByName(part)
    classes = classes.select("cid", "h1", "h2", "copies", "least_id")
    if found is not None:
        found = written(found, "vector-links")
        joined = components(found.where("cid <> other").select(F.col("cid").alias("a"), F.col("other").alias("b")))
        links = found.groupBy(F.col("cid").alias("c1")).agg(F.sum("links").alias("links"))
        classes = classes.join(links, F.col("cid") == F.col("c1"), "left").join(joined, F.col("cid") == F.col("id"), "left")
        classes = classes.withColumn("part", F.coalesce("component", "cid"))
    else:
        classes = classes.withColumn("links", F.lit(None).cast("long")).withColumn("part", F.col("cid"))
    classes = written(classes.select("h1", "h2", "copies", "least_id", "part", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-parts")
    least = classes.groupBy("part").agg(F.min("least_id").alias("component_id"))
    # Classes of one row that are linked with nothing need no lookup.
    linked = classes.where("n_links > 0").join(least, "part").select("h1", "h2", "n_links", "component_id")
    result = rows.select("vec_id", "h1", "h2", F.col("vector").isNotNull().alias("good")).join(written(linked, "vector-lookup"), ["h1", "h2"], "left")
    mine = F.col("good") & F.col("n_links").isNotNull()
    component = F.when(mine, F.col("component_id")).otherwise(F.col("vec_id"))
    return result.select(
        "vec_id", F.when(mine, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _links(classes: DataFrame, dim: int, n: int, cosine: float) -> DataFrame:
    """Rows (cid, other, links): link counts where cid is other, else links that join components."""
    spark = classes.sparkSession
    sample = classes.orderBy("h1", "h2").limit(SAMPLE).select("vector").collect()
    lists = max(1, min(MOST_LISTS, n // PER_LIST))
    shared = spark.sparkContext.broadcast(fit(_unit(np.array([r[0] for r in sample], np.float64)), lists))
    rows = classes.select("cid", "copies", "vector")
    indexed = written(rows.mapInArrow(lambda x: _indexed(x, shared.value, dim), INDEXED), "vector-index")
    members = indexed.withColumn("list", F.col("lists")[0])
    # Columns of their own, as both sides meet again below.
    asking = indexed.select(*(F.col(c).alias(f"q_{c}") for c in ("cid", "copies", "vector", "lists"))).toDF("cid", "copies", "vector", "lists")
    queries = asking.select("cid", "copies", "vector", F.col("lists")[0].alias("home"), F.explode("lists").alias("list"))
    # One row per list, so bounded by MOST_LISTS.
    sizes = members.groupBy("list").agg(F.count(F.lit(1)).alias("n_members"))
    asked = queries.groupBy("list").agg(F.count(F.lit(1)).alias("n_queries"))
    blocks = sizes.join(asked, "list").select(
        "list", F.ceil(F.col("n_members") / BLOCK_ROWS).cast("int").alias("mb"), F.ceil(F.col("n_queries") / BLOCK_ROWS).cast("int").alias("qb")
    )
    blocks = F.broadcast(written(blocks, "vector-blocks"))
    own = lambda count: F.pmod(F.xxhash64("cid"), count).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    members = members.join(blocks, "list").withColumn("m", own(F.col("mb"))).withColumn("q", every("qb")).drop("mb", "qb")
    queries = queries.join(blocks, "list").withColumn("q", own(F.col("qb"))).withColumn("m", every("mb")).drop("mb", "qb")
    both = members.groupBy("list", "m", "q").cogroup(queries.groupBy("list", "m", "q"))
    return both.applyInArrow(lambda key, left, right: _search(key, left, right, shared.value, dim, cosine), FOUND)
