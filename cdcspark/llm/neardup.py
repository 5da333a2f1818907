"""Near-duplicate documents by an inverted join of MinHash signature coordinates, confirmed on full shingle sets.

Documents with one shingle set are one class, found by a 128-bit sum over the set. Each class has a signature of
``COORDINATES`` minima. A pair at the similarity asked for agrees in at least ``MATCHES`` of them, but for a chance below
1e-5. Classes are posted under each (coordinate, value) that another class has too. Those with fewer than ``MATCHES`` such
postings can have no partner. The others keep a prefix, their rarest postings less ``MATCHES`` - 1: two classes that
agree often enough meet in a prefix, and the longest lists are skipped.

Lists are merged without pairing all that is in them. First every list's most central class is compared with the others.
Of the links found, one per class makes the first parts, and one per pair of parts joins these further. Then, in rounds, a part that a list
leaves open meets a few classes of the list's largest part, then more of them, then all of every other part; after each round one
link per pair of parts joins them, so what is joined meets no more. Only pairs are compared whose shared shingles could
still suffice, each in the first list the two share. The number of shingles that a class shares with any
other bounds its overlap, so classes full of shingles of their own fall away early. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import Workspace, bitmap, bounded_batches, buffers, in_bitmap, mixed, text_bytes
from cdcspark.llm.components import between, components, merged
from cdcspark.llm.shingles import shingle_sets
from cdcspark.session import written

#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75

#: Coordinates of a signature, and agreements that a pair must show: a binomial draw of 32 at 0.75 is below 13 once in 10^5.
COORDINATES, MATCHES = 32, 13

#: Places that shared shingles are folded into where two classes' overlap is bounded.
FOLDS = 4_096

#: Rounds in which open parts of a list meet: about how many classes of the list's largest part, then all of every part.
MEETINGS = (4, 64, None)

#: Bits of the filters that keep rows without a partner out of a shuffle; they are broadcast, 1 MB each.
FILTER_BITS = 1 << 23

_random = np.random.Generator(np.random.PCG64(75))
_MULTIPLY = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)

SKETCH = "doc_id long, n long, k1 long, k2 long, signature array<int>"


def sketches(documents: DataFrame, text_hash: bool = False) -> DataFrame:
    """Per row the size of its shingle set, the set's two sums and its signature (nulls without shingles); and the text's hash if asked."""
    own = [F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")] if text_hash else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(*buffers(batch.column(1))))
            sizes = np.array([len(x) for x in sets], np.int64)
            some = sizes > 0
            sums = np.zeros((2, len(sets)), np.uint64)
            minima = np.zeros((len(sets), COORDINATES), np.uint32)
            # Sets are put through together, a bounded number of shingles at a time.
            ends = np.cumsum(sizes)
            first = 0
            while first < len(sets):
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (1 << 20))))
                own = [x for x in sets[first:last] if len(x)]
                if own:
                    at = np.flatnonzero(some[first:last]) + first
                    flat = np.concatenate(own)
                    starts = np.cumsum([0, *map(len, own[:-1])])
                    sums[0, at] = np.add.reduceat(flat, starts)
                    sums[1, at] = np.add.reduceat(mixed(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
                    for c in range(COORDINATES):
                        values = ((flat * _MULTIPLY[c] + _ADD[c]) >> np.uint64(32)).astype(np.uint32)
                        minima[at, c] = np.minimum.reduceat(values, starts)
                first = last
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES), pa.array(minima.reshape(-1).view(np.int32))
            )
            keys = [pa.array(x.view(np.int64), mask=~some) for x in sums]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), *keys, lists, *batch.columns[2:]],
                ["doc_id", "n", "k1", "k2", "signature", *batch.schema.names[2:]],
            )

    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), text_bytes().alias("raw"), *own)
    return rows.mapInArrow(work, SKETCH + (", text_hash long" if text_hash else ""))


def full_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (doc_id, k1, shingles): the sorted distinct shingle hashes of texts, at least of those whose id is in ``wanted``."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS)).alias("place")
    words = documents.sparkSession.sparkContext.broadcast(bitmap(wanted.select("doc_id").select(place), FILTER_BITS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(words.value, batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))))
            sets = list(shingle_sets(*buffers(batch.column(1))))
            sums = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
            ends = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
            flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums), pa.ListArray.from_arrays(ends, pa.array(flat))], ["doc_id", "k1", "shingles"]
            )

    bounded_batches(documents.sparkSession)
    named = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), text_bytes().alias("raw"), place)
    return named.mapInArrow(work, "doc_id long, k1 long, shingles array<long>")


def _posting_key(at, value):
    """The (coordinate, value) pair as one number; columns and arrays alike."""
    return at * (1 << 32) + (value + (1 << 31))


def _posting_place(at, value):
    """The pair's bit in a filter; a minimum's low bits are as good as random."""
    return (value + at * 262_147) % FILTER_BITS


def _prefixes(classes: DataFrame, space: Workspace) -> DataFrame:
    """Rows (cid, n, key, keys, centrality) of the rarest postings of every class that may have a partner."""
    posted = classes.select(F.posexplode("signature").alias("at", "value"))
    again = posted.groupBy(F.col("at").cast("long").alias("at"), F.col("value").cast("long").alias("value")).count().where("count > 1")
    again = space.written(again.withColumnRenamed("count", "df"), "postings")
    place = F.pmod(F.col("value") + F.col("at") * 262_147, F.lit(FILTER_BITS)).alias("place")
    words = classes.sparkSession.sparkContext.broadcast(bitmap(again.select(place), FILTER_BITS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.arange(COORDINATES, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                values = batch.column(2).flatten().to_numpy().astype(np.int64).reshape(-1, COORDINATES)
                row, c = np.nonzero(in_bitmap(words.value, _posting_place(at, values)))
                key = _posting_key(c, values[row, c])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(key)], ["cid", "n", "key"]
                )

    met = classes.select("cid", "n", "signature").mapInArrow(work, "cid long, n long, key long")
    met = met.join(again.select(_posting_key(F.col("at"), F.col("value")).alias("key"), "df"), "key")
    met = met.groupBy("cid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("all"))
    met = met.where(F.size("all") >= MATCHES)
    kept = met.select(
        "cid", "n", F.expr("aggregate(all, 0L, (s, x) -> s + x.df)").alias("centrality"),
        F.expr(f"transform(slice(all, 1, size(all) - {MATCHES} + 1), x -> x.key)").alias("keys"),
    )
    return kept.select("*", F.explode("keys").alias("key"))


def _in_company(lists: DataFrame) -> DataFrame:
    """Rows of lists with more than one class."""
    sizes = lists.groupBy("key").count().where("count > 1").select("key")
    return lists.join(sizes, "key", "left_semi")


def _colliding(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in at least ``MATCHES`` coordinates."""
    left = classes.select(F.col("cid").alias("a"), F.col("signature").alias("ga"))
    right = classes.select(F.col("cid").alias("b"), F.col("signature").alias("gb"))
    agreed = F.size(F.filter(F.arrays_zip("ga", "gb"), lambda x: x["ga"] == x["gb"]))
    return pairs.join(left, "a").join(right, "b").where(agreed >= MATCHES).select("a", "b")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with how many shingles they have in common, and whether that makes a link."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    enough = 100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))
    return both.select("a", "b", "common", enough.alias("linked"))


def _folded(sets: DataFrame, common: DataFrame) -> DataFrame:
    """Rows (cid, folded): the shingles a class shares with others, as their place among ``FOLDS`` and a running number there.

    Two such lists have at least as much in common as the sets do, at a fraction of their size.
    """
    shared = sets.select("cid", F.explode("shingles").alias("shingle")).join(common, "shingle", "left_semi")
    counts = shared.groupBy("cid", F.pmod("shingle", F.lit(FOLDS)).cast("int").alias("fold")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    lists = F.collect_list(F.expr(f"transform(sequence(0, n - 1), j -> j * {FOLDS} + fold)"))
    return counts.groupBy("cid").agg(F.flatten(lists).alias("folded"))


def _enough(c, na, nb, percent: int):
    """n shingles on each side and c in common make a link: 100 c >= percent * (na + nb - c)."""
    return (100 + percent) * c >= percent * (na + nb)


def parts_of_classes(documents: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (id, component) of all classes (cid, n, k1, signature) that confirmed links join with others."""
    space = Workspace(documents.sparkSession, "neardup")
    found = written(_parts(documents, classes, percent, space), "class-parts")
    space.remove()
    return found


def _parts(documents: DataFrame, classes: DataFrame, percent: int, space: Workspace) -> DataFrame:
    lists = _in_company(space.written(_prefixes(classes, space), "prefixes"))
    likely = lists.select("cid").distinct().join(classes.select("cid", "k1", "signature"), "cid")
    likely = space.written(likely, "likely")
    sets = full_sets(documents, likely.select(F.col("cid").alias("doc_id"))).withColumnRenamed("doc_id", "cid")
    sets = sets.join(likely.select("cid", "k1"), ["cid", "k1"], "left_semi").dropDuplicates(["cid", "k1"])
    sets = space.written(sets.select("cid", "shingles"), "sets")
    # How many of its shingles a class shares with any other one.
    single = sets.select("cid", F.explode("shingles").alias("shingle"))
    common = single.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("cid").alias("one")).where("df > 1")
    common = space.written(common.select("shingle"), "common-shingles")
    shared = single.join(common, "shingle", "left_semi").groupBy("cid").agg(F.count(F.lit(1)).alias("u"))
    lists = lists.join(shared, "cid").where(100 * F.col("u") >= percent * F.col("n"))
    lists = space.written(_in_company(lists), "lists")
    centre = lists.groupBy("key").agg(F.max(F.struct("centrality", "cid", "n", "u")).alias("p"))
    near = lists.join(centre, "key").where("cid <> p.cid").where(
        _enough(F.least("u", "p.u"), F.col("n"), F.col("p.n"), percent)
    )
    ends = [F.least("cid", "p.cid").alias("a"), F.greatest("cid", "p.cid").alias("b")]
    near = space.written(near.select("cid", *ends, F.struct("p.centrality", "p.cid").alias("p")).distinct(), "near")
    tried = _colliding(near.select("a", "b").distinct(), likely)
    tried = space.written(_compared(space.written(tried, "colliding"), sets, percent), "tried")
    first = tried.where("linked").select("a", "b")
    # A class's link to the most central of its partners, then one link per pair of the parts that these make.
    stars = near.join(first, ["a", "b"]).groupBy("cid").agg(F.max("p").alias("p"))
    labels = components(stars.select(F.col("cid").alias("a"), F.col("p.cid").alias("b")))
    labels = space.written(merged(labels, components(between(first, labels))), "parts")
    # What a class has in common with its list's centre, where the two were compared.
    members = lists.join(centre.select("key", "p"), "key").select("*", *ends)
    members = members.join(tried.select("a", "b", "common"), ["a", "b"], "left")
    inner = F.when(F.col("cid") == F.col("p.cid"), F.col("u")).otherwise(F.col("common"))
    members = space.written(members.select("key", "keys", "cid", "n", "u", inner.cast("long").alias("i")), "members")
    folded, known = None, tried.select("a", "b")
    for turn, few in enumerate(MEETINGS):
        open_rows = space.written(_open_rows(members, labels), f"open-{turn}")
        if open_rows.isEmpty():
            break
        if folded is None:
            # No class is open later that is not so now.
            some = open_rows.select("cid").distinct()
            folded = space.written(_folded(sets.join(some, "cid", "left_semi"), common), "folded")
        rest = _meeting(open_rows.join(folded, "cid"), few, percent).join(known, ["a", "b"], "left_anti")
        rest = space.written(_colliding(rest, likely), f"rest-{turn}")
        found = space.written(_compared(rest, sets, percent), f"found-{turn}")
        known = known.unionByName(found.select("a", "b"))
        labels = space.written(merged(labels, components(between(found.where("linked").select("a", "b"), labels))), f"parts-{turn}")
    return labels


def _open_rows(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the lists that hold several parts, with their part, its size in the list and the list's largest part."""
    own = labels.select(F.col("id").alias("cid"), "component")
    rows = members.join(own, "cid", "left").withColumn("label", F.coalesce("component", "cid")).drop("component")
    sizes = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"))
    top = sizes.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top"), F.count(F.lit(1)).alias("parts"))
    several = top.where("parts > 1").select("key", F.col("top.label").alias("top"), F.col("top.size").alias("top_size"))
    return rows.join(several, "key")


def _meeting(open_rows: DataFrame, few: int | None, percent: int) -> DataFrame:
    """Pairs (a, b) of different parts to compare: with about ``few`` classes of the largest part of a list, or with all of every part."""
    left = open_rows.where("label <> top").select(
        "key", "keys", F.col("cid").alias("x"), F.col("n").alias("xn"), F.col("u").alias("xu"), F.col("i").alias("xi"),
        F.col("label").alias("xl"), F.col("folded").alias("xf"),
    )
    right = open_rows
    if few is not None:
        # Which ones of a large part is for a hash to say, another one in every round.
        right = right.where("label = top").where(F.pmod(F.xxhash64("cid", F.lit(few)), F.col("top_size")) < few)
    right = right.select(
        F.col("key").alias("ykey"), F.col("keys").alias("ykeys"), F.col("cid").alias("y"), F.col("n").alias("yn"), F.col("u").alias("yu"),
        F.col("i").alias("yi"), F.col("label").alias("yl"), F.col("folded").alias("yf"), "top",
    )
    # Two classes share inside the centre no more than either does with it, and outside no more than either shares there at all.
    known = F.col("xi").isNotNull() & F.col("yi").isNotNull()
    outside = F.least(F.col("xu") - F.col("xi"), F.col("yu") - F.col("yi"))
    most = F.when(known, F.least("xi", "yi") + outside).otherwise(F.least("xu", "yu"))
    # Members of the largest part of a list need not meet each other, and two classes meet in the first list they share.
    met = left.join(right, (F.col("key") == F.col("ykey")) & (F.col("xl") != F.col("yl"))
                    & ((F.col("yl") == F.col("top")) | (F.col("x") < F.col("y")))
                    & _enough(most, F.col("xn"), F.col("yn"), percent)
                    & (F.array_min(F.array_intersect("keys", "ykeys")) == F.col("key"))
                    & _enough(F.size(F.array_intersect("xf", "yf")), F.col("xn"), F.col("yn"), percent))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(documents: DataFrame, percent: int = PERCENT, text_hash: bool = False) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id and kept; if asked, text_hash (xxhash64, null as empty).

    component_id is the least doc_id reachable by links of 100 * intersection >= ``percent`` * union of distinct 5-word
    shingles, kept says that it is the row's own. A text of fewer words is one shingle; null, empty or wordless texts have none
    and are linked with nothing. Rows without doc_id follow a text equal to theirs, else they stay alone (component_id null,
    kept). Ids are taken to be unique: rows that repeat id and text get the same result each, and rows that repeat an id with
    other texts follow their own text.
    """
    rows = written(sketches(documents, text_hash), "sketches")
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    # A sum per class before the shuffle; classes of copies are one row per task.
    classes = written(
        some.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("cid"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature")),
        "classes",
    )
    found = parts_of_classes(documents, classes, percent)
    # Classes of one row need no lookup.
    several = classes.where("copies > 1").select("n", "k1", "k2", "cid")
    nameless = rows.where("doc_id IS NULL AND n > 0").select("n", "k1", "k2").distinct()
    several = several.unionByName(
        classes.where("copies = 1").select("n", "k1", "k2", "cid").join(nameless, ["n", "k1", "k2"], "left_semi")
    )
    result = rows.drop("signature").join(written(several, "copies"), ["n", "k1", "k2"], "left")
    result = result.withColumn("cid", F.coalesce("cid", "doc_id")).join(found, F.col("cid") == F.col("id"), "left")
    component = F.coalesce("component", "cid")
    return result.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        *(["text_hash"] if text_hash else []),
    )


def without_rows(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """``documents`` (doc_id, text and others) without the rows that ``gone`` (doc_id, text_hash) names; rows without doc_id stay.

    Texts are not shuffled but for rows that a filter of fixed size cannot clear: those that go, and a share of the others that
    grows as the filter fills up (a fifth at 1.8 million rows of ``gone``). A join decides on them.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    place = lambda own: F.pmod(F.xxhash64("doc_id", own), F.lit(FILTER_BITS)).alias("__place")
    words = documents.sparkSession.sparkContext.broadcast(
        bitmap(gone.select(place(F.col("text_hash")).alias("place")), FILTER_BITS)
    )

    def part(doubtful: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *own, places = batch.columns
                hit = in_bitmap(words.value, places.to_numpy(zero_copy_only=False).astype(np.int64))
                yield pa.RecordBatch.from_arrays(own, batch.schema.names[:-1]).filter(pa.array(hit == doubtful))

        return documents.select("*", place(text_hash)).mapInArrow(work, documents.schema)

    bounded_batches(documents.sparkSession)
    names = gone.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash"))
    open_rows = part(True)
    decided = open_rows.join(names, (F.col("doc_id") == F.col("__gone")) & (text_hash == F.col("__hash")), "left_anti")
    return part(False).unionByName(decided)
