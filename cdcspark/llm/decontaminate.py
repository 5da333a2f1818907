"""Benchmark decontamination with a broadcast set of word windows, built-in functions only.

The benchmark becomes a set of windows (``window`` consecutive words; a shorter item is one window). Any window of
L words in a document contains a whole block of k = (L+1)//2 words that starts at a multiple of k. So a document
is looked at in blocks, one lookup per k words: each block's hash is joined with the hashes of all k-word runs of the
benchmark. The few blocks that match carry the words around them; every window there is compared word by word.

Documents are read once; one shuffle gathers what was found per document. Nothing is collected but the lengths of the
benchmark's windows (at most ``window`` numbers) and the sizes of its two tables, which decide whether they are broadcast
(up to ``BROADCAST_ROWS`` rows) or joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import small
from cdcspark.session import written

WINDOW = 13
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; plain ASCII takes the faster function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def word_list(text: Column) -> Column:
    """Lower-cased words: runs of digits, letters and non-ASCII characters. Null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _OTHER + "+"), "")


def _blocks(length: int) -> str:
    """Aligned blocks of documents for windows of ``length`` words, with the words that such windows may cover."""
    k = (length + 1) // 2
    around = length - k
    return f"""
        if(n < {length}, array(), transform(sequence(0, (n - {k}) div {k}), j -> struct(
            {length} as len, xxhash64(slice(w, j * {k} + 1, {k})) as h, greatest(j * {k} - {around}, 0) as at,
            slice(w, greatest(j * {k} - {around}, 0) + 1, j * {k} - greatest(j * {k} - {around}, 0) + {k + around}) as ctx)))"""


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (len, words, item_id): every window of every item; items without words have none."""
    items = benchmark.select("item_id", word_list(F.col("text")).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    return items.withColumn("len", F.least(F.lit(window), "n")).select(
        "len", "item_id", F.explode(F.expr("transform(sequence(0, n - len), i -> slice(w, i + 1, len))")).alias("words")
    )


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """What each document shares with a benchmark.

    Returns per row of ``documents`` (doc_id, text; other columns are ignored): doc_id, text_hash, n_words, n_hit (words
    inside any occurrence of a window), n_items and items (distinct item ids as sorted text), spans (covered word ranges,
    end exclusive) and contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    Null text and text without words give zeros; repeated rows give repeated results; a benchmark without words hits
    nothing; an item whose id is null hits words but is not listed.
    """
    spark = documents.sparkSession
    windows = benchmark_windows(benchmark, window)
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())
    base = documents.select(
        F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), word_list(F.col("text")).alias("w")
    ).withColumn("n", F.size("w"))
    key = ["doc_id", "text_hash", "n"]
    if lengths:
        found = _found(base, windows, lengths, key)
    else:
        found = base.select(
            *key, F.lit(1).alias("rows"), F.lit(None).cast("array<struct<at:int,len:int>>").alias("hits"),
            F.lit(None).cast("array<bigint>").alias("items"),
        )
    per_doc = found.groupBy(*key).agg(
        F.sum("rows").alias("rows"),
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.flatten(F.collect_list("items")).alias("items"),
    )
    merged = F.expr(
        """aggregate(array_sort(hits), cast(array() as array<struct<start:int,end:int>>), (m, x) ->
            if(size(m) > 0 and element_at(m, -1).end >= x.at,
               concat(slice(m, 1, size(m) - 1), array(struct(element_at(m, -1).start as start,
                      greatest(element_at(m, -1).end, x.at + x.len) as end))),
               concat(m, array(struct(x.at as start, x.at + x.len as end)))))"""
    )
    names = F.array_sort(F.array_distinct(F.transform("items", lambda x: x.cast("string"))))
    result = per_doc.select(
        *key, "rows", F.when(F.size("hits") > 0, merged).otherwise(F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans"),
        names.alias("items"),
    ).withColumn("n_hit", F.expr("aggregate(spans, 0L, (s, x) -> s + x.end - x.start)"))
    return result.select(
        "doc_id", "text_hash", F.col("n").cast("long").alias("n_words"), "n_hit",
        F.size("items").cast("long").alias("n_items"), "items", "spans",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n"))).alias("contaminated"),
        F.explode(F.expr("sequence(1L, rows)")).alias("_row"),
    ).drop("_row")


def _found(base: DataFrame, windows: DataFrame, lengths: list[int], key: list[str]) -> DataFrame:
    """A marker row per document, plus a row per block that holds windows of the benchmark."""
    runs = windows.select(
        F.col("len").alias("g_len"),
        F.explode(F.expr("transform(sequence(0, len - (len + 1) div 2), i -> xxhash64(slice(words, i + 1, (len + 1) div 2)))")).alias("g_h"),
    ).distinct().withColumn("hit", F.lit(True))
    texts = windows.groupBy("len", F.array_join("words", " ").alias("t")).agg(F.collect_set("item_id").alias("ids"))
    texts = texts.select(F.col("len").alias("t_len"), F.col("t"), "ids")
    mark = "array(struct(0 as len, 0L as h, 0 as at, cast(array() as array<string>) as ctx))"
    rows = base.select(*key, F.explode(F.expr(f"concat({mark}, {', '.join(map(_blocks, lengths))})")).alias("b"))
    rows = rows.select(*key, "b.*")
    n_runs, n_texts = runs.count(), texts.count()
    near = rows.join(small(runs, n_runs), (F.col("len") == F.col("g_len")) & (F.col("h") == F.col("g_h")), "left")
    near = near.where("len = 0 or hit").select(*key, "len", "at", "ctx")
    tried = near.select(
        *key, "len",
        F.explode(F.expr("""if(len = 0, array(struct(0 as at, '' as t)),
            transform(sequence(0, size(ctx) - len), i -> struct(at + i as at, array_join(slice(ctx, i + 1, len), ' ') as t)))""")).alias("x"),
    ).select(*key, "len", "x.at", "x.t")
    sure = tried.join(small(texts, n_texts), (F.col("len") == F.col("t_len")) & (tried["t"] == texts["t"]), "left")
    sure = sure.where("len = 0 or ids is not null")
    return sure.select(
        *key, F.when(F.col("len") == 0, 1).otherwise(0).alias("rows"),
        F.when(F.col("len") > 0, F.array(F.struct(F.col("at").cast("int").alias("at"), F.col("len").cast("int").alias("len")))).alias("hits"),
        "ids",
    ).withColumnRenamed("ids", "items")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, without the contaminated ones."""
    bad = contamination(documents, benchmark, window).where("contaminated").select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")
    ).distinct()
    # Written, so the planner knows whether the documents need a shuffle to meet them.
    bad = written(bad, "contaminated")
    own = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["_bad_id"]) & (own == bad["_bad_hash"]), "left_anti")


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, with the hit words cut out of their texts (with the separators before them)."""
    cut = contamination(documents, benchmark, window).where("n_hit > 0").select(
        F.col("doc_id").alias("_cut_id"), F.col("text_hash").alias("_cut_hash"), F.col("spans").alias("_cut_spans")
    ).dropDuplicates(["_cut_id", "_cut_hash"])
    own = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    joined = documents.join(cut, documents["doc_id"].eqNullSafe(cut["_cut_id"]) & (own == cut["_cut_hash"]), "left")
    parts = F.regexp_extract_all("text", F.lit(f"{_OTHER}*[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), F.lit(0))
    held = F.filter(
        F.transform(parts, lambda p, i: F.struct(p.alias("p"), i.alias("i"))),
        lambda x: ~F.exists("_cut_spans", lambda s: (s["start"] <= x["i"]) & (x["i"] < s["end"])),
    )
    tail = F.regexp_extract("text", f"({_OTHER}*)$", 1)
    text = F.concat(F.array_join(F.transform(held, lambda x: x["p"]), ""), tail)
    joined = joined.withColumn("text", F.when(F.col("_cut_spans").isNull(), F.col("text")).otherwise(text))
    return joined.drop("_cut_id", "_cut_hash", "_cut_spans")
