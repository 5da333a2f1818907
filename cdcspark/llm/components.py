"""Connected components of a table of links, by least labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark import files
from cdcspark.session import fresh_dir, written


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for every id in the columns a and b of ``links``; component is the least id reachable.

    Each round takes the least label of the neighbours, then the label of that label, so chains halve. Rounds are
    written to the shared folder; only the number of changes comes to the driver. A node with very many links is summed up
    before the shuffle.
    """
    spark = links.sparkSession
    pairs = links.select("a", "b").where("a <> b")
    edges = written(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    path = fresh_dir(spark, "labels")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select(
        "id", F.least("id", "least").alias("label")), "labels", path=path)
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step_path = fresh_dir(spark, "labels")
        step = written(step, "labels", path=step_path)
        up = step.select(F.col("id").alias("up_id"), F.col("label").alias("up"))
        new_path = fresh_dir(spark, "labels")
        new = written(step.join(up, step["label"] == up["up_id"]).select("id", "old", F.col("up").alias("label")), "labels", path=new_path)
        changed = new.where("old <> label").limit(1).count()
        files.remove(spark, step_path)
        files.remove(spark, path)
        path, labels = new_path, new.select("id", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")


def between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links (a, b) as links between the parts that ``labels`` (id, component) has, each pair of parts once, inner ones left out.

    An id without a label is a part of its own.
    """
    for end in ("a", "b"):
        own = labels.select(F.col("id").alias("__id"), F.col("component").alias("__part"))
        links = links.join(own, F.col(end) == F.col("__id"), "left").withColumn(end, F.coalesce("__part", end)).drop("__id", "__part")
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def merged(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """Labels after the parts were joined; ``joined`` has rows (id, component) for the parts that were."""
    found = joined.select(F.col("id").alias("__id"), F.col("component").alias("__part"))
    old = labels.join(found, F.col("component") == F.col("__id"), "left")
    old = old.select("id", F.coalesce("__part", "component").alias("component"))
    # Parts of one id had no row before.
    alone = joined.join(labels.select("id"), "id", "left_anti").select("id", "component")
    return old.unionByName(alone)
