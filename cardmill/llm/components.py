"""Connected components of a graph held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill import files
from cardmill.session import materialize, scratch_path


def _written(edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    path = scratch_path(edges.sparkSession, "edges")
    edges.write.parquet(path)
    stored = edges.sparkSession.read.schema(edges.schema).parquet(path)
    mark = stored.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return stored, path, tuple(mark)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); the component is its smallest node.

    Large-star and small-star steps (Kiveris et al., 2014) turn the edges into stars around the smallest nodes. Every
    step is a grouped minimum, which is aggregated before the shuffle, and a join; no neighbourhood is collected. The
    edges are written after each round, which cuts the lineage and outlives executors. Loops and edges with a null end
    are left out; repeated edges count once; without edges the result is empty.
    """
    pairs = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).filter("a > b").select("a", "b").distinct()
    stored, path, mark = _written(pairs)
    while mark[0]:
        both = stored.union(stored.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v > m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).distinct()
        new, new_path, new_mark = _written(small)
        files.delete(edges.sparkSession, path)
        done = new_mark == mark
        stored, path, mark = new, new_path, new_mark
        if done:
            break
    return stored.select(F.col("a").alias("node"), F.col("b").alias("component")).union(stored.select("b", "b").distinct())


def stored_components(edges: DataFrame) -> DataFrame:
    return materialize(components(edges), "components")
