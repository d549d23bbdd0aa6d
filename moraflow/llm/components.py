"""Connected components of an edge table by alternating stars, each round written to the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraflow.llm.texts import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links neighbours to the least of them and u: the greater neighbours (large), or the smaller ones and u itself.

    The least comes from a combined aggregation and is joined back, so a vertex with very many neighbours can be split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    joined = pairs.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every vertex that has an edge and is not the least of its component; edges are (u, v) longs.

    An empty table gives an empty one; loops and repeated edges do not matter.
    """
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        count, total = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == (count, total) or count == 0:
            return now.select("u", F.col("v").alias("root"))
        state = (count, total)
        grown = _star(_both(now), large=True)
        now = written(_star(grown.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), large=False), "edges")
