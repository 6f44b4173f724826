"""Connected components of a distributed edge table (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges ``(a long, b long)`` -> ``(node, root)``, one row per node that has an edge to another
    node; ``root`` is the smallest node reachable.

    Each round hooks every node's larger neighbours to its smallest neighbour (large star), then its
    smaller neighbours likewise (small star), until every component is a star on its smallest node;
    the number of rounds grows with the logarithm of the longest path. Minima are combined map-side
    and the joins are plain equi-joins that Spark may split, so a hub holding a third of all edges is
    spread over tasks. Edges never reach the driver, only a count and a checksum per round do.
    Null ends, loops and repeated edges are ignored; an empty table gives an empty table.
    """
    e = stage(edges.where("a is not null and b is not null and a <> b")
              .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    seen = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.join(low, F.col("u") == F.col("k")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = (large.join(low, F.col("u") == F.col("k")).where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
        e = stage(small, "cc")
        now = tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
