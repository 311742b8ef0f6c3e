"""Connected components of an undirected graph held as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Return ``node, component`` (the smallest node reachable) for every node of ``edges``.

    Alternates the large-star and small-star rewrites until the edge set is stable, so the
    number of rounds grows with the logarithm of the longest path. A hub never meets in one
    list: each rewrite is a minimum per node (combined map-side) and a join back, which
    adaptive execution can split. Each round's edges are checkpointed. Null ends and loops
    are ignored; repeated edges count once; an empty table gives an empty result.
    """
    use_checkpoints(edges.sparkSession)
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v").distinct().checkpoint()
    before = None
    while (now := _mark(e)) != before and now[0]:
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
        e = small.filter("u <> v").distinct().checkpoint()
    own = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
