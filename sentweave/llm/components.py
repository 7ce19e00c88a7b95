"""Connected components of an edge table by alternating large-star and small-star steps (DataFrame functions only)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentweave.llm.common import materialise, remove

MAX_ROUNDS = 60


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least neighbour: the larger ones (large star) or the smaller ones and the node (small star)."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        least = least.select("u", F.least("u", "m").alias("m"))
        hung = near.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return hung.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``; a component's name is its least node.

    Each round is written to the shared folder. Loops and repeated edges do no harm; null ends are ignored; without
    edges the result is empty. No node's neighbours are ever collected: minima are aggregated and joined.
    """
    spark = edges.sparkSession
    clean = edges.select("u", "v").filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct()
    now, path = materialise(clean, "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = mark(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        after, new_path = materialise(_step(_step(now, True), False), "edges")
        remove(spark, path)
        now, path, before, seen = after, new_path, seen, mark(after)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
