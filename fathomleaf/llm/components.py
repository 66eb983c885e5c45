"""Connected components by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomleaf.llm._shared import staged

ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (a > b). A node's neighbours are never gathered in one place.

    A star's centre is one key of the first join. Its least neighbours are written before, so that both sides come from a
    shuffle of their own (or the small one is broadcast by its size) and adaptive execution can split a very large star.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of ``links`` (two long columns): root is the least node reachable.

    Links to oneself, repeated and reversed links change nothing; links with a null take no part; no links, no rows.
    """
    a_, b_ = F.col(a).cast("long"), F.col(b).cast("long")
    edges = staged(
        links.select(F.greatest(a_, b_).alias("a"), F.least(a_, b_).alias("b"), a_.isNull().alias("na"), b_.isNull().alias("nb"))
        .filter("not na and not nb and a > b")
        .select("a", "b")
        .distinct(),
        "links",
    )
    before = _signature(edges)
    for _ in range(ROUNDS):
        if not before[0]:
            break
        edges = staged(_stars(edges), "stars")
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
