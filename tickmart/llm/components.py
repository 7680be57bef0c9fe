"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.scratch import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``(a, b)`` edges; the root is the component's smallest node.

    Large-star hangs a node's larger neighbours on its smallest one, small-star does so with the smaller
    neighbours; both keep components whole, and repeating them leaves one star per component. Each round
    is two joins with a map-side minimum, written to the shared folder; the driver sees three numbers.
    Loops, repeated edges and null ends are ignored. No edges: no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stored(e, "edges")
    before = _state(e)
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = (both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        hung = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(hung.union(least).distinct(), "edges")
        now = _state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
