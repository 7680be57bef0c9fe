"""Packing documents into batches of near-equal length."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.llm.copies import numbered
from tickmart.llm.mixing import word_count
from tickmart.llm.scratch import stored

BUCKETS = 16
TOKEN_BUDGET = 65_536
#: Lengths are exact below 2**(1 + FINE_BITS) and then share a cell by that many leading bits, so the histogram has at
#: most 2**FINE_BITS cells per doubling whatever the corpus holds. A cell's longest document is its edge.
FINE_BITS = 8
#: Documents of a bucket that are numbered together; each such run may end with one batch that is not full.
RUN = 8192


def cell_of(length: str) -> Column:
    """The upper edge of a length's histogram cell; the smallest is 1."""
    size = f"greatest({length}, 1L)"
    step = f"shiftleft(1L, greatest(length(bin({size} - 1)) - {FINE_BITS + 1}, 0))"
    return F.expr(f"cast(ceil({size} / {step}) * {step} as bigint)")


def best_edges(cells: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper edges of at most ``buckets`` buckets with the least padding; cells ascend.

    ``cost[j]`` after k rounds is the least number of places that k buckets need for the first j cells; padding is
    that less the lengths themselves, which no choice changes.
    """
    n = len(cells)
    if not n:
        return []
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    cost = np.full(n + 1, np.iinfo(np.int64).max // 4, np.int64)
    cost[0] = 0
    cuts, costs = [], []
    for _ in range(min(buckets, n)):
        new, cut = np.empty_like(cost), np.zeros(n + 1, np.int64)
        new[0] = 0
        for j in range(1, n + 1):
            ways = cost[:j] + cells[j - 1] * (before[j] - before[:j])
            cut[j] = int(ways.argmin())
            new[j] = ways[cut[j]]
        cost = new
        cuts.append(cut)
        costs.append(int(cost[n]))
    edges, j = [], n
    for cut in reversed(cuts[:int(np.argmin(costs)) + 1]):
        if j == 0:
            break
        edges.append(int(cells[j - 1]))
        j = int(cut[j])
    return edges[::-1]


def packed_batches(docs: DataFrame, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, run: int = RUN) -> DataFrame:
    """One row per document: ``doc_id, length, bucket, batch_id, slot, padding``.

    ``length`` is the document's words. ``bucket`` is the length its batch is padded to: dynamic programming over the
    histogram of all documents places the edges with the least padding. A batch holds documents of one bucket, as
    many as fit the token budget at that length; a document longer than the budget has a batch of its own. Documents
    of a bucket are dealt by hash into runs of about ``run``, and each run is cut into batches, so no bucket is
    gathered in one task; rows alike in id and length are dealt by their number among these. ``slot`` counts from 0 inside a batch.

    Null and blank texts have length 0 and take a place in the smallest bucket they fit. Repeated rows are packed one
    by one. Rows without doc_id are packed like others. Other columns are ignored. An empty table gives an empty
    result.
    """
    known_as = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("length").cast("string"))
    sized = docs.select("doc_id", word_count().alias("length")).withColumn("key", known_as)
    sized = stored(numbered(stored(sized, "lengths"), "key").drop("key"), "numbered-lengths")
    top = F.max(F.greatest("length", F.lit(1))).cast("long").alias("top")
    cells = sized.withColumn("cell", cell_of("length")).groupBy("cell").agg(F.count("*").alias("n"), top).orderBy("cell").collect()
    edges = best_edges(np.array([c.top for c in cells], np.int64), np.array([c.n for c in cells], np.int64), buckets)
    held = np.zeros(len(edges), np.int64)
    for c in cells:
        held[int(np.searchsorted(edges, c.top))] += c.n
    known = [(e, int(-(-h // run)), max(1, token_budget // e)) for e, h in zip(edges, held)] or [(1, 1, 1)]
    pick = lambda k: F.coalesce(*[F.when(F.col("length") <= e[0], F.lit(e[k]).cast("long")) for e in known])
    placed = (sized.select("doc_id", "length", "copy", pick(0).alias("bucket"), pick(1).alias("runs"), pick(2).alias("places"))
              .withColumn("run", F.pmod(F.xxhash64("doc_id", "length", "copy"), F.col("runs"))))
    seat = F.row_number().over(Window.partitionBy("bucket", "run").orderBy("doc_id", "length", "copy")) - 1
    return placed.withColumn("seat", seat).select(
        "doc_id", "length", "bucket",
        F.concat_ws("-", "bucket", "run", F.floor(F.col("seat") / F.col("places"))).alias("batch_id"),
        (F.col("seat") % F.col("places")).cast("int").alias("slot"), (F.col("bucket") - F.col("length")).alias("padding"))
