"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickmart.llm.copies import numbered
from tickmart.llm.scratch import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Tables of rates up to this many sources (some 10 MB) are broadcast; larger ones are joined.
BROADCAST_SOURCES = 100_000

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words of a text, runs without ASCII blanks; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``(source, source_size, place)``, places counting from 0 by code point, null last.

    Sources are ranged over partitions and counted within each; only one number per partition is summed up in one
    place.
    """
    last = F.col("source").isNull()
    ranged = stored(sources.repartitionByRange(last, "source").withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("part").agg(F.count("*").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    place = F.row_number().over(Window.partitionBy("part").orderBy(last, "source")) - 1
    return ranged.withColumn("inside", place).join(offsets, "part").select(
        "source", "source_size", (F.col("offset") + F.col("inside")).alias("place"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, size)`` rows.

    Sources in order of place weigh ``weights`` in turn and share ``share`` times all sizes. A target stops at
    ``most`` times its source's size; the excess is shared again by weight until none is above. Each round is one sum
    over the sources, of which the driver gets two numbers. Sources without words have target and rate 0.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    places = stored(ranked_sources(by_source).select("source", "source_size", weight.alias("weight")), "weights")
    cap = F.col("source_size") * most
    total = places.agg(F.sum("source_size")).first()[0] or 0
    level, left, free = 0.0, 0.0, 0
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        row = places.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        left, free, before = total * share - (row[0] or 0), row[1] or 0, free
        if not free or (free == before and level):
            break
        level = left / free
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(float(left)) / F.lit(float(free or 1)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return places.withColumn("target", F.least(target, cap.cast("double"))).select("source", "source_size", "target", rate.alias("rate"))


def row_key() -> Column:
    """What a row's draw goes by: its id, source and text."""
    parts = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.md5("source"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))
    return F.md5(F.concat_ws(":", *parts))


def draw(seed: int) -> Column:
    """A number from 0 to 1 (excluded) that only the seed, the row's key and its number among equal rows decide."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "key", F.col("copy").cast("string"))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**52))


def with_copies(rows: DataFrame, rates: DataFrame, seed: int, limit: int = BROADCAST_SOURCES) -> DataFrame:
    """Rows ``(key, copy, source, ...)`` with their source's columns and ``copies``: floor(rate), and one more with the fraction as
    probability.

    A large source is no hot key: its rates are broadcast while they are few, and else Spark splits the join.
    """
    few = rates.limit(limit + 1).count() <= limit
    side = rates.withColumnRenamed("source", "_source")
    joined = rows.join(F.broadcast(side) if few else side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    more = (draw(seed) < F.col("rate") - F.floor("rate")).cast("long")
    return joined.withColumn("copies", F.floor("rate") + more)


def mixture(docs: DataFrame, seed: int = 9, **settings) -> DataFrame:
    """What the mix takes of each document: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    ``size`` is the document's words, ``taken`` its words times its copies. Null and blank texts have size 0. A null
    source is a source of its own, placed last. A row draws by its id, source and text; rows alike in
    these, and rows without id, draw one by one. Other columns are ignored. An empty table gives an empty result. The same rows and seed
    give the same mix.
    """
    sized = stored(docs.select("doc_id", "source", word_count().alias("size"), row_key().alias("key")), "sizes")
    out = with_copies(numbered(sized, "key"), source_targets(sized, **settings), seed)
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, seed: int = 9, **settings) -> DataFrame:
    """The mixed corpus itself: every row as often as its source's rate says, with the columns of ``docs``.

    Of rows alike in id, source and text, their order in the input decides which gets a further copy.
    """
    rates = source_targets(docs.select("source", word_count().alias("size")), **settings)
    few = numbered(docs.select(F.struct(*docs.columns).alias("doc"), "source", row_key().alias("key")), "key")
    copied = with_copies(few, rates, seed).select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return copied.select("doc.*")
