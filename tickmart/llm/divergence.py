"""How sources of one language differ in their words: Arrow counts terms inside tasks, merged shards compute the divergences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickmart.llm.scratch import stored
from tickmart.llm.text_arrays import column_buffer, slices

#: What stands between terms: every ASCII character but the letters.
BETWEEN = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
MIN_DOCS = 3
TOP = 200
SCALE = 10**9
#: Bytes of text that are split together; a longer text is split alone.
SPLIT_BYTES = 4 << 20
#: Counted terms that a task gathers before it hands them on.
GATHERED = 500_000
#: Counts of a shard, sources whose rows one shard computes, and cells of the dense table a shard works on at a time.
SHARD_ROWS, SHARD_SOURCES, CELLS = 50_000, 256, 1 << 20

GROUP = ["lang", "source"]


def split_counts(texts: pa.Array) -> pa.Table:
    """``(row, term, n)``: how often each text says each term; A-Z are lower-cased, other letters stay."""
    words = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    table = pa.table({"row": pc.list_parent_indices(words), "term": pc.list_flatten(words)})
    table = table.filter(pc.not_equal(table["term"], ""))
    coded = table["term"].combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.unify_dictionaries().combine_chunks()
    counts = pa.table({"row": table["row"], "code": coded.indices}).group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    return pa.table({"row": counts["row"], "term": coded.dictionary.take(counts["code"].combine_chunks()), "n": counts["count_all"]})


def _merged(parts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by([*GROUP, "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.rename_columns([*GROUP, "term", "n", "docs"])


def partial_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: each task's occurrences and documents of every term; null text, lang and source are ''."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            offsets = column_buffer(batch.column(2))[1]
            for a, b in slices(offsets, SPLIT_BYTES):
                part = batch.slice(a, b - a)
                counts = split_counts(part.column(2))
                own = {g: part.column(i).take(counts["row"].combine_chunks()) for i, g in enumerate(GROUP)}
                ones = pa.array(np.ones(len(counts), np.int64))
                parts.append(_merged([pa.table({**own, "term": counts["term"], "n": counts["n"], "docs": ones})]))
                held += len(parts[-1])
                if held > GATHERED:
                    whole = _merged(parts)
                    parts, held = [whole], len(whole)
                    if held > GATHERED // 2:
                        yield from whole.to_batches(65536)
                        parts, held = [], 0
        if parts:
            yield from _merged(parts).to_batches(65536)

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*GROUP, "text")]
    return docs.select(*text).mapInArrow(rows, "lang string, source string, term string, n bigint, docs bigint")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)`` in whole numbers, three digits at a time: exact up to totals of 9 * 10**15."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


SHARD = "lang string, source string, part string, item string, value bigint"


def _shard(key: tuple, rows: pa.Table) -> pa.Table:
    """One shard of a language's terms: sums of the pairs over its terms, and the highest terms of each source.

    Rows without term name the language's sources, with their totals; the others are counts.
    """
    lang, low = key[0].as_py(), key[2].as_py() * SHARD_SOURCES
    named = pc.equal(rows["term"], "")
    heads, counts = rows.filter(named).sort_by("place"), rows.filter(pc.invert(named))
    sources = heads["source"].to_pylist()
    kept = heads["kept"].to_numpy()
    total = heads["total"].to_numpy() + kept
    whole = heads["lang_total"][0].as_py() + int(kept[0])
    mine = np.arange(low, min(low + SHARD_SOURCES, len(sources)))
    sums = np.zeros((len(mine), len(sources)), np.int64)
    out_source, out_item, out_value = [], [], []
    if len(counts):
        coded = counts["term"].combine_chunks().dictionary_encode()
        names, term = coded.dictionary, coded.indices.to_numpy()
        place, n = counts["place"].to_numpy(), counts["n"].to_numpy()
        order = np.argsort(term, kind="stable")
        term, place, n = term[order], place[order], n[order]
        wide = max(CELLS // len(sources), 1)
        best: list[list] = [[] for _ in mine]
        for first in range(0, len(names), wide):
            a, b = np.searchsorted(term, [first, first + wide])
            size = min(wide, len(names) - first)
            table = np.zeros((len(sources), size), np.int64)
            table[place[a:b], term[a:b] - first] = n[a:b]
            p = shares(table, total[:, None])
            q = shares(table.sum(axis=0), np.int64(whole))
            for i, s in enumerate(mine):
                sums[i] += _distance(p[s], p).sum(axis=1)
                over = np.flatnonzero((table[s] > 0) & (p[s] > q))
                if len(over):
                    best[i].append((over + first, _distance(p[s][over], q[over])))
        for i, s in enumerate(mine):
            if not best[i]:
                continue
            at, value = np.concatenate([x for x, _ in best[i]]), np.concatenate([v for _, v in best[i]])
            if len(at) > TOP:  # all that reach the last place's value: ties are decided when the shards meet
                least = np.partition(value, -TOP)[-TOP]
                at, value = at[value >= least], value[value >= least]
            out_source += [sources[s]] * len(at)
            out_item += names.take(pa.array(at)).to_pylist()
            out_value += value.tolist()
    parts = ["term"] * len(out_item)
    for i, s in enumerate(mine):
        others = [j for j in range(len(sources)) if j != s]
        out_source += [sources[s]] * len(others)
        out_item += [sources[j] for j in others]
        out_value += sums[i, others].tolist()
    parts += ["pair"] * (len(out_item) - len(parts))
    return pa.table({"lang": pa.array([lang] * len(parts), pa.string()), "source": pa.array(out_source, pa.string()), "part": pa.array(parts, pa.string()),
                     "item": pa.array(out_item, pa.string()), "value": pa.array(out_value, pa.int64())})


def source_divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``docs(text, lang, source)``; null texts, languages and sources are ''.

    A language keeps the terms of at least ``MIN_DOCS`` of its documents. Every source of a language, and the language as a
    whole, gives each kept term a share, in whole billionths plus one, with one added to every count. Part ``pair`` ranks the other sources by
    the distance summed over all kept terms (0 without any), part ``term`` the terms that a source says more often than
    its language, up to rank ``TOP``. Equal values rank by the bytes of the item. Repeated rows count as documents of their
    own; a text without terms, empty or null, still makes its source known. Other columns are not read. A language with one source has
    no pairs. No rows: no rows.

    Tasks count in Arrow and hand on merged counts, so a frequent term or a large source is one row a task. Terms go to
    shards of their language by the number of counts, so a shard is bounded whatever the language's size; more than
    ``SHARD_SOURCES`` sources share the work of a shard. The result has a row for each ordered pair of a language's sources.
    """
    counts = partial_counts(docs).groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = Window.partitionBy("lang", "term")
    kept = (counts.withColumns({"in_docs": F.sum("docs").over(by_term), "first": F.row_number().over(by_term.orderBy("source")) == 1})
            .where(F.col("in_docs") >= MIN_DOCS).select(*GROUP, "term", "n", F.col("first").cast("long").alias("first")))
    kept = stored(kept, "divergence-terms")
    totals = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("first").alias("kept"), F.sum("n").alias("lang_total"), F.count("*").alias("counted"))
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP)).distinct()
    by_lang = Window.partitionBy("lang")
    nothing = {"total": 0, "kept": 0, "lang_total": 0, "counted": 0}
    groups = groups.join(totals, GROUP, "left").join(langs, "lang", "left").na.fill(nothing)
    groups = groups.select(*GROUP, *nothing, (F.row_number().over(by_lang.orderBy("source")) - 1).alias("place"), F.count("*").over(by_lang).alias("width"))
    groups = groups.withColumns({"shards": F.expr(f"1 + counted div {SHARD_ROWS}"), "blocks": F.expr(f"1 + (width - 1) div {SHARD_SOURCES}")})
    groups = stored(groups, "divergence-groups")

    each_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    heads = groups.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard")).select(
        "lang", "shard", each_block, "source", F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), "place", "total", "kept", "lang_total")
    terms = kept.join(groups.select(*GROUP, "place", "shards", "blocks"), GROUP).select(
        "lang", F.pmod(F.xxhash64("term"), "shards").alias("shard"), each_block, "source", "term", "n", "place",
        *(F.lit(0).cast("long").alias(c) for c in ("total", "kept", "lang_total")))
    done = stored(heads.union(terms).groupBy("lang", "shard", "block").applyInArrow(_shard, SHARD), "divergence-shards")
    summed = done.where("part = 'pair'").groupBy(*GROUP, "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    terms = done.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return summed.withColumn("rank", F.row_number().over(order)).union(terms)
