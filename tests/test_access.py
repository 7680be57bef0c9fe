"""Lookups that read little: fuzzy joins, sketches, curve cells, buckets."""

import datetime as dt
import random

import pytest
from frames import rows
from pyspark.sql import functions as F

from tickmart.functions.matching import word_distance
from tickmart.operators import fuzzy, market, topk
from tickmart.plans.catalog import QUERIES
from tickmart.sinks.tables import save_bucketed
from tickmart.sources import cells


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def misspelt(rng, word):
    out = list(word)
    for _ in range(rng.randrange(3)):
        i = rng.randrange(len(out) or 1)
        out[i:i + rng.randrange(2)] = rng.choice(["", "x", "é", "a"])
    return "".join(out)


def test_fuzzy_join_equals_the_scan_for_a_thousand_keywords(spark, small):
    rng = random.Random(9)
    vocabulary = sorted({"".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(150)})
    names = [(i, " ".join(rng.choices(vocabulary, k=3))) for i in range(60)]
    keywords = sorted({misspelt(rng, rng.choice(vocabulary)) for _ in range(2500)} - {""})[:1000]
    coins = spark.createDataFrame(names, "id int, name string")
    got = fuzzy.fuzzy_rows(coins, spark.createDataFrame([(k,) for k in keywords], "keyword string"), "id", "name")
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    found = {(r.keyword, r.id): r.distance for r in got.collect()}
    asked = rng.sample(keywords, 40)
    scan = coins.select("id", *[word_distance(F.col("name"), k).alias(f"k{i}") for i, k in enumerate(asked)]).collect()
    want = {(k, r.id): r[f"k{i}"] for i, k in enumerate(asked) for r in scan if r[f"k{i}"] is not None}
    assert {p: d for p, d in found.items() if p[0] in asked} == want and len(found) > 1000
    every = brute(keywords, names)
    assert found == every


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


def brute(keywords, names):
    out = {}
    for k in keywords:
        limit = 0 if len(k) <= 2 else 1 if len(k) <= 5 else 2
        known = {w: distance(k, w) for w in {w for _, n in names for w in n.split()} if abs(len(w) - len(k)) <= limit}
        for i, n in names:
            d = min((known.get(w, 9) for w in n.split()), default=9)
            if d <= limit:
                out[k, i] = d
    return out


def test_sketches_of_days_combine_to_any_range(spark):
    """Few values: exact. Many: within the bound, and the frequent ones are there."""
    rng = random.Random(10)
    data = [(dt.date(2024, 1, 1 + i % 5), f"s{min(int(rng.expovariate(0.5)), 30)}") for i in range(4000)]
    frame = spark.createDataFrame(data, "at date, symbol string")
    sketches = topk.daily_sketches(frame, "symbol", "at").cache()
    for low, high in ((1, 5), (2, 3)):
        part = sketches.where(F.dayofmonth("day").between(low, high))
        exact = frame.where(F.dayofmonth("at").between(low, high)).groupBy("symbol").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "symbol").limit(7)
        assert [tuple(r) for r in topk.most_frequent(part, 7).collect()] == [tuple(r) for r in exact.collect()]
    many = spark.range(40_000).select(F.lit("2024-01-01").cast("date").alias("at"),
                                      F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 9000)).alias("symbol"))
    top = topk.most_frequent(topk.daily_sketches(many, "symbol", "at", 256), 1, 256).first()
    assert top.item == "hot" and 10_000 <= top["count"] <= 10_000 + topk.count_error(40_000, 256)


@pytest.fixture(scope="module")
def history(spark):
    days = F.explode(F.sequence(F.lit(dt.date(2023, 1, 1)), F.lit(dt.date(2024, 12, 31)))).alias("date")
    return spark.range(40).select(F.concat(F.lit("C"), "id").alias("symbol"), days).withColumn("price_usd", F.xxhash64("symbol", "date") % 100)


def test_a_lookup_opens_few_files(spark, history, tmp_path):
    path = str(tmp_path / "h")
    cells.write_cells(history, path)
    files = len(spark.read.parquet(path).inputFiles())
    since, until = dt.date(2024, 3, 1), dt.date(2024, 3, 20)
    cases = [(dict(symbol="C7"), 0.08), (dict(since=since, until=until), 0.08), (dict(symbol="C7", since=since, until=until), 0.01),
             (dict(symbol="C7", since=dt.date(2023, 12, 20), until=dt.date(2024, 1, 9)), 0.08), (dict(until=dt.date(2023, 1, 5)), 0.55)]
    for asked, share in cases:
        found = cells.lookup(spark, path, **asked)
        want = history
        if "symbol" in asked:
            want = want.where(F.col("symbol") == asked["symbol"])
        want = want.where(F.col("date").between(asked.get("since", dt.date(1900, 1, 1)), asked.get("until", dt.date(2100, 1, 1))))
        assert rows(found, "symbol", "date", "price_usd") == rows(want, "symbol", "date", "price_usd")
        listed = int(found._jdf.queryExecution().executedPlan().collectLeaves().head().selectedPartitions().totalNumberOfFiles())
        assert listed <= share * files, (asked, listed, files)


def test_bucketed_tables_need_no_shuffle(spark, history):
    daily = history.select(F.col("symbol").alias("coin_id"), "symbol", F.col("symbol").alias("name"), "date",
                           (F.xxhash64("symbol", "date") % 40).alias("rank_close"))
    save_bucketed(daily, "bucketed_daily", "coin_id", ["date"], 4)
    try:
        stored = spark.table("bucketed_daily")
        moved = market.rank_changes(stored)
        text = plan(moved)
        assert "Exchange" not in text and "Window" in text
        assert rows(moved) == rows(market.rank_changes(daily))
        assert "Exchange" not in plan(stored.groupBy("coin_id").agg(F.avg("rank_close")))
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_daily")


def joins(node):
    """The columns of every join below a logical plan node."""
    found = [node.output().mkString(",")] if node.nodeName() == "Join" else []
    return found + [j for i in range(node.children().size()) for j in joins(node.children().apply(i))]


def test_counting_fuzzy_matches_joins_sets_of_words_and_not_rows(spark, small):
    found = joins(QUERIES["fuzzy_keywords"](spark, small)._jdf.queryExecution().optimizedPlan())
    assert len(found) == 2 and not [j for j in found if "p_partkey" in j]


def test_fuzzy_counts_merge_rows_of_a_key(spark):
    names = [(1, "red ring"), (1, "Rad bolt"), (1, "red ring"), (2, "ring, red red"), (3, None), (4, ""), (5, "rod"), (None, "red"), (None, "x ring")]
    coins = spark.createDataFrame(names, "id int, name string")
    asked = spark.createDataFrame([("red",), ("red",), ("rring",), ("",), ("no",)], "keyword string")
    assert rows(fuzzy.fuzzy_rows(coins, asked, "id", "name"), "keyword", "id", "distance") == sorted(
        [("red", 1, 0), ("red", 2, 0), ("red", 5, 1), ("red", None, 0), ("rring", 1, 1), ("rring", 2, 1), ("rring", None, 1)], key=repr)
    assert rows(fuzzy.fuzzy_counts(coins, asked, "id", "name", "n"), "keyword", "distance", "n") == [("red", 0, 3), ("red", 1, 1), ("rring", 1, 3)]
