"""Fuzzy search for a whole table of keywords: an equi-join on deletion variants instead of a scan per keyword."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.functions.matching import deletion_variants, edits_for, words


def fuzzy_words(keywords: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``keyword, word, distance`` for every keyword and every word within the edits that the keyword's length allows.

    ``keywords(keyword)`` and ``vocabulary(word)`` are lower-case; each is taken once. Words meet where they share a variant, and the
    edit distance decides. A variant has at least two letters unless it is a whole keyword, so no variant is shared by everything.
    """
    edits = edits_for(F.col("keyword"))
    asked = keywords.where(F.length("keyword") > 0).select("keyword").distinct() \
        .select("keyword", edits.alias("edits"), F.explode(deletion_variants(F.col("keyword"), edits)).alias("variant"))
    known = vocabulary.where(F.length("word") > 0).select("word").distinct() \
        .select("word", F.explode(deletion_variants(F.col("word"), F.lit(2))).alias("variant"))
    met = asked.join(known, "variant").select("keyword", "word", "edits").distinct()
    return met.withColumn("distance", F.levenshtein("keyword", "word")).where(F.col("distance") <= F.col("edits")).drop("edits")


def said_words(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``key, said``: one row per key with the distinct words of its names, in order.

    The rows are dealt by key before anything is collected, so a task holds its share of them, and what follows is planned by
    their size in memory and not by that of the files.
    """
    said = F.array_remove(F.array_distinct(words(F.col(name))), "")
    return rows.select(key, said.alias("said")).repartition(key).groupBy(key).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("said")))).alias("said"))


def fuzzy_sets(sets: DataFrame, keywords: DataFrame) -> DataFrame:
    """The rows of ``sets``, whose ``said`` lists differ, with each ``keyword`` near one of the words and the smallest ``distance``."""
    spoken = sets.withColumn("word", F.explode("said"))
    near = fuzzy_words(keywords, spoken)
    return spoken.join(near, "word").groupBy("keyword", *sets.columns).agg(F.min("distance").alias("distance"))


def fuzzy_rows(rows: DataFrame, keywords: DataFrame, key: str, name: str) -> DataFrame:
    """``keyword``, the row's ``key`` and the smallest ``distance`` between the keyword and a word of the row's name.

    What ``matching.word_distance`` yields for one keyword of one word, for all keywords at once. Equal lists of words are compared once.
    """
    said = said_words(rows, key, name)
    return said.join(fuzzy_sets(said.select("said").distinct(), keywords), "said").select("keyword", key, "distance")


def fuzzy_counts(rows: DataFrame, keywords: DataFrame, key: str, name: str, count: str) -> DataFrame:
    """How many keys ``fuzzy_rows`` finds per ``keyword`` and ``distance``, from the number of keys that say the same words."""
    sets = said_words(rows, key, name).groupBy("said").agg(F.count("*").alias("keys"))
    return fuzzy_sets(sets, keywords).groupBy("keyword", "distance").agg(F.sum("keys").alias(count))
