"""Rows without id, repeated ids, ties and odd norms: nothing is lost and nothing is decided by chance."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickmart.llm import ann, copies, mixing, ngram_join, packing, suffix_dedup

from test_llm_dedup import prose, variant
from test_llm_models import best, vectors


def test_no_document_is_lost_to_a_shared_id(make_docs):
    rng = random.Random(31)
    c, a, d, e = (prose(rng, 120, 10**6) for _ in range(4))
    b = variant(rng, c, 1)
    rows = [(3, c), (5, a), (5, b), (None, d), (None, d), (None, variant(rng, d, 1)), (None, e), (None, ""), (None, None), (7, ""), (7, " "), (9, a), (11, e)]
    docs = make_docs(rows).withColumn("tags", F.create_map(F.lit("k"), F.col("doc_id")))
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    loose = [t for i, t in got if i is None and t not in ("", None)]
    assert len(loose) == 1 and loose[0] in (d, rows[5][1])
    assert {k: n for k, n in got.items() if k[0] is not None} == {(3, c): 1, (5, a): 1, (7, ""): 1, (11, e): 1}
    assert got[None, ""] == 1 and got[None, None] == 1 and sum(got.values()) == 7


def test_links_of_classes_without_any_id(make_docs):
    rng = random.Random(32)
    d = prose(rng, 150, 10**6)
    rows = [(None, d), (None, d), (None, variant(rng, d, 1)), (1, prose(rng, 90, 10**6)), (None, prose(rng, 90, 10**6))]
    got = sorted((r.doc_id or 0, r.n_links, r.class_id or 0) for r in ngram_join.near_duplicates(make_docs(rows)).collect())
    assert got == [(0, 0, 0), (0, 2, 0), (0, 2, 0), (0, 2, 0), (1, 0, 1)]
    long = [(i if i > 1 else None, variant(rng, d, 1)) for i in range(4)]
    assert {r.n_links for r in ngram_join.near_duplicates(make_docs(long), range_bytes=400).collect()} == {3}


def test_ties_in_one_leaf_go_to_the_smaller_id(spark):
    """400 different vectors of one score, all in one leaf."""
    rng = np.random.default_rng(5)
    x = np.concatenate([np.ones((400, 1)), rng.standard_normal((400, 7))], axis=1)
    q = np.array([[1.0] + [0.0] * 7])
    ids = rng.permutation(np.arange(1, 401))
    base = vectors(spark, np.vstack([x, q]), [*ids.tolist(), 1000])
    got = [(r.vec_id, r.score) for r in sorted(ann.nearest(base.where("vec_id < 1000"), base.where("vec_id = 1000")).collect(), key=lambda r: r["rank"])]
    assert got == [(i, 1.0) for i in range(1, 21)]


@pytest.mark.parametrize("norm", [1e-8, 1.0, 1e8])
def test_recall_at_any_norm(spark, norm):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((10, 12)) * 2
    x = (centres[rng.integers(0, 10, 600)] + rng.standard_normal((600, 12))) * norm
    base = vectors(spark, x)
    found = defaultdict(list)
    for r in ann.nearest(base, base.where("vec_id % 20 = 0"), cell_rows=150, leaf_rows=32).collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = sum(len(set(best(np.arange(600), x, x[q], q, 20)) & set(found[q])) for q in range(0, 600, 20))
    assert hits >= 0.95 * 30 * 20


def test_rows_without_id_draw_one_by_one(make_docs):
    rows = [(None, "one two three " * (1 + i % 3), f"s{i % 2}") for i in range(900)] + [(4, "a b", "s0")] * 300
    out = mixing.mixture(make_docs(rows)).collect()
    taken, target = Counter(), {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(out) == 1200 and all(abs(taken[s] - t) < 0.08 * t for s, t in target.items())
    again = mixing.mixture(make_docs(rows).repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.source, r["size"], r.copies)
    assert Counter(map(key, again)) == Counter(map(key, out))
    assert mixing.mixed(make_docs(rows)).count() == sum(r.copies for r in out)


def test_equal_rows_are_dealt_over_runs(make_docs):
    rows = [(None, "a b c")] * 1500 + [(8, "a b c d")] * 700 + [(i, "a") for i in range(50)]
    out = packing.packed_batches(make_docs(rows), buckets=3, token_budget=64, run=50).collect()
    runs = Counter(tuple(r.batch_id.split("-")[:2]) for r in out)
    assert len(out) == len(rows) and max(runs.values()) <= 100
    assert len({(r.batch_id, r.slot) for r in out}) == len(out)


def test_copies_are_numbered_without_gaps(spark):
    keys = [("hot",)] * 500 + [(f"k{i}",) for i in range(40)] + [("two",)] * 2
    rows = spark.createDataFrame(keys, "key string").repartition(7).withColumn("copy_of", F.lit(1))
    got = defaultdict(list)
    for r in copies.numbered(rows, "key").collect():
        got[r.key].append(r.copy)
    assert sorted(got["hot"]) == list(range(500)) and sorted(got["two"]) == [0, 1] and len(got) == 42
    assert all(v == [0] for k, v in got.items() if k.startswith("k"))


def test_extra_columns_of_any_name(make_docs):
    long = "the same passage of more than a hundred bytes, said twice, word by word, so that it goes the second time. " * 2
    docs = make_docs([(1, "first " + long), (2, "second " + long), (3, "x")])
    for c in ("_sha", "_bytes", "_first", "_early", "_copy", "rest"):
        docs = docs.withColumn(c, F.concat(F.lit("mine "), F.col("doc_id")))
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text != long and len(got[2].text) < 60 and got[3].text == "x"
    assert all(r._sha == r._early == r.rest == f"mine {i}" and r.n_chars == len(r.text) for i, r in got.items())
