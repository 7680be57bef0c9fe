"""Nearest neighbours, toxicity, packing, mixing, the pipeline and the registered queries."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tickmart.llm import ann, mixing, packing, toxicity
from tickmart.llm.queries import ORACLE_SQL, QUERIES


def vectors(spark, x, ids=None):
    rows = [(None if ids is None and i < 0 else int(i), None if v is None else [None if c is None else float(c) for c in v], "a", "b")
            for i, v in zip(ids if ids is not None else range(len(x)), x)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string, rank string")


def best(ids, x, q, own, k):
    scores = (x * q).sum(axis=1)
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]
    return [(int(ids[i]), float(scores[i])) for i in order]


@pytest.mark.parametrize("cell_rows,block_rows", [(100, 40), (10_000, 10_000)])
def test_neighbours_against_brute_force(spark, cell_rows, block_rows):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 16)) * 3
    x = centres[rng.integers(0, 12, 900)] + rng.standard_normal((900, 16))
    x[100:180] = x[100]  # many equal vectors
    base = vectors(spark, x)
    found = defaultdict(list)
    for r in sorted(ann.nearest(base, base.where("vec_id % 20 = 0"), cell_rows=cell_rows, block_rows=block_rows, leaf_rows=32,
                                block_queries=20).collect(), key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 900, 20):
        want = best(np.arange(900), x, x[q], q, 20)
        hits += len({w for w, _ in want} & {g for g, _ in found[q]})
        assert len(found[q]) == 20
        assert [s for _, s in found[q]] == sorted((s for _, s in found[q]), reverse=True)
    assert set(found) == set(range(0, 900, 20)) and hits >= 0.95 * 45 * 20
    assert found[100] == best(np.arange(900), x, x[100], 100, 20)  # ties to the smaller ids


def test_neighbours_of_odd_vectors(spark):
    x = [[1, 0], None, [0, 0], [1, None], [float("nan"), 1], [float("inf"), 1], [2, 1], [1, 2, 3], [1, 0], [1, 0]]
    base = vectors(spark, x, [0, 1, 2, 3, 4, 5, 6, 7, 20, 20])
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(base, base.where("vec_id % 20 = 0")).collect())
    assert got == [(0, 1, 6, 2.0), (0, 2, 20, 1.0), (0, 3, 20, 1.0), (20, 1, 6, 2.0), (20, 2, 0, 1.0)]
    assert ann.nearest(base.limit(0), base).collect() == [] and ann.nearest(base, base.limit(0)).collect() == []
    assert ann.nearest(base.where("vec_id = 2"), base).collect() == []


def test_chi_square_cut():
    assert abs(ann.chi_square_cut(8, 0.05) - 15.507) < 1e-2 and abs(ann.chi_square_cut(2, 0.5) - 1.386) < 1e-2


def toxic_texts(n, seed):
    rng = random.Random(seed)
    words = [f"{rng.choice('bdfgklmn')}{rng.choice('aeiou')}{rng.choice('rstvz')}{rng.choice('aeiou')}{rng.choice('lmn')}" for _ in range(400)]
    out = []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.choice([5, 40, 150]))]
        bad = rng.random() < 0.3
        if bad:
            for _ in range(3):
                t[rng.randrange(len(t))] = rng.choice(["Wretch!", "vermin", "oaf,", "cretinous", "cretinly"])
        out.append((" ".join(t), int(bad)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = toxic_texts(600, 1)
    return toxicity.train(pa.array([t for t, _ in rows]), np.array([y for _, y in rows], float), steps=160, rounds=2)


def test_held_out_accuracy(model):
    rows = toxic_texts(300, 2)
    score = toxicity.text_scores(model, pa.array([t for t, _ in rows]))
    assert np.mean((score >= 0.5) == np.array([y for _, y in rows])) > 0.9
    assert ((score >= 0) & (score <= 1)).all()


def test_every_window_counts(model):
    calm = " ".join(t for t, y in toxic_texts(400, 3) if not y)
    words = calm.split()
    late = " ".join(words[:-5] + ["wretch"] * 3 + words[-5:])
    quiet, loud = toxicity.text_scores(model, pa.array([calm, late]))
    assert loud > 0.5 > quiet or loud > quiet + 0.2


def test_windows_cover_the_text():
    for n in [0, 1, 31, 32, 33, 48, 49, 100]:
        at, row = toxicity.windows(np.array([0, n, n + 5]), -1)
        assert set(at[row == 0].ravel().tolist()) - {-1} == set(range(n)) and (row == 1).sum() == 1


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in toxicity.new_weights(4, 1).items()}
    width = toxicity.WORD_DIM + toxicity.CHAR_DIM + 2
    inputs, at, y = rng.standard_normal((6, width)), rng.integers(0, 6, (3, toxicity.WINDOW)), np.array([0.0, 1.0, 1.0])

    def loss():
        z = toxicity.logits(w, inputs, at).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))))

    g, _ = toxicity.gradients(w, inputs, at, y)
    for key in ("xf", "hb", "att", "out"):
        spot = np.unravel_index(np.abs(g[key]).argmax(), g[key].shape)
        kept, step = w[key][spot], 1e-2
        w[key][spot] = kept + step
        up = loss()
        w[key][spot] = kept - step
        down = loss()
        w[key][spot] = kept
        assert abs((up - down) / (2 * step) - g[key][spot]) < 0.05 * abs(g[key][spot]) + 1e-4


def test_scores_of_odd_rows(spark, make_docs, model):
    docs = make_docs([(1, None), (2, ""), (3, " \n"), (None, "wretch"), (5, "vermin " * 30000), (6, "same"), (6, "same")])
    got = toxicity.scored(docs, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[1][0].score == by[2][0].score == by[3][0].score and by[6][0].score == by[6][1].score
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert by[5][0].predicted == 1 and toxicity.scored(make_docs([]), model).collect() == []
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and 5 not in {r.doc_id for r in kept.collect()}


def test_fit_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(make_docs([(1, "a")]), none)
    assert [r.score for r in toxicity.scored(make_docs([(1, "a")]), model).collect()] == [0.5]
    odd = spark.createDataFrame([(1, 0, None), (None, 1, 1), (2, 1, 7)], "doc_id bigint, quality int, toxic int")
    assert "weights" not in toxicity.fit(make_docs([(1, "a"), (2, "b")]), odd)


def test_best_edges_against_all_choices():
    from itertools import combinations
    rng = random.Random(2)
    for _ in range(30):
        n, buckets = rng.randrange(1, 9), rng.randrange(1, 5)
        cells = np.array(sorted(rng.sample(range(1, 60), n)))
        counts = np.array([rng.randrange(1, 50) for _ in range(n)])
        cost = lambda edges: sum(c * min(e for e in edges if e >= x) for x, c in zip(cells, counts))
        want = min(cost([*c, cells[-1]]) for k in range(min(buckets, n)) for c in combinations(cells[:-1], k))
        got = packing.best_edges(cells, counts, buckets)
        assert cost(got) == want and len(got) <= buckets


def test_packing(make_docs):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 90))) for i in range(300)] + [(400, None), (401, "w " * 5000), (5, "w w"), (5, "w w"), (None, "w")]
    out = packing.packed_batches(make_docs(rows), buckets=4, token_budget=300, run=50).collect()
    assert sorted((str(r.doc_id), r.length) for r in out) == sorted((str(i), len((t or "").split())) for i, t in rows)
    batches = defaultdict(list)
    for r in out:
        assert r.bucket >= r.length and r.padding == r.bucket - r.length
        batches[r.batch_id].append(r)
    assert len({r.bucket for r in out}) <= 4
    for rs in batches.values():
        assert len({r.bucket for r in rs}) == 1
        assert len(rs) * rs[0].bucket <= max(300, rs[0].bucket)
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    assert packing.packed_batches(make_docs([])).collect() == []


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full = {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(full.values())
        free = sum(w for s, w in weight.items() if s not in full)
        target = {s: weight[s] * left / free for s in names if s not in full} if free else {}
        over = [s for s, t in target.items() if t > 2 * sizes[s]]
        if not over:
            return {**full, **target}
        full |= {s: 2.0 * sizes[s] for s in over}


def test_mixture(make_docs):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 30)), rng.choice(["a", "B", "é", "zz", "\U0001f600", None])) for i in range(2000)]
    rows += [(3000, None, "blank"), (3001, "", "blank"), (1, "w w", "a")]
    out = mixing.mixture(make_docs(rows)).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken in {r.size * int(r.rate), r.size * (int(r.rate) + 1)} and r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(out) == len(rows)
    assert all(abs(taken[s] - t) <= 0.1 * max(t, 1) for s, t in want.items())
    again = mixing.mixture(make_docs(rows)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)
    copies = Counter(r.doc_id for r in mixing.mixed(make_docs(rows)).collect())
    counted = Counter()
    for r in out:
        counted[r.doc_id] += r.copies
    assert copies == +counted
    assert mixing.mixture(make_docs([])).collect() == [] and mixing.mixed(make_docs([])).collect() == []


def test_registered_names():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 11)) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, small, name):
    from oracle_check import compare, database
    count, error = compare(QUERIES[name](spark, small), database(small), ORACLE_SQL[name])
    assert not error and count > 0


def test_pipeline(spark, small):
    import corpus_pipeline
    from tickmart.llm.suffix_dedup import repeated_bytes

    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    single = stages["ngram_jaccard"](spark, docs, small)
    assert single.columns == docs.columns
    single.write.mode("overwrite").parquet(path := corpus_pipeline.fresh_path(spark, "test"))
    single = spark.read.parquet(path)
    cut = stages["suffix_dedup"](spark, single, small)
    lost = repeated_bytes(single).agg({"n_removed": "sum"}).first()[0]
    size = lambda d: d.selectExpr("sum(octet_length(text))").first()[0]
    assert cut.columns == docs.columns and cut.count() == single.count() and 0 <= size(cut) - (size(single) - lost) < 0.01 * size(single)
    result = corpus_pipeline.run(spark, small)
    assert 0 < result.count() and "batch_id" in result.columns
    assert set(r.doc_id for r in result.select("doc_id").distinct().collect()) <= set(r.doc_id for r in docs.select("doc_id").collect())
