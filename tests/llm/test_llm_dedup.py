"""Near-duplicate join, fingerprints and substring removal against brute force."""

import hashlib
import random
import re

import pytest

from tickmart.llm import fingerprint, induced_sort, ngram_join, suffix_dedup

import numpy as np


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def prose(rng, n, vocabulary=500):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def variant(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    base = [prose(rng, rng.choice([3, 30, 120, 400])) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    hub = prose(rng, 150)
    rows += [(100 + i, variant(rng, hub, rng.randrange(5))) for i in range(40)]
    rows += [(200 + i, base[i % 4]) for i in range(10)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one two"), (304, "one two"), (305, prose(rng, 8000))]
    rows += [(306, rows[-1][1] + " tail")]
    return rows


def brute_links(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and jaccard(sets[i], sets[j]) >= threshold:
                links[i].add(j)
                links[j].add(i)
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in links:
            low = min([label[i], *(label[j] for j in links[i])])
            if low < label[i]:
                label[i], changed = low, True
    group = {}
    for i, root in enumerate(label):
        group.setdefault(root, []).append(rows[i][0])
    return {rows[i][0]: (min(group[label[i]]), len(links[i])) for i in links}


@pytest.mark.parametrize("block", [1024, 3])
def test_join_equals_brute_force(make_docs, corpus, block):
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(make_docs(corpus), block=block).collect()}
    assert got == brute_links(corpus)


def test_join_of_nothing_and_of_odd_rows(make_docs):
    assert ngram_join.near_duplicates(make_docs([])).collect() == []
    rows = [(None, "a b c d e f"), (None, None), (5, "a b c d e f"), (5, "a b c d e f"), (6, None)]
    got = sorted(((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in ngram_join.near_duplicates(make_docs(rows)).collect()), key=repr)
    assert got == sorted([(None, 5, 5, 2), (None, None, None, 0), (5, 5, 5, 2), (5, 5, 5, 2), (6, 6, 6, 0)], key=repr)


def test_pruning_keeps_what_may_reach_the_threshold():
    fewest = ngram_join.fewest_matches(0.8, 1e-9)
    assert list(fewest) == list(range(16, 129, 16))
    assert 0 < fewest[16] < 16 and 64 < fewest[128] < 100
    assert ngram_join.fewest_matches(0.8, 0.05)[128] > fewest[128]


def test_one_document_of_each_group_stays(make_docs, corpus):
    docs = make_docs(corpus + [(305, corpus[-2][1])])
    kept = ngram_join.one_of_each_group(docs)
    want = {c for c, _ in brute_links(corpus).values()}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def brute_repeats(rows):
    seen, out = set(), {}
    for key, text in rows:
        b = (text or "").encode()
        cover = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                cover[s:s + 100] = b"\1" * 100
            else:
                seen.add(b[s:s + 100])
        spans = sum(1 for i in range(len(b)) if cover[i] and (i == 0 or not cover[i - 1]))
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.setdefault(key, []).append((len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(9)
    shared = [prose(rng, 60) for _ in range(4)] + ["ä" * 130, "ab" * 200, "x" * 5000]
    rows = []
    for i in range(40):
        parts = [prose(rng, rng.randrange(40)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(40)
            parts.insert(rng.randrange(3), s[a:a + rng.randrange(90, 400)])
        rows.append((i, rng.choice([" ", "", "\n"]).join(parts)))
    rows += [(50, rows[3][1]), (51, rows[3][1]), (52, None), (53, ""), (54, "short"), (55, "y" * 99), (56, "y" * 100), (57, "y" * 101)]
    return rows + [(58, rows[0][1] + rows[1][1] + prose(rng, 3000)), (59, "\0" * 300 + "nul" * 50)]


@pytest.mark.parametrize("hot,queue_bytes", [(5000, 1 << 20), (0, 2000)])
def test_repeats_equal_brute_force(make_docs, passages, monkeypatch, hot, queue_bytes):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 6000)
    got = {r.doc_id: [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)]
           for r in suffix_dedup.repeated_bytes(make_docs(passages), hot, queue_bytes).collect()}
    assert got == brute_repeats(passages)


def test_repeats_of_nothing_and_of_odd_rows(make_docs):
    assert suffix_dedup.repeated_bytes(make_docs([])).collect() == []
    text = prose(random.Random(1), 50)
    got = sorted(((r.doc_id, r.n_removed == r.n_bytes) for r in suffix_dedup.repeated_bytes(
        make_docs([(2, text), (2, text), (None, text), (3, text[20:] + "end")])).collect()), key=repr)
    assert got == sorted([(2, False), (2, True), (None, True), (3, False)], key=repr)


def test_kept_texts(make_docs, passages):
    docs = make_docs(passages)
    out = suffix_dedup.without_repeats(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and len(got) == len(passages)
    assert got[50].text == "" and got[55].text == "y" * 99
    assert got[52].text is None and got[52].n_chars is None
    want, given = brute_repeats(passages), dict(passages)
    for r in got.values():
        if r.text is not None:
            assert r.n_chars == len(r.text)
            if "ä" not in given[r.doc_id]:
                assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][0][3]


def test_induced_order_and_common_prefixes():
    rng = np.random.default_rng(0)
    for k in range(60):
        body = bytes(rng.integers(97, 98 + k % 4, int(rng.integers(0, 80))).astype(np.uint8)) + b"ab" * (k % 5 * 30)
        text = np.concatenate([np.frombuffer(body, np.uint8), np.zeros(induced_sort.PAD, np.uint8)])
        steps = list(induced_sort.suffix_runs(text, 300 if k % 2 else 1 << 20))
        place = np.concatenate([p for p, _ in steps]) if steps else np.zeros(0, int)
        prefix = np.concatenate([c for _, c in steps]) if steps else place
        padded = text.tobytes()
        suffixes = [padded[p:p + 100] for p in place]
        assert sorted(place.tolist()) == list(range(len(body)))
        for i in range(1, len(suffixes)):
            a, b = suffixes[i - 1], suffixes[i]
            assert a >= b
            same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[i] == same


def test_fingerprints(make_docs, corpus):
    rows = sorted(corpus)
    for size in (2048, 7):
        got = {r.doc_id: r for r in fingerprint.edited_likeness(make_docs(corpus), range_rows=size).collect()}
        assert len(got) == len(rows)
        for i, (key, text) in enumerate(rows):
            text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
            edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
            r = got[key]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            if len(shingles(text) | shingles(edited)) > 300:
                assert abs(r.near_edited - jaccard(shingles(text), shingles(edited))) < 0.15
    by_text = {}
    for key, text in rows:
        by_text.setdefault(text or "", set()).add(got[key].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    assert fingerprint.edited_likeness(make_docs([])).collect() == []
    alone = fingerprint.edited_likeness(make_docs([(1, "a b c d e f")])).collect()[0]
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"a b c a b c"[:6] + b"a b c").hexdigest()
    twice = fingerprint.edited_likeness(make_docs([(1, "a"), (1, "a"), (None, None), (2, "b")])).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["1", "1", "2", "None"]


def test_sketches_merge_and_estimate_containment(spark, make_docs):
    rng = random.Random(5)
    long_ = prose(rng, 6000, 10**6)
    part = " ".join(long_.split()[1000:2000])
    made = fingerprint.sketches(make_docs([(1, long_), (2, part), (3, None)])).withColumnRenamed("doc_id", "name")
    rows = {r.name: r for r in made.collect()}
    assert rows[3].sketch == [] and set(rows[2].sketch) - set(rows[1].sketch) == set()
    assert abs(len(rows[1].sketch) / rows[1].n_shingles - 1 / fingerprint.SCALE) < 0.03
    from pyspark.sql import functions as F
    joined = made.where("name = 2").select(F.col("sketch").alias("a")).crossJoin(made.where("name = 1").select(F.col("sketch").alias("b")))
    assert joined.select(fingerprint.containment(F.col("a"), F.col("b"))).first()[0] == 1.0
    assert fingerprint.merged(made.withColumn("all", F.lit(1)), "all").count() == len(rows[1].sketch)
