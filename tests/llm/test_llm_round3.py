"""Lattice near-duplicates, the prefix trie and source divergence against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tickmart.llm import divergence, lattice, prefix_trie

VECTORS = "vec_id bigint, embedding array<float>, label int, cid string, cell string, n_links int, digest string"


def vectors(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], lab, "x", "y", 1, "z") for i, v, lab in rows], schema)


def brute_components(rows, threshold=0.93, kind=np.float32):
    unit = []
    for _, v, lab in rows:
        x = None if v is None or lab is None or not len(v) or any(c is None for c in v) else np.array(v, kind).astype(float)
        unit.append(None if x is None or not np.isfinite(x).all() or not x.any() else (lab, x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())))
    near = [[j for j, b in enumerate(unit) if j != i and a is not None and b is not None and a[0] == b[0] and len(a[1]) == len(b[1])
             and a[1] @ b[1] >= threshold] for i, a in enumerate(unit)]
    root = [None] * len(rows)
    for i in range(len(rows)):
        if root[i] is None:
            todo, group = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in group if rows[j][0] is not None]
            for j in group:
                root[j] = (min(ids) if ids else None,)
    return sorted(((r[0], len(near[i]), root[i][0], r[0] is not None and r[0] == root[i][0]) for i, r in enumerate(rows)), key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def around(rng, x, cosine):
    g = rng.standard_normal(len(x))
    x = x / np.linalg.norm(x)
    g -= (g @ x) * x
    return cosine * x + np.sqrt(1 - cosine**2) * g / np.linalg.norm(g)


@pytest.mark.parametrize("block", [1024, 9])
def test_lattice_links_against_brute_force(spark, block):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(260):
        rows.append((i, rng.standard_normal(24), i % 2))
    for i in range(260, 320):  # chains: each close to the one before
        rows.append((i, around(rng, rows[i - 20][1], rng.choice([0.96, 0.98, 0.995])), rows[i - 20][2]))
    hub = rng.standard_normal(24)
    rows += [(i, around(rng, hub, 0.99), 1) for i in range(400, 440)]  # one large group
    rows += [(i, hub, 1) for i in range(450, 460)] + [(455, hub, 1), (None, hub, 1), (470, hub, 0), (471, hub, None)]
    rng.shuffle(rows)
    assert found(lattice.near_duplicates(vectors(spark, rows), block=block)) == brute_components(rows)


def test_lattice_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0], 0), (2, None, 0), (3, [0, 0], 0), (4, [1, None], 0), (5, [nan, 1], 0), (6, [inf, 1], 0), (7, [], 0), (8, [1, 0, 0], 0),
            (9, [1e-30, 0], 0), (10, [1e30, 1e28], 0), (11, [-1, 0], 0), (12, [1, 0], None), (None, [1, 0], 0), (None, [0, 1], 0), (None, None, None), (2, None, 0),
            (13, [0, 1], 0), (14, [-0.0, 1], 0)]
    assert found(lattice.near_duplicates(vectors(spark, rows))) == brute_components(rows)
    wide = VECTORS.replace("float", "double").replace("label int", "label string")
    rows = [(i, [v[0] * 1e200, v[1] * 1e200] if v and len(v) == 2 and None not in v else v, None if lab is None else f"l{lab}") for i, v, lab in rows]
    assert found(lattice.near_duplicates(vectors(spark, rows, wide))) == brute_components(rows, kind=np.float64)
    assert found(lattice.near_duplicates(vectors(spark, []))) == []
    assert found(lattice.near_duplicates(vectors(spark, rows[1:2], wide))) == [(2, 0, 2, True)]


def test_decoding_finds_the_nearest_lattice_point():
    near = lattice.shortest_vectors()
    assert len(np.unique(near, axis=0)) == 240 and np.allclose((near**2).sum(axis=1), 2)
    x = np.random.default_rng(3).standard_normal((2000, 8)) * 2
    z = lattice.nearest_point(x)
    assert ((2 * z) % 2 == (2 * z[:, :1]) % 2).all() and (z.sum(axis=1) % 2 == 0).all()
    d = ((x - z) ** 2).sum(axis=1)
    assert (d <= 1 + 1e-9).all()
    assert all(((x[i] - z[i] - near) ** 2).sum(axis=1).min() >= d[i] - 1e-9 for i in range(200))


def test_recall_at_the_threshold():
    """Pairs at cosine 0.93 exactly, the hardest there are."""
    rng = np.random.default_rng(4)
    x = lattice.unit_rows(rng.standard_normal((1500, 64)))
    y = np.array([around(rng, v, 0.93) for v in x])
    none = np.zeros(len(x), np.uint64)
    a, b = lattice.lattice_cells(x, none), lattice.lattice_cells(y, none)
    met = np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
    far = np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, np.roll(b, 1, axis=0))])
    assert met > 0.98 and far < 0.002
    assert (lattice.lattice_cells(x[7:8], none[:1]) == a[7:8]).all()


def rebuilt(rows):
    """Ids and turns of every rebuilt conversation, of (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    own = {c: [v[3:] for v in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(int(c - np.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def brute_trie(rows):
    convs = rebuilt(rows)
    nodes = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, m in nodes.items():
        gain = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += gain
    out = []
    for p, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id bigint, turn bigint, role string, text string, path string, name string, depth string, n string"


def talk(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], TURNS)


def trie(frame, **how):
    return sorted((tuple(r) for r in prefix_trie.prefix_nodes(frame, **how).select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("shard_turns", [20_000, 40, 1])
def test_trie_against_brute_force(spark, shard_turns):
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 130), 205, 306, 400, 512, *range(-105, -95), 10**12 + 3]:
        said = ["hello", "ok"][: rng.randrange(3)] + [f"w{rng.randrange(3)} é" for _ in range(rng.randrange(7))]
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", x) for t, x in enumerate(said)]
    rows += [(c, t, "user", "the same") for c in range(700, 760) for t in range(9)]  # equal conversations
    rows += [(900, t, "user", f"long {t}") for t in range(300)] + [(901, t, "user", f"long {t}") for t in range(298)]
    rng.shuffle(rows)
    assert trie(talk(spark, rows), shard_turns=shard_turns) == brute_trie(rows)


def test_trie_odd_rows(spark):
    rows = [(1, None, "user", "a"), (1, 0, None, "b"), (1, 0, None, "b"), (1, 0, "", None), (2, 3, "user", None), (2, None, None, None), (None, 0, "user", "x"),
            (100, 0, "user", "x" * 300_000), (100, 1, "u", "ser"), (101, 0, "us", "er"), (7, 0, "user", ":"), (7, 1, "user:", "")]
    assert trie(talk(spark, rows)) == brute_trie(rows)
    assert trie(talk(spark, rows), shard_turns=1) == brute_trie(rows)
    assert trie(talk(spark, [])) == [] and trie(talk(spark, [(None, 0, "user", "x")])) == []
    alone = next(c for c in range(1, 50) if zlib.crc32(str(c).encode()) % 6)
    assert trie(talk(spark, [(alone, 0, "user", "x")])) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_double_array_holds_every_path():
    rng = random.Random(6)
    arrays = prefix_trie.DoubleArray(4)
    codes = {0: sorted(rng.sample(range(5000), 700))}
    todo, made = [0], {}
    while todo and len(made) < 3000:
        s = todo.pop(0)
        mine = codes.get(s) or sorted(rng.sample(range(5000), rng.choice([1, 1, 1, 2, 5])))
        arrays.add_children(s, np.array(mine))
        for c in mine:
            made[s, c] = int(arrays.child(np.array([s]), np.array([c]))[0])
            todo.append(made[s, c])
    assert len(set(made.values())) == len(made) and 0 not in made.values()
    assert all(arrays.base[s] + c == p and arrays.check[p] == s for (s, c), p in made.items())


def brute_divergence(rows):
    docs = [(lang or "", src or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, src in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df, n = defaultdict(int), defaultdict(lambda: defaultdict(int))
        for _, src, words in mine:
            n[src]
            for w in set(words):
                df[w] += 1
            for w in words:
                n[src][w] += 1
        kept = [w for w in df if df[w] >= 3]

        def share(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 1) // (total + len(kept)) for w in kept}

        p = {s: share(n[s]) for s in n}
        q = share({w: sum(n[s][w] for s in n) for w in kept})
        for s in p:
            pairs = [(-sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept), o.encode()) for o in p if o != s]
            terms = [(-((p[s][w] - q[w]) ** 2 // q[w]), w.encode()) for w in kept if n[s][w] > 0 and p[s][w] > q[w]]
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", o.decode(), -v, i + 1) for i, (v, o) in enumerate(sorted(terms)[:200])]
    return sorted(out)


def audit(spark, rows):
    schema = "text string, lang string, source string, term string, n bigint, place int, item string, value int, kept int, counted int"
    made = divergence.source_divergence(spark.createDataFrame([(*r, "a", 1, 2, "b", 3, 4, 5) for r in rows], schema))
    return sorted(tuple(r) for r in made.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("small", [False, True])
def test_divergence_against_brute_force(spark, monkeypatch, small):
    if small:
        for name, n in {"SHARD_ROWS": 50, "SHARD_SOURCES": 2, "CELLS": 30, "GATHERED": 40, "SPLIT_BYTES": 200}.items():
            monkeypatch.setattr(divergence, name, n)
    rng = random.Random(7)
    words = [f"w{a}{b}é" for a in "abcdefghijklmnop" for b in "abcdefghijklmnopqrstuvwxyz"] + ["Été", "ÉTÉ", "the", "THE", "naïve", "ßa", "日本"]
    rows = []
    for i in range(160):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", "s3", None])
        rows.append((rng.choice([" ", "1\n", ", "]).join(rng.choices(words, k=rng.choice([0, 3, 40]))), lang, source))
    rows += [(None, "en", "quiet"), ("", "fr", "s1"), ("12 34 !", "fr", "s2"), ("a\x00b_c`d{e\x7ff[g", "de", "s1"), ("one two", "it", "only")]
    rows += [rows[0]] * 5 + [("the " * 30_000 + "wabé", "en", "s1")]
    assert audit(spark, rows) == brute_divergence(rows)


def test_divergence_top_and_empty(spark):
    rows = [(" ".join(f"{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}" for i in range(600)), "en", s) for s in "aab"] + [("zz zz", "en", "c")] * 3
    got = audit(spark, rows)
    assert got == brute_divergence(rows) and sum(r[:3] == ("en", "a", "term") for r in got) == 200  # ties at the last rank
    assert audit(spark, []) == []
    assert audit(spark, [("x", "en", "a"), ("y", "en", "b")]) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_shares_are_exact():
    rng = random.Random(8)
    for _ in range(300):
        total = rng.randrange(1, 9 * 10**15)
        count = rng.randrange(0, total)
        assert int(divergence.shares(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * (count + 1) // total


def test_split_counts_fold_ascii_only():
    got = divergence.split_counts(pa.array(["Aa aA É é", "", None, "x1x"])).to_pylist()
    assert sorted((r["row"], r["term"], r["n"]) for r in got) == [(0, "aa", 2), (0, "É", 1), (0, "é", 1), (3, "x", 2)]
