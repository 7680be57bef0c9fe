"""Work of one task is bounded by bytes, whatever the corpus repeats."""

import random
from collections import Counter

import numpy as np
import pytest

from tickmart.llm import ngram_join, packing, suffix_dedup

from test_llm_dedup import brute_links, brute_repeats, prose, variant


def shard_bytes(segments):
    held = Counter()
    for r in segments.where("blob IS NOT NULL").collect():
        held[r.part] += len(suffix_dedup._unpacked(r.blob)[4])
    return held


def outcome(frame):
    return {r.doc_id: [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)] for r in frame.collect()}


def test_shards_follow_the_bytes_of_repeated_spans(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 30_000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 40_000)
    rng = random.Random(21)
    base = [prose(rng, 350, 10**6) for _ in range(40)]
    rows = [(i, prose(rng, 10, 10**6) + base[i % 40]) for i in range(80)]
    chunks, segments, shards = suffix_dedup._dealt(make_docs(rows), suffix_dedup.HOT_BYTES)
    held = shard_bytes(segments)
    assert sum(held.values()) > 400_000 and shards >= sum(held.values()) // 20_000
    assert max(held.values()) < 60_000
    assert outcome(suffix_dedup.repeated_bytes(make_docs(rows))) == brute_repeats(rows)


def test_an_anchor_with_many_edges_is_dealt_by_stretches(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 50_000)
    rng = random.Random(22)
    passage = prose(rng, 40, 10**6)
    rows = [(i, prose(rng, 15, 10**6) + passage + prose(rng, 15, 10**6)) for i in range(300)]
    whole = max(shard_bytes(suffix_dedup._dealt(make_docs(rows), suffix_dedup.HOT_BYTES)[1]).values())
    chunks, segments, shards = suffix_dedup._dealt(make_docs(rows), 5000)
    held = shard_bytes(segments)
    assert sum(held.values()) <= 50_000 * shards
    assert len(held) > 10 and max(held.values()) < 100_000 and whole < 512 << 10
    assert outcome(suffix_dedup.repeated_bytes(make_docs(rows), 5000)) == brute_repeats(rows)


@pytest.mark.parametrize("block", [1024, 7])
def test_long_near_copies_are_compared_range_by_range(make_docs, monkeypatch, block):
    rng = random.Random(23)
    hubs = [prose(rng, n, 10**6) for n in (900, 120)]
    rows = [(i, variant(rng, hubs[i % 2], rng.randrange(12 if i % 2 == 0 else 4))) for i in range(50)]
    rows += [(60, "one two"), (61, rows[0][1]), (62, None)]

    def held(self, rows, add=ngram_join._Bucket.add):
        assert sum(len(r["shingles"]) for r in rows) < 20_000
        add(self, rows)

    monkeypatch.setattr(ngram_join._Bucket, "add", held)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(make_docs(rows), block=block, range_bytes=8000).collect()}
    assert got == brute_links(rows)
    whole = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert [len(ngram_join.hash_ranges(whole, n)) for n in (1, 2, 64)] == [1, 2, 64]
    assert (np.concatenate(ngram_join.hash_ranges(whole, 64)) == whole).all()


def test_a_bucket_is_padded_to_its_longest_document(make_docs):
    rows = [(i, "w " * n) for i, n in enumerate([0, 1, 3, 700, 1025, 1025, 2049, 5001])]
    out = packing.packed_batches(make_docs(rows), buckets=3).collect()
    longest = {}
    for r in out:
        longest[r.bucket] = max(longest.get(r.bucket, 1), r.length)
    assert len(out) == len(rows) and all(b == n for b, n in longest.items())
