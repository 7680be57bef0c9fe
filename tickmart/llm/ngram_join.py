"""Near-duplicate join on word shingles: MinHash candidates, Bayesian pruning, exact verification.

Documents with the same set of shingles form one class and take part once. Classes that agree on all rows of
a MinHash band meet in a bucket. Inside a bucket the two signatures are compared piece by piece, and a pair is
given up as soon as the posterior probability that its similarity reaches the threshold falls below the
tolerance; what is left is decided on the shingle sets themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickmart.llm.components import components
from tickmart.llm.packed import pack_texts, unpack_batches
from tickmart.llm.scratch import stored
from tickmart.llm.text_arrays import column_buffer, slices, text_shingles

WIDTH = 5
THRESHOLD = 0.8
#: A pair is dropped when it reaches the threshold with a smaller probability than this.
TOLERANCE = 1e-9
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
#: Members of a bucket that one task compares with as many others; larger buckets are dealt out in pairs of blocks.
BLOCK = 1024
#: Bytes of shingles of a pair of blocks that a task holds at a time; larger pairs are compared in ranges of the hashes.
RANGE_BYTES = 16 << 20
#: Bytes of text that are signed together; a longer text is signed alone.
SIGNED_BYTES = 4 << 20

_rng = np.random.Generator(np.random.PCG64(5))
_FLIP = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_SCALE = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def fewest_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For 16, 32, ... compared hashes the fewest agreements with which a pair stays.

    With a uniform prior, m agreements of n leave Beta(m + 1, n - m + 1); its mass above the threshold is a
    binomial sum.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every row."""
    for a, b, hashes, at in text_shingles(column, width):
        for i in range(b - a):
            yield np.unique(hashes[at[i]:at[i + 1]])


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 128 minima for each set; no set may be empty."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    short = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat((short ^ _FLIP[k]) * _SCALE[k], starts)
    return out


def _text_parts(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``rows`` rows and about ``SIGNED_BYTES`` of the text in the second column."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        for a, b in slices(column_buffer(part.column(1))[1], SIGNED_BYTES):
            yield part.slice(a, b - a)


def hash_ranges(shingles: np.ndarray, number: int) -> list[np.ndarray]:
    """Sorted shingles cut at equal steps of the hashes; ``number`` is a power of two."""
    step = np.uint64(65 - number.bit_length())
    bounds = np.arange(1, number, dtype=np.uint64) << step if number > 1 else np.zeros(0, np.uint64)
    return np.split(shingles, np.searchsorted(shingles, bounds))


def signed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, sid, n_shingles, sig)``: shingle set key and MinHash signature, null for texts without words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text_parts(batch, 512):
                sets = list(shingle_sets(part.column(1), width))
                full = [s for s in sets if len(s)]
                sigs = iter(minhashes(full) if full else ())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([next(sigs).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "sid", "n_shingles", "sig"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, sid binary, n_shingles int, sig binary")


def _bucket_keys(classes: DataFrame) -> DataFrame:
    """``(band, key, sid, n_shingles)``, one row for each class and band."""
    part = F.substring("sig", F.col("band") * (4 * ROWS) + 1, F.lit(4 * ROWS))
    return (classes.select("sid", "sig", "n_shingles", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
            .select("band", F.xxhash64("band", part).alias("key"), "sid", "n_shingles"))


def _shared_buckets(keys: DataFrame) -> DataFrame:
    """Buckets with two members or more; those with the same members become one with the bits of all their bands.

    Membership is compared by two order-free sums, so no bucket is gathered anywhere.
    """
    size = F.count("*").alias("members"), F.sum(F.col("n_shingles").cast("long")).alias("volume")
    marks = (F.sum(F.xxhash64("sid").cast("decimal(20,0)")).alias("m1"), F.bit_xor(F.xxhash64(F.lit(7), "sid")).alias("m2"))
    many = keys.groupBy("band", "key").agg(*size, *marks).where("members > 1")
    return (many.groupBy("members", "m1", "m2")
            .agg(F.min("key").alias("key"), F.bit_or(F.expr("shiftleft(1L, band)")).alias("mask"), F.max("volume").alias("volume"))
            .select("key", "mask", "members", "volume"))


class _Bucket:
    """Members of one pair of blocks of one bucket, of whose shingle sets one range of hashes is held at a time."""

    def __init__(self, rows: list[dict], threshold: float, fewest: dict[int, int]):
        self.rows = [{k: v for k, v in r.items() if k != "shingles"} for r, new in zip(rows, _new_members(rows)) if new]
        self.threshold = threshold
        self.sig = np.frombuffer(b"".join(r["sig"] for r in self.rows), np.uint32).reshape(-1, HASHES)
        self.copies = np.array([r["copies"] for r in self.rows], np.int64)
        self.size = np.array([r["n_shingles"] for r in self.rows], np.int64)
        self.block = np.array([r["block"] for r in self.rows])
        self.partners = {}
        for i, r in enumerate(self.rows):
            if r["low"] == r["high"] or self.block[i] == r["low"]:
                found = self.candidates(i, fewest)
                if len(found):
                    self.partners[i] = found.astype(np.int32)
        self.shared = {i: np.zeros(len(p), np.int32) for i, p in self.partners.items()}

    def add(self, rows: list[dict]) -> None:
        """Count the shingles that candidates share in one range; rows come in the order of the members."""
        if not self.partners:
            return
        held = np.array([len(r["shingles"]) // 8 for r in rows])
        member = np.cumsum(_new_members(rows)) - 1
        size = np.bincount(member, held, len(self.rows)).astype(np.int64)
        values, flat = np.unique(np.frombuffer(b"".join(r["shingles"] for r in rows), np.uint64), return_inverse=True)
        mark = np.zeros(len(values), bool)
        at = np.concatenate([[0], np.cumsum(size)])
        for i, partners in self.partners.items():
            if not size[i]:
                continue
            full = np.flatnonzero(size[partners])
            if not len(full):
                continue
            mark[flat[at[i]:at[i + 1]]] = True
            sizes = size[partners[full]]
            self.shared[i][full] += np.add.reduceat(mark[np.concatenate([flat[at[j]:at[j + 1]] for j in partners[full]])].astype(np.int32),
                                                    np.cumsum(sizes) - sizes)
            mark[flat[at[i]:at[i + 1]]] = False

    def candidates(self, i: int, fewest: dict[int, int]) -> np.ndarray:
        """Partners of member i that share their first band here and survive the pruning."""
        low, high = self.rows[i]["low"], self.rows[i]["high"]
        others = np.arange(i + 1, len(self.rows)) if low == high else np.flatnonzero(self.block == high)
        same = self.sig[i] == self.sig[others]
        bands = same.reshape(-1, BANDS, ROWS).all(axis=2)
        mine = (self.rows[i]["mask"] >> bands.argmax(axis=1)) & 1
        keep = np.flatnonzero(bands.any(axis=1) & (mine == 1))
        matches = np.zeros(len(keep), np.int64)
        for n, least in fewest.items():
            matches += same[keep, n - STEP:n].sum(axis=1)
            alive = matches >= least
            keep, matches = keep[alive], matches[alive]
        return others[keep]

    def links(self) -> Iterator[tuple[bytes, int, bytes | None]]:
        """For every member with links here: its links, and the root of the links' spanning stars."""
        n = len(self.rows)
        found, parent = np.zeros(n, np.int64), list(range(n))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i, partners in self.partners.items():
            shared = self.shared[i]
            linked = partners[shared / (self.size[i] + self.size[partners] - shared) >= self.threshold]
            found[i] += self.copies[linked].sum()
            found[linked] += self.copies[i]
            for j in linked:
                a, b = root(i), root(int(j))
                if a != b:
                    parent[max(a, b)] = min(a, b)
        for i in np.flatnonzero(found):
            top = root(int(i))
            yield self.rows[i]["sid"], int(found[i]), self.rows[top]["sid"] if top != i else None


def _new_members(rows: list[dict]) -> list[bool]:
    """Where the next member begins; every member has all its pieces of the range, also empty ones."""
    return [i == 0 or r["sid"] != rows[i - 1]["sid"] for i, r in enumerate(rows)]


def _linked(threshold: float, tolerance: float):
    fewest = fewest_matches(threshold, tolerance)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        name, bucket = None, None
        for this, group in _groups(batches):
            if this[:-1] != name:
                if bucket:
                    out.extend(bucket.links())
                name, bucket = this[:-1], _Bucket(group, threshold, fewest)
            bucket.add(group)
            if len(out) >= 10_000:
                yield _link_batch(out)
                out = []
        if bucket:
            out.extend(bucket.links())
        yield _link_batch(out)

    return rows


def _link_batch(out: list[tuple]) -> pa.RecordBatch:
    sid, links, parent = zip(*out) if out else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(sid, pa.binary()), pa.array(links, pa.int64()), pa.array(parent, pa.binary())],
                                      names=["sid", "links", "parent"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Name and rows of one range of one pair of blocks at a time, from input sorted by it."""
    group: list[dict] = []
    name = None
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in batch.slice(at, 256).to_pylist():
                this = (row["key"], row["mask"], row["low"], row["high"], row["range"])
                if this != name and group:
                    yield name, group
                    group = []
                name = this
                group.append(row)
    if group:
        yield name, group


def _wanted_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(sid, pieces, piece, shingles)`` of the wanted ``(doc_id, sid, pieces)``; texts travel compressed.

    A class none of whose rows has an id is found by the key of its set, among the rows without id.
    """
    packed = pack_texts(docs.where("doc_id IS NOT NULL"))
    kind = "sid binary, pieces int, piece int, shingles binary"

    def split(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int32(), pa.int32(), pa.binary()))],
                                          names=["sid", "pieces", "piece", "shingles"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sids, pieces, texts in unpack_batches(batches, 3):
            yield split([(sid, n, p, part.tobytes()) for sid, n, s in zip(sids, pieces, shingle_sets(texts, width)) if set_key(s) == sid
                         for p, part in enumerate(hash_ranges(s, n))])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in shingle_sets(batch.column(0), width):
                yield split([(set_key(s), 1, 0, s.tobytes())] if len(s) else [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, n, s in zip(*(c.to_pylist() for c in batch.columns)):
                yield split([(sid, n, p, part.tobytes()) for p, part in enumerate(hash_ranges(np.frombuffer(s, np.uint64), n))])

    named = packed.join(wanted.where("doc_id IS NOT NULL").hint("merge"), "doc_id").select("doc_id", "sid", "pieces", "packed").mapInArrow(rows, kind)
    loose = docs.where("doc_id IS NULL").select("text").mapInArrow(keyed, kind).select("sid", "shingles").dropDuplicates(["sid"])
    loose = loose.join(wanted.where("doc_id IS NULL").select("sid", "pieces"), "sid").select("sid", "pieces", "shingles").mapInArrow(cut, kind)
    return named.unionByName(loose)


def _judged(docs: DataFrame, threshold: float, width: int, tolerance: float, block: int, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Every row with the key of its shingle set, and every set's ``sid, copy_of, n_links, root``; groups share a root."""
    base = stored(signed(docs, width), "signatures")
    classes = base.where("sid IS NOT NULL").groupBy("sid").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("copy_of"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    classes = stored(classes, "classes")
    keys = _bucket_keys(classes)
    blocks = F.ceil(F.col("members") / block).cast("int")
    size = F.col("volume") * 8 * F.least(F.lit(2), "blocks") / F.col("blocks") / range_bytes
    ranges = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(size, F.lit(1.0))))).cast("int")
    shared = _shared_buckets(keys).withColumn("blocks", blocks).withColumn("ranges", ranges).drop("volume")
    members = stored(keys.drop("band", "n_shingles").join(shared, "key"), "members")

    finest = members.groupBy("sid").agg(F.max("ranges").alias("pieces"))
    wanted = classes.join(finest, "sid").select(F.col("copy_of").alias("doc_id"), "sid", "pieces")
    sets = _wanted_sets(docs, wanted, width).dropDuplicates(["sid", "piece"])
    facts = sets.join(classes.select("sid", "copies", "sig", "n_shingles"), "sid")

    mine = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda o: F.struct(F.least(o, "block").alias("low"), F.greatest(o, "block").alias("high")))
    dealt = (members.withColumn("block", mine).select("key", "mask", "sid", "ranges", "block", F.explode(pairs).alias("p"))
             .select("key", "mask", "sid", "ranges", "block", "p.low", "p.high").join(facts, "sid")
             .withColumn("range", F.expr("cast(piece div (pieces div ranges) as int)")).drop("ranges", "pieces"))
    links = stored(dealt.repartition("key", "mask", "low", "high").sortWithinPartitions("key", "mask", "low", "high", "range", "sid", "piece")
                   .mapInArrow(_linked(threshold, tolerance), "sid binary, links bigint, parent binary"), "links")

    roots = components(links.where("parent IS NOT NULL").select(F.col("sid").alias("a"), F.col("parent").alias("b")))
    counts = links.groupBy("sid").agg(F.sum("links").alias("links"))
    each = (classes.select("sid", "copies", "copy_of").join(counts, "sid", "left")
            .join(roots.withColumnRenamed("node", "sid"), "sid", "left")
            .select("sid", "copy_of", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("root", "sid").alias("root")))
    return base, each


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, tolerance: float = TOLERANCE,
                    block: int = BLOCK, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Groups of documents whose Jaccard similarity of word shingles reaches ``threshold``.

    One row per input row: ``doc_id``; ``class_id``, the smallest doc_id of the group that links connect;
    ``copy_of``, the smallest doc_id with the same shingles; ``n_links``, the number of other documents at or
    above the threshold, copies counted one by one; ``n_shingles``.

    Words are split at ASCII blanks and compared as they are; a text of one to four words is one shingle.
    Null and blank texts have no shingles and no links: class_id and copy_of are their own doc_id. Repeated
    rows are copies of each other. Rows without doc_id keep null as their id and link like others; a group none of
    whose rows has an id has none either. Other columns are ignored. An empty table gives an empty result.

    128 hashes in 32 bands miss a pair at exactly 0.8 with probability 5e-8, the pruning at most about
    as rarely per look. Pairs are decided inside the tasks, and only counts and spanning stars leave them, so a
    group of thousands of variants does not become millions of rows. A task compares two blocks of at most about
    ``block`` members; where their sets have more than ``range_bytes``, range by range of the hashes.
    """
    base, each = _judged(docs, threshold, width, tolerance, block, range_bytes)
    tops = each.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    named = each.join(tops, "root").drop("root")
    return (base.drop("sig").join(named, "sid", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copy_of", "doc_id").alias("copy_of"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_shingles"))


def _set_keys(rows: DataFrame, width: int) -> DataFrame:
    """``row`` and ``sid`` of ``(row, text)``; no key for a text without words."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [set_key(s) if len(s) else b"" for s in shingle_sets(batch.column(1), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], names=["row", "sid"])

    schema = T.StructType([rows.schema["row"], T.StructField("sid", T.BinaryType())])
    return rows.mapInArrow(keyed, schema)


def one_of_each_group(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, tolerance: float = TOLERANCE,
                      block: int = BLOCK, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The documents with one row of each near-duplicate group, of the smallest doc_id, and all columns.

    Rows are judged by their own texts: of two texts that share a doc_id each stays or goes with its group, and if one
    group has both, the one with the smaller shingle key counts. Of rows alike in doc_id and shingles the one with the smallest
    text stays (of equal texts, that with the smallest JSON form of the other columns). A group without any id keeps one row
    too. Texts without words have no group: they stay, one of each doc_id, and all of those without doc_id. An
    empty table stays empty.
    """
    base, each = _judged(docs, threshold, width, tolerance, block, range_bytes)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.struct(F.coalesce("row.text", F.lit("")), F.to_json(F.struct(F.lit(0), *[F.col("row")[c] for c in rest])))

    def one(rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.min_by("row", order).alias("row")).select("row.*")

    first = F.min(F.struct(F.col("copy_of").isNull().alias("loose"), F.col("copy_of").alias("doc_id"), "sid"))
    groups = each.groupBy("root").agg(first.alias("first")).select("first.doc_id", "first.sid")
    blank = base.where("sid IS NULL").select("doc_id", F.lit(b"").alias("sid"))
    chosen = stored(groups.unionByName(blank).distinct(), "chosen")
    sid = F.coalesce("sid", F.lit(b""))
    several = base.where("doc_id IS NOT NULL").groupBy("doc_id").agg((F.min(sid) != F.max(sid)).alias("several")).where("several").select("doc_id")
    several = stored(several, "several")

    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    numbered = rows.where("doc_id IS NOT NULL").drop("text")
    plain = numbered.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").join(several, "doc_id", "left_anti")
    apart = _set_keys(rows.join(several, "doc_id", "left_semi").select("row", "text"), width).withColumn("doc_id", F.col("row.doc_id"))
    loose = _set_keys(rows.where("doc_id IS NULL").select("row", "text"), width)
    unnamed = chosen.where("doc_id IS NULL AND sid <> X''").select("sid")
    kept = [one(plain, "doc_id"), one(apart.join(chosen, ["doc_id", "sid"], "left_semi"), "doc_id", "sid"),
            one(loose.join(unnamed, "sid", "left_semi"), "sid"), loose.where("sid = X''").select("row.*")]
    return reduce(DataFrame.unionByName, kept).select(*docs.columns)
