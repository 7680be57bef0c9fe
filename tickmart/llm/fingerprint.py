"""Threshold-scaled sketches: every shingle hash below a fixed share of the hash range is kept.

A sketch grows with its text, so containment can be estimated between a short text and a very long one, and the
sketch of a union is the union of the sketches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.packed import LEVEL, PIECE
from tickmart.llm.text_arrays import text_shingles

WIDTH = 5
#: One of so many shingle hashes is kept.
SCALE = 4
#: Documents of consecutive ids that are handled together, and the most such ranges there are.
RANGE_ROWS, MOST_RANGES = 2048, 4096


class Sketch:
    """Kept hashes in order, with the number and the sum of all shingles of the text."""

    __slots__ = ("kept", "count", "total")

    def __init__(self, hashes: np.ndarray, scale: int):
        self.kept = np.unique(hashes[hashes < np.uint64((1 << 64) // scale)])
        self.count = len(hashes)
        with np.errstate(over="ignore"):
            self.total = int(hashes.sum(dtype=np.uint64))

    def text(self, scale: int) -> str:
        """Scale, number and sum of the shingles, then the kept hashes with 16 hexadecimal digits each."""
        return f"{scale}:{self.count}:{self.total:016x}:" + self.kept.astype(">u8").tobytes().hex()

    def like(self, other: Sketch) -> float:
        """Estimated Jaccard similarity; two sketches without hashes are alike if all else agrees."""
        both = len(np.intersect1d(self.kept, other.kept, assume_unique=True))
        either = len(self.kept) + len(other.kept) - both
        return both / either if either else float((self.count, self.total) == (other.count, other.total))

    def inside(self, other: Sketch) -> float:
        """Estimated share of this text's shingles that the other has."""
        if not len(self.kept):
            return float((self.count, self.total) == (other.count, other.total))
        return len(np.intersect1d(self.kept, other.kept, assume_unique=True)) / len(self.kept)


def text_sketches(column: pa.Array, width: int = WIDTH, scale: int = SCALE) -> list[Sketch]:
    return [Sketch(hashes[at[i]:at[i + 1]], scale) for a, b, hashes, at in text_shingles(column, width) for i in range(b - a)]


# --- sketches as columns ----------------------------------------------------------------------

def sketches(docs: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``(doc_id, n_shingles, sketch)`` with the kept hashes as sorted signed numbers.

    Null and blank texts have no shingles and an empty sketch; one to four words are one shingle. Repeated rows have
    equal sketches, other columns are ignored, an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = text_sketches(batch.column(1), width, scale)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([s.count for s in made], pa.int64()),
                pa.array([np.sort(s.kept.view(np.int64)) for s in made], pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_shingles bigint, sketch array<bigint>")


def merged(made: DataFrame, by: str) -> DataFrame:
    """The sketch of all texts of a group, one row per kept hash: ``(by, hash)``; hashes are folded before the shuffle."""
    return made.select(by, F.explode("sketch").alias("hash")).distinct()


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of ``part``'s shingles in ``whole``; null when the part's sketch is empty."""
    return F.size(F.array_intersect(part, whole)) / F.nullif(F.size(part), F.lit(0))


# --- documents against their edited form and their successor ----------------------------------

def _range_of(ids: pa.Array, edges: np.ndarray) -> pa.Array:
    """Range number of each id; ids without a value form the last range."""
    known = ids.fill_null(0).to_numpy(zero_copy_only=False)
    at = np.searchsorted(edges, known, side="left")
    return pa.array(np.where(np.asarray(ids.is_null()), len(edges) + 1, at).astype(np.int32))


def _edges(docs: DataFrame, range_rows: int) -> np.ndarray:
    """Upper ends of the id ranges, at most ``MOST_RANGES`` numbers."""
    n = docs.count()
    ranges = min(MOST_RANGES, -(-n // range_rows))
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * MOST_RANGES)).first()[0] if shares else []
    return np.unique(np.array(found or [], np.int64))


def _compare(pairs: list[tuple], width: int, scale: int) -> pa.RecordBatch:
    """Output rows of (doc_id, text, next text) triples."""
    texts = [p[1].decode() for p in pairs]
    edited = [t[:len(t) - len(t) // 2] + p[2].decode()[:len(t) // 2] for t, p in zip(texts, pairs)]
    sketched = lambda parts: text_sketches(pa.array(parts, pa.large_binary()), width, scale)
    own = sketched([p[1] for p in pairs])
    # Mostly the next text is the next pair's own.
    after = [own[i + 1] if i + 1 < len(pairs) and pairs[i + 1][1] is p[2] else sketched([p[2]])[0] for i, p in enumerate(pairs)]
    changed_bytes = [e.encode() for e in edited]
    changed = sketched(changed_bytes)
    return pa.RecordBatch.from_arrays([
        pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in changed_bytes]),
        pa.array([s.text(scale) for s in own]), pa.array([s.text(scale) for s in changed]),
        pa.array([a.like(b) for a, b in zip(own, changed)], pa.float64()), pa.array([a.like(b) for a, b in zip(own, after)], pa.float64()),
        pa.array([b.inside(a) for a, b in zip(own, changed)], pa.float64())], names=[n for n, _ in _OUT])


_OUT = [("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"),
        ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"), ("edited_inside", "double")]


def edited_likeness(docs: DataFrame, width: int = WIDTH, scale: int = SCALE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every document's fingerprint against that of its edited text and that of the next document.

    The edited text has the last half of the code points (rounded down) replaced by as many, or all, of the next
    document by ascending doc_id; the first follows the last. One row per input row: ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` and ``edited_inside``, the share of the
    edited text's shingles that the document has.

    Null texts are empty. Rows that share a doc_id stand in order of their compressed text, rows without doc_id come
    last. A single row is its own successor. Two empty sketches are alike (1) if number and sum of all shingles
    agree, else unlike (0). Other columns are ignored. An empty table gives an empty result.

    Ranges of ids are shuffled once, with the texts compressed, and read through in order; the first text of each
    range also goes to the range before it, so no text is moved twice and no range meets another.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    edges = _edges(docs, range_rows)

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _range_of(batch.column(0), edges)], names=["doc_id", "range"])

    heads = (docs.select("doc_id").mapInArrow(ranged, "doc_id bigint, range int").groupBy("range")
             .agg(F.min("doc_id").alias("head")).orderBy("range").collect())
    before = {h["head"]: heads[i - 1]["range"] for i, h in enumerate(heads)}  # at most MOST_RANGES + 1 entries

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), _range_of(part.column(0), edges),
                    pa.array([squeeze(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()], pa.binary())],
                    names=["doc_id", "range", "packed"])

    spark = docs.sparkSession
    wanted = spark.createDataFrame(list(before.items()), "head bigint, range int")
    first = docs.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("head")), "left_semi")
    lead = (first.mapInArrow(packed, "doc_id bigint, range int, packed binary")
            .groupBy("doc_id").agg(F.min("packed").alias("packed"))
            .join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "range", "packed"))
    rows = (docs.mapInArrow(packed, "doc_id bigint, range int, packed binary").withColumn("foreign", F.lit(False))
            .unionByName(lead.withColumn("foreign", F.lit(True))))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor()
        last, pairs, size = None, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in range(4)]
            for i in range(batch.num_rows):
                name, doc_id, foreign = (columns[c][i].as_py() for c in (0, 1, 2))
                text = spread.decompress(columns[3][i].as_py())
                if last is not None and last[0] == name:
                    pairs.append((last[1], last[2], text))
                    size += len(last[2])
                last = None if foreign else (name, doc_id, text)
                if size >= PIECE:
                    yield _compare(pairs, width, scale)
                    pairs, size = [], 0
        if pairs:
            yield _compare(pairs, width, scale)

    ordered = (rows.select("range", "doc_id", "foreign", "packed").repartition("range")
               .sortWithinPartitions("range", "foreign", F.col("doc_id").isNull(), "doc_id", "packed"))
    return ordered.mapInArrow(compared, ", ".join(f"{n} {t}" for n, t in _OUT))
