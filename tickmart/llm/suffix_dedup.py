"""Removal of byte strings that occur earlier in the corpus, by suffix arrays over shards.

Equal texts are folded first. In every stretch of ``LENGTH`` bytes the smallest hash of its ``GRAM``-byte substrings is
its anchor, so equal stretches have equal anchors. Stretches whose anchor occurs once anywhere are unique. The others
go, with the bytes they span, to the shard of their anchor; each shard sorts its suffixes by external induction, and
runs of suffixes with a common prefix of ``LENGTH`` are the repeated stretches, of which the earliest stays.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickmart.llm.grouped import sorted_groups
from tickmart.llm.induced_sort import DEPTH, PAD, QUEUE_BYTES, narrow, suffix_runs
from tickmart.llm.packed import LEVEL
from tickmart.llm.scratch import fresh_path, stored
from tickmart.llm.text_arrays import mix

LENGTH = DEPTH
GRAM = 32
#: Fewest shards for each of the session's shuffle partitions.
SHARDS_PER_PARTITION = 2
#: Bytes of spans that a shard gets on average at most; its suffix arrays take some 50 times that in memory.
SHARD_BYTES = 4 << 20
#: Bytes of distinct text whose anchors are counted in one part; counting takes about twice that in memory.
PART_BYTES = 64 << 20
#: Bytes of text in one stored chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: An anchor whose spans have more bytes than this is hot: its stretches are dealt one by one, by all their bytes.
HOT_BYTES = 512 << 10
#: Starts handled together; with a stretch's length they must stay below 2**20 for the packed minimum.
PIECE = 500_000

_rng = np.random.Generator(np.random.PCG64(6))
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_LAST = np.iinfo(np.int64).max
_PLACE = np.uint64((1 << 20) - 1)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _packed(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(pickle.dumps(arrays, protocol=5))


def _unpacked(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


# --- anchors ----------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every place, built by doubling."""
    h, span = _VALUE[data], 1
    with np.errstate(over="ignore"):
        while span < GRAM:
            h = h[:-span] * np.uint64(pow(_BASE, span, 1 << 64)) + h[span:]
            span *= 2
        return mix(h)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of stretches with one anchor: first start, number of starts, anchor hash. Texts are at least ``LENGTH`` long."""
    fits = np.ones(len(data), bool)
    for end in offsets[1:].tolist():
        fits[end - LENGTH + 1:end] = False
    out = []
    window = LENGTH - GRAM + 1
    for a in range(0, len(data) - LENGTH + 1, PIECE):
        b = min(a + PIECE, len(data) - LENGTH + 1)
        hashes = gram_hashes(data[a:b + LENGTH - 1])
        low, span = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), 1
        while 2 * span <= window:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:b - a], low[window - span:window - span + b - a]) & _PLACE
        starts = np.flatnonzero(fits[a:b])
        if len(starts):
            at = low[starts].astype(np.int64)
            new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
            out.append((starts[new] + a, np.diff(np.append(new, len(starts))), hashes[at[new]]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def asked(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors by (part, hash): parts, 48-bit hashes, counts, and the place of each given hash among them."""
    part = (hashes % np.uint64(parts)).astype(np.int64)
    short = hashes >> np.uint64(16)
    order = np.lexsort((short, part))
    p, s = part[order], short[order]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])]) if len(p) else np.zeros(0, bool)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    return p[head], s[head], np.diff(np.append(head, len(p))), place


# --- chunks -----------------------------------------------------------------------------------

_CHUNK = "chunk bigint, shas array<string>, firsts array<bigint>, lengths array<bigint>, packed binary"


def _folded(docs: DataFrame) -> DataFrame:
    """One row per distinct text of ``LENGTH`` bytes or more: ``sha, first, packed``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                                                  pa.array([squeeze(t) for t in texts], pa.binary())], names=["doc_id", "sha", "packed"])

    long_ = docs.select("doc_id", "text").where(F.octet_length("text") >= LENGTH)
    return (long_.mapInArrow(rows, "doc_id bigint, sha string, packed binary").groupBy("sha")
            .agg(F.min("doc_id").alias("first"), F.first("packed").alias("packed")))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spread = zstandard.ZstdDecompressor().decompress
    base, nth = TaskContext.get().partitionId() << 32, 0
    shas, firsts, texts, size = [], [], [], 0

    def chunk() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([base + nth], pa.int64()), pa.array([shas]), pa.array([firsts], pa.list_(pa.int64())),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
            pa.array([zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(texts))], pa.binary())],
            names=["chunk", "shas", "firsts", "lengths", "packed"])

    for batch in batches:
        for i in range(batch.num_rows):
            text = spread(batch.column(2)[i].as_py())
            if texts and size + len(text) > CHUNK_BYTES:
                yield chunk()
                nth += 1
                shas, firsts, texts, size = [], [], [], 0
            shas.append(batch.column(0)[i].as_py())
            firsts.append(batch.column(1)[i].as_py())
            texts.append(text)
            size += len(text)
    if texts:
        yield chunk()


def _stored_chunks(spark: SparkSession, folded: DataFrame, parts: int) -> DataFrame:
    """Chunks of distinct texts, laid out by chunk so that later joins on it don't move them."""
    path = fresh_path(spark, "chunks")
    name = "llm_chunks_" + path.rsplit("-", 1)[1]
    (folded.mapInArrow(_chunked, _CHUNK).write.option("path", path).option("compression", "none")
     .bucketBy(parts, "chunk").sortBy("chunk").saveAsTable(name))
    chunks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the resolved frame keeps the layout, and the files stay
    return chunks


class Chunk:
    """An unpacked chunk with its anchors."""

    def __init__(self, row: dict):
        self.name, self.shas, self.firsts = row["chunk"], row["shas"], row["firsts"]
        self.bytes = zstandard.ZstdDecompressor().decompress(row["packed"])
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)

    def order(self) -> np.ndarray:
        """Order of each text's document; documents without id come last."""
        return np.array([_LAST if f is None else f for f in self.firsts], np.int64)


def distinct_spans(chunk: Chunk, first: np.ndarray, count: np.ndarray, times: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs and starts of each distinct anchor; spans that are equal inside the chunk count once, as they are sent once."""
    new, seen = np.ones(len(first), bool), set()
    many = np.flatnonzero(times[place] > 1)
    for k, a, n in zip(many.tolist(), first[many].tolist(), count[many].tolist()):
        span = chunk.bytes[a:a + n + LENGTH - 1]
        new[k] = span not in seen
        seen.add(span)
    at = place[new]
    return np.bincount(at, minlength=len(times)), np.bincount(at, count[new], len(times)).astype(np.int64)


def _requests(parts: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = Chunk(batch.slice(i, 1).to_pylist()[0])
                first, count, hashes = anchors(chunk.data, chunk.offsets)
                part, short, times, place = asked(hashes, parts)
                sizes = [x.astype(np.uint32) for x in (times, *distinct_spans(chunk, first, count, times, place))]
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist() if len(part) else []
                blobs = [_packed(np.diff(short[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.copy(),
                                 *(x[a:b] for x in sizes)) for a, b in zip(cuts, [*cuts[1:], len(part)])]
                yield pa.RecordBatch.from_arrays([pa.array(part[cuts].astype(np.int32) if cuts else [], pa.int32()),
                                                  pa.array([chunk.name] * len(cuts), pa.int64()), pa.array(blobs, pa.binary())],
                                                 names=["part", "chunk", "blob"])

    return rows


def _replies(hot: int):
    """Per part: which of each chunk's anchors occur in another chunk too, and which of them are hot, as bits; and the
    bytes of the spans that the chunk will send for them."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), group in sorted_groups(batches, 1):
            blobs = [_unpacked(b) for b in group.column("blob").to_pylist()]
            sent = [np.cumsum(np.ascontiguousarray(b[0].T).view(np.uint64).ravel(), dtype=np.uint64) for b in blobs]
            _, inverse, counts = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
            times = counts[inverse]
            inside, runs, starts = (np.concatenate([b[c] for b in blobs]).astype(np.int64) for c in (1, 2, 3))
            span = starts + runs * (LENGTH - 1)
            many = np.bincount(inverse, span)[inverse] > hot
            bytes_ = np.where(many, starts * LENGTH, span) * ((times > 1) | (inside > 1))
            ends = np.cumsum([len(s) for s in sent])
            cuts = [(e - len(s), e) for s, e in zip(sent, ends)]
            bits = [_packed(np.packbits(times[a:b] > 1), np.packbits(many[a:b])) for a, b in cuts]
            yield pa.RecordBatch.from_arrays([group.column("chunk").combine_chunks(), pa.array([part] * len(bits), pa.int32()),
                                              pa.array(bits, pa.binary()), pa.array([int(bytes_[a:b].sum()) for a, b in cuts], pa.int64())],
                                             names=["chunk", "part", "bits", "bytes"])

    return rows


def _segments(parts: int, shards: int):
    """Per chunk and shard: the spans of stretches that may be repeated; stretches repeated inside the chunk go along."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _segment_rows(Chunk(row), row["replies"] or [], parts, shards)

    return rows


def _segment_rows(chunk: Chunk, replies: list[dict], parts: int, shards: int) -> pa.RecordBatch:
    first, count, hashes = anchors(chunk.data, chunk.offsets)
    part, _, times, place = asked(hashes, parts)
    again, hot = times > 1, np.zeros(len(part), bool)
    for reply in replies:
        a, b = np.searchsorted(part, [reply["part"], reply["part"] + 1])
        more, many = (np.unpackbits(x)[:b - a].astype(bool) for x in _unpacked(reply["bits"]))
        again[a:b] |= more
        hot[a:b] |= many
    pick = np.flatnonzero(again[place])
    text = np.searchsorted(chunk.offsets, first[pick], "right") - 1
    rank = chunk.order()[text]
    pick, text, rank = (x[np.lexsort((first[pick], text, rank))] for x in (pick, text, rank))
    seen: set[bytes] = set()
    lists: dict[int, list] = {}
    gone: list[tuple[int, int, int]] = []
    for k, t, r, a, n, is_hot, home in zip(pick.tolist(), text.tolist(), rank.tolist(), first[pick].tolist(), count[pick].tolist(),
                                           hot[place[pick]].tolist(), (hashes[pick] % np.uint64(shards)).tolist()):
        for s, m in ((s, 1) for s in range(a, a + n)) if is_hot else ((a, n),):
            span = chunk.bytes[s:s + m + LENGTH - 1]
            begin = s - int(chunk.offsets[t])
            if span in seen:
                gone.append((t, begin, m))
            else:
                seen.add(span)
                lists.setdefault(zlib.crc32(span) % shards if is_hot else home, []).append((t, r, begin, m, span))
    blobs = {p: _packed(*(np.array(c, np.int64) for c in list(zip(*x))[:4]), b"".join(s[4] for s in x)) for p, x in lists.items()}
    names = sorted(blobs)
    own = [_packed(np.array(gone, np.int64))] if gone else []
    return pa.RecordBatch.from_arrays([
        pa.array([*names, *([chunk.name % shards] if gone else [])], pa.int32()), pa.array([chunk.name] * (len(names) + len(own)), pa.int64()),
        pa.array([blobs[p] for p in names] + [None] * len(own), pa.binary()), pa.array([None] * len(names) + own, pa.binary())],
        names=["part", "chunk", "blob", "gone"])


# --- shards -----------------------------------------------------------------------------------

def repeated_starts(text: np.ndarray, is_start: np.ndarray, queue_bytes: int) -> np.ndarray:
    """Starts whose ``LENGTH`` bytes also begin at an earlier start, from the suffix order of the padded text."""
    gone = np.zeros(len(is_start), bool)
    earliest = -1  # of the run of equal suffixes that reaches into the next step
    for place, prefix in suffix_runs(text, queue_bytes):
        run = np.cumsum(prefix < LENGTH)
        keep = is_start[place]
        carried = earliest >= 0 and prefix[0] >= LENGTH
        at, run_of = place[keep], run[keep]
        if carried:
            at, run_of = np.append(earliest, at), np.append(run[0], run_of)
        earliest = -1
        if len(at):
            head = np.flatnonzero(np.concatenate([[True], run_of[1:] != run_of[:-1]]))
            least = np.minimum.reduceat(at, head)
            gone[at] = True
            gone[least] = False
            if run_of[-1] == run[-1]:
                earliest = int(least[-1])
    return gone


def _shard(queue_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in sorted_groups(batches, 1):
            names, blobs, own = (group.column(c).to_pylist() for c in ("chunk", "blob", "gone"))
            out = [(n, [g]) for n, g in ((n, _unpacked(g)[0]) for n, g in zip(names, own) if g is not None)]
            spans = [(n, *_unpacked(b)) for n, b in zip(names, blobs) if b is not None]
            if spans:
                out += _shard_ranges(spans, queue_bytes).items()
            for n, found in out:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([_packed(np.concatenate(found))], pa.binary())],
                                                 names=["chunk", "ranges"])

    return rows


def _shard_ranges(spans: list[tuple], queue_bytes: int) -> dict[int, list[np.ndarray]]:
    """Removed runs of starts, rows of (text, start, number), by chunk."""
    chunk = np.repeat([s[0] for s in spans], [len(s[1]) for s in spans])
    text, rank, begin, count = (np.concatenate([s[c] for s in spans]) for c in (1, 2, 3, 4))
    body = b"".join(s[5] for s in spans)
    length = count + LENGTH - 1
    at = np.cumsum(length) - length
    order = np.lexsort((begin, text, chunk, rank))
    seen: set[bytes] = set()
    kept, whole = [], []
    for k, a, n in zip(order.tolist(), at[order].tolist(), length[order].tolist()):
        span = body[a:a + n]
        if span in seen:
            whole.append(k)
        else:
            seen.add(span)
            kept.append(k)
    seen.clear()
    kept = np.array(kept)
    size = length[kept] + 1
    starts = np.cumsum(size) - size
    joined = np.frombuffer(b"\0".join(body[at[k]:at[k] + length[k]] for k in kept.tolist()) + bytes(PAD + 1), np.uint8)
    kind = narrow(len(joined))
    offset = np.arange(int(size.sum()), dtype=kind) - np.repeat(starts.astype(kind), size)
    is_start = offset < np.repeat(count[kept].astype(kind), size)
    del body
    gone = repeated_starts(joined, is_start, queue_bytes)
    hit = np.flatnonzero(gone)
    found: dict[int, list[np.ndarray]] = {}
    parts = [np.stack([text[whole], begin[whole], count[whole]], 1)] if whole else []
    owner = [chunk[whole]] if whole else []
    if len(hit):
        new = np.flatnonzero(np.concatenate([[True], hit[1:] != hit[:-1] + 1]))
        seg = np.searchsorted(starts, hit[new], "right") - 1
        k = kept[seg]
        parts.append(np.stack([text[k], begin[k] + offset[hit[new]], np.diff(np.append(new, len(hit)))], 1))
        owner.append(chunk[k])
    if parts:
        table, own = np.concatenate(parts), np.concatenate(owner)
        by = np.argsort(own, kind="stable")
        table, own = table[by], own[by]
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        for a, b in zip(cuts, [*cuts[1:], len(own)]):
            found[int(own[a])] = [table[a:b]]
    return found


# --- results ----------------------------------------------------------------------------------

def _outcome(keep_text: bool):
    """Per distinct text: what is removed, and the rest."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row)
                change = np.zeros(len(chunk.data) + 1, np.int32)
                for blob in row["ranges"] or []:
                    text, start, count = _unpacked(blob)[0].T
                    np.add.at(change, chunk.offsets[text] + start, 1)
                    np.add.at(change, chunk.offsets[text] + start + count + LENGTH - 1, -1)
                covered = np.cumsum(change[:-1]) > 0
                opens = covered.copy()
                opens[1:] &= ~covered[:-1]
                edge = chunk.offsets[1:-1]
                opens[edge] = covered[edge]
                removed = np.add.reduceat(covered.astype(np.int64), chunk.offsets[:-1])
                spans = np.add.reduceat(opens.astype(np.int64), chunk.offsets[:-1])
                rest = [chunk.data[a:b][~covered[a:b]].tobytes() for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:])]
                whole = [squeeze(_in_characters(chunk.data[a:b], covered[a:b])) if keep_text else None
                         for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(chunk.shas), pa.array(chunk.firsts, pa.int64()), pa.array(removed), pa.array(spans),
                    pa.array([hashlib.sha256(r).hexdigest() for r in rest]), pa.array(whole, pa.binary())],
                    names=["sha", "first", "removed", "spans", "kept_sha", "kept"])

    return rows


def _in_characters(data: np.ndarray, covered: np.ndarray) -> bytes:
    """The uncovered text; characters of which some byte is uncovered stay whole."""
    lead = (data & 0xC0) != 0x80
    head = np.flatnonzero(lead)
    if not len(head):
        return data[~covered].tobytes()
    every = np.logical_and.reduceat(covered, head)
    return data[~np.repeat(every, np.diff(np.append(head, len(data))))].tobytes()


def _dealt(docs: DataFrame, hot: int) -> tuple[DataFrame, DataFrame, int]:
    """Chunks, the spans they send to shards, and the number of shards, chosen by the bytes of all spans."""
    spark = docs.sparkSession
    least = SHARDS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = _stored_chunks(spark, _folded(docs), least)
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = max(least, -(-(chunks.agg(F.sum(length)).first()[0] or 0) // PART_BYTES))
    replies = stored(chunks.mapInArrow(_requests(parts), "part int, chunk bigint, blob binary").repartition(parts, "part")
                     .sortWithinPartitions("part").mapInArrow(_replies(hot), "chunk bigint, part int, bits binary, bytes bigint"), "replies")
    shards = max(least, -(-(replies.agg(F.sum("bytes")).first()[0] or 0) // SHARD_BYTES))
    answered = replies.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("replies"))
    segments = chunks.join(answered.hint("merge"), "chunk", "left").mapInArrow(
        _segments(parts, shards), "part int, chunk bigint, blob binary, gone binary")
    return chunks, segments, shards


def _text_outcomes(docs: DataFrame, keep_text: bool, hot: int, queue_bytes: int) -> DataFrame:
    """``sha, first, removed, spans, kept_sha, kept`` per distinct text of ``LENGTH`` bytes or more."""
    chunks, segments, shards = _dealt(docs, hot)
    ranges = (segments.repartition(shards, "part").sortWithinPartitions("part")
              .mapInArrow(_shard(queue_bytes), "chunk bigint, ranges binary"))
    found = ranges.groupBy("chunk").agg(F.collect_list("ranges").alias("ranges"))
    return chunks.join(found.hint("merge"), "chunk", "left").mapInArrow(
        _outcome(keep_text), "sha string, first bigint, removed bigint, spans bigint, kept_sha string, kept binary")


def _judged(docs: DataFrame, columns: list[str], keep_text: bool, hot: int, queue_bytes: int) -> DataFrame:
    """Rows with ``_sha, _bytes``, the outcome of their text, and whether they are its earliest copy."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    bare = F.coalesce("text", F.lit(""))
    base = docs.select(*columns, F.sha2(bare, 256).alias("_sha"), F.octet_length(bare).cast("long").alias("_bytes"))
    copy = F.row_number().over(Window.partitionBy("_sha", "doc_id").orderBy("_bytes"))
    out = _text_outcomes(docs, keep_text, hot, queue_bytes).select(*[F.col(c).alias(f"_{c}") for c in
                                                                    ("sha", "first", "removed", "spans", "kept_sha", "kept")])
    return base.withColumn("_copy", copy).join(out, "_sha", "left").withColumn(
        "_early", F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("_copy") == 1))


def repeated_bytes(docs: DataFrame, hot: int = HOT_BYTES, queue_bytes: int = QUEUE_BYTES) -> DataFrame:
    """What exact deduplication removes: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per input row.

    A byte goes when a string of 100 bytes that covers it also begins earlier: in a document with a smaller doc_id, or
    in the same one further ahead. Strings are judged on the input, overlaps count, matches stay inside documents.
    ``n_spans`` counts the maximal removed runs, ``kept_sha256`` is the digest of what is left.

    Null texts are empty; texts under 100 bytes lose nothing. Documents without id come last. Of repeated rows one
    counts as the earliest. Texts that share a doc_id are ordered by where they are stored. Other columns are
    ignored. An empty table gives an empty result.

    Work is sharded by anchor, in as many shards as the bytes of the spans ask for; an anchor whose spans have more
    than ``hot`` bytes is dealt out stretch by stretch. Equal spans are folded in every chunk first. Queues of the sort
    beyond ``queue_bytes`` go to disk.
    """
    rows = _judged(docs, ["doc_id"], False, hot, queue_bytes)
    short, early = F.col("_bytes") < LENGTH, F.col("_early")
    choose = lambda a, b, c: F.when(short, a).when(early, b).otherwise(c)
    return rows.select(
        "doc_id", F.col("_bytes").alias("n_bytes"), choose(F.lit(0).cast("long"), F.col("_removed"), F.col("_bytes")).alias("n_removed"),
        choose(F.lit(0).cast("long"), F.col("_spans"), F.lit(1).cast("long")).alias("n_spans"),
        choose(F.col("_sha"), F.col("_kept_sha"), F.lit(EMPTY_SHA)).alias("kept_sha256"))


def without_repeats(docs: DataFrame, hot: int = HOT_BYTES, queue_bytes: int = QUEUE_BYTES) -> DataFrame:
    """The documents with what is left of their texts and all their columns; ``n_chars`` is counted anew.

    No row is dropped: a later copy keeps its row with an empty text. A character stays whole if one of its bytes is
    left.
    """
    rest = [c for c in docs.columns if c not in ("text", "doc_id")]
    whole = docs.select("doc_id", "text", F.struct(*(rest or [F.lit(0)])).alias("rest"))
    rows = _judged(whole, ["doc_id", "rest"], True, hot, queue_bytes)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            last = batch.num_columns - 1
            texts = [None if b is None else spread(b) for b in batch.column(last).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(texts, pa.binary()).cast(pa.string())], names=names)

    names = ["doc_id", "rest", "text"]
    kinds = whole.withColumn("doc_id", F.col("doc_id").cast("long")).select(*names).schema
    changed = rows.where(F.col("_bytes") >= LENGTH).select(
        "doc_id", "rest", F.when(F.col("_early"), F.col("_kept")).alias("_kept")).mapInArrow(unpacked, kinds)
    short = whole.where(F.octet_length(F.coalesce("text", F.lit(""))) < LENGTH).select(*names)
    out = changed.withColumn("text", F.coalesce("text", F.lit(""))).unionByName(short)
    out = out.select("doc_id", "text", *[F.col("rest")[c].alias(c) for c in rest])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
