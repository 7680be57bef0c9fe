"""Near-duplicate embeddings by lattice hashing: random projections decoded to E8, neighbouring cells probed, cosine verified.

A table projects a vector to pairs of eight dimensions and decodes each eight to the nearest point of the E8 lattice. A vector
is placed into that cell and into the neighbouring cells it lies closest to, so two vectors meet in a table when any of their
cells agree. Vectors that meet are compared by cosine in double precision, each pair in the first cell it shares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.llm.components import components
from tickmart.llm.grouped import sorted_groups
from tickmart.llm.scratch import stored
from tickmart.llm.text_arrays import mix

THRESHOLD = 0.93
#: Tables, eights of projected dimensions in a table, and cells a vector is placed into per table. Of pairs at cosine 0.93
#: about 0.49 meet in one table, so 0.995 in eight; of pairs at 0.97 0.87 and all but one in ten million.
TABLES, EIGHTS, PROBES = 8, 2, 8
#: Spacing of the cells: projected differences of unit vectors are divided by it.
SPACING = 1.5
#: Members of a cell that one task compares with as many others; larger cells are dealt out in pairs of blocks.
BLOCK = 1024
#: Unit vectors and directions are rounded to multiples of 1/2**20 and 1/2**10: their products add up without rounding, so a
#: vector has the same cells in whatever batch a task sees it.
_UNIT, _TURN = 2.0**20, 2.0**10


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of 1 or -1, or all entries a half with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i + 1, 8):
            for a, b in ((1, 1), (1, -1), (-1, 1), (-1, -1)):
                v = np.zeros(8)
                v[i], v[j] = a, b
                out.append(v)
    signs = 0.5 - (np.arange(256)[:, None] >> np.arange(8) & 1)
    return np.vstack([out, signs[(signs < 0).sum(axis=1) % 2 == 0]])


def _even_point(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole entries and an even sum."""
    z = np.rint(x)
    row = np.flatnonzero(z.sum(axis=1) % 2)
    off = x[row] - z[row]
    worst = np.abs(off).argmax(axis=1)
    z[row, worst] += np.where(off[np.arange(len(row)), worst] >= 0, 1.0, -1.0)
    return z


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of every row: whole entries with an even sum, or those shifted by a half."""
    whole, half = _even_point(x), _even_point(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None], whole, half)


def directions(dim: int, tables: int) -> np.ndarray:
    """Gaussian directions as whole multiples of 1/2**10, the same for every task."""
    rng = np.random.Generator(np.random.PCG64([11, dim]))
    return np.rint(rng.standard_normal((dim, tables * EIGHTS * 8)) * _TURN) / _TURN


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, whatever their size."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def lattice_cells(x: np.ndarray, salt: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """``tables * probes`` cell numbers of each row of unit vectors; equal salts, tables and lattice points share a number."""
    n, wide = len(x), EIGHTS * 8
    y = (np.rint(x * _UNIT) / _UNIT) @ directions(x.shape[1], tables) / SPACING
    near = shortest_vectors()
    weigh = mix(np.arange(1, wide + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((n, tables, probes), np.uint64)
    row = np.arange(n)
    with np.errstate(over="ignore"):
        steps = (2 * near).astype(np.int64).astype(np.uint64)
        moved = np.stack([(steps * weigh[8 * e:8 * e + 8]).sum(axis=1, dtype=np.uint64) for e in range(EIGHTS)])
        for t in range(tables):
            at = y[:, wide * t:wide * (t + 1)]
            point = np.hstack([nearest_point(at[:, 8 * e:8 * e + 8]) for e in range(EIGHTS)])
            closer = np.hstack([(at - point)[:, 8 * e:8 * e + 8] @ near.T for e in range(EIGHTS)])
            best = np.argpartition(-closer, probes - 2, axis=1)[:, :probes - 1] if probes > 1 else np.zeros((n, 0), np.int64)
            base = ((2 * point).astype(np.int64).astype(np.uint64) * weigh).sum(axis=1, dtype=np.uint64)
            out[:, t, 0] = base
            for p in range(probes - 1):
                out[row, t, p + 1] = base + moved[best[:, p] // 240, best[:, p] % 240]
            out[:, t] = mix(mix(out[:, t]) ^ salt[:, None] ^ mix(np.uint64(t + 1)))
    return out.reshape(n, -1).view(np.int64)


def _signed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, label as text, the vector's bytes and a digest of both; digest and bytes are null where the row can't link."""
    wide = vectors.schema["embedding"].dataType.elementType.simpleString() != "float"
    kind = np.float64 if wide else np.float32
    vid = vectors.schema["vec_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2)
            ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())])
            flat = lists.flatten()
            x = flat.cast(pa.float64() if wide else pa.float32()).to_numpy(zero_copy_only=False).astype(kind, copy=False) + kind(0)
            x[flat.is_null().to_numpy(zero_copy_only=False)] = np.nan
            ok = np.isfinite(x)

            def every(flags):
                return np.diff(np.concatenate([[0], np.cumsum(flags)])[ends])

            usable = (every(~ok) == 0) & (every(x != 0) > 0)
            labels = batch.column(1).to_pylist()
            packed, digest = [], []
            for i, label in enumerate(labels):
                if label is None or not usable[i]:
                    packed.append(None)
                    digest.append(None)
                    continue
                packed.append(x[ends[i]:ends[i + 1]].tobytes())
                digest.append(hashlib.blake2b(packed[-1], digest_size=16, key=hashlib.sha256(label.encode()).digest()).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary()),
                                              pa.array(digest, pa.binary())], names=["vec_id", "label", "vec", "digest"])

    plain = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast(f"array<{'double' if wide else 'float'}>"))
    return plain.mapInArrow(rows, f"vec_id {vid}, label string, vec binary, digest binary")


def _unpacked(column: pa.Array | pa.ChunkedArray, kind) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors, by number of dimensions."""
    raw = column.to_pylist()
    size = np.array([len(v) for v in raw], np.int64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, unit_rows(np.frombuffer(b"".join(raw[i] for i in at), kind).reshape(len(at), -1))


def _places(classes: DataFrame, kind, tables: int, probes: int) -> DataFrame:
    """``(cell, cid)`` of every cell of every class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                cid = batch.column(0).to_numpy()
                salt = np.array([int.from_bytes(hashlib.sha256(s.encode()).digest()[:8], "little") for s in batch.column(1).to_pylist()], np.uint64)
                for at, x in _unpacked(batch.column(2), kind):
                    cells = lattice_cells(x, salt[at] ^ np.uint64(x.shape[1]), tables, probes)
                    yield pa.RecordBatch.from_arrays([pa.array(cells.ravel()), pa.array(np.repeat(cid[at], cells.shape[1]))], names=["cell", "cid"])

    return classes.select("cid", "label", "vec").mapInArrow(rows, "cell bigint, cid bigint")


def _smallest_linked(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest number that every row and column reaches; each has a link."""
    top = np.iinfo(np.int64).max
    while True:
        left = np.minimum(a, np.where(linked, b[None, :], top).min(axis=1))
        right = np.minimum(b, np.where(linked, left[:, None], top).min(axis=0))
        if (left == a).all() and (right == b).all():
            return a, b
        a, b = left, right


def _first_here(cell: int, a: list, b: list) -> np.ndarray:
    """Which pairs share no cell below this one."""
    seen: dict[int, int] = {}
    spots = []
    for lists in (a, b):
        rows, cols = [], []
        for i, cells in enumerate(lists):
            for c in cells:
                if c < cell:
                    rows.append(i)
                    cols.append(seen.setdefault(c, len(seen)))
        spots.append((rows, cols))
    marks = []
    for lists, (rows, cols) in zip((a, b), spots):
        m = np.zeros((len(lists), max(len(seen), 1)), np.float32)
        m[rows, cols] = 1
        marks.append(m)
    return marks[0] @ marks[1].T == 0


def _compared(dealt: DataFrame, kind, threshold: float) -> DataFrame:
    """Links of every class counted in this cell (``cid, links, null``), and stars of its linked classes (``cid, null, other``)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cell, low, high), rows in sorted_groups(batches, 3):
            cid = rows["cid"].combine_chunks().to_numpy()
            block = rows["block"].combine_chunks().to_numpy()
            size = rows["size"].combine_chunks().to_numpy()
            label = np.unique(rows["label"].combine_chunks().to_numpy(zero_copy_only=False).astype(str), return_inverse=True)[1]
            cells = rows["cells"].to_pylist()
            for at, x in _unpacked(rows["vec"], kind):
                left = np.flatnonzero(block[at] == low)
                right = left if low == high else np.flatnonzero(block[at] == high)
                linked = (x[left] @ x[right].T >= threshold) & (label[at[left]][:, None] == label[at[right]][None, :])
                if low == high:
                    np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                l, r = at[left], at[right]
                p, q = linked.any(axis=1), linked.any(axis=0)
                l, r, linked = l[p], r[q], linked[np.ix_(p, q)]
                counted = linked & _first_here(cell, [cells[i] for i in l], [cells[i] for i in r])
                rooted = _smallest_linked(linked, cid[l], cid[r])
                ids, links, roots = [cid[l]], [counted @ size[r]], [rooted[0]]
                if low != high:
                    ids, links, roots = [*ids, cid[r]], [*links, counted.T @ size[l]], [*roots, rooted[1]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in (ids, links, roots)], names=["cid", "links", "other"])

    return dealt.mapInArrow(rows, "cid bigint, links bigint, other bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, label, embedding)``.

    Rows link when their labels are equal and not null and the cosine of their vectors is at least ``threshold``. A row
    whose label or vector is null, whose vector is empty or zero or holds null or non-finite components, and vectors of
    different length link with nothing; such a row is its own component. Repeated rows and rows of one id are rows of their own that
    link like any others. A row without id takes part; its component is the smallest id among the linked rows, null if there is none, and
    it is never kept. Other columns are not read. No rows: no rows.

    Equal vectors of one label fold first. Only cells that two different vectors share ship any vectors, cells with the same
    members merge, and a pair counts in the smallest of its cells. Cells of more than ``block`` members are dealt out in
    pairs of blocks, so a task holds two blocks. Tasks emit sums and spanning stars, never pairs.
    """
    kind = np.float32 if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64
    signed = _signed(vectors)
    classes = stored(signed.where("digest IS NOT NULL").groupBy("digest")
                     .agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.min("vec_id").alias("low"), F.count("*").alias("size"))
                     .withColumn("cid", F.monotonically_increasing_id()), "lattice-classes")
    places = _places(classes, kind, tables, probes)
    shared = (places.groupBy("cell").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"))
              .where("n > 1").groupBy("n", "x", "y").agg(F.min("cell").alias("cell")).select("cell", "n"))
    lists = places.join(shared, "cell").groupBy("cid").agg(F.collect_list(F.struct("cell", "n")).alias("met"))
    members = stored(classes.select("cid", "label", "vec", "size").join(lists, "cid"), "lattice-members")

    blocks = F.ceil(F.col("m.n") / block).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    dealt = (members.withColumn("cells", F.col("met.cell")).withColumn("m", F.explode("met")).withColumn("blocks", blocks).withColumn("block", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.col("m.cell").alias("cell"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                     "cid", "block", "size", "label", "vec", "cells"))
    dealt = dealt.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    found = stored(_compared(dealt, kind, threshold), "lattice-found")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    of = (classes.select("cid", "digest", "low", "size").join(links, "cid", "left").join(roots, F.col("cid") == F.col("node"), "left")
          .select("digest", "low", F.coalesce("root", "cid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    least = of.groupBy("root").agg(F.min("low").alias("component_id"))
    of = of.join(least, "root").select("digest", "n_links", "component_id")
    ids = signed.select("vec_id", "digest")
    linked = ids.where("digest IS NOT NULL").join(of, "digest").select("vec_id", "n_links", "component_id")
    alone = ids.where("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
