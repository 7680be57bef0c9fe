"""External induced suffix sorting: queues on disk carry suffixes and common-prefix values from bucket to bucket.

Suffixes of the leftmost-smaller kind ("seeds") are named by their substrings and ordered by names; all other suffixes
follow by induction: one pass in ascending order places the descending suffixes, one pass in descending order the
ascending ones. What a pass finds for a later bucket waits in that bucket's queue. Values are found in the order in
which the queue must give them back, so a queue is an append-only run that is spilled when memory is short.
Orders and common prefixes are right to ``DEPTH`` bytes, which is all that is asked of them.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

DEPTH = 100
#: Bytes that all queues of a pass keep in memory before the fullest ones are written to disk.
QUEUE_BYTES = 96 << 20
#: Suffixes handled in one step of a pass.
STEP = 1 << 20
PAD = 16


def spill_folder() -> str | None:
    """One of Spark's own local folders, where an executor keeps its spilled data."""
    for name in ("SPARK_LOCAL_DIRS", "LOCAL_DIRS"):
        for folder in os.environ.get(name, "").split(","):
            if folder and os.path.isdir(folder):
                return folder
    return None


class Queues:
    """One first-in first-out queue of (place, common prefix) per bucket, on disk beyond a memory limit."""

    def __init__(self, buckets: int = 256, limit: int = QUEUE_BYTES):
        self.waiting: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(buckets)]
        self.spilled: list[list[tuple[int, int]]] = [[] for _ in range(buckets)]
        self.limit, self.held, self.size, self.file = limit, 0, np.zeros(buckets, np.int64), None

    def push(self, bucket: int, place: np.ndarray, prefix: np.ndarray) -> None:
        self.waiting[bucket].append((place, prefix))
        self.size[bucket] += len(place)
        self.held += place.nbytes + prefix.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        """Write the fuller half of the memory; the file has no name, so it goes with the process."""
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=spill_folder())
        weight = [sum(p.nbytes + c.nbytes for p, c in w) for w in self.waiting]
        for bucket in sorted(range(len(weight)), key=weight.__getitem__, reverse=True):
            if self.held <= self.limit // 2 or not weight[bucket]:
                break
            place = np.concatenate([p for p, _ in self.waiting[bucket]])
            prefix = np.concatenate([c for _, c in self.waiting[bucket]])
            at = self.file.seek(0, os.SEEK_END)
            self.file.write(place.tobytes())
            self.file.write(prefix.tobytes())
            self.spilled[bucket].append((at, len(place)))
            self.waiting[bucket] = []
            self.held -= weight[bucket]

    def pop(self, bucket: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All that waits now, in order and in steps; what is pushed meanwhile waits for the next call."""
        spilled, waiting = self.spilled[bucket], self.waiting[bucket]
        self.spilled[bucket], self.waiting[bucket] = [], []
        self.size[bucket] = 0
        self.held -= sum(p.nbytes + c.nbytes for p, c in waiting)
        for at, n in spilled:
            for a in range(0, n, STEP):
                k = min(STEP, n - a)
                self.file.seek(at + 8 * a)
                place = np.frombuffer(self.file.read(8 * k), np.int64)
                self.file.seek(at + 8 * n + a)
                yield place, np.frombuffer(self.file.read(k), np.uint8)
        group, n = [], 0
        for part in waiting:
            group.append(part)
            n += len(part[0])
            if n >= STEP:
                yield np.concatenate([p for p, _ in group]), np.concatenate([c for _, c in group])
                group, n = [], 0
        if group:
            yield np.concatenate([p for p, _ in group]), np.concatenate([c for _, c in group])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class RangeLow:
    """Least common prefix over any stretch of a step, from a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows, span = [values], 1
        while 2 * span <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-span], last[span:]))
            span *= 2
        self.offsets = np.cumsum([0, *map(len, self.rows)])
        self.flat = np.concatenate(self.rows)

    def over(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value from ``first`` to ``last`` inclusive."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        base = self.offsets[level]
        return np.minimum(self.flat[base + first], self.flat[base + last + 1 - (1 << level)])


class Pass:
    """Hands the predecessors of scanned suffixes to the queues of their first bytes."""

    def __init__(self, text: np.ndarray, queues: Queues):
        self.text, self.queues = text, queues
        self.low = np.full(256, 0, np.uint8)  # least prefix since a bucket last got a suffix

    def scan(self, place: np.ndarray, prefix: np.ndarray, keep) -> None:
        """``prefix`` is what each suffix shares with the one scanned before; ``keep`` picks predecessors by their byte."""
        byte = self.text[np.maximum(place - 1, 0)]
        chosen = np.flatnonzero(keep(byte) & (place > 0))
        if not len(chosen):
            np.minimum(self.low, prefix.min(), out=self.low)
            return
        target = byte[chosen]
        by = np.argsort(target, kind="stable")
        at, target = chosen[by], target[by]
        head = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        before = np.empty(len(at), np.int64)
        before[1:] = at[:-1] + 1
        before[head] = 0
        table = RangeLow(prefix)
        shared = table.over(before, at)
        present = target[head]
        shared[head] = np.minimum(shared[head], self.low[present])
        shared = np.minimum(shared, DEPTH - 1) + np.uint8(1)
        tail = np.append(head[1:], len(at)) - 1
        rest = np.full(256, prefix.min(), np.uint8)
        np.minimum(self.low, rest, out=self.low)
        end = at[tail]
        inner = end + 1 < len(prefix)
        self.low[present] = DEPTH
        if inner.any():
            self.low[present[inner]] = table.over(end[inner] + 1, np.full(inner.sum(), len(prefix) - 1))
        place = place[at] - 1
        for bucket, a, b in zip(present.tolist(), head.tolist(), (tail + 1).tolist()):
            self.queues.push(bucket, place[a:b], shared[a:b])


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as big-endian numbers; the text is padded."""
    return np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Common prefix of suffix pairs, at most ``depth``."""
    view, out, live = words(text), np.zeros(len(a), np.int64), np.arange(len(a))
    limit = len(view) - 1
    for at in range(0, depth, 8):
        x = view[np.minimum(a[live] + at, limit)].astype(np.uint64) ^ view[np.minimum(b[live] + at, limit)].astype(np.uint64)
        same = 8 - (np.frexp(x.astype(np.float64))[1] + 7) // 8
        # A number just below a power of two may be rounded up to it in a double.
        same = np.where((x > 0) & (x >> np.uint64(8) * np.minimum(7 - np.minimum(same, 7), 7).astype(np.uint64) == 0), same + 1, same)
        out[live] += same
        live = live[same == 8]
        if not len(live):
            break
    return np.minimum(out, depth)


def refined(order: np.ndarray, rank: np.ndarray, slots: np.ndarray, key: np.ndarray) -> None:
    """Sort the items in ``slots`` of ``order`` inside their groups by ``key``; a group's rank is its first slot."""
    items = order[slots]
    by = np.lexsort((key, rank[items]))
    items, key = items[by], key[by]
    old = rank[items]
    order[slots] = items
    fresh = np.concatenate([[True], (old[1:] != old[:-1]) | (key[1:] != key[:-1])])
    rank[items] = np.maximum.accumulate(np.where(fresh, slots, 0))


def seed_order(text: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Seeds in suffix order: by the substrings up to the next seed, then by runs of 1, 2, 4, ... of their names."""
    n = len(seeds)
    length = np.append(seeds[1:], len(text) - PAD) - seeds + 1
    view = words(text)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)

    def piece(items: np.ndarray, w: int) -> np.ndarray:
        """Bytes 8w to 8w+8 of the items' substrings; past the end all ones, as a longer substring comes first."""
        value = view[np.minimum(seeds[items] + 8 * w, len(view) - 1)].astype(np.uint64)
        left = np.clip(length[items] - 8 * w, 0, 8)
        shift = (np.uint64(8) * np.minimum(left, 7).astype(np.uint64))
        return np.where(left >= 8, value, np.where(left <= 0, ones, value | (ones >> shift)))

    first = piece(np.arange(n), 0)
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    ordered = first[order]
    rank[order] = np.maximum.accumulate(np.where(np.concatenate([[True], ordered[1:] != ordered[:-1]]), np.arange(n), 0))

    def open_slots(wanted: np.ndarray | None = None) -> np.ndarray:
        """Slots of groups with two members or more, one of them wanted."""
        group = rank[order]
        size = np.bincount(group, minlength=n)
        open_ = size[group] > 1
        if wanted is not None:
            hit = np.zeros(n, bool)
            hit[rank[wanted]] = True
            open_ &= hit[group]
        return np.flatnonzero(open_)

    for w in range(1, -(-int(length.max()) // 8)):
        slots = open_slots(np.flatnonzero(length > 8 * w))
        if not len(slots):
            break
        refined(order, rank, slots, piece(order[slots], w))
    run = 1
    while run < DEPTH // 2 + 2:
        slots = open_slots()
        if not len(slots):
            break
        after = order[slots] + run
        refined(order, rank, slots, np.where(after < n, rank[np.minimum(after, n - 1)], -1))
        run *= 2
    return seeds[order]


def narrow(n: int) -> type:
    """The smaller integer type that holds places up to ``n``."""
    return np.int32 if n < 2**31 - 1 else np.int64


def ascending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the padding's end counts as descending."""
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    place = np.where(step != 0, np.arange(len(step), dtype=narrow(len(text))), narrow(len(text))(len(step)))
    nearest = np.minimum.accumulate(place[::-1])[::-1]
    return np.append(np.append(step, -1)[nearest] > 0, False)


def suffix_runs(text: np.ndarray, limit: int = QUEUE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in descending order, in steps of (places, common prefix with the suffix given before).

    ``text`` holds bytes and ends with ``PAD`` zeros, which are not reported.
    """
    n = len(text) - PAD
    up = ascending(text)
    length = np.diff(np.append(np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])), len(text)))
    kind = narrow(len(text))
    run = np.repeat(np.cumsum(length).astype(kind), length) - np.arange(len(text), dtype=kind)
    run = np.minimum(run, DEPTH).astype(np.uint8)
    seeds = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    seeds = seeds[seeds < n]
    down = Queues(limit=limit)
    first_seed: dict[int, tuple[int, int]] = {}
    if len(seeds):
        seeds = seed_order(text, seeds)
        shared = np.append(0, common_prefix(text, seeds[:-1], seeds[1:])).astype(np.uint8)
        heads = text[seeds]
        cuts = np.searchsorted(heads, np.arange(257))
        first_seed = {c: (int(cuts[c]), int(cuts[c + 1])) for c in range(256) if cuts[c] < cuts[c + 1]}
    # Ascending pass: the end of the text stands for the smallest suffix.
    ahead = Pass(text, down)
    kept = Queues(limit=limit)  # descending suffixes per bucket, for the second pass
    if n:
        ahead.scan(np.array([n]), np.zeros(1, np.uint8), lambda b: b >= 0)
    for c in range(256):
        last = None
        while down.size[c]:
            for place, prefix in down.pop(c):
                if last is None:
                    prefix = prefix.copy()
                    prefix[0] = 0
                kept.push(c, place, prefix)
                ahead.scan(place, prefix, lambda b: b >= c)
                last = int(place[-1])
        if c in first_seed:
            a, b = first_seed[c]
            for i in range(a, b, STEP):
                place, prefix = seeds[i:min(i + STEP, b)], shared[i:min(i + STEP, b)].copy()
                if i == a:
                    prefix[0] = 0 if last is None else min(run[last], run[place[0]])
                ahead.scan(place, prefix, lambda b: b >= c)
    down.close()
    # Descending pass: ascending suffixes are found from the largest down, then the bucket's descending ones follow.
    rising = Queues(limit=limit)
    back = Pass(text, rising)
    for c in range(255, -1, -1):
        last = None
        while rising.size[c]:
            for place, prefix in rising.pop(c):
                if last is None:
                    prefix = prefix.copy()
                    prefix[0] = 0
                back.scan(place, prefix, lambda b: b <= c)
                yield place, prefix
                last = int(place[-1])
        parts = list(kept.pop(c))
        behind = None
        for k in range(len(parts) - 1, -1, -1):
            place, prefix = parts[k]
            place = place[::-1]
            # Ascending prefixes are with the suffix before; turned round they are with the one after.
            turned = np.empty(len(prefix), np.uint8)
            turned[1:] = prefix[1:][::-1]
            turned[0] = behind if behind is not None else (0 if last is None else min(run[last], run[place[0]]))
            behind = prefix[0]
            back.scan(place, turned, lambda b: b < c)
            yield place, turned
        del parts
    rising.close()
    kept.close()
