"""Trie of conversation prefixes: double arrays per prefix shard, upper nodes shared by shards merged globally.

A turn is known by the digest of its role and text. Conversations with the same turns fold into one path with a number of
members. Paths are dealt to shards by a prefix short enough to be known everywhere and long enough that no prefix
brings more turns than a shard may have; nodes above that prefix are met by several shards and merged afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickmart.llm.scratch import stored

#: Conversations of a hundred share the first turns of the one whose id ends in 00; at most MOST_SHARED - 1 of them.
HUNDRED, MOST_SHARED = 100, 6
#: Turns of a shard: a prefix with more turns below it is split at its children.
SHARD_TURNS = 20_000
#: Shared upper nodes that are broadcast to the nodes right below them; more are joined by their digest.
MOST_BROADCAST = 100_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _step(parent: bytes, key: bytes) -> bytes:
    """Name of the prefix that adds one turn to a prefix."""
    return hashlib.blake2b(parent + key, digest_size=16).digest()


def turn_key(role: Column, text: Column) -> Column:
    """Strong digest of a turn; the role's length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path``: the turns ``(key, chars)`` of every rebuilt conversation, an empty array where none is left.

    Turns are ordered by ``turn`` (null first); of equal turns the digest decides. With ``h = crc32(conv_id) % 6`` the first h
    turns come from the conversation with the id's last two digits cleared, then the own turns after the first h follow.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = (conversations.where("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     turn_key(role, text).alias("key"), F.char_length(text).cast("long").alias("chars")))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "key", "chars")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(order)).alias("own")).select(
        "conv_id", F.transform("own", lambda t: F.struct(t["key"].alias("key"), t["chars"].alias("chars"))).alias("own"))
    h = F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED
    base = F.col("conv_id") - F.col("conv_id") % HUNDRED
    rest = whole.select("conv_id", "own", h.cast("int").alias("h"), base.alias("base"))
    rest = rest.select("conv_id", "h", "base", F.expr("slice(own, h + 1, greatest(size(own) - h, 0))").alias("own"))
    first = whole.where(F.col("conv_id") % HUNDRED == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, MOST_SHARED - 1).alias("lead"))
    none = F.expr("cast(array() as array<struct<key: binary, chars: bigint>>)")
    return rest.join(first, "base", "left").select("conv_id", F.concat(F.slice(F.coalesce("lead", none), F.lit(1), F.col("h")), "own").alias("path"))


def _ends(named: DataFrame) -> DataFrame:
    """``name, ends``: digest of the members' ids, ascending and comma-joined, one id at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running = None, None
        for batch in batches:
            names, ends = [], []
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != last:
                    if last is not None:
                        names.append(last)
                        ends.append(running.hexdigest())
                    last, running = name, hashlib.sha256(b"%d" % conv)
                else:
                    running.update(b",%d" % conv)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(ends, pa.string())], names=["name", "ends"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([running.hexdigest()])], names=["name", "ends"])

    return named.select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id").mapInArrow(rows, "name binary, ends string")


def _prefixes(folded: DataFrame) -> DataFrame:
    """``name, prefix, depth, below``: every prefix of every folded path, with the turns that follow it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(columns):
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64()),
                                               pa.array(columns[3], pa.int64())], names=["name", "prefix", "depth", "below"])

        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for name, keys in zip(batch.column(0).to_pylist(), batch.column(1)):
                prefix, keys = b"", keys.as_py()
                for depth in range(len(keys) + 1):
                    for column, value in zip(columns, (name, prefix, depth, len(keys) - depth)):
                        column.append(value)
                    if depth < len(keys):
                        prefix = _step(prefix, keys[depth])
                if len(columns[0]) > 50_000:
                    yield out(columns)
                    columns = [[], [], [], []]
            if columns[0]:
                yield out(columns)

    return folded.select("name", F.col("path.key").alias("keys")).mapInArrow(rows, "name binary, prefix binary, depth bigint, below bigint")


class DoubleArray:
    """A trie in two arrays: the child of state s by code c is ``base[s] + c`` where ``check`` of that place is s.

    States are places; the root has place 0. Codes are dense turn numbers.
    """

    def __init__(self, size: int):
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.free = np.ones(size, bool)
        self.free[0] = False
        self.lowest = 1

    def _grow(self, size: int) -> None:
        more = max(size, 2 * len(self.base)) - len(self.base)
        self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
        self.free = np.concatenate([self.free, np.ones(more, bool)])

    def _spot(self, codes: np.ndarray) -> int:
        """Where the children of a state fit: the first of some free places, else past the end."""
        reach = codes - codes[0]
        while True:
            ahead = self.lowest + np.flatnonzero(self.free[self.lowest:self.lowest + 4096])
            if len(ahead):
                self.lowest = int(ahead[0])
                break
            if self.lowest >= len(self.free):
                self._grow(self.lowest + 4096)
                continue
            self.lowest += 4096
        ahead = ahead[:256 if len(codes) > 8 else 1024]
        if ahead[-1] + reach[-1] >= len(self.free):
            self._grow(int(ahead[-1] + reach[-1]) + 1)
        fits = self.free[ahead[:, None] + reach[None, :]].all(axis=1)
        if fits.any():
            return int(ahead[fits.argmax()])
        end = len(self.free) - int(self.free[::-1].argmin())
        if end + reach[-1] >= len(self.free):
            self._grow(int(end + reach[-1]) + 1)
        return end

    def add_children(self, state: int, codes: np.ndarray) -> None:
        """Make room for the ascending ``codes`` below a state that has no children yet."""
        first = self._spot(codes)
        self.base[state] = first - codes[0]
        places = self.base[state] + codes
        self.check[places], self.free[places] = state, False

    def child(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        places = self.base[states] + codes
        assert (self.check[places] == states).all()
        return places


NODES = ("upper boolean, name binary, parent binary, above array<binary>, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved bigint, chars bigint, ends string")


def shard_nodes(rows: pa.Table) -> pa.Table:
    """Nodes of one shard's ``(low, n, top, ends, path)`` rows; a path's nodes above depth ``top`` are upper, shared with other shards.

    Upper nodes carry their name, their ancestors' names and what the shard's other nodes below them add up to.
    """
    low, n, top = (rows[c].to_numpy() for c in ("low", "n", "top"))
    ends, paths = rows["ends"].to_pylist(), rows["path"].combine_chunks()
    length = np.array([len(p) for p in paths], np.int64)
    start = np.concatenate([[0], np.cumsum(length)])
    turns = paths.flatten()
    coded = turns.field("key").dictionary_encode()
    code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    chars = turns.field("chars").to_numpy()

    trie = DoubleArray(max(2 * len(code), 1024) + 1)
    state, alive = np.zeros(len(rows), np.int64), np.arange(len(rows))
    # one entry a node, level by level: place, parent's entry, code, characters, members, smallest member
    place, up, letter, weight = [np.zeros(1, np.int64)], [np.array([-1])], [np.array([-1])], [np.zeros(1, np.int64)]
    members, least, levels = [np.array([n.sum()])], [np.array([low.min()])], [0, 1]
    entry, ender = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    depth = 0
    while True:
        ender[alive] = entry[alive]
        alive = alive[length[alive] > depth]
        if not len(alive):
            break
        turn = start[alive] + depth
        pair, where, back = np.unique(state[alive] * len(names) + code[turn], return_index=True, return_inverse=True)
        above, codes = np.divmod(pair, len(names))
        cuts = np.flatnonzero(np.diff(above, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(pair)]):
            trie.add_children(int(above[a]), codes[a:b])
        went = trie.child(state[alive], code[turn])
        state[alive] = went
        fresh = len(pair)
        place.append(went[where])
        up.append(entry[alive[where]])
        letter.append(codes)
        weight.append(chars[turn[where]])
        grown = np.zeros(fresh, np.int64)
        np.add.at(grown, back, n[alive])
        members.append(grown)
        smallest = np.full(fresh, np.iinfo(np.int64).max)
        np.minimum.at(smallest, back, low[alive])
        least.append(smallest)
        entry[alive] = levels[-1] + back
        levels.append(levels[-1] + fresh)
        depth += 1

    up, letter, weight, members, least = (np.concatenate(c) for c in (up, letter, weight, members, least))
    total = levels[-1]
    level = np.repeat(np.arange(len(levels) - 1), np.diff(levels))
    children = np.bincount(up[1:], minlength=total)
    upper = np.zeros(total, bool)
    for i in range(len(rows)):  # the path's entries from its end up
        e = ender[i]
        while e >= 0 and level[e] >= top[i]:
            e = up[e]
        while e >= 0 and not upper[e]:
            upper[e] = True
            e = up[e]
    leaves = np.where(upper, 0, children == 0).astype(np.int64)
    saved = np.where(upper, 0, (members - 1) * weight)
    for a, b in zip(levels[-2:0:-1], levels[:0:-1]):
        np.add.at(leaves, up[a:b], leaves[a:b])
        np.add.at(saved, up[a:b], saved[a:b])
    own_children = np.bincount(up[1:][~upper[1:]], minlength=total)
    closing: list = [None] * total
    for i in range(len(rows)):
        closing[ender[i]] = ends[i]
    name: dict[int, bytes] = {}
    line: dict[int, list] = {}
    for e in np.flatnonzero(upper).tolist():
        name[e] = b"" if e == 0 else _step(name[int(up[e])], names[int(letter[e])].as_py())
        line[e] = [] if e == 0 else [*line[int(up[e])], name[int(up[e])]]
    shared = upper[up] & (np.arange(total) > 0)  # the parent is an upper node
    parent = [name[int(up[e])] if shared[e] else None for e in range(total)]
    return pa.table({
        "upper": pa.array(upper), "name": pa.array([name.get(e) for e in range(total)], pa.binary()), "parent": pa.array(parent, pa.binary()),
        "above": pa.array([line.get(e) for e in range(total)], pa.list_(pa.binary())), "conv_id": pa.array(least), "depth": pa.array(level),
        "parent_conv_id": pa.array(least[up], mask=shared | (up < 0)), "n_convs": pa.array(members), "n_children": pa.array(np.where(upper, own_children, children)),
        "n_leaves": pa.array(leaves), "saved": pa.array(saved), "chars": pa.array(weight), "ends": pa.array(closing, pa.string()),
    })


def prefix_nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``conversations(conv_id, turn, role, text)``: null roles and texts are empty, rows without conv_id belong to no conversation, repeated
    rows are turns of their own, of equal turn numbers the digest of role and text decides. Other columns are not read. A
    conversation whose rebuilt path is empty is a member of the root. No conversation: no rows.

    Texts leave the first scan as digests and lengths, so a long text weighs no more than a short one. Members of equal paths
    are counted before shuffles and their ids stream through one digest, one at a time. A conversation's turns meet in one task as
    forty bytes a turn. Prefixes with more than ``shard_turns`` turns below them are split at their children.
    """
    paths = rebuilt_paths(conversations).withColumn("name", F.unhex(F.sha2(F.array_join(F.transform("path.key", F.hex), ""), 256)))
    paths = stored(paths, "trie-paths")
    folded = paths.groupBy("name").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("path").alias("path"))
    folded = stored(folded.join(_ends(paths), "name"), "trie-folded")
    prefixes = _prefixes(folded)
    hot = prefixes.groupBy("prefix", "depth").agg(F.sum("below").alias("below")).where((F.col("below") > shard_turns) | (F.col("depth") == 0))
    tops = prefixes.join(hot.select("prefix"), "prefix").groupBy("name").agg((F.max("depth") + 1).alias("top"))
    row = folded.agg(F.sum(F.size("path"))).first()
    shards = int((row[0] or 0) // shard_turns) + 1
    cut = F.array_join(F.transform(F.slice("path.key", F.lit(1), F.col("top").cast("int")), F.hex), "")
    dealt = folded.join(tops, "name").select(F.pmod(F.xxhash64(cut), F.lit(shards)).alias("shard"), "low", "n", "top", "ends", "path")
    nodes = stored(dealt.groupBy("shard").applyInArrow(lambda rows: shard_nodes(rows), NODES), "trie-nodes")

    shared = nodes.where("upper").groupBy("name").agg(
        F.first("parent").alias("parent"), F.first("above").alias("above"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.first("chars").alias("chars"),
        F.max("ends").alias("ends"))
    shared = stored(shared, "trie-upper")
    inner = shared.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("shared_children"))
    whole = shared.join(inner, "name", "left").withColumn("n_children", F.col("n_children") + F.coalesce("shared_children", F.lit(0)))
    own = whole.select("name", F.explode(F.concat("above", F.array("name"))).alias("of"), F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("chars")).alias("gain"))
    own = own.groupBy(F.col("of").alias("name")).agg(F.sum("leaf").alias("leaf"), F.sum("gain").alias("gain"))
    whole = whole.join(own, "name").withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") + F.col("gain")})
    known = shared.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv"))
    if shared.count() <= MOST_BROADCAST:
        known = F.broadcast(known)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    below = nodes.where("NOT upper").select("parent", *columns).union(whole.withColumn("parent_conv_id", F.lit(None).cast("long")).select("parent", *columns))
    return below.join(known, "parent", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
