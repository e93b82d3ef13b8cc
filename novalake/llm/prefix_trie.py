"""The trie of conversation prefixes: one row for each distinct sequence of first turns.

Turns are sorted and cut into shards by ranges of conversation and turn; a conversation may go on over
several shards. What a shard needs of those before it (how far its first conversation has come, the first
turns it shares) is a few numbers, which the driver passes on from shard to shard like the bounds of a range.
A prefix is known by a 128-bit digest, the sum of its turns' hashes, each multiplied by a number that its place
gives. So a long conversation's digests are sums over shards as well.

A shard holds its part of the trie as a table of flat arrays. A minimal perfect hash gives each distinct digest its slot,
and the digest kept there tells whether a slot is really that of a digest asked for. Counts are scattered to the
slots and added up through the array of parents' slots, deepest first. What a conversation has beyond the shard is
added at its deepest turn in it. All numbers are sums over conversations, so that shards simply add up:

* members of a prefix, and the smallest one;
* childless nodes below it: the members that are the smallest of such a node;
* saved tokens: all members' bytes but those of the smallest at each node. A conversation is the smallest member
  from some depth on, down to its end; its bytes count above that depth only.
"""

from __future__ import annotations

import hashlib
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from novalake.llm.common import staged
from novalake.llm.token_store import PerfectHash, mixed

GROUP, LENGTHS = 5, 9
MOST_SHARED = LENGTHS - 1
SHARD_TURNS = 1 << 18
PIECE_BYTES = 1 << 20
NODE = ["d1", "d2", "depth"]
FOUND = "kind int, d1 bigint, d2 bigint, depth bigint, p1 bigint, p2 bigint, size bigint, prefix bigint, n bigint, least bigint"
SUMS = "d1 bigint, d2 bigint, depth bigint, n_leaves bigint, saved bigint"
PIECES = "d1 bigint, d2 bigint, depth bigint, part int, nth int, open boolean, data binary"
FAR = 1 << 62


class Start(NamedTuple):
    """What a shard knows of those before it."""

    base: int | None = None  # the group of the last conversation
    heads: tuple = ()  # (w1, w2, size) of the first turns of that group's base
    conv: int | None = None  # the last conversation
    turns: int = 0  # its turns so far
    digest: tuple = (0, 0)  # of its rebuilt turns so far
    prefix: int = 0  # their bytes
    following: int | None = None  # the first conversation of the next shard


class Turns(NamedTuple):
    """Rebuilt turns in order: conversations, depths, digests, parents' digests, bytes, bytes of the prefix; which
    ones go on from an earlier shard, are a conversation's last in this shard, and its last at all."""

    conv: np.ndarray
    depth: np.ndarray
    digest: np.ndarray
    parent: np.ndarray
    size: np.ndarray
    prefix: np.ndarray
    goes_on: np.ndarray
    deepest: np.ndarray
    end: np.ndarray


def base_of(conv: np.ndarray) -> np.ndarray:
    return conv - np.fmod(conv, GROUP)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i] .. starts[i] + counts[i] - 1, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = table.sort_by("place")
    prints = b"".join(table["print"].to_pylist())
    return table["conv_id"].to_numpy(), np.frombuffer(prints, "<u8").reshape(-1, 2), table["size"].to_numpy()


def rebuilt(conv: np.ndarray, words: np.ndarray, size: np.ndarray, start: Start) -> Turns:
    """The rebuilt turns that a shard is to give: a conversation's shared first turns come with its first own turn
    that stays, or with its last one if none stays."""
    first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    name, length = conv[first], np.diff(np.r_[first, len(conv)])
    before = np.zeros(len(first), np.int64)
    if start.conv == name[0]:
        before[0] = start.turns
    base = base_of(name)
    ends = np.r_[np.ones(len(name) - 1, bool), start.following != name[-1]]

    # Shared turns stand at `at` in the shard's turns, which follow those of earlier shards.
    old = np.array(start.heads, np.uint64).reshape(-1, 3)
    words, size = np.r_[old[:, :2], words], np.r_[old[:, 2].astype(np.int64), size]
    is_base = name == base
    bases, at, have = name[is_base], first[is_base] + len(old), np.minimum(length[is_base], MOST_SHARED)
    if start.base == base[0]:
        if is_base[0]:
            at[0], have[0] = 0, min(MOST_SHARED, len(old) + length[0])
        else:
            bases, at, have = np.r_[base[0], bases], np.r_[0, at], np.r_[len(old), have]
    found = np.searchsorted(bases, base)
    known = np.r_[bases, 0][found] == base
    known[found == len(bases)] = False
    at, have = np.r_[at, 0][found], np.where(known, np.r_[have, 0][found], 0)

    cut = np.array([zlib.crc32(str(c).encode()) % LENGTHS for c in name.tolist()], np.int64)
    cut[is_base] = 0
    shared = np.minimum(cut, have)
    total = before + length
    comes = np.where(total > cut, before <= cut, ends) & ~is_base
    skip = np.maximum(0, np.minimum(length, cut - before))
    empty = ends & (total <= cut) & (shared == 0)

    head_n = np.where(comes, shared, 0)
    own_n = length - skip
    row = np.r_[_ranges(at, head_n), _ranges(first + len(old) + skip, own_n)]
    seg = np.r_[np.repeat(np.arange(len(name)), head_n), np.repeat(np.arange(len(name)), own_n)]
    nth = np.r_[_ranges(np.zeros(len(name), np.int64), head_n),
                _ranges(shared + before + skip - cut, own_n)]
    order = np.lexsort((nth, seg))
    row, seg, nth = row[order], seg[order], nth[order]

    place = nth.astype(np.uint64)
    added = words[row] * np.stack([mixed(place, 11) | np.uint64(1), mixed(place, 12) | np.uint64(1)], axis=1)
    sums = np.r_[np.zeros((1, 2), np.uint64), np.cumsum(added, axis=0, dtype=np.uint64)]
    bytes_to = np.r_[0, np.cumsum(size[row])]
    opened = np.searchsorted(seg, seg)
    carried, passed = np.zeros((len(row), 2), np.uint64), np.zeros(len(row), np.int64)
    if start.conv == name[0]:
        carried[seg == 0], passed[seg == 0] = np.array(start.digest, np.uint64), start.prefix
    digest = sums[1:] - sums[opened] + carried
    prefix = bytes_to[1:] - bytes_to[opened] + passed
    last = np.r_[seg[1:] != seg[:-1], True][:len(seg)]
    goes_on = (opened == np.arange(len(seg))) & (nth > 0)
    out = Turns(name[seg], nth + 1, digest, digest - added, size[row], prefix, goes_on, last, last & ends[seg])
    none = name[empty]  # conversations without a turn are members of the root
    zeros, flags = np.zeros((len(none), 2), np.uint64), np.ones(len(none), bool)
    more = Turns(none, zeros[:, 0].astype(np.int64), zeros, zeros, zeros[:, 0].astype(np.int64),
                 zeros[:, 0].astype(np.int64), ~flags, flags, flags)
    return Turns(*(np.concatenate(pair) for pair in zip(out, more)))


class NodeTable:
    """The distinct prefixes of a shard's turns, and the root, in flat arrays."""

    def __init__(self, turns: Turns):
        digests = np.r_[np.zeros((1, 2), np.uint64), turns.digest]
        order = np.lexsort(digests.T)
        new = np.r_[True, (digests[order][1:] != digests[order][:-1]).any(axis=1)]
        distinct = digests[order][new]
        self.seed = 21
        while len(np.unique(self._hashed(distinct))) < len(distinct):
            self.seed += 1
        self.hash = PerfectHash.of(self._hashed(distinct))
        self.digest = np.zeros_like(distinct)
        self.digest[self.hash.slots(self._hashed(distinct))] = distinct
        self.slot = self.slots(turns.digest)
        self.parent, self.depth, self.size, self.prefix = (np.full(len(distinct), v, np.int64) for v in (-1, 0, 0, 0))
        inner = turns.depth > 0
        self.parent[self.slot[inner]] = self.slots(turns.parent)[inner]
        self.above = np.zeros_like(self.digest)
        for mine, theirs in ((self.depth, turns.depth), (self.size, turns.size), (self.prefix, turns.prefix),
                             (self.above, turns.parent)):
            mine[self.slot] = theirs
        order = np.argsort(-self.depth, kind="stable")
        order = order[self.parent[order] >= 0]
        self.levels = np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1) if len(order) else []

    def _hashed(self, digests: np.ndarray) -> np.ndarray:
        return digests[:, 0] ^ mixed(digests[:, 1].copy(), self.seed)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 if it is not the one kept there."""
        slots = self.hash.slots(self._hashed(digests))
        slots[(self.digest[slots] != digests).any(axis=1)] = -1
        return slots

    def known_parents(self, turns: Turns) -> tuple[np.ndarray, np.ndarray]:
        """Turns that go on from an earlier shard though their parent is a node here too, by other conversations; and the
        parents' slots. What such a turn passes up has been counted there already, and is to be taken off."""
        at = np.flatnonzero(turns.goes_on)
        slots = self.slots(turns.parent[at])
        return at[slots >= 0], slots[slots >= 0]

    def gathered(self, values: np.ndarray, how: np.ufunc) -> np.ndarray:
        """Values by slot, with those of all nodes below."""
        for level in self.levels:
            how.at(values, self.parent[level], values[level])
        return values


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))


def _nodes(turns: Turns) -> pa.Table:
    """The shard's nodes (kind 0), and each conversation that ends here with its end node (kind 1)."""
    table = NodeTable(turns)
    n, least = np.zeros(len(table.depth), np.int64), np.full(len(table.depth), np.iinfo(np.int64).max)
    np.add.at(n, table.slot[turns.deepest], 1)
    np.minimum.at(least, table.slot[turns.deepest], turns.conv[turns.deepest])
    _, again = table.known_parents(turns)
    np.subtract.at(n, again, 1)
    table.gathered(n, np.add)
    table.gathered(least, np.minimum)
    e, zero = turns.end, np.zeros(int(turns.end.sum()), np.int64)
    real = n > 0
    columns = [(np.zeros(int(real.sum())), zero + 1)]
    columns += [(a[real, i], b[e, i]) for a, b in ((table.digest, turns.digest),) for i in (0, 1)]
    columns += [(table.depth[real], turns.depth[e])]
    columns += [(table.above[real, i], turns.parent[e, i]) for i in (0, 1)]
    columns += [(table.size[real], turns.size[e]), (table.prefix[real], turns.prefix[e]), (n[real], zero),
                (least[real], turns.conv[e])]
    names = [c.split()[0] for c in FOUND.split(", ")]
    out = pa.table({k: pa.concat_arrays([_signed(a), _signed(b)]) for k, (a, b) in zip(names, columns)})
    return out.set_column(0, "kind", out["kind"].cast(pa.int32()))


def _sums(turns: Turns, tops: pa.Table) -> pa.Table:
    """Childless nodes and saved tokens below each node, as far as this shard's conversations tell."""
    order = np.argsort(tops["conv_id"].to_numpy())
    at = order[np.searchsorted(tops["conv_id"].to_numpy(), turns.conv, sorter=order)]
    top, ahead, leaf = (tops[c].to_numpy()[at] for c in ("top", "ahead", "leaf"))
    table = NodeTable(turns)
    leaves, saved = np.zeros(len(table.depth), np.int64), np.zeros(len(table.depth), np.int64)
    low = turns.deepest
    np.add.at(leaves, table.slot[low], leaf[low])
    np.add.at(saved, table.slot, turns.size * (turns.depth < top))
    np.add.at(saved, table.slot[low], np.maximum(0, ahead - turns.prefix)[low])  # its bytes in later shards
    on, again = table.known_parents(turns)
    np.subtract.at(leaves, again, leaf[on])
    np.subtract.at(saved, again, np.maximum(0, ahead - turns.prefix + turns.size)[on])
    table.gathered(leaves, np.add)
    table.gathered(saved, np.add)
    kept = (leaves != 0) | (saved != 0)
    return pa.table({"d1": _signed(table.digest[kept, 0]), "d2": _signed(table.digest[kept, 1]),
                     "depth": _signed(table.depth[kept]), "n_leaves": _signed(leaves[kept]),
                     "saved": _signed(saved[kept])})


def _starts(turns: DataFrame) -> dict[int, Start]:
    """What each shard knows of those before it. The driver gets a row of bounded size from each shard, twice: how far
    its last conversation has come, then, with that known, its sums."""
    def first(table: pa.Table) -> pa.Table:
        conv, words, size = _columns(table)
        base = base_of(conv)
        heads = np.flatnonzero((conv == base[-1]) & (base == conv))[:MOST_SHARED]
        return pa.table({"shard": table["shard"][:1], "first": [int(conv[0])], "last": [int(conv[-1])],
                         "turns": [int((conv == conv[-1]).sum())],
                         "w1": [words[heads, 0].view(np.int64).tolist()], "w2": [words[heads, 1].copy().view(np.int64).tolist()],
                         "size": [size[heads].tolist()]},
                        schema=pa.schema([("shard", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("turns", pa.int64()),
                                          *((n, pa.list_(pa.int64())) for n in ("w1", "w2", "size"))]))

    told = turns.groupBy("shard").applyInArrow(lambda t: first(t), (
        "shard bigint, first bigint, last bigint, turns bigint, w1 array<bigint>, w2 array<bigint>, size array<bigint>"))
    rows = sorted(told.collect())
    starts, now = {}, Start()
    for n, row in enumerate(rows):
        starts[row.shard] = now._replace(following=rows[n + 1].first if n + 1 < len(rows) else None)
        heads = tuple((a & 2**64 - 1, b & 2**64 - 1, s) for a, b, s in zip(row.w1, row.w2, row["size"]))
        base = int(base_of(np.array([row.last]))[0])
        now = Start(base, ((now.heads if now.base == base else ()) + heads)[:MOST_SHARED], row.last,
                    row.turns + (now.turns if now.conv == row.last else 0))

    def second(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        conv, words, size = _columns(table)
        out = rebuilt(conv, words, size, starts[shard])
        mine = np.flatnonzero((out.conv == conv[-1]) & out.deepest & (out.depth > 0))
        digest, prefix = (out.digest[mine[-1]], out.prefix[mine[-1]]) if len(mine) else (np.zeros(2, np.uint64), 0)
        return pa.table({"shard": [shard], "d1": _signed(digest[:1]), "d2": _signed(digest[1:]), "prefix": [int(prefix)]})

    sums = turns.groupBy("shard").applyInArrow(lambda t: second(t), "shard bigint, d1 bigint, d2 bigint, prefix bigint")
    now = (0, 0, 0)
    for (shard, a, b, prefix), row in zip(sorted(map(tuple, sums.collect())), rows):
        goes_on = starts[shard].conv
        starts[shard] = starts[shard]._replace(digest=now[:2], prefix=now[2])
        carried = now if goes_on == row.last else (0, 0, 0)
        now = ((carried[0] + a) % 2**64, (carried[1] + b) % 2**64, carried[2] + prefix)
    return starts


def _hash_of_ends(ends: DataFrame) -> DataFrame:
    """``d1, d2, depth, ends_sha256``: the hash of the ids that end at a node, in order. Ranges of (node, id) are joined to
    pieces in parallel; a node that reaches beyond one range has its pieces hashed one after the other, as the
    hash wants it, without being held."""
    def join(batches):
        part, node, ids, held, nth, inner = None, None, [], 0, 0, False

        def row(open_):
            data = ",".join(map(str, ids)).encode()
            if not open_:
                data = hashlib.sha256(data).hexdigest().encode()
            return dict(zip(names, [*node, part, nth, open_, data]))

        names = [c.split()[0] for c in PIECES.split(", ")]
        schema = pa.schema([*((n, pa.int64()) for n in NODE), ("part", pa.int32()), ("nth", pa.int32()),
                            ("open", pa.bool_()), ("data", pa.binary())])
        for batch in batches:
            rows = []
            for *one, p, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "part", "conv_id"))):
                if one != node:
                    if node is not None:
                        rows.append(row(not inner))
                    inner, nth = node is not None, 0
                    node, part, ids, held = one, p, [], 0
                elif held >= PIECE_BYTES:  # a large node is never told whole by one row
                    rows.append(row(True))
                    ids, held, nth, inner = [], 0, nth + 1, False
                ids.append(conv)
                held += 20
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist([row(True)], schema)

    def whole(batches):
        node, hashed = None, None
        schema = pa.schema([*((n, pa.int64()) for n in NODE), ("ends_sha256", pa.string())])

        def row():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, [*node, hashed.hexdigest()]))], schema)

        for batch in batches:
            for *one, data in zip(*(batch.column(c).to_pylist() for c in (*NODE, "data"))):
                if one != node:
                    if node is not None:
                        yield row()
                    node, hashed = one, hashlib.sha256(data)
                else:
                    hashed.update(b"," + data)
        if node is not None:
            yield row()

    keys = [*NODE, "conv_id"]
    ranged = ends.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*keys)
    pieces = staged(ranged.select(*keys, "part").mapInArrow(join, PIECES), "ends")
    order = [*NODE, "part", "nth"]
    rest = pieces.filter("open").repartition(*NODE).sortWithinPartitions(*order).select(*NODE, "data")
    rest = rest.mapInArrow(whole, "d1 bigint, d2 bigint, depth bigint, ends_sha256 string")
    return pieces.filter("not open").select(*NODE, F.col("data").cast("string").alias("ends_sha256")).unionByName(rest)


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations, with ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by turn (null first), then by role and text; null role and text are empty. Rows that repeat are turns of
    their own. Rows without conversation id take no part. The remainder of a negative id is not positive, so the ids
    -4 to 4 share the base 0. An empty table has no node, not even a root. Other columns are ignored.
    """
    spark = conversations.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("bigint")
    own = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(conv.isNotNull()).select(
        (conv - conv % GROUP).alias("base"), (conv % GROUP != 0).alias("later"), conv.alias("conv_id"),
        F.col("turn").alias("turn"), F.concat(role, F.lit("\0"), text).alias("content"),
        F.unhex(F.substring(F.sha2(own, 256), 1, 32)).alias("print"),
        F.octet_length(text).cast("bigint").alias("size"))
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-conversations.count() // SHARD_TURNS))
    keys = ["base", "later", "conv_id", F.col("turn").asc_nulls_first()]
    ranged = rows.repartitionByRange(parts, *keys, F.substring("content", 1, 64)).sortWithinPartitions(*keys, "content")
    turns = staged(ranged.select("conv_id", "print", "size", F.monotonically_increasing_id().alias("place")), "turns")
    turns = turns.withColumn("shard", F.shiftright("place", 33))
    starts = _starts(turns)
    if not starts:
        return spark.createDataFrame([], (
            "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
            "saved_tokens bigint, ends_sha256 string"))
    shared = spark.sparkContext.broadcast(starts)  # some numbers for each shard

    def of(table: pa.Table) -> Turns:
        return rebuilt(*_columns(table), shared.value[table["shard"][0].as_py()])

    found = staged(turns.groupBy("shard").applyInArrow(lambda t: _nodes(of(t)), FOUND), "shard-nodes")
    nodes = staged(found.filter("kind = 0").groupBy(*NODE).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("size").alias("size"), F.max("prefix").alias("prefix"),
        F.sum("n").alias("n_convs"), F.min("least").alias("conv_id")), "nodes")
    children = nodes.filter("depth > 0").groupBy(
        F.col("p1").alias("d1"), F.col("p2").alias("d2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    nodes = staged(nodes.join(children, NODE, "left").fillna(0, ["n_children"]), "nodes")

    ends = found.filter("kind = 1").select(*NODE, "prefix", F.col("least").alias("conv_id"))
    tops = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.min(F.col("prefix") - F.col("size")).alias("ahead"),
                                        F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    tops = ends.select("conv_id", "prefix").join(tops, "conv_id", "left").select(
        "conv_id", F.coalesce("top", F.lit(FAR)).alias("top"), F.coalesce("ahead", "prefix").alias("ahead"),
        F.coalesce("leaf", F.lit(0)).cast("bigint").alias("leaf"))
    met = turns.select(F.col("shard").alias("shard"), F.col("conv_id").alias("conv_id")).distinct().join(tops, "conv_id")
    sums = turns.groupBy("shard").cogroup(met.groupBy("shard")).applyInArrow(lambda t, m: _sums(of(t), m), SUMS)
    sums = sums.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    root = nodes.filter("depth = 0").first()["conv_id"]
    parents = nodes.filter("n_children > 0 and depth > 0").select(
        F.col("d1").alias("p1"), F.col("d2").alias("p2"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(sums, NODE, "left").join(_hash_of_ends(ends), NODE, "left")
    full = full.join(parents, ["p1", "p2", "depth"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return full.select(
        "conv_id", "depth", F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", F.coalesce("n_leaves", F.lit(0)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
