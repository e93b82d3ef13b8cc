"""Exact join of documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

Two sets link only if their symmetric difference is at most H, a ninth of their sizes together (for
0.8). The universe of shingles is cut by hash into m = H + 1 + e segments, a cut for each size band;
sets that link have e + 1 equal segments at least. Every set is indexed by the subsets it has in its
segments, in its own band's cut and in the one below, so that partners in neighbouring bands meet.

Segments without shingles are allocated nothing: an equal pair of them says little. As long as a
set has at most e of those, one of the equal segments has shingles. A set with more ("spread out")
meets sets of the other sort by the argument for the partner; for two such sets the one-deletion
neighbourhoods of their segments are indexed as well, so that a segment may differ by one shingle
and counts twice, and where that is still too little, the empty segments too. The number e is the one that costs
the fewest index entries in the band, neighbourhoods of the spread-out sets included.

What a set does not need of its e it spends on its hottest segments: those whose subset most sets
share, in one order for all (a passage that many documents quote, for one). With e + 1 equal
segments, a pair's least hot one is among the e hottest of neither, so it is always left.

Candidates share an index entry. First the members of each group are compared with one of them,
the one that shares most entries; then, for groups that still lie in several components, all pairs across components are taken, each in the first group that has both where that is known. Pairs that a parity
sketch (a lower bound of the difference) excludes are left out; links are verified on the shingles
of the texts.
"""

from __future__ import annotations

from collections.abc import Callable
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest
from zstandard import ZstdCompressor, ZstdDecompressor

from novalake.llm.common import Places, pack_longs, slices, staged, texts_of, unpack_longs
from novalake.llm.components import components
from novalake.llm.lm_scoring import word_hashes

WORDS = 5
NUMERATOR, DENOMINATOR = 80, 100
BUCKET_BYTES = 24 << 20
SLICE_BYTES = 4 << 20
SEEN_SETS = 500_000
MAX_SLACK = 64
SPREAD = 255
FIRST_GROUPS = 6
BLOCK_SETS, BUCKET_SETS = 512, 16_384

U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0x9FB21C651E98DF25)
    return h ^ (h >> U(32))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word 5-grams; of fewer words, of the whole sequence.
    Two of a pair of 20,000-shingle sets collide with a probability of 2e-11."""
    w = word_hashes(text.encode("utf-8", "surrogatepass"))
    size = min(words, len(w))
    if not size:
        return w
    h = np.full(len(w) - size + 1, size, U)
    for n in range(size):
        h = mix(h * U(0x9E3779B97F4A7C15) + w[n : len(w) - size + 1 + n])
    return np.unique(h)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(a) + len(b) - both) and both > 0


def most_difference(sizes: int) -> int:
    """The largest symmetric difference of linked sets with so many shingles together."""
    return (DENOMINATOR - NUMERATOR) * sizes // (DENOMINATOR + NUMERATOR)


def band_edges(most: int) -> np.ndarray:
    """First sizes of the bands: a partner is in the same band or a neighbouring one."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, DENOMINATOR * (edges[-1] - 1) // NUMERATOR + 1))
    return np.array(edges)


class Cut:
    """The cut of the universe for pairs whose smaller set is in one band."""

    def __init__(self, first: int, last: int):
        self.difference = most_difference(last + DENOMINATOR * last // NUMERATOR)
        costs = [(self._cost(first, e), e) for e in range(MAX_SLACK + 1)]
        self.slack = min(costs)[1]
        self.segments = self.difference + 1 + self.slack

    def _cost(self, size: int, slack: int) -> float:
        """Entries for a set of ``size``: its segments with shingles, and the neighbourhoods times the
        probability (Poisson) of more empty segments than ``slack``."""
        segments = self.difference + 1 + slack
        empty = segments * (1 - 1 / segments) ** size
        within = term = exp(-empty)
        for n in range(1, slack + 1):
            term *= empty / n
            within += term
        return segments - empty + max(0.0, 1 - within) * (size + segments) * 4


class Cuts(dict):
    """Cuts by band, made when asked for."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges

    def __missing__(self, band: int) -> Cut:
        self[band] = Cut(int(self.edges[band]), int(self.edges[band + 1] - 1))
        return self[band]


def _entries(hashes: np.ndarray, sizes: np.ndarray, band: int, cut: Cut):
    """Index keys of many sets in one cut, the number of the set each belongs to, whether it is for pairs
    of spread-out sets; and for each set how many entries it may do without."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = owner * cut.segments + ((mix(hashes ^ U(band)) >> U(20)) % U(cut.segments)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    place, content = place[order], mix(hashes[order] + U(0x632BE59BD9B4E019))
    starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    filled, totals = place[starts], np.add.reduceat(content, starts)
    owners, segment = np.divmod(filled, cut.segments)

    def key(segment, total, spread):
        return mix(total + mix(segment.astype(U) + U((2 * band + spread) << 32)))

    keys, of = [key(segment, totals, 0)], [owners]
    plain = len(totals)
    used = np.bincount(owners, minlength=len(sizes))
    spread = cut.segments - used > cut.slack
    if spread.any():
        counts = np.diff(np.append(starts, len(place)))
        mine = spread[owners]
        keys.append(key(segment[mine], totals[mine], 1))
        of.append(owners[mine])
        which = np.repeat(np.arange(len(starts)), counts)  # one shingle left out of a segment of several
        which, left_out = (x[mine[which] & (counts[which] > 1)] for x in (which, content))
        keys.append(key(segment[which], totals[which] - left_out, 1))
        of.append(owners[which])
        covered = used + np.bincount(owners, counts > 1, len(sizes))
        for n in np.flatnonzero(spread & (covered <= cut.difference)).tolist():
            empty = np.setdiff1d(np.arange(cut.segments), segment[owners == n])
            keys.append(key(empty, np.zeros(len(empty), U), 1))
            of.append(np.full(len(empty), n))
    keys = np.concatenate(keys)
    return keys, np.concatenate(of), np.arange(len(keys)) >= plain, np.maximum(cut.slack - cut.segments + used, 0)


def index_entries(sets: list[np.ndarray], cuts: Cuts):
    """Keys of all sets in their own band's cut and the one below, the set each belongs to, the band it is
    for (``SPREAD`` for pairs of spread-out sets); and how many entries each set may do without in
    the two cuts. A cut that permits no difference is left out, since equal sets are one already."""
    sizes = np.array([len(s) for s in sets])
    bands = np.searchsorted(cuts.edges, sizes, side="right") - 1
    keys, owners, of_band = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
    spare = np.zeros((2, len(sets)), np.int32)
    for band in np.unique(np.concatenate((bands, bands - 1))).tolist():
        mine = np.flatnonzero((bands == band) | (bands == band + 1))
        if band < 0 or cuts[band].difference == 0:
            continue
        k, of, spread, free = _entries(np.concatenate([sets[i] for i in mine]), sizes[mine], band, cuts[band])
        keys.append(k)
        owners.append(mine[of])
        of_band.append(np.where(spread, SPREAD, band).astype(np.uint8))
        spare[bands[mine] - band, mine] = free
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(of_band), spare


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of the numbers of shingles in about as many cells as there are shingles."""
    cells = 1 << max(6, (len(hashes) - 1).bit_length())
    odd = np.bincount(((hashes >> U(8)) & U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def possible(sizes_a, sizes_b, sketches_a: list[bytes], sketches_b: list[bytes]) -> np.ndarray:
    """Which pairs the sizes and the sketches do not exclude."""
    out = np.zeros(len(sizes_a), bool)
    for n, (a, b, x, y) in enumerate(zip(sizes_a, sizes_b, sketches_a, sketches_b)):
        if DENOMINATOR * min(a, b) >= NUMERATOR * max(a, b):
            x, y = np.frombuffer(x, U), np.frombuffer(y, U)
            size = min(len(x), len(y))
            apart = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()
            out[n] = apart <= most_difference(a + b)
    return out


INDEXED = ("bucket int, keys binary, owners binary, bands binary, docs binary, no_id binary, places binary, sizes binary, "
           "sets binary, spare binary, sketches array<binary>")
ROWS = {"doc_id": "bigint", "place": "bigint", "n": "bigint", "set_id": "bigint", "sketch": "binary", "band": "int", "spare": "int",
        "spare_below": "int", "members": "array<bigint>", "group_id": "bigint", "entries": "bigint"}
GROUPED = ", ".join(f"{n} {t}" for n, t in ROWS.items())


def _index(docs: DataFrame, buckets: int, most: int) -> DataFrame:
    schema = pa.schema([
        ("bucket", pa.int32()), *((n, pa.binary()) for n in (
            "keys", "owners", "bands", "docs", "no_id", "places", "sizes", "sets", "spare")),
        ("sketches", pa.list_(pa.binary()))])
    empty = dict.fromkeys(schema.names)

    def run(batches):
        cuts, seen = Cuts(band_edges(most)), set()
        for batch in slices(batches, "body", SLICE_BYTES):
            sets = [shingles(t) for t in texts_of(batch, "body")]
            ids = [xxh3_64_intdigest(s.tobytes()) for s in sets]
            if len(seen) > SEEN_SETS:
                seen.clear()
            new = {}
            for n, i in enumerate(ids):
                if len(sets[n]) and i not in seen:
                    seen.add(i)
                    new[i] = n
            found, no_id = pack_longs(batch.column("doc"))
            keys, owners, bands, spare = index_entries([sets[n] for n in new.values()], cuts)
            own_spare = np.zeros((3, len(sets)), np.int32)
            own_spare[0] = np.searchsorted(cuts.edges, [len(x) for x in sets], side="right") - 1
            own_spare[1:, list(new.values())] = spare
            rows = [empty | {
                "bucket": ids[0] % buckets, "docs": found, "no_id": no_id,
                "places": batch.column("place").to_numpy(zero_copy_only=False).tobytes(),
                "sizes": np.array([len(s) for s in sets], np.int64).tobytes(), "sets": np.array(ids, U).tobytes(),
                "spare": own_spare.tobytes(), "sketches": [sketch(s) if new.get(i) == n else None for n, (i, s) in enumerate(zip(ids, sets))]}]
            if new:
                own = np.array(list(new), U)[owners]
                bucket = (keys % U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else []
                for a, b in zip(edges, [*edges[1:], len(order)]):
                    part = order[a:b]
                    rows.append(empty | {
                        "bucket": int(bucket[part[0]]), "owners": own[part].tobytes(),
                        "keys": (keys[part] >> U(32)).astype(np.uint32).tobytes(), "bands": bands[part].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.mapInArrow(run, INDEXED)


def _group(blocks: pd.DataFrame) -> pd.DataFrame:
    """One bucket of the index: the documents that came along, and the distinct groups of sets that
    share an entry."""
    parts = []
    along = blocks[blocks["docs"].notna()]
    for r in along.itertuples():
        sizes = np.frombuffer(r.sizes, np.int64)
        ids = pd.arrays.IntegerArray(np.frombuffer(r.sets, np.int64).copy(), sizes == 0)
        parts.append(pd.DataFrame({
            "doc_id": unpack_longs(r.docs, r.no_id), "place": np.frombuffer(r.places, np.int64), "n": sizes, "set_id": ids, "sketch": list(r.sketches),
            **dict(zip(("band", "spare", "spare_below"), np.frombuffer(r.spare, np.int32).reshape(3, -1)))}))
    entries = blocks[blocks["keys"].notna()]
    if len(entries):
        keys = np.frombuffer(b"".join(entries["keys"]), np.uint32)
        owners = np.frombuffer(b"".join(entries["owners"]), np.int64)
        bands = np.frombuffer(b"".join(entries["bands"]), np.uint8)
        keys = keys.astype(U) << U(8) | bands
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1]))
        keys, owners = keys[new], owners[new]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        several = sizes > 1
        if several.any():
            bands = keys[starts] & U(255)
            ids = np.add.reduceat(mix(owners.view(U)), starts) ^ mix(sizes.astype(U) + (bands << U(32)))
            starts, sizes, ids, bands = starts[several], sizes[several], ids[several], bands[several]
            ids, once, count = np.unique(ids, return_index=True, return_counts=True)
            members = [owners[a : a + n] for a, n in zip(starts[once].tolist(), sizes[once].tolist())]
            parts.append(pd.DataFrame({"members": members, "group_id": ids.view(np.int64), "entries": count,
                                       "band": bands[once].astype(np.int32)}))
    longs = {n: "Int64" for n, t in ROWS.items() if t in ("bigint", "int")}
    parts = [p.reindex(columns=list(ROWS)).astype(longs) for p in parts]
    out = pd.concat(parts) if parts else pd.DataFrame(columns=list(ROWS))
    return out.astype(object).where(out.notna(), None)


def _across(members: pd.DataFrame) -> pd.DataFrame:
    """Pairs of each group that lie in different components and may link, between two blocks of its members (or within
    one). ``groups`` has the first few groups of each member: a pair is taken in the first one both have, or wherever
    it meets if there is none. A call has many groups, one after the other."""
    members = members.sort_values(["group_id", "one", "other", "block", "set_id"])
    keys = members[["group_id", "one", "other"]].to_numpy(np.int64)
    starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    ids, sizes, labels, blocks = (members[c].to_numpy(np.int64) for c in ("set_id", "n", "label", "block"))
    sketches, groups = members["sketch"].tolist(), members["groups"].tolist()
    found = []
    for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
        group, one, other = keys[begin].tolist()
        middle = begin + int(np.count_nonzero(blocks[begin:end] == one))  # where the second block begins, if there are two
        if (labels[begin:end] == labels[begin]).all() or one != other and middle in (begin, end):
            continue
        parts = [np.frombuffer(s, U) for s in sketches[begin:end]]
        size = min(map(len, parts))
        bits = np.stack([_folded(s, size) for s in parts])
        for a in range(begin, middle):
            first = a + 1 if one == other else middle
            small, large = np.minimum(sizes[a], sizes[first:end]), np.maximum(sizes[a], sizes[first:end])
            rest = np.flatnonzero((DENOMINATOR * small >= NUMERATOR * large) & (labels[first:end] != labels[a])) + first
            if len(rest):
                apart = np.bitwise_count(bits[rest - begin] ^ bits[a - begin]).sum(axis=1)
                for b in rest[apart <= most_difference(sizes[a] + sizes[rest])].tolist():
                    both = set(groups[a]) & set(groups[b])
                    if not both or min(both) == group:
                        found.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
    found = np.array(found, np.int64).reshape(-1, 2)
    return pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})


TextsAt = Callable[[DataFrame], DataFrame]


def _verified(pairs: DataFrame, sets: DataFrame, texts_at: TextsAt) -> DataFrame:
    """The pairs ``u, v`` of sets that link, by the shingles of a document of each. Only the texts of these documents
    cross a shuffle, compressed."""
    needed = pairs.select(F.col("u").alias("set_id")).union(pairs.select("v")).distinct()
    chosen = texts_at(sets.join(needed, "set_id").select("place"))

    def identify(batches):
        squeeze = ZstdCompressor().compress
        for batch in slices(batches, "body", SLICE_BYTES):
            texts = texts_of(batch, "body")
            ids = [xxh3_64_intdigest(shingles(t).tobytes()) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, U).view(np.int64)), pa.array(
                [squeeze(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary())], ["set_id", "text"])

    texts = staged(chosen.select("body").mapInArrow(identify, "set_id bigint, text binary"), "jaccard-texts")

    def check(batches):
        held: dict[int, np.ndarray] = {}
        expand = ZstdDecompressor().decompress

        def of(i, text):
            if i not in held:
                if len(held) > 500:
                    held.clear()
                held[i] = shingles(expand(text).decode("utf-8", "surrogatepass"))
            return held[i]

        for batch in slices(batches, "text_u", SLICE_BYTES):
            rows = zip(*(batch.column(n).to_pylist() for n in ("u", "v", "text_u", "text_v")))
            keep = [linked(of(u, a), of(v, b)) for u, v, a, b in rows]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("set_id").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("set_id").alias("v"), F.col("text").alias("text_v"))
    return staged(pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v")
                  .mapInArrow(check, "u bigint, v bigint"), "jaccard-links")


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct pairs that sizes and sketches do not exclude."""
    of_u = sets.select(F.col("set_id").alias("u"), F.col("n").alias("n_u"), F.col("sketch").alias("sketch_u"))
    of_v = sets.select(F.col("set_id").alias("v"), F.col("n").alias("n_v"), F.col("sketch").alias("sketch_v"))

    def keep(batches):
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("n_u", "n_v", "sketch_u", "sketch_v")]
            yield batch.select(["u", "v"]).filter(pa.array(possible(*columns), pa.bool_()))

    joined = staged(pairs.distinct(), "jaccard-pairs").join(of_u, "u").join(of_v, "v")
    return joined.select("u", "v", "n_u", "n_v", "sketch_u", "sketch_v").mapInArrow(keep, "u bigint, v bigint")


def _with_center(members: DataFrame) -> DataFrame:
    """Pairs of each group's center, the member that shares most entries, with its other members."""
    center = members.groupBy("group_id").agg(F.max(F.struct("weight", "set_id")).alias("c")).select(
        "group_id", F.col("c.set_id").alias("center"))
    pairs = members.join(center, "group_id").filter("set_id <> center")
    return pairs.select(F.least("set_id", "center").alias("u"), F.greatest("set_id", "center").alias("v"))


def _split_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``group_id, set_id, label`` of the groups of three and more that lie in several components."""
    named = members.filter("size > 2").select("group_id", "set_id").join(
        labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    named = staged(named.withColumn("label", F.coalesce("label", "set_id")), "jaccard-members")
    split = named.groupBy("group_id").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
    return staged(named.join(split.select("group_id"), "group_id", "left_semi"), "jaccard-members")


def _in_blocks(members: DataFrame) -> tuple[DataFrame, int]:
    """Members of a group dealt into blocks of about BLOCK_SETS, each with every block; a bucket has some pairs of blocks,
    of about BUCKET_SETS members together. And the number of buckets."""
    sizes = members.groupBy("group_id").agg(F.count("*").alias("had"))
    sizes = staged(sizes.withColumn("parts", F.ceil(F.col("had") / BLOCK_SETS)), "jaccard-sizes")
    rows = sizes.agg(F.coalesce(F.sum(F.col("had") * F.col("parts")), F.lit(0))).first()[0]
    buckets = 1 + rows // BUCKET_SETS
    dealt = members.join(sizes, "group_id").withColumn("block", F.pmod(F.xxhash64("set_id"), "parts"))
    met = dealt.select("*", F.explode(F.expr("sequence(0L, parts - 1)")).alias("met"))
    met = met.select("group_id", "set_id", "label", "block", F.least("block", "met").alias("one"),
                     F.greatest("block", "met").alias("other"))
    return met.withColumn("bucket", F.pmod(F.xxhash64("group_id", "one", "other"), F.lit(buckets))), buckets


def _needed(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """``group_id, set_id, size, weight``: members of groups, without the hottest entries each set can spare. The
    weight is the size of all groups of the set together."""
    members = groups.select("group_id", "band", "entries", F.size("members").alias("size"),
                            F.explode("members").alias("set_id"))
    spare = sets.select("set_id", F.col("band").alias("own"), "spare", "spare_below")
    allowed = F.when(F.col("band") == F.col("own"), F.col("spare")).when(
        F.col("band") == F.col("own") - 1, F.col("spare_below")).otherwise(0)
    hottest = Window.partitionBy("set_id", "band").orderBy(F.desc("size"), "group_id")
    counted = members.join(spare, "set_id").withColumn("spent", F.sum("entries").over(hottest)).withColumn(
        "weight", F.sum("size").over(Window.partitionBy("set_id")))
    kept = counted.filter(F.col("spent") > allowed)
    return staged(kept.select("group_id", "set_id", "size", "weight"), "jaccard-members")


def _linked_sets(groups: DataFrame, sets: DataFrame, texts_at: TextsAt) -> DataFrame:
    """``node, label``: the components of the sets that link with others."""
    members = _needed(groups, sets)
    tried = staged(_possible(_with_center(members), sets), "jaccard-pairs")
    links = _verified(tried, sets, texts_at)
    labels = components(links)
    apart = _split_groups(members, labels)
    of_set = apart.groupBy("set_id").agg(F.slice(F.sort_array(F.collect_set("group_id")), 1, FIRST_GROUPS).alias("groups"))
    dealt, buckets = _in_blocks(apart)
    dealt = dealt.join(of_set, "set_id").join(sets.select("set_id", "n", "sketch"), "set_id")
    more = staged(dealt.repartition(buckets, "bucket").groupBy("bucket")
                  .applyInPandas(_across, "u bigint, v bigint").distinct(), "jaccard-pairs")
    more = staged(more.join(tried, ["u", "v"], "left_anti"), "jaccard-pairs")
    return labels if more.isEmpty() else components(links.union(_verified(more, sets, texts_at)))


def join(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row, ``set_id`` beside them.

    Rows with equal sets are one node, so copies are never paired. A document without words is alone:
    its component is its own id. Null ids do not take part in the least id of a component.
    """
    return _join(Places(docs.select(F.col(key).alias("doc"), F.col(text).alias("body"))), "body", "place", "doc").drop("place")


def _join(docs: Places, text: str, at: str, key: str) -> DataFrame:
    """``at`` is a name for the rows' places. It may be the key as well: a row is then known by its place."""
    slim = docs.rows(at).select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("body"), F.col(at).alias("place"))
    spark = slim.sparkSession

    def texts_at(places: DataFrame) -> DataFrame:
        return docs.rows_at(places, at).select(F.col(text).alias("body"))

    size, longest = slim.agg(F.sum(F.octet_length("body")), F.max(F.octet_length("body"))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * partitions, int((size or 0) // BUCKET_BYTES))
    grouped = _index(slim, buckets, (longest or 0) // 2 + 2).groupBy("bucket").applyInPandas(_group, GROUPED)
    grouped = staged(grouped, "jaccard-index")
    rows = grouped.filter("group_id is null").drop("members", "group_id", "entries")
    sets = staged(rows.filter("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.min("place").alias("place"), F.first("n").alias("n"), F.first("band").alias("band"),
        F.max("spare").alias("spare"), F.max("spare_below").alias("spare_below"),
        F.first("sketch", ignorenulls=True).alias("sketch")), "jaccard-sets")
    groups = staged(grouped.filter("group_id is not null").groupBy("group_id").agg(
        F.first("members").alias("members"), F.first("band").alias("band"), F.sum("entries").alias("entries")),
        "jaccard-groups")

    labels = _linked_sets(groups, sets, texts_at)
    of_set = sets.select("set_id", "doc_id").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    of_set = staged(of_set.withColumn("label", F.coalesce("label", "set_id")), "jaccard-labels")
    least = of_set.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_set = of_set.join(least, "label").select("set_id", "component_id")
    return rows.join(of_set, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "set_id", "place")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each component, with its columns as they are: the one with the least id (null last),
    among those the first in the table. Documents without words all stay.

    Rows are told apart by their places in the stored files, the same in every scan.
    """
    at = "place"
    while at in docs.columns:
        at += "_"
    places = Places(docs)
    joined = _join(places, text, at, at).select("place", "component_id")
    ids = places.rows(at).select(F.col(at).alias("place"), F.col(key).alias("id"))
    first = joined.join(ids, "place").groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "place")).getField("place").alias("place"))
    return places.rows_at(first.select("place"), at).drop(at)
