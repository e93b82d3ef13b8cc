"""Main text of web pages: the structure says what may be main text, repetition within the host what is not.

Pages become streams of block numbers; pages of a host with equal streams are one content. The streams
of a host are joined, and long stretches of blocks that stand on a tenth of its contents, and three at
least, are found by sorting suffixes: a suffix array in shards by host and first block, each suffix with
the ``DEPTH`` blocks that follow, which is enough to cover longer repeats piece by piece. Blocks that
fewer contents have end a suffix. Equal suffixes are one row with counts of their contents before any
shard sees them, so a block that stands on every page of a big host is no burden.

A block in an article element may be main text, one in a menu, footer, advert or the like is not. On pages
without article or main element, all others may be. Those are removed where long repeats cover them, unless
those cover nearly all of the page: then it is a copy. In an article or main element, where the structure
speaks for a block, the repeats must stand on half of the contents (lists of links apart).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from novalake.llm.common import slices, staged, texts_of
from novalake.llm.markup import ARTICLE, MAIN, REST, Block, read_blocks

DEPTH = 8
LONG = 20  # characters a repeat must have
LINKED = 0.5
LEAST = 3  # contents a repeat must stand on
SHARE = 0.1  # and of the contents of the host
INSIDE = 0.5  # and for blocks in an article or main element
COPY = 0.9  # share of the characters of a page that make a repeat a copy

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"
STREAM = "page bigint, host string, blocks array<bigint>, sizes array<int>, unsure array<boolean>, kept array<boolean>"


def chosen(blocks: list[Block]) -> tuple[list[int], set[int]]:
    """Numbers of the blocks that may be main text, and which of them the structure does not speak for."""
    for part in (ARTICLE, MAIN):
        inside = [n for n, b in enumerate(blocks) if b.part == part]
        if inside:
            return inside, {n for n in inside if blocks[n].linked > LINKED}
    rest = [n for n, b in enumerate(blocks) if b.part == REST]
    return rest, set(rest)


def _streams(pages: DataFrame) -> DataFrame:
    def run(batches):
        for batch in slices(batches, "body"):
            out = {n: [] for n in ("blocks", "sizes", "unsure", "kept")}
            for body in texts_of(batch, "body"):
                blocks = read_blocks(body)
                kept, unsure = chosen(blocks)
                kept = set(kept)
                numbers = np.array([xxh3_64_intdigest(b.text) for b in blocks], np.uint64)
                out["blocks"].append(numbers.view(np.int64))
                out["sizes"].append([len(b.text) for b in blocks])
                out["unsure"].append([n in unsure for n in range(len(blocks))])
                out["kept"].append([n in kept for n in range(len(blocks))])
            yield pa.RecordBatch.from_arrays([
                batch.column("page"), batch.column("host"), pa.array(out["blocks"], pa.list_(pa.int64())),
                pa.array(out["sizes"], pa.list_(pa.int32())), pa.array(out["unsure"], pa.list_(pa.bool_())),
                pa.array(out["kept"], pa.list_(pa.bool_()))], ["page", "host", "blocks", "sizes", "unsure", "kept"])

    streams = pages.mapInArrow(run, STREAM).withColumn("content", F.xxhash64("blocks"))
    return staged(streams, "page-streams")


def _suffixes(contents: DataFrame) -> DataFrame:
    """``content, host, least, inside, nth, suffix, sizes, again``: from each block that stands on ``least`` contents of the
    host, it and those after it, up to ``DEPTH`` or to the first that fewer have. ``again`` of its first blocks
    begin the suffix before it too, among those of the content in order."""
    hosts = contents.groupBy("host").agg(*(
        F.greatest(F.lit(LEAST), F.ceil(F.count("*") * share)).cast("int").alias(name)
        for name, share in (("least", SHARE), ("inside", INSIDE))))
    shared = contents.select("host", F.explode(F.array_distinct("blocks")).alias("block")).groupBy("host", "block").count()
    shared = shared.filter(F.col("count") >= LEAST).join(hosts, "host").filter("count >= least")
    places = contents.select("content", "host", F.posexplode("blocks").alias("nth", "block"), "sizes").select(
        "content", "host", "nth", "block", F.expr("sizes[nth]").alias("size"))
    runs = places.join(shared.select("host", "block", "least", "inside"), ["host", "block"]).groupBy("content", "host").agg(
        F.first("least").alias("least"), F.first("inside").alias("inside"),
        F.sort_array(F.collect_list(F.struct("nth", "block", "size"))).alias("run"))

    def cut(batches):
        for batch in batches:
            out = []
            columns = (batch.column(n).to_pylist() for n in ("content", "host", "least", "inside", "run"))
            for content, host, least, inside, run in zip(*columns):
                mine = []
                for n, first in enumerate(run):
                    stop = n + 1
                    while stop < len(run) and stop < n + DEPTH and run[stop]["nth"] == run[stop - 1]["nth"] + 1:
                        stop += 1
                    mine.append({"content": content, "host": host, "least": least, "inside": inside, "nth": first["nth"],
                                 "suffix": [r["block"] for r in run[n:stop]], "sizes": [r["size"] for r in run[n:stop]]})
                mine.sort(key=lambda x: x["suffix"])
                for x, before in zip(mine, [{"suffix": []}, *mine]):
                    x["again"] = next((n for n, (a, b) in enumerate(zip(x["suffix"], before["suffix"])) if a != b),
                                      min(len(x["suffix"]), len(before["suffix"])))
                out += mine
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("content", pa.int64()), ("host", pa.string()), ("least", pa.int32()),
                        ("inside", pa.int32()), ("nth", pa.int32()), ("suffix", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("again", pa.int32())])
    return staged(runs.mapInArrow(cut, "content bigint, host string, least int, inside int, nth int, "
                                  "suffix array<bigint>, sizes array<int>, again int"), "page-suffixes")


def repeated_prefixes(suffixes: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For sorted distinct suffixes, each with the least and greatest page it stands on: how many of its
    first blocks stand, one after the other, on several pages."""
    return _prefixes(suffixes, lambda order, starts, depth: (
        np.minimum.reduceat(low[order], starts) != np.maximum.reduceat(high[order], starts)))


def frequent_prefixes(suffixes: list[np.ndarray], on: np.ndarray, least: int) -> np.ndarray:
    """The same for blocks that stand on ``least`` contents. ``on[n, d]`` contents have suffix ``n`` and, before
    it in order, none with the same ``d + 1`` first blocks: so each content counts once for a prefix."""
    return _prefixes(suffixes, lambda order, starts, depth: np.add.reduceat(on[order, depth - 1], starts) >= least)


def _prefixes(suffixes: list[np.ndarray], enough) -> np.ndarray:
    table = np.zeros((len(suffixes), DEPTH), np.int64)
    lengths = np.array([len(s) for s in suffixes])
    for n, s in enumerate(suffixes):
        table[n, : len(s)] = s
    there = np.arange(DEPTH) < lengths[:, None]  # a suffix that has ended is equal to none that goes on
    order = np.lexsort([x for n in reversed(range(DEPTH)) for x in (there[:, n], table[:, n])])
    table, there = table[order], there[order]
    common = np.zeros(len(table), np.int64)
    new = np.append(True, np.zeros(len(table) - 1, bool))
    for depth in range(1, DEPTH + 1):
        here, alive = table[:, depth - 1], there[:, depth - 1]
        new = new | np.append(True, (here[1:] != here[:-1]) | (alive[1:] != alive[:-1]))
        starts = np.flatnonzero(new)
        mine = np.repeat(enough(order, starts, depth), np.diff(np.append(starts, len(table)))) & alive
        common[mine] = depth
    out = np.zeros(len(table), np.int64)
    out[order] = common
    return out


def _sorted_shard(rows: pd.DataFrame) -> pd.DataFrame:
    suffixes, on = list(rows["suffix"]), np.stack(list(rows["on"]))
    common, inside = (frequent_prefixes(suffixes, on, rows[n].iloc[0]) for n in ("least", "inside"))
    return pd.DataFrame({"host": rows["host"], "suffix_id": rows["suffix_id"], "common": common.astype(np.int32),
                         "common_inside": inside.astype(np.int32)})


def _removed(streams: DataFrame) -> DataFrame:
    """``page, covered``: the numbers of blocks that may be main text and lie in long repeats."""
    contents = staged(streams.filter(F.size("blocks") > 0).drop("page").dropDuplicates(["host", "content"]), "page-contents")
    suffixes = _suffixes(contents).withColumn("suffix_id", F.xxhash64("suffix"))
    distinct = suffixes.groupBy("host", "suffix_id").agg(
        F.first("suffix").alias("suffix"), F.first("least").alias("least"),
        F.first("inside").alias("inside"), F.array(*(F.sum((F.col("again") <= d).cast("bigint")) for d in range(DEPTH))).alias("on"))
    shards = distinct.groupBy("host", F.element_at("suffix", 1)).applyInPandas(
        _sorted_shard, "host string, suffix_id bigint, common int, common_inside int")
    found = suffixes.join(shards, ["host", "suffix_id"])
    long = found.filter(F.expr("aggregate(slice(sizes, 1, common), 0, (a, x) -> a + x)") >= LONG)
    often = F.expr("aggregate(slice(sizes, 1, common_inside), 0, (a, x) -> a + x)") >= LONG
    long = long.withColumn("often", F.when(often, F.col("common_inside")).otherwise(0))
    covered = long.select("host", "content", F.posexplode(F.expr("sequence(nth, nth + common - 1)")).alias("at", "nth"), "often")
    covered = covered.join(contents.select("host", "content", "unsure", "kept", "sizes"), ["host", "content"])
    covered = covered.filter(F.expr("kept[nth] and (unsure[nth] or at < often)"))
    covered = covered.groupBy("host", "content").agg(
        F.collect_set("nth").alias("covered"), F.first("sizes").alias("sizes"), F.first("kept").alias("kept"))
    gone = F.expr("aggregate(covered, 0L, (a, n) -> a + sizes[n])")
    there = F.expr("aggregate(zip_with(sizes, kept, (s, k) -> if(k, s, 0)), 0L, (a, s) -> a + s)")
    covered = covered.filter(gone < COPY * there).select("host", "content", "covered")
    return streams.select("page", "host", "content").distinct().join(covered, ["host", "content"]).select("page", "covered")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row; the text is empty if there is none.

    A null or empty page has no text; without url, pages are of one host without name. Pages of a host with equal
    blocks are one content to the search for repeats, and get the same text.
    """
    slim = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("body"),
        F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1)).alias("host"),
        F.xxhash64(page_id, url, page).alias("page"))
    streams = _streams(slim.select("page", "host", "body"))
    removed = staged(_removed(streams), "page-covered")

    def run(batches):
        for batch in slices(batches, "body"):
            texts = []
            for body, covered in zip(texts_of(batch, "body"), batch.column("covered").to_pylist()):
                blocks = read_blocks(body)
                kept, gone = chosen(blocks)[0], set(covered or ())
                texts.append("\n".join(blocks[n].text for n in kept if n not in gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    marked = slim.join(removed, "page", "left").select("page_id", "url", "body", "covered")
    return marked.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
