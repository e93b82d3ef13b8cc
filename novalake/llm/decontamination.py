"""Benchmark passages in training documents, found in an FM-index of each training shard.

A shard is a bounded batch of documents inside a task. Its words become numbers: a word that no
benchmark item has can be part of no match, so it only separates; stretches between separators
that are shorter than the shortest window are left out of the index. Windows of the benchmark are
searched backwards, all at once, and located; places are merged into spans of words.

The benchmark goes to every task in blocks of at most ``BLOCK_BYTES`` of text. Each block is one
more pass over the documents inside the same stage, that adds its spans to those found before.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from novalake.llm.common import slices, texts_of
from novalake.llm.fm_index import FMIndex

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 16 << 20

# Fixed value: words are runs of digits, lower-case Latin letters and bytes above 127.
AS_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c > 0x7F or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)
FOUND = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int64())),
                   ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
FOUND_DDL = "n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(AS_WORDS).split()


class Windows:
    """The distinct windows of benchmark items, as rows of word numbers (2 and up) by length."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in words_of(text or "")]
            for start in range(max(1, len(ids) - window + 1) if ids else 0):
                owners = found.setdefault(tuple(ids[start : start + window]), set())
                if item is not None:
                    owners.add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for length in sorted({len(w) for w in found}):
            rows = [w for w in found if len(w) == length]
            self.by_length[length] = (np.array(rows, np.int64), [sorted(found[w]) for w in rows])
        self.shortest = min(self.by_length, default=0)

    def search(self, texts: list[str]) -> list[tuple[int, list[int], list[int], list[str]]]:
        """For each text: words, starts and ends of merged spans of words, items found."""
        numbers = []
        for text in texts:
            words = words_of(text)
            numbers.append(np.fromiter(map(self.numbers.get, words, repeat(1)), np.int64, len(words)))
        found = [(len(n), [], [], set()) for n in numbers]
        first, waiting = 0, 0
        for doc, n in enumerate(numbers):
            waiting += len(n)
            if waiting * 8 >= SHARD_BYTES or doc + 1 == len(numbers):
                self._shard(numbers[first : doc + 1], found[first : doc + 1])
                first, waiting = doc + 1, 0
        return [(n, starts, ends, sorted(items)) for n, starts, ends, items in found]

    def _shard(self, numbers: list[np.ndarray], found: list) -> None:
        if not self.by_length:
            return
        parts = [x for n in numbers for x in (n, np.ones(1, np.int64))]
        stream = np.concatenate(parts)
        doc_starts = np.cumsum([0, *(len(n) + 1 for n in numbers)])
        inside = np.concatenate(([False], stream > 1, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        starts, lengths = starts[long], (ends - starts)[long] + 1  # with the separator
        if not len(starts):
            return
        kept_starts = np.cumsum(lengths) - lengths
        origin = np.repeat(starts - kept_starts, lengths) + np.arange(lengths.sum())
        text = np.append(stream[origin], 0)
        index = FMIndex(text, len(self.numbers) + 2)
        spans = []
        for length, (patterns, owners) in self.by_length.items():
            which, low, high = index.ranges(patterns)
            if not len(which):
                continue
            counts = high - low
            rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            places = origin[index.locate(rows)]
            docs = np.searchsorted(doc_starts, places, side="right") - 1
            at = places - doc_starts[docs]
            spans.append(np.stack((docs, at, at + length), axis=1))
            for doc, pattern in np.unique(np.stack((docs, np.repeat(which, counts)), axis=1), axis=0):
                found[doc][3].update(owners[pattern])
        if not spans:
            return
        spans = np.concatenate(spans)
        spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
        for doc, start, end in spans.tolist():
            _, begun, ended, _ = found[doc]
            if ended and start <= ended[-1]:
                ended[-1] = max(ended[-1], end)
            else:
                begun.append(start)
                ended.append(end)


def _merged(before: dict | None, found: tuple) -> tuple:
    if not before:
        return found
    spans = sorted(zip(before["starts"] + found[1], before["ends"] + found[2]))
    starts, ends = [], []
    for start, end in spans:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return found[0], starts, ends, sorted({*before["items"], *found[3]})


def annotate(docs: DataFrame, benchmark: DataFrame, name: str, text: str = "text",
             window: int = WINDOW, item_id: str = "item_id", item_text: str = "text",
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds ``name``: a struct of ``n_words``, ``starts`` and ``ends`` (merged spans of words that lie
    in benchmark windows, end exclusive) and ``items`` (ids as sorted strings).

    All other columns and all rows stay. Null and empty texts have no words; an item without words
    has no window; an item without id marks words but is not listed; repeated items count once. An
    empty benchmark finds nothing.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("body"))
    items = items.filter(F.col("body").isNotNull())
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    schema = StructType([*docs.schema.fields,
                         StructField(name, StructType.fromDDL(FOUND_DDL))])
    out = docs
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("id", "body"), F.lit(blocks)) == block)
        searched = Windows([tuple(r) for r in mine.collect()], window)  # bounded by block_bytes
        out = out.mapInArrow(_pass(searched, name, text), schema)
    return out


def _pass(windows: Windows, name: str, text: str):
    def run(batches):
        for batch in slices(batches, text, SHARD_BYTES):
            found = windows.search(texts_of(batch, text))
            if name in batch.schema.names:
                before = batch.column(name).to_pylist()
                found = [_merged(b, f) for b, f in zip(before, found)]
                batch = batch.drop_columns([name])
            column = pa.array([dict(zip(("n_words", "starts", "ends", "items"), f)) for f in found], FOUND)
            yield batch.append_column(name, column)
    return run


def hit_words(found: Column) -> Column:
    widths = F.zip_with(found["ends"], found["starts"], lambda end, start: end - start)
    return F.aggregate(widths, F.lit(0).cast("bigint"), lambda total, x: total + x)


def is_contaminated(found: Column) -> Column:
    """At least a twentieth of the words, and one, lie in benchmark windows."""
    return (hit_words(found) > 0) & (hit_words(found) * 20 >= found["n_words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their columns as they are."""
    name = "found_in_benchmark"
    while name in docs.columns:
        name += "_"
    marked = annotate(docs, benchmark, name, text)
    return marked.filter(~is_contaminated(F.col(name))).drop(name)
