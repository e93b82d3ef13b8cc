"""Shards of near-equal bytes by histogram sort, in DataFrame operations only.

Every row gets a 64-bit sort key whose high 40 bits come from the text and whose low 24 bits
come from the row, so that equal texts lie side by side and yet no group of copies is too big
to be cut. The bytes below candidate key boundaries are counted exactly by one aggregation a
round; each round looks only into the key ranges that hold a splitter not found yet, and probes
them 1,024 times finer. When all splitters meet the tolerance the rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from novalake.llm.common import staged

SALT_BITS = 24
ROUND_BITS = 10
KEY_BITS = 63
ROWS_PER_PIECE = 250_000
MAX_PIECES = 64


@dataclass
class _Open:
    """A key range that holds the place of some splitters: ``below`` bytes lie under it."""

    prefix: int
    below: int
    targets: list[tuple[int, float]]


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (none if null) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("bigint")


def key_of(text: Column, *row: Column) -> Column:
    """63-bit sort key. Rows with equal texts share all but the low bits."""
    of_text = F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS + SALT_BITS)
    of_row = F.xxhash64(*row).bitwiseAND(F.lit((1 << SALT_BITS) - 1))
    return F.shiftleft(of_text, SALT_BITS).bitwiseOR(of_row)


def splitters(keyed: DataFrame, count: int, tolerance: float) -> list[int]:
    """``count - 1`` keys that cut the rows into ``count`` runs of near-equal bytes.

    ``keyed`` has ``key`` and ``size``. A splitter is found when the bytes below it
    are within ``tolerance`` of its target, or when no finer boundary is left. A round brings at
    most ``(count - 1) * 1024`` sums to the driver, whatever the number of rows.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    found: dict[int, int] = {}
    ranges = [_Open(0, 0, [(i, total * i / count) for i in range(1, count)])]
    low = KEY_BITS
    while ranges and total:
        width, low = low, max(0, low - ROUND_BITS)
        if width == KEY_BITS:
            rows = keyed
        else:
            inside = F.shiftright("key", width).isin([r.prefix for r in ranges])
            rows = keyed.filter(inside)
        sums: dict[int, dict[int, int]] = {}
        counted = rows.groupBy(F.shiftright("key", low).alias("probe")).agg(F.sum("size"))
        for probe, size in counted.collect():
            sums.setdefault(probe >> (width - low), {})[probe] = size
        finer = []
        for span in ranges:
            below, left = span.below, list(span.targets)
            for probe, size in sorted(sums[span.prefix].items()):
                inner = []
                while left and left[0][1] <= below + size:
                    i, target = left.pop(0)
                    down, up = target - below, below + size - target
                    if min(down, up) <= tolerance or low == 0:
                        found[i] = (probe if down <= up else probe + 1) << low
                    else:
                        inner.append((i, target))
                if inner:
                    finer.append(_Open(probe, below, inner))
                below += size
        ranges = finer
    return [found.get(i, 0) for i in range(1, count)]


def _cuts_below(cuts: list[int]) -> Column:
    """How many of the cuts are at or below the key."""
    count = F.lit(0)
    for cut in cuts:
        count = count + (F.col("key") >= F.lit(cut)).cast("int")
    return count


def _pieces(keyed: DataFrame, cuts: list[int], shards: int, pieces: int) -> DataFrame:
    """``shard`` and ``piece``: each shard consists of as many pieces, in the order of the keys."""
    outer = cuts[pieces - 1 :: pieces]
    dealt = keyed.withColumn("shard", _cuts_below(outer))
    if pieces == 1:
        return dealt.withColumn("piece", F.col("shard"))
    inner = F.array(*(
        F.array(*(F.lit(c) for c in cuts[k * pieces : (k + 1) * pieces - 1])) for k in range(shards)
    ))
    nth = F.size(F.filter(F.element_at(inner, F.col("shard") + 1), lambda cut: cut <= F.col("key")))
    return dealt.withColumn("piece", F.col("shard") * pieces + nth)


def shard(df: DataFrame, shards: int, text: str = "text", row: tuple[str, ...] = ("doc_id",),
          tolerance: float = 0.0005) -> DataFrame:
    """Deals all rows into shards of near-equal bytes.

    Returns the ``row`` columns, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0
    in the order of the keys). ``tolerance`` is a fraction of a piece's mean size; where single
    rows are larger than that, the boundary next to the target is taken. A null text counts 8
    bytes; repeated rows are dealt like any others, since a row's place in its file takes part in
    its key; an empty table gives no rows; other columns are not read.

    A shard is exchanged and numbered in pieces of about 250,000 rows, 64 at most, so that the
    number of tasks is not held down to the number of shards.
    """
    body, names = F.col(text), [f"row{i}" for i in range(len(row))]
    keyed = staged(df.select(
        *(F.col(n).alias(own) for n, own in zip(row, names)),
        size_of(body).alias("size"),
        F.crc32(F.coalesce(body, F.lit(""))).alias("crc"),
        key_of(body, *(F.col(n) for n in row), F.monotonically_increasing_id()).alias("key"),
    ), "shard-keys")
    rows, total = keyed.agg(F.count("*"), F.sum("size")).first()
    pieces = max(1, min(MAX_PIECES, -(-rows // (shards * ROWS_PER_PIECE))))
    cuts = splitters(keyed, shards * pieces, tolerance * (total or 0) / (shards * pieces))
    dealt = _pieces(keyed, cuts, shards, pieces)
    counts = dict(dealt.groupBy("piece").count().collect())  # one row per piece
    starts, seen = [], 0
    for piece in range(shards * pieces):
        seen = 0 if piece % pieces == 0 else seen
        starts.append(F.lit(seen).cast("bigint"))
        seen += counts.get(piece, 0)
    nth = F.row_number().over(Window.partitionBy("piece").orderBy("key", *names))
    return dealt.select(
        *(F.col(own).alias(n) for n, own in zip(row, names)),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.element_at(F.array(*starts), F.col("piece") + 1) + nth - 1).cast("bigint").alias("slot"),
    )
