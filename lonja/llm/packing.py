"""Best-fit packing of documents into training sequences of several permitted lengths.

Pieces go, longest first, to the open sequence that they leave the least room in. If none has
room, the length with the least cost per token that holds the piece is opened. How long opened
sequences may be is chosen jointly for all pieces packed together: every permitted limit is
tried, each sequence is then cut down to the shortest length that holds its pieces, and the
cheapest outcome counts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)

# Pieces packed together; a piece's group depends on its document alone.
GROUP = 4096

_PACKED = (
    "doc_id bigint, piece int, start bigint, n_tokens bigint, sequence bigint, position bigint, "
    "capacity bigint, used bigint"
)


def cost(capacity: int) -> float:
    """Cost of a sequence: its tokens, attention that grows with their square, an overhead."""
    return capacity + capacity * capacity / 16384 + 64


def word_count(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.array_remove(words, "")).cast("bigint")


def _fill(sizes: Sequence[int], capacities: Sequence[int], limit: int) -> list[list[int]]:
    """Best fit of falling ``sizes``; each bin as the numbers of its pieces."""
    room: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for number, size in enumerate(sizes):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, chosen = room.pop(at)
        else:
            fits = [c for c in capacities if c >= size]
            fits = [c for c in fits if c <= limit] or fits[:1]
            left, chosen = min(fits, key=lambda c: (cost(c) / c, c)), len(bins)
            bins.append([])
        bins[chosen].append(number)
        if left > size:
            insort(room, (left - size, chosen))
    return bins


def pack_sizes(sizes: Sequence[int], capacities: Sequence[int]) -> list[tuple[int, list[int]]]:
    """Capacity and piece numbers of each bin for ``sizes`` in falling order."""
    best: tuple[float, list[tuple[int, list[int]]]] | None = None
    for limit in capacities:
        bins = []
        for own in _fill(sizes, capacities, limit):
            used = sum(sizes[i] for i in own)
            bins.append((next(c for c in capacities if c >= used), own))
        total = sum(cost(c) for c, _ in bins)
        if best is None or total < best[0]:
            best = total, bins
    return best[1] if best else []


def _packer(capacities: Sequence[int], group: int):
    def close(number: int, run: int, rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        out = []
        for place, (capacity, own) in enumerate(pack_sizes([r[3] for r in rows], capacities)):
            position, used = 0, sum(rows[i][3] for i in own)
            for i in own:
                doc_id, piece, start, size = rows[i]
                sequence = (number << 32) + run * group + place
                out.append((doc_id, piece, start, size, sequence, position, capacity, used))
                position += size
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6]
        names = [f.split()[0] for f in _PACKED.split(", ")]
        columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, run, rows = None, 0, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for number, *row in zip(*columns, strict=True):
                if number != last or len(rows) == group:
                    if rows:
                        yield close(last, run, rows)
                    last, run, rows = number, run + 1 if number == last else 0, []
                rows.append(tuple(row))
        if rows:
            yield close(last, run, rows)

    return pack


def packed(
    docs: DataFrame,
    size: Column,
    doc_id: str = "doc_id",
    capacities: Sequence[int] = CAPACITIES,
    group: int = GROUP,
) -> DataFrame:
    """Where every piece of every row of ``docs`` goes.

    doc_id, piece, start and n_tokens (the piece's tokens in its document), sequence, position
    (its first token in the sequence), capacity and used of the sequence. A document longer
    than the longest capacity is cut into pieces of that length and a rest. One without tokens,
    or of null size, has one row without a sequence. Pieces are dealt by a hash of doc_id, piece
    and the document's size into groups of about ``group`` and never more, equal ones included,
    so results do not depend on the cluster, and rows without an id are dealt out by their sizes.
    Repeated rows and null ids are packed like others. Only doc_id and
    what ``size`` needs are read.
    """
    capacities = sorted(capacities)
    longest = capacities[-1]
    sized = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)).alias("size"),
    )
    count = F.greatest(F.ceil(F.col("size") / longest).cast("int"), F.lit(1))
    pieces = sized.select(
        "doc_id", "size", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece")
    )
    start = F.col("piece").cast("bigint") * longest
    pieces = pieces.select(
        "doc_id",
        "piece",
        start.alias("start"),
        F.least(F.col("size") - start, F.lit(longest)).alias("n_tokens"),
        F.xxhash64("doc_id", "piece", "size").alias("hash"),
    )
    total = pieces.where("n_tokens > 0").count()
    groups = max(1, -(-total // group))
    number = F.pmod("hash", F.lit(groups)).alias("number")
    dealt = pieces.where("n_tokens > 0").select(number, "doc_id", "piece", "start", "n_tokens")
    dealt = dealt.repartition("number")
    ordered = dealt.sortWithinPartitions("number", F.desc("n_tokens"), "doc_id", "piece")
    placed = ordered.mapInArrow(_packer(capacities, group), _PACKED)
    nothing = F.lit(None).cast("bigint")
    empty = pieces.where("n_tokens = 0").select(
        "doc_id",
        "piece",
        "start",
        "n_tokens",
        nothing.alias("sequence"),
        nothing.alias("position"),
        nothing.alias("capacity"),
        nothing.alias("used"),
    )
    return placed.unionAll(empty)
