"""Turns of conversations: places in order, and running keys over turns, for any length of one.

No step gathers a conversation: rows are sorted over ranges, joined in blocks of bounded size,
and scanned in levels of 64 rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.texts import small_batches
from lonja.sources.staging import ROW, stage_numbered

# Rows of one conversation that meet in one key of a join.
JOIN_BLOCK = 1 << 16

# Rows of one group of a scan.
SCAN_WIDTH = 64

# Characters of a text that take part in choosing the ranges of a sort.
_RANGE_CHARS = 64

KEY_LIST = 4096


def content_key(*values: Column) -> Column:
    """128 bits that stand for the values: two of Spark's 64-bit hashes with unlike seeds."""
    return F.struct(
        F.xxhash64(F.lit(1), *values).alias("a"), F.xxhash64(F.lit(2), *values).alias("b")
    )


def placed(
    turns: DataFrame, conv: Column, order: Sequence[Column], texts: Sequence[Column], **more: Column
) -> tuple[DataFrame, DataFrame]:
    """Turns as ``conv``, ``more`` and the row number of the order, written once; their bounds.

    Conversations follow each other by id, nulls first; turns in one by ``order``, nulls first,
    and then by ``texts``. Equal rows are in any order. The second frame has ``conv``, its first
    row and its number of rows. A conversation is dealt out over as many tasks as it fills.
    """
    ranges = [conv, *order, *[F.substring(t, 1, _RANGE_CHARS) for t in texts]]
    keys = {f"_r{i}": c for i, c in enumerate(ranges)} | {f"_t{i}": t for i, t in enumerate(texts)}
    named = turns.select(
        conv.alias("conv"),
        *[c.alias(name) for name, c in more.items()],
        *[c.alias(name) for name, c in keys.items()],
        F.monotonically_increasing_id().alias("_place"),
    )
    # The bounds of the ranges are sampled on the driver, so they take the head of a text only.
    nulls_first = [F.col(name).asc_nulls_first() for name in keys]
    heads = nulls_first[: len(ranges)]
    spread = named.repartitionByRange(*heads, F.col("_place"))
    inner = [*heads[: len(ranges) - len(texts)], *nulls_first[len(ranges) :], F.col("_place")]
    slim = spread.sortWithinPartitions(*inner).select("conv", *more)
    rows = stage_numbered(slim, "turns")
    bounds = rows.groupBy("conv").agg(F.min(ROW).alias("first_row"), F.count(F.lit(1)).alias("n"))
    return rows, bounds


def with_bounds(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows with the columns of their conversation, joined in blocks of ``JOIN_BLOCK`` rows."""
    block = F.floor(F.col(ROW) / JOIN_BLOCK)
    first, last = F.col("first_row"), F.col("first_row") + F.col("n") - 1
    blocks = F.sequence(F.floor(first / JOIN_BLOCK), F.floor(last / JOIN_BLOCK))
    by_block = bounds.select("*", F.explode(blocks).alias("_block")).withColumnRenamed("conv", "_conv")
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("_rows") == F.col("_block"))
    return rows.withColumn("_rows", block).join(by_block, same).drop("_conv", "_block", "_rows")


def prefix_keys(turns: DataFrame, longest: int) -> DataFrame:
    """Add ``node`` and ``parent``: keys of all turns up to this one, and of all before it.

    ``turns`` has ``conv``, its turns counted from 1 in ``depth`` and ``key``, a ``content_key``.
    A key is the exclusive or of the hashes of depth and content. Up to ``longest`` turns are
    scanned in levels of ``SCAN_WIDTH``, so no window holds more rows than that.
    """
    tag = content_key(F.col("depth"), F.col("key.a"), F.col("key.b"))
    tagged = turns.withColumn("_tag", tag).withColumn("_at", F.col("depth") - 1)
    scanned = _before(tagged, longest)
    node = F.struct(*[(F.col(f"_b{x}").bitwiseXOR(F.col(f"_tag.{x}"))).alias(x) for x in "ab"])
    parent = F.struct(F.col("_ba").alias("a"), F.col("_bb").alias("b"))
    return scanned.select("*", node.alias("node"), parent.alias("parent")).drop("_tag", "_at", "_ba", "_bb")


def _before(tagged: DataFrame, longest: int) -> DataFrame:
    """Add ``_ba`` and ``_bb``, the exclusive or of the tags of all earlier rows of ``conv``."""
    group = F.floor(F.col("_at") / SCAN_WIDTH)
    tagged = tagged.withColumn("_group", group)
    earlier = Window.partitionBy("conv", "_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    for x in "ab":
        inside = F.coalesce(F.bit_xor(f"_tag.{x}").over(earlier), F.lit(0))
        tagged = tagged.withColumn(f"_b{x}", inside)
    if longest <= SCAN_WIDTH:
        return tagged.drop("_group")
    totals = tagged.groupBy("conv", "_group").agg(
        F.struct(*[F.bit_xor(f"_tag.{x}").alias(x) for x in "ab"]).alias("_tag")
    )
    above = _before(totals.withColumnRenamed("_group", "_at"), -(-longest // SCAN_WIDTH))
    above = above.select(
        F.col("conv").alias("_conv"),
        F.col("_at").alias("_over"),
        F.col("_ba").alias("_xa"),
        F.col("_bb").alias("_xb"),
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("_group") == F.col("_over"))
    joined = tagged.join(above, same)
    for x in "ab":
        joined = joined.withColumn(f"_b{x}", F.col(f"_b{x}").bitwiseXOR(F.col(f"_x{x}")))
    return joined.drop("_conv", "_over", "_xa", "_xb", "_group")


def joined_sha256(lists: DataFrame, key: str, order: Sequence[str], value: str, separator: str) -> DataFrame:
    """``key`` and ``sha256``: the hash of its values in order, with ``separator`` between them.

    SHA-256 takes its input in order, so one key's values pass through one task, as a stream of
    batches of which one is held.
    """
    small_batches(lists, 256)
    dealt = lists.select(F.col(key).alias("key"), *order, F.col(value).alias("value"))
    streams = dealt.repartition("key").sortWithinPartitions("key", *order).select("key", "value")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(done: list) -> pa.RecordBatch:
            keys, sums = [k for k, _ in done], [h.hexdigest() for _, h in done]
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(sums)], ["key", "sha256"])

        held: tuple | None = None
        kind = pa.null()
        for batch in batches:
            kind, done = batch.schema.field("key").type, []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if held and held[0] == k:
                    held[1].update(separator.encode())
                else:
                    if held:
                        done.append(held)
                    held = (k, hashlib.sha256())
                held[1].update(text.encode())
            if done:
                yield made(done)
        if held:
            yield made([held])

    return streams.mapInArrow(digest, streams.select("key").schema.add("sha256", "string"))
