"""Documents and their token counts in flat token files without an index.

A flat token file is nothing but token ids of fixed width, one after the other, with an
end-of-document id after each document. Files are cut into blocks. Every block is searched for
separators by itself, and a prefix scan over the blocks of a file adds to each block's first
document the tokens that earlier blocks left open.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.llm.texts import binary, small_batches, total_bytes, word_hashes
from lonja.session import shared_folder

# Little-endian unsigned ids of two bytes; 0 ends a document.
WIDTH = 2
SEPARATOR = 0

BLOCK_BYTES = 1 << 20

BLOCKS_A_TASK = 32

# Text behind one token file.
FILE_TEXT_BYTES = 32 << 20

_FOUND = "path string, block bigint, n_tokens bigint, first bigint, last bigint, inner array<bigint>"


def write_token_files(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> str:
    """Write the texts' words as token ids to flat files in the shared folder; the folder.

    A word's id is a hash from 1 to 65 535, so no vocabulary is needed. Documents follow each
    other by doc_id, nulls first, over the files in the order of their names, and by a hash of
    their tokens where ids are equal. Rows of one id, and equal rows too, are dealt out over as
    many files as they fill. Null and empty texts are documents without tokens.
    """
    spark = docs.sparkSession
    small_batches(docs)
    files = max(1, math.ceil(total_bytes(docs, text) / FILE_TEXT_BYTES))
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        binary(text).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = word_hashes(batch.column("text").to_pylist())
            ids = (words % np.uint64((1 << (8 * WIDTH)) - 1) + np.uint64(1)).astype("<u2")
            parts = [p.tobytes() for p in np.split(ids, np.cumsum(counts)[:-1])]
            yield batch.set_column(1, "text", pa.array(parts[: batch.num_rows], pa.binary()))

    tokens = source.mapInArrow(encode, source.schema)
    # The hash, not the tokens: the bounds of the ranges are sampled on the driver.
    order = ("doc_id", F.xxhash64("text"))
    ordered = tokens.repartitionByRange(files, *order, "place")
    ordered = ordered.sortWithinPartitions(*order, "text")
    folder = f"{shared_folder(spark)}/tokens/{uuid4().hex}"
    separator = "\0" * WIDTH
    ordered.select(F.col("text").cast("string")).write.text(folder, lineSep=separator)
    return folder


def _opened(path: str) -> pa.NativeFile:
    """The file that Spark names ``path``, where pyarrow reaches its store."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


def _reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path, length in zip(*[batch.column(c).to_pylist() for c in ("path", "length")], strict=True):
            try:
                with _opened(path) as file:
                    found.append(file.size() == length)
            except (OSError, ValueError, NotImplementedError):
                found.append(False)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.bool_())], ["reached"])


def _data(batch: pa.RecordBatch, block_bytes: int) -> Iterator[pa.Buffer]:
    """Each row's block: its column ``data``, or else its range of the file."""
    if "data" in batch.schema.names:
        yield from (data.as_buffer() for data in batch.column("data"))
        return
    paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
    lengths = batch.column("length").to_pylist()
    for path, block, length in zip(paths, blocks, lengths, strict=True):
        at = block * block_bytes
        with _opened(path) as file:
            file.seek(at)
            data = file.read_buffer(min(block_bytes, length - at))
        if len(data) != min(block_bytes, length - at):
            raise OSError(f"{path} is shorter than listed")
        yield data


def _scanner(width: int, separator: int, block_bytes: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in _data(batch, block_bytes):
                # A last token that is cut off is no token.
                ids = np.frombuffer(raw, dtype=f"<u{width}", count=len(raw) // width)
                ends = np.flatnonzero(ids == separator)
                found = (int(ends[0]), int(ends[-1])) if len(ends) else (None, None)
                rows.append((len(ids), *found, np.diff(ends) - 1))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("block"), *columns],
                ["path", "block", "n_tokens", "first", "last", "inner"],
            )

    return scan


def documents_in(
    spark: SparkSession,
    folder: str,
    width: int = WIDTH,
    separator: int = SEPARATOR,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """path, document, start and n_tokens of every document in the token files of ``folder``.

    ``document`` counts from 0 over all files in the order of their names, ``start`` is the
    document's first token in its file. Tokens after the last separator of a file are a document
    too; an empty file has none. Ids have ``width`` bytes (1, 2, 4 or 8); a cut-off last id is
    left out. Every block is read by itself in its own row's task, so files have any size. Only
    in a store that pyarrow doesn't reach is one file one Spark binary value, hence less than 2 GB.
    """
    block_bytes -= block_bytes % width
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    small_batches(files, 16)
    files = files.where("length > 0")
    listed = files.select("path", "length")
    number = F.ceil(F.col("length") / block_bytes)
    block = F.explode(F.sequence(F.lit(0), number.cast("bigint") - 1)).alias("block")
    reached = listed.limit(1).mapInArrow(_reach, "reached boolean").first()
    if reached is None or reached["reached"]:
        n = listed.agg(F.sum(number)).first()[0] or 0
        # A block's row is small, its data are not.
        blocks = listed.select("path", "length", block)
        blocks = blocks.repartition(max(1, math.ceil(n / BLOCKS_A_TASK)))
    else:
        data = F.substring(
            F.col("content"), (F.col("block") * block_bytes + 1).cast("int"), F.lit(block_bytes)
        )
        blocks = files.select("path", "content", block).select("path", "block", data.alias("data"))
    found = blocks.mapInArrow(_scanner(width, separator, block_bytes), _FOUND)

    size = block_bytes // width
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("block") * size
    scanned = found.select(
        "*",
        place.alias("place"),
        F.coalesce(F.last(place + F.col("last"), True).over(before) + 1, F.lit(0)).alias("open"),
        F.lead("block").over(Window.partitionBy("path").orderBy("block")).isNull().alias("ends"),
    )
    # What a block finishes, and what the file's last block leaves unfinished.
    ended = F.when(F.col("first").isNull(), F.array().cast("array<bigint>")).otherwise(
        F.concat(F.array(F.col("place") + F.col("first") - F.col("open")), F.col("inner"))
    )
    since = F.coalesce(F.col("place") + F.col("last") + 1, F.col("open"))
    left = F.col("place") + F.col("n_tokens") - since
    tail = F.when(F.col("ends") & (left > 0), F.array(left)).otherwise(
        F.array().cast("array<bigint>")
    )
    lists = scanned.select("path", "block", "open", F.concat(ended, tail).alias("sizes"))
    totals = lists.groupBy("path").agg(F.sum(F.size("sizes")).alias("n"))
    # One row per file.
    order = Window.orderBy(F.length("path"), "path").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("path", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    earlier = F.coalesce(F.sum(F.size("sizes")).over(before), F.lit(0))
    numbered = lists.withColumn("earlier", earlier).join(firsts, "path")
    out = numbered.select(
        "path", "base", "earlier", "open", "sizes", F.posexplode("sizes").alias("i", "n_tokens")
    )
    # Every document takes its tokens and one separator.
    start = F.col("open") + F.aggregate(
        F.slice("sizes", 1, F.col("i")), F.lit(0).cast("bigint"), lambda s, n: s + n + 1
    )
    document = F.col("base") + F.col("earlier") + F.col("i")
    return out.select("path", document.alias("document"), start.alias("start"), "n_tokens")
