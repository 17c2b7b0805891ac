"""Words, word hashes and stable chunks of documents, shared by the corpus operators."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The separator bytes of a word `[^\x20\x09-\x0D]+`.
SPACES = b" \t\n\x0b\x0c\r"

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_CUT = re.compile(rb"[\t-\r ]")

# Text of one hashing step; a longer text is cut at a space.
_STEP = 1 << 16

_MULTIPLIER = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, as long as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _hash_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and 64-bit hash of every word in ``data``."""
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = ~_IS_SPACE[codes]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, dtype=np.uint64)
    return starts, range_hashes(codes, starts, ends)


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every range of the bytes ``codes``."""
    up, down = _POWERS.upto(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[codes] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def _blocks(texts: Sequence[bytes]) -> Iterable[tuple[list[int], list[bytes]]]:
    """Runs of short texts, and pieces of long ones that end at a space."""
    numbers: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > _STEP:
                cut = _CUT.search(text, at + _STEP)
                end = cut.end() if cut else end
            numbers.append(i)
            parts.append(text[at:end])
            size += end - at
            at = end
            if size >= _STEP:
                yield numbers, parts
                numbers, parts, size = [], [], 0
    if parts:
        yield numbers, parts


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each text."""
    counts = np.zeros(len(texts), dtype=np.int64)
    found = []
    for numbers, parts in _blocks(texts):
        starts, hashes = _hash_block(b"\n".join(parts))
        ends = np.cumsum([len(p) + 1 for p in parts])
        upto = np.searchsorted(starts, ends)
        np.add.at(counts, numbers, np.diff(upto, prepend=0))
        found.append(hashes)
    return (np.concatenate(found) if found else np.empty(0, dtype=np.uint64)), counts


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values; one shorter than ``words`` by width - 1."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        total = total * np.uint64(0xD1342543DE82EF95) + words[j : j + n]
    return mix(total)


def binary(name: str) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("binary"), F.lit(b""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def total_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def chunked(
    df: DataFrame, text: str, chunk_bytes: int, **more: Column
) -> tuple[DataFrame, int, int]:
    """Whole rows with their ``chunk`` and ``utf8`` text; the number of chunks; all bytes of text.

    Rows go to chunks by a hash of the whole row, so a hot source or group of copies is dealt
    out, and a recomputed task finds the same rows in the same chunk.
    """
    size = total_bytes(df, text)
    chunks = max(1, math.ceil(size / chunk_bytes))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    chunk = F.pmod(row, F.lit(chunks)).cast("int")
    dealt = whole_rows(df, chunk=chunk, utf8=binary(text), **more)
    return dealt, chunks, size


def whole_rows(df: DataFrame, **more: Column) -> DataFrame:
    """Whole rows as a struct ``row``, in which no name can clash, and ``more`` columns."""
    columns = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(columns, *[value.alias(name) for name, value in more.items()])


def unpacked(df: DataFrame, columns: Sequence[str], result: str) -> DataFrame:
    """The struct ``row`` as the columns it was made of, and ``result``."""
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], F.col("result").alias(result))


def small_batches(df: DataFrame, rows: int = 512) -> None:
    """Bound what one Arrow batch holds; texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
