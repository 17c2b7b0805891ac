"""Removal of word passages that repeat anywhere in a corpus, by fixed-block anchors.

Documents are cut into non-overlapping reference blocks of half a window, rounded up, so that
every window of ``window`` words holds a whole block. Every rolling window of block length
probes the block index. A hit anchors the windows around it; these are compared as whole
windows over the corpus, and runs of repeated windows are the maximal exact repeats.

All exchanges carry one sorted, delta-coded list of distinct hashes per chunk of documents and
hash range, so a passage that a third of the corpus shares costs one entry per chunk.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lonja.llm.texts import (
    chunked,
    free_name,
    mix,
    small_batches,
    unpacked,
    window_hashes,
    word_hashes,
)

CHUNK_BYTES = 8 << 20

_POSTS = "bucket int, chunk int, n int, width int, keys binary, checks binary, flags binary"
_ANSWERS = "chunk int, bucket int, n int, width int, keys binary, hits binary"
_RESULT = (
    "n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, "
    "kept binary, kept_sha256 string"
)


def _pack(values: np.ndarray) -> tuple[int, bytes]:
    """Rising numbers as differences of the fewest bytes that fit."""
    steps = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return width, steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(n: int, width: int, data: bytes) -> np.ndarray:
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(n, width)
    return np.cumsum(steps.reshape(-1).view(np.uint64), dtype=np.uint64)


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n).astype(bool)


class _Chunk:
    """The words of a chunk's documents, and which block windows lie inside one document."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.window = window
        self.block = (window + 1) // 2
        self.texts = table.column("utf8").to_pylist()
        self.words, self.counts = word_hashes(self.texts)
        self.starts = np.cumsum(self.counts) - self.counts
        self.blocks = window_hashes(self.words, self.block)
        self.inside = self._within(self.block)

    def _within(self, width: int) -> np.ndarray:
        """Whether the window of ``width`` words at each word stays in its document."""
        last = np.repeat(self.starts + self.counts, self.counts)
        return np.arange(len(self.words)) + width <= last

    def aligned(self) -> np.ndarray:
        place = np.arange(len(self.words)) - np.repeat(self.starts, self.counts)
        return (place % self.block == 0)[: len(self.blocks)]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, hash and check of all whole windows; two blocks cover one window."""
        starts = np.flatnonzero(self._within(self.window))
        first = self.blocks[starts]
        last = self.blocks[starts + self.window - self.block]
        key = mix(first * np.uint64(0x9FB21C651E98DF25) + last)
        check = mix(last * np.uint64(0xA24BAED4963EE407) + first) >> np.uint64(32)
        return starts, key, check.astype(np.uint32)


def _split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ``keys`` by bucket and rest, and each one's bucket and rest in that order."""
    bucket, rest = keys % np.uint64(buckets), keys // np.uint64(buckets)
    order = np.lexsort((rest, bucket))
    return order, bucket[order], rest[order]


def _posts(
    chunk: int,
    keys: np.ndarray,
    buckets: int,
    flags: np.ndarray | None = None,
    checks: np.ndarray | None = None,
) -> pa.Table:
    """Distinct keys by bucket. Flag 1: found twice here; flag 2: flagged at least once."""
    names = ["bucket", "chunk", "n", "width", "keys", "checks", "flags"]
    columns: dict[str, list] = {name: [] for name in names}
    if len(keys):
        order, bucket, rest = _split(keys, buckets)
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (rest[1:] != rest[:-1])
        at = np.flatnonzero(new)
        twice = np.diff(at, append=len(keys)) > 1
        marked = np.add.reduceat(flags[order], at) > 0 if flags is not None else twice
        proof = checks[order][at] if checks is not None else None
        bucket, rest = bucket[at], rest[at]
        edges = np.append(np.flatnonzero(np.diff(bucket, prepend=buckets)), len(bucket))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            width, packed = _pack(rest[a:b])
            both = np.packbits(twice[a:b]).tobytes() + np.packbits(marked[a:b]).tobytes()
            row = (int(bucket[a]), chunk, b - a, width, packed)
            row += (proof[a:b].tobytes() if proof is not None else b"", both)
            for name, value in zip(names, row, strict=True):
                columns[name].append(value)
    kinds = [pa.int32()] * 4 + [pa.binary()] * 3
    return pa.table({n: pa.array(columns[n], k) for n, k in zip(names, kinds, strict=True)})


def _answers(posts: pa.Table, with_keys: bool) -> pa.Table:
    """For every chunk that posted to this bucket, which of its keys repeat."""
    rows = posts.to_pylist()
    rests = [_unpack(r["n"], r["width"], r["keys"]) for r in rows]
    half = [(r["n"] + 7) // 8 for r in rows]
    twice = [_bits(r["flags"][:h], r["n"]) for r, h in zip(rows, half, strict=True)]
    marked = [_bits(r["flags"][h:], r["n"]) for r, h in zip(rows, half, strict=True)]
    rest = np.concatenate(rests)
    order = np.argsort(rest, kind="stable")
    sorted_rest = rest[order]
    new = np.ones(len(rest), dtype=bool)
    new[1:] = sorted_rest[1:] != sorted_rest[:-1]
    if with_keys:  # whole windows: the check must agree too
        check = np.concatenate([np.frombuffer(r["checks"], dtype=np.uint32) for r in rows])
        order = np.lexsort((check, rest))
        sorted_rest, check = rest[order], check[order]
        new[1:] = (sorted_rest[1:] != sorted_rest[:-1]) | (check[1:] != check[:-1])
    at = np.flatnonzero(new)
    repeated = np.diff(at, append=len(rest)) > 1
    repeated |= np.add.reduceat(np.concatenate(twice)[order], at) > 0
    if not with_keys:  # anchors: one of the occurrences is a reference block
        repeated &= np.add.reduceat(np.concatenate(marked)[order], at) > 0
    hits = np.empty(len(rest), dtype=bool)
    hits[order] = np.repeat(repeated, np.diff(at, append=len(rest)))
    out: dict[str, list] = {k: [] for k in ("chunk", "bucket", "n", "width", "keys", "hits")}
    upto = 0
    for row, values in zip(rows, rests, strict=True):
        own = hits[upto : upto + row["n"]]
        upto += row["n"]
        n, width, keys, bits = row["n"], 0, b"", np.packbits(own).tobytes()
        if with_keys:
            bits, n = b"", int(own.sum())
            if not n:
                continue
            width, keys = _pack(values[own])
        answer = (row["chunk"], row["bucket"], n, width, keys, bits)
        for name, value in zip(out, answer, strict=True):
            out[name].append(value)
    kinds = [pa.int32()] * 4 + [pa.binary()] * 2
    return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds, strict=True)})


def _anchored(chunk: _Chunk, answers: pa.Table, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Whether each word starts a block window that an anchor hit."""
    order, bucket, rest = _split(keys, buckets)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (rest[1:] != rest[:-1])
    rows = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
    hits = np.concatenate([_bits(r["hits"], r["n"]) for r in rows])
    found = np.zeros(len(chunk.words) + 1, dtype=np.int64)
    places = np.flatnonzero(chunk.inside)
    found[places[order]] = hits[np.cumsum(new) - 1]
    return found


def _probe_keys(chunk: _Chunk, shift: int) -> np.ndarray:
    return chunk.blocks[chunk.inside[: len(chunk.blocks)]] >> np.uint64(shift)


def repeated_passages(
    docs: DataFrame,
    text: str = "text",
    window: int = 35,
    result: str = "passages",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """All rows of ``docs`` with a struct ``result``: words, removed words, spans, kept text.

    A word goes when a window of ``window`` consecutive words that covers it has a word
    sequence that also starts elsewhere, in another row or in the same text. ``spans`` are the
    removed word ranges; ``kept`` are the other words joined by one space, as UTF-8. A null or
    empty text has no words. Repeated rows are occurrences of each other. Other columns pass
    through whatever their names; ``result`` must be free.
    """
    block = (window + 1) // 2
    small_batches(docs)
    whole, chunks, size = chunked(docs, text, chunk_bytes)
    # Short hashes suffice for anchors, as long as few of all words collide.
    shift = max(0, 64 - max(24, math.ceil(math.log2(size + 1)) + 8))

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        chunk = _Chunk(table, window)
        aligned = chunk.aligned()[chunk.inside[: len(chunk.blocks)]]
        return _posts(key[0].as_py(), _probe_keys(chunk, shift), chunks, aligned)

    def extend(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not answers.num_rows or not table.num_rows:
            return _posts(0, np.empty(0, dtype=np.uint64), chunks)
        chunk = _Chunk(table, window)
        hit = _anchored(chunk, answers, _probe_keys(chunk, shift), chunks)
        upto = np.concatenate(([0], np.cumsum(hit)))
        starts, keys, checks = chunk.windows()
        near = upto[starts + window - block + 1] > upto[starts]
        number = answers.column("chunk")[0].as_py()
        return _posts(number, keys[near], chunks, None, checks[near])

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(table, window)
        gone = np.zeros(len(chunk.words) + 1, dtype=np.int64)
        if answers.num_rows:
            starts, keys, _ = chunk.windows()
            known = np.sort(
                np.concatenate(
                    [
                        _unpack(r["n"], r["width"], r["keys"]) * np.uint64(chunks)
                        + np.uint64(r["bucket"])
                        for r in answers.to_pylist()
                    ]
                )
            )
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            repeated = starts[known[at] == keys]
            np.add.at(gone, repeated, 1)
            np.add.at(gone, repeated + window, -1)
        gone = np.cumsum(gone)[:-1] > 0
        return _with_result(table, chunk, gone)

    kind = whole.select("row", F.lit(None).cast(StructType.fromDDL(_RESULT)).alias("result")).schema

    def _with_result(table: pa.Table, chunk: _Chunk, gone: np.ndarray) -> pa.Table:
        rows = []
        for text_, start, n in zip(chunk.texts, chunk.starts, chunk.counts, strict=True):
            own = gone[start : start + n]
            words = text_.split()
            edge = np.diff(own.astype(np.int8), prepend=0, append=0)
            spans = zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)
            spans = [{"start": int(a), "end": int(b)} for a, b in spans]
            if spans:
                words = [w for w, g in zip(words, own.tolist(), strict=True) if not g]
            kept = b" ".join(words)
            rows.append((int(n), int(own.sum()), spans, kept, hashlib.sha256(kept).hexdigest()))
        fields = [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array(
                [r[2] for r in rows],
                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
            ),
            pa.array([r[3] for r in rows], pa.binary()),
            pa.array([r[4] for r in rows], pa.string()),
        ]
        names = ["n_words", "n_removed", "spans", "kept", "kept_sha256"]
        own = pa.StructArray.from_arrays(fields, names)
        return table.select(["row"]).append_column("result", own)

    grouped = whole.groupBy("chunk")
    anchors = grouped.applyInArrow(probe, _POSTS).groupBy("bucket")
    hits = anchors.applyInArrow(lambda key, t: _answers(t, False), _ANSWERS).groupBy("chunk")
    extended = grouped.cogroup(hits).applyInArrow(extend, _POSTS).groupBy("bucket")
    repeats = extended.applyInArrow(lambda key, t: _answers(t, True), _ANSWERS).groupBy("chunk")
    return unpacked(grouped.cogroup(repeats).applyInArrow(remove, kind), docs.columns, result)


def without_passages(docs: DataFrame, text: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; texts without one stay as they are."""
    result = free_name(docs, "_passages")
    found = repeated_passages(docs, text, window, result)
    cut = F.col(f"{result}.n_removed") > 0
    new = F.when(cut, F.col(f"{result}.kept").cast("string")).otherwise(F.col(f"`{text}`"))
    found = found.withColumn(text, new)
    if "n_chars" in docs.columns:
        size = F.when(cut, F.length(F.col(f"`{text}`")).cast(docs.schema["n_chars"].dataType))
        found = found.withColumn("n_chars", size.otherwise(F.col("n_chars")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
