"""Token ids of documents in Parquet list columns, for reading by document, place or metadata.

A table is a folder with two parts. ``data`` holds one row per document, in the order of the
documents: the file's number, the ids before it in that file, its own number of ids and the ids
as a list. ``index`` holds one row per file with the ids before it in the whole table. Row
groups and pages are of a set size and carry Parquet's page index, so a reader of a few
documents or of a range of ids decodes the pages that hold them, and a reader of counts or
other metadata never touches the ids.
"""

from __future__ import annotations

import functools
import math
import os
import re
import string
import zlib
from collections.abc import Callable, Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lonja.llm.texts import range_hashes, small_batches, total_bytes
from lonja.session import shared_folder

# Text behind one file of the table.
FILE_TEXT_BYTES = 32 << 20

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1000

# Writer options of each way to store the ids. A dictionary page must hold the whole vocabulary;
# a column that does without one is delta-coded by the second version of the format.
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": "1048576"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "v2"},
}

# Bytes of remembered pieces and ids; beyond it a worker forgets the half that it met last, as
# frequent pieces are met early. Arrays that grow may take twice as much.
_MEMORY = 96 << 20

# Text that is encoded in one call, and characters whose pieces are held at a time.
_STEP = 64 << 10
_GROUP = 1 << 18

# A byte-level pre-tokenizer always starts a new piece at one space between two other characters,
# at and after one newline between two, and where a letter or digit meets one of these marks.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = string.punctuation.encode()

# Longer runs of marks stay with the word before them.
_MOST_MARKS = 15

# Among pieces joined by zeros, one that is not bare: empty, or with white space at an end other
# than a first newline.
_JOIN = "\0"
_NOT_BARE = re.compile(r"(?:\A|\0)(?:\n?(?:[^\S\n]|\0|\Z)|\n\n)|\s(?:\0|\Z)")

_SPACE, _NEWLINE = b" \n"
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[list((string.ascii_letters + string.digits).encode())] = True
# The second byte of the letters from U+00C0 to U+00FF, and their first.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_LATIN_LEAD = 0xC3


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs of ``sizes`` from ``starts`` on, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class _Growing:
    """An array that is appended to."""

    def __init__(self, dtype: type | str):
        self._all, self.n = np.empty(1024, dtype=dtype), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self._all):
            self._all = np.resize(self._all, max(2 * len(self._all), self.n + len(values)))
        self._all[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def now(self) -> np.ndarray:
        return self._all[: self.n]


class _Memory:
    """Numbered byte strings with their ids, found by a hash and then compared byte by byte."""

    def __init__(self) -> None:
        self._hashes, self._text, self._ids = _Growing(np.uint64), _Growing(np.uint8), _Growing("<u4")
        # Where the text and the ids of each string begin, and the end of the last.
        self._text_at, self._ids_at = _Growing(np.int64), _Growing(np.int64)
        self._text_at.append(np.zeros(1, dtype=np.int64))
        self._ids_at.append(np.zeros(1, dtype=np.int64))
        self._slots = np.full(4096, -1, dtype=np.int32)

    @property
    def held(self) -> int:
        return 40 * self._hashes.n + self._text.n + 4 * self._ids.n

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the string of each hash, or -1."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        if not self._hashes.n:
            return found
        known, left, at = self._hashes.now, np.arange(len(hashes)), self._first_slot(hashes)
        while len(left):
            number = self._slots[at]
            taken = number >= 0
            hit = taken & (known[number] == hashes[left])
            found[left[hit]] = number[hit]
            on = taken & ~hit
            left, at = left[on], self._next_slot(at[on])
        return found

    def add(
        self, hashes: np.ndarray, text: bytes, text_sizes: np.ndarray, ids: np.ndarray, id_sizes: np.ndarray
    ) -> np.ndarray:
        """Remember strings whose hashes are unlike each other and all known ones; their numbers."""
        numbers = np.arange(self._hashes.n, self._hashes.n + len(hashes), dtype=np.int32)
        self._text_at.append(self._text.n + np.cumsum(text_sizes))
        self._ids_at.append(self._ids.n + np.cumsum(id_sizes))
        self._hashes.append(hashes)
        self._text.append(np.frombuffer(text, dtype=np.uint8))
        self._ids.append(ids)
        if 2 * self._hashes.n > len(self._slots):
            self._deal(4 * self._hashes.n)
        else:
            self._place(hashes, numbers)
        return numbers

    def forget_half(self) -> None:
        n = self._hashes.n // 2
        self._hashes.n, self._text_at.n, self._ids_at.n = n, n + 1, n + 1
        self._text.n, self._ids.n = int(self._text_at.now[-1]), int(self._ids_at.now[-1])
        self._deal(len(self._slots))

    def _deal(self, slots: int) -> None:
        self._slots = np.full(1 << (slots - 1).bit_length(), -1, dtype=np.int32)
        self._place(self._hashes.now, np.arange(self._hashes.n, dtype=np.int32))

    def _first_slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self._slots) - 1)).astype(np.int64)

    def _next_slot(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & (len(self._slots) - 1)

    def _place(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        at = self._first_slot(hashes)
        while len(numbers):
            free = self._slots[at] < 0
            self._slots[at[free]] = numbers[free]
            on = self._slots[at] != numbers
            numbers, at = numbers[on], self._next_slot(at[on])

    def unlike(self, numbers: np.ndarray, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which strings, given as ranges of ``codes``, are other ones than those of the numbers."""
        first = self._text_at.now[numbers]
        sizes = ends - starts
        other = self._text_at.now[numbers + 1] - first != sizes
        if other.any():
            sizes = np.where(other, 0, sizes)
        differs = self._text.now[_spread(first, sizes)] != codes[_spread(starts, sizes)]
        if differs.any():
            other[np.repeat(np.arange(len(sizes)), sizes)[differs]] = True
        return other

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings, one after the other, and the count of each."""
        first = self._ids_at.now[numbers]
        sizes = self._ids_at.now[numbers + 1] - first
        return self._ids.now[_spread(first, sizes)], sizes


class Encoder:
    """Texts to little-endian 32-bit ids by a byte-level tokenizer file, without special tokens.

    A text is cut where the tokenizer cuts it in any case, and a piece seen before is not encoded
    again. A piece is remembered as what follows a space, as a newline and what follows it, or as
    the marks after a word. New pieces are encoded together; as every id stands for a known number
    of bytes, their ids are told apart by the pieces' lengths. So no long text is encoded as a
    whole, unless nothing in it can be cut.
    """

    def __init__(self, path: str):
        # Spark gives a task its cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        kind = str(tokenizer.pre_tokenizer)
        if not kind.startswith("ByteLevel") or "use_regex=True" not in kind or tokenizer.normalizer:
            raise ValueError(f"{path} is not a plain byte-level tokenizer: texts can't be cut at spaces")
        tokenizer.no_truncation()
        tokenizer.no_padding()
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        # The byte-level alphabet has one character a byte; added tokens are ordinary text.
        added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        self._bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self._bytes[number] = len(token.encode()) if token in added else len(token)
        self._tokenizer = tokenizer
        # A mark may be a part of an added token.
        self._is_mark = np.zeros(256, dtype=bool)
        self._is_mark[list(set(_MARKS).difference(*[t.encode() for t in added]))] = True
        self._newline = len(self._ids("\n"))
        self._known = _Memory()

    def _ids(self, text: str) -> np.ndarray:
        (found,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text."""
        found: list[list[bytes]] = [[] for _ in texts]
        group: list[tuple[int, str, bool]] = []
        size = 0
        for i, text in enumerate(texts):
            at = 0
            while at < len(text):
                end = len(text)
                if end - at > _GROUP and (cut := _CUT.search(text, at + _GROUP)):
                    end = cut.start()
                group.append((i, text[at:end], at > 0))
                size += end - at
                at = end
                if size >= _GROUP:
                    self._encode_group(group, found)
                    group, size = [], 0
        if group:
            self._encode_group(group, found)
        return [b"".join(parts) for parts in found]

    def _encode_group(self, group: Sequence[tuple[int, str, bool]], found: list[list[bytes]]) -> None:
        """Append the ids of parts of texts; all but a text's first begin with a space at a cut."""
        if self._known.held > _MEMORY:
            self._known.forget_half()
        # The newline before a text is taken off again with its id.
        marked = [(t if on else "\n" + t).replace("\n", " \n").encode() for _, t, on in group]
        data = b"".join(marked)[1:]
        codes = np.frombuffer(data, dtype=np.uint8)
        spaces = np.flatnonzero(codes == _SPACE)
        starts, ends, is_marks = self._cut_marks(
            codes, np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(codes)]])
        )
        numbers, rejected = self._numbers(data, starts, ends, is_marks)
        upto = np.searchsorted(starts, np.cumsum([0, *map(len, marked)]))
        apart = np.diff(np.concatenate([[0], np.cumsum(rejected)])[upto]) > 0
        ids, sizes = self._known.ids(numbers[~rejected])
        counts = np.zeros(len(numbers), dtype=np.int64)
        counts[~rejected] = sizes
        places = np.concatenate([[0], np.cumsum(counts)])[upto].tolist()
        for k, (i, text, on) in enumerate(group):
            if apart[k]:
                found[i].append(self._cut_apart(text))
            else:
                found[i].append(ids[places[k] + (0 if on else self._newline) : places[k + 1]].tobytes())

    def _cut_apart(self, text: str) -> bytes:
        """The ids of a text that has other white space than single spaces and newlines."""
        first, *pieces = _CUT.split(text)
        last = [self._ids(" " + pieces.pop())] if pieces else []
        inner = []
        if pieces:
            parts = [p.encode() for p in pieces]
            data = b" ".join(parts)
            sizes = np.array(list(map(len, parts)), dtype=np.int64)
            ends = np.cumsum(sizes + 1) - 1
            codes = np.frombuffer(data, dtype=np.uint8)
            starts, ends, is_marks = self._cut_marks(codes, ends - sizes, ends)
            numbers, rejected = self._numbers(data, starts, ends, is_marks)
            if rejected.any():
                inner = [self._ids(" " + p) for p in pieces]
            else:
                inner = [self._known.ids(numbers)[0]]
        return b"".join([x.tobytes() for x in (self._ids(first), *inner, *last)])

    def _cut_marks(
        self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces with the marks after a word cut off as a piece; starts, ends and which are marks."""
        filled = np.flatnonzero(ends > starts)
        here = filled[self._is_mark[codes[ends[filled] - 1]]]
        first, stem = starts[here], ends[here] - 1
        for _ in range(_MOST_MARKS):
            more = (stem > first) & self._is_mark[codes[stem - 1]]
            if not more.any():
                break
            stem = stem - more
        last = codes[stem - 1]
        letter = _ALNUM[last] | (_LATIN[last] & (codes[np.maximum(stem - 2, 0)] == _LATIN_LEAD) & (stem > first + 1))
        cut = (stem > first) & letter
        here, stem = here[cut], stem[cut]
        shorter = ends.copy()
        shorter[here] = stem
        is_marks = np.insert(np.zeros(len(starts), dtype=bool), here + 1, True)
        return np.insert(starts, here + 1, stem), np.insert(shorter, here + 1, ends[here]), is_marks

    def _numbers(
        self, data: bytes, starts: np.ndarray, ends: np.ndarray, is_marks: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece in the memory, where new ones are put, and which have none.

        Those are not bare, or have the hash of another piece.
        """
        codes = np.frombuffer(data, dtype=np.uint8)
        hashes = range_hashes(codes, starts, ends)
        hashes[is_marks] = ~hashes[is_marks]
        numbers = self._known.find(hashes)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            fresh, first, own = np.unique(hashes[missing], return_index=True, return_inverse=True)
            first = missing[first]
            a, b = starts[first].tolist(), ends[first].tolist()
            pieces = [data[x:y] for x, y in zip(a, b, strict=True)]
            numbers[missing] = self._learn(fresh, pieces, is_marks[first])[own]
        rejected = numbers < 0
        good = np.flatnonzero(~rejected)
        rejected[good] = self._known.unlike(numbers[good], codes, starts[good], ends[good])
        return numbers, rejected

    def _learn(self, hashes: np.ndarray, pieces: Sequence[bytes], is_marks: np.ndarray) -> np.ndarray:
        """Numbers of new pieces, -1 for those that are not bare."""
        numbers = np.full(len(pieces), -1, dtype=np.int64)
        chosen: list[int] = []
        words: list[bytes] = []
        size = 0
        every_bare = not _NOT_BARE.search(b"\0".join(pieces).decode())
        for i, piece in enumerate(pieces):
            if is_marks[i]:
                ids = self._ids(piece.decode())
                one = np.array([len(piece)]), ids, np.array([len(ids)])
                numbers[i] = self._known.add(hashes[i : i + 1], piece, *one)[0]
            elif every_bare or not _NOT_BARE.search(piece.decode()):
                chosen.append(i)
                words.append(piece)
                size += len(piece) + 1
            if words and (size >= _STEP or i == len(pieces) - 1):
                numbers[chosen] = self._learn_words(hashes[chosen], words)
                chosen, words, size = [], [], 0
        return numbers

    def _learn_words(self, hashes: np.ndarray, words: Sequence[bytes]) -> np.ndarray:
        spaced = [w if w[0] == _NEWLINE else b" " + w for w in words]
        ids = self._ids(b"".join(spaced).decode())
        ends = np.cumsum(list(map(len, spaced)))
        cuts = np.searchsorted(np.cumsum(self._bytes[ids]), ends) + 1
        sizes = np.array(list(map(len, words)), dtype=np.int64)
        return self._known.add(hashes, b"".join(words), sizes, ids, np.diff(cuts, prepend=0))


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder a worker, which keeps what it has seen from task to task."""
    return Encoder(path)


def _encoding(tokenizer: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            found = [ids + end for ids in encoder(tokenizer).encode(texts)]
            sizes = np.array([len(ids) // 4 for ids in found], dtype=np.int64)
            ends = np.cumsum(sizes)
            ids = np.frombuffer(b"".join(found), dtype="<i4")
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), part, dtype=np.int32)),
                    pa.array(at + ends - sizes),
                    batch.column("row"),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                ],
                ["part", "at", "row", "n_tokens", "ids"],
            )
            at += int(ends[-1]) if len(ends) else 0

    return encode


def write_token_table(
    docs: DataFrame,
    tokenizer: str,
    path: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    end_id: int = 0,
    metadata: Sequence[str] = (),
    encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
    compression: str = "zstd",
) -> str:
    """Encode the whole texts of ``docs`` and write them as a token table; its folder.

    ``tokenizer`` is a byte-level tokenizer file that every executor can open. ``path`` must be a
    folder that all executors reach; without one it is a new one in the shared folder. Documents
    follow each other by ``doc_id``, nulls first, rows of one id by a hash of their text. A row
    keeps its id and the ``metadata`` columns in the struct ``row``, where no name can clash;
    other columns are left out. ``end_id`` follows each document, and is all that a null or empty
    text has. Equal rows are all written, and many rows of one id are dealt out over as many
    files as they fill. A very long text is one list, encoded piece by piece; a text without a
    single space between two characters is one piece. No documents make a table without rows.

    ``encoding`` is a name of ``ENCODINGS``: ids as places in a dictionary, best for a vocabulary
    that fits one page, or delta-coded. Lists are never split over row groups.
    """
    spark = docs.sparkSession
    options = ENCODINGS[encoding]
    path = path or f"{shared_folder(spark)}/token-tables/{uuid4().hex}"
    small_batches(docs, 256)
    files = max(1, math.ceil(total_bytes(docs, text) / FILE_TEXT_BYTES))
    kept = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys((doc_id, *metadata))])
    source = docs.select(
        kept.alias("row"),
        F.col(f"`{text}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Equal keys and even equal rows are told apart by their place, so that no range is hot.
    order = (F.col(f"row.`{doc_id}`").asc_nulls_first(), F.col("hash"), F.col("place"))
    ordered = source.repartitionByRange(files, *order).sortWithinPartitions(*order)
    schema = StructType(
        [
            StructField("part", IntegerType()),
            StructField("at", LongType()),
            source.schema["row"],
            StructField("n_tokens", LongType()),
            StructField("ids", ArrayType(IntegerType())),
        ]
    )
    encoded = ordered.select("row", "text").mapInArrow(_encoding(tokenizer, end_id), schema)
    writer = encoded.write.options(**options).option("compression", compression)
    writer.options(
        **{
            "parquet.block.size": str(row_group_bytes),
            "parquet.page.size": str(page_bytes),
            "parquet.page.row.count.limit": str(page_rows),
        }
    ).parquet(f"{path}/data")
    _write_index(spark, path, schema)
    return path


def _write_index(spark: SparkSession, path: str, schema: StructType) -> None:
    counted = spark.read.schema(schema).parquet(f"{path}/data").groupBy("part")
    sizes = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("n"))
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    sizes.select("part", "docs", F.col("n").alias("n_ids"), start).write.parquet(f"{path}/index")


def read_token_table(spark: SparkSession, path: str) -> DataFrame:
    """``row``, ``start``, ``n_tokens`` and ``ids`` of every document of a token table.

    ``start`` counts the ids of all documents before. Select what is needed: without ``ids``
    their pages are not read. Conditions on fields of ``row`` reach Parquet's page index.
    """
    return _placed(spark, path).select("row", "start", "n_tokens", "ids")


def read_ids(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """The documents that hold the ids ``first`` to ``first + count - 1`` of the whole table.

    Columns are those of ``read_token_table`` with ``ids`` cut to the range, and ``start`` at
    the first of them. Files outside the range are skipped by the index, pages by their bounds.
    """
    index = spark.read.parquet(f"{path}/index")
    inside = (F.col("first") < first + count) & (F.col("first") + F.col("n_ids") > first)
    end = first + count
    placed = _placed(spark, path, index.where(inside))
    held = placed.where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > first))
    begin = F.greatest(F.lit(first), F.col("start"))
    stop = F.least(F.lit(end), F.col("start") + F.col("n_tokens"))
    cut = F.slice("ids", (begin - F.col("start") + 1).cast("int"), (stop - begin).cast("int"))
    return held.select("row", begin.alias("start"), (stop - begin).alias("n_tokens"), cut.alias("ids"))


def _placed(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    data = spark.read.parquet(f"{path}/data")
    index = spark.read.parquet(f"{path}/index") if index is None else index
    start = (F.col("first") + F.col("at")).alias("start")
    return data.join(index.select("part", "first"), "part").select("*", start)


def ids_crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the column ``ids`` by the crc32 of the ids as little-endian 32-bit integers."""
    for batch in batches:
        lists = batch.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        ends = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        at = batch.schema.get_field_index("ids")
        yield batch.set_column(at, "ids", pa.array(sums, pa.int64()))
