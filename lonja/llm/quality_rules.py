"""Quality rules of a document, with repetition found by suffix arrays.

The suffix array of a text's words is built by prefix doubling, for many texts at once. The
ranks of each doubling give the longest common prefix of neighbouring suffixes; the maximal
repeated substrings are the longest-common-prefix intervals that a suffix cannot extend to the
left. Their spans are united into covered words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lonja.llm.texts import SPACES, binary, free_name, small_batches, unpacked, whole_rows

# Production limits of the repetition verdict.
MIN_REPEAT = 10
MAX_COVERED = 0.3
MAX_REPEAT = 100

# The symbols that the base rule counts, and its limits.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SHORT_WINDOW = 3

_CONTINUATION = bytes(range(0x80, 0xC0))

# Words whose suffixes are sorted together.
_BATCH_WORDS = 200_000

_RESULT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_covered bigint, longest_repeat bigint, n_repeats bigint, "
    "base_failed boolean, kept boolean"
)


def repeat_lengths(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For every position, the longest sequence from there that also starts elsewhere.

    ``words`` numbers the words, ``owner`` their text; a sequence stays in its text.
    """
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int64)
    last = np.searchsorted(owner, owner, side="right")
    _, rank = np.unique(owner.astype(np.int64) * (int(words.max()) + 1) + words, return_inverse=True)
    levels, step = [rank.astype(np.int64)], 1
    while True:
        rank = levels[-1]
        size = np.bincount(rank)
        if size.max() == 1:
            break
        after = np.full(n, -1, dtype=np.int64)
        reach = np.arange(n) + step
        on = reach < last
        after[on] = rank[reach[on]]
        # Only suffixes that are not told apart yet are sorted again.
        open_ = np.flatnonzero(size[rank] > 1)
        order = open_[np.lexsort((after[open_], rank[open_]))]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (after[order[1:]] != after[order[:-1]])
        # A suffix's new rank is the place of its group among all suffixes.
        place = np.cumsum(size) - size
        head = np.ones(len(order), dtype=bool)
        head[1:] = rank[order[1:]] != rank[order[:-1]]
        first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
        group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        wider = place[rank]
        wider[order] = place[rank[order]] + group - first
        levels.append(wider)
        step *= 2
    suffixes = np.argsort(levels[-1], kind="stable")
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        inside = (left + common < last[left]) & (right + common < last[right])
        at = np.flatnonzero(inside)
        a, b = left[at] + common[at], right[at] + common[at]
        width = 1 << level
        whole = (a + width <= last[left[at]]) & (b + width <= last[right[at]])
        same = whole & (ranks[a] == ranks[b])
        common[at[same]] += width
    longest = np.zeros(n, dtype=np.int64)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def covered(lengths: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a repeat of ``least`` words or more covers each word, and where maximal ones start."""
    starts = np.flatnonzero(lengths >= least)
    change = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths[starts], -1)
    maximal = np.zeros(len(lengths), dtype=bool)
    before = np.zeros(len(lengths), dtype=np.int64)
    before[1:] = lengths[:-1]
    maximal[starts] = before[starts] != lengths[starts] + 1
    return np.cumsum(change)[:-1] > 0, maximal


def _repetition(texts: Sequence[bytes], least: int) -> list[tuple[int, int, int, int, int]]:
    """Per text: words, words in short repeats, covered words, longest repeat, maximal repeats."""
    ids: dict[bytes, int] = {}
    numbers = [[ids.setdefault(w, len(ids)) for w in text.split()] for text in texts]
    counts = np.array([len(x) for x in numbers], dtype=np.int64)
    words = np.fromiter((x for own in numbers for x in own), np.int64, int(counts.sum()))
    lengths = repeat_lengths(words, np.repeat(np.arange(len(texts)), counts))
    short, _ = covered(lengths, SHORT_WINDOW)
    long, maximal = covered(lengths, least)
    out = []
    for start, n in zip(np.cumsum(counts) - counts, counts, strict=True):
        own = slice(start, start + n)
        longest = int(lengths[own].max()) if n else 0
        out.append(
            (int(n), int(short[own].sum()), int(long[own].sum()), longest, int(maximal[own].sum()))
        )
    return out


def _repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            repeated += line in seen
            seen.add(line)
    return repeated


def measure(
    texts: Sequence[bytes], min_repeat: int, max_covered: float, max_repeat: int
) -> list[dict]:
    """The result struct of each text; see ``quality``."""
    rows: list[dict] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < _BATCH_WORDS * 6):
            size += len(texts[end])
            end += 1
        part = texts[at:end]
        for text, found in zip(part, _repetition(part, min_repeat), strict=True):
            n_words, n_short, n_covered, longest, n_repeats = found
            failed = n_words < MIN_WORDS or 100 * n_short > MAX_REPEATED_PERCENT * n_words
            repetitive = n_covered > max_covered * n_words or longest > max_repeat
            rows.append(
                {
                    "n_words": n_words,
                    "word_chars": len(text.translate(None, SPACES + _CONTINUATION)),
                    "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
                    "n_dup_lines": _repeated_lines(text),
                    "n_repeat_words": n_short,
                    "n_covered": n_covered,
                    "longest_repeat": longest,
                    "n_repeats": n_repeats,
                    "base_failed": failed,
                    "kept": not failed and not repetitive,
                }
            )
        at = end
    return rows


def quality(
    docs: DataFrame,
    text: str = "text",
    result: str = "quality",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """All rows of ``docs`` with a struct ``result`` of measures and the verdict ``kept``.

    A text fails the base rule with fewer than 50 words or more than half of them in repeated
    3-word windows. It fails the repetition rule when maximal repeats of ``min_repeat`` words or
    more cover over ``max_covered`` of its words, or one is longer than ``max_repeat`` words.
    ``longest_repeat`` may be shorter than ``min_repeat``; repeats may overlap themselves.

    Null and empty texts have no words and fail. Each row is judged by its text alone, so
    repeated rows get equal results. Other columns pass through whatever their names; ``result``
    must be free.
    """
    small_batches(docs)
    kind = StructType.fromDDL(_RESULT)
    types = {"bigint": pa.int64(), "boolean": pa.bool_()}
    struct = pa.struct([(f.name, types[f.dataType.simpleString()]) for f in kind.fields])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("utf8").to_pylist()
            rows = measure(texts, min_repeat, max_covered, max_repeat)
            yield batch.select(["row"]).append_column("result", pa.array(rows, struct))

    rows = whole_rows(docs, utf8=binary(text))
    schema = rows.select("row", F.lit(None).cast(kind).alias("result")).schema
    return unpacked(rows.mapInArrow(judge, schema), docs.columns, result)


def good_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the quality rules keep, unchanged."""
    result = free_name(docs, "_quality")
    kept = quality(docs, text, result).where(F.col(f"{result}.kept"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
