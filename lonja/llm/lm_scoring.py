"""Language-model scores of whole texts: prediction by partial matching over byte contexts.

The model is a trie of byte contexts of up to ``order`` bytes, kept as one table per depth. A
symbol that a context has not been followed by is reached by escape to the context one byte
shorter, where the symbols already ruled out are excluded: with total T and q distinct symbols
left after exclusion, a symbol seen n times has n / (T + q) and escape q / (T + q). What is left
below the empty context is shared evenly. A byte that UTF-8 never uses marks start and end.

Nothing of the model is broadcast. Each chunk of documents asks for the counts of its own
distinct words and byte strings; these are dealt out by hash, summed over the corpus, scored,
and answered chunk by chunk.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lonja.llm.texts import LOWER, chunked, small_batches, unpacked

ORDER = 4
CHUNK_BYTES = 8 << 20

# Added to every count of the base score.
ADD = 0.1

_MARK = b"\xff"
_END = b""  # the end token; no word is empty

# Bytes of text whose byte strings are looked up together.
_STEP = 1 << 20

_WORDS = "bucket int, chunk int, words array<binary>, counts array<bigint>"
_GRAMS = "bucket int, chunk int, grams array<bigint>, counts array<bigint>"
_ANSWERS = "chunk int, bucket int, words boolean, tokens bigint, types bigint, found array<double>"
_RESULT = (
    "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, "
    "n_symbols bigint"
)


def _word_counts(texts: list[bytes], train: list[bool]) -> dict[bytes, int]:
    counts: dict[bytes, int] = {}
    for text, learn in zip(texts, train, strict=True):
        words = text.split()
        words.append(_END)
        if learn:
            for word in words:
                counts[word] = counts.get(word, 0) + 1
        else:
            for word in words:
                counts.setdefault(word, 0)
    return counts


def _by_bucket(words: list[bytes], buckets: int) -> list[list[bytes]]:
    """Words in rising order, dealt out by a hash."""
    dealt: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in words:
        dealt[zlib.crc32(word) % buckets].append(word)
    return dealt


def _steps(texts: list[bytes], order: int):
    """Groups of texts: first number, and the byte strings and start of each text's symbols.

    A symbol's byte string is the symbol and the ``order`` bytes before it, as one number.
    """
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _STEP or i + 1 == len(texts):
            part = texts[first : i + 1]
            # One mark run ends a text and starts the next.
            joined = _MARK * order + (_MARK * order).join(part) + _MARK
            codes = np.frombuffer(joined, dtype=np.uint8).astype(np.int64)
            strings = codes[: len(codes) - order].copy()
            for j in range(1, order + 1):
                strings = (strings << 8) | codes[j : len(codes) - order + j]
            sizes = np.array([len(t) for t in part], dtype=np.int64)
            starts = np.cumsum(sizes + order) - sizes - order
            inside = np.ones(len(strings), dtype=bool)
            for j in range(1, order):  # within a run of marks only the first is an end
                inside[(starts[1:] - j)] = False
            yield first, strings[inside], np.cumsum(sizes + 1) - sizes - 1, sizes + 1
            first, size = i + 1, 0


def _gram_counts(texts: list[bytes], train: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct byte strings in rising order and how often training texts have them."""
    keys, counts = [], []
    for first, strings, _, sizes in _steps(texts, order):
        codes, distinct = pd.factorize(strings)
        learn = np.repeat(train[first : first + len(sizes)], sizes)
        keys.append(distinct)
        counts.append(np.bincount(codes[learn], minlength=len(distinct)))
    codes, distinct = _merged(keys)
    return distinct, np.bincount(codes, weights=np.concatenate(counts)).astype(np.int64)


def _merged(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Place of every key among the distinct ones of all steps, and these in rising order."""
    return pd.factorize(np.concatenate(keys), sort=True)


def _gram_places(texts: list[bytes], order: int) -> tuple[np.ndarray, list[tuple]]:
    """The byte strings of ``_gram_counts``, and per step the place of every symbol's among them."""
    keys, steps = [], []
    for _, strings, starts, sizes in _steps(texts, order):
        codes, distinct = pd.factorize(strings)
        keys.append(distinct)
        steps.append((codes.astype(np.int32), starts, sizes))
    places, grams = _merged(keys)
    own = np.split(places, np.cumsum([len(k) for k in keys])[:-1])
    return grams, [(place, *step) for place, step in zip(own, steps, strict=True)]


def _dealt(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the byte strings by bucket, in rising order in each, and where each bucket starts."""
    bucket = grams % buckets
    place = np.argsort(bucket, kind="stable")
    return place, np.searchsorted(bucket[place], np.arange(buckets + 1))


def _lists(kind: pa.DataType, values: list) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _trie_scores(strings: DataFrame, order: int) -> DataFrame:
    """log10 probability of each byte string's last symbol after its other bytes.

    ``strings`` has every byte string ``gram`` that is asked for and its training count ``n``.
    A context has at most 256 rows, so every window below is that small.
    """
    depths = [strings.select("gram", "n")]
    for depth in range(order - 1, -1, -1):
        mask = (1 << (8 * (depth + 1))) - 1
        shorter = depths[-1].select(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"), "n")
        depths.append(shorter.groupBy("gram").agg(F.sum("n").alias("n")))
    depths.reverse()

    rows = depths[0].selectExpr(
        "gram", "n", "sum(n) OVER () AS total", "count_if(n > 0) OVER () AS types"
    )
    below = -F.log10(F.greatest(F.lit(1), F.lit(256) - F.col("types")))
    size = F.col("total") + F.col("types")
    enter = F.when(F.col("total") == 0, -F.log10(F.lit(256.0)))
    enter = enter.when(F.col("n") > 0, F.log10(F.col("n") / size))
    enter = enter.otherwise(F.log10(F.col("types") / size) + below)
    rows = rows.select("gram", "n", "total", "types", enter.alias("enter"), below.alias("escaped"))

    for depth in range(1, order + 1):
        mask = (1 << (8 * depth)) - 1
        lower = rows.select(
            F.col("gram").alias("suffix"),
            F.col("n").alias("low_n"),
            F.col("total").alias("low_total"),
            F.col("types").alias("low_types"),
            F.col("enter").alias("low_enter"),
            F.col("escaped").alias("low_escaped"),
        )
        here = depths[depth].withColumn("suffix", F.col("gram").bitwiseAND(F.lit(mask)))
        here = here.join(lower, "suffix").withColumn("context", F.shiftright("gram", 8))
        over = "OVER (PARTITION BY context)"
        here = here.selectExpr(
            "*",
            f"sum(n) {over} AS total",
            f"count_if(n > 0) {over} AS types",
            f"sum(if(n > 0, low_n, 0)) {over} AS excluded",
        )
        total = F.col("low_total") - F.col("excluded")
        types = F.col("low_types") - F.col("types")
        # Probability one byte shorter, without the symbols that this context has shown.
        escaped = F.when(types == 0, F.col("low_escaped"))
        escaped = escaped.when(F.col("low_n") > 0, F.log10(F.col("low_n") / (total + types)))
        escaped = escaped.otherwise(F.log10(types / (total + types)) + F.col("low_escaped"))
        size = F.col("total") + F.col("types")
        enter = F.when(F.col("total") == 0, F.col("low_enter"))
        enter = enter.when(F.col("n") > 0, F.log10(F.col("n") / size))
        enter = enter.otherwise(F.log10(F.col("types") / size) + escaped)
        rows = here.select(
            "gram", "n", "total", "types", enter.alias("enter"), escaped.alias("escaped")
        )
    return rows.select("gram", F.col("enter").alias("log10"))


def text_scores(
    docs: DataFrame,
    held_out: Column,
    text: str = "text",
    result: str = "scores",
    order: int = ORDER,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """All rows of ``docs`` with a struct ``result`` of scores; rows not held out are learnt from.

    A-Z are lower-cased. ``base_score`` is the add-0.1 unigram score of the words and one end,
    ``score`` the byte model's log10 probability of the text and its end over ``n_symbols``
    symbols. A null ``held_out`` counts as held out. Null and empty texts have the end alone.
    Repeated rows are each learnt from. With nothing to learn from, all bytes are equally likely.
    Other columns pass through whatever their names; ``result`` must be free.
    """
    small_batches(docs)
    train = ~F.coalesce(held_out, F.lit(True))
    learnt, chunks, _ = chunked(docs, text, chunk_bytes, train=train)
    schema = learnt.select("row", F.lit(None).cast(StructType.fromDDL(_RESULT)).alias("result")).schema
    grouped = learnt.groupBy("chunk")

    def read(table: pa.Table) -> tuple[list[bytes], list[bool]]:
        texts = [t.translate(LOWER) for t in table.column("utf8").to_pylist()]
        return texts, table.column("train").to_pylist()

    def count_words(key: tuple, table: pa.Table) -> pa.Table:
        counts = _word_counts(*read(table))
        dealt = _by_bucket(sorted(counts), chunks)
        # Empty lists too: each bucket answers every chunk with its totals.
        return pa.table(
            {
                "bucket": pa.array(range(chunks), pa.int32()),
                "chunk": pa.array([key[0].as_py()] * chunks, pa.int32()),
                "words": _lists(pa.binary(), dealt),
                "counts": _lists(pa.int64(), [[counts[w] for w in own] for own in dealt]),
            }
        )

    def count_grams(key: tuple, table: pa.Table) -> pa.Table:
        texts, train = read(table)
        grams, counts = _gram_counts(texts, np.array(train, dtype=bool), order)
        place, ends = _dealt(grams, chunks)
        full = np.flatnonzero(np.diff(ends)).tolist()
        own = [place[ends[b] : ends[b + 1]] for b in full]
        return pa.table(
            {
                "bucket": pa.array(full, pa.int32()),
                "chunk": pa.array([key[0].as_py()] * len(full), pa.int32()),
                "grams": _lists(pa.int64(), [grams[o] for o in own]),
                "counts": _lists(pa.int64(), [counts[o] for o in own]),
            }
        )

    def answer_words(key: tuple, posts: pa.Table) -> pa.Table:
        totals: dict[bytes, int] = {}
        lists = posts.column("words").to_pylist()
        for words, counts in zip(lists, posts.column("counts").to_pylist(), strict=True):
            for word, n in zip(words, counts, strict=True):
                totals[word] = totals.get(word, 0) + n
        tokens, types = sum(totals.values()), sum(n > 0 for n in totals.values())
        n = posts.num_rows
        return pa.table(
            {
                "chunk": posts.column("chunk"),
                "bucket": posts.column("bucket"),
                "words": pa.array([True] * n, pa.bool_()),
                "tokens": pa.array([tokens] * n, pa.int64()),
                "types": pa.array([types] * n, pa.int64()),
                "found": _lists(pa.float64(), [[float(totals[w]) for w in own] for own in lists]),
            }
        )

    def total_grams(key: tuple, posts: pa.Table) -> pa.Table:
        grams = posts.column("grams").combine_chunks().flatten().to_numpy()
        counts = posts.column("counts").combine_chunks().flatten().to_numpy()
        codes, distinct = pd.factorize(grams)
        total = np.bincount(codes, weights=counts, minlength=len(distinct)).astype(np.int64)
        return pa.table({"gram": pa.array(distinct, pa.int64()), "n": pa.array(total, pa.int64())})

    def answer_grams(key: tuple, posts: pa.Table, scores: pa.Table) -> pa.Table:
        index = pd.Index(scores.column("gram").to_numpy())
        logs = scores.column("log10").to_numpy()
        found = [logs[index.get_indexer(g)] for g in _arrays(posts.column("grams"))]
        n = posts.num_rows
        return pa.table(
            {
                "chunk": posts.column("chunk"),
                "bucket": posts.column("bucket"),
                "words": pa.array([False] * n, pa.bool_()),
                "tokens": pa.array([0] * n, pa.int64()),
                "types": pa.array([0] * n, pa.int64()),
                "found": _lists(pa.float64(), found),
            }
        )

    def score(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        texts, _ = read(table)
        if not texts:
            return _append(table, [])
        replies = answers.select(["words", "bucket", "tokens", "types", "found"])
        found: dict[bool, list] = {k: [np.empty(0)] * chunks for k in (True, False)}
        kinds, buckets = replies.column("words").to_pylist(), replies.column("bucket").to_pylist()
        tokens = sum(replies.column("tokens").to_pylist())
        types = sum(replies.column("types").to_pylist())
        for kind, bucket, own in zip(kinds, buckets, _arrays(replies.column("found")), strict=True):
            found[kind][bucket] = own

        split = [t.split() for t in texts]
        vocabulary = sorted({_END}.union(*split))
        logs: dict[bytes, float] = {}
        for words, own in zip(_by_bucket(vocabulary, chunks), found[True], strict=True):
            values = np.where(own > 0, np.log10(own + ADD), -1.0).tolist()
            logs.update(zip(words, values, strict=True))
        base, known, sizes = [], [], []
        whole = float(np.log10(tokens + ADD * (types + 1)))
        for words in split:
            values = list(map(logs.__getitem__, words))
            values.append(logs[_END])
            sizes.append(len(values))
            known.append(len(values) - values.count(-1.0))
            base.append(sum(values) - len(values) * whole)

        grams, steps = _gram_places(texts, order)
        values = np.empty(len(grams))
        by_bucket, ends = _dealt(grams, chunks)
        for bucket in np.flatnonzero(np.diff(ends)).tolist():
            values[by_bucket[ends[bucket] : ends[bucket + 1]]] = found[False][bucket]
        scores: list[float] = []
        symbols: list[int] = []
        for place, codes, starts, lengths in steps:
            scores += np.add.reduceat(values[place][codes], starts).tolist()
            symbols += lengths.tolist()
        rows = zip(sizes, known, [tokens] * len(texts), base, scores, symbols, strict=True)
        return _append(table, list(rows))

    fields = [f.split() for f in _RESULT.split(", ")]
    arrow = {"bigint": pa.int64(), "double": pa.float64()}

    def _append(table: pa.Table, rows: list[tuple]) -> pa.Table:
        own = [pa.array([r[i] for r in rows], arrow[kind]) for i, (_, kind) in enumerate(fields)]
        struct = pa.StructArray.from_arrays(own, [name for name, _ in fields])
        return table.select(["row"]).append_column("result", struct)

    words = grouped.applyInArrow(count_words, _WORDS).groupBy("bucket")
    posted = grouped.applyInArrow(count_grams, _GRAMS)
    totals = posted.groupBy("bucket").applyInArrow(total_grams, "gram bigint, n bigint")
    # Dealt out once, so that all depths of the trie read what was summed one time.
    totals = totals.repartition("gram")
    scores = _trie_scores(totals, order)
    scores = scores.withColumn("bucket", F.pmod("gram", F.lit(chunks)).cast("int"))
    replies = posted.groupBy("bucket").cogroup(scores.groupBy("bucket"))
    answers = words.applyInArrow(answer_words, _ANSWERS).union(
        replies.applyInArrow(answer_grams, _ANSWERS)
    )
    scored = grouped.cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)
    return unpacked(scored, docs.columns, result)


def _arrays(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as arrays."""
    out = []
    for chunk in lists.chunks:
        values, edges = chunk.flatten().to_numpy(), np.diff(chunk.offsets.to_numpy())
        out += np.split(values, np.cumsum(edges)[:-1]) if len(edges) else []
    return out
