"""Language of a text by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. Three letters are bound into a vector of their
own: the product of the first one's vector permuted twice, the second one's permuted once, and
the third one's. A text bundles the vectors of its letter triples by their sum, a language those
of its texts, and a text gets the language whose vector has the greatest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.llm.texts import mix, small_batches, unpacked, whole_rows
from lonja.sources.staging import stage

DIMENSIONS = 1024
UNKNOWN = "und"

# Languages compared in one pass over the texts.
LANGUAGES_A_PASS = 512

# Letter triples whose vectors are made together, and characters of a text read together.
_TRIPLES = 4096
_STEP = 1 << 20

_SPACE = 0x20

# What each text adds to its language in all, so that a long one counts no more than a short one.
_SHARE = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    """Random signs that depend on the letter alone."""
    place = np.arange(dimensions, dtype=np.uint64)
    seeds = mix(letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    bits = mix(seeds[:, None] + place * np.uint64(0xD1342543DE82EF95)) >> np.uint64(63)
    return (bits.astype(np.int8) << 1) - 1


def triple_counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct letter triples and their counts, or None without a letter.

    The text is lower-cased; anything between letters is one space, also at both ends.
    """
    found: list[np.ndarray] = []
    carry = np.array([_SPACE], dtype=np.int64)
    any_letter = False
    for at in range(0, len(text), _STEP):
        lowered = text[at : at + _STEP].lower()
        codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        any_letter |= bool(letter.any())
        codes = np.concatenate((carry, np.where(letter, codes, _SPACE)))
        spaces = codes == _SPACE
        repeated = np.zeros(len(codes), dtype=bool)
        repeated[len(carry) :] = (spaces[1:] & spaces[:-1])[len(carry) - 1 :]
        codes = codes[~repeated]
        found.append((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])
        carry = codes[-2:]
    if not any_letter:
        return None
    if carry[-1] != _SPACE and len(carry) == 2:
        found.append(np.array([(carry[0] << 42) | (carry[1] << 21) | _SPACE]))
    numbers, distinct = pd.factorize(np.concatenate(found))
    return distinct, np.bincount(numbers)


def shares(counts: np.ndarray) -> np.ndarray:
    """What each triple of a text adds: its part of ``_SHARE``, 1 at least, in whole numbers.

    So sums are exact in any order, and the rare triples of a very long text count too.
    """
    return np.maximum(1, np.rint(counts * (_SHARE / counts.sum())))


class Binder:
    """Vectors of letter triples; sums of whole numbers in float64 are exact."""

    def __init__(self, dimensions: int, kind: type = np.float32) -> None:
        self.dimensions = dimensions
        self.kind = kind

    def bundle(self, triples: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Rows of ``counts`` (texts by triples) as sums of the triples' vectors."""
        total = np.zeros((len(counts), self.dimensions), dtype=self.kind)
        for at in range(0, len(triples), _TRIPLES):
            part = triples[at : at + _TRIPLES]
            letters, place = np.unique(
                np.concatenate((part >> 42, (part >> 21) & 0x1FFFFF, part & 0x1FFFFF)),
                return_inverse=True,
            )
            first, second, third = np.split(place, 3)
            signs = _vectors(letters, self.dimensions)
            bound = np.roll(signs, 2, axis=1)[first]
            bound *= np.roll(signs, 1, axis=1)[second]
            bound *= signs[third]
            total += counts[:, at : at + _TRIPLES].astype(self.kind) @ bound.astype(self.kind)
        return total


def _table(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct triples of several texts, and a matrix of counts by text and triple."""
    numbers, distinct = pd.factorize(np.concatenate([t for t, _ in found]))
    counts = np.zeros((len(found), len(distinct)), dtype=np.float32)
    rows = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
    counts[rows, numbers] = np.concatenate([n for _, n in found])
    return distinct, counts


def _runs(found: list) -> Iterator[list[int]]:
    """Numbers of texts whose count matrix stays small."""
    run: list[int] = []
    size = 0
    for i, own in enumerate(found):
        if own is None:
            continue
        run.append(i)
        size += len(own[0])
        if size * len(run) > 1 << 21 or len(run) == 128:
            yield run
            run, size = [], 0
    if run:
        yield run


def prototypes(
    docs: DataFrame, learn: Column, text: str, lang: str, dimensions: int = DIMENSIONS
) -> DataFrame:
    """lang, place and value: the bundled vector of each language, over all rows to learn from."""
    rows = docs.where(learn).select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")
    )
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binder, sums = Binder(dimensions, np.float64), {}

        def out() -> pa.RecordBatch:
            names = sorted(sums)
            values = [sums[n].astype(np.int64) for n in names]
            sums.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(values, pa.list_(pa.int64()))],
                ["lang", "vector"],
            )

        for batch in batches:
            by_lang: dict[str, list] = {}
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for name, text_ in zip(langs, texts, strict=True):
                if (own := triple_counts(text_)) is not None:
                    by_lang.setdefault(name, []).append(own)
            for name, own in by_lang.items():
                triples = np.concatenate([t for t, _ in own])
                numbers, distinct = pd.factorize(triples)
                weights = np.concatenate([shares(n) for _, n in own])
                counts = np.bincount(numbers, weights=weights)[None, :]
                sums[name] = sums.get(name, 0) + binder.bundle(distinct, counts)[0]
            if len(sums) >= LANGUAGES_A_PASS:
                yield out()
        yield out()

    parts = rows.mapInArrow(bundle, "lang string, vector array<bigint>")
    parts = parts.select("lang", F.posexplode("vector").alias("place", "value"))
    return parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))


def languages(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    lang: str = "lang",
    result: str = "language",
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """All rows of ``docs`` with a struct ``result``: lang_pred and score from 0 to 1.

    Rows where ``learn`` is true and neither ``lang`` nor the text is null are learnt from; a
    prediction sees the text alone. ``score`` is the cosine, 0 if negative. A null text or one
    without a letter is `und` with score 0, and so is any text if nothing was learnt; of equal
    languages the first by name wins. Repeated rows get equal results. Texts of any length are
    read in pieces and learnt from whole. The learnt vectors are written to the shared folder and
    come to the driver for 512 languages at a time; the texts are compared in as many passes.
    Other columns pass through whatever their names; ``result`` must be free.
    """
    small_batches(docs, 256)
    learnt = stage(prototypes(docs, learn, text, lang, dimensions), "languages")
    kind = "struct<lang_pred:string,score:double>"
    start = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")).cast(kind)
    out = whole_rows(docs, text=F.col(f"`{text}`"), result=start)
    schema = out.schema
    for block, matrix in _blocks_of(learnt, dimensions):
        out = out.mapInArrow(_comparer(block, matrix, dimensions), schema)
    return unpacked(out, docs.columns, result)


def _blocks_of(learnt: DataFrame, dimensions: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """Names in rising order and their vectors of length one, ``LANGUAGES_A_PASS`` at a time."""
    names = learnt.groupBy("lang").agg(F.max(F.abs("value")).alias("most")).where("most > 0")
    last = F.lit(True)
    while block := [
        r["lang"] for r in names.where(last).orderBy("lang").limit(LANGUAGES_A_PASS).collect()
    ]:
        matrix = np.zeros((len(block), dimensions))
        places = {name: i for i, name in enumerate(block)}
        inside = F.col("lang").between(block[0], block[-1])
        for row in learnt.where(inside).collect():
            if row["lang"] in places:
                matrix[places[row["lang"]], row["place"]] = row["value"]
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        yield block, matrix.astype(np.float32)
        last = F.col("lang") > block[-1]


def _comparer(block: list[str], matrix: np.ndarray, dimensions: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        binder = Binder(dimensions)
        for batch in batches:
            best = batch.column("result").to_pylist()
            texts = batch.column("text").to_pylist()
            found = [triple_counts(t) if t is not None else None for t in texts]
            for run in _runs(found):
                bundled = binder.bundle(*_table([found[i] for i in run]))
                length = np.maximum(np.linalg.norm(bundled, axis=1), 1e-9)
                cosine = np.clip((bundled @ matrix.T) / length[:, None], 0.0, 1.0)
                for i, own in zip(run, cosine, strict=True):
                    top = int(own.argmax())
                    if best[i]["lang_pred"] == UNKNOWN or own[top] > best[i]["score"]:
                        best[i] = {"lang_pred": block[top], "score": float(own[top])}
            place = batch.schema.get_field_index("result")
            kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
            yield batch.set_column(place, "result", pa.array(best, kind))

    return compare
