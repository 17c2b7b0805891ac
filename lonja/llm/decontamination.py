"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions alone.

Every item is cut into windows of ``width`` words. A window's tokens are its shingles of two
words (its word, if it has one), ordered by how rare they are in the corpus. All tokens of a
window must occur, so the necessary prefix is its rarest token, and documents are joined on
that one. The token's place gives the only possible start; starts before the first word or too
near the last fall away. The words from each start are compared with the whole window.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.llm.texts import free_name
from lonja.sources.staging import stage

WIDTH = 10

# Fixed value: what separates words, after A-Z were lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Joins with the benchmark's tokens are broadcast up to this many tokens of 8 bytes each.
BROADCAST_TOKENS = 2_000_000


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else; plain ASCII takes the short way."""
    by_letter = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(by_letter)


def word_list(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _tokens(words: str, single: bool) -> Column:
    """Hashes of all two-word shingles in order, or of all words."""
    if single:
        return F.transform(words, lambda w: F.xxhash64(w))
    count = F.greatest(F.size(words) - 1, F.lit(0))
    return F.transform(
        F.slice(words, 1, count), lambda w, i: F.xxhash64(w, F.get(F.col(words), i + 1))
    )


def item_windows(items: DataFrame, text: str, item_id: str, width: int) -> DataFrame:
    """item_id, size, gram and tokens of every window of every item."""
    words = items.select(
        F.col(f"`{item_id}`").cast("string").alias("item_id"),
        word_list(F.col(f"`{text}`")).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    cut = words.select("item_id", "words", F.explode_outer(starts).alias("start"))
    cut = cut.select("item_id", F.slice("words", F.col("start"), width).alias("window"))
    tokens = F.when(F.size("window") == 1, _tokens("window", True)).otherwise(
        _tokens("window", False)
    )
    return cut.select(
        "item_id",
        F.size("window").alias("size"),
        F.array_join("window", " ").alias("gram"),
        tokens.alias("tokens"),
    )


def _small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint where its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_TOKENS else df


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    width: int = WIDTH,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    A window is ``width`` consecutive words of an item, or a whole item of fewer words. A word
    inside any occurrence of a window is hit; ``spans`` are the occurrences as word ranges.
    ``items_sha256`` is over the sorted distinct ids, as text, of items with occurring windows;
    an item without an id adds no id. Null and empty texts have no words, items without words
    no windows; without items nothing is hit. Repeated rows are answered alike, one by one.
    Only the four named columns are read. The benchmark's windows are written first.
    """
    judged = _judged(docs, items, text, doc_id, item_text, item_id, width)
    return judged.drop("k1", "k2")


def _row_keys(text: str, doc_id: str) -> tuple[Column, Column]:
    """Two hashes that tell rows of different ids or texts apart."""
    text, doc_id = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    return F.xxhash64(doc_id, text), F.xxhash64(text, F.lit(1), doc_id)


def _judged(
    docs: DataFrame,
    items: DataFrame,
    text: str,
    doc_id: str,
    item_text: str,
    item_id: str,
    width: int,
) -> DataFrame:
    """The columns of ``contaminated`` and the row's keys k1 and k2."""
    windows = item_windows(items, item_text, item_id, width)
    windows = stage(windows, "windows")
    grams = windows.groupBy("gram", "size").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.first("tokens").alias("tokens")
    )
    # An occurrence is known by its whole text; this also names the window.
    k1, k2 = _row_keys(text, doc_id)
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        k1.alias("k1"),
        k2.alias("k2"),
    )
    worded = source.select("k1", "k2", word_list(F.col("text")).alias("words"))
    singles = not windows.where("size = 1").isEmpty()

    def occurrences(carry: tuple[str, ...]) -> DataFrame:
        """Every token of every document and its place; single words where items ask for them."""
        carried = worded.select(*carry, F.size("words").alias("n_words"), "words")
        kinds = [carried.select(*carry, "n_words", _tokens("words", False).alias("t"))]
        if singles:
            kinds.append(carried.select(*carry, "n_words", _tokens("words", True).alias("t")))
        out = kinds[0] if len(kinds) == 1 else kinds[0].unionAll(kinds[1])
        # The outer form: the inner one adds a filter that splits the text once more per word.
        return out.select(*carry, "n_words", F.posexplode_outer("t").alias("at", "token"))

    tokens = windows.select(F.explode("tokens").alias("token")).distinct()
    counts = occurrences(()).join(_small(tokens), "token").groupBy("token")
    rarity = stage(counts.agg(F.count("*").alias("n")), "rarity")

    # The rarest token of each window that occurs at all; a window lacking one can't occur.
    placed = grams.select("gram", "size", F.posexplode_outer("tokens").alias("offset", "token"))
    ordered = placed.join(rarity, "token", "left").withColumn(
        "rank",
        F.row_number().over(
            Window.partitionBy("gram").orderBy(F.col("n").asc_nulls_first(), "token", "offset")
        ),
    )
    anchors = ordered.where("rank = 1 AND n IS NOT NULL").select("token", "offset", "size")
    anchors = stage(anchors.distinct(), "anchors")
    rare = _small(anchors.select("token").distinct())

    start = F.col("at") - F.col("offset")
    found = occurrences(("k1", "k2")).join(rare, "token").join(anchors, "token")
    found = found.select("k1", "k2", "n_words", start.alias("start"), "size")
    found = found.where("start >= 0 AND start + size <= n_words")
    candidates = found.groupBy("k1", "k2").agg(
        F.collect_set(F.struct("start", "size")).alias("candidates")
    )

    # Every row meets its candidate starts once; the words there are compared as text.
    text_rows = source.join(candidates.hint("shuffle_hash"), ["k1", "k2"], "left").select(
        "k1", "k2", "doc_id", "candidates", word_list(F.col("text")).alias("words")
    )
    phrases = F.transform(
        "candidates",
        lambda c: F.struct(
            c["start"].alias("start"),
            (c["start"] + c["size"]).alias("end"),
            F.array_join(F.slice("words", c["start"] + 1, c["size"]), " ").alias("gram"),
        ),
    )
    rows = text_rows.select(
        "k1",
        "k2",
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.greatest(F.size("candidates"), F.lit(1)).alias("parts"),
        F.explode_outer(phrases).alias("c"),
    )
    rows = rows.select("k1", "k2", "doc_id", "n_words", "parts", "c.*")
    matched = rows.join(grams.select("gram", "items"), "gram", "left")
    hit = F.col("items").isNotNull()
    by_row = matched.groupBy("k1", "k2", "doc_id", "n_words").agg(
        # Equal rows come together here and part again below.
        (F.count("*") / F.max("parts")).cast("int").alias("copies"),
        F.collect_set(F.when(hit, F.struct("start", "end"))).alias("found"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    spans = F.array_sort("found")
    union = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("bigint").alias("n")),
        lambda s, c: F.struct(
            F.greatest(s["upto"], c["end"]).alias("upto"),
            (s["n"] + F.greatest(c["end"] - F.greatest(s["upto"], c["start"]), F.lit(0))).alias("n"),
        ),
        lambda s: s["n"],
    )
    out = by_row.select(
        "k1",
        "k2",
        "doc_id",
        "n_words",
        union.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        spans.alias("spans"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    )
    return out.withColumn("contaminated", F.col("n_hit") > 0).drop("copy")


def clean_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item.

    Every row is judged by its own text, whatever other rows share its doc_id or lack of one.
    """
    found = _judged(docs, items, "text", "doc_id", "text", "item_id", width)
    dirty = found.where("contaminated").select("k1", "k2").distinct()
    names = [free_name(docs, f"_{k}") for k in dirty.columns]
    keyed = docs.withColumns(dict(zip(names, _row_keys("text", "doc_id"), strict=True)))
    return keyed.join(dirty.toDF(*names), names, "left_anti").drop(*names)
