"""Corpus operators against brute force, on texts with every awkward case."""

import hashlib
import math
from collections import Counter, defaultdict

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lonja.llm import (
    decontamination,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    quality_rules,
    substring_dedup,
    token_counts,
    url_filters,
    warc,
)

SCHEMA = "doc_id bigint, text string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def awkward(df):
    """Columns named like the ones operators use inside."""
    for name in ("_chunk", "_utf8", "_train", "n_words", "kept", "bucket", "keys", "component", "k1"):
        df = df.withColumn(name, F.lit(name))
    return df.withColumn("odd.name", F.array(F.lit(None).cast("int")))


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def same(df, columns, expected):
    found, wanted = rows_of(df, *columns), Counter(expected)
    assert found - wanted == Counter() and wanted - found == Counter()


@pytest.fixture(scope="module")
def rows():
    return brute.corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return awkward(frame(spark, rows)).cache()


@pytest.mark.parametrize("width", [2, 7, 35])
def test_substrings(docs, rows, width):
    found = substring_dedup.repeated_passages(docs, window=width, chunk_bytes=60_000)
    assert found.columns == [*docs.columns, "passages"]
    columns = ["doc_id", "passages.n_words", "passages.n_removed", "passages.kept_sha256"]
    same(found, columns, brute.substrings(rows, width))
    for row in found.select("passages.*").collect():
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
        assert hashlib.sha256(row.kept).hexdigest() == row.kept_sha256


def test_substrings_cut_from_texts(docs, rows):
    cut = substring_dedup.without_passages(docs.withColumn("n_chars", F.length("text")), window=35)
    assert cut.columns == [*docs.columns, "n_chars"]
    whole = Counter(text for _, text in rows)
    for row in cut.collect():
        assert row.text is None or row.n_chars == len(row.text)
        assert whole[row.text] or not brute.words_of(row.text) or row.text == " ".join(row.text.split())


def test_quality(docs, rows):
    judged = quality_rules.quality(docs, min_repeat=5, max_covered=0.2, max_repeat=12)
    fields = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    same(judged, ["doc_id", *[f"quality.{c}" for c in fields]], brute.quality(rows, 5, 0.2, 12))
    assert quality_rules.good_documents(docs).columns == docs.columns


def test_repeat_lengths_of_periodic_words():
    words = np.array([1, 2, 1, 2, 1, 2, 9, 1, 2])
    owner = np.array([0, 0, 0, 0, 0, 0, 0, 1, 1])
    lengths = quality_rules.repeat_lengths(words, owner)
    assert lengths.tolist() == [4, 3, 4, 3, 2, 1, 0, 0, 0]
    _, maximal = quality_rules.covered(lengths, 2)
    assert maximal.tolist() == [True, False, True, False, False, False, False, False, False]


def test_near_duplicates(docs, rows):
    found = near_dedup.near_duplicates(docs)
    same(found, ["doc_id", "n_shingles", "component_id", "kept"], brute.near(rows))


def test_near_duplicates_of_a_drifting_group(spark):
    """Copies that each change a little: only some link to any one of them."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(150, rng.integers(0, 7), replace=False):
            words[at] = f"e{rng.integers(0, 40)}"
        rows.append((int(i), " ".join(words[: rng.integers(120, 151)])))
    found = near_dedup.near_duplicates(frame(spark, rows))
    same(found, ["doc_id", "n_shingles", "component_id", "kept"], brute.near(rows))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = near_dedup.components(spark.createDataFrame(chain, "x bigint, y bigint"))
    expected = {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
    assert {r.node: r.component for r in found.collect()} == expected


@pytest.mark.parametrize("width", [3, 10])
def test_decontamination(spark, docs, rows, width):
    texts = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(1, " ".join(texts[1].split()[5:30]).upper()), (2, " ".join(texts[2].split()[:12]))]
    items += [(3, "one"), (4, None), (5, " ,;"), (None, " ".join(texts[3].split()[3:20]))]
    items += [(10, "-".join(texts[1].split()[5:30])), (2, "nowhere to be found at all")]
    table = spark.createDataFrame(items, "item_id bigint, text string").withColumn("n", F.lit(1))
    found = decontamination.contaminated(docs, table, width=width)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    same(found, columns, brute.contaminated(rows, items, width))
    clean = decontamination.clean_documents(docs, table, width)
    assert clean.columns == docs.columns
    dirty = {r[0] for r in brute.contaminated(rows, items, width) if r[5]}
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - dirty


def test_decontamination_without_items(spark, docs, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert rows_of(decontamination.contaminated(docs, none), "contaminated") == {(False,): len(rows)}


def test_scores(docs, rows):
    held = F.col("doc_id") % 4 == 0
    rows = [(i, t) for i, t in rows if len(t or "") < 5000]
    docs = docs.where("coalesce(length(text), 0) < 5000")
    found = lm_scoring.text_scores(docs, held, order=3, chunk_bytes=4000)
    assert found.columns == [*docs.columns, "scores"]
    model, counts = brute.Ppm(3), Counter()
    for doc_id, text in rows:
        if doc_id is not None and doc_id % 4:
            model.learn((text or "").encode().translate(brute.LOWER))
            counts.update([*brute.words_of(text, True), None])
    total, types = sum(counts.values()), len(counts)
    expected = defaultdict(list)
    for doc_id, text in rows:
        known = [counts[w] for w in [*brute.words_of(text, True), None]]
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (types + 1))) for c in known)
        score = model.score((text or "").encode().translate(brute.LOWER))
        own = (len(known), sum(c > 0 for c in known), total, base, score)
        expected[doc_id, text].append(own)
    for row in found.select("doc_id", "text", "scores.*").collect():
        own = expected[row.doc_id, row.text].pop()
        assert (row.n_tokens, row.n_known, row.train_tokens) == own[:3]
        assert (row.base_score, row.score) == pytest.approx(own[3:], rel=1e-9)
    assert not any(expected.values())
    assert sum(10 ** model.log10(b"abc", s) for s in range(256)) == pytest.approx(1)


def test_scores_without_training(spark):
    docs = frame(spark, [(1, "ab"), (2, None)])
    found = lm_scoring.text_scores(docs, F.lit(None).cast("boolean"))
    scores = {r.doc_id: r.scores for r in found.collect()}
    assert scores[1].score == pytest.approx(-3 * math.log10(256))
    assert (scores[2].n_tokens, scores[2].n_known, scores[2].train_tokens) == (1, 0, 0)


def test_token_files(spark, docs, rows):
    folder = token_counts.write_token_files(docs)
    key = lambda r: (r[0] is not None, r[0] or 0)
    ordered = sorted(rows, key=key)
    for block in (6, 4096, 1 << 20):
        found = token_counts.documents_in(spark, folder, block_bytes=block if block > 6 else 5000)
        found = found.orderBy("document").collect()
        assert [r.document for r in found] == list(range(len(rows)))
        sizes = defaultdict(list)
        for row, (doc_id, _) in zip(found, ordered, strict=True):
            sizes[doc_id].append(row.n_tokens)
        expected = defaultdict(list)
        for doc_id, text in ordered:
            expected[doc_id].append(len(brute.words_of(text)))
        assert {k: sorted(v) for k, v in sizes.items()} == {k: sorted(v) for k, v in expected.items()}
        starts = 0
        for row in found:
            starts = starts if row.start else 0
            assert row.start == starts
            starts += row.n_tokens + 1


@pytest.mark.parametrize("block", [4, 6, 64])
def test_token_files_by_hand(spark, tmp_path, block):
    files = [[5, 0, 6, 7, 0, 0, 9], [], [0, 0, 3], [1, 2, 3, 4, 5, 6, 7, 0]]
    for i, ids in enumerate(files):
        data = np.array(ids, dtype="<u2").tobytes() + (b"\x07" if i == 2 else b"")
        (tmp_path / f"part-{i:05d}").write_bytes(data)
    found = token_counts.documents_in(spark, str(tmp_path), block_bytes=block)
    rows = [(r.document, r.start, r.n_tokens) for r in found.orderBy("document").collect()]
    first = [(0, 0, 1), (1, 2, 2), (2, 5, 0), (3, 6, 1)]
    assert rows == [*first, (4, 0, 0), (5, 1, 0), (6, 2, 1), (7, 0, 7)]


def test_url_verdicts(spark):
    urls = ["http://A.Example.org/es/1", "https://example.org/en/12?x", "http://x.org", None, "nothing"]
    urls += ["http://a.com/de/1", "http://a.com/fr/1", "http://spam-farm.net/", "ftp://ok.net#/x"]
    urls += ["http://casino.net/", "://", "http://ok.net/a?b", "http://notexample.org/es/"] * 2
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    pages = pages.withColumn("host", F.lit(1)).withColumn("verdict", F.lit(2))
    for bits in (url_filters.CASCADE_BITS, 8):
        found = url_filters.judged(pages, cascade_bits=bits)
        rows = {r.page_id: tuple(r.judged) for r in found.collect()}
        assert len(rows) == len(urls)
        assert rows[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
        assert rows[1] == ("example.org", "/en/12", "example.org/en/1", "block")
        assert rows[2] == ("x.org", "", None, "allow")
        assert rows[3] == rows[4] == rows[10] == ("", "", None, "allow")
        assert rows[5][2:] == ("com/de/", "block") and rows[6][2:] == ("com/fr/", "allow")
        assert rows[7] == ("spam-farm.net", "/", None, "block")
        assert rows[8] == ("ok.net", "", None, "allow")
        assert rows[9] == rows[13] == ("casino.net", "/", None, "block")
        assert rows[11] == ("ok.net", "/a", None, "allow")
        assert rows[12] == rows[16] == ("notexample.org", "/es/", "org/", "allow")


def test_cascade_is_exact(spark):
    keys = spark.range(6000).select(F.concat(F.lit("h"), "id").alias("host"), "id")
    listed = keys.where("id % 3 = 0").select("host")
    others = keys.where("id % 3 <> 0").select("host")
    cascade = url_filters.Cascade(listed, others, "host")
    assert len(cascade.levels) > 2
    wrong = keys.where(cascade.member(F.col("host")) != (F.col("id") % 3 == 0))
    assert wrong.count() == 0
    nothing = url_filters.Cascade(listed.limit(0), others, "host")
    assert keys.where(nothing.member(F.col("host"))).count() == 0


def test_languages(spark):
    rng = np.random.default_rng(3)
    letters = {"xx": "abcdefg", "yy": "efghijk", "zz": "жзийкл"}
    rows = []
    for i in range(120):
        lang = list(letters)[i % 3]
        words = ["".join(rng.choice(list(letters[lang]), 4)) for _ in range(40)]
        rows.append((i, " ".join(words), lang if i % 10 else None))
    rows += [(200, None, "xx"), (201, "12 ,.", "xx"), (202, "", None), (None, "abc", "xx"), (204, "a", "xx")]
    rows += [(205, "жж " * 600_000, "zz"), (205, "жж " * 600_000, "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs = docs.withColumn("lang_pred", F.lit(1))
    found = language_id.languages(docs, F.col("doc_id") % 4 != 2)
    assert found.columns == [*docs.columns, "language"] and found.count() == len(rows)
    named = {r.doc_id: r.language for r in found.collect()}
    assert all(named[i].lang_pred == list(letters)[i % 3] for i in range(120))
    assert {named[i].lang_pred for i in (200, 201, 202)} == {"und"} and named[205].lang_pred == "zz"
    assert all(0 <= x.score <= 1 for x in named.values())
    blind = language_id.languages(docs, F.lit(False)).select("language.lang_pred").distinct()
    assert [r.lang_pred for r in blind.collect()] == ["und"]


def test_languages_of_the_documents(spark, sf):
    """Every prediction against plain sums of vectors, and those of held-out texts against lang."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [tuple(r) for r in rows] + [(9001, "aaa " * 40_000 + "qwx", "de"), (9002, None, "en"), (None, "Ab", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learn = [r[0] is not None and r[0] % 4 != 2 for r in rows]
    found = {
        r.doc_id: r.language for r in language_id.languages(docs, F.col("doc_id") % 4 != 2).collect()
    }
    expected = brute.languages(rows, learn, language_id._vectors, language_id._SHARE)
    for (doc_id, _, _), (name, score) in zip(rows, expected, strict=True):
        assert found[doc_id].lang_pred == name and abs(found[doc_id].score - score) < 1e-4
    held_out = [(r, e) for r, e, own in zip(rows, expected, learn, strict=True) if not own and r[0] and r[1] and r[2]]
    right = sum(r[2] == e[0] for r, e in held_out)
    assert len(held_out) > 20 and right >= 0.9 * len(held_out)


def test_rare_triples_of_a_long_text_count():
    shares = language_id.shares(np.array([30_000_000, 2, 1]))
    assert shares[0] > 1 << 19 and shares[1:].tolist() == [1, 1]


def test_languages_in_blocks(spark, monkeypatch):
    """More languages than are compared at a time."""
    monkeypatch.setattr(language_id, "LANGUAGES_A_PASS", 2)
    rows = [(i, f"{chr(97 + i) * 3} {chr(98 + i) * 2}", f"l{i}") for i in range(7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = language_id.languages(docs, F.lit(True)).collect()
    assert all(r.language.lang_pred == r.lang for r in found)


def test_near_duplicates_without_ids(spark):
    """Rows without an id, or with one id and other texts, are found by their texts."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        words = [f"w{j}" for j in rng.integers(0, 50_000, 60)]
        near = [*words[:59], "other"]
        rows += [(None, " ".join(words)), (None if i % 2 else 5, " ".join(near))]
    found = near_dedup.near_duplicates(frame(spark, rows))
    same(found, ["doc_id", "n_shingles", "component_id", "kept"], brute.near(rows))


def test_triples_across_steps(monkeypatch):
    text = "ab,, cDİ x" * 50
    whole = dict(zip(*map(list, language_id.triple_counts(text)), strict=True))
    monkeypatch.setattr(language_id, "_STEP", 7)
    assert dict(zip(*map(list, language_id.triple_counts(text)), strict=True)) == whole


def test_revisits(spark):
    h = {"content-type": "text/html", "content-length": "9", "cache-control": "a", "server": "s"}
    new = {"content-length": "0", "cache-control": "b", "etag": "E"}
    records = [
        (1, "http://www.A.org/x/", 10, "response", '"1"', None, h),
        (2, "https://a.org/x#f", 20, "revisit", 'W/"1"', None, new),
        (3, "http://a.org:80/x?utm_source=q", 200_000, "revisit", '"2"', None, new),
        (4, "http://a.org/x", 200_000, "response", None, "d", None),
        (5, "http://a.org/x", 900_000, "revisit", '"1"', "d", new),
        (6, "http://a.org/x", 900_001, "revisit", '"1"', None, None),
        (7, "http://b.org/", 5, "revisit", '"1"', None, new),
        (8, None, 5, "revisit", '"1"', None, new),
        (9, "http://a.org/x", None, "response", '"1"', None, h),
        (10, "http://a.org/x", 15, "metadata", None, None, h),
        (11, "http://a.org/x?a=1&utm_x=2", 16, "revisit", '"1"', None, None),
    ]
    schema = (
        "record_id bigint, uri string, at bigint, kind string, etag string, last_modified string, "
        "headers map<string,string>"
    )
    frame = spark.createDataFrame(records + records[1:2], schema)
    frame = frame.withColumn("slice", F.lit(1)).withColumn("outcome", F.lit(2))
    found = warc.resolved(frame)
    assert found.count() == len(records) + 1
    rows = {r.record_id: r for r in found.collect()}
    assert {i: (r.outcome, r.refers_to) for i, r in rows.items()} == {
        1: ("full", None),
        2: ("resolved", 1),
        3: ("changed", None),
        4: ("full", None),
        5: ("resolved", 4),
        6: ("unchecked", None),
        7: ("no response", None),
        8: ("no response", None),
        9: ("full", None),
        10: ("ignored", None),
        11: ("no response", None),
    }
    assert rows[2].headers == h | {"cache-control": "b", "etag": "E"}
    assert rows[5].headers == {"cache-control": "b", "etag": "E"} and rows[6].headers == {}
    assert rows[2].uri_key == "a.org/x" and rows[11].uri_key == "a.org/x?a=1"
    assert warc.resolved(frame.limit(0)).count() == 0


def plain_fill(sizes, capacities, limit):
    """Best fit with lists: (room, pieces) per bin."""
    bins = []
    for i, size in enumerate(sizes):
        open_ = [(b[0], n) for n, b in enumerate(bins) if b[0] >= size]
        if open_:
            n = min(open_)[1]
        else:
            fits = [c for c in capacities if c >= size]
            fits = [c for c in fits if c <= limit] or fits[:1]
            n = len(bins)
            bins.append([min(fits, key=lambda c: (packing.cost(c) / c, c)), []])
        bins[n][0] -= size
        bins[n][1].append(i)
    return [b[1] for b in bins]


def test_packing_of_one_group():
    rng = np.random.default_rng(2)
    sizes = sorted((int(x) for x in rng.integers(1, 65, 300)), reverse=True)
    capacities = (16, 32, 64)

    def total(bins):
        used = [sum(sizes[i] for i in own) for own in bins]
        return sum(packing.cost(min(c for c in capacities if c >= u)) for u in used)

    options = [plain_fill(sizes, capacities, limit) for limit in capacities]
    found = packing.pack_sizes(sizes, capacities)
    assert sorted(i for _, own in found for i in own) == list(range(300))
    assert [own for _, own in found] == min(options, key=total)
    assert packing.pack_sizes([], capacities) == []


def test_packing(spark, docs, rows):
    size = packing.word_count(F.col("text"))
    found = packing.packed(docs, size, capacities=(64, 16, 32), group=20)
    again = packing.packed(docs.repartition(1), size, capacities=(64, 16, 32), group=20)
    assert rows_of(found, *found.columns) == rows_of(again, *found.columns)
    bins, pieces = defaultdict(list), Counter()
    for row in found.collect():
        if row.sequence is None:
            assert row.n_tokens == 0
        else:
            bins[row.sequence].append(row)
        pieces[row.doc_id] += row.n_tokens
    expected = Counter()
    for doc_id, text in rows:
        expected[doc_id] += len(brute.words_of(text))
    assert pieces == expected
    for own in bins.values():
        own.sort(key=lambda r: r.position)
        used = sum(r.n_tokens for r in own)
        assert [r.position for r in own] == [sum(x.n_tokens for x in own[:i]) for i in range(len(own))]
        assert {(r.capacity, r.used) for r in own} == {(min(c for c in (16, 32, 64) if c >= used), used)}


def test_empty_tables(spark):
    none = awkward(frame(spark, []))
    assert substring_dedup.repeated_passages(none).count() == 0
    assert substring_dedup.without_passages(none).count() == 0
    assert quality_rules.quality(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert lm_scoring.text_scores(none, F.lit(False)).count() == 0
    assert language_id.languages(none, F.lit(True), lang="kept").count() == 0
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontamination.contaminated(none, items).count() == 0
    assert packing.packed(none, F.lit(3)).count() == 0
    assert token_counts.documents_in(spark, token_counts.write_token_files(none)).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filters.judged(pages).count() == 0


def test_queries_and_stages(spark, sf):
    """Registered names, whole answers, and a pipeline whose stages take effect."""
    import __spark_entry__ as driver
    import corpus_pipeline

    queries, statements = driver.queries(), driver.oracle_sql()
    names = [n for n in queries if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert {n for n in names if n in statements} == {
        n for n in names if int(n[2:].split("_")[0]) in (1, 3, 6, 7, 9, 11, 13)
    }
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes, now = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == docs.columns, name
        now = now.checkpoint() if spark.sparkContext.getCheckpointDir() else now.cache()
        sizes.append(now.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] >= sizes[4]
    before = [(r.doc_id, r.text) for r in docs.collect()]
    limits = (quality_rules.MIN_REPEAT, quality_rules.MAX_COVERED, quality_rules.MAX_REPEAT)
    good = {r[0] for r in brute.quality(before, *limits) if r[-1]}
    kept = {r[0] for r in brute.near([r for r in before if r[0] in good]) if r[3]}
    assert sizes[2] == len(kept)
    cut = brute.substrings([r for r in before if r[0] in kept], 35)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in now.collect()}
    for doc_id, _, removed, digest in cut:
        if removed and doc_id in texts:
            assert hashlib.sha256(texts[doc_id].encode()).hexdigest() == digest
    assert not any(r[5] for r in brute.contaminated(list(texts.items()), items, 10))
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert {r.doc_id for r in packed.collect()} == set(texts)
