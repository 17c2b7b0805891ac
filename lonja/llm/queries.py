"""Registered queries of the corpus operators and, where SQL can say it, their DuckDB statements."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from lonja.llm import (
    decontamination,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    prefix_trie,
    quality_rules,
    structure_repair,
    substring_dedup,
    token_counts,
    token_files,
    turns,
    url_filters,
    warc,
)
from lonja.llm.prefix_trie import EMPTY_SHA256
from lonja.session import apply_settings
from lonja.sources.staging import ROW

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(apply_settings(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def remainder(modulus: int) -> Column:
    """crc32 of the document's id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def _crc32(text: str) -> str:
    """crc32 of an ASCII text in SQL: every byte is followed by eight shifts of one bit."""
    steps = f"""flatten(list_transform(string_split({text}, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], {steps}),
        lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END),
        4294967295)"""


_A, _Z = string.ascii_uppercase, string.ascii_lowercase


@query(
    "op1_decontamination",
    f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', '{_Z}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', '{_Z}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id::VARCHAR AS item_id, list_slice(w, p, p + 9) AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b
        WHERE len(w) > 0)
), starts AS (
    SELECT doc_id, size, p, list_slice(w, p, p + size - 1) AS gram
    FROM (
        SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM d, (SELECT DISTINCT len(gram) AS size FROM windows) WHERE len(w) >= size
    )
), hits AS (
    SELECT doc_id, size, p, item_id FROM starts JOIN windows USING (gram)
), words AS (
    SELECT doc_id, count(DISTINCT p + step) AS n FROM hits, range(0, 10) AS r(step)
    WHERE step < size GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
    coalesce(sha, sha256('')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.contaminated(docs, items).drop("spans")


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = lm_scoring.text_scores(docs, remainder(10) == 0, result="scores")
    columns = "n_tokens n_known train_tokens base_score score".split()
    held_out = F.coalesce(remainder(10) == 0, F.lit(True)).alias("held_out")
    return scored.select("doc_id", held_out, *[f"scores.{c}" for c in columns])


@query(
    "op3_quality_rules",
    f"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), tokens AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), grams AS (
    SELECT doc_id, 3 AS width, p, word || ' ' || lead(word) OVER s || ' ' || lead(word, 2) OVER s
        AS gram
    FROM tokens WINDOW s AS (PARTITION BY doc_id ORDER BY p)
    UNION ALL
    SELECT doc_id, {quality_rules.MIN_REPEAT}, p, CASE WHEN count(*) OVER s = {quality_rules.MIN_REPEAT}
        THEN string_agg(word, ' ') OVER s END
    FROM tokens WINDOW s AS (PARTITION BY doc_id ORDER BY p
        ROWS BETWEEN CURRENT ROW AND {quality_rules.MIN_REPEAT - 1} FOLLOWING)
), short AS (
    SELECT doc_id, width, p
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, width, gram) AS n FROM grams
        WHERE gram IS NOT NULL)
    WHERE n > 1
), repeated AS (
    SELECT doc_id, width, p FROM short
    UNION ALL
    SELECT doc_id, {quality_rules.MAX_REPEAT + 1}, p
    FROM (
        SELECT doc_id, p, count(*) OVER (
            PARTITION BY doc_id, list_slice(w, p, p + {quality_rules.MAX_REPEAT})) AS n
        FROM short JOIN words USING (doc_id)
        WHERE width = {quality_rules.MIN_REPEAT} AND p + {quality_rules.MAX_REPEAT} <= len(w)
    ) WHERE n > 1
), spread AS (
    SELECT doc_id, width, count(DISTINCT p + step) AS n
    FROM repeated, range(0, {quality_rules.MAX_REPEAT + 1}) AS s(step)
    WHERE step < width
    GROUP BY doc_id, width
), lines AS (
    SELECT doc_id, sum(n - 1) AS n
    FROM (
        SELECT doc_id, line, count(*) AS n
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
        GROUP BY doc_id, line
    ) GROUP BY doc_id
), measured AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce((SELECT n FROM lines l WHERE l.doc_id = d.doc_id), 0)::BIGINT AS n_dup_lines,
        coalesce((SELECT n FROM spread s WHERE s.doc_id = d.doc_id AND width = 3), 0)
            AS n_repeat_words,
        coalesce((SELECT n FROM spread s WHERE s.doc_id = d.doc_id
            AND width = {quality_rules.MIN_REPEAT}), 0) AS n_covered,
        coalesce((SELECT n FROM spread s WHERE s.doc_id = d.doc_id
            AND width = {quality_rules.MAX_REPEAT + 1}), 0) AS n_long
    FROM words d
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND n_covered <= {quality_rules.MAX_COVERED} * n_words AND n_long = 0 AS kept
FROM measured
""",
)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    judged = quality_rules.quality(docs, result="quality")
    return judged.select("doc_id", *[f"quality.{c}" for c in columns])


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = substring_dedup.repeated_passages(docs, result="passages")
    return found.select("doc_id", *[f"passages.{c}" for c in ("n_words", "n_removed", "kept_sha256")])


@query("op5_near_dedup")
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query(
    "op6_token_counts",
    """
SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS document,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
FROM documents
""",
)
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    folder = token_counts.write_token_files(docs)
    return token_counts.documents_in(spark, folder).select("document", "n_tokens")


def _case(field: int) -> str:
    """The rules as a CASE expression, longest first; ``field`` 2 gives the verdict."""
    ordered = sorted(url_filters.RULES, key=lambda r: -len(r[0] + r[1]))
    whens = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
        f"THEN '{verdict if field == 2 else h + p}'"
        for h, p, verdict in ordered
    )
    return f"CASE {whens} END"


@query(
    "op7_url_filters",
    f"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://')
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), p AS (
    SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_A}', '{_Z}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
)
SELECT page_id, host, path, {_case(1)} AS rule,
    coalesce({_case(2)}, CASE WHEN list_has_any(regexp_split_to_array(host, '[.-]'),
        {list(url_filters.LISTED_TERMS)}) THEN 'block' ELSE 'allow' END) AS verdict
FROM p
""",
)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judged(table(spark, sf_dir, "pages", "page_id", "url"), result="judged")
    return judged.select("page_id", "judged.*")


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    named = language_id.languages(docs, remainder(4) != 2, result="language")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return named.select("doc_id", held_out, "language.*")


def captures(pages: DataFrame) -> DataFrame:
    """Web captures made of the pages, one a minute: a third are not-modified revisits.

    An entity tag names the page's path and a version that changes every 4000 captures; a third
    of the revisits have a date alone, as have some responses.
    """
    chance = F.col("page_id") * 7919 % 1009
    revisit = chance % 3 == 0
    version = F.floor(F.col("page_id") / 4000)
    resource = F.regexp_extract("url", r"://[^/]*/(\w*)", 1)
    tag = F.concat(F.lit('"'), F.md5(F.concat_ws(":", resource, version)), F.lit('"'))
    date = F.concat(F.lit("day "), version)
    empty = F.create_map().cast("map<string,string>")
    body = F.create_map(
        F.lit("content-type"),
        F.lit("text/html"),
        F.lit("content-length"),
        F.length("html").cast("string"),
    )
    always = F.create_map(
        F.lit("date"),
        F.col("page_id").cast("string"),
        F.lit("cache-control"),
        F.when(revisit, F.lit("max-age=60")).otherwise(F.lit("max-age=3600")),
    )
    wrong = F.create_map(F.lit("content-length"), F.lit("0"))
    return pages.select(
        F.col("page_id").alias("record_id"),
        F.col("url").alias("uri"),
        (F.col("page_id") * 60).alias("at"),
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(chance % 7 != 0, tag).alias("etag"),
        F.when(chance % 5 != 0, date).alias("last_modified"),
        F.map_concat(F.coalesce(F.when(revisit, wrong).otherwise(body), empty), always).alias("headers"),
    )


@query(
    "op9_warc_revisits",
    f"""
WITH base AS (
    SELECT page_id, length(html) AS size, page_id // 4000 AS version,
        page_id * 7919 % 1009 AS chance,
        regexp_extract(url, '://[^/]*/(\\w*)', 1) AS resource,
        regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#[\\s\\S]*$', '')
            AS rest
    FROM pages
), parts AS (
    SELECT *, regexp_replace(regexp_replace(
            translate(regexp_extract(rest, '^([^/?]*)', 1), '{_A}', '{_Z}'), '^www\\.', ''),
            ':(80|443)$', '') AS host,
        regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
        regexp_replace(regexp_replace(regexp_extract(rest, '\\?([\\s\\S]*)$', 1),
            '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
    FROM base
), records AS (
    SELECT page_id, size, host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END AS uri_key,
        CASE WHEN chance % 3 = 0 THEN 'revisit' ELSE 'response' END AS kind,
        CASE WHEN chance % 7 <> 0 THEN md5(resource || ':' || version) END AS tag,
        CASE WHEN chance % 5 <> 0 THEN version END AS day
    FROM parts
), placed AS (
    SELECT *, max(CASE WHEN kind = 'response' THEN page_id END) OVER (
        PARTITION BY uri_key ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ) AS earlier
    FROM records
), joined AS (
    SELECT p.*, CASE
            WHEN p.kind = 'response' THEN 'full'
            WHEN p.earlier IS NULL THEN 'no response'
            WHEN coalesce(p.tag = r.tag, p.day = r.day) IS NULL THEN 'unchecked'
            WHEN coalesce(p.tag = r.tag, p.day = r.day) THEN 'resolved'
            ELSE 'changed' END AS outcome,
        r.size AS stored_size
    FROM placed p LEFT JOIN records r ON r.page_id = p.earlier
)
SELECT page_id AS record_id, uri_key, kind, CASE WHEN outcome = 'resolved' THEN earlier END
        AS refers_to, outcome,
    concat_ws(chr(10),
        'cache-control: max-age=' || CASE kind WHEN 'revisit' THEN '60' ELSE '3600' END,
        'content-length: ' || CASE WHEN outcome = 'resolved' THEN stored_size
            WHEN kind = 'revisit' THEN 0 ELSE size END,
        CASE WHEN outcome IN ('resolved', 'full') THEN 'content-type: text/html' END,
        'date: ' || page_id) AS headers
FROM joined
""",
)
def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    found = warc.resolved(captures(pages))
    header = F.transform(
        F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"])
    )
    return found.withColumn("headers", F.array_join(header, "\n"))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.packed(docs, packing.word_count(F.col("text")))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns, and all conversations; see ``prefix_trie.prefix_trie``.

    A conversation is the first h turns of the one with its id cut to a multiple of five, then
    its own after the first h. Rows without an id are one conversation, of its own turns.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows, bounds = turns.placed(
        conversations,
        F.col("conv_id"),
        [F.col("turn")],
        [role, text],
        key=turns.content_key(role, text),
        weight=F.octet_length(text).cast("bigint"),
    )
    borrowed = F.coalesce(F.crc32(F.col("conv").cast("string")) % 9, F.lit(0))
    convs = bounds.withColumns({"h": borrowed, "base": F.col("conv") - F.col("conv") % 5})
    bases = bounds.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken).drop("n_base")
    placed = turns.with_bounds(rows, convs)
    placed = placed.withColumn("place", F.col(ROW) - F.col("first_row") + 1)
    own = placed.where("place > h").withColumn("depth", F.col("taken") + F.col("place") - F.col("h"))
    heads = placed.where("place <= 8 AND conv = base").select("base", "place", "key", "weight")
    lent = convs.where("h > 0").select("conv", "base", "h").join(heads, "base").where("place <= h")
    lent = lent.withColumn("depth", F.col("place"))
    columns = ("conv", "depth", "key", "weight")
    return own.select(*columns).unionByName(lent.select(*columns)), convs.select("conv")


@query(
    "op11_prefix_trie",
    f"""
WITH t AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
    FROM conversations GROUP BY conv_id
), c AS (
    SELECT *, coalesce({_crc32("conv_id::VARCHAR")} % 9, 0) AS h, conv_id - conv_id % 5 AS base FROM t
), rebuilt AS (
    SELECT c.conv_id, list_concat(CASE WHEN c.h > 0 THEN coalesce(list_slice(b.l, 1, c.h), []) ELSE [] END,
        list_slice(c.l, c.h + 1, len(c.l))) AS l
    FROM c LEFT JOIN t b ON b.conv_id = c.base
), members AS (
    SELECT conv_id, len(l) AS size, d, list_slice(l, 1, d) AS node
    FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS sha
    FROM members GROUP BY node, d
), children AS (
    SELECT list_slice(node, 1, d - 1) AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), valued AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children,
        CASE WHEN d > 0 THEN (n_convs - 1) * strlen(node[-1].x) ELSE 0 END AS own
    FROM nodes LEFT JOIN children USING (node)
), sums AS (
    SELECT list_slice(node, 1, up) AS node, sum((n_children = 0)::BIGINT) AS n_leaves, sum(own) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM valued) GROUP BY 1
)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
    n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, v.sha AS ends_sha256
FROM valued v JOIN sums USING (node)
LEFT JOIN nodes p ON v.d > 0 AND p.node = list_slice(v.node, 1, v.d - 1)
""",
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    trie = prefix_trie.prefix_trie(*rebuilt_turns(conversations))
    totals = prefix_trie.subtree_totals(
        trie.nodes,
        n_leaves=F.when(F.col("n_children") == 0, 1),
        saved_tokens=(F.col("n_convs") - 1) * F.col("weight"),
    )
    sums = prefix_trie.ends_sha256(trie.ends).withColumnRenamed("key", "node")
    found = trie.nodes.join(totals, "node").join(sums, "node", "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("bigint").alias("depth"),
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


@query("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    folder = token_files.write_token_table(docs, public_tokenizers.path("byte_bpe_50k.json"))
    found = token_files.read_token_table(spark, folder)
    found = found.select("row.doc_id", "start", "n_tokens", "ids")
    sums = "doc_id bigint, start bigint, n_tokens bigint, ids bigint"
    return found.mapInArrow(token_files.ids_crc32, sums).withColumnRenamed("ids", "ids_crc32")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by the hash of conversation and turn; nulls are one space."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    ids = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *ids)) % 20
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    changed = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
    rows = conversations.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        changed.otherwise(text).alias("text"),
        copies.alias("copy"),
    )
    return rows.drop("copy")


@query(
    "op13_structure_repair",
    f"""
WITH RECURSIVE hit AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS fault
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hit, range(0, 2) AS copies(k) WHERE fault <> 0 AND (k = 0 OR fault = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM damaged
), judged AS (
    SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (
            PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
        coalesce(lag(initial) OVER w || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY i)
), rows AS (
    SELECT *, NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') AS cut FROM judged
), sizes AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) AS n, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM rows GROUP BY conv_id
), inserted(state, middle, letters, spent, lines) AS (VALUES
    ('^', '^', '', 0, []), ('s', 's', '', 0, []), ('u', 'u', '', 0, []), ('a', 'a', '', 0, []),
    ('^', 'u', 'I', 2, ['user:']), ('s', 'u', 'I', 2, ['user:']), ('a', 'u', 'I', 2, ['user:']),
    ('u', 'a', 'I', 2, ['assistant:']), ('^', 'a', 'II', 4, ['user:', 'assistant:']),
    ('s', 'a', 'II', 4, ['user:', 'assistant:'])
), edits(middle, letter, next, needs, costs) AS (VALUES
    ('^', 'D', '^', NULL, 3), ('s', 'D', 's', NULL, 3), ('u', 'D', 'u', NULL, 3), ('a', 'D', 'a', NULL, 3),
    ('^', 'K', 's', 's', 0), ('^', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('a', 'K', 'u', 'u', 0),
    ('u', 'K', 'a', 'a', 0),
    ('^', 'R', 'u', NULL, 2), ('s', 'R', 'u', NULL, 2), ('a', 'R', 'u', NULL, 2), ('u', 'R', 'a', NULL, 2)
), ways AS (
    SELECT state, next, inserted.letters || letter AS letters, letter, spent + costs AS spent, needs, lines
    FROM inserted JOIN edits USING (middle)
), paths AS (
    SELECT conv_id, 0::BIGINT AS i, '^' AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS best
    FROM sizes
    UNION ALL
    SELECT p.conv_id, p.i + 1, next, min({{
        'cost': p.best.cost + spent + (letter <> 'D' AND cut)::BIGINT,
        'audit': p.best.audit || letters,
        'lines': list_concat(p.best.lines, list_concat(lines, CASE letter WHEN 'D' THEN []
            WHEN 'K' THEN [role || ':' || text]
            ELSE [CASE next WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] END))}})
    FROM paths p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
    JOIN ways w ON w.state = p.state AND (letter = 'D' OR NOT blank AND NOT duplicate)
        AND (needs IS NULL OR needs = initial)
    GROUP BY p.conv_id, p.i, next
), ended AS (
    SELECT s.conv_id, min({{'cost': best.cost + spent, 'audit': best.audit || letters,
        'lines': list_concat(best.lines, ins.lines)}}) AS best
    FROM sizes s JOIN paths p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.n
    JOIN inserted ins ON ins.state = p.state AND (ins.middle = 'a' OR p.state = '^' AND ins.middle = '^')
    GROUP BY s.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
""",
)
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    result = structure_repair.repaired(damaged(conversations))
    line = F.concat_ws(":", "role", "text").alias("line")
    lines = result.edits.where("edit <> 'D'").select("conv", "step", line)
    sums = turns.joined_sha256(lines, "conv", ["step"], "line", "\n")
    found = conversations.select("conv_id").distinct()
    for more, conv in ((result.summary, "conv"), (sums, "key")):
        more = more.withColumnRenamed(conv, "_conv")
        found = found.join(more, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = "gaps blank duplicate truncated illegal cost".split()
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
