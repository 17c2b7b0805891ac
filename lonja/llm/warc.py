"""Not-modified revisits of web captures, resolved to the full response they stand for.

A revisit record has no body. It refers to the latest earlier full response with the same
canonical URL, if their validators agree, and then stands for that response with the headers
that a not-modified answer may update. The as-of join runs in two steps, so that a URL with very
many captures is not one task: within a slice of time, and over the last response per slice.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Header fields that a not-modified answer never updates.
KEPT_HEADERS = (
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)

SLICE_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Key under which captures of one resource meet; null stays null.

    Without scheme, fragment, `www.`, default port, tracking parameters (`utm_...`), and a
    slash at the end of the path; A-Z of the host lower-cased.
    """
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"#[\s\S]*$", "")
    host = F.regexp_extract(rest, r"^([^/?]*)", 1)
    host = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?([\s\S]*)$", 1)
    query = F.regexp_replace(query, r"(^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, r"^&", "")
    return F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _agree(mine: Column, stored: Column) -> Column:
    """Whether the validators agree: entity tags without their weak mark, else dates."""
    tags = [F.regexp_replace(F.trim(x["etag"]), r"^W/", "") for x in (mine, stored)]
    dates = [F.trim(x["last_modified"]) for x in (mine, stored)]
    by_tag = F.when(tags[0].isNotNull() & tags[1].isNotNull(), tags[0] == tags[1])
    return F.coalesce(by_tag, dates[0] == dates[1])


def resolved(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """record_id, uri_key, kind, refers_to, outcome and headers of every row of ``records``.

    ``records`` has record_id, uri, at (seconds), kind (`response` or `revisit`), etag,
    last_modified and headers (a map with lower-case names); other columns are not read. Records
    of a URL are ordered by time, then record_id. ``outcome`` is `full` for a response; of a
    revisit it is `resolved`, `no response` if none is earlier, `changed` if the validators
    differ, `unchecked` if they share none. Only a resolved revisit has ``refers_to``, and the
    response's headers updated by its own permitted ones; any other row keeps its headers. A
    null uri or time is never joined, other kinds are answered `ignored`, null headers are
    empty. Repeated rows are answered alike.
    """
    state = F.struct("record_id", "etag", "last_modified", "headers")
    usable = F.col("uri_key").isNotNull() & F.col("at").isNotNull()
    rows = records.select(
        "record_id",
        canonical_url(F.col("uri")).alias("uri_key"),
        F.col("at").cast("bigint").alias("at"),
        "kind",
        "etag",
        "last_modified",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
    )
    rows = rows.withColumn("slice", F.floor(F.col("at") / slice_seconds))
    # Records that can't be joined are dealt out by themselves.
    rows = rows.withColumn("alone", F.when(~usable, F.xxhash64("record_id", "uri_key", "at")))
    full = F.when((F.col("kind") == "response") & usable, state)
    keys = ["uri_key", "slice", "alone"]
    before = Window.partitionBy(*keys).orderBy("at", "record_id")
    near = F.last(full, True).over(before.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("near", F.when(usable, near))

    per_slice = rows.where(usable).groupBy("uri_key", "slice").agg(
        F.max_by(full, F.when(full.isNotNull(), F.struct("at", "record_id"))).alias("newest")
    )
    earlier = Window.partitionBy("uri_key").orderBy("slice")
    carried = F.last("newest", True).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    per_slice = per_slice.select("uri_key", "slice", carried.alias("far"))
    per_slice = per_slice.where("far IS NOT NULL")
    joined = rows.join(per_slice, ["uri_key", "slice"], "left")

    stored = F.coalesce("near", "far")
    agree = _agree(F.struct("etag", "last_modified"), stored)
    outcome = (
        F.when(F.col("kind") == "response", "full")
        .when(F.coalesce(F.col("kind") != "revisit", F.lit(True)), "ignored")
        .when(stored.isNull(), "no response")
        .when(agree.isNull(), "unchecked")
        .when(agree, "resolved")
        .otherwise("changed")
    )
    out = joined.withColumn("stored", stored).withColumn("outcome", outcome)
    kept = F.array(*[F.lit(h) for h in KEPT_HEADERS])
    updates = F.map_filter("headers", lambda k, v: ~F.array_contains(kept, k))
    others = F.map_filter("stored.headers", lambda k, v: ~F.map_contains_key(updates, k))
    merged = F.when(F.col("outcome") == "resolved", F.map_concat(others, updates))
    return out.select(
        "record_id",
        "uri_key",
        "kind",
        F.when(F.col("outcome") == "resolved", F.col("stored.record_id")).alias("refers_to"),
        "outcome",
        F.coalesce(merged, "headers").alias("headers"),
    )
