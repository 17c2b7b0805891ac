"""URL verdicts by host and path rules, then by a Bloom filter cascade over hosts.

The first level of the cascade holds the listed keys. The second holds the keys of the corpus
that the first takes for listed by mistake, the third the listed keys that the second takes
for these, and so on until a level makes no mistake. Over all keys of the corpus the first level
that lacks a key decides exactly, and rows are judged by looking at bits, without a join.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.sources.staging import stage

# Fixed values: (host, path, verdict); a rule also fits all subdomains of its host.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

# A host with one of these between dots and hyphens is listed.
LISTED_TERMS = ("adult", "ads", "bets", "casino", "pills", "spam")

BITS_PER_KEY = 8
HASHES = 5

# Bits of all levels of one cascade; more keys are dealt out over several cascades.
CASCADE_BITS = 1 << 28


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as `host/path`, else null; and its verdict."""
    chosen = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found) if chosen is None else chosen.when(fits, found)
    nothing = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return nothing if chosen is None else chosen


def _places(key: Column, level: int, size: int) -> list[Column]:
    return [
        F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(size).cast("bigint"))
        for i in range(HASHES)
    ]


class Level:
    """One Bloom filter: its number, its bits in use, and the bits in 64-bit words."""

    def __init__(self, keys: DataFrame, key: str, number: int, count: int) -> None:
        self.number = number
        self.size = 64 * max(1, math.ceil(count * BITS_PER_KEY / 64))
        spots = keys.select(F.explode(F.array(*_places(F.col(key), number, self.size))).alias("p"))
        one, spot = F.lit(1).cast("bigint"), F.pmod("p", F.lit(64)).cast("int")
        bit = F.call_function("shiftleft", one, spot)
        words = spots.groupBy(F.shiftright("p", 6).cast("int").alias("word"))
        self.words = np.zeros(self.size // 64, dtype=np.int64)
        for row in words.agg(F.bit_or(bit).alias("bits")).toLocalIterator():
            self.words[row["word"]] = row["bits"]

    def has(self, key: Column) -> Column:
        words = F.lit(self.words)
        every = F.lit(True)
        for place in _places(key, self.number, self.size):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            moved = F.call_function("shiftright", word, F.pmod(place, F.lit(64)).cast("int"))
            every = every & (moved.bitwiseAND(F.lit(1)) == 1)
        return every


class Cascade:
    """Exact membership in ``listed`` for every key of ``others`` and ``listed``.

    Both are single-column frames of distinct keys without a common one. Keys of neither are
    answered too, but may be wrong; null is no member.
    """

    def __init__(self, listed: DataFrame, others: DataFrame, key: str) -> None:
        self.levels: list[Level] = []
        inside, outside = listed, others
        while count := inside.count():
            level = Level(inside, key, len(self.levels), count)
            self.levels.append(level)
            mistaken = stage(outside.where(level.has(F.col(key))), "mistaken")
            inside, outside = mistaken, inside

    def member(self, key: Column) -> Column:
        verdict = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            verdict = F.when(level.has(key), verdict).otherwise(F.lit(level.number % 2 == 1))
        return F.coalesce(verdict, F.lit(False))


def listed_hosts(hosts: DataFrame, terms: Sequence[str] = LISTED_TERMS) -> DataFrame:
    """The hosts with a listed term between dots and hyphens."""
    parts = F.split("host", "[.-]")
    return hosts.where(F.arrays_overlap(parts, F.array(*[F.lit(t) for t in terms])))


def judged(
    pages: DataFrame,
    listed: DataFrame | None = None,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    result: str = "judged",
    cascade_bits: int = CASCADE_BITS,
) -> DataFrame:
    """All rows of ``pages`` with a struct ``result``: host, path, rule, verdict.

    The longest fitting rule decides; without one a listed host is blocked and any other is
    allowed. ``listed`` has a column ``host``; by default it is derived from the pages' hosts.
    The key universe is every host of ``pages``. A null url or one without `://` has an empty
    host and path and is allowed unless the empty host is listed. Repeated rows and listed hosts
    are fine, null ones are passed over. A list too long for one cascade is dealt out by hash,
    and each part of the rows is judged by its own. Other columns pass through; ``result`` must
    be free. The distinct hosts are written first.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    universe = stage(pages.select(host.alias("host")).distinct(), "hosts")
    if listed is None:
        listed = listed_hosts(universe)
    listed = stage(listed.where("host IS NOT NULL").select("host").distinct(), "listed")
    others = universe.join(listed, "host", "left_anti")
    parts = max(1, math.ceil(listed.count() * BITS_PER_KEY / cascade_bits))

    def part_of(key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))

    chosen = rule_of(host, path, rules)
    rows = None
    for part in range(parts):
        mine = part_of(F.col("host")) == part
        cascade = Cascade(listed.where(mine), others.where(mine), "host")
        own = F.when(cascade.member(host), "block").otherwise("allow")
        verdict = F.coalesce(chosen["verdict"], own)
        fields = F.struct(
            host.alias("host"),
            path.alias("path"),
            chosen["rule"].alias("rule"),
            verdict.alias("verdict"),
        )
        these = pages if parts == 1 else pages.where(part_of(host) == part)
        these = these.withColumn(result, fields)
        rows = these if rows is None else rows.unionAll(these)
    return rows
