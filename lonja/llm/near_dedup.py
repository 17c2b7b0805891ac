"""Near-duplicate classes by a signature-coordinate inverted join.

A document's set of word shingles has a MinHash signature; each coordinate and its value is a
posting. Documents with equal sets are one class from the start. Postings that no other class
shares are skipped, the rest of a class are ordered from rare to frequent, and only the prefix
without which ``matches`` collisions are impossible is merged. Collisions of a candidate pair
are counted on the signatures; pairs above the match threshold are confirmed on full sets.

A posting list never emits all its pairs. Its members are first compared with its hub, the
member with the most common coordinate values. Members outside the hub's component are then
compared with the others, unless what both share with the hub proves that they can't link: they
have at most the hub's shingles in common, less those that one of them lacks, and those outside
the hub that each shares with anyone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.llm.texts import (
    LOWER,
    binary,
    free_name,
    mix,
    small_batches,
    window_hashes,
    word_hashes,
)
from lonja.sources.staging import stage

WIDTH = 5
PERCENT = 75

# At similarity 0.75, fewer than 20 of 48 coordinates agree once in about three million pairs.
COORDINATES = 48
MATCHES = 20

_SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, keys array<bigint>"
_CONFIRMED = (
    "x bigint, y bigint, n_common bigint, n_x bigint, n_y bigint, linked boolean, "
    "missing array<int>, extra array<bigint>"
)

# Shingles that a member lacks of its hub are counted in so many parts.
PARTS = 64


def shingle_sets(texts: Sequence[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles; a shorter text is one shingle."""
    words, counts = word_hashes([t.translate(LOWER) for t in texts])
    windows = window_hashes(words, width)
    found, start = [], 0
    for n in counts.tolist():
        own = window_hashes(words[start : start + n], n) if 0 < n < width else None
        if own is None:
            own = windows[start : start + max(0, n - width + 1)]
        found.append(np.unique(own))
        start += n
    return found


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """One key per coordinate: the coordinate and its least value, mixed into 64 bits."""
    factors = mix(np.arange(1, coordinates + 1, dtype=np.uint64)) | np.uint64(1)
    least = np.full(coordinates, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 4096):
        np.minimum(least, (shingles[at : at + 4096, None] * factors).min(axis=0), out=least)
    return mix(least + np.arange(coordinates, dtype=np.uint64) * factors).view(np.int64)


def _number(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _signer(width: int, coordinates: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), width)
            nodes = [_number(s) if len(s) else None for s in sets]
            keys = [signature(s, coordinates) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n_shingles", "node", "keys"],
            )

    return sign


def _confirmer(width: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            xs = batch.column("x").to_pylist()
            ys = batch.column("y").to_pylist()
            sets = shingle_sets(batch.column("text_x").to_pylist(), width)
            texts = batch.column("text_y")
            rows: list[tuple] = []
            for i, (x, y, own) in enumerate(zip(xs, ys, sets, strict=True)):
                if y != last:
                    last, hub = y, shingle_sets([texts[i].as_py()], width)[0]
                at = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                inside = hub[at] == own
                common = int(inside.sum())
                linked = 100 * common >= percent * (len(own) + len(hub) - common)
                lost = np.setdiff1d(hub, own[inside], assume_unique=True) % np.uint64(PARTS)
                missing = np.bincount(lost.astype(np.int64), minlength=PARTS).astype(np.int32)
                extra = own[~inside].view(np.int64)
                rows.append((x, y, common, len(own), len(hub), linked, missing, extra))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            names = ["x", "y", "n_common", "n_x", "n_y", "linked", "missing", "extra"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names
            )

    return confirm


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node reachable, of every node of edges (x, y).

    Alternates large-star and small-star steps, each a minimum per node and a join, until all
    edges form stars; the number of rounds grows with the logarithm of the longest path. Edges
    are written after every round. Loops, repeated edges and no edges at all are fine.
    """
    now = edges.where("x <> y").select(
        F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")
    )
    now = stage(now.distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), "m").distinct()
        lower = large.groupBy("u").agg(F.min("m").alias("least"))
        small = large.join(lower, "u").select(
            F.when(F.col("m") == F.col("least"), F.col("u")).otherwise(F.col("m")).alias("u"),
            F.col("least").alias("v"),
        )
        now = stage(small.distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either a root or has one edge, to a root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"))
    ends = ends.union(edges.select("v", F.lit(0)))
    outs = ends.groupBy("node").agg(F.sum("out").alias("outs"), F.min("out").alias("least"))
    return outs.where("outs > 1 OR (outs = 1 AND least = 0)").isEmpty()


def _confirm(pairs: DataFrame, keys: DataFrame, texts: DataFrame, settings: dict) -> DataFrame:
    """Candidate pairs (x, y) with enough collisions, compared on their full sets."""
    mine = keys.select(F.col("node").alias("x"), F.col("keys").alias("keys_x"))
    theirs = keys.select(F.col("node").alias("y"), F.col("keys").alias("keys_y"))
    collide = F.size(F.array_intersect("keys_x", "keys_y")) >= settings["matches"]
    chosen = pairs.join(mine, "x").join(theirs, "y").where(collide).select("x", "y")
    mine = texts.select(F.col("node").alias("x"), F.col("text").alias("text_x"))
    theirs = texts.select(F.col("node").alias("y"), F.col("text").alias("text_y"))
    both = chosen.join(mine, "x").join(theirs, "y").select("x", "y", "text_x", "text_y")
    confirm = _confirmer(settings["width"], settings["percent"])
    return stage(both.mapInArrow(confirm, _CONFIRMED), "confirmed")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    width: int = WIDTH,
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Rows link when 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the least doc_id reachable over links, and the row that bears it is
    kept. A text without words links with nothing and is kept. Rows with equal doc_id and text
    share their result. A null doc_id never names a component: its row is kept only where no
    linked row has an id. Tables are written while this runs; the result reads them.
    """
    settings = {"width": width, "percent": percent, "matches": matches}
    small_batches(docs, 256)
    source = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), binary(text).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    signed = stage(source.mapInArrow(_signer(width, coordinates), _SIGNED), "signed")
    members = signed.select("doc_id", "n_shingles", "node")

    # One class per set; its postings, without the lists that hold one class only.
    classes = signed.where("node IS NOT NULL").groupBy("node")
    keys = classes.agg(F.first("keys").alias("keys"))
    posts = keys.select("node", F.explode("keys").alias("key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    live = stage(posts.join(shared, "key"), "postings")

    # From rare to frequent, as many as hold one of any ``matches`` collisions.
    per_node = live.groupBy("node").agg(F.count("*").alias("m"), F.sum("n").alias("weight"))
    per_node = per_node.where(F.col("m") >= matches)
    rank = F.expr("row_number() OVER (PARTITION BY node ORDER BY n, key)")
    prefix = live.join(per_node, "node").withColumn("rank", rank)
    prefix = prefix.where(F.col("rank") <= F.col("m") - matches + 1).select("node", "key", "weight")
    hubs = prefix.groupBy("key").agg(
        F.max(F.struct("weight", "node")).alias("hub"), F.count("*").alias("n")
    )
    hubs = hubs.where("n > 1").select("key", F.col("hub.node").alias("hub"))
    merged = stage(prefix.join(hubs, "key").select("key", "node", "hub"), "merged")
    candidates = merged.select("node").distinct()
    keys = keys.join(candidates, "node")
    row = F.min(F.struct("doc_id", "text_hash")).alias("row")
    chosen = signed.join(candidates, "node").groupBy("node").agg(row).select("node", "row.*")
    texts = stage(_texts(source, chosen, width), "texts")
    keys = stage(keys, "keys")

    with_hub = merged.where("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y"))
    first = _confirm(with_hub.distinct(), keys, texts, settings)
    linked = first.where("linked").select("x", "y")
    label = stage(components(linked), "components")

    rest = stage(_unproved(merged, first, label, keys, settings), "unproved")
    second = _confirm(rest, keys, texts, settings).where("linked").select("x", "y")
    if not second.isEmpty():
        known = label.select(F.col("node").alias("x"), F.col("component").alias("y"))
        label = components(known.union(second))

    named = members.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = named.join(label, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component")
    )
    leaders = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(leaders, "component").select("node", "component_id")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = members.join(named, "node", "left").withColumn("component_id", own)
    same = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return found.select("doc_id", "n_shingles", "component_id", same.alias("kept"))


def _texts(source: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """node and text of each candidate class, read from one of its documents.

    A document is found by its id and the hash of its text, so that rows without an id, or with
    the same one, meet only where their texts are equal too.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = shingle_sets(texts, width)
            # Unlike texts may have one hash.
            nodes = batch.column("node").to_pylist()
            own = [len(s) > 0 and _number(s) == n for s, n in zip(sets, nodes, strict=True)]
            yield batch.filter(pa.array(own, pa.bool_()))

    same = source["doc_id"].eqNullSafe(chosen["doc_id"]) & (source["text_hash"] == chosen["text_hash"])
    picked = source.join(chosen, same).select("node", "text")
    rows = picked.mapInArrow(pick, "node bigint, text binary")
    return rows.groupBy("node").agg(F.first("text").alias("text"))


def _unproved(
    merged: DataFrame, first: DataFrame, label: DataFrame, keys: DataFrame, settings: dict
) -> DataFrame:
    """Pairs of a list in different components that their hub doesn't rule out."""
    label = label.select("node", "component")
    hub_label = label.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))

    def placed(rows: DataFrame) -> DataFrame:
        return (
            rows.join(label, "node", "left")
            .join(hub_label, "hub", "left")
            .withColumn("component", F.coalesce("component", "node"))
            .withColumn("hub_component", F.coalesce("hub_component", "hub"))
        )

    apart = F.col("x.component") != F.col("y.component")
    outer = F.col("y.component") == F.col("y.hub_component")
    once = outer | (F.col("x.node") < F.col("y.node"))

    # Members whose relation to the hub is known meet once per hub, whatever lists they share.
    known = stage(placed(_relation(first)), "relations")
    x, y = known.where("component <> hub_component").alias("x"), known.alias("y")
    outside = F.least("x.core", "y.core") + F.least("x.s", "y.s")
    sizes = F.col("x.n") + F.col("y.n")
    percent = settings["percent"]

    def possible(inside: Column) -> Column:
        return F.lit(100) * (inside + outside) >= F.lit(percent) * (sizes - inside - outside)

    lacking = F.zip_with("x.missing", "y.missing", lambda p, q: F.greatest(p, q))
    inside = F.col("x.n_hub") - F.aggregate(lacking, F.lit(0), lambda n, p: n + p)
    bound = possible(F.least("x.a", "y.a")) & possible(inside)
    by_hub = x.join(y, (F.col("x.hub") == F.col("y.hub")) & apart & once & bound)

    # Others collide with the hub too seldom to have been compared with it.
    compared = first.select(F.col("x").alias("node"), F.col("y").alias("hub"))
    merged = merged.where("node <> hub")
    others = merged.join(compared, ["node", "hub"], "left_anti").select("key").distinct()
    members = merged.join(others, "key").join(
        compared.withColumn("known", F.lit(True)), ["node", "hub"], "left"
    )
    members = placed(members).join(keys, "node")
    x, y = members.where("component <> hub_component").alias("x"), members.alias("y")
    either = F.col("x.known").isNull() | F.col("y.known").isNull()
    collide = F.size(F.array_intersect("x.keys", "y.keys")) >= settings["matches"]
    by_key = x.join(y, (F.col("x.key") == F.col("y.key")) & apart & once & either & collide)

    pair = F.least("x.node", "y.node").alias("x"), F.greatest("x.node", "y.node").alias("y")
    return by_hub.select(*pair).union(by_key.select(*pair)).distinct()


def _relation(first: DataFrame) -> DataFrame:
    """What each compared member shares with a hub that has an unlinked member.

    node, hub, their sizes n and n_hub, a common shingles, missing ones by part, and of those
    outside the hub ``core`` that most members have and ``s`` others that another member has.
    """
    hubs = first.groupBy(F.col("y").alias("hub")).agg(
        F.count("*").alias("members"), F.count_if(~F.col("linked")).alias("unlinked")
    )
    hubs = hubs.where("unlinked > 0").select("hub", "members")
    pairs = first.selectExpr(
        "x AS node", "y AS hub", "n_common AS a", "n_x AS n", "n_y AS n_hub", "missing", "extra"
    ).join(hubs, "hub")
    extra = pairs.select("node", "hub", "members", F.explode("extra").alias("shingle"))
    found = extra.groupBy("hub", "shingle").agg(
        F.count("*").alias("finds"), F.first("members").alias("members")
    )
    found = found.where("finds > 1").selectExpr("hub", "shingle", "2 * finds > members AS most")
    shared = extra.join(found, ["hub", "shingle"]).groupBy("node", "hub")
    shared = shared.agg(F.count_if("most").alias("core"), F.count_if(~F.col("most")).alias("s"))
    rows = pairs.drop("extra", "members").join(shared, ["node", "hub"], "left")
    return rows.na.fill(0, ["core", "s"])


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component of near duplicates; rows without words all stay.

    The row of the least doc_id stays, one without an id only where no linked row has an id, and
    of rows with equal ids or none the first as written. Rows are told apart by a number that is
    written with them first, so ids may be missing or repeated.
    """
    number = free_name(docs, "_row")
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows, doc_id=number).select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select(F.col(number).alias("row"), F.col("doc_id").alias("id"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    first = found.join(ids, "row").groupBy("component_id").agg(F.min(place).alias("first"))
    gone = found.join(first.select("first.row"), "row", "left_anti")
    gone = gone.select(F.col("row").alias("_gone"))
    return rows.join(gone, rows[number] == gone["_gone"], "left_anti").drop(number)
