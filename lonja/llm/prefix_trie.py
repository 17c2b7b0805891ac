"""The trie of conversation prefixes, and totals over all its subtrees by tree contraction.

Every distinct sequence of first turns is a node. Totals come from parallel tree contraction:
each round rakes the leaves into their parents and compresses unary chains by taking out nodes
that are no neighbours of each other, so a tree of any shape, a single chain too, is gone after
a number of rounds that grows with the logarithm of its size. Nodes that were taken out then get
their totals back through pointers that double their reach.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lonja.llm.turns import KEY_LIST, joined_sha256, prefix_keys
from lonja.session import shared_folder
from lonja.sources.staging import stage

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@dataclass
class Trie:
    """``nodes``: node, parent, depth, conv, parent_conv, n_convs, n_children, weight;
    ``ends``: conv and the node of its last turn, the root for one without turns."""

    nodes: DataFrame
    ends: DataFrame


def prefix_trie(turns: DataFrame, convs: DataFrame) -> Trie:
    """The trie of the conversations ``convs`` (``conv``) and their ``turns``.

    ``turns`` has ``conv``, ``depth`` (1, 2, ... without gaps), ``key`` (``content_key`` of what
    makes two turns equal, 128 bits) and ``weight``. A node's ``conv`` is its smallest member,
    ``n_convs`` their number, ``weight`` that of its last turn (the root's is null). Conversations
    without turns are members of the root alone. A null id is a member like others, but not the
    smallest one where there is another. No conversations make no nodes. Both frames are written and read back.
    """
    seen = Observation()
    counted = turns.observe(seen, F.max("depth").alias("longest"))
    staged = stage(counted.select("conv", "depth", "key", "weight"), "rebuilt")
    paths = prefix_keys(staged, seen.get.get("longest") or 1)
    paths = paths.select("conv", "depth", "node", "parent", "weight")
    roots = convs.select(
        "conv",
        F.lit(0).cast(paths.schema["depth"].dataType).alias("depth"),
        F.struct(*[F.lit(0).cast("bigint").alias(x) for x in "ab"]).alias("node"),
        F.lit(None).cast(paths.schema["parent"].dataType).alias("parent"),
        F.lit(None).cast(paths.schema["weight"].dataType).alias("weight"),
    )
    paths = stage(paths.unionByName(roots), "paths")
    ends = paths.groupBy("conv").agg(F.max_by("node", "depth").alias("node"))
    made = paths.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("weight").alias("weight"),
    )
    named = stage(made, "nodes")
    children = named.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    n_children = F.coalesce(F.col("n_children"), F.lit(0)).alias("n_children")
    counts = children.agg(F.count(F.lit(1)).alias("n_children"))
    # Many nodes may have one parent; adaptive execution splits that side of the join.
    parents = named.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    nodes = named.join(counts, "node", "left").join(parents, "parent", "left")
    return Trie(stage(nodes.select(*named.columns, n_children, "parent_conv"), "trie"), ends)


def subtree_totals(tree: DataFrame, **values: Column) -> DataFrame:
    """``node`` and, by its name, the sum of every long value over the node's whole subtree.

    ``tree`` has ``node`` (a struct of longs ``a`` and ``b``, distinct and not null) and
    ``parent`` (null, or unknown, for a root); it may hold many trees. Null values count as 0.
    A cycle is an error. Every round is written to the shared folder and read by the next.
    """
    spark = tree.sparkSession
    names = list(values)
    folder = f"{shared_folder(spark)}/contraction/{uuid4().hex}"
    kids = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    first = tree.join(kids.agg(F.count(F.lit(1)).alias("kids")), "node", "left").select(
        "node",
        "parent",
        F.coalesce("kids", F.lit(0)).alias("kids"),
        *[F.coalesce(v.cast("bigint"), F.lit(0)).alias(n) for n, v in values.items()],
        # What was taken out between a node and its parent.
        *[F.lit(0).cast("bigint").alias(f"edge_{n}") for n in names],
    )
    live = stage(first, "tree")
    schema, rounds, left = None, 0, -1
    while left != 0:
        seen = Observation()
        done = _contracted(live, names, rounds).observe(
            seen,
            F.count_if(F.col("state") == "live").alias("live"),
            F.count_if(F.col("state") == "raked").alias("raked"),
        )
        schema = done.schema
        done.write.parquet(f"{folder}/round={rounds}")
        left, raked = (seen.get.get(state, 0) for state in ("live", "raked"))
        if left and not raked:
            raise ValueError("the tree has a cycle")
        live = spark.read.schema(schema).parquet(f"{folder}/round={rounds}").where("state = 'live'")
        rounds += 1
    every = spark.read.schema(schema).parquet(*[f"{folder}/round={i}" for i in range(rounds)])
    return _expanded(every, names, rounds)


def _contracted(live: DataFrame, names: list[str], number: int) -> DataFrame:
    """One round. State ``raked``: values are the subtree's. State ``spliced``: taken out of a chain.

    A node whose upper neighbour was taken out names it in ``gone``; ``add_`` columns hold what
    that one's subtree has above this node's own.
    """
    leaf = F.col("kids") == 0
    sums = [F.sum(F.when(leaf, F.col(n) + F.col(f"edge_{n}")).otherwise(0)).alias(f"up_{n}") for n in names]
    below = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    below = below.agg(
        *sums, F.count_if(leaf).alias("n_raked"), F.max(F.when(~leaf, F.col("node"))).alias("heir")
    )

    def priority(node: str) -> Column:
        return F.xxhash64(F.lit(number), F.col(f"{node}.a"), F.col(f"{node}.b"))

    rest = F.col("kids") - F.coalesce("n_raked", F.lit(0))
    # A node goes only if its hash is below its neighbours', so that neither of them goes too.
    goes = (rest == 1) & (priority("node") < priority("heir")) & (priority("node") < priority("parent"))
    state = F.when(leaf, "raked").when(F.col("parent").isNotNull() & goes, "spliced").otherwise("live")
    merged = live.join(below, "node", "left").select(
        "node",
        "parent",
        rest.alias("kids"),
        *[(F.col(n) + F.coalesce(f"up_{n}", F.lit(0))).alias(n) for n in names],
        *[f"edge_{n}" for n in names],
        "heir",
        state.alias("state"),
    )
    taken = merged.where("state = 'spliced'").select(
        F.col("heir").alias("node"),
        F.col("node").alias("gone"),
        F.col("parent").alias("over"),
        *[F.col(n).alias(f"own_{n}") for n in names],
        *[F.col(f"edge_{n}").alias(f"above_{n}") for n in names],
    )
    add = [(F.col(f"edge_{n}") + F.col(f"own_{n}")).alias(f"add_{n}") for n in names]
    edge = [
        F.coalesce(F.col(f"edge_{n}") + F.col(f"own_{n}") + F.col(f"above_{n}"), F.col(f"edge_{n}"))
        for n in names
    ]
    return merged.join(taken, "node", "left").select(
        "node",
        F.coalesce("over", "parent").alias("parent"),
        "kids",
        *names,
        *[e.alias(f"edge_{n}") for n, e in zip(names, edge, strict=True)],
        "state",
        "gone",
        *add,
    )


def _expanded(every: DataFrame, names: list[str], rounds: int) -> DataFrame:
    raked = every.where("state = 'raked'").select("node", *names)
    adds = [f"add_{n}" for n in names]
    # Each node taken out points at a node that went in a later round.
    pointers = every.where("gone IS NOT NULL").select(F.col("gone"), F.col("node").alias("to"), *adds)
    for _ in range(math.ceil(math.log2(max(rounds, 1)))):
        far = pointers.select(
            F.col("gone").alias("to"), F.col("to").alias("far"), *[F.col(a).alias(f"far_{a}") for a in adds]
        )
        longer = pointers.join(far, "to", "left").select(
            "gone",
            F.coalesce("far", "to").alias("to"),
            *[(F.col(a) + F.coalesce(f"far_{a}", F.lit(0))).alias(a) for a in adds],
        )
        pointers = stage(longer, "pointers")
    known = raked.withColumnRenamed("node", "to")
    back = pointers.join(known, "to").select(
        F.col("gone").alias("node"), *[(F.col(n) + F.col(f"add_{n}")).alias(n) for n in names]
    )
    return raked.unionByName(back)


def ends_sha256(ends: DataFrame) -> DataFrame:
    """``key`` (a node) and the hash of its ending conversations' ids, ascending, comma-joined.

    Ids are integers; a null id is left out. Ids are first joined in lists of ``KEY_LIST`` at most.
    """
    bucket = F.floor(F.col("conv") / KEY_LIST).alias("bucket")
    lists = ends.where("conv IS NOT NULL").groupBy("node", bucket)
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    return joined_sha256(lists.agg(F.array_join(ids, ",").alias("ids")), "node", ["bucket"], "ids", ",")
