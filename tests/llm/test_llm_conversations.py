"""Prefix trie, tree contraction and structure repair against brute force."""

import random
from collections import Counter

import conversation_brute as brute
import pytest
from pyspark.sql import functions as F

from lonja.llm import prefix_trie, queries, structure_repair, survivors, turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def write(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def found(df):
    return Counter(tuple(r) for r in df.collect())


def conversations(seed=3):
    """Shared beginnings, one very long conversation, nulls everywhere, ties and equal rows."""
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "Ünï. ", "x" * 30_000 + "."]
    rows = []
    for c in range(60):
        for t in range(rng.randint(0, 9)):
            role = ("user", "assistant")[t % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((c, t if rng.random() < 0.9 else None, role, rng.choice(texts)))
    rows += [(7, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(150)]
    rows += [(61, t, "user", f"turn {t}") for t in range(70)]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in range(5)]
    rows += [(70, None, "user", "Yes.")] * 3 + [(71, 1, "user", "b."), (71, 1, "user", "a."), (71, 1, "assistant", "a.")]
    rows += [(75 + i, t, "user", "Same.") for i in range(40) for t in range(3)]
    rows += [(-3, 0, "user", "Below zero."), (-5, -2, "user", "Below zero."), (-5, 10, "assistant", "So.")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return conversations()


def test_prefix_trie(spark, rows, tmp_path):
    # Division of negative ids goes toward zero in Spark, downward in Python.
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    assert found(queries.QUERIES["op11_prefix_trie"](spark, write(spark, tmp_path, rows))) == Counter(brute.trie(rows))


def test_prefixes_in_many_levels(spark, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(turns, "SCAN_WIDTH", 4)
    monkeypatch.setattr(turns, "JOIN_BLOCK", 8)
    monkeypatch.setattr(prefix_trie, "KEY_LIST", 3)
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    assert found(queries.QUERIES["op11_prefix_trie"](spark, write(spark, tmp_path, rows))) == Counter(brute.trie(rows))


def tree_frame(spark, parents):
    data = [((i, i), None if p is None else (p, p), i) for i, p in parents.items()]
    return spark.createDataFrame(
        data, "node struct<a: bigint, b: bigint>, parent struct<a: bigint, b: bigint>, own bigint"
    )


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest"])
def test_subtree_totals(spark, shape):
    rng = random.Random(4)
    parents = {
        "chain": {i: i - 1 if i else None for i in range(120)},
        "star": {i: 0 if i else None for i in range(120)},
        "random": {i: rng.randrange(max(0, i - 6), i) if i else None for i in range(120)},
        "forest": {i: rng.randrange(i) if i % 10 else None for i in range(120)},
    }[shape]
    expected, leaf = dict.fromkeys(parents, 0), set(parents) - set(parents.values())
    leaves = dict.fromkeys(parents, 0)
    for i in parents:
        at = i
        while at is not None:
            expected[at] += i
            leaves[at] += i in leaf
            at = parents[at]
    one = F.when(F.col("own").isin(*leaf), 1)
    got = prefix_trie.subtree_totals(tree_frame(spark, parents), total=F.col("own"), n=one).collect()
    assert sorted((r.node.a, r.total, r.n) for r in got) == [(i, expected[i], leaves[i]) for i in parents]


def test_a_cycle_is_an_error(spark):
    with pytest.raises(ValueError, match="cycle"):
        prefix_trie.subtree_totals(tree_frame(spark, {0: 1, 1: 2, 2: 0, 3: 2}), total=F.col("own"))


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_structure_repair"])
def test_no_conversations(spark, name, tmp_path):
    assert queries.QUERIES[name](spark, write(spark, tmp_path, [])).count() == 0


def test_repair_of_damaged_conversations(spark, rows, tmp_path):
    made = brute.repairs(brute.damaged(rows))
    none = (0, 0, 0, 0, 0, 0, "", prefix_trie.EMPTY_SHA256)
    expected = Counter((c, *made.get(c, none)) for c in {r[0] for r in rows})
    assert found(queries.QUERIES["op13_structure_repair"](spark, write(spark, tmp_path, rows))) == expected


@pytest.mark.parametrize("block", [1, 3])
def test_repair_in_blocks(spark, rows, block, monkeypatch):
    """Conversations cut into blocks of a few turns, with other columns and names."""
    monkeypatch.setattr(structure_repair, "BLOCK_TURNS", block)
    rows = [r for r in rows if None not in r]
    df = frame(spark, rows).toDF("first_row", "block", "letters", "conv").withColumn("codes", F.lit(1))
    result = structure_repair.repaired(df, "first_row", "block", "letters", "conv")
    expected = brute.repairs(rows)
    summary = {r.conv: r for r in result.summary.collect()}
    assert set(summary) == set(expected)
    fields = "gaps blank duplicate truncated illegal cost audit".split()
    assert {c: tuple(r[f] for f in fields) for c, r in summary.items()} == {c: e[:-1] for c, e in expected.items()}
    lists = brute.by_conversation(rows)
    edits = {}
    for r in result.edits.orderBy("conv", "step").collect():
        edits.setdefault(r.conv, []).append((r.edit, r.role, r.text))
    for c, held in lists.items():
        assert "".join(e[0] for e in edits[c]) == summary[c].audit
        made = [(role, text) for edit, role, text in edits[c] if edit != "D"]
        assert tuple(made) == brute.repair(held)[2]
        assert "".join(role[0] for role, _ in made).removeprefix("s").replace("ua", "") == ""


def test_nothing_but_the_open_steps_is_held():
    """Edits come out while turns go in, and ties are settled on all that is open."""
    search, final = survivors.Survivors("^", structure_repair._SLACK), []
    widest = 0
    rng = random.Random(1)
    codes = [rng.choice(list(structure_repair._EDGES)) for _ in range(3000)]
    for code in codes:
        final += search.step((a, b, cost, letters, None) for a, b, cost, letters in structure_repair._EDGES[code])
        widest = max(widest, search.unsettled())
    assert len(final) + search.unsettled() == 3000 and widest < 60
    assert len("".join(letters for letters, _ in final)) >= len(final)


def test_ties_take_the_least_letters():
    for codes in (["u", "u", "a", "a"], ["a"], ["s", "s"], ["o"] * 4, ["U", "xu", "A", "u"], ["s", "a", "u", "u"]):
        names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
        listed = [
            (i, names[c[-1].lower()], "" if c[0] == "x" else f"text {i}" + ("" if c.isupper() else "."))
            for i, c in enumerate(codes)
        ]
        ends = structure_repair._ENDS
        best = min(
            (cost + 2 * len(ends[state]), letters + ends[state])
            for state, (cost, letters) in structure_repair.cheapest(codes, "^").items()
        )
        audit = best[1].translate(str.maketrans("JS", "IR"))
        assert (best[0], audit) == brute.repair(listed)[:2]
