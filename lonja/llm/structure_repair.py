"""Repair the turn structure of conversations at the least cost.

Every turn is kept, given another role or deleted, and empty turns may be inserted, so that the
roles read system (or not), then user and assistant in turns. The cheapest edits come from a
Viterbi search that hands out edits as soon as all surviving paths share them. A long
conversation is cut into blocks, which are searched from every state they may start in, all at
once; the same search then runs over its blocks. So no task holds a conversation, and only the
edit letters of its blocks, not its texts, pass one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from lonja.llm.survivors import Survivors
from lonja.llm.texts import small_batches
from lonja.llm.turns import content_key, placed, with_bounds
from lonja.sources.staging import ROW, stage

BLOCK_TURNS = 1024

# Turns that one task searches.
TURNS_A_TASK = 100_000

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

SPACES = " \t\n\x0b\x0c\r"

# States: nothing yet, after the system turn, after a user's, after an assistant's.
_START = "^"
_KEEPS = {("^", "s"): "s", ("^", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
_NEXT = {"^": "u", "s": "u", "u": "a", "a": "u"}
_LEGAL = {"su", "ua", "au"}

# Letters of the edits. Those that give a role say which; paths that agree up to a letter are in
# one state, so the second letter of a pair never decides a tie.
_INSERT = {"u": "I", "a": "J"}
_REROLE = {"u": "R", "a": "S"}
_GIVEN, _AUDIT = "IJRS", "IIRR"
_ENDS = {"^": "", "a": "", "u": "J", "s": "IJ"}


# What a path's rest can cost more if it is followed from the second state, not the first: an
# insertion to be after the other speaker, a deletion of the system turn that can't be kept, or two
# insertions where the rest is nothing and the second state may not be the last.
_SLACK = {
    **{("^", "s"): 2 * INSERT, ("^", "u"): INSERT + DELETE, ("^", "a"): DELETE},
    **{("s", "^"): 0, ("s", "u"): INSERT, ("s", "a"): 0},
    **{("u", "^"): INSERT, ("u", "s"): INSERT, ("u", "a"): INSERT},
    **{("a", "^"): 0, ("a", "s"): 2 * INSERT, ("a", "u"): INSERT},
}


def _edges(code: str) -> list[tuple[str, str, int, str]]:
    """(state, next state, cost, letters) of all that can be done up to one turn.

    A code is the initial of the turn's role (``o`` for all but s, u and a), in upper case where
    its text is truncated, or with ``x`` before it where the turn must go.
    """
    best: dict[tuple[str, str], tuple[int, str]] = {}
    initial, must_go = code[-1].lower(), code[0] == "x"
    extra = TRUNCATED if code.isupper() else 0
    for source in "^sua":
        state, inserted = source, ""
        # More insertions only lead back to the same states.
        for _ in range(3):
            ways = [(state, DELETE, "D")]
            if not must_go:
                if (state, initial) in _KEEPS:
                    ways.append((_KEEPS[state, initial], extra, "K"))
                ways.append((_NEXT[state], REROLE + extra, _REROLE[_NEXT[state]]))
            for to, cost, letter in ways:
                found = (cost + INSERT * len(inserted), inserted + letter)
                best[source, to] = min(best.get((source, to), found), found)
            state = _NEXT[state]
            inserted += _INSERT[state]
    return [(source, to, *found) for (source, to), found in best.items()]


_EDGES = {code: _edges(code) for c in "suao" for code in (c, c.upper(), "x" + c)}


def cheapest(codes: Sequence[str], start: str) -> dict[str, tuple[int, str]]:
    """For each state after the turns ``codes``, the least cost from ``start`` and its letters."""
    search, final = Survivors(start, _SLACK), []
    for code in codes:
        final += search.step((a, b, cost, letters, None) for a, b, cost, letters in _EDGES[code])
    done = "".join(letters for letters, _ in final)
    return {
        state: (search.cost(state), done + "".join(letters for letters, _ in search.path(state)))
        for state in search.states
    }


_PIECE = "struct<start: string, stop: string, cost: bigint, letters: string>"
_SEARCHED = f"block bigint, first string, last string, illegal bigint, first_row bigint, pieces array<{_PIECE}>"
_CHOSEN = "block bigint, first_row bigint, letters string, cost bigint, illegal bigint"


def _layout(conv: StructField, ddl: str) -> StructType:
    return StructType([conv, *StructType.fromDDL(ddl).fields])


def _searcher(layout: StructType):
    """Search every block from each state that it may start in."""
    schema = to_arrow_schema(layout)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                codes = row.pop("codes")
                initials = "".join(c[-1].lower() for c in codes)
                row["first"], row["last"] = initials[0], initials[-1]
                row["illegal"] = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
                row["pieces"] = [
                    {"start": start, "stop": stop, "cost": cost, "letters": letters}
                    for start in ("^sua" if row["block"] else _START)
                    for stop, (cost, letters) in cheapest(codes, start).items()
                ]
                made.append(row)
            yield pa.RecordBatch.from_pylist(made, schema)

    return search


class _Chain:
    """The pieces chosen for the blocks of one conversation, which come in order."""

    def __init__(self, conv: object):
        self.conv, self.search, self.last = conv, Survivors(_START, _SLACK), ""
        self.illegal = self.blocks = 0

    def _rows(self, final: Iterator) -> Iterator[tuple]:
        for letters, (block, first_row) in final:
            yield (self.conv, block, first_row, letters, 0, 0)

    def add(self, row: dict) -> Iterator[tuple]:
        self.illegal += row["illegal"] + (bool(self.last) and self.last + row["first"] not in _LEGAL)
        self.last, self.blocks = row["last"], row["block"] + 1
        what = (row["block"], row["first_row"])
        pieces = [(p["start"], p["stop"], p["cost"], p["letters"], what) for p in row["pieces"]]
        return self._rows(self.search.step(pieces))

    def end(self) -> Iterator[tuple]:
        """What is left, then a row with the cost and the illegal pairs of all blocks."""
        what = (self.blocks, None)
        ends = [(s, "end", INSERT * len(letters), letters, what) for s, letters in _ENDS.items()]
        yield from self._rows(self.search.step(ends))
        yield (self.conv, self.blocks + 1, None, "", self.search.cost("end"), self.illegal)


def _chainer(layout: StructType):
    schema = to_arrow_schema(layout)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            made: list[tuple] = []
            for row in batch.to_pylist():
                if row["block"] == 0:
                    made += held.end() if held else ()
                    held = _Chain(row["conv"])
                made += held.add(row)
            yield batch_of(made)
        if held:
            yield batch_of(list(held.end()))

    return chain


@dataclass
class Repaired:
    """``edits``: conv, step, edit, role and text, one row per edit in the order of ``step``;
    ``summary``: conv, gaps, blank, duplicate, truncated, illegal, cost and audit."""

    edits: DataFrame
    summary: DataFrame


def _initial(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial.isin("s", "u", "a"), initial).otherwise("o")


def repaired(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> Repaired:
    """The least edits that give every conversation the roles ``(s?(ua)+)?``, by their initials.

    Turns are taken by ``turn`` (an integer), nulls first, then role and text. A turn without a
    character other than white space is blank; else one whose role and text came before in the
    conversation is a duplicate, also where rows are wholly equal; else one that does not end in
    ``.``, ``!`` or ``?`` is truncated. Blank and duplicate turns are deleted. Keep costs 0, a new
    role 2, deletion 3, insertion of an empty turn 2, and a truncated turn that stays 1 more.
    Of the cheapest edits those with the least letters are taken (D, I, K, R in order).

    Null roles and texts are empty; rows without an id are one conversation. ``gaps`` counts the
    turn numbers that are missing between the least and the greatest, 0 without any. Texts of
    any length are only hashed and copied. Other columns are left out, and an empty table gives
    empty results. ``audit`` is one text, so a conversation has less than 2**31 edits.
    """
    small_batches(turns, 256)
    value = {n: F.coalesce(F.col(f"`{c}`"), F.lit("")) for n, c in (("role", role), ("text", text))}
    end = F.rtrim(value["text"], F.lit(SPACES))
    rows, bounds = placed(
        turns,
        F.col(f"`{conv}`"),
        [F.col(f"`{turn}`")],
        list(value.values()),
        turn=F.col(f"`{turn}`").cast("bigint"),
        **value,
        initial=_initial(value["role"]),
        blank=end == "",
        cut=~F.substring(end, -1, 1).isin(".", "!", "?"),
        key=content_key(*value.values()),
    )
    slim = with_bounds(rows.drop("role", "text"), bounds)
    firsts = rows.where(~F.col("blank")).groupBy("conv", "key").agg(F.min(ROW).alias(ROW))
    judged = slim.join(firsts.select(ROW, F.lit(True).alias("is_first")), ROW, "left")
    duplicate = ~F.col("blank") & F.col("is_first").isNull()
    cut = F.col("cut") & ~F.col("blank") & ~duplicate
    code = F.when(F.col("blank") | duplicate, F.concat(F.lit("x"), F.col("initial")))
    code = code.when(cut, F.upper("initial")).otherwise(F.col("initial"))
    place = F.floor((F.col(ROW) - F.col("first_row")) / BLOCK_TURNS).alias("block")
    coded = judged.select(
        "conv", place, ROW, code.alias("code"), "blank", duplicate.alias("duplicate"), cut.alias("cut")
    )
    in_order = F.sort_array(F.collect_list(F.struct(ROW, "code")))
    blocks = coded.groupBy("conv", "block").agg(
        F.min(ROW).alias("first_row"),
        F.transform(in_order, lambda r: r["code"]).alias("codes"),
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "cut")],
    )
    seen = Observation()
    blocks = stage(blocks.observe(seen, F.sum(F.size("codes")).alias("turns")), "blocks")
    layout = _layout(blocks.schema["conv"], _SEARCHED)
    # A block is a few bytes a turn but takes its time: tasks by turns, not by bytes.
    tasks = math.ceil((seen.get.get("turns") or 1) / TURNS_A_TASK)
    dealt = blocks.select("conv", "block", "first_row", "codes").repartition(tasks)
    found = dealt.mapInArrow(_searcher(layout), layout)
    layout = _layout(blocks.schema["conv"], _CHOSEN)
    ordered = found.repartition("conv").sortWithinPartitions("conv", "block")
    chosen = stage(ordered.mapInArrow(_chainer(layout), layout), "chosen")
    return Repaired(_edits(chosen, rows), _summary(chosen, blocks, rows))


def _edits(chosen: DataFrame, rows: DataFrame) -> DataFrame:
    letters = chosen.where("letters <> ''").select(
        "conv", "block", "first_row", "letters", F.posexplode(F.split("letters", "")).alias("i", "letter")
    )
    before = F.length(F.translate(F.expr("substr(letters, 1, i)"), "IJ", ""))
    inserted = F.col("letter").isin("I", "J")
    given = F.when(F.col("letter").isin("I", "R"), "user").when(F.col("letter").isin("J", "S"), "assistant")
    spelt = letters.select(
        "conv",
        # A block has less than four letters a turn.
        (F.col("block") * 4 * BLOCK_TURNS + F.col("i")).alias("step"),
        F.translate("letter", _GIVEN, _AUDIT).alias("edit"),
        given.alias("given"),
        F.when(~inserted, F.col("first_row") + before).alias(ROW),
    )
    own = rows.select(ROW, "role", "text")
    joined = spelt.where(F.col(ROW).isNotNull()).join(own, ROW)
    kept = joined.select("conv", "step", "edit", F.coalesce("given", "role").alias("role"), "text")
    new = spelt.where(F.col(ROW).isNull())
    return kept.unionByName(new.select("conv", "step", "edit", F.col("given").alias("role"), F.lit("").alias("text")))


def _summary(chosen: DataFrame, blocks: DataFrame, rows: DataFrame) -> DataFrame:
    texts = F.sort_array(F.collect_list(F.struct("block", "letters")))
    audit = F.array_join(F.transform(texts, lambda t: t["letters"]), "")
    costs = chosen.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.translate(audit, _GIVEN, _AUDIT).alias("audit"),
    )
    faults = blocks.groupBy("conv").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("cut").alias("truncated")
    )
    turn = F.col("turn").cast("decimal(20,0)")
    missing = F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn")
    spans = rows.groupBy("conv").agg(F.coalesce(missing.cast("bigint"), F.lit(0)).alias("gaps"))
    out = spans
    for more in (faults, costs):
        own = more.withColumnRenamed("conv", "_conv")
        out = out.join(own, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    return out
