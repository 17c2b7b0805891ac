"""Full load: sources to cleaned, ruled and staged frames, dimensions, facts, checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lonja.functions.casts import Mode
from lonja.operators import calendar, clean, rules
from lonja.operators import dimensions as dims
from lonja.operators.facts import FACT_SPECS, build_fact, used_columns
from lonja.operators.quality import (
    require_no_violations,
    require_passed,
    require_same_totals,
    validation_report,
)
from lonja.sources.mart_tables import Draft, MartTables, StaleDraft, conformed
from lonja.sources.registry import PLACE, first_rows
from lonja.sources.schemas import DIMENSIONS, FACTS, STAR
from lonja.sources.staging import (
    ROW,
    literal_rows,
    new_staging_folder,
    side_by_side,
    stage,
    stage_numbered,
    staging_in,
)

# A load that another one has overtaken starts again on the new state, so many times in all.
ATTEMPTS = 5

# Published states that stay readable after a load.
KEPT_STATES = 2

Totals = Mapping[str, Any]


@dataclass
class LoadResult:
    """Written tables, staged ruled frames, merge and stage counts, and the check report."""

    tables: dict[str, DataFrame]
    ruled: dict[str, DataFrame]
    merges: DataFrame
    stages: DataFrame
    report: DataFrame


def _published(mart: MartTables, kept: int, step: Callable[[Draft], Any]) -> Any:
    """Run ``step`` on a draft and publish it; nothing of it stays if it fails.

    If another load has published meanwhile, the step runs again on top of that.
    """
    for attempt in range(1, ATTEMPTS + 1):
        draft = mart.draft(new_staging_folder(mart.spark))
        try:
            with staging_in(draft.staged):
                result = step(draft)
                draft.publish()
        except StaleDraft:
            draft.discard()
            if attempt == ATTEMPTS:
                raise
        except BaseException:
            draft.discard()
            raise
        else:
            mart.keep(kept)
            return result


def evolve(mart: MartTables) -> list[str]:
    """Add the declared columns that a stored table lacks, and publish the calendar with them filled.

    Returns the added columns as ``table.column``. Rows stored before have nulls in added
    columns, but for the later calendar columns, which follow from the older ones.
    """
    added = []
    for table in DIMENSIONS:
        stored = mart.spark.table(mart.name(table)).schema.names
        missing = [f for f in STAR[table].fields if f.name not in stored]
        if not missing:
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        older = mart.read(table).select(*stored)
        mart.spark.sql(f"ALTER TABLE {mart.name(table)} ADD COLUMNS ({columns})")
        filled = calendar.backfill_master_columns(older) if table == "dim_tiempo" else older
        mart.replace(table, filled)
        added += [f"{table}.{f.name}" for f in missing]
    return added


def seed_calendar(
    mart: MartTables, years: DataFrame, holidays: DataFrame, order_by: str
) -> dict[str, int]:
    """Insert or update the calendar days of ``years``; known dates keep their key.

    Returns how many days were inserted, updated and skipped.
    """
    mart.create()
    evolve(mart)
    spine = calendar.date_spine(years)
    incoming = calendar.calendar_days(spine, calendar.holiday_names(holidays, order_by))

    def merge(draft: Draft) -> dict[str, int]:
        existing = dims.ensure_seeds(draft.read("dim_tiempo"), "dim_tiempo")
        merged = dims.merge_members(existing, incoming, dims.CALENDAR)
        seen = Observation()
        actions = ("inserted", "updated", "skipped")
        counts = [F.count_if(F.col("_action") == action).alias(action) for action in actions]
        draft.write("dim_tiempo", merged.observe(seen, *counts))
        return {action: _seen(seen).get(action, 0) for action in actions}

    return _published(mart, KEPT_STATES, merge)


def measures_of(table: str, ruled: bool) -> dict[str, Column]:
    """The numeric measures of a fact, from its ruled source or from its own columns."""
    found = {}
    for name, expression in FACT_SPECS[table].measures.items():
        kind = STAR[table][name].dataType
        if isinstance(kind, NumericType):
            found[f"{table}.{name}"] = F.expr(expression).cast(kind) if ruled else F.col(name)
    return found


def _totals(measures: Mapping[str, Column]) -> list[Column]:
    """Rows, and the sum of each measure."""
    return [F.count(F.lit(1)).alias("filas"), *[F.sum(m).alias(n) for n, m in measures.items()]]


def _seen(observation: Observation) -> Totals:
    """What was observed; a frame that Spark found to be empty reports nothing."""
    return observation.get or {"filas": 0}


def ruled_frames(
    raw: Mapping[str, DataFrame],
    business_days: DataFrame,
    specs: Mapping[str, dims.Dimension] = dims.TEXT_DIMENSIONS,
    mode: Mode = "strict",
) -> tuple[dict[str, DataFrame], list[tuple[str, str, int]], dict[str, Totals]]:
    """Cleaned and ruled sources, each written once with row numbers; rows per stage; totals.

    The staged table is read by the dimensions and by its fact, and gives the fact its keys, so
    the joins, the parse and the dedup of a source run one time. It holds the columns that are
    read later; the dedup before it compares all of them. Rows are counted at each stage, and
    the measures of each source's fact summed, while the frame is written.
    """
    counted: list[tuple[str, str, Observation]] = []

    def watched(df: DataFrame, step: str, source: str, **measures: Column) -> DataFrame:
        counted.append((step, source, Observation()))
        return df.observe(counted[-1][2], *_totals(measures))

    def cleaned(source: str, cleaner: Callable[[DataFrame, Mode], DataFrame]) -> DataFrame:
        extracted = watched(raw[source].drop(PLACE), "extract", source)
        return watched(cleaner(extracted, mode), "transform", source)

    ruled = {
        "ventas": rules.sales_rules(cleaned("ventas", clean.clean_sales)),
        "presupuesto": rules.budget_rules(
            cleaned("presupuesto", clean.clean_budget), business_days
        ),
        "registros": rules.contact_rules(cleaned("registros", clean.clean_contacts)),
    }
    facts = {spec.source: table for table, spec in FACT_SPECS.items()}

    def staged(item: tuple[str, DataFrame]) -> DataFrame:
        source, df = item
        used = [c for c in used_columns(source, specs) if c in df.columns]
        measures = measures_of(facts[source], ruled=True)
        return stage_numbered(
            watched(df.select(*used), "business_rules", source, **measures), source
        )

    frames = dict(zip(ruled, side_by_side(staged, ruled.items()), strict=True))
    rows = [(step, source, _seen(seen)["filas"]) for step, source, seen in counted]
    totals = {facts[s]: _seen(seen) for step, s, seen in counted if step == "business_rules"}
    return frames, rows, totals


def load_dimensions(
    draft: Draft,
    ruled: Mapping[str, DataFrame],
    specs: Mapping[str, dims.Dimension] = dims.TEXT_DIMENSIONS,
) -> DataFrame:
    """Merge the members of all dimensions into the draft and report what the merge did."""
    existing = {
        table: dims.ensure_seeds(draft.read(table), table)
        for table in DIMENSIONS
        if table != "dim_tiempo"
    }
    keys = stage(dims.all_member_keys(ruled, specs), "members")
    fresh = dims.number_new_members(keys, existing, specs)

    def merge(table: str) -> None:
        if table == dims.VALIDITY.table:
            incoming = dims.observed_validity(ruled["ventas"])
            draft.write(table, dims.updated_members(existing[table], incoming, dims.VALIDITY))
            return
        spec = specs[table]
        known = dims.updated_members(existing[table], dims.from_parts(keys, spec), spec)
        new = dims.from_parts(fresh, spec, "_sk").withColumnRenamed("_sk", spec.sk)
        draft.write(table, conformed(known, table).unionByName(conformed(new, table)))

    side_by_side(merge, existing)
    return dims.merge_report(keys, fresh, existing, specs)


def load_facts(
    draft: Draft,
    ruled: Mapping[str, DataFrame],
    loaded_at: str,
    specs: Mapping[str, dims.Dimension] = dims.TEXT_DIMENSIONS,
) -> dict[str, Totals]:
    """Rebuild the three facts in the draft; the rows and sums of each, taken while it is written."""
    dimensions = {table: draft.read(table) for table in DIMENSIONS}

    def write(table: str) -> tuple[str, Totals]:
        spec = FACT_SPECS[table]
        fact = build_fact(spec, ruled[spec.source], dimensions, loaded_at, specs)
        seen = Observation()
        draft.write(table, fact.observe(seen, *_totals(measures_of(table, ruled=False))))
        return table, _seen(seen)

    return dict(side_by_side(write, FACT_SPECS))


def stage_counts(
    counted: Sequence[tuple[str, str, int]], draft: Draft, facts: Mapping[str, Totals]
) -> DataFrame:
    """Rows per stage and table: as counted while written, and those of the dimensions."""
    listed = [*counted, *[("load", table, totals["filas"]) for table, totals in facts.items()]]
    result = literal_rows(draft.spark, listed, "etapa string, tabla string, filas bigint")
    for table in DIMENSIONS:
        loaded = draft.read(table).agg(
            F.lit("load").alias("etapa"), F.lit(table).alias("tabla"), F.count("*").alias("filas")
        )
        result = result.unionByName(loaded)
    return result


def run_load(
    mart: MartTables,
    raw: Mapping[str, DataFrame],
    loaded_at: str | None = None,
    max_rows: int | None = None,
    specs: Mapping[str, dims.Dimension] = dims.TEXT_DIMENSIONS,
    mode: Mode = "strict",
    kept_states: int = KEPT_STATES,
) -> LoadResult:
    """Load the whole mart from the raw sources; fails when a check fails.

    All tables are written as a draft, checked, and then published at once, so a load that fails
    leaves every table as it was. A load that is overtaken by another one runs again on top of
    it, so no two loads give the same key. ``kept_states`` published states stay readable, older
    ones are deleted with their staged frames.

    ``mode`` says whether a value that does not fit its type fails the load or becomes null.

    Keys and values of the dimensions are checked before the facts are built, since a repeated
    member would multiply fact rows; then the facts' own, their rows and sums against the ruled
    sources, and the report.
    The calendar must have been seeded before. ``max_rows`` loads a sample, the first rows of
    each source in file order if it was read with ``order=PLACE``, else in column order.
    ``specs`` replaces dimension declarations, for instance to take another region column or to
    give a normalised segment.
    """
    mart.create()
    evolve(mart)
    stamp = loaded_at or datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
    if max_rows is not None:
        raw = {key: first_rows(df, max_rows, df.columns) for key, df in raw.items()}

    def step(draft: Draft) -> LoadResult:
        calendar_table = calendar.require_calendar(draft.read("dim_tiempo"))
        business_days = calendar.business_days(calendar_table)
        ruled, counted, before = ruled_frames(raw, business_days, specs, mode)
        merges = load_dimensions(draft, ruled, specs)
        require_no_violations({table: draft.read(table) for table in DIMENSIONS})
        after = load_facts(draft, ruled, stamp, specs)
        require_same_totals(before, after)
        require_no_violations({table: draft.read(table) for table in FACTS})
        report = validation_report(draft)
        require_passed(report)
        return LoadResult(
            draft.read_all(),
            {name: df.drop(ROW) for name, df in ruled.items()},
            merges,
            stage_counts(counted, draft, after),
            report,
        )

    return _published(mart, kept_states, step)
