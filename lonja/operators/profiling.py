"""Column profiles and key, grain and domain audits.

Every audit is a grouped aggregate with partial sums in the scan tasks; no group is collected
or sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.functions.text import strip
from lonja.sources.staging import literal_rows, stage, stage_numbered

# Limits of the profile and of the audits.
TOP_VALUES = 10
LOW_CARDINALITY = 30
SAMPLE_VALUES = 15
SHORT_CODE = 5
SAMPLE_GROUPS = 5

# Rows at the start of a source in which most columns have all their sample values.
HEAD_ROWS = 1000


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def _as_text(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Values as text; the two zeros of a floating type are one value."""
    floating = {name for name, dtype in df.dtypes if dtype in ("float", "double")}
    return [
        (_named(c) + F.lit(0.0) if c in floating else _named(c)).cast("string").alias(c)
        for c in columns
    ]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Occurrences of every value of every column as ``(columna, valor, n)``, nulls included.

    One scan; the rows of a column combine by value before they are shuffled.
    """
    melted = df.select(*_as_text(df, columns)).unpivot(
        [], [_named(c) for c in columns], "columna", "valor"
    )
    return melted.groupBy("columna", "valor").agg(F.count("*").alias("n"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, non-null and null rows, null share and distinct values of each column."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    filled = F.col("valor").isNotNull()
    counted = (
        value_counts(df, columns)
        .groupBy("columna")
        .agg(
            F.sum(F.when(filled, F.col("n"))).alias("_filled"),
            F.sum(F.when(~filled, F.col("n"))).alias("_null"),
            F.count("valor").alias("_distinct"),
        )
    )
    zero = F.lit(0).cast("bigint")
    # One row per column on either side; an empty table still lists its columns.
    pair = "columna string, tipo string"
    names = literal_rows(df.sparkSession, [(c, types[c]) for c in columns], pair)
    return (
        names.join(F.broadcast(counted), "columna", "left")
        .select(
            "columna",
            "tipo",
            F.coalesce("_filled", zero).alias("no_nulos"),
            F.coalesce("_null", zero).alias("nulos"),
            F.coalesce("_distinct", zero).alias("distintos"),
        )
        .withColumn(
            "pct_nulos",
            F.round(F.try_divide(100.0 * F.col("nulos"), F.col("nulos") + F.col("no_nulos")), 2),
        )
    )


def profile_columns_approx(df: DataFrame, sketch_bits: int = 12) -> DataFrame:
    """Like ``profile_columns`` with estimated distinct counts: one pass and no value shuffle.

    Twelve bits keep a sketch at a few kilobytes and its error near two percent.
    """
    wide = df.agg(
        *[
            F.struct(
                F.count(_named(c)).alias("no_nulos"),
                F.count_if(_named(c).isNull()).alias("nulos"),
                F.hll_sketch_estimate(F.hll_sketch_agg(text, F.lit(sketch_bits))).alias(
                    "distintos"
                ),
            ).alias(c)
            for c, text in zip(df.columns, _as_text(df, df.columns), strict=True)
        ]
    )
    return wide.unpivot([], [_named(c) for c in df.columns], "columna", "_p").select(
        "columna", "_p.*"
    )


def sketch_agreement(df: DataFrame, sketch_bits: int = 12, sigmas: float = 6.0) -> DataFrame:
    """Whether each column's estimated distinct count is within its error of the exact one.

    A sketch's standard error is at most ``1.04 / sqrt(2 ** sketch_bits)`` of the count; small
    counts are exact but for one.
    """
    exact = profile_columns(df).select("columna", "no_nulos", "nulos", "distintos")
    guess = profile_columns_approx(df, sketch_bits).select(
        "columna", F.col("distintos").alias("estimados")
    )
    error = F.lit(sigmas * 1.04 / 2 ** (sketch_bits / 2))
    gap = F.abs(F.col("estimados") - F.col("distintos"))
    return exact.join(guess, "columna").select(
        "columna",
        "no_nulos",
        "nulos",
        "distintos",
        (gap <= F.greatest(F.lit(1.0), error * F.col("distintos"))).alias("dentro_del_error"),
    )


def _limited(df: DataFrame, per: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group; tasks keep only their own first n before the shuffle."""
    window = Window.partitionBy(*per).orderBy(*order)
    return df.withColumn("puesto", F.row_number().over(window).cast("bigint")).where(
        F.col("puesto") <= n
    )


def top_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Ten most frequent values of each column that has at most thirty.

    One value more than thirty per column is enough to tell the two kinds apart, so the values
    are counted once and never joined back.
    """
    counted = value_counts(df, list(columns or df.columns)).where("valor is not null")
    order = [F.col("n").desc(), F.col("valor")]
    first = _limited(counted, ["columna"], order, LOW_CARDINALITY + 1)
    values = F.count("*").over(Window.partitionBy("columna"))
    return (
        first.withColumn("_d", values)
        .where((F.col("_d") <= LOW_CARDINALITY) & (F.col("puesto") <= TOP_VALUES))
        .drop("_d")
    )


def sample_values(
    df: DataFrame, order_by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """First fifteen non-null values of each column in the given row order.

    The rows that come first are kept by every task and written; in them nearly all columns have
    their values. Only columns with fewer there are looked for in all rows: a row becomes one value
    per such column with the row's place, and a task keeps the first values of each column before
    anything is shuffled.
    """
    columns = list(columns or df.columns)
    place = F.struct(*[F.col(c) for c in order_by]).alias("_place")
    placed = df.select(place, *[_named(c).cast("string").alias(c) for c in columns])
    # More rows may share the last place of the head, so that one does not count.
    tied = F.col("_place") == F.max("_place").over(Window.partitionBy())
    head = stage(placed.orderBy("_place").limit(HEAD_ROWS).withColumn("_tied", tied), "head")
    counts = [F.count_if(~F.col("_tied") & _named(c).isNotNull()).alias(c) for c in columns]
    rows, *filled = head.agg(F.count("*").alias("_rows"), *counts).first()
    if rows < HEAD_ROWS:
        return _first_values(head, columns)
    early = [c for c, n in zip(columns, filled, strict=True) if n >= SAMPLE_VALUES]
    late = [c for c in columns if c not in early]
    parts = [_first_values(df, own) for df, own in ((head.where("not _tied"), early), (placed, late)) if own]
    return reduce(DataFrame.unionByName, parts)


def _first_values(placed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """First fifteen non-null values of each column by ``_place``, then by value."""
    melted = placed.select("_place", *[_named(c) for c in columns]).unpivot(
        ["_place"], [_named(c) for c in columns], "columna", "valor"
    )
    order = [F.col("_place"), F.col("valor")]
    first = _limited(melted.where("valor is not null"), ["columna"], order, SAMPLE_VALUES)
    return first.select("columna", "puesto", "valor")


def of_sources(
    frames: Mapping[str, DataFrame], report: Callable[[str, DataFrame], DataFrame]
) -> DataFrame:
    """One report over several sources, with the source's name in ``fuente``."""
    parts = [report(name, df).withColumn("fuente", F.lit(name)) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns, all-null columns and rows that repeat an earlier row."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    empty = reduce(
        lambda total, c: total + (F.max(F.col(c).isNotNull()) == F.lit(False)).cast("bigint"),
        df.columns,
        F.lit(0).cast("bigint"),
    )
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("filas"),
        F.lit(len(df.columns)).cast("bigint").alias("columnas"),
        F.coalesce(empty, F.lit(len(df.columns)).cast("bigint")).alias("columnas_vacias"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("filas_duplicadas"),
    )


def candidate_keys(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Uniqueness of several candidate keys out of one scan.

    Grouping sets count each candidate's key values side by side. Rows with a null key part are
    counted apart and not evaluated.
    """
    columns = list(dict.fromkeys(c for key in candidates.values() for c in key))
    narrow = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    place = {c: i for i, c in enumerate(columns)}
    sets = [[f"_k{place[c]}" for c in key] for key in candidates.values()]
    grouped = narrow.groupingSets(sets, *narrow.columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("_n")
    )
    width = len(columns)
    parts = []
    for name, key in candidates.items():
        used = {place[c] for c in key}
        identity = sum(1 << (width - 1 - i) for i in range(width) if i not in used)
        whole = reduce(lambda a, b: a & b, [F.col(f"_k{i}").isNotNull() for i in sorted(used)])
        mine = F.col("_set") == identity
        parts.append(F.when(mine, F.struct(F.lit(name).alias("clave"), whole.alias("_whole"))))
    count, whole = F.col("_n"), F.col("_c._whole")
    zero = F.lit(0).cast("bigint")
    return (
        grouped.withColumn("_c", F.coalesce(*parts))
        .groupBy(F.col("_c.clave").alias("clave"))
        .agg(
            F.coalesce(F.sum(F.when(~whole, count)), zero).alias("filas_nulas"),
            F.coalesce(F.sum(F.when(whole, count)), zero).alias("filas_evaluadas"),
            F.count_if(whole).alias("claves_unicas"),
        )
        .withColumn("filas_duplicadas", F.col("filas_evaluadas") - F.col("claves_unicas"))
        .withColumn("es_unica", F.col("filas_duplicadas") == 0)
    )


def key_cardinality(df: DataFrame, key: str) -> DataFrame:
    """Nulls, distinct and repeated values of one key column."""
    counted = df.groupBy(key).agg(F.count("*").alias("_n"))
    filled, n = F.col(key).isNotNull(), F.col("_n")
    zero = F.lit(0).cast("bigint")
    return counted.agg(
        F.coalesce(F.sum(n), zero).alias("filas"),
        F.coalesce(F.sum(F.when(~filled, n)), zero).alias("nulos"),
        F.coalesce(F.sum(F.when(filled, n)), zero).alias("no_nulos"),
        F.count(key).alias("distintos"),
        F.count_if(filled & (n > 1)).alias("valores_repetidos"),
        F.coalesce(F.sum(F.when(filled & (n > 1), n)), zero).alias("filas_en_grupos"),
        F.coalesce(F.sum(F.when(filled, n - 1)), zero).alias("filas_extra"),
    ).withColumn("es_unica", (F.col("valores_repetidos") == 0) & (F.col("nulos") == 0))


def repeated_values(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All non-null key values that occur more than once, with their number of rows."""
    return (
        df.dropna(how="any", subset=list(key))
        .groupBy(*key)
        .agg(F.count("*").alias("ocurrencias"))
        .where("ocurrencias > 1")
    )


def repetition_histogram(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many repeated key values occur twice, three times, and so on."""
    return repeated_values(df, key).groupBy("ocurrencias").agg(F.count("*").alias("claves"))


def _varies(column: str, rows: Column) -> Column:
    """Whether a group holds more than one value of a column, null being a value too."""
    filled = F.count(column)
    return ((filled > 0) & (filled < rows)) | F.coalesce(
        F.min(column) != F.max(column), F.lit(False)
    )


def only_repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose non-null key occurs more than once.

    The repeated keys are counted on the key alone and written first. A tested key is nearly
    unique, so they are few; Spark then knows their size and can filter the wide rows in place
    instead of shuffling them all.
    """
    names = "-".join(key)
    repeated = stage(repeated_values(df, key).select(*key), f"repeated-{names}")
    return df.join(repeated, list(key), "left_semi")


def varying_columns(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """In how many repeated-key groups each column varies.

    Minimum, maximum and non-null count say whether a group varies, so one grouped pass answers
    for every column and a hot key combines in the scan tasks.
    """
    rows = F.count("*")
    flags = (
        only_repeated(df, key)
        .groupBy(*key)
        .agg(*[_varies(c, rows).alias(f"_v_{c}") for c in columns])
    )
    totals = flags.agg(*[F.count_if(F.col(f"_v_{c}")).alias(c) for c in columns])
    return totals.unpivot([], list(columns), "columna", "grupos_con_variacion")


def sample_repeated(
    df: DataFrame, key: str, preview: Sequence[str], n: int = SAMPLE_GROUPS
) -> DataFrame:
    """Rows of the n repeated keys that come first in key order."""
    # n rows by construction.
    first = F.broadcast(repeated_values(df, [key]).orderBy(key).limit(n))
    return df.join(first, key).select(key, "ocurrencias", *preview)


def short_codes(df: DataFrame, column: str, below: int = SHORT_CODE) -> DataFrame:
    """Codes whose stripped text is shorter than expected, with counts."""
    code = strip(F.col(column).cast("string"))
    return (
        df.select(code.alias("codigo"))
        .where(F.length("codigo") < below)
        .groupBy("codigo")
        .agg(F.count("*").alias("n"))
    )


def repeated_crosses(df: DataFrame, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Every measure combination of the keys that occur more than once, null equal to null.

    One row per key and combination of measures with its number of rows, so a key with many
    rows never becomes one list. ``combinaciones`` above 1 means the amounts differ.
    """
    detail = df.groupBy(*key, *measures).agg(F.count("*").alias("filas"))
    totals = (
        detail.groupBy(*key)
        .agg(F.sum("filas").alias("ocurrencias"), F.count("*").alias("combinaciones"))
        .where("ocurrencias > 1")
    )
    renamed = totals.select(
        *[F.col(c).alias(f"_{c}") for c in key], "ocurrencias", "combinaciones"
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return detail.join(renamed, same).drop(*[f"_{c}" for c in key])


def largest_group(
    df: DataFrame, key: Sequence[str], measures: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The largest group (smallest key on a tie): rows, measure sums, and which columns vary."""
    rows = F.count("*")
    groups = df.groupBy(*key).agg(
        rows.alias("filas"),
        *[F.sum(m).alias(f"suma_{m}") for m in measures],
        *[_varies(c, rows).alias(f"varia_{c}") for c in columns],
    )
    order = [F.col("filas").desc(), *[F.col(c).asc_nulls_first() for c in key]]
    return groups.orderBy(*order).limit(1)


def group_sizes(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Groups, groups with more than one row, and rows of the largest group."""
    sizes = df.groupBy(*key).agg(F.count("*").alias("_n"))
    return sizes.agg(
        F.count("*").alias("grupos"),
        F.count_if(F.col("_n") > 1).alias("grupos_repetidos"),
        F.max("_n").alias("mayor_grupo"),
    )


def domain_overlap(pairs: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Shared and one-sided values of column pairs, after strip and upper case.

    Each frame is scanned once for all the pairs it takes part in, and reduced to the distinct
    values of its columns before a value is normalised or handed to a pair.
    """
    frames: dict[int, DataFrame] = {}
    roles: dict[int, list[tuple[str, str, int]]] = {}
    for name, (left, left_column, right, right_column) in pairs.items():
        for df, column, side in ((left, left_column, 1), (right, right_column, 2)):
            frames[id(df)] = df
            roles.setdefault(id(df), []).append((column, name, side))
    role = "columna string, par string, _side int"
    values = []
    for key, df in frames.items():
        columns = list(dict.fromkeys(column for column, _, _ in roles[key]))
        melted = df.select(*_as_text(df, columns)).unpivot([], columns, "columna", "valor")
        mine = literal_rows(df.sparkSession, roles[key], role)
        values.append(melted.distinct().join(mine, "columna"))
    found = (
        reduce(DataFrame.unionByName, values)
        .groupBy("par", F.upper(strip(F.col("valor"))).alias("valor"))
        .agg(F.bit_or("_side").alias("_sides"))
    )
    # Nulls are no values, but they keep a pair without any value in the report.
    sides = F.when(F.col("valor").isNotNull(), F.col("_sides"))
    return found.groupBy("par").agg(
        F.count_if(sides != 2).alias("n_a"),
        F.count_if(sides != 1).alias("n_b"),
        F.count_if(sides == 3).alias("n_comunes"),
        F.count_if(sides == 1).alias("n_solo_a"),
        F.count_if(sides == 2).alias("n_solo_b"),
    )


def period_coverage(sources: Mapping[str, DataFrame], column: str, base: str) -> DataFrame:
    """Months per source: how many, first, last, shared with the base source, subset of it."""
    tagged = [
        df.select(F.lit(name).alias("fuente"), F.col(column).alias("_p"))
        .where("_p is not null")
        .distinct()
        for name, df in sources.items()
    ]
    months = reduce(DataFrame.unionByName, tagged)
    basis = months.where(F.col("fuente") == base).select("_p", F.lit(1).alias("_base"))
    return (
        months.join(basis, "_p", "left")
        .groupBy("fuente")
        .agg(
            F.count("*").alias("periodos"),
            F.min("_p").alias("primero"),
            F.max("_p").alias("ultimo"),
            F.count("_base").alias("comunes"),
        )
        .withColumn("subconjunto", F.col("comunes") == F.col("periodos"))
    )


def measure_stats(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Count, sum, minimum, maximum, mean and standard deviation of each measure."""
    wide = df.agg(
        *[
            F.struct(
                F.count(m).alias("n"),
                F.sum(m).cast("double").alias("suma"),
                F.min(m).cast("double").alias("minimo"),
                F.max(m).cast("double").alias("maximo"),
                F.round(F.avg(F.col(m).cast("double")), 4).alias("media"),
                F.round(F.stddev_samp(F.col(m).cast("double")), 4).alias("desviacion"),
            ).alias(m)
            for m in measures
        ]
    )
    return wide.unpivot([], list(measures), "medida", "_m").select("medida", "_m.*")


def quartiles(df: DataFrame, measure: str) -> DataFrame:
    """Exact quartiles of one measure with linear interpolation between neighbours.

    Equal values combine first, so a value that fills a third of the rows is one row. The
    distinct values are sorted by range across tasks with the rows up to each; only those at
    the wanted positions go on.
    """
    value = F.col(measure).cast("double").alias("v")
    counted = df.select(value).where("v is not null").groupBy("v").agg(F.count("*").alias("_rows"))
    sorted_values = stage_numbered(
        counted, f"sorted-{measure}", [F.col("v")], "_upto", weight="_rows"
    )
    last = (sorted_values.agg(F.max("_upto").alias("n")).first()["n"] or 1) - 1
    covers = F.col("_upto") - F.col("_rows")
    picked = []
    for name, q in {"p25": 0.25, "p50": 0.5, "p75": 0.75}.items():
        place = last * q
        low = int(place)
        at = [
            F.max(F.when((covers <= i) & (F.lit(i) < F.col("_upto")), F.col("v")))
            for i in (low, min(low + 1, last))
        ]
        picked.append((at[0] + (at[1] - at[0]) * F.lit(place - low)).alias(name))
    return sorted_values.agg(F.lit(measure).alias("medida"), *picked)


def share(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Percentage of rows that meet each condition; a null condition counts as not met."""
    return df.agg(
        *[
            F.round(F.try_divide(100.0 * F.count_if(condition), F.count("*")), 2).alias(name)
            for name, condition in conditions.items()
        ]
    )


def additive_gap(df: DataFrame, total: str, parts: Sequence[str], tolerance: float) -> DataFrame:
    """Rows where a total differs from the sum of its parts, and the largest difference."""
    gap = F.abs(F.col(total) - reduce(lambda a, b: a + b, [F.col(p) for p in parts]))
    return df.agg(
        F.count_if(gap > F.lit(tolerance).cast("decimal(20,4)")).alias("filas_fuera"),
        F.max(gap).cast("double").alias("delta_maximo"),
    )


def validity_breakdown(df: DataFrame, invoice: str, credit_note: str) -> DataFrame:
    """Valid rows, rows without invoice and credited rows of a raw sales source."""
    invoiced = F.col(invoice).isNotNull()
    credited = F.coalesce(F.upper(F.col(credit_note)) == "SI", F.lit(False))
    return df.agg(
        F.count_if(invoiced & ~credited).alias("validas"),
        F.count_if(~invoiced).alias("sin_factura"),
        F.count_if(credited).alias("con_nota_credito"),
    )
