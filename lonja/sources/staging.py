"""Tables written to the shared folder: staged frames with a dense row number."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lonja.session import shared_folder

ROW = "_src_row"

# Independent table writes run side by side; the cluster's scheduler shares the executors.
CONCURRENT_WRITES = 8

# Folder of the frames that a load stages; they go when the load's state goes.
_SCOPE: ContextVar[str | None] = ContextVar("staged", default=None)

# monotonically_increasing_id() keeps the row position in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def literal_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType | str
) -> DataFrame:
    """A few fixed rows as an inline table, whose size Spark knows when it plans a join."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    listed = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows)
    inline = spark.sql(f"SELECT * FROM VALUES {listed} AS rows({', '.join(schema.names)})")
    return inline.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower()


def new_staging_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged/load-{uuid4().hex}"


@contextmanager
def staging_in(folder: str) -> Iterator[None]:
    """Stage all frames in ``folder`` meanwhile, so that they can be deleted together."""
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)


def side_by_side(function: Callable[[Any], Any], items: Iterable[Any]) -> list:
    """The results of ``function`` for all items, each in a thread that stages where this one does."""
    items = list(items)
    scopes = [copy_context() for _ in items]
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        return list(pool.map(lambda scope, item: scope.run(function, item), scopes, items))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage."""
    folder = _SCOPE.get() or f"{shared_folder(df.sparkSession)}/staged"
    path = f"{folder}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_numbered(
    df: DataFrame,
    name: str,
    order_by: Sequence[Column] = (),
    column: str = ROW,
    weight: str | None = None,
) -> DataFrame:
    """Stage ``df`` with a gap-free number 1..n in ``column``.

    Every write task stores its own partition number and row positions, so the numbers come
    from what was written once and stay the same when tasks are lost and rerun. The offsets are
    a running sum over one count per write task. With ``order_by`` the frame is
    range-partitioned and sorted first, and the numbers follow that order. With ``weight`` a
    row stands for that many, and its number is the running total.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    written = stage(
        ordered.select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_pos"),
        ),
        name,
    )
    if weight:
        total, so_far = F.sum(weight), Window.partitionBy("_part").orderBy("_pos")
        within = F.sum(weight).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    else:
        total, within = F.count("*"), F.col("_pos") + 1
    sizes = written.groupBy("_part").agg(total.alias("_n"))
    # One row per write task.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    # Spark takes the counts for as large as what they count, and would shuffle all rows to few tasks.
    starts = F.broadcast(sizes.select("_part", start))
    numbered = written.withColumn(column, within).join(starts, "_part")
    numbered = numbered.withColumn(column, F.col(column) + F.col("_start"))
    return numbered.drop("_part", "_pos", "_start")


def ordinal(df: DataFrame, order_by: Sequence[Column], column: str) -> DataFrame:
    """Number rows 1..n in the given order by a distributed sort that is written once."""
    return stage_numbered(df, f"ordered-{column}", order_by, column)
