"""Casts with two behaviours on bad input: fail the job, or give null."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

Mode = Literal["strict", "permissive"]


def typed(value: Column, dtype: str, mode: Mode = "strict", label: str = "value") -> Column:
    """Cast to ``dtype``. Strict fails on a value that does not fit; permissive gives null."""
    casted = value.try_cast(dtype)
    if mode == "permissive":
        return casted
    bad = value.isNotNull() & casted.isNull()
    return F.when(bad, _fail(f"{label}: cannot cast to {dtype}: ", value)).otherwise(casted)


def whole_number(value: Column, mode: Mode = "strict", label: str = "value") -> Column:
    """Numeric text or number to bigint; text that is no number gives null in both modes.

    A number with a fraction is an error in strict mode and null in permissive mode; it is
    never truncated. Going through double lets the text ``20260630.0`` pass.
    """
    number = value.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    if mode == "permissive":
        return whole
    fraction = number.isNotNull() & (number != F.floor(number))
    return F.when(fraction, _fail(f"{label}: not a whole number: ", value)).otherwise(whole)


def _fail(message: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), value.cast("string")))
