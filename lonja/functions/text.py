"""Text expressions and header normalisation."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of every character that counts as outer whitespace.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)

# Fixed value: name of a column whose header has no usable character.
EMPTY_HEADER = "columna"


def strip(value: Column) -> Column:
    """Remove outer whitespace of any kind (``trim`` alone removes only spaces)."""
    return F.btrim(value, F.lit(WHITESPACE))


def strip_visible(value: Column) -> Column:
    """As ``strip``, but a text that begins and ends with a visible ASCII character is left as it is.

    Comparing the first and the last byte costs less than a search among all kinds of whitespace.
    It takes more generated code, too much for joined projections.
    """
    last = F.substring(value.cast("binary"), -1, 1)
    visible = (value >= "!") & (value < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(visible, value).otherwise(strip(value))


def key_text(value: Column) -> Column:
    """Natural-key text: stripped, blank becomes null."""
    return F.nullif(strip(value.cast("string")), F.lit(""))


def header_name(header: object) -> str:
    """Lower-case, accent-free snake_case form of one header."""
    decomposed = unicodedata.normalize("NFKD", str(header).strip().lower())
    unaccented = "".join(filter(lambda ch: not unicodedata.combining(ch), decomposed))
    return re.sub(r"[\W_]+", "_", unaccented).strip("_") or EMPTY_HEADER


def header_names(headers: Iterable[object]) -> list[str]:
    """Normalised headers; a repeated name takes the next free ``_1``, ``_2``, ... suffix."""
    taken: set[str] = set()
    result = []
    for base in map(header_name, headers):
        name, suffix = base, 0
        while name in taken:
            suffix += 1
            name = f"{base}_{suffix}"
        taken.add(name)
        result.append(name)
    return result
