"""Small fixed tables inside expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

BETWEEN, AFTER = "\u0001", "\u0002"


def lookup(table: Mapping[str, object], key: Column) -> Column:
    """The table's value for key as a text; NULL where it has none. The table is one literal, folded once."""
    return F.try_element_at(F.str_to_map(F.lit(BETWEEN.join(f"{k}{AFTER}{v}" for k, v in table.items())), F.lit(BETWEEN), F.lit(AFTER)), key)


def among(words: Iterable[str], c: Column) -> Column:
    """Is c one of the words?"""
    return F.array_contains(F.split(F.lit(BETWEEN.join(words)), BETWEEN), c)
