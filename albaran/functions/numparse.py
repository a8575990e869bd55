"""Numeric parsers: text to DOUBLE, each with its own rule for separators. No UDF; NULL and '' as stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _count(c: Column, mark: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))


def _drop(c: Column, mark: str) -> Column:
    return F.replace(c, F.lit(mark), F.lit(""))


def _double(c: Column) -> Column:
    """A plain number; NULL for anything else, without the exception that a failing cast costs."""
    return F.when(c.rlike(r"^\s*[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?\s*$"), c).try_cast("double")


def parse_decimal_legacy(c: Column) -> Column:
    """Reads O as 0 and drops signs; a point before a comma wins, so 1.234,56 gives 1.23456. NULL where unreadable."""
    s = F.regexp_replace(F.translate(c, "Oo ", "00"), "[^0-9.,]", "")
    s = F.when((_count(s, ".") > 1) & (_count(s, ",") == 1), _drop(s, ".")).otherwise(s)
    s = F.when((_count(s, ",") > 1) & (_count(s, ".") == 1), _drop(s, ",")).otherwise(s)
    s = F.when((F.instr(s, ".") > 0) & (F.instr(s, ",") > F.instr(s, ".")), _drop(s, ",")).otherwise(s)
    return _double(F.translate(s, ",", "."))


def parse_numeric(c: Column) -> Column:
    """Keeps digits, separators and minus; the last of two kinds of separator is decimal. NULL where unreadable."""
    s = F.regexp_replace(c, "[^0-9.,-]", "")
    both = (F.instr(s, ".") > 0) & (F.instr(s, ",") > 0)
    comma_last = F.instr(F.reverse(s), ",") < F.instr(F.reverse(s), ".")
    s = F.when(both & comma_last, F.translate(_drop(s, "."), ",", ".")).when(both, _drop(s, ",")).otherwise(F.translate(s, ",", "."))
    return _double(s)


def safe_float(c: Column) -> Column:
    """0.0 where unreadable, NULL or with more than two separators; one separator with up to two digits is decimal."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9.,]", "")
    n = _count(s, ".") + _count(s, ",")
    after = F.length(F.regexp_extract(s, "[.,]([0-9]*)$", 1))
    bare = F.translate(s, ".,", "")
    comma_last = F.instr(F.reverse(s), ",") < F.when(F.instr(F.reverse(s), ".") == 0, 999).otherwise(F.instr(F.reverse(s), "."))
    comma_last = comma_last & (F.instr(s, ",") > 0)
    two = F.when(comma_last, F.translate(_drop(s, "."), ",", ".")).otherwise(_drop(s, ","))
    out = F.when(n == 0, s).when((n == 1) & (after <= 2), F.translate(s, ",", ".")).when(n == 1, bare).when(n == 2, two)
    return F.coalesce(_double(out), F.lit(0.0))


def safe_parse_numeric(c: Column) -> Column:
    """The first acceptable number of a text, 0.0 where there is none; a,bbb,ccc reads as abbb.ccc."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9.,]", "")

    def read(t: Column) -> Column:
        dots, commas = _count(t, "."), _count(t, ",")
        comma_last = F.instr(F.reverse(t), ",") < F.instr(F.reverse(t), ".")
        mixed = F.when(comma_last, F.translate(_drop(t, "."), ",", ".")).otherwise(_drop(t, ","))
        groups = F.when(t.rlike("^[0-9]+(,[0-9]{3}){2,}$"), F.concat(_drop(F.regexp_replace(t, ",[0-9]{3}$", ""), ","), F.lit("."), F.right(t, F.lit(3))))
        value = (
            F.when((dots > 1) & (commas == 0), F.lit(None).cast("string"))
            .when((dots > 0) & (commas > 0), mixed)
            .when((commas > 1) & (dots == 0), groups)
            .otherwise(F.translate(t, ",", "."))
        )
        return _double(F.when(_count(value, ".") <= 1, value))

    tokens = F.regexp_extract_all(s, F.lit(r"([0-9]+(?:[.,][0-9]+)*)"), F.lit(1))
    return F.coalesce(F.get(F.array_compact(F.transform(tokens, read)), F.lit(0)), F.lit(0.0))


def comma_to_dot(c: Column) -> Column:
    return _double(F.translate(c, ",", "."))
