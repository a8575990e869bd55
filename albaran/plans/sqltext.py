"""Fragments of ANSI SQL for the twins of the column builders."""

from __future__ import annotations

from albaran.functions.text import SPACE


def q(pattern: str) -> str:
    """A pattern as an SQL string."""
    return "'" + pattern.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {q(f'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def squash(c: str) -> str:
    return f"trim(regexp_replace({c}, {q(f'{SPACE}+')}, ' ', 'g'))"


def clean(c: str) -> str:
    return f"nullif({squash(c)}, '')"


def has(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {q(pattern)})"


def group(c: str, pattern: str, n: int = 1) -> str:
    return f"regexp_extract({c}, {q(pattern)}, {n})"


def every(c: str, pattern: str, n: int = 0) -> str:
    return f"regexp_extract_all({c}, {q(pattern)}, {n})"


def sub(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, {q(pattern)}, {q(to)}, 'g')"


def count(c: str, pattern: str) -> str:
    return f"len({every(c, pattern)})"


def marks(c: str, mark: str) -> str:
    return f"(length({c}) - length(replace({c}, '{mark}', '')))"


def words(c: str) -> str:
    return f"(CASE WHEN {squash(c)} = '' THEN 0 ELSE len(string_split({squash(c)}, ' ')) END)"


def safe_float(c: str) -> str:
    s = sub(f"coalesce({c}, '')", "[^0-9.,]")
    n = f"({marks(s, '.')} + {marks(s, ',')})"
    after = f"length({group(s, '[.,]([0-9]*)$')})"
    comma_last = f"(instr({s}, ',') > 0 AND instr(reverse({s}), ',') < CASE WHEN instr({s}, '.') = 0 THEN 999 ELSE instr(reverse({s}), '.') END)"
    two = f"CASE WHEN {comma_last} THEN replace(replace({s}, '.', ''), ',', '.') ELSE replace({s}, ',', '') END"
    out = f"CASE WHEN {n} = 0 THEN {s} WHEN {n} = 1 AND {after} <= 2 THEN replace({s}, ',', '.') WHEN {n} = 1 THEN replace(replace({s}, '.', ''), ',', '') WHEN {n} = 2 THEN {two} END"
    return f"coalesce(try_cast({out} AS DOUBLE), 0.0)"


def parse_numeric(c: str) -> str:
    s = sub(c, "[^0-9.,-]")
    both = f"(instr({s}, '.') > 0 AND instr({s}, ',') > 0)"
    last = f"instr(reverse({s}), ',') < instr(reverse({s}), '.')"
    out = f"CASE WHEN {both} AND {last} THEN replace(replace({s}, '.', ''), ',', '.') WHEN {both} THEN replace({s}, ',', '') ELSE replace({s}, ',', '.') END"
    return f"try_cast({out} AS DOUBLE)"


def legacy_steps(c: str) -> str:
    """Nested steps of the legacy parser as one scalar subquery."""
    s = sub(f"replace(translate({c}, 'Oo', '00'), ' ', '')", "[^0-9.,]")
    return f"""(SELECT try_cast(replace(s3, ',', '.') AS DOUBLE) FROM (SELECT CASE WHEN instr(s2, '.') > 0 AND instr(s2, ',') > instr(s2, '.') THEN replace(s2, ',', '') ELSE s2 END s3 FROM (
      SELECT CASE WHEN {marks('s1', ',')} > 1 AND {marks('s1', '.')} = 1 THEN replace(s1, ',', '') ELSE s1 END s2 FROM (
      SELECT CASE WHEN {marks('s0', '.')} > 1 AND {marks('s0', ',')} = 1 THEN replace(s0, '.', '') ELSE s0 END s1 FROM (SELECT {s} s0)))))"""


def first_of(c: str, patterns: list[str], flags: str = "(?im)") -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN length({strip(group(c, flags + p))}) BETWEEN 2 AND 200 THEN {strip(group(c, flags + p))} END" for p in patterns) + ")"


LINES = f"""lines AS (SELECT doc, line_no, line FROM (SELECT doc_id doc, generate_subscripts(string_split(text, chr(10)), 1) - 1 line_no,
  {strip("unnest(string_split(text, chr(10)))")} line FROM documents) WHERE line <> '')"""
