"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from albaran.plans import more, problems, records, texts

QUERIES = {**problems.QUERIES, **texts.QUERIES, **records.QUERIES, **more.QUERIES}
SQL = {**problems.SQL, **texts.SQL, **records.SQL, **more.SQL}
FLAGSHIP = texts.line_items
