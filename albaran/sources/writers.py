"""Writers: lazy tables to files. Nothing but a report of a few aggregates passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with the NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def to_csv(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """CSV with a header, in the order of columns as far as df has them; nested columns as JSON."""
    kinds = dict(df.dtypes)
    out = [F.to_json(c).alias(c) if kinds[c].startswith(("array", "map", "struct")) else F.col(c) for c in columns if c in kinds]
    df.select(*out).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def by_route(df: DataFrame, path: str, route: str, mode: str = "overwrite", combined: bool = False) -> None:
    """One folder for each route; rows of one route are spread over as many files as there are tasks.

    combined: all routes together, too, in the folder `combined` beside them; the rows are computed for either.
    """
    df.write.mode(mode).partitionBy(route).option("ignoreNullFields", False).json(f"{path}/by_route" if combined else path)
    if combined:
        to_json(df, f"{path}/combined", mode)


#: The fields of a classification with their values where they are missing.
CLASSIFICATION = {
    "document_name": "", "document_type": "unknown", "extraction_method": "manual_review", "classification_confidence": "UNKNOWN",
    "file_size_mb": None, "text_ratio": None, "image_ratio": None, "mixed_ratio": None,
}


def classifications(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The eight fields of classified documents as JSON lines; missing columns and NULLs get the field's default."""
    kind = lambda n: "double" if n.startswith("file") or n.endswith("ratio") else "string"
    own = lambda n, v: F.coalesce(F.col(n), F.lit(v).cast(kind(n))) if n in df.columns else F.lit(v).cast(kind(n))
    to_json(df.select(*[own(n, v).alias(n) for n, v in CLASSIFICATION.items()]), path, mode)


def append_log(df: DataFrame, path: str) -> None:
    """Rows added to the log table (Parquet), with the time of writing."""
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def markdown(title: str, tables: dict[str, DataFrame], most: int = 50) -> str:
    """A report of small aggregate tables; a table's rows past `most` are counted, not listed."""
    out = [f"# {title}"]
    for name, df in tables.items():
        rows = df.limit(most + 1).collect()
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows[:most]]
        if len(rows) > most:
            out.append(f"| ... {df.count() - most} more |")
    return "\n".join(out) + "\n"
