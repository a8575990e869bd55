"""Normalise a column of dates and times against the table of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from albaran.functions import timestamps as ts
from albaran.session import settle


def laid_out(df: DataFrame, value: str, tz_name: str, date_order: str, years: tuple[int, int], out: str) -> DataFrame:
    """df with the columns of all steps of ts.stages. What later steps read many times is computed once, apart from them."""
    for i, step in enumerate(ts.stages(value, tz_name, date_order, years, out)):
        df = df.withColumns(step)
        if i in (1, 2, 5):
            df = settle(df, *step)
    return df


def normalise_dates(rows: DataFrame, value: str, sites: DataFrame, site: str = "site_code", out: str = "norm", years: tuple[int, int] = (2022, 2026)) -> DataFrame:
    """rows with the normal form of the column value in the new column out.

    sites (site_code, tz_name, date_order) is the list of places, a table of fixed size that Spark broadcasts by
    itself when it is small. Rows without a known site keep what needs none. Repeated rows stay repeated.
    """
    places = sites.select(F.col("site_code").alias("_ts_site"), F.col("tz_name").alias("_ts_tz"), F.col("date_order").alias("_ts_order")).dropDuplicates(["_ts_site"])
    df = rows.join(places, rows[site] == places["_ts_site"], "left")
    df = laid_out(df, value, "_ts_tz", "_ts_order", years, out)
    return settle(df.drop(*[c for c in df.columns if c.startswith("_ts_")]), out)
