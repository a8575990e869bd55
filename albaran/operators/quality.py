"""Quality of records: presence, completeness, record checks, group counts, field measures, normalising and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.functions.numparse import safe_float
from albaran.functions.text import clean_text, repair_zero_l, squash, strip
from albaran.operators.tables import is_header_like

# The fields a line record must have; known spellings of suppliers.
REQUIRED = ("supplier_name", "invoice_or_po_number", "item_description", "quantity", "unit_price", "total_amount", "currency")
SUPPLIERS = {
    "ACME": ["ACME", "ACME INC", "ACME CORP"],
    "SIEMENS": ["SIEMENS", "SIEMENS AG", "SIEMENS GMBH"],
    "PHILIPS": ["PHILIPS", "PHILIPS LIGHTING", "PHILIPS ELECTRONICS"],
    "BOSCH": ["BOSCH", "BOSCH GMBH", "ROBERT BOSCH"],
}
SUPPLIER_LABELS = ("Suministrado por", "Proveedor", "Fabricante", "Marca")


def present(df: DataFrame, name: str) -> Column:
    """Not NULL, and not blank if it is a text. Zero is present."""
    c = F.col(name)
    return c.isNotNull() & (strip(c) != "") if dict(df.dtypes)[name] == "string" else c.isNotNull() & ~F.isnan(c.cast("double"))


def classified(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """df with missing_fields (in order) and quality_classification: VALID, PARTIAL (up to two missing) or INVALID."""
    missing = F.array_compact(F.array(*[F.when(~present(df, f), F.lit(f)) for f in required]))
    n = F.size("missing_fields")
    return df.withColumn("missing_fields", missing).withColumn("quality_classification", F.when(n == 0, "VALID").when(n <= 2, "PARTIAL").otherwise("INVALID"))


def quality_report(df: DataFrame, by: list[str] | None = None, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """One row (or one for each group): records by class and completeness; nulls for no records."""
    c = classified(df, required)
    kind = lambda k: F.count_if(F.col("quality_classification") == k)
    return c.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total_records"),
        kind("VALID").alias("valid_records"),
        kind("PARTIAL").alias("partial_records"),
        kind("INVALID").alias("invalid_records"),
        F.try_divide(F.sum(len(required) - F.size("missing_fields")), F.count(F.lit(1)) * len(required)).alias("completeness_score"),
    )


def missing_summary(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """(field, missing): one scan, then a row for each field."""
    sums = df.agg(*[F.count_if(~present(df, f)).alias(f) for f in required])
    return sums.unpivot([], list(required), "field", "missing")


def completeness(df: DataFrame, names: list[str]) -> DataFrame:
    """(field, percent): share of values that are not NULL; '' counts as filled."""
    sums = df.agg(*[(F.try_divide(F.count(n), F.count(F.lit(1))) * 100).alias(n) for n in names])
    return sums.unpivot([], names, "field", "percent")


def quality_level(df: DataFrame, names: list[str]) -> DataFrame:
    """Mean completeness of the fields and its level."""
    c = completeness(df, names).agg(F.avg("percent").alias("average"))
    a = F.col("average")
    return c.withColumn("level", F.when(a >= 80, "EXCELLENT").when(a >= 60, "GOOD").when(a >= 40, "FAIR").otherwise("POOR"))


def record_checks(df: DataFrame, key: str, description: str, quantity: str) -> DataFrame:
    """(key, errors, classification): numeric or header-like description, quantity that is no simple whole number."""
    d, q = F.coalesce(squash(F.col(description)), F.lit("")), F.coalesce(squash(F.col(quantity)), F.lit(""))
    digits = F.regexp_replace(d, "[^0-9]", "")
    numeric = (digits != "") & (digits == F.replace(d, F.lit(" "), F.lit("")))
    simple = q.rlike("^[0-9]+$") & (safe_float(q) > 0)
    errors = F.array_compact(
        F.array(
            F.when(numeric, F.lit("Description is numeric-only.")).when((d != "") & is_header_like(d), F.lit("Description appears header-like.")),
            F.when((q != "") & ~simple, F.lit("Quantity is not a simple integer like 1 or 01.")),
        )
    )
    return df.select(F.col(key), errors.alias("errors")).withColumn("classification", F.when(F.size("errors") == 0, "VALID").otherwise("INVALID"))


def group_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """(field, value, n): how often each value of each field occurs; counted map-side, one shuffle for all fields."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value")) for n in names])).alias("x"))
    return long.groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("n"))


def measures(df: DataFrame, value: Column) -> DataFrame:
    """One row: sum, mean, least, greatest and number of a numeric value."""
    return df.select(value.alias("v")).agg(F.sum("v").alias("total"), F.avg("v").alias("average"), F.min("v").alias("least"), F.max("v").alias("greatest"), F.count("v").alias("n"))


def diagnostics(df: DataFrame, document: str, supplier: str, number: str, description: str, quantity: str, price: str, total: str, currency: str) -> DataFrame:
    """One row for each document: missing shares, whether all it has is header data, whether values are scattered."""
    p = lambda n: present(df, n)
    filled = lambda n: p(n) & (F.col(n).cast("string") != "0.0")
    pct = lambda n: F.try_divide(F.count_if(~p(n)), F.count(F.lit(1))) * 100
    rows = df.groupBy(F.col(document).alias("document")).agg(
        F.count(F.lit(1)).alias("total_records"),
        pct(supplier).alias("missing_supplier_pct"),
        pct(price).alias("missing_price_pct"),
        pct(currency).alias("missing_currency_pct"),
        pct(number).alias("missing_number_pct"),
        F.bool_or(filled(supplier) | filled(number)).alias("header_present"),
        F.count_if(~filled(description) & ~filled(quantity) & ~filled(total)).alias("empty_items"),
        (F.bool_or(p(supplier)).cast("int") + F.bool_or(p(price)).cast("int") + F.bool_or(p(currency)).cast("int") + F.bool_or(p(number)).cast("int")).alias("fields_seen"),
    )
    header_only = F.col("header_present") & (F.col("empty_items") >= F.greatest(F.lit(1), F.floor(F.col("total_records") * 0.6)))
    return rows.withColumn("issue", F.when(header_only, "HEADER_ONLY_DATA").otherwise("SCATTERED_VALUES")).drop("header_present", "empty_items")


def normalise(raw: DataFrame) -> DataFrame:
    """Raw items to normal records: cleaned texts, currency and date found in the description; NULL for missing."""
    d = clean_text(F.col("original_description"))
    return raw.select(
        "raw_id",
        clean_text(F.col("pdf_name")).alias("document_name"),
        d.alias("item_description"),
        F.col("quantity"),
        fx.currency_short(d).alias("currency"),
        fx.raw_date(d).alias("delivery_date"),
        clean_text(F.col("item_id")).alias("purchase_order_number"),
        clean_text(F.col("unit")).alias("unit_of_measurement"),
        clean_text(F.col("technical_specifications")).alias("technical_specifications"),
    )


def supplier_from_text(c: Column) -> Column:
    """A known supplier named in the text, else what follows a label; NULL where there is neither."""
    known = [F.when(F.upper(c).contains(v), F.lit(k)) for k, vs in SUPPLIERS.items() for v in vs]
    names = r"([A-Za-záéíóúñüAÉÍÓÚÑÜ\s&,.]+?)(?:\n|$)"
    labelled = [F.nullif(strip(F.regexp_extract(c, rf"(?i){w}[:\s]+{names}", 1)), F.lit("")) for w in SUPPLIER_LABELS]
    return F.coalesce(*known, *labelled)


def supplier_dictionary(spark) -> DataFrame:
    """(variant, standard) of the known spellings: a fixed table."""
    rows = [(v, k) for k, vs in SUPPLIERS.items() for v in vs]
    return spark.createDataFrame(rows, "variant string, standard string")


def standard_suppliers(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, supplier, standard): the dictionary's name of an exact spelling, whatever its case; NULL where unknown."""
    own = df.select(key, clean_text(F.col(name)).alias("supplier"))
    table = F.broadcast(supplier_dictionary(df.sparkSession))  # twelve rows
    return own.join(table, F.upper("supplier") == table["variant"], "left").select(key, "supplier", "standard")


def quantity_note(c: Column) -> Column:
    return F.when(c == 0, "quantity_is_zero").when(c > 1_000_000, "quantity_unusually_high").when(c < 0, "quantity_negative")


def clean(df: DataFrame) -> DataFrame:
    """Normal records to clean ones; every value keeps its entered twin in `raw`."""
    d = repair_zero_l(clean_text(F.col("item_description")))
    cur = fx.currency_by_map(F.col("currency"))
    q = F.when(~F.isnan("quantity"), F.col("quantity"))
    return df.select(
        "line_id",
        clean_text(F.col("document_name")).alias("document_name"),
        F.coalesce(clean_text(F.col("supplier_name")), supplier_from_text(F.col("item_description"))).alias("supplier_name"),
        d.alias("item_description"),
        q.alias("quantity"),
        quantity_note(q).alias("quantity_notes"),
        cur["code"].alias("currency"),
        cur["name"].alias("currency_name"),
        cur["raw"].alias("currency_raw_match"),
        clean_text(F.col("unit_of_measurement")).alias("unit_of_measurement"),
        F.struct("supplier_name", "item_description", "quantity", "currency", "unit_of_measurement").alias("raw"),
    )


#: The fields of a normal record, in order.
RECORD = ("document_name", "supplier_name", "item_description", "quantity", "unit_price", "total_price", "currency", "delivery_date", "purchase_order_number", "unit_of_measurement", "technical_specifications")


def clean_records(df: DataFrame, key: str) -> DataFrame:
    """All eleven fields of normal records, cleaned, each with its entered twin `raw_value:<name>`, and the notes.

    The supplier is the dictionary's name of the entered one or of one that the description names; the currency is the
    first that the cleaned description names; a quantity that is no number is noted as such. NULL for missing.
    """
    text = {n: clean_text(F.col(n)) for n in RECORD if n not in ("quantity", "unit_price", "total_price", "currency")}
    named = F.coalesce(text["supplier_name"], clean_text(supplier_from_text(F.col("item_description"))))
    text["item_description"] = repair_zero_l(text["item_description"])
    number = ~F.isnan("quantity")
    cleaned = df.select(
        key, *[F.col(n).alias(f"raw_value:{n}") for n in RECORD], *[c.alias(n) for n, c in text.items() if n != "supplier_name"], named.alias("_named"),
        F.when(number, F.col("quantity")).alias("quantity"), F.when(number, quantity_note(F.col("quantity"))).when(~number, "failed_numeric_conversion").alias("quantity_notes"), "unit_price", "total_price",
    )
    known = F.broadcast(supplier_dictionary(df.sparkSession).withColumnRenamed("variant", "_variant"))  # twelve rows
    cleaned = cleaned.join(known, F.upper("_named") == F.col("_variant"), "left").withColumn("_c", fx.currency_by_map(F.col("item_description")))
    return cleaned.select(
        key, *[c for n in RECORD for c in ({"supplier_name": F.coalesce("standard", "_named").alias(n), "currency": F.col("_c.code").alias(n)}.get(n, F.col(n)), F.col(f"`raw_value:{n}`"))],
        F.col("_c.name").alias("currency_name"), F.col("_c.raw").alias("currency_raw_match"), "quantity_notes",
    )


def cleaning_report(df: DataFrame) -> DataFrame:
    """(field, found, distinct_values, nulls) of a clean table: one scan, values counted map-side before they are counted again."""
    names = ["supplier_name", "quantity", "currency", "item_description", "purchase_order_number"]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value")) for n in names]))
    counts = df.select(each.alias("x")).groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("n"))
    there = F.col("value").isNotNull()
    sums = counts.groupBy("field").agg(F.sum(F.when(there, F.col("n")).otherwise(0)).alias("found"), F.count("value").alias("distinct_values"), F.sum(F.when(there, 0).otherwise(F.col("n"))).alias("nulls"))
    fields = df.sparkSession.createDataFrame([(n,) for n in names], "field string")
    return fields.join(sums, "field", "left").fillna(0)
