"""Documents: density, pages, text or scanned, route scores, extraction, validation, harness metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.functions.numparse import parse_numeric
from albaran.functions.text import confidence, garbled, squash, strip

# Key words of the two kinds of documents, looked for anywhere in the lower-case text.
PROCUREMENT_WORDS = ["invoice", "factura", "boleta", "purchase order", "orden de compra", "pedido", "po number", "invoice number", "bill", "receipt", "recibo"]
SPECIFICATION_WORDS = [
    "specification", "especificación", "technical sheet", "hoja técnica", "datasheet", "product datasheet", "requirements", "requisitos", "technical details",
    "detalles técnicos", "standard", "norma", "norm",
]
# Words of the text signals of a route, and the markers of the check of texts.
PROCUREMENT_SIGNAL = "total|subtotal|tax|cantidad|precio"
SPECIFICATION_SIGNALS = ("specification|requirement|standard|norm|datasheet|technical|feature|characteristic", "material|dimension|weight|temperature|voltage|current")
MARKERS = {"number": "INVOICE|FACTURA|INV-", "year": "2024|2025", "amount": r"Total|Amount|\$|€|USD|EUR", "quantity": "Quantity|Cantidad"}
CORRUPTED = r"\?|@@@|%%%%"
MISSING_ORDER = ("supplier", "invoice_or_po_number", "issue_date", "currency", "line_items", "subtotal", "tax", "total_amount")
CRITICAL = ("supplier", "invoice_or_po_number", "issue_date", "total_amount")
TOLERANCE = 0.05


def pages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, page from 1, text): the blocks of a text between blank lines stand for its pages; NULL texts give none."""
    p = F.filter(F.split(F.col(text), r"\n[ \t]*\n"), lambda x: strip(x) != "")
    return docs.select(F.col(key).alias("doc"), F.posexplode(p).alias("page", "text")).withColumn("page", F.col("page") + 1)


def text_density(pg: DataFrame) -> DataFrame:
    """(doc, pages, chars, chars_per_page)."""
    return pg.groupBy("doc").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("text")).alias("chars"), F.avg(F.length("text")).alias("chars_per_page"))


def is_scanned(c: Column) -> Column:
    """Under 80 characters or under 30 words."""
    return (F.length(strip(c)) < 80) | (F.size(F.split(squash(c), " ")) < 30)


def page_mix(pg: DataFrame) -> DataFrame:
    """(doc, pages, text_pages, scanned_pages, text_ratio, average_chars)."""
    has = F.length(strip(F.col("text"))) > 50
    return pg.groupBy("doc").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(has).alias("text_pages"),
        F.count_if(is_scanned(F.col("text"))).alias("scanned_pages"),
        F.try_divide(F.count_if(has), F.count(F.lit(1))).alias("text_ratio"),
        F.avg(F.length("text")).alias("average_chars"),
    )


def classify(mix: DataFrame) -> DataFrame:
    """mix with document_type, extraction_method and classification_confidence."""
    text = (F.col("average_chars") > 100) | (F.col("text_ratio") >= 0.5)
    image = 1 - F.col("text_ratio")
    return mix.select(
        "doc",
        F.when(text, "text").otherwise("scanned").alias("document_type"),
        F.when(text, "text_parser").otherwise("ocr_engine").alias("extraction_method"),
        F.when(text | (image > 0.5), "HIGH").otherwise("LOW").alias("classification_confidence"),
    )


def with_classification(docs: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """docs with the document type and method of known (doc, ...); unknown where it has none."""
    k = known.select(F.col("doc").alias("_doc"), "document_type", "extraction_method")
    return docs.join(k, docs[key] == F.col("_doc"), "left").drop("_doc").fillna("unknown", ["document_type", "extraction_method"])


def route_scores(docs: DataFrame, key: str, text: str, record: dict[str, str] | None = None, keep: dict[str, Column] = {}) -> DataFrame:
    """(doc, procurement, specification): scores from 0 to 1 by key words and text signals.

    record: columns supplier, number, date, subtotal, total of an extraction, where there is one; '' and NULL are missing.
    keep: more columns of the result.
    """
    low = F.lower(F.col(text))
    hits = lambda words: sum((F.when(low.contains(w), 1).otherwise(0) for w in words[1:]), F.when(low.contains(words[0]), 1).otherwise(0))
    points = lambda cond, n: F.when(F.coalesce(cond, F.lit(False)), float(n)).otherwise(0.0)
    p = F.least(hits(PROCUREMENT_WORDS) / 2, F.lit(3.0))
    s = F.least(hits(SPECIFICATION_WORDS) / 2, F.lit(3.0))
    if record:
        has = {k: F.coalesce(F.col(v) != "", F.lit(False)) for k, v in record.items()}
        priced = has["subtotal"] | has["total"]
        p = p + points(has["supplier"], 2) + points(has["number"], 2) + points(priced, 2) + points(has["date"], 1)
        s = s + points(~has["supplier"], 1.5) + points(~priced, 2) + points(~has["date"], 1.5)
    p = p + points(low.rlike(PROCUREMENT_SIGNAL), 1)
    s = s + points(low.rlike(SPECIFICATION_SIGNALS[0]), 1)
    s = s + points(low.rlike(SPECIFICATION_SIGNALS[1]), 1)
    return docs.select(F.col(key).alias("doc"), F.least(p / 10, F.lit(1.0)).alias("procurement"), F.least(s / 10, F.lit(1.0)).alias("specification"), *[c.alias(n) for n, c in keep.items()])


def extract(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, supplier, invoice_or_po_number, issue_date, currency, subtotal, tax, total_amount): '' and NULL for missing."""
    c = F.col(text)
    amounts = fx.prices(c)
    return docs.select(
        F.col(key).alias("doc"),
        *[F.coalesce(fx.field(c, f), F.lit("")).alias(n) for n, f in (("supplier", "supplier"), ("invoice_or_po_number", "invoice_po"), ("issue_date", "date"), ("currency", "currency"))],
        fx.labelled_amount(c, "subtotal").alias("subtotal"),
        fx.labelled_amount(c, "tax").alias("tax"),
        F.coalesce(fx.labelled_amount(c, "total"), F.array_max(amounts)).alias("total_amount"),
        F.size(amounts).alias("n_prices"),
        confidence(c).alias("text_quality"),
    )


def missing_fields(n_items: Column) -> Column:
    """The missing fields of an extraction in their fixed order; zero amounts are missing."""
    text = [F.when(F.col(f) == "", F.lit(f)) for f in MISSING_ORDER[:4]]
    amounts = [F.when(F.coalesce(F.col(f), F.lit(0.0)) == 0, F.lit(f)) for f in MISSING_ORDER[5:]]
    return F.array_compact(F.array(*text, F.when(n_items == 0, F.lit("line_items")), *amounts))


def extraction_confidence(missing: Column, quality: Column) -> Column:
    """0..100: share of fields found and half the text quality, less ten for each critical field missing."""
    base = F.floor((8 - F.size(missing)) / 8 * 100)
    bad = F.size(F.array_intersect(missing, F.array(F.lit("supplier"), F.lit("invoice_or_po_number"), F.lit("total_amount")))) * 10
    return F.greatest(F.lit(0), F.least(F.lit(100), base + F.floor(quality * 0.5) - bad)).cast("int")


def validate(df: DataFrame, key: str) -> DataFrame:
    """(key, is_valid, errors, warnings, subtotal_match) of extracted records: strict for texts, lenient for scans.

    Amounts agree within 5 %; message texts name the field or check, without numbers.
    """
    text = F.col("document_type") == "text"
    gone = lambda f: F.coalesce(F.col(f), F.lit("")) == ""
    items = F.coalesce(F.size("line_items"), F.lit(0)) > 0
    st, tx, tot = (parse_numeric(F.nullif(strip(F.col(c)), F.lit(""))) for c in ("subtotal", "tax", "total_amount"))
    calc = st + tx
    known = calc.isNotNull() & tot.isNotNull()
    off = F.try_divide(F.abs(calc - tot), calc)
    match = text & known & (((calc == 0) & (tot == 0)) | ((calc > 0) & (off <= TOLERANCE)) | ((calc <= 0) & (calc == tot)))
    errors = F.array_compact(
        F.array(
            *[F.when(text & gone(f), F.lit(f"missing {f}")) for f in CRITICAL],
            F.when(text & ~items, F.lit("no line items")),
            F.when(text & known & (calc > 0) & (off > TOLERANCE), F.lit("amounts differ")),
        )
    )
    score = F.coalesce(F.col("confidence_score"), F.lit(0))
    scan = F.col("document_type") == "scanned"
    warnings = F.array_compact(
        F.array(
            *[F.when(~text & gone(f), F.lit(f"missing {f}")) for f in CRITICAL],
            F.when(~text & ((score == 0) | ~items), F.lit("nothing extracted")),
            F.when(text & ~known, F.lit("amounts incomplete")),
            F.when(text & known & (calc <= 0) & (calc != tot), F.lit("amounts differ")),
            F.when(scan & (score == 0), F.lit("confidence zero")).when(scan & (score < 20), F.lit("confidence very low")),
        )
    )
    out = df.select(key, errors.alias("errors"), warnings.alias("warnings"), F.coalesce(match, F.lit(False)).alias("subtotal_match"))
    return out.select(key, (F.size("errors") == 0).alias("is_valid"), "errors", "warnings", "subtotal_match")


def ocr_checks(df: DataFrame, key: str) -> DataFrame:
    """(key, confidence_very_low, has_garbled_text, has_missing_rows) of scanned records."""
    return df.where("document_type = 'scanned'").select(
        key,
        (F.coalesce(F.col("confidence_score"), F.lit(0)) < 20).alias("confidence_very_low"),
        F.coalesce(F.exists("line_items", lambda i: F.coalesce(garbled(i["description"]), F.lit(False))), F.lit(False)).alias("has_garbled_text"),
        (F.coalesce(F.size("line_items"), F.lit(0)) == 1).alias("has_missing_rows"),
    )


def schema_violations(df: DataFrame, key: str) -> DataFrame:
    """(key, violation): score outside 0..100, currency that is not three capitals, negative amounts, unknown kinds, lines without description."""
    amount = lambda c: parse_numeric(F.nullif(strip(F.col(c)), F.lit("")))
    rules = {
        "confidence_score range": ~F.col("confidence_score").between(0, 100),
        "currency form": (F.col("currency") != "") & ~F.col("currency").rlike("^[A-Z]{3}$"),
        "negative subtotal": amount("subtotal") < 0,
        "negative tax": amount("tax") < 0,
        "negative total_amount": amount("total_amount") < 0,
        "document_type kind": ~F.col("document_type").isin("text", "scanned", "unknown"),
        "empty description": F.exists("line_items", lambda i: i.isNotNull() & (F.coalesce(i["description"], F.lit("")) == "")),
    }
    hits = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.select(key, F.explode(hits).alias("violation"))


def marker_confidence(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, status, confidence): 25 for each of four markers, less 30 for corrupted texts, 0 for texts of under 20 characters."""
    c = F.coalesce(F.col(text), F.lit(""))
    one = lambda cond: F.when(cond, 25).otherwise(0)
    n = (
        one(F.upper(c).rlike(MARKERS["number"]))
        + one(c.rlike(MARKERS["year"]))
        + one(c.rlike(MARKERS["amount"]))
        + one(c.rlike(MARKERS["quantity"]))
    )
    bad, short = c.rlike(CORRUPTED), F.length(strip(c)) < 20
    status = F.when(short, "FAILED").when(bad, "WARNING").otherwise("SUCCESS")
    score = F.when(short, 0).when(bad, F.greatest(F.lit(0), n - 30)).otherwise(n)
    return docs.select(F.col(key).alias("doc"), "category", status.alias("status"), score.cast("int").alias("confidence"))


def harness_metrics(results: DataFrame, by: list[str]) -> DataFrame:
    """Counts and rates by status, confidence mean, range and exact median of result rows (status, confidence)."""
    kind = lambda s: F.count_if(F.col("status") == s)
    n = F.count(F.lit(1))
    return results.groupBy(*by).agg(
        n.alias("total_files"), kind("SUCCESS").alias("successful"), kind("WARNING").alias("warnings"), kind("FAILED").alias("failed"),
        (F.try_divide(kind("SUCCESS"), n) * 100).alias("success_rate"), (F.try_divide(F.count_if(F.col("confidence") < 70), n) * 100).alias("review_rate"),
        F.avg("confidence").alias("average_confidence"), F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"),
        F.percentile("confidence", F.lit(0.5)).alias("median_confidence"),
    )


def failure_examples(results: DataFrame, most: int = 3) -> DataFrame:
    """(status, n, examples): the first documents of each status that is no success. Only `most` ids a task are kept."""
    bad = results.where("status <> 'SUCCESS'")
    first = bad.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    ranked = bad.withColumn("r", F.row_number().over(Window.partitionBy("status").orderBy("doc"))).where(F.col("r") <= most)
    ids = ranked.groupBy("status").agg(F.array_sort(F.collect_list("doc")).alias("examples"))
    return first.join(ids, "status").select("status", "n", "examples")
