"""Rows of tables and lines of records: items out of cells, arithmetic checks, routes, currencies, units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.functions.numparse import comma_to_dot, parse_numeric
from albaran.functions.text import squash, strip
from albaran.operators.documents import route_scores
from albaran.operators.lines import SECTION_UNITS, item_sections

# The forms of an item's code and of a quantity at the start of a cell.
ITEM_CODE = r"^(?:[A-Z][0-9]{6,}|[A-Z]{3}[0-9]+)"
CELL_QUANTITY = r"^([0-9]+(?:[.,][0-9]+)?)(?:\s|$)"
# Bounds of the checks.
TOLERANCE, SUSPICIOUS, CONFIDENT = 0.05, 10_000, 0.6
# Words of technical lines, for the route, its fallback, and the flag of a specification.
TECHNICAL_LINE = "standard|norm|requirement|specification|feature|technical|temperature|voltage"
TECHNICAL_FALLBACK = "specification|requirement|standard|norm|feature"
TECHNICAL_FLAG = "standard|norm|requirement|specification|complies|comply|feature|technical|temperature|voltage|current|dimensions|weight|material"
# Marks and codes of a currency in a row, in the order they are looked for.
ROW_MARKS, ROW_CODES = "£ $ €".split(), "USD GBP EUR CAD AUD MXN COP ARS".split()
# Lines that may hold an item, by key word; forms of numbers of an invoice.
SHORT_CANDIDATE = "qty|quantity|unit price|total|amount"
INVOICE_FORMS = [
    r"\b(?:invoice(?:\s*no\.?|\s*number|\s*#)?\s*[:\-]?\s*)([A-Z0-9\-\/]+)",
    r"\b(?:po(?:\s*no\.?|\s*number|\s*#)?\s*[:\-]?\s*)([A-Z0-9\-\/]+)",
    r"\b(?:order\s*number\s*[:\-]?\s*)([A-Z0-9\-\/]+)",
    r"\b(?:ref(?:erence)?\s*[:\-]?\s*)([A-Z0-9\-\/]+)",
]
# Classes of units.
UNIT_CLASSES = {
    "piece": r"u|un|unidad|unidades|pz|pza|piezas|ud|uds|u\.",
    "weight": "kg|g|mg|gr|gramo|kilogramo|tonelada|ton|t",
    "volume": "l|ml|litro|mililitro|m³|litros",
    "length": "m|cm|mm|metro|centímetro|milímetro|km",
    "area": "m²|cm²|hectárea|ha",
    "box": "caja|cajas|cj|cx",
    "pack": "pack|paquete|lote",
    "roll": "rollo|rollos",
    "set": "juego|set|kit",
    "hour": "hora|horas|h",
    "day": "día|días",
    "service": "servicio|servicios",
}
# Quantities of a line: decimal, in brackets, with a label, before a unit.
QUANTITY_FORMS = {
    "any": r"(?:^|\s)([0-9]+[.,][0-9]+|[0-9]+)",
    "bracketed": r"[(\[]([0-9]+(?:[.,][0-9]+)?)[)\]]",
    "labelled": r"(?:Cantidad|CANTIDAD|Qty|QTY|Cant\.)[:\s]+([0-9]+(?:[.,][0-9]+)?)",
    "before_unit": r"([0-9]+(?:[.,][0-9]+)?)\s+(?:u|un|unid|Ud|pcs|pz|kg|g|l|ml|m|m²|m³|ud\.|uds\.)",
}
# Descriptions of a line: after a number, after a bullet, after a label.
_D = r"[A-Za-záéíóúñüAÉÍÓÚÑÜ\s,().\-]"
DESCRIPTION_FORMS = {
    "after_id": r"^\s*[0-9]+\s+([A-Za-záéíóúñüAÉÍÓÚÑÜ\s,().]+?)\s*[0-9]+(?:\s*(?:u|un|unid|Ud|pcs|kg|l|ml|m|m²|m³))?\s*$",
    "bulleted": rf"(?:[-•*]|[0-9]+\.|o\))\s+({_D}+?)(?:\s+[0-9]+(?:\s+(?:u|un|unid|Ud|kg|l|m))?)?$",
    "labelled": rf"(?:Descripción|DESCRIPCIÓN|Concepto|CONCEPTO)[:\s]+({_D}+?)(?:$|[0-9])",
}
# Fixed value: a price in a text.
PRICE_IN_TEXT = r"[$€£]?\s*([0-9]+(?:[.,][0-9]{2})?)"


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]", ""))


def table_items(rows: DataFrame) -> DataFrame:
    """(doc, row_no, item_id, description, quantity, unit, specs) of the rows of cells that hold an item.

    rows: (doc, row_no, cells). A row counts if one cell has a number and one has over five characters with over three
    letters; cells of one character are not read. item_id, unit and description are the first cells' of their form; the
    quantity is the first that isn't zero, zero where all are. Rows without description or quantity give nothing;
    descriptions end at 200 characters, as the operator is defined, and specs are read from the first 500 of the row.
    """
    cells = F.col("cells")
    whole = rows.where(F.exists(cells, lambda x: x.rlike("[0-9]")) & F.exists(cells, lambda x: (F.length(x) > 5) & (letters(x) > 3)))
    read = F.filter(cells, lambda x: F.length(x) >= 2)
    first = lambda keep, take=lambda x: x: F.get(F.transform(F.filter(read, keep), take), F.lit(0))
    unit = rf"(?iu)({SECTION_UNITS})"
    numbers = F.transform(F.filter(read, lambda x: x.rlike(CELL_QUANTITY)), lambda x: comma_to_dot(F.regexp_extract(x, CELL_QUANTITY, 1)))
    quantity = F.coalesce(F.get(F.filter(numbers, lambda v: v != 0), F.lit(0)), F.get(numbers, F.lit(0)))
    got = whole.select(
        "doc", "row_no",
        F.coalesce(first(lambda x: x.rlike(ITEM_CODE)), F.lit("")).alias("item_id"),
        F.substring(first(lambda x: (F.length(x) > 10) & (letters(x) > 5)), 1, 200).alias("description"),
        quantity.alias("quantity"),
        F.coalesce(first(lambda x: x.rlike(unit), lambda x: F.regexp_extract(x, unit, 1)), F.lit("")).alias("unit"),
        fx.specifications(F.array_join(cells, " | ")).alias("specs"),
    )
    return got.where("description is not null and quantity is not null")


def document_items(rows: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, source, item_id, description, quantity, unit): items of the tables, and of the texts those that no table has.

    An item of a text has no id here; of equal descriptions of a document's text the first counts.
    """
    t = table_items(rows)
    x = item_sections(docs, key, text)
    fresh = x.join(t.select("doc", "description").distinct(), ["doc", "description"], "left_anti")
    first = fresh.withColumn("_n", F.row_number().over(Window.partitionBy("doc", "description").orderBy("item_no"))).where("_n = 1")
    one = lambda df, source, item: df.select("doc", F.lit(source).alias("source"), item.alias("item_id"), "description", "quantity", "unit")
    return one(t, "table", F.col("item_id")).unionByName(one(first, "text", F.lit("")))


def line_checks(records: DataFrame, key: str, items: str = "line_items") -> DataFrame:
    """(key, line_number, description, is_valid, matches_price, issues) of each line item: quantity x price = total.

    A quantity above 10,000 is suspicious; amounts agree within 5 %; matches_price is NULL where an amount is missing.
    NULL items have no row but keep their number; descriptions end at 50 characters, as the operator is defined.
    """
    at = records.select(key, F.posexplode(items).alias("_at", "_i")).where(F.col("_i").isNotNull())
    number = lambda n: parse_numeric(F.nullif(strip(F.col(f"_i.{n}")), F.lit("")))
    at = at.select(key, (F.col("_at") + 1).alias("line_number"), F.substring(F.coalesce("_i.description", F.lit("")), 1, 50).alias("description"), *[number(n).alias(a) for n, a in (("quantity", "_q"), ("unit_price", "_p"), ("total_price", "_t"))])
    q, p, t = F.col("_q"), F.col("_p"), F.col("_t")
    made = q * p
    whole = q.isNotNull() & p.isNotNull() & t.isNotNull()
    match = F.when(whole, F.when((t == 0) & (made == 0), True).when(made > 0, F.abs(made - t) / made <= TOLERANCE).otherwise(made == t))
    some = lambda c: F.coalesce(c != 0, F.lit(False))
    odd, torn = F.coalesce(q > SUSPICIOUS, F.lit(False)), ~whole & (some(q) | some(p) | some(t))
    off = F.coalesce(~match, F.lit(False))
    issues = F.array_compact(F.array(F.when(odd, F.lit("suspicious quantity")), F.when(off, F.lit("price mismatch")), F.when(torn, F.lit("incomplete price data"))))
    return at.select(key, "line_number", "description", (~odd & ~off).alias("is_valid"), match.alias("matches_price"), issues.alias("issues"))


def page_kinds(pages: DataFrame) -> DataFrame:
    """(doc, pages, text_pages, image_pages, mixed_pages, their ratios to two places, average_chars). pages: (doc, page, text, images)."""
    has, pictured = F.length(strip(F.col("text"))) > 50, F.col("images") > 0
    n = F.count(F.lit(1))
    kinds = {"text": has & ~pictured, "image": ~has & pictured, "mixed": has & pictured}
    return pages.groupBy("doc").agg(
        n.alias("pages"),
        *[F.count_if(c).alias(f"{k}_pages") for k, c in kinds.items()],
        *[F.round(F.count_if(c) / n, 2).alias(f"{k}_ratio") for k, c in kinds.items()],
        F.avg(F.length("text")).alias("average_chars"),
    )


def classify_kinds(kinds: DataFrame) -> DataFrame:
    """(doc, document_type, extraction_method, classification_confidence) by the pages' kinds; NULL counts mean unreadable."""
    text = (F.col("average_chars") > 100) | (F.col("text_pages") / F.col("pages") >= 0.5)
    r = lambda k: F.col(f"{k}_pages") / F.col("pages")
    sure = F.when(text, F.when(r("mixed") > 0.3, "MEDIUM").otherwise("HIGH")).when(r("image") > 0.5, "HIGH").when((r("mixed") > r("text")) & (r("mixed") > r("image")), "MEDIUM").otherwise("LOW")
    lost = F.col("pages").isNull()
    return kinds.select(
        "doc",
        F.when(lost, "unknown").when(text, "text").otherwise("scanned").alias("document_type"),
        F.when(lost, "manual_review").when(text, "text_parser").otherwise("ocr_engine").alias("extraction_method"),
        F.when(lost, "LOW").otherwise(sure).alias("classification_confidence"),
    )


def with_technical(scores: DataFrame, lines: Column) -> DataFrame:
    """scores with two points of ten more for a specification whose lines have technical words."""
    more = F.when(F.coalesce(F.lower(lines).rlike(TECHNICAL_LINE), F.lit(False)), 0.2).otherwise(0.0)
    return scores.withColumn("specification", F.least(F.col("specification") + more, F.lit(1.0)))


def routed(scores: DataFrame, supplier: Column, priced: Column, lines: Column) -> DataFrame:
    """scores with route, confidence and confident: the higher score; a tie goes by supplier, price and technical lines."""
    p, s = F.col("procurement"), F.col("specification")
    named = F.coalesce(supplier != "", F.lit(False))
    technical = F.coalesce(F.lower(lines).rlike(TECHNICAL_FALLBACK), F.lit(False))
    route = F.when(p > s, "procurement").when(s > p, "specification").when(named | priced, "procurement").when(technical | ~priced, "specification").otherwise("procurement")
    sure = F.when(p != s, F.greatest(p, s)).otherwise(F.lit(0.6))
    return scores.withColumns({"route": route, "confidence": sure, "confident": sure >= CONFIDENT})


def row_currency(cells: Column, document: Column) -> Column:
    """The first mark or code in a row's cells, cell by cell; the document's currency where there is none."""
    one = lambda x: F.coalesce(*[F.when(x.contains(m), F.lit(m)) for m in ROW_MARKS], *[F.when(F.upper(x).contains(c), F.lit(c)) for c in ROW_CODES])
    return F.coalesce(F.get(F.array_compact(F.transform(cells, one)), F.lit(0)), document)


def unit_class(c: Column) -> Column:
    """Class of a unit that is one of its forms; NULL for others."""
    low = F.lower(strip(c))
    return F.coalesce(*[F.when(low.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in UNIT_CLASSES.items()])


def price_in_text(c: Column) -> Column:
    """The first number of a text, two decimals at most; NULL where there is none."""
    return comma_to_dot(F.nullif(F.regexp_extract(c, PRICE_IN_TEXT, 1), F.lit("")))


def invoice_form(c: Column) -> Column:
    """Number after invoice, po, order number or ref, the first form that occurs; NULL where none does."""
    return F.coalesce(*[F.nullif(squash(F.regexp_extract(c, "(?i)" + p, 1)), F.lit("")) for p in INVOICE_FORMS])


def technical(c: Column) -> Column:
    return F.coalesce(F.lower(c).rlike(TECHNICAL_FLAG), F.lit(False))


def route_records(records: DataFrame, key: str, text: str, record: dict[str, str], priced: Column, lines: str = "lines") -> DataFrame:
    """(doc, procurement, specification, route, confidence, confident) of extracted records with all signals.

    record: columns supplier, number, date, subtotal, total; lines: the descriptions of the items as one text.
    """
    scores = route_scores(records, key, text, record, {"_lines": F.col(lines), "_supplier": F.col(record["supplier"]), "_priced": priced})
    done = routed(with_technical(scores, F.col("_lines")), F.col("_supplier"), F.col("_priced"), F.col("_lines"))
    return done.drop("_lines", "_supplier", "_priced")
