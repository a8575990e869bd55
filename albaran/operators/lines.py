"""Line items out of document texts: one row for each accepted line, in the order of the lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from albaran.functions.fields import specifications
from albaran.functions.numparse import comma_to_dot
from albaran.functions.text import spaced, squash, strip
from albaran.session import settle

# Lines with one of these are no items.
SKIP = "PAGE|INVOICE|FACTURA|DATE:|FECHA:|---|SUBTOTAL|TOTAL|TAX|IVA|PROVEEDOR|SUPPLIER"
# The ways a quantity, a price and a total stand in a line.
QUANTITY = [r"(?i)(?:Qty|Quantity|Cantidad|Cant\.)[:\s]*([\d,.]+)", r"(?i)([\d,.]+)\s*(?:u|un|pcs|kg|m|l|ud|uds|pza|pz)"]
PRICE = [r"(?i)(?:Unit Price|Precio Unitario|Price|Precio)[:\s]*[$€£]?\s*([\d,.]+)", r"[$€£]\s*([\d,.]+)"]
TOTAL = [r"(?i)(?:Total Amount|Total|Monto Total|Importe Total|Total a Pagar)[:\s]*[$€£]?\s*([\d,.]+)"]
CANDIDATE = "qty|quantity|unit price|amount|total|description|\\$|£|€|usd|gbp|eur"
NUMBER_LIKE = r"\b\d{1,3}(?:[.,]\d{3})*(?:[.,]\d{2})?\b"
# Units of measure as the line patterns know them, short forms first.
UNITS = (
    "u|un|unidad|unidades|pz|pza|piezas|ud|uds|u\\.|kg|g|mg|gr|gramo|kilogramo|tonelada|ton|t|l|ml|litro|mililitro|m³|litros|m|cm|mm|metro|centímetro|milímetro|km|m²|cm²|"
    "hectárea|ha|caja|cajas|cj|cx|pack|paquete|lote|rollo|rollos|juego|set|kit|hora|horas|h|día|días|servicio|servicios"
)
SECTION_UNITS = (
    "u|un|unidad|unidades|pz|pza|piezas|ud|uds|u\\.|kg|g|mg|gramo|tonelada|ton|t|l|ml|litro|m³|m|cm|mm|km|m²|cm²|hectárea|ha|caja|cajas|pack|paquete|lote|rollo|juego|set|kit|"
    "hora|horas|h|día|días|servicio|servicios|in|inch"
)
WORDS = r"[A-Za-záéíóúñüAÉÍÓÚÑÜ\s,().\-]"
SPANISH_LINES = [
    rf"(\d+)\s*\|\s*({WORDS}+?)\s*\|\s*(\d+(?:[.,]\d+)?)\s*\|\s*({UNITS})",
    rf"(\d+)\t+({WORDS}+?)\t+(\d+(?:[.,]\d+)?)\t+({UNITS})",
    rf"^(\d{{1,5}})\s+({WORDS}{{5,100}}?)\s+(\d+(?:[.,]\d+)?)\s+({UNITS})$",
    rf"(?:REF|ART|COD)[:\s-]+([A-Z0-9\-]+)\s+({WORDS}+?)\s+(\d+(?:[.,]\d+)?)\s+({UNITS})",
]
SPANISH_LINES = [spaced(p) for p in SPANISH_LINES]
SECTION = rf"(\d{{1,4}})\s+({WORDS}{{10,200}}?)\s+(\d+(?:[.,]\d+)?)\s+({SECTION_UNITS})"
SECTION = spaced(SECTION)


def text_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no from 0, line): the stripped, non-empty lines."""
    each = df.select(F.col(key).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return each.withColumn("line", strip(F.col("line"))).where("line <> ''")


def _first(c: Column, patterns: list[str]) -> Column:
    """The first pattern's number with points for commas; NULL where there is none."""
    return F.coalesce(*[F.nullif(F.translate(F.regexp_extract(c, p, 1), ",", "."), F.lit("")) for p in patterns])


def line_items(df: DataFrame, key: str, text: str, most: int | None = 20, width: int | None = 150) -> DataFrame:
    """(doc, line_no, description, quantity, unit_price, total_price), texts; '' where a value is missing.

    Of equal descriptions (whatever case) the first stays, of each document the first `most` lines, of a description
    the first `width` characters, as the operator is defined; None for all. Documents without items give no row.
    """
    lines = text_lines(df, key, text).where((F.length("line") >= 12) & ~F.upper("line").rlike(SKIP))
    line, cols = F.col("line"), F.col("cols")
    lines = lines.withColumn("cols", F.split("line", r"\s*\|\s*|\t+"))
    cut = (line.contains("|") | line.contains("\t")) & (F.size(cols) >= 3) & F.exists(F.slice(cols, F.lit(2), F.size(cols)), lambda x: x.rlike(r"\d"))
    last, before = F.try_element_at(cols, F.lit(-1)), F.try_element_at(cols, F.lit(-2))
    q, p, t = _first(line, QUANTITY), _first(line, PRICE), _first(line, TOTAL)
    lines = lines.withColumns(
        {
            "d1": F.when(cut, strip(F.get(cols, F.lit(1)))),
            "q1": F.coalesce(q, _first(before, QUANTITY)),
            "p1": F.coalesce(p, _first(last, PRICE)),
            "t1": F.coalesce(t, _first(last, PRICE)),
            "q2": q,
            "p2": p,
            "t2": t,
        }
    )
    one = (F.col("d1") != "") & F.coalesce("q1", "p1", "t1").isNotNull()
    two = line.rlike("[A-Za-z]{5,}") & line.rlike(r"[\d,.]{2,}") & F.coalesce("q2", "p2", "t2").isNotNull()
    way = F.when(F.coalesce(one, F.lit(False)), 1).when(F.coalesce(two, F.lit(False)), 2)
    value = lambda a, b: F.coalesce(F.when(F.col("way") == 1, F.col(a)).otherwise(F.col(b)), F.lit(""))
    got = lines.withColumn("way", way).where("way is not null")
    whole = F.when(F.col("way") == 1, F.col("d1")).otherwise(line)
    got = got.select(
        "doc", "line_no", (whole if width is None else F.substring(whole, 1, width)).alias("description"),
        value("q1", "q2").alias("quantity"), value("p1", "p2").alias("unit_price"), value("t1", "t2").alias("total_price"),
    )
    seen = Window.partitionBy("doc", F.lower("description")).orderBy("line_no")
    first = got.withColumn("n", F.row_number().over(seen)).where("n = 1")
    if most is None:
        return first.drop("n")
    return first.withColumn("n", F.row_number().over(Window.partitionBy("doc").orderBy("line_no"))).where(F.col("n") <= most).drop("n")


def candidate_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, line_no, line) of lines that may hold an item: a keyword or mark, or a number in over 20 characters."""
    lines = text_lines(df, key, text)
    return lines.where(F.lower("line").rlike(CANDIDATE) | (F.col("line").rlike(NUMBER_LIKE) & (F.length("line") > 20)))


def complete_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, line_no, id, description, quantity, unit) of lines that are a whole item: piped, tabbed, spaced or coded."""
    lines = text_lines(df, key, text)
    ways = [F.when(F.col("line").rlike("(?iu)" + p), F.array(*[F.regexp_extract("line", "(?iu)" + p, g) for g in (1, 2, 3, 4)])) for p in SPANISH_LINES]
    got = lines.withColumn("g", F.coalesce(*ways)).where("g is not null")
    return got.select(
        "doc", "line_no", F.get("g", F.lit(0)).alias("id"), squash(F.get("g", F.lit(1))).alias("description"), comma_to_dot(F.get("g", F.lit(2))).alias("quantity"), F.get("g", F.lit(3)).alias("unit")
    )


def with_fallback(df: DataFrame, key: str, text: str) -> DataFrame:
    """complete_lines, and for documents without any their lines of at least three characters as UNKNOWN, 1, u."""
    whole = complete_lines(df, key, text)
    rest = text_lines(df, key, text).where(F.length("line") >= 3).join(whole.select("doc").distinct(), "doc", "left_anti")
    rest = rest.select("doc", "line_no", F.lit("UNKNOWN").alias("id"), F.col("line").alias("description"), F.lit(1.0).alias("quantity"), F.lit("u").alias("unit"))
    return whole.unionByName(rest)


def item_sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, item_no, item_id, description, quantity, unit) of all number-words-number-unit runs of a text."""
    parts = [F.regexp_extract_all(F.col(text), F.lit("(?iu)" + SECTION), F.lit(g)) for g in (1, 2, 3, 4)]
    each = df.select(F.col(key).alias("doc"), F.posexplode(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("a", "b", "c", "d"))])).alias("item_no", "m"))
    out = each.select("doc", "item_no", F.col("m.a").alias("item_id"), squash(F.col("m.b")).alias("description"), comma_to_dot(F.col("m.c")).alias("quantity"), F.lower("m.d").alias("unit"))
    return out.where(F.length("description") > 8)


def item_specifications(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, item_no, item_id, description, specs): of each item of item_sections the keywords in 500 characters from its place.

    The place is the description's first one in the text. A description that white space interrupts has none there; the
    reference reads nothing then, here it is the place of the description as it is written.
    """
    parts = [F.regexp_extract_all(F.col(text), F.lit("(?iu)" + SECTION), F.lit(g)) for g in (1, 2)]
    each = df.select(F.col(key).alias("doc"), F.col(text).alias("_text"), F.posexplode(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("a", "b"))])).alias("item_no", "m"))
    out = each.select("doc", "item_no", F.col("m.a").alias("item_id"), squash(F.col("m.b")).alias("description"), "_text", strip(F.col("m.b")).alias("_raw"))
    place = F.coalesce(*[F.nullif(F.position(F.col(c), F.col("_text")), F.lit(0)) for c in ("description", "_raw")])
    out = settle(out.withColumn("_part", F.substring("_text", place, 500)).drop("_text", "_raw"), "description", "_part")
    return out.where(F.length("description") > 8).select("doc", "item_no", "item_id", "description", specifications(F.col("_part")).alias("specs"))


def unseen_items(texts: DataFrame, tables: DataFrame) -> DataFrame:
    """Items of texts (doc, line_no, description, ...) whose description no table item of the document has; first ones only."""
    fresh = texts.join(tables.select("doc", "description").distinct(), ["doc", "description"], "left_anti")
    w = Window.partitionBy("doc", "description").orderBy("line_no")
    return fresh.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")
