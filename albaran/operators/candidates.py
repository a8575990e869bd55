"""Choosing between several readings of a page, header words, and documents made or spoiled for tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.functions.text import ocr_score, strip
from albaran.operators.documents import is_scanned


def best_readings(readings: DataFrame, least: float = 20.0) -> DataFrame:
    """(document_name, page, method, text, score) of readings (document_name, page, ord, method, text).

    The best score wins, the first of equal ones; if even the best is under `least`, the first reading stands as
    ocr_fallback. One reading is kept for each task and page: the aggregation is combined map-side.
    """
    df = readings.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("score", ocr_score(F.col("text")))
    one = F.struct("method", "text", "score")
    got = df.groupBy("document_name", "page").agg(
        F.max_by(one, F.struct("score", (-F.col("ord")).alias("o"))).alias("best"), F.min_by(one, F.col("ord")).alias("first")
    )
    low = F.col("best.score") < least
    return got.select(
        "document_name", "page", F.when(low, "ocr_fallback").otherwise(F.col("best.method")).alias("method"),
        F.when(low, F.col("first.text")).otherwise(F.col("best.text")).alias("text"), F.col("best.score").alias("score"),
    )


def document_method(best: DataFrame) -> DataFrame:
    """(document_name, method): the method of the best page, the first page of equal ones."""
    return best.groupBy("document_name").agg(F.max_by("method", F.struct("score", (-F.col("page")).alias("p"))).alias("method"))


def header_words(words: DataFrame, share: float = 0.20) -> DataFrame:
    """(document_name, page, header) of words (document_name, page, ord, text, top, height): those in the top fifth."""
    top = words.where(F.col("top") <= F.col("height") * share)
    each = F.array_sort(F.collect_list(F.struct("ord", "text")))
    return top.groupBy("document_name", "page").agg(F.array_join(F.transform(each, lambda x: x["text"]), " ").alias("header"))


def item_issues(items: DataFrame) -> DataFrame:
    """items (id, description, quantity, unit) with issues and is_valid."""
    gone = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    issues = F.array_compact(
        F.array(
            F.when(gone("id"), F.lit("Missing item ID")),
            F.when(F.length(F.coalesce("description", F.lit(""))) < 3, F.lit("Invalid description")),
            F.when(F.coalesce(F.col("quantity"), F.lit(0.0)) <= 0, F.lit("Invalid quantity")),
            F.when(gone("unit"), F.lit("Missing unit")),
        )
    )
    return items.withColumn("issues", issues).withColumn("is_valid", F.size("issues") == 0)


def _chance(key: Column, what: str, seed: int) -> Column:
    """A number from 0 to 99 that depends on the key alone."""
    return F.pmod(F.xxhash64(key, F.lit(what), F.lit(seed)), F.lit(100))


# Characters and what a bad scan makes of them.
LOOKALIKES = [("0", "O"), ("I", "l"), ("S", "5"), ("8", "B"), ("1", "l")]


def degrade(df: DataFrame, key: str, text: str, out: str = "degraded", seed: int = 1) -> DataFrame:
    """df with a spoiled copy of text: each look-alike with 30 %, a line lost or noisy with 10 % each; the same for every run."""
    c = F.col(text)
    for a, b in LOOKALIKES:
        c = F.when(_chance(F.col(key), f"char {a}", seed) < 30, F.translate(c, a, b)).otherwise(c)
    lines = F.transform(F.split(c, "\n"), lambda x, i: F.struct(x.alias("x"), F.pmod(F.xxhash64(F.col(key), i, F.lit(seed)), F.lit(100)).alias("p")))
    kept = F.transform(F.filter(lines, lambda r: r["p"] >= 10), lambda r: F.when(r["p"] < 20, F.concat(r["x"], F.lit(" %%%% @@@"))).otherwise(r["x"]))
    return df.withColumn(out, F.array_join(kept, "\n"))


def invoices(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """(doc_id, category, text): n invoices, every fourth in Spanish; made from the row number alone, at any size."""
    r = spark.range(n).withColumnRenamed("id", "doc_id")
    pick = lambda what, m: F.pmod(F.xxhash64("doc_id", F.lit(what), F.lit(seed)), F.lit(m))
    num = F.format_string("%d%03d", F.lit(2024), (F.col("doc_id") % 1000).cast("int"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), pick("day", 365).cast("int"))
    qty, cents = pick("qty", 100) + 1, pick("price", 499_001) + 1000
    money = lambda c: F.format_string("%d.%02d", (c / 100).cast("long"), (c % 100).cast("long"))
    cur = F.element_at(F.array(*[F.lit(x) for x in ("USD", "EUR", "GBP")]), (pick("cur", 3) + 1).cast("int"))
    sup = F.concat(F.lit("Supplier "), F.element_at(F.split(F.lit("Alba Norte Prisma Vega Delta"), " "), (pick("sup", 5) + 1).cast("int")))
    es = ["Factura #", "Fecha: ", "Número: INV-", "Proveedor: ", "Descripción: Suministro industrial", "Cantidad: ", "Precio: ", "Total: ", "Vencimiento: "]
    en = ["INVOICE #", "Date: ", "Invoice Number: INV-", "Supplier: ", "Description: Industrial Supplies", "Quantity: ", "Unit Price: ", "Total Amount: ", "Due Date: "]
    values = [num, day.cast("string"), num, sup, F.lit(""), qty.cast("string"), F.concat(money(cents), F.lit(" "), cur), F.concat(money(cents * qty), F.lit(" "), cur), F.date_add(day, 30).cast("string")]
    text = lambda labels: F.concat_ws("\n", *[F.concat(F.lit(x), v) for x, v in zip(labels, values)])
    return r.select("doc_id", F.lit("clean").alias("category"), F.when(F.col("doc_id") % 4 == 3, text(es)).otherwise(text(en)).alias("text"))


def specification_sheets(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """(doc_id, category, text): n data sheets of parts; made from the row number alone, at any size."""
    r = spark.range(n).withColumnRenamed("id", "doc_id")
    pick = lambda what, low, high: (F.pmod(F.xxhash64("doc_id", F.lit(what), F.lit(seed)), F.lit(high - low + 1)) + low).cast("string")
    made = F.element_at(F.split(F.lit("Steel Aluminium Brass Composite"), " "), pick("made", 1, 4).cast("int"))
    lines = [
        F.lit("DATA SHEET OF A PART"), F.concat(F.lit("Sheet: SPEC-"), F.lpad((F.col("doc_id") + 1).cast("string"), 4, "0")), F.concat(F.lit("Part Number: PART-"), pick("part", 10000, 99999)),
        F.concat(F.lit("Dimensions: "), pick("w", 100, 500), F.lit(" mm x "), pick("h", 50, 300), F.lit(" mm")), F.concat(F.lit("Weight: "), pick("kg", 1, 50), F.lit(" kg")), F.concat(F.lit("Material: "), made),
        F.concat(F.lit("Temperature: -"), pick("cold", 0, 40), F.lit(" to "), pick("hot", 60, 150), F.lit(" degrees")), F.concat(F.lit("Pressure: "), pick("psi", 100, 1000), F.lit(" PSI")),
    ]
    return r.select("doc_id", F.lit("specification").alias("category"), F.concat_ws("\n", *lines).alias("text"))


#: Documents that checks must stand: without fields, corrupted, hardly any text, read from behind, in two languages.
EDGE = {
    "missing fields": "INVOICE\nDate: 2024-06-24\nQuantity: 50",
    "corrupted": "ÍÑVØÍÇÉ #2024001\nDäté: ¿¿¿¿\nQuäntîty: %%%%\nTötäl: @@@",
    "minimal": "Paper",
    "from behind": "ECIOVNI\n1004202\n:ytitnauQ\n05 :latoT",
    "two languages": "INVOICE 2024001 / FACTURA 2024001\nSupplier / Proveedor: Alba\nQuantity / Cantidad: 5\nTotal: 50.00 EUR",
}


def made_documents(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """(doc_id, category, text): n documents, of nine four clean invoices, two scanned ones, two specifications and one edge case."""
    kind = F.col("doc_id") % 9
    clean = invoices(spark, n, seed)
    sheets = specification_sheets(spark, n, seed)
    edge = F.element_at(F.array(*[F.lit(t) for t in EDGE.values()]), (F.floor(F.col("doc_id") / 9) % len(EDGE) + 1).cast("int"))
    parts = [
        clean.where(kind < 4),
        degrade(clean.where(kind.between(4, 5)), "doc_id", "text", seed=seed).select("doc_id", F.lit("scanned").alias("category"), F.col("degraded").alias("text")),
        sheets.where(kind.between(6, 7)),
        spark.range(n).withColumnRenamed("id", "doc_id").where(kind == 8).select("doc_id", F.lit("edge").alias("category"), edge.alias("text")),
    ]
    return reduce(DataFrame.unionByName, parts)


def text_or_ocr(pages: DataFrame, ocr: DataFrame) -> DataFrame:
    """(document_name, page, text, method): pages whose text is too thin get that of the OCR where it has one.

    pages, ocr: (document_name, page, text). A page that only the OCR has is its page.
    """
    o = ocr.select("document_name", "page", F.nullif(strip(F.col("text")), F.lit("")).alias("_ocr"))
    both = pages.select("document_name", "page", "text").join(o, ["document_name", "page"], "full")
    by_ocr = F.col("_ocr").isNotNull() & F.coalesce(is_scanned(F.col("text")), F.lit(True))
    return both.select("document_name", "page", F.when(by_ocr, F.col("_ocr")).otherwise(F.col("text")).alias("text"), F.when(by_ocr, "ocr").otherwise("text").alias("method"))


def page_header(c: Column, most: int = 10) -> Column:
    """The first ten lines of a page that are not blank, as one: the header where the words have no places."""
    return F.array_join(F.slice(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), 1, most), " ")
