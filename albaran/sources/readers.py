"""Readers of the kinds of input the engine takes. Schemas are declared, never inferred."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.session import ship

RAW_ITEMS = "pdf_name string, item_id string, original_description string, quantity double, unit string, technical_specifications string"
NORMAL = (
    "document_name string, supplier_name string, item_description string, quantity double, unit_price double, total_price double, currency string, delivery_date string, "
    "purchase_order_number string, unit_of_measurement string, technical_specifications string"
)
LINE_ITEM = "struct<description:string,quantity:string,unit_price:string,total_price:string>"
EXTRACTED = (
    "document_name string, document_type string, supplier string, invoice_or_po_number string, issue_date string, currency string, "
    f"line_items array<{LINE_ITEM}>, subtotal string, tax string, total_amount string, confidence_score int, missing_fields array<string>, extraction_method string, error string"
)
CLASSIFICATION = "document_name string, document_type string, extraction_method string, classification_confidence string, file_size_mb double, text_ratio double, image_ratio double, mixed_ratio double"
PAGES = "document_name string, page int, text string, error string, tables array<array<array<string>>>"

#: A page is its text, or its text and its tables (rows of cells).
PageReader = Callable[[bytes], list[str | tuple[str, list[list[list[str]]]]]]


def text_files(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(file_name, content, size) of whole text files; an empty file gives one row with an empty text."""
    df = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("content"), F.col("_metadata.file_size").alias("size"))


def binary_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(document_name, content, length, input_hash) of files; nothing is collected, sort only where the order shows."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("document_name"), "content", "length", F.sha2("content", 256).alias("input_hash"))


def document_pages(files: DataFrame, reader: PageReader) -> DataFrame:
    """(document_name, page, text, error, tables): pages by a pluggable reader of bytes; a failing file gives one row with its error.

    The reader runs in the Python workers, file by file; it may be a PDF library or OCR, where one is installed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, raw in zip(b["document_name"], b["content"]):
                try:
                    both = [t if isinstance(t, tuple) else (t, []) for t in reader(bytes(raw))]
                    rows = [(name, i, t or "", None, tables) for i, (t, tables) in enumerate(both, 1)]
                except Exception as e:  # one bad file must not end the job
                    rows = [(name, 0, None, f"{type(e).__name__}: {e}"[:500], [])]
                yield pd.DataFrame(rows, columns=["document_name", "page", "text", "error", "tables"])

    ship(files.sparkSession)
    return files.select("document_name", "content").mapInPandas(run, PAGES)


def document_text(pages: DataFrame, separator: str = "\n--- PAGE %d ---\n", most_pages: int | None = None) -> DataFrame:
    """(document_name, text): pages put together in their order, each under its heading; NULL pages are left out.

    The tables of a page, where pages has them, follow its text: a heading for each, a line for each row.
    """
    p = pages.where("text is not null")
    if "tables" in pages.columns:
        row = lambda r: F.concat(F.array_join(r, " | ", ""), F.lit("\n"))
        block = lambda t: F.concat(F.lit("\n--- TABLE ---\n"), F.array_join(F.transform(t, row), ""))
        p = p.withColumn("text", F.concat("text", F.coalesce(F.array_join(F.transform("tables", block), ""), F.lit(""))))
    if most_pages:
        p = p.where(F.col("page") <= most_pages)
    each = F.array_sort(F.collect_list(F.struct("page", "text")))
    whole = F.array_join(F.transform(each, lambda x: F.concat(F.format_string(separator, x["page"]) if "%d" in separator else F.lit(separator), x["text"])), "")
    return p.groupBy("document_name").agg(whole.alias("text"))


def raw_items(spark: SparkSession, path: str) -> DataFrame:
    """The CSV of raw items: quoted fields may hold line breaks and doubled quotes."""
    return spark.read.schema(RAW_ITEMS).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a JSON array (or of one object a file); unreadable records give NULL fields."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def config(path: str) -> dict:
    """A small JSON of settings, on the driver; {} where there is no file."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return {}
