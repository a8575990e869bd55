"""Items of table rows, line checks, routes and forms: nulls, empties, ties and long rows."""

import pytest
from pyspark.sql import functions as F

from albaran import session
from albaran.operators import lines as L
from albaran.operators import rows as R
from albaran.operators import tables as T

ITEM = "array<struct<description:string,quantity:string,unit_price:string,total_price:string>>"


def test_line_checks(spark):
    rows = [
        (1, [("a" * 60, "2", "5", "10"), None, ("b", "2", "5", "10.6"), ("c", "20000", "1", "20000"), ("d", "", "5", "10"), ("e", "0", "5", "0"), ("f", None, None, ""), (None, "-1", "5", "-5")]),
        (2, None), (3, []),
    ]
    got = {(r.id, r.line_number): (len(r.description), r.is_valid, r.matches_price, r.issues) for r in R.line_checks(spark.createDataFrame(rows, f"id int, line_items {ITEM}"), "id").collect()}
    assert got == {
        (1, 1): (50, True, True, []), (1, 3): (1, False, False, ["price mismatch"]), (1, 4): (1, False, True, ["suspicious quantity"]), (1, 5): (1, True, None, ["incomplete price data"]),
        (1, 6): (1, True, True, []), (1, 7): (1, True, None, []), (1, 8): (0, True, True, []),
    }


def test_table_items(spark):
    rows = [
        (1, 0, ["S1234567", "steel pipe for water", "0", "12,5 kg", "x"]), (1, 1, ["a", "b"]), (1, 2, []), (1, 3, None), (1, 4, ["longer description", "no number"]),
        (1, 5, ["ABC12", "short", "7"]), (1, 6, ["", "other steel pipe here", "00", None]), (2, 0, ["y" * 300, "3 cajas"]),
    ]
    got = {(r.doc, r.row_no): (r.item_id, len(r.description), r.quantity, r.unit) for r in R.table_items(spark.createDataFrame(rows, "doc int, row_no int, cells array<string>")).collect()}
    assert got == {(1, 0): ("S1234567", 20, 12.5, "t"), (1, 6): ("", 21, 0.0, "t"), (2, 0): ("", 200, 3.0, "caja")}
    assert R.table_items(spark.createDataFrame([], "doc int, row_no int, cells array<string>")).count() == 0


def test_ties_of_routes(spark):
    rows = [(1, 0.5, 0.5, "x", False, ""), (2, 0.5, 0.5, "", True, ""), (3, 0.5, 0.5, None, False, "a NORM"), (4, 0.5, 0.5, "", False, None), (5, 0.2, 0.1, "", False, ""), (6, 0.1, 0.7, "x", True, "")]
    df = spark.createDataFrame(rows, "doc int, procurement double, specification double, s string, p boolean, l string")
    got = {r.doc: (r.route, r.confidence, r.confident) for r in R.routed(df, F.col("s"), F.col("p"), F.col("l")).collect()}
    assert got == {
        1: ("procurement", 0.6, True), 2: ("procurement", 0.6, True), 3: ("specification", 0.6, True), 4: ("specification", 0.6, True), 5: ("procurement", 0.2, False), 6: ("specification", 0.7, True)
    }


def test_kinds_of_pages(spark):
    t = "word " * 30
    pages = [(1, 1, t, 0), (1, 2, t, 1), (2, 1, "", 2), (2, 2, "", 1), (3, 1, "y" * 60, 1), (3, 2, "", 0), (3, 3, "", 0), (4, 1, "", 0)]
    kinds = R.page_kinds(spark.createDataFrame(pages, "doc int, page int, text string, images int"))
    all_ = spark.createDataFrame([(i,) for i in range(1, 6)], "doc int").join(kinds, "doc", "left")
    got = {r.doc: (r.document_type, r.classification_confidence) for r in R.classify_kinds(all_).collect()}
    assert got == {1: ("text", "MEDIUM"), 2: ("scanned", "HIGH"), 3: ("scanned", "MEDIUM"), 4: ("scanned", "LOW"), 5: ("unknown", "LOW")}


def test_rows_longer_than_the_old_bounds(spark):
    wide = spark.createDataFrame([(["c"] * 10_050,)], "cells array<string>")
    folded = wide.select(T.normalise_row(F.col("cells"), 3).alias("x")).first().x
    assert folded[:2] == ["c", "c"] and len(folded[2]) == 2 * 10_048 - 1
    line = " | ".join(["id", "some long words"] + ["w"] * 10_010 + ["Qty: 5"])
    assert L.line_items(spark.createDataFrame([(1, line)], "doc_id int, text string"), "doc_id", "text").count() == 1


def test_a_cluster_needs_a_shared_checkpoint_folder():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        session.checkpoint_folder(Session())


def test_parsed_rows(spark):
    rows = [(1, 0, ["Description", "Qty", "Unit Price", "Total"]), (1, 1, ["galvanised steel pipes", "2", "$ 5.50", "$ 11.00"]), (1, 2, ["12", "", "", ""]), (1, 3, ["", "", "", ""]), (2, 0, ["blue cable on wooden drums", "3", "4.25", "12.75"])]
    df = spark.createDataFrame(rows, "doc int, row_no int, cells array<string>")
    schema = spark.createDataFrame([(1, 0, 1, None, 3)], "doc int, description int, quantity int, unit_price int, total_amount int")
    got = {(r.doc, r.row_no): (r.description, r.quantity, r.unit_price, r.total_amount) for r in T.parse_rows(df, schema).collect()}
    assert got[(1, 1)][0] == "galvanised steel pipes" and got[(1, 1)][1] == "2" and got[(1, 1)][3] == "$ 11.00"
    assert got[(2, 0)] == ("blue cable on wooden drums", "3", "4.25", "12.75") and (1, 0) not in got and (1, 3) not in got
    assert T.parse_rows(df.limit(0), schema).count() == 0
