"""Readings, header words, generated and spoiled documents."""

from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.operators import candidates as C
from albaran.operators import documents as D
from albaran.operators import lines as L


def test_best_readings(spark):
    good = "INVOICE total 123.45 supplier date quantity"
    rows = [("a", 1, 0, "raw", "zzzzzzzzzzzzzzzzzzzzzzzz @@@@@@@@"), ("a", 1, 1, "enhanced", good), ("a", 2, 0, "raw", good), ("a", 2, 1, "enhanced", good), ("b", 1, 0, "raw", None), ("b", 1, 1, "enhanced", "short")]
    best = C.best_readings(spark.createDataFrame(rows, "document_name string, page int, ord int, method string, text string"))
    got = {(r.document_name, r.page): (r.method, r.text) for r in best.collect()}
    assert got == {("a", 1): ("enhanced", good), ("a", 2): ("raw", good), ("b", 1): ("ocr_fallback", "")}
    assert {r.document_name: r.method for r in C.document_method(best).collect()} == {"a": "enhanced", "b": "ocr_fallback"}


def test_header_words_and_block(spark):
    w = spark.createDataFrame([("a", 1, 2, "B", 10.0, 100.0), ("a", 1, 1, "A", 20.0, 100.0), ("a", 1, 3, "C", 20.5, 100.0)], "document_name string, page int, ord int, text string, top double, height double")
    assert C.header_words(w).first().header == "A B"
    df = spark.createDataFrame([("SCOPE OF WORK\nACME TOOLS LTD\nstreet 1",), ("SCOPE OF WORK\nstreet 1",), ("SCOPE OF WORK",), ("",)], "t string")
    assert [r[0] for r in df.select(fx.header_block(F.col("t"))).collect()] == ["ACME TOOLS LTD", "street 1", "SCOPE OF WORK", ""]


def test_generated_invoices_are_read_back(spark):
    docs = C.invoices(spark, 40)
    assert docs.exceptAll(C.invoices(spark, 40)).count() == 0
    assert docs.where("text like 'Factura%'").count() == 10
    status = {r.status for r in D.marker_confidence(docs).collect()}
    assert status == {"SUCCESS"}
    got = D.extract(docs).collect()
    assert all(r.total_amount > 0 and r.issue_date for r in got)
    bad = C.degrade(docs, "doc_id", "text")
    assert bad.where("degraded <> text").count() > 20 and bad.where("degraded like '%@@@%'").count() > 5
    assert C.degrade(docs.limit(0), "doc_id", "text").count() == 0


def test_item_issues(spark):
    rows = spark.createDataFrame([("1", "bolt", 2.0, "u"), (None, "x", 0.0, ""), ("", None, None, None)], "id string, description string, quantity double, unit string")
    assert [r.is_valid for r in C.item_issues(rows).collect()] == [True, False, False]
    assert len(C.item_issues(rows).collect()[2].issues) == 4


def test_specifications_of_each_item_wherever_it_stands(spark):
    far = "n. " * 400
    text = f"1 steel pipe long 5 kg\nmaterial: iron\n{far}\n2 garden  hose\ngreen 7 m\ncolor: verde claro. marca: Acme\n{far}\n3 copper wire coil 2 kg\n{far}\nmodelo: too far"
    rows = L.item_specifications(spark.createDataFrame([(1, text), (2, None), (3, "")], "k long, t string"), "k", "t").collect()
    assert [(r.doc, r.item_no, r.description, r.specs) for r in sorted(rows, key=lambda r: r.item_no)] == [
        (1, 0, "steel pipe long", "material: iron"), (1, 1, "garden hose green", "marca: Acme | color: verde claro"), (1, 2, "copper wire coil", "")
    ]


def test_all_line_items_of_a_long_invoice(spark):
    long = "steel pipe " * 15
    text = "\n".join([f"copper wire coil no {i} Qty: {i}" for i in range(11, 41)] + [f"{long} A Qty: 22", f"{long} B Qty: 33"])
    df = spark.createDataFrame([(1, text)], "k long, t string")
    assert L.line_items(df, "k", "t").count() == 20
    got = L.line_items(df, "k", "t", most=None, width=None).orderBy("line_no").collect()
    assert [r.line_no for r in got] == list(range(32)) and got[-1].description.endswith("B Qty: 33")


def test_made_documents_of_all_kinds(spark):
    rows = C.made_documents(spark, 90).collect()
    kinds = {}
    for r in rows:
        kinds.setdefault(r.category, []).append(r)
    assert {k: len(v) for k, v in kinds.items()} == {"clean": 40, "scanned": 20, "specification": 20, "edge": 10}
    assert len({r.doc_id for r in rows}) == 90 and all("Part Number: PART-" in r.text for r in kinds["specification"])
    assert {r.text for r in kinds["edge"]} == set(C.EDGE.values())
    assert C.made_documents(spark, 0).count() == 0
