"""Readers, writers and streams on small files."""

import json

from albaran.operators import candidates as C
from albaran.sources import readers as R
from albaran.sources import writers as W
from albaran.streaming import events as E


def test_raw_csv_with_line_breaks(spark, tmp_path):
    f = tmp_path / "raw.csv"
    f.write_text('pdf_name,item_id,original_description,quantity,unit,technical_specifications\na.pdf,,"bolt\n""M8"", zinc",2.5,u,\nb.pdf,1,,,,x\n', encoding="utf-8")
    rows = R.raw_items(spark, str(f)).orderBy("pdf_name").collect()
    assert [tuple(r) for r in rows] == [("a.pdf", None, 'bolt\n"M8", zinc', 2.5, "u", None), ("b.pdf", "1", None, None, None, "x")]


def test_json_array_and_lines(spark, tmp_path):
    f = tmp_path / "n.json"
    f.write_text(json.dumps([{"document_name": "ñ.pdf", "quantity": 1.0}, {"document_name": None}]), encoding="utf-8")
    df = R.json_array(spark, str(f), R.NORMAL)
    assert df.count() == 2 and df.columns[0] == "document_name"
    W.to_json(df, str(tmp_path / "out"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json"))
    assert '"supplier_name":null' in text and "ñ.pdf" in text
    assert R.json_lines(spark, str(tmp_path / "out"), R.NORMAL).count() == 2


def test_binary_pages_and_text(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one\x0ctwo")
    (tmp_path / "b.pdf").write_bytes(b"bad")
    (tmp_path / "c.txt").write_text("left out")

    def reader(raw):
        if raw == b"bad":
            raise ValueError("no pdf")
        return raw.decode().split("\x0c")

    files = R.binary_files(spark, str(tmp_path))
    pages = R.document_pages(files, reader)
    assert sorted((r.document_name, r.page, r.text, r.error) for r in pages.collect()) == [("a.pdf", 1, "one", None), ("a.pdf", 2, "two", None), ("b.pdf", 0, None, "ValueError: no pdf")]
    assert R.document_text(pages).collect()[0].text == "\n--- PAGE 1 ---\none\n--- PAGE 2 ---\ntwo"
    assert R.document_text(pages, " ", 1).collect()[0].text == " one"
    assert R.text_files(spark, str(tmp_path)).first().content == "left out"


def test_csv_routes_log_and_report(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x"], "p"), ("b", None, "q|r")], "k string, l array<string>, route string")
    W.to_csv(df, str(tmp_path / "csv"), ["route", "missing", "k", "l"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["route", "k", "l"]
    W.by_route(df, str(tmp_path / "routes"), "k")
    assert sorted(p.name for p in (tmp_path / "routes").glob("k=*")) == ["k=a", "k=b"]
    W.append_log(df, str(tmp_path / "log"))
    W.append_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    text = W.markdown("Report", {"rows": df.select("k", "route").orderBy("k")}, most=1)
    assert "| a | p |" in text and "1 more" in text


def test_config(tmp_path):
    assert R.config(str(tmp_path / "none.json")) == {}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i % 3} 0{i % 9}:00:00", "ab"[i % 2], float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, at string, kind string, value double").selectExpr("id", "cast(at as timestamp_ntz) ts", "kind", "value")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    s = E.read_files(spark, str(tmp_path / "in"), "*.parquet", df.schema, files_a_batch=1)
    got = E.run_to_end(E.window_counts(s, "ts", "kind"), "t")
    want = E.window_counts(df, "ts", "kind")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_unique_documents(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "")], "id long, text string")
    assert E.unique_documents(df, "id", "text").count() == 2


def test_tables_of_pages_combined_routes_and_classifications(spark, tmp_path):
    files = spark.createDataFrame([("a.pdf", b"x"), ("b.pdf", b"")], "document_name string, content binary")
    read = lambda raw: [("one", [[["a", None], ["b", "c"]]]), "two"] if raw else [1 / 0]
    pages = R.document_pages(files, read)
    assert {r.document_name: r.text for r in R.document_text(pages).collect()} == {"a.pdf": "\n--- PAGE 1 ---\none\n--- TABLE ---\na | \nb | c\n\n--- PAGE 2 ---\ntwo"}
    df = spark.createDataFrame([("a", "p"), ("b", "q")], "k string, route string")
    W.by_route(df, str(tmp_path / "r"), "route", combined=True)
    assert spark.read.json(str(tmp_path / "r" / "combined")).count() == spark.read.json(str(tmp_path / "r" / "by_route")).count() == 2
    W.classifications(spark.createDataFrame([("a.pdf", None, 0.5)], "document_name string, document_type string, text_ratio double"), str(tmp_path / "c"))
    (got,) = R.json_lines(spark, str(tmp_path / "c"), R.CLASSIFICATION).collect()
    assert tuple(got) == ("a.pdf", "unknown", "manual_review", "UNKNOWN", None, 0.5, None, None)


def test_thin_pages_take_the_ocr(spark):
    long = " ".join(["word"] * 40)
    a = spark.createDataFrame([("d", 1, long), ("d", 2, "thin"), ("d", 3, ""), ("d", 4, None)], "document_name string, page int, text string")
    b = spark.createDataFrame([("d", 1, "x"), ("d", 2, "read"), ("d", 3, " "), ("d", 5, "more")], "document_name string, page int, text string")
    got = {r.page: (r.text, r.method) for r in C.text_or_ocr(a, b).collect()}
    assert got == {1: (long, "text"), 2: ("read", "ocr"), 3: ("", "text"), 4: (None, "text"), 5: ("more", "ocr")}
