"""Scalar operators on literal cases."""

import math

import pytest
from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.functions import numparse as num
from albaran.functions import text as tx
from albaran.functions import units as un


def values(spark, f, inputs):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, s string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("s")).alias("v")).collect()]


INPUTS = ["1,234.56", "1.234,56", "1,234", "12,5", "1,234,567", "1.234.567", "1.234.567,89", "1,234,567.89", "-5", "1O0", "", None, "120.50", "45,000.00", "$ 120.50", "112.202202.300300.3.2.1"]


@pytest.mark.parametrize(
    "f, expected",
    [
        (num.parse_decimal_legacy, [None, 1.23456, 1.234, 12.5, None, None, 1234567.89, 1234567.89, 5.0, 100.0, None, None, 120.5, None, 120.5, None]),
        (num.parse_numeric, [1234.56, 1234.56, 1.234, 12.5, None, None, 1234567.89, 1234567.89, -5.0, 10.0, None, None, 120.5, 45000.0, 120.5, None]),
        (num.safe_float, [1234.56, 1234.56, 1234.0, 12.5, 0.0, 0.0, 0.0, 0.0, 5.0, 10.0, 0.0, 0.0, 120.5, 45000.0, 120.5, 0.0]),
        (num.safe_parse_numeric, [1234.56, 1234.56, 1.234, 12.5, 1234.567, 0.0, 1234567.89, 1234567.89, 5.0, 10.0, 0.0, 0.0, 120.5, 45000.0, 120.5, 0.0]),
    ],
)
def test_numeric_parsers(spark, f, expected):
    got = values(spark, f, INPUTS)
    if f is num.parse_decimal_legacy:  # a comma before a point stays a second point
        expected = [None if x is None else x for x in expected]
    for i, (g, e) in enumerate(zip(got, expected)):
        assert (g is None) == (e is None) and (g is None or math.isclose(g, e)), (INPUTS[i], g, e)


def test_text_cleaning(spark):
    assert values(spark, tx.clean_text, ["  a \n b ", "", " \t", None, "x"]) == ["a b", None, None, None, "x"]
    assert values(spark, tx.repair_zero_l, ["S0LUTION 100", "call level", "a0b0c", None]) == ["SOLUTION 100", "ca1 1eve1", "aOb0c", None]
    assert values(spark, tx.clean_ocr, ["l5 pcs A1B 1O2 -x  y", None]) == ["l5 pcs AIB 102 x y", None]
    assert values(spark, tx.ocr_garbage, ["1111", "1.2.3", "12345678901234567", None, "1.21.31.41.5"]) == [True, False, True, False, True]


def test_scores_of_short_and_empty_texts(spark):
    assert values(spark, tx.ocr_score, ["", "short", None]) == [0.0, 0.0, 0.0]
    assert values(spark, tx.confidence, ["", "INVOICE total date supplier quantity unit"]) == [0, 50]  # five keywords, two quantity words


def test_fields(spark):
    t = "INVOICE #INV-2024001\nDate: 24/06/2024\nSupplier: Acme Tools\nTotal Amount: 1,200.50 USD"
    assert values(spark, lambda c: fx.field(c, "supplier"), [t, "", None]) == ["Acme Tools", None, None]
    assert values(spark, lambda c: fx.field(c, "date"), [t]) == ["24/06/2024"]
    assert values(spark, fx.strict_number, ["no. INV-2024001", "PO_ABCD12", "po 1"]) == ["2024001", "ABCD12", ""]
    assert values(spark, fx.currency_of_document, [t, "10 €", "S/ 5", "EURO"]) == ["USD", "EUR", "PEN", ""]
    assert values(spark, fx.document_type, [t, "purchase order 3", "a tender", ""]) == ["invoice", "po", "tender", "unknown"]
    assert values(spark, fx.raw_date, ["el 12 de enero 2024", "1/2/24", "x"]) == ["12 de enero 2024", "1/2/24", None]


def test_unit_phrases(spark):
    content = values(spark, lambda c: un.phrase(un.fold(c))[0], ["Kg.", "caja x 25 kilos", "caja", "m.l.", "BLS 20 mtr", None, "", "saco 6unid", "lote"])
    code = values(spark, lambda c: un.phrase(un.fold(c))[1], ["Kg.", "caja x 25 kilos", "caja", "m.l.", "BLS 20 mtr", None, "", "saco 6unid", "lote"])
    assert content == [1.0, 25.0, None, 1.0, 20.0, None, None, 6.0, None]
    assert code == ["kg", "kg", None, "m", "m", None, None, "u", None]
    assert values(spark, un.number, ["588,1", "1.234,5", "1,234,567", "12", "x"]) == [588.1, 1234.5, 1234567.0, 12.0, None]
