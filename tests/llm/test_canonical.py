"""The trie search against plain edit distances, and the mapping's defined cases."""

import random

import pytest

from albaran.llm import canonical as C

ENTRIES = [("USD", "US Dollar", "$"), ("EUR", "Euro", "€"), ("PEN", "Peruvian Sol", "S/"), ("MXN", "Mexican Peso", "MX$"), ("COP", "Colombian Peso", "COL$"), ("DKK", "Danish Krone", "kr."), ("SEK", "Swedish Krona", "SEK kr")]


@pytest.fixture(scope="module")
def matcher():
    return C.Matcher(ENTRIES)


@pytest.mark.parametrize(
    "value, code",
    [
        ("$", "USD"), ("US Dllar", "USD"), ("euros", "EUR"), ("€UR", "EUR"), ("U5D", "USD"), ("U.S.D", "USD"), (" EUR ", "EUR"), ("Usd", "USD"), ("PEN-", "PEN"), ("S/.", "PEN"),
        ("pago en nuevos soles", "PEN"), ("(peso mx)", "MXN"), ("MXN - peso mexicano", "MXN"), ("MX$ MXN", "MXN"), ("PEN - S/.", "PEN"), ("SEK kr SEK", "SEK"), ("kr.", "DKK"), ("moneda: Euros (EUR)", "EUR"),
        ("pesos", "NONE"), ("kr/$", "NONE"), ("NOK", "NONE"), ("USD - euro", "NONE"), ("   ", "NONE"), ("x" * 50_000, "NONE"), ("peso colomviano", "COP"), ("dólares americanos", "USD"),
    ],
)
def test_values(matcher, value, code):
    assert matcher.code(value) == code


def osa(a, b):
    t = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = min(t[i - 1][j] + 1, t[i][j - 1] + 1, t[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                t[i][j] = min(t[i][j], t[i - 2][j - 2] + 1)
    return t[-1][-1]


def test_search_finds_all_entries_within_the_distance():
    rng = random.Random(8)
    paths = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(60)})
    trie = C.Trie()
    for p in paths:
        trie.add(p, p)
    for _ in range(300):
        w, k = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))), rng.randint(0, 2)
        assert trie.search(w, k) == {p: osa(w, p) for p in paths if osa(w, p) <= k}


def test_rows(spark):
    ref = spark.createDataFrame(ENTRIES, "code string, name string, symbol string")
    rows = spark.createDataFrame([(1, "USD", "a"), (2, "euro", "b"), (2, "euro", "b"), (3, None, "c"), (4, "", "d"), (5, "?", "e")], "rec_id long, currency string, code string")
    got = sorted(tuple(r) for r in C.map_values(rows, "rec_id", "currency", "extracted", ref).collect())
    assert got == [("extracted", 2, "EUR"), ("extracted", 2, "EUR"), ("extracted", 5, "NONE")]
    assert C.map_values(rows.limit(0), "rec_id", "currency", "extracted", ref).count() == 0


def test_long_values_are_read_whole(matcher):
    assert matcher.code("Moneda:" + " " * 500 + "peso" + " " * 90_000 + "mexicano") == "MXN"
    assert matcher.code(" - ".join(["EUR"] * 3 + ["euro"])) == "EUR" and matcher.code("usd " * 20_000) == "USD"
    assert matcher.code("moneda " * 5_000 + "euros") == "EUR"


def test_lists_in_blocks(spark):
    ref = spark.createDataFrame(ENTRIES, "code string, name string, symbol string")
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(["euro", "EUR", "kr.", "peso", None, "", "danish krome", "us dolar", "x" * 9_000])], "rec_id long, currency string")
    one, many = (sorted(map(tuple, C.within(rows, "currency", ref, size=n).collect())) for n in (100, 2))
    assert one == many and ("danish krome", "DKK", 1) in one
    got = dict((r.row_id, r.code) for r in C.map_values(rows, "rec_id", "currency", "x", ref, size=2).collect())
    assert got == {0: "EUR", 2: "DKK", 3: "NONE", 6: "DKK", 7: "USD", 8: "NONE"}
    assert C.within(rows, "currency", ref.limit(0)).count() == 0


def test_results_do_not_depend_on_the_length_of_the_list(spark, matcher):
    """Words around a value, look-alike codes, symbols and codes beside names: the rules hold with a list in blocks, too."""
    values = ["$", "US Dllar", "euros", "€UR", "U5D", "U.S.D", " EUR ", "Usd", "PEN-", "S/.", "pago en nuevos soles", "(peso mx)", "MXN - peso mexicano", "MX$ MXN", "PEN - S/.", "SEK kr SEK", "kr.", "EUR"]
    values += ["moneda: Euros (EUR)", "pesos", "kr/$", "NOK", "USD - euro", "   ", "x" * 5_000, "peso colomviano", "dólares americanos", " - ".join(["EUR"] * 3 + ["euro"]), "usd " * 200, "moneda " * 50 + "euros"]
    values += ["EUR - USD - euro", "pago PEN soles peruanos", "euro euro", "us dollar $", "danish krome DKK", "kr. (SEK)", "COP peso colombiano COL$", "EUR EURO USD euro PEN"]
    ref = spark.createDataFrame(ENTRIES, "code string, name string, symbol string").repartition(3)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "rec_id long, currency string")
    want = {(i, matcher.code(v)) for i, v in enumerate(values) if v not in {c for c, _, _ in ENTRIES}}
    for size in (100, 3):
        got = [(r.row_id, r.code) for r in C.map_values(rows, "rec_id", "currency", "x", ref, size=size).collect()]
        assert len(got) == len(want) and set(got) == want
    assert len({c for _, c in want}) == 8
