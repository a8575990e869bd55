"""Pairs of redelivered records against all pairs; runs against the whole table at once."""

import itertools

import pytest
from pyspark.sql import functions as F

from albaran.llm import batches as B

SITES = [("mad", "Europe/Madrid", "DMY"), ("bog", "America/Bogota", "DMY")]
ROWS = [
    (1, "mad", "Logística Brutrogrevo S.L.", "PO/24/010018030", "2023-04-25", "5195.51"),
    (2, "mad", "log. brutrogrevo", "#PO/24/01OO18O30", "25/04/2023", "5.195,51"),
    (3, "mad", "Logística Brutrogrevo S.L.", "", "2023-04-25 10:11:12", "5196"),
    (4, "mad", "Logística Brutrogrevo S.L.", "PO/24/010018031", "2023-04-25", "5195.51"),
    (5, "mad", "Logística Brutrogrevo S.L.", "PO/24/010018030", "2023-04-25", "5195.52"),
    (6, "mad", "Catering Brutrogrevo S.L.", "PO/24/010018030", "2023-04-25", "5195.51"),
    (7, "bog", "José Crutefafli Naruz", "FW-PO-770015", "2023-07-16T04:57:50Z", "USD 100.50"),
    (8, "bog", "pepe crutefafli naruz", "FW PO 770015", "2023-07-15", "100"),
    (9, "bog", "José Crutefafli Naruz", "Nº FW-PO-77001S", "", "101 "),
    (10, "bog", "José Crutefafli Naruz", "FW-PO-770015", "", "###"),
    (11, None, None, "FW-PO-770015", "", "100.50"),
    (12, "mad", "Logística Brutrogrevo S.L.", "PO/24/010018030", "2023-04-25", "5195.51"),
    (13, "mad", "Logística Brutrogrevo S.L.", "", "", "5195.51"),
    (14, "mad", "Logística Brutrogrevo S.L.", "", "", "5195.51"),
    (15, "mad", "Logística Brutrogrevo S.L.", "PO/24/010018030", "2023-04-26", "5195.51"),
    (16, "mad", "Logística Brutrogrevo S.L.", "PO/24/010018030", "2023-04-28", "5195.51"),
    (17, "mad", "Logística Brutrogrevo S.L.", "", "2023-04-26", "5195.51"),
]
COLS = "rec_id long, site_code string, supplier string, invoice_or_po_number string, issue_date string, total_amount string"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(ROWS, COLS), spark.createDataFrame(SITES, "site_code string, tz_name string, date_order string")


def brute(tables):
    p = {r.rec_id: (r.supplier, r.number, r.day, r.cents) for r in B.prepare(*tables).collect()}
    return {(a, b) for a, b in itertools.combinations(sorted(p), 2) if B.same_document(p[a], p[b])}


def test_amounts(spark):
    vals = ["953.44", "509,27", "38300.14 USD", "58800", "1,028.52", "91.700,41", "13600 . 32", "1 132.46", "S/ 115300.38", "$ 1.5", "99B2.54", "SB7.43", "-45.00", "1154.49-", "1,2,3", "###", "", None, "5195.510"]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, s string")
    got = [r.c for r in df.orderBy("i").select(B.amount_cents(F.col("s")).alias("c")).collect()]
    assert got == [95344, 50927, 3830014, 5880000, 102852, 9170041, 1360032, 113246, 11530038, 150, 998254, 58743, None, 115449, None, None, None, None, 519551]


def test_pairs_equal_all_pairs_compared(tables):
    got = {tuple(r) for r in B.pairs_of(*tables).collect()}
    assert got == brute(tables)
    assert {(1, 2), (1, 12), (2, 3), (7, 8)} <= got
    assert (1, 15) in got
    assert not {(1, 4), (1, 5), (1, 6), (8, 9), (13, 14), (1, 16), (1, 17)} & got


def test_runs_give_the_same_pairs_batch_by_batch(spark, tables, tmp_path):
    rows, sites = tables
    store = B.RunStore(spark, str(tmp_path / "runs"), per_range=3, most_runs=2)
    got = set()
    for k in range(4):
        new = {tuple(r) for r in store.add(rows.where(f"rec_id % 4 = {k}"), sites).collect()}
        assert not new & got
        got |= new
    assert got == brute(tables)
    assert len(store.runs()) <= 2


def test_loads_in_order_give_the_same_pairs(tables):
    rows, sites = tables
    loads = rows.withColumn("load_id", F.when(F.col("rec_id") < 12, (F.col("rec_id") % 5).cast("int")))
    for n in (1, 2, 3):
        assert {tuple(r) for r in B.pairs_by_batches(loads, sites, batches=n).collect()} == brute(tables)
    assert B.pairs_by_batches(loads.limit(0), sites).count() == 0


def test_empty(tables):
    rows, sites = tables
    assert B.pairs_of(rows.limit(0), sites).count() == 0


@pytest.mark.parametrize("most_keys", [0, 500_000])
def test_history_is_read_by_range_and_key(spark, tables, tmp_path, most_keys):
    rows, sites = tables
    store = B.RunStore(spark, str(tmp_path / "runs"), per_range=2, broadcast_rows=most_keys)
    store.add(rows.where("rec_id in (1, 7, 9)"), sites)
    assert len(store._list(store.runs()[0], "lo=")) > 1
    new = B.cut(B.sort_keys(B._rows(rows.where("rec_id in (2, 3)"), sites)))
    near = store._near(new)
    assert {r.whole for r in near.collect()} == {5196}
    plan = near._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(lo" in plan.replace("  ", " ") or "lo#" in plan.split("PartitionFilters")[1][:200]
    # copies of what is accepted are members and nothing else
    before = store.links().count()
    got = {tuple(r) for r in store.add(rows.where("rec_id = 12"), sites).collect()}
    assert got == {(1, 12)} and store.links().count() == before


def test_hot_windows_are_split(spark, tables):
    rows = [(i, "mad", f"Logística Brutrogrevo {'S.L.' if i % 2 else 'SL'}", "" if i % 3 == 0 else "PO-1", "2023-04-25", f"{5000 + (i % 7) / 100:.2f}") for i in range(60)]
    df = spark.createDataFrame(rows, COLS)
    p = {r.rec_id: (r.supplier, r.number, r.day, r.cents) for r in B.prepare(df, tables[1]).collect()}
    want = {(a, b) for a, b in itertools.combinations(sorted(p), 2) if B.same_document(p[a], p[b])}
    keyed = B.sort_keys(B._rows(df, tables[1]).dropDuplicates(["w"]))
    links = {tuple(r) for r in B.windows(keyed, least_hot=4).collect()}
    assert links == {tuple(r) for r in B.windows(keyed).collect()} and len(links) > 100
    assert {tuple(r) for r in B.pairs_of(df, tables[1]).collect()} == want


def test_classes(tables):
    rows, sites = tables
    got = {r.rec_id: (r.cls, r.copies) for r in B.classes_by_batches(rows.withColumn("load_id", F.lit(1)), sites).collect()}
    of = {r: r for r in got}
    for a, b in sorted(brute(tables)):
        low, high = sorted((of[a], of[b]))
        of = {r: low if c == high else c for r, c in of.items()}
    assert {r: c for r, (c, _) in got.items()} == of and got[1][1] == sum(c == 1 for c in of.values())
