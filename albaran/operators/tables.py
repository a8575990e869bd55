"""Unlabelled tables: header rows, broken rows, column roles, cell scores, conflicts, alignment, range repair.

A table is a set of rows (doc, row_no, cells ARRAY<STRING>). Column roles need one aggregation by table; everything
else is computed inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from albaran.functions.numparse import safe_float, safe_parse_numeric
from albaran.functions.text import ocr_garbage, squash, strip
from albaran.session import settle

# Labels of header cells, currency marks and codes of cells.
HEADER_LABELS = "DESCRIPCIÓN|CANT|CANT.|QTY|QUANTITY|UNIT PRICE|PRICE|TOTAL|AMOUNT|ITEM|ÍTEM|MEDIDA|DESCRIPTION|UNIT|CURRENCY"
HEADER_LIKE = "ITEM|DESCRIPTION|DESCRIPCION|QTY|QUANTITY|UNITS|UNIT PRICE|PRICE|TOTAL|AMOUNT|CURRENCY|SUBTOTAL|LINE|ITEM DESCRIPTION"
SCHEMA_CODES = "USD|GBP|EUR|CAD|AUD|MXN|COP|ARS"
SCORER_CODES = "USD|GBP|EUR|CAD|AUD|MXN|COP|ARS|JPY|CNY|INR|BRL"
ALIGN_CODES = "USD|GBP|EUR|CAD|AUD|MXN|COP|ARS|JPY|CNY"
NUMERIC = r"^[0-9]+(?:[.,][0-9]+)?$"
ROLES = ("description", "quantity", "unit_price", "total_amount")


def piped_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, row_no, cells) of the lines of a text that hold a bar."""
    each = df.select(F.col(key).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("row_no", "line"))
    return each.where(F.col("line").contains("|")).select("doc", "row_no", F.transform(F.split("line", r"\|"), strip).alias("cells"))


def _caps(c: Column) -> Column:
    return (c == F.upper(c)) & (c != F.lower(c))


def _words(c: Column) -> Column:
    return F.when(squash(c) == "", 0).otherwise(F.size(F.split(squash(c), " ")))


def is_header_row(cells: Column) -> Column:
    """At least 40 % of the cells (and one) hold a label or are short capitals."""

    def label(x: Column) -> Column:
        v = F.upper(strip(x))
        return v.rlike(HEADER_LABELS.replace("CANT.", r"CANT\.")) | (_caps(v) & (F.length(v) <= 20) & (_words(v) <= 3) & ~v.rlike(NUMERIC))

    return F.size(F.filter(cells, label)) >= F.greatest(F.lit(1), F.floor(F.size(cells) * 0.4))


def is_header_like(c: Column) -> Column:
    """A label, a label and more, or up to three capital words with a label in them."""
    t = F.upper(squash(c))
    return t.rlike(f"^(?:{HEADER_LIKE})(?: |$)") | (_caps(t) & (_words(t) <= 3) & t.rlike(HEADER_LIKE))


def normalise_row(cells: Column, width: int) -> Column:
    """Padded with '' or folded into `width` cells."""
    c = F.transform(cells, squash)
    folded = F.concat(F.slice(c, 1, width - 1), F.array(squash(F.array_join(F.slice(c, F.lit(width), F.greatest(F.size(c), F.lit(1))), " "))))
    return F.when(F.size(c) <= width, F.slice(F.concat(c, F.array_repeat(F.lit(""), width)), 1, width)).otherwise(folded)


def merge_broken_rows(rows: DataFrame, width: int) -> DataFrame:
    """Rows with fewer cells than the header continue the row before cell by cell; rows with an empty first cell continue
    its last cell. A row starts a group if it does neither; the group is found by a running count over the table.
    """
    full = rows.where(F.exists("cells", lambda x: strip(x) != ""))
    short, headless = F.size("cells") < width, strip(F.get("cells", F.lit(0))) == ""
    w = Window.partitionBy("doc").orderBy("row_no")
    full = full.withColumns({"_new": F.when(short | headless, 0).otherwise(1), "_n": F.row_number().over(w)})
    full = full.withColumn("_group", F.sum(F.greatest("_new", F.when(F.col("_n") == 1, 1).otherwise(0))).over(w))
    row = F.struct("row_no", "cells", short.alias("short"))
    grouped = full.groupBy("doc", "_group").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def add(acc: Column, r: Column) -> Column:
        cells = r["cells"]
        beside = F.transform(acc, lambda prev, i: F.when(F.coalesce(strip(F.get(cells, i)), F.lit("")) != "", squash(F.concat_ws(" ", prev, F.get(cells, i)))).otherwise(prev))
        tail = F.concat(F.slice(acc, 1, width - 1), F.array(squash(F.concat(F.element_at(acc, -1), F.lit(" "), F.array_join(cells, " ")))))
        return F.when(r["short"], beside).otherwise(tail)

    first = normalise_row(F.col("rows")[0]["cells"], width)
    merged = F.aggregate(F.slice("rows", F.lit(2), F.size("rows")), first, add)
    return grouped.select("doc", F.col("rows")[0]["row_no"].alias("row_no"), merged.alias("cells"))


def has_currency(c: Column, codes: str = SCHEMA_CODES) -> Column:
    return c.rlike("[$£€¥]") | F.upper(c).rlike(codes)


def column_statistics(rows: DataFrame) -> DataFrame:
    """(doc, col_idx, price_count, quantity_count, currency_count, text_length, numeric_count, max_price_value).

    Header rows are left out unless the table has no others; unreadable cells don't count. Aggregated map-side.
    """
    marked = rows.withColumn("_head", is_header_row(F.col("cells")))
    plain = marked.groupBy("doc").agg(F.bool_and("_head").alias("_all"))
    body = marked.join(plain, "doc").where("_all or not _head")
    cells = body.select("doc", F.posexplode("cells").alias("col_idx", "cell")).withColumn("cell", squash(F.col("cell")))
    cells = cells.where(~ocr_garbage(F.col("cell")))
    cell, cur = F.col("cell"), has_currency(F.col("cell"))
    price = (cell != "") & (cur | cell.rlike("[0-9]"))
    digits = F.translate(cell, ",.", "")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return cells.groupBy("doc", "col_idx").agg(
        one(price).alias("price_count"),
        one(digits.rlike("^[0-9]+$") & (F.length(digits) <= 5)).alias("quantity_count"),
        one(price & cur).alias("currency_count"),
        F.sum(F.length(cell)).cast("bigint").alias("text_length"),
        one(cell.rlike(NUMERIC)).alias("numeric_count"),
        F.max(F.when(price, safe_parse_numeric(cell)).otherwise(0.0)).alias("max_price_value"),
    )


def infer_schema(rows: DataFrame) -> DataFrame:
    """(doc, description, quantity, unit_price, total_amount): column index of each role, NULL where no column has it."""
    s = column_statistics(rows)
    best = lambda *k: F.max_by("col_idx", F.struct(*[x.alias(f"k{i}") for i, x in enumerate([*k, -F.col("col_idx")])]))
    c = F.col
    picked = s.groupBy("doc").agg(
        best(c("text_length"), -c("numeric_count")).alias("d"),
        best(c("quantity_count"), -c("price_count"), -c("text_length")).alias("q"),
        best(c("price_count"), c("currency_count"), -c("numeric_count")).alias("p"),
        best(c("max_price_value"), c("price_count"), c("currency_count")).alias("t"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("col_idx", F.struct("text_length", "quantity_count", "price_count"))))).alias("m"),
    )
    keys = F.array_sort(F.map_keys("m"))
    other = lambda no, what: F.get(F.filter(keys, lambda i: (i != no) & (F.element_at("m", i)[what] > 0)), F.lit(0))
    picked = picked.withColumn("q", F.when(c("q") == c("d"), F.coalesce(other(c("d"), "quantity_count"), c("q"))).otherwise(c("q")))
    picked = picked.withColumn("p", F.when(c("p") == c("d"), F.coalesce(other(c("d"), "price_count"), c("p"))).otherwise(c("p")))
    picked = picked.withColumn("t", F.when(c("t") == c("d"), F.coalesce(other(c("d"), "price_count"), c("t"))).otherwise(c("t")))
    picked = picked.withColumn("t", F.when(c("t") == c("p"), F.coalesce(other(c("p"), "price_count"), c("t"))).otherwise(c("t")))
    has = lambda i, what: F.when(F.element_at("m", c(i))[what] > 0, c(i))
    return picked.select(
        "doc", has("d", "text_length").alias("description"), has("q", "quantity_count").alias("quantity"), has("p", "price_count").alias("unit_price"), has("t", "price_count").alias("total_amount")
    )


def map_cells(rows: DataFrame, schema: DataFrame) -> DataFrame:
    """Rows with the cell of each role by the table's schema; '' where the role or the cell is missing."""
    j = rows.join(schema, "doc", "left")
    return j.select("doc", "row_no", "cells", *[F.coalesce(squash(F.get("cells", F.col(r))), F.lit("")).alias(r) for r in ROLES])


def _value(c: Column) -> Column:
    return safe_float(F.regexp_replace(squash(c), "[^0-9.,]", ""))


def _numeric_only(c: Column) -> Column:
    return F.regexp_replace(squash(c), r"[$£€¥\s]", "").rlike("^[0-9.,]+$")


def _whole(c: Column) -> Column:
    """No digits after the separator."""
    n = F.regexp_replace(squash(c), "[^0-9.,]", "")
    return ~n.rlike("[.,]") | n.rlike(r"^[0-9]*[.,]$")


def _clamp(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


# Fixed values in the scorers below: the weights and bounds of each role.
def score_cells(rows: DataFrame) -> DataFrame:
    """rows with the arrays s_description, s_quantity, s_unit_price, s_total_amount: how well each cell fits each role."""
    df = rows.withColumn("_v", F.transform("cells", _value)).withColumn("_p", F.filter("_v", lambda v: v > 0))
    df = df.withColumns(
        {
            "_lo": F.array_min("_p"),
            "_hi": F.array_max("_p"),
            "_avg": F.try_divide(F.aggregate("_p", F.lit(0.0), lambda a, b: a + b), F.size("_p")),
            "_len": F.transform("cells", lambda x: F.length(strip(F.regexp_replace(squash(x), "[0-9.,]", "")))),
        }
    )
    df = df.withColumn("_most", F.array_max("_len"))
    lo, hi, avg, most = F.col("_lo"), F.col("_hi"), F.col("_avg"), F.col("_most")
    money = lambda x: has_currency(x, SCORER_CODES)
    d = lambda x: F.lit(float(x))

    def quantity(x: Column, v: Column) -> Column:
        n = F.length(F.regexp_replace(x, "[^0-9]", ""))
        s = F.when(F.abs(v - lo) < 0.01, d(0.8)).when(v < avg, d(0.4)).otherwise(d(0.1))
        s = s + F.when(_whole(x), d(0.2)).otherwise(d(0)) + F.when(n <= 5, d(0.1)).when(n > 8, d(-0.3)).otherwise(d(0)) + F.when(v > 10000, d(-0.4)).otherwise(d(0))
        return F.when((squash(x) == "") | (v <= 0), d(0)).when(money(x), d(0.1)).otherwise(_clamp(s))

    def unit_price(x: Column, v: Column) -> Column:
        part = F.length(F.regexp_extract(squash(x), "[.,]([0-9]+)", 1))
        dec = F.when(part == 2, d(0.6)).when(part.between(1, 4), d(0.3)).otherwise(d(0))
        s = F.when(money(x), d(0.7)).otherwise(d(0)) + F.when(squash(x).rlike("[.,]"), dec).otherwise(d(-0.2))
        s = s + F.when((v < lo * 5) & (v > lo * 0.5), d(0.3)).when(v < hi, d(0.2)).when(v == hi, d(-0.3)).otherwise(d(0))
        s = s + F.when(v.between(0.01, 100000), d(0.2)).when(v > 100000, d(-0.4)).otherwise(d(0))
        return F.when((squash(x) == "") | (v <= 0), d(0)).otherwise(_clamp(s))

    def total(x: Column, v: Column) -> Column:
        s = F.when((F.abs(v - hi) < hi * 0.01) | (v >= hi * 0.99), d(0.9)).when(v >= hi * 0.8, d(0.5)).when(v >= hi * 0.5, d(0.2)).otherwise(d(-0.3))
        s = s + F.when(money(x), d(0.4)).otherwise(d(0)) + F.when(squash(x).rlike("[.,]"), d(0.2)).otherwise(d(0))
        return F.when((squash(x) == "") | (v <= 0), d(0)).otherwise(_clamp(s))

    def description(x: Column, n: Column) -> Column:
        words = _words(x)
        s = F.when(n > 0, n / F.greatest(most, F.lit(1)) * 0.8).otherwise(d(0)) + F.when(words >= 3, d(0.2)).when(words == 2, d(0.1)).otherwise(d(0))
        s = s + F.when(money(x), d(-0.3)).otherwise(d(0))
        share = F.try_divide(F.length(F.regexp_replace(squash(x), "[^0-9.,]", "")), F.length(squash(x)))
        s = s + F.when(share > 0.5, d(-0.4)).otherwise(d(0))
        return F.when((squash(x) == "") | _numeric_only(x) | (most == 0), d(0)).otherwise(_clamp(s))

    df = df.withColumns(
        {
            "s_description": F.zip_with("cells", "_len", description),
            "s_quantity": F.zip_with("cells", "_v", quantity),
            "s_unit_price": F.zip_with("cells", "_v", unit_price),
            "s_total_amount": F.zip_with("cells", "_v", total),
        }
    )
    return df.drop("_v", "_p", "_lo", "_hi", "_avg", "_len", "_most")


def resolve_conflicts(scored: DataFrame) -> DataFrame:
    """rows with i_description .. i_total_amount: greedy by role; a taken column gives way to the best free one, the first
    of equals; -1 where all are taken.
    """
    df = scored.withColumn("_used", F.array().cast("array<int>"))
    for r in ROLES:
        free = F.transform(f"s_{r}", lambda v, i: F.when(F.array_contains("_used", i), F.lit(-1.0)).otherwise(v))
        df = settle(df.withColumn("_f", free), "_f")
        at = F.when(F.array_max("_f") >= 0, (F.array_position("_f", F.array_max("_f")) - 1).cast("int")).otherwise(F.lit(-1))
        df = df.withColumn(f"i_{r}", at)
        df = df.withColumn("_used", F.when(F.col(f"i_{r}") >= 0, F.array_append("_used", F.col(f"i_{r}"))).otherwise(F.col("_used"))).drop("_f")
    return df.drop("_used")


def scored_fields(rows: DataFrame) -> DataFrame:
    """(doc, row_no, cells, the four roles as cleaned texts): scores, conflicts, then checks of the values."""
    df = resolve_conflicts(score_cells(rows))
    df = df.select("doc", "row_no", "cells", *[F.coalesce(squash(F.get("cells", F.when(F.col(f"i_{r}") >= 0, F.col(f"i_{r}")))), F.lit("")).alias(r) for r in ROLES])
    num = lambda r: _value(F.col(r))
    df = df.withColumns(
        {
            "description": F.when(_numeric_only(F.col("description")), F.lit("")).otherwise(F.col("description")),
            "quantity": F.when(num("quantity") > 0, F.floor(num("quantity")).cast("string")).otherwise(F.lit("")),
            "unit_price": F.when(num("unit_price") > 0, num("unit_price").cast("string")).otherwise(F.lit("")),
            "total_amount": F.when(num("total_amount") > 0, num("total_amount").cast("string")).otherwise(F.lit("")),
        }
    )
    q, p = safe_float(F.col("quantity")), safe_float(F.col("unit_price"))
    both = (F.col("quantity") != "") & (F.col("unit_price") != "") & (F.abs(q - p) < 0.01)
    df = df.withColumns({"_bp": both & (q < p), "_bq": both & (q >= p)})
    df = df.withColumns({"unit_price": F.when(F.col("_bp"), F.lit("")).otherwise(F.col("unit_price")), "quantity": F.when(F.col("_bq"), F.lit("")).otherwise(F.col("quantity"))})
    p, t = safe_float(F.col("unit_price")), safe_float(F.col("total_amount"))
    swap = (t > 0) & (p > 0) & (t < p)
    df = df.withColumn("_s", swap)
    u, a = F.col("unit_price"), F.col("total_amount")
    return df.withColumns({"unit_price": F.when(F.col("_s"), a).otherwise(u), "total_amount": F.when(F.col("_s"), u).otherwise(a)}).drop("_bp", "_bq", "_s")


def align_rows(rows: DataFrame, schema: DataFrame) -> DataFrame:
    """rows with a_description .. a_total_amount (column index, -1 for none): schema and cells' own look weighed by row.

    Of equal scores the last column is the best here.
    """
    df = rows.withColumn("_v", F.transform("cells", _value)).withColumn("_hi", F.array_max("_v"))
    money = lambda x: has_currency(x, ALIGN_CODES)
    d = lambda x: F.lit(float(x))
    none = lambda x, v: (squash(x) == "") | (v <= 0)
    quantity = lambda x, v: F.when(none(x, v) | (F.length(squash(x)) > 10) | money(x), d(0)).when(F.length(F.regexp_replace(x, "[^0-9]", "")) > 5, d(0.1)).otherwise(d(1))
    price = lambda x, v: (
        F.when(none(x, v), d(0)).when(money(x), d(0.9)).when(strip(F.regexp_replace(squash(x), "[$£€]", "")).rlike("^[0-9]{1,4}[.,][0-9]{2}$"), d(0.95))
        .when(v.between(0.01, 999999.99), F.when(squash(x).rlike("[.,]"), d(0.8)).otherwise(d(0.5))).otherwise(d(0))
    )
    total = lambda x, v: F.when(none(x, v), d(0)).when(money(x), d(0.9)).when(v >= F.col("_hi") * 0.99, d(0.95)).when(v >= F.col("_hi") * 0.1, d(0.6)).otherwise(d(0))
    desc = lambda x, v: (
        F.when((squash(x) == "") | _numeric_only(x), d(0)).when(F.length(squash(x)) < 2, d(0.1)).when(_words(x) >= 2, d(0.9)).when(F.length(squash(x)) >= 5, d(0.7)).otherwise(d(0.5))
    )
    df = df.withColumns({f"_s_{r}": F.zip_with("cells", "_v", f) for r, f in zip(ROLES, (desc, quantity, price, total))})
    df = settle(df, *[f"_s_{r}" for r in ROLES])
    named = schema.select("doc", *[F.col(r).alias(f"_c_{r}") for r in ROLES])
    df = df.join(named, "doc", "left").withColumn("_used", F.array().cast("array<int>"))
    for r in ROLES:
        s = F.col(f"_s_{r}")
        h = (F.size(s) - F.array_position(F.reverse(s), F.array_max(s))).cast("int")
        df = df.withColumn("_h", h)
        c, h = F.coalesce(F.col(f"_c_{r}"), F.lit(-1)), F.col("_h")
        free = lambda i: ~F.array_contains("_used", i)
        pick = (
            F.when((c >= 0) & (c == h) & free(c), c)
            .when((F.get(s, h) >= 0.7) & free(h), h)
            .when((c >= 0) & free(c), c)
            .when(free(h), h)
            .otherwise(F.lit(-1))
        )
        df = settle(df.withColumn(f"a_{r}", pick.cast("int")), f"a_{r}")
        df = df.withColumn("_used", F.when(F.col(f"a_{r}") >= 0, F.array_append("_used", F.col(f"a_{r}"))).otherwise(F.col("_used"))).drop("_h")
    return df.select("doc", "row_no", "cells", *[f"a_{r}" for r in ROLES])


def range_repair(mapped: DataFrame, low: float = 1.0, high: float = 10000.0) -> DataFrame:
    """Quantities, prices and totals outside the range become the least, the upper median and the greatest of the row's
    values inside it; only rows with two or more positive values and one inside are touched.
    """
    df = mapped.withColumn("_p", F.filter(F.transform("cells", _value), lambda v: v > 0)).withColumn("_ok", F.array_sort(F.filter("_p", lambda v: v.between(low, high))))
    usable = (F.size("_p") > 1) & (F.size("_ok") > 0)
    out = lambda r: usable & (F.col(r) != "") & ~_value(F.col(r)).between(low, high)
    fix = {"quantity": F.get("_ok", F.lit(0)), "unit_price": F.get("_ok", F.floor(F.size("_ok") / 2).cast("int")), "total_amount": F.get("_ok", F.size("_ok") - 1)}
    return df.select("doc", "row_no", "description", *[F.when(out(r), v.cast("string")).otherwise(F.col(r)).alias(r) for r, v in fix.items()])


# The columns of a table whose schema can't be told.
DEFAULT_SCHEMA = {"description": 0, "quantity": 1, "unit_price": 2, "total_amount": 3}


def parse_rows(rows: DataFrame, schema: DataFrame) -> DataFrame:
    """(doc, row_no, the four roles) of the rows of tables: cells by the schema, blanks filled from the scores, then the range repair.

    A table without a schema has the default one. A description that is a number is blank. Header rows and rows without
    any value give nothing.
    """
    scored = scored_fields(rows.where(~is_header_row(F.col("cells")))).withColumnsRenamed({r: f"_f_{r}" for r in ROLES})
    told = schema.select("doc", *[F.col(r).alias(f"_c_{r}") for r in ROLES], F.lit(True).alias("_told"))
    df = scored.join(told, "doc", "left")
    cell = {r: F.coalesce(squash(F.get("cells", F.when(F.col("_told"), F.col(f"_c_{r}")).otherwise(F.lit(DEFAULT_SCHEMA[r])))), F.lit("")) for r in ROLES}
    cell["description"] = F.when(_numeric_only(cell["description"]), F.lit("")).otherwise(cell["description"])
    df = df.select("doc", "row_no", "cells", *[F.when(c != "", c).otherwise(F.col(f"_f_{r}")).alias(r) for r, c in cell.items()])
    return range_repair(settle(df, *ROLES)).where(F.concat(*ROLES) != "")
