"""Queries on texts: numeric parsers, cleaning, measures, fields, line items, classification; and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.functions import numparse as num
from albaran.functions import text as tx
from albaran.operators import candidates as C
from albaran.operators import documents as D
from albaran.operators import lines as L
from albaran.plans import sqltext as S
from albaran.session import spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def _totals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_procurement").select("rec_id", F.col("total_amount").alias("raw"))


@query(f"SELECT rec_id, raw, {S.legacy_steps('raw')} AS value FROM (SELECT rec_id, total_amount raw FROM extracted_procurement)")
def parse_decimal_legacy(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d).withColumn("value", num.parse_decimal_legacy(F.col("raw")))


@query(f"SELECT rec_id, raw, {S.parse_numeric('raw')} AS value FROM (SELECT rec_id, total_amount raw FROM extracted_procurement)")
def parse_numeric(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d).withColumn("value", num.parse_numeric(F.col("raw")))


@query(f"SELECT rec_id, raw, {S.safe_float('raw')} AS value FROM (SELECT rec_id, total_amount raw FROM extracted_procurement)")
def safe_float(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d).withColumn("value", num.safe_float(F.col("raw")))


def _safe_parse_sql(c: str) -> str:
    s = S.sub(f"coalesce({c}, '')", "[^0-9.,]")
    d, k = S.marks("t", "."), S.marks("t", ",")
    value = f"""CASE WHEN {d} > 1 AND {k} = 0 THEN NULL
      WHEN {d} > 0 AND {k} > 0 THEN CASE WHEN instr(reverse(t), ',') < instr(reverse(t), '.') THEN replace(replace(t, '.', ''), ',', '.') ELSE replace(t, ',', '') END
      WHEN {k} > 1 AND {d} = 0 THEN CASE WHEN regexp_full_match(t, '[0-9]+(,[0-9]{{3}}){{2,}}') THEN replace(left(t, length(t) - 4), ',', '') || '.' || right(t, 3) END
      ELSE replace(t, ',', '.') END"""
    tokens = S.every(s, "[0-9]+(?:[.,][0-9]+)*")
    return f"coalesce(list_filter(list_transform({tokens}, lambda t: try_cast({value} AS DOUBLE)), lambda v: v IS NOT NULL)[1], 0.0)"


@query(f"SELECT rec_id, raw, {_safe_parse_sql('raw')} AS value FROM (SELECT rec_id, total_amount raw FROM extracted_procurement)")
def safe_parse_numeric(spark: SparkSession, d: str) -> DataFrame:
    return _totals(spark, d).withColumn("value", num.safe_parse_numeric(F.col("raw")))


@query(f"SELECT doc_id, md5({S.clean('text')}) AS cleaned, length({S.clean('text')}) AS n FROM documents")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    c = tx.clean_text(F.col("text"))
    return _docs(spark, d).select("doc_id", F.md5(c).alias("cleaned"), F.length(c).cast("bigint").alias("n"))


_ZERO = S.sub("text", "([A-Za-z])0([A-Za-z])", r"\1O\2")


@query(f"SELECT doc_id, md5(CASE WHEN contains({_ZERO}, 'll') THEN {S.sub(_ZERO, 'l+', '1')} ELSE {_ZERO} END) AS repaired FROM documents")
def ocr_zero_l_repair(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.md5(tx.repair_zero_l(F.col("text"))).alias("repaired"))


@query()
def ocr_clean_full(spark: SparkSession, d: str) -> DataFrame:
    """Look-around has no SQL twin: tested on fixed cases."""
    return _docs(spark, d).select("doc_id", tx.clean_ocr(F.col("text")).alias("cleaned"))


_SCORE = f"""least({S.count('text', f'(?i)(?:{tx.KEYWORDS})')} * 6, 40) + least({S.count('text', '[0-9]')} / greatest(length(text), 1) * 40, 40.0)
  + greatest(0, 20 - {S.count('text', r'[$@%&*#^~]')} * 2) + CASE WHEN contains(text, '|') OR contains(text, chr(9)) THEN 10 ELSE 0 END"""


@query(f"SELECT doc_id, CAST(CASE WHEN length({S.strip('text')}) >= 20 THEN {_SCORE} ELSE 0.0 END AS DOUBLE) AS score FROM documents")
def ocr_text_score(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", tx.ocr_score(F.col("text")).alias("score"))


_NOISE = r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}\-:|.$€£,/]"
_CONF = f"""CASE WHEN length({S.strip('text')}) >= 20 THEN greatest(0, least(60, least({S.count('text', f'(?i)(?:{tx.KEYWORDS}|ORDER|ORDEN)')} * 8, 40)
  + least({S.count('text', r'(?i)\b(?:Qty|Quantity|Cantidad|Unidad|Unit)(?:[^\p{L}\p{N}_]|$)')} * 5, 20) - least({S.count('text', _NOISE)}, 15))) ELSE 0 END"""


@query(f"SELECT doc_id, CAST({_CONF} AS INTEGER) AS confidence FROM documents")
def text_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", tx.confidence(F.col("text")).alias("confidence"))


@query(f"SELECT doc_id, {S.has('text', r'[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}\-.,():/]|[\x00-\x1f]')} AS garbled FROM documents")
def garbled_text(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", tx.garbled(F.col("text")).alias("garbled"))


_N = S.sub(S.squash("coalesce(total_amount, '')"), "[^0-9.,]")
_SAME = "|".join(str(i) * 4 for i in range(10))


@query(f"SELECT rec_id, (length({_N}) > 15 OR {S.has(_N, _SAME)} OR {S.has(S.squash("coalesce(total_amount, '')"), '(?:[0-9][.][0-9]){4,}')}) AS garbage FROM extracted_procurement")
def ocr_garbage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_procurement").select("rec_id", tx.ocr_garbage(F.col("total_amount")).alias("garbage"))


_F = fx.FIELD_PATTERNS


@query(
    "SELECT doc_id, "
    + ", ".join(f"coalesce({S.first_of('text', _F[k])}, '') AS {n}" for n, k in (("supplier", "supplier"), ("number", "invoice_po"), ("issue_date", "date"), ("currency", "currency"), ("quantity", "quantity"), ("tax", "tax")))
    + " FROM documents"
)
def extract_fields(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    named = (("supplier", "supplier"), ("number", "invoice_po"), ("issue_date", "date"), ("currency", "currency"), ("quantity", "quantity"), ("tax", "tax"))
    return _docs(spark, d).select("doc_id", *[F.coalesce(fx.field(c, k), F.lit("")).alias(n) for n, k in named])


def _amount_sql(name: str) -> str:
    return S.legacy_steps(f"nullif({S.group('text', '(?i)' + fx.LABELLED_AMOUNTS[name])}, '')")


_PRICES = f"list_filter(list_transform({S.every('text', '(?i)' + fx.PRICE, 1)}, lambda x: try_cast(replace(CASE WHEN instr(x, '.') > 0 AND instr(x, ',') > instr(x, '.') AND {S.marks('x', ',')} = 1 AND {S.marks('x', '.')} = 1 THEN replace(x, ',', '') WHEN {S.marks('x', '.')} > 1 AND {S.marks('x', ',')} = 1 THEN replace(x, '.', '') WHEN {S.marks('x', ',')} > 1 AND {S.marks('x', '.')} = 1 THEN replace(x, ',', '') WHEN {S.marks('x', '.')} > 0 AND instr(x, ',') > instr(x, '.') THEN replace(x, ',', '') ELSE x END, ',', '.') AS DOUBLE)), lambda v: v > 0 AND v < 10000000)"


@query(f"SELECT doc_id, len({_PRICES}) AS n_prices, list_max({_PRICES}) AS greatest_price, {_amount_sql('subtotal')} AS subtotal, {_amount_sql('tax')} AS tax, coalesce({_amount_sql('total')}, list_max({_PRICES})) AS total_amount FROM documents WHERE text IS NOT NULL")
def extract_prices(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("text")
    p = fx.prices(c)
    return _docs(spark, d).where("text is not null").select(
        "doc_id", F.size(p).cast("bigint").alias("n_prices"), F.array_max(p).alias("greatest_price"), fx.labelled_amount(c, "subtotal").alias("subtotal"),
        fx.labelled_amount(c, "tax").alias("tax"), F.coalesce(fx.labelled_amount(c, "total"), F.array_max(p)).alias("total_amount"),
    )


def _extracted(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    n = L.line_items(docs, "doc_id", "text").groupBy("doc").agg(F.count(F.lit(1)).alias("n_items"))
    e = D.extract(docs).join(n, "doc", "left").fillna(0, ["n_items"])
    e = e.withColumn("missing_fields", D.missing_fields(F.col("n_items")))
    return e.withColumn("confidence", D.extraction_confidence(F.col("missing_fields"), F.col("text_quality")))


@query()
def extraction_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Fields, missing fields and confidence of every document: the whole chain from text to record."""
    return _extracted(spark, d).select("doc", "supplier", "invoice_or_po_number", "issue_date", "currency", "n_items", F.array_join("missing_fields", ",").alias("missing_fields"), "confidence")


@query()
def extraction_summary(spark: SparkSession, d: str) -> DataFrame:
    return _extracted(spark, d).agg(F.count(F.lit(1)).alias("total"), F.avg("confidence").alias("average_confidence"), F.sum("n_items").alias("line_items"), F.sum(F.size("missing_fields")).alias("missing"))


def _first_sql(c: str, patterns: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif(replace({S.group(c, p)}, ',', '.'), '')" for p in patterns) + ")"


_ITEMS = f"""WITH {S.LINES},
k AS (SELECT doc, line_no, line, regexp_split_to_array(line, '\\s*\\|\\s*|\\t+') cols FROM lines WHERE length(line) >= 12 AND NOT {S.has('upper(line)', L.SKIP)}),
v AS (SELECT *, CASE WHEN (contains(line, '|') OR contains(line, chr(9))) AND len(cols) >= 3 AND len(list_filter(cols[2:], lambda x: regexp_matches(x, '[0-9]'))) > 0 THEN {S.strip('cols[2]')} END d1,
  {_first_sql('line', L.QUANTITY)} q2, {_first_sql('line', L.PRICE)} p2, {_first_sql('line', L.TOTAL)} t2,
  {_first_sql('cols[-2]', L.QUANTITY)} qb, {_first_sql('cols[-1]', L.PRICE)} pb FROM k),
w AS (SELECT *, CASE WHEN coalesce(d1, '') <> '' AND coalesce(q2, qb, p2, pb, t2) IS NOT NULL THEN 1
  WHEN {S.has('line', '[A-Za-z]{5,}')} AND {S.has('line', '[0-9,.]{2,}')} AND coalesce(q2, p2, t2) IS NOT NULL THEN 2 END way FROM v),
g AS (SELECT doc, line_no, substring(CASE WHEN way = 1 THEN d1 ELSE line END, 1, 150) description, coalesce(CASE WHEN way = 1 THEN coalesce(q2, qb) ELSE q2 END, '') quantity,
  coalesce(CASE WHEN way = 1 THEN coalesce(p2, pb) ELSE p2 END, '') unit_price, coalesce(CASE WHEN way = 1 THEN coalesce(t2, pb) ELSE t2 END, '') total_price FROM w WHERE way IS NOT NULL),
u AS (SELECT *, row_number() OVER (PARTITION BY doc, lower(description) ORDER BY line_no) n FROM g),
f AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY line_no) m FROM u WHERE n = 1)
"""


@query(_ITEMS + "SELECT doc, line_no, description, quantity, unit_price, total_price FROM f WHERE m <= 20")
def line_items(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 of each document, as the reference has them; line_items_all has the others, too."""
    return L.line_items(_docs(spark, d), "doc_id", "text")


@query(_ITEMS.replace("substring(CASE WHEN way = 1 THEN d1 ELSE line END, 1, 150)", "CASE WHEN way = 1 THEN d1 ELSE line END") + "SELECT doc, line_no, description, quantity, unit_price, total_price FROM u WHERE n = 1")
def line_items_all(spark: SparkSession, d: str) -> DataFrame:
    """All items with their whole descriptions."""
    return L.line_items(_docs(spark, d), "doc_id", "text", most=None, width=None)


@query(f"WITH {S.LINES} SELECT doc, line_no, line FROM lines WHERE {S.has('lower(line)', L.CANDIDATE)} OR ({S.has('line', L.NUMBER_LIKE)} AND length(line) > 20)")
def candidate_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.candidate_lines(_docs(spark, d), "doc_id", "text")


def _complete_sql() -> str:
    pick = lambda g: "coalesce(" + ", ".join(f"CASE WHEN {S.has('line', '(?i)' + p)} THEN {S.group('line', '(?i)' + p, g)} END" for p in L.SPANISH_LINES) + ")"
    return f"whole AS (SELECT doc, line_no, {pick(1)} id, {S.squash(pick(2))} description, try_cast(replace({pick(3)}, ',', '.') AS DOUBLE) quantity, {pick(4)} unit FROM lines)"


@query(f"WITH {S.LINES}, {_complete_sql()} SELECT * FROM whole WHERE id IS NOT NULL")
def spanish_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.complete_lines(_docs(spark, d), "doc_id", "text")


@query(f"WITH {S.LINES}, {_complete_sql()}, w AS (SELECT * FROM whole WHERE id IS NOT NULL) SELECT * FROM w UNION ALL SELECT doc, line_no, 'UNKNOWN', line, 1.0, 'u' FROM lines WHERE length(line) >= 3 AND doc NOT IN (SELECT doc FROM w)")
def fallback_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.with_fallback(_docs(spark, d), "doc_id", "text")


@query(
    f"""WITH s AS (SELECT doc_id doc, {S.every('text', '(?i)' + L.SECTION, 1)} a, {S.every('text', '(?i)' + L.SECTION, 2)} b, {S.every('text', '(?i)' + L.SECTION, 3)} c, {S.every('text', '(?i)' + L.SECTION, 4)} d FROM documents),
    e AS (SELECT doc, generate_subscripts(a, 1) i, a, b, c, d FROM s), o AS (SELECT doc, i - 1 item_no, a[i] item_id, {S.squash('b[i]')} description, try_cast(replace(c[i], ',', '.') AS DOUBLE) quantity, lower(d[i]) unit FROM e)
    SELECT * FROM o WHERE length(description) > 8"""
)
def item_sections(spark: SparkSession, d: str) -> DataFrame:
    return L.item_sections(_docs(spark, d), "doc_id", "text")


def _spec_sql(part: str = "substring(text, 1, 500)") -> str:
    one = lambda w: f"CASE WHEN length({_v(w)}) > 2 THEN '{w}: ' || {_v(w)} END"
    _v = lambda w: f"substring({S.strip(S.group(part, f'(?i){w}[:\\s\\x0b]+([^\\n.]+)'))}, 1, 80)"
    return f"array_to_string(list_filter([{', '.join(one(w) for w in fx.SPEC_WORDS)}], lambda x: x IS NOT NULL)[1:3], ' | ')"


@query(f"SELECT doc_id, {_spec_sql()} AS specs FROM documents WHERE text IS NOT NULL")
def spec_keywords(spark: SparkSession, d: str) -> DataFrame:
    """Of the first 500 characters of a text; spec_keywords_items has the windows at the items."""
    return _docs(spark, d).where("text is not null").select("doc_id", fx.specifications(F.col("text")).alias("specs"))


@query(
    f"""WITH s AS (SELECT doc_id doc, text, {S.every('text', '(?i)' + L.SECTION, 1)} a, {S.every('text', '(?i)' + L.SECTION, 2)} b FROM documents),
    e AS (SELECT doc, text, generate_subscripts(a, 1) i, a, b FROM s), o AS (SELECT doc, text, i - 1 item_no, a[i] item_id, {S.squash('b[i]')} description, {S.strip('b[i]')} raw FROM e),
    w AS (SELECT *, substring(text, coalesce(nullif(strpos(text, description), 0), strpos(text, raw)), 500) part FROM o)
    SELECT doc, item_no, item_id, description, {_spec_sql('part')} AS specs FROM w WHERE length(description) > 8"""
)
def spec_keywords_items(spark: SparkSession, d: str) -> DataFrame:
    """One row for each item of the texts, with the keywords near it wherever in the text it stands."""
    return L.item_specifications(_docs(spark, d), "doc_id", "text")


@query("SELECT doc_id, coalesce(" + ", ".join(f"nullif({S.group('upper(text)', p)}, '')" for p in fx.STRICT_NUMBERS) + ", '') AS number FROM documents")
def invoice_number_strict(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", fx.strict_number(F.col("text")).alias("number"))


@query("SELECT doc_id, coalesce(" + ", ".join(f"CASE WHEN {S.has('text', '(?i)' + p)} THEN {S.group('text', '(?i)' + p)} END" for p in fx.LOOSE_NUMBERS) + ", '') AS number FROM documents")
def invoice_number_loose(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", fx.loose_number(F.col("text")).alias("number"))


@query("SELECT doc_id, coalesce(" + ", ".join(f"CASE WHEN length({S.squash(S.group('text', '(?i)' + p))}) >= 4 THEN {S.squash(S.group('text', '(?i)' + p))} END" for p in fx.SUPPLIER_LABELS) + ", '') AS supplier FROM documents")
def supplier_by_label(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", fx.labelled_supplier(F.col("text")).alias("supplier"))


@query()
def supplier_name(spark: SparkSession, d: str) -> DataFrame:
    """By label, else a line in capitals."""
    return _docs(spark, d).select("doc_id", fx.supplier_name(F.col("text")).alias("supplier"))


_CASES = " ".join(f"WHEN {S.has('upper(v)', p)} THEN '{c}|{n}|' || {S.group('upper(v)', f'({p})')}" for c, p, n in fx.CURRENCY_MAP)


@query(f"SELECT line_id, string_split(m, '|')[1] AS code, string_split(m, '|')[2] AS name, string_split(m, '|')[3] AS raw FROM (SELECT line_id, CASE {_CASES} END m FROM (SELECT line_id, \"raw_value:currency\" v FROM cleaned_procurement))")
def currency_map(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "cleaned_procurement").select("line_id", fx.currency_by_map(F.col("`raw_value:currency`")).alias("m"))
    return c.select("line_id", "m.code", "m.name", "m.raw")


def _word(code: str) -> str:
    return S.has("upper(text)", rf"(?:^|[^\p{{L}}\p{{N}}_]){code}(?:[^\p{{L}}\p{{N}}_]|$)")


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(text, '{s}') THEN '{c}'" for s, c in fx.CURRENCY_SYMBOLS) + " " + " ".join(f"WHEN {_word(c)} THEN '{c}'" for c in fx.CURRENCY_CODES) + " ELSE '' END AS currency FROM documents")
def currency_document(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", fx.currency_of_document(F.col("text")).alias("currency"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(text, '{s}') THEN '{s}'" for s in "£$€") + " " + " ".join(f"WHEN {_word(c)} THEN '{c}'" for c in "USD GBP EUR CAD AUD MXN COP ARS".split()) + " ELSE '' END AS currency FROM documents")
def currency_symbol(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", fx.currency_mark(F.col("text")).alias("currency"))


@query("SELECT doc_id, coalesce(" + ", ".join(f"nullif({S.group('text', '(?i)' + p)}, '')" for p in fx.DATES) + ") AS raw_date FROM documents")
def date_raw(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", fx.raw_date(F.col("text")).alias("raw_date"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN {S.has('lower(text)', p)} THEN '{k}'" for k, p in fx.DOCUMENT_TYPES) + " ELSE 'unknown' END AS kind FROM documents")
def document_type(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", fx.document_type(F.col("text")).alias("kind"))


_PAGES = f"""pages AS (SELECT doc, unnest(p) text, generate_subscripts(p, 1) page FROM (SELECT doc_id doc,
  list_filter(regexp_split_to_array(text, '\\n[ \\t]*\\n'), lambda x: {S.strip('x')} <> '') p FROM documents))"""
_MIX = f"""mix AS (SELECT doc, count(*) pages, count(*) FILTER (length({S.strip('text')}) > 50) text_pages,
  count(*) FILTER (length({S.strip('text')}) < 80 OR len(string_split({S.squash('text')}, ' ')) < 30) scanned_pages,
  count(*) FILTER (length({S.strip('text')}) > 50) / count(*) text_ratio, avg(length(text)) average_chars FROM pages GROUP BY doc)"""


@query(f"WITH {_PAGES} SELECT doc, count(*) AS pages, sum(length(text))::BIGINT AS chars, avg(length(text)) AS chars_per_page FROM pages GROUP BY doc")
def text_density(spark: SparkSession, d: str) -> DataFrame:
    return D.text_density(D.pages(_docs(spark, d)))


@query(f"WITH {_PAGES}, {_MIX} SELECT * FROM mix")
def scanned_pages(spark: SparkSession, d: str) -> DataFrame:
    return D.page_mix(D.pages(_docs(spark, d)))


_CLASS = """cls AS (SELECT doc, CASE WHEN average_chars > 100 OR text_ratio >= 0.5 THEN 'text' ELSE 'scanned' END document_type,
  CASE WHEN average_chars > 100 OR text_ratio >= 0.5 THEN 'text_parser' ELSE 'ocr_engine' END extraction_method,
  CASE WHEN average_chars > 100 OR text_ratio >= 0.5 OR 1 - text_ratio > 0.5 THEN 'HIGH' ELSE 'LOW' END classification_confidence FROM mix)"""


@query(f"WITH {_PAGES}, {_MIX}, {_CLASS} SELECT * FROM cls")
def document_classification(spark: SparkSession, d: str) -> DataFrame:
    return D.classify(D.page_mix(D.pages(_docs(spark, d))))


@query(f"WITH {_PAGES}, {_MIX}, {_CLASS} SELECT document_type, classification_confidence, count(*) AS n FROM cls GROUP BY ALL")
def classification_summary(spark: SparkSession, d: str) -> DataFrame:
    return document_classification(spark, d).groupBy("document_type", "classification_confidence").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_PAGES}, {_MIX}, {_CLASS} SELECT doc_id, lang, coalesce(document_type, 'unknown') AS document_type, coalesce(extraction_method, 'unknown') AS extraction_method FROM documents LEFT JOIN cls ON doc = doc_id")
def join_classification(spark: SparkSession, d: str) -> DataFrame:
    return D.with_classification(_docs(spark, d).select("doc_id", "lang"), "doc_id", document_classification(spark, d))


def _route_sql() -> str:
    hits = lambda words: "(" + " + ".join(f"CASE WHEN contains(t, '{w}') THEN 1 ELSE 0 END" for w in words) + ")"
    one = lambda p: f"CASE WHEN {S.has('t', p)} THEN 1.0 ELSE 0.0 END"
    p = f"(least({hits(D.PROCUREMENT_WORDS)} / 2, 3.0) + {one('total|subtotal|tax|cantidad|precio')}) / 10"
    s = f"(least({hits(D.SPECIFICATION_WORDS)} / 2, 3.0) + {one('specification|requirement|standard|norm|datasheet|technical|feature|characteristic')} + {one('material|dimension|weight|temperature|voltage|current')}) / 10"
    return f"SELECT doc, least({p}, 1.0)::DOUBLE AS procurement, least({s}, 1.0)::DOUBLE AS specification FROM (SELECT doc_id doc, lower(text) t FROM documents WHERE text IS NOT NULL)"


@query(_route_sql())
def route_text_only(spark: SparkSession, d: str) -> DataFrame:
    return D.route_scores(_docs(spark, d).where("text is not null"), "doc_id", "text")


@query()
def route_with_signals(spark: SparkSession, d: str) -> DataFrame:
    """With the signals of the extraction beside those of the text."""
    docs = _docs(spark, d).where("text is not null")
    j = docs.join(D.extract(docs).drop("text_quality"), F.col("doc") == F.col("doc_id"))
    j = j.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in ("subtotal", "total_amount")})
    return D.route_scores(j, "doc_id", "text", {"supplier": "supplier", "number": "invoice_or_po_number", "date": "issue_date", "subtotal": "subtotal", "total": "total_amount"})


@query("SELECT doc_id, sha256(text) AS input_hash FROM documents")
def input_hash(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.sha2("text", 256).alias("input_hash"))


_MARK = f"""mk AS (SELECT doc_id doc, category, coalesce(text, '') t, length({S.strip("coalesce(text, '')")}) < 20 short, {S.has("coalesce(text, '')", '[?]|@@@|%%%%')} bad FROM documents),
m AS (SELECT doc, category, CASE WHEN short THEN 'FAILED' WHEN bad THEN 'WARNING' ELSE 'SUCCESS' END status, CAST(CASE WHEN short THEN 0 WHEN bad THEN greatest(0, n - 30) ELSE n END AS INTEGER) confidence FROM (
  SELECT *, 25 * (CAST({S.has('upper(t)', 'INVOICE|FACTURA|INV-')} AS INT) + CAST({S.has('t', '2024|2025')} AS INT) + CAST({S.has('t', r'Total|Amount|\$|€|USD|EUR')} AS INT) + CAST({S.has('t', 'Quantity|Cantidad')} AS INT)) n FROM mk))"""


@query(f"WITH {_MARK} SELECT * FROM m")
def marker_confidence(spark: SparkSession, d: str) -> DataFrame:
    return D.marker_confidence(_docs(spark, d))


_METRICS = """count(*) AS total_files, count(*) FILTER (status = 'SUCCESS') AS successful, count(*) FILTER (status = 'WARNING') AS warnings, count(*) FILTER (status = 'FAILED') AS failed,
 100.0 * count(*) FILTER (status = 'SUCCESS') / count(*) AS success_rate, 100.0 * count(*) FILTER (confidence < 70) / count(*) AS review_rate, avg(confidence) AS average_confidence,
 min(confidence) AS min_confidence, max(confidence) AS max_confidence, median(confidence)::DOUBLE AS median_confidence"""


@query(f"WITH {_MARK} SELECT category, {_METRICS} FROM m GROUP BY category")
def category_metrics(spark: SparkSession, d: str) -> DataFrame:
    return D.harness_metrics(marker_confidence(spark, d), ["category"])


@query(f"WITH {_MARK} SELECT {_METRICS} FROM m")
def overall_metrics(spark: SparkSession, d: str) -> DataFrame:
    return D.harness_metrics(marker_confidence(spark, d), [])


@query(f"WITH {_MARK} SELECT status, count(*) AS n, list_sort(list(doc))[1:3] AS examples FROM m WHERE status <> 'SUCCESS' GROUP BY status")
def failure_examples(spark: SparkSession, d: str) -> DataFrame:
    return D.failure_examples(marker_confidence(spark, d))


@query(f"WITH {_MARK} SELECT 100.0 * count(*) FILTER (status <> 'FAILED') / count(*) AS rate, count(*) AS n FROM m WHERE category = 'edge'")
def edge_case_rate(spark: SparkSession, d: str) -> DataFrame:
    m = marker_confidence(spark, d).where("category = 'edge'")
    return m.agg((F.try_divide(F.count_if(F.col("status") != "FAILED"), F.count(F.lit(1))) * 100).alias("rate"), F.count(F.lit(1)).alias("n"))


#: The number between word boundaries of any script.
_ALONE = r"(?:^|[^\p{L}\p{N}_])([0-9]+(?:[.,][0-9]+)?)(?:[^\p{L}\p{N}_]|$)"


@query(
    f"WITH {S.LINES} SELECT doc, line_no, {S.squash(S.group('line', fx.AMOUNT_IN_LINE))} AS amount, {S.squash(S.group('line', fx.UNIT_PRICE_IN_LINE))} AS unit_price, "
    f"{S.squash(S.group('line', _ALONE))} AS quantity FROM lines"
)
def line_amounts(spark: SparkSession, d: str) -> DataFrame:
    got = fx.line_amounts(F.col("line"))
    return L.text_lines(_docs(spark, d), "doc_id", "text").select("doc", "line_no", *[c.alias(n) for n, c in got.items()])


@query(f"WITH {S.LINES} SELECT doc, line_no, coalesce({', '.join(f'''nullif({S.group('line', '(?i)' + p)}, '')''' for p in fx.ITEM_IDS)}) AS item_id FROM lines")
def item_ids(spark: SparkSession, d: str) -> DataFrame:
    return L.text_lines(_docs(spark, d), "doc_id", "text").select("doc", "line_no", fx.item_id(F.col("line")).alias("item_id"))


_TITLE = f"({S.has('upper(x)', fx.TITLE_PHRASES)} OR (x = upper(x) AND x <> lower(x) AND NOT {S.has('x', r'[\p{Ll}]')} AND {S.words('x')} <= 6 AND {S.has('upper(x)', fx.TITLE_WORDS)}))"
_HB = f"""hb AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {S.strip('x')}), lambda x: x <> '')[1:8] ls FROM documents WHERE text IS NOT NULL),
hp AS (SELECT doc_id, ls, list_filter(ls, lambda x: NOT {_TITLE}) p FROM hb), hc AS (SELECT *, list_filter(p, lambda x: x = upper(x) AND x <> lower(x) AND NOT {S.has('x', r'[\p{Ll}]')} AND {S.words('x')} >= 2) c FROM hp)"""


@query(f"WITH {_HB} SELECT doc_id, array_to_string(CASE WHEN len(c) > 0 THEN c WHEN len(p) > 0 THEN p ELSE ls END, ' ') AS header FROM hc")
def header_block(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).where("text is not null").select("doc_id", fx.header_block(F.col("text")).alias("header"))


@query()
def best_readings(spark: SparkSession, d: str) -> DataFrame:
    """Each document's text and a spoiled copy as two readings; the better one by its score."""
    docs = C.degrade(_docs(spark, d).where("text is not null").select("doc_id", "text"), "doc_id", "text")
    both = F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.lit("raw").alias("method"), F.col("degraded").alias("text")), F.struct(F.lit(1).alias("ord"), F.lit("enhanced").alias("method"), F.col("text"))))
    r = docs.select(F.col("doc_id").cast("string").alias("document_name"), F.lit(1).alias("page"), both.alias("x")).select("document_name", "page", "x.*")
    return C.best_readings(r)


@query()
def generated_invoices(spark: SparkSession, d: str) -> DataFrame:
    """Invoices made from row numbers, as many as there are documents, through the marker check."""
    n = _docs(spark, d).count()
    return D.marker_confidence(C.invoices(spark, n))


@query(
    f"""WITH {S.LINES}, {_complete_sql()}, w AS (SELECT * FROM whole WHERE id IS NOT NULL) SELECT doc, line_no, list_filter([CASE WHEN id = '' THEN 'Missing item ID' END, CASE WHEN length(description) < 3 THEN 'Invalid description' END,
    CASE WHEN coalesce(quantity, 0) <= 0 THEN 'Invalid quantity' END, CASE WHEN unit = '' THEN 'Missing unit' END], lambda x: x IS NOT NULL) AS issues FROM w"""
)
def item_validity(spark: SparkSession, d: str) -> DataFrame:
    return C.item_issues(spanish_lines(spark, d)).select("doc", "line_no", "issues")


@query(f"SELECT CASE WHEN procurement > specification THEN 'procurement' WHEN specification > procurement THEN 'specification' ELSE 'tie' END AS route, count(*) AS n, max(procurement) AS best FROM ({_route_sql()}) GROUP BY 1")
def route_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many texts score higher as one or the other kind."""
    p, s = F.col("procurement"), F.col("specification")
    return route_text_only(spark, d).groupBy(F.when(p > s, "procurement").when(s > p, "specification").otherwise("tie").alias("route")).agg(F.count(F.lit(1)).alias("n"), F.max("procurement").alias("best"))
