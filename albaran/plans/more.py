"""Queries on rows of tables, line checks, routes and forms in lines, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.operators import candidates as C
from albaran.operators import documents as D
from albaran.operators import lines as L
from albaran.operators import quality as Q
from albaran.operators import rows as R
from albaran.operators import tables as T
from albaran.plans import records, texts
from albaran.plans import sqltext as S
from albaran.session import spread, table

QUERIES: dict[str, records.Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: records.Query) -> records.Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def _first(keep: str, take: str = "x") -> str:
    return f"list_transform(list_filter(r, lambda x: {keep}), lambda x: {take})[1]"


_ABC = r"length(regexp_replace(x, '[^\p{L}]', '', 'g'))"
_NUM = f"try_cast(replace({S.group('x', R.CELL_QUANTITY)}, ',', '.') AS DOUBLE)"
_UNIT = f"(?i)({L.SECTION_UNITS})"
_ITEMS = f"""ti AS (SELECT * FROM (SELECT doc, row_no, coalesce({_first(S.has('x', R.ITEM_CODE))}, '') item_id, substring({_first(f'length(x) > 10 AND {_ABC} > 5')}, 1, 200) description,
  coalesce(list_filter(ns, lambda v: v <> 0)[1], ns[1]) quantity, coalesce({_first(S.has('x', _UNIT), S.group('x', _UNIT))}, '') unit, {texts._spec_sql("substring(array_to_string(cells, ' | '), 1, 500)")} specs
  FROM (SELECT *, list_transform(list_filter(r, lambda x: {S.has('x', R.CELL_QUANTITY)}), lambda x: {_NUM}) ns FROM (SELECT *, list_filter(cells, lambda x: length(x) >= 2) r FROM rw
    WHERE len(list_filter(cells, lambda x: {S.has('x', '[0-9]')})) > 0 AND len(list_filter(cells, lambda x: length(x) > 5 AND {_ABC} > 3)) > 0)))
  WHERE description IS NOT NULL AND quantity IS NOT NULL)"""


@query(f"WITH {records._CUT}, {_ITEMS} SELECT * FROM ti")
def table_row_items(spark: SparkSession, d: str) -> DataFrame:
    return R.table_items(records._rows(spark, d))


_SECTIONS = f"""ss AS (SELECT doc_id doc, {S.every('text', '(?i)' + L.SECTION, 2)} b, {S.every('text', '(?i)' + L.SECTION, 3)} c, {S.every('text', '(?i)' + L.SECTION, 4)} u FROM documents),
se AS (SELECT doc, generate_subscripts(b, 1) i, b, c, u FROM ss),
sx AS (SELECT doc, i, {S.squash('b[i]')} description, try_cast(replace(c[i], ',', '.') AS DOUBLE) quantity, lower(u[i]) unit FROM se),
sf AS (SELECT *, row_number() OVER (PARTITION BY doc, description ORDER BY i) n FROM sx WHERE length(description) > 8 AND NOT EXISTS (SELECT 1 FROM ti WHERE ti.doc = sx.doc AND ti.description = sx.description))"""


@query(
    f"WITH {records._CUT}, {_ITEMS}, {_SECTIONS} SELECT doc, 'table' AS source, item_id, description, quantity, unit FROM ti "
    "UNION ALL SELECT doc, 'text', '', description, quantity, unit FROM sf WHERE n = 1"
)
def document_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of tables and texts together, those of the texts that no table has."""
    return R.document_items(records._rows(spark, d), _docs(spark, d), "doc_id", "text")


def _amount(c: str) -> str:
    return S.parse_numeric(f"nullif({S.strip(c)}, '')")


_LC = f"""li AS (SELECT rec_id, line_items, unnest(generate_series(1, len(line_items))) n FROM extracted_procurement),
ln AS (SELECT rec_id, n, coalesce(i.description, '') s, {_amount('i.quantity')} q, {_amount('i.unit_price')} p, {_amount('i.total_price')} t FROM (SELECT rec_id, n, line_items[n] i FROM li) WHERE i IS NOT NULL),
lm AS (SELECT *, CASE WHEN q IS NOT NULL AND p IS NOT NULL AND t IS NOT NULL THEN CASE WHEN t = 0 AND q * p = 0 THEN TRUE WHEN q * p > 0 THEN abs(q * p - t) / (q * p) <= {R.TOLERANCE} ELSE q * p = t END END m FROM ln),
lc AS (SELECT rec_id, n::INT line_number, substring(s, 1, 50) description, NOT coalesce(q > {R.SUSPICIOUS}, FALSE) AND coalesce(m, TRUE) is_valid, m matches_price, list_filter([CASE WHEN q > {R.SUSPICIOUS} THEN 'suspicious quantity' END,
  CASE WHEN NOT m THEN 'price mismatch' END, CASE WHEN m IS NULL AND (coalesce(q, 0) <> 0 OR coalesce(p, 0) <> 0 OR coalesce(t, 0) <> 0) THEN 'incomplete price data' END], lambda x: x IS NOT NULL) issues FROM lm)"""


@query(f"WITH {_LC} SELECT * FROM lc")
def line_item_checks(spark: SparkSession, d: str) -> DataFrame:
    return R.line_checks(table(spark, d, "extracted_procurement"), "rec_id")


@query(f"WITH {_LC} SELECT issue, count(*) AS n FROM (SELECT unnest(issues) issue FROM lc) GROUP BY issue")
def line_issue_counts(spark: SparkSession, d: str) -> DataFrame:
    return line_item_checks(spark, d).select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


_PK = f"""pk AS (SELECT doc, count(*) pages, count(*) FILTER (h AND NOT g) text_pages, count(*) FILTER (NOT h AND g) image_pages, count(*) FILTER (h AND g) mixed_pages, avg(length(text)) average_chars
  FROM (SELECT doc, text, length({S.strip('text')}) > 50 h, contains(text, '~~~') g FROM pages) GROUP BY doc)"""


def _pictured(spark: SparkSession, d: str) -> DataFrame:
    """Pages; scanner noise in a text stands for an image on its page."""
    pages = D.pages(_docs(spark, d))
    return pages.withColumn("images", F.when(F.col("text").contains("~~~"), 1).otherwise(0))


@query(f"WITH {texts._PAGES}, {_PK} SELECT *, round(text_pages / pages, 2) AS text_ratio, round(image_pages / pages, 2) AS image_ratio, round(mixed_pages / pages, 2) AS mixed_ratio FROM pk")
def page_kinds(spark: SparkSession, d: str) -> DataFrame:
    return R.page_kinds(_pictured(spark, d))


@query(
    f"""WITH {texts._PAGES}, {_PK}, al AS (SELECT doc_id doc, pk.* EXCLUDE (doc), average_chars > 100 OR text_pages / pages >= 0.5 tx FROM documents LEFT JOIN pk ON pk.doc = doc_id)
    SELECT doc, CASE WHEN pages IS NULL THEN 'unknown' WHEN tx THEN 'text' ELSE 'scanned' END AS document_type, CASE WHEN pages IS NULL THEN 'manual_review' WHEN tx THEN 'text_parser' ELSE 'ocr_engine' END AS extraction_method,
    CASE WHEN pages IS NULL THEN 'LOW' WHEN tx THEN CASE WHEN mixed_pages / pages > 0.3 THEN 'MEDIUM' ELSE 'HIGH' END WHEN image_pages / pages > 0.5 THEN 'HIGH'
    WHEN mixed_pages > text_pages AND mixed_pages > image_pages THEN 'MEDIUM' ELSE 'LOW' END AS classification_confidence FROM al"""
)
def classification_by_kinds(spark: SparkSession, d: str) -> DataFrame:
    """With images, mixed pages and documents that can't be read."""
    all_ = table(spark, d, "documents").select(F.col("doc_id").alias("doc"))
    return R.classify_kinds(all_.join(page_kinds(spark, d), "doc", "left"))


_RT = f"""rt AS (SELECT rec_id, lower(concat_ws(' ', document_type, document_name, array_to_string(list_transform(line_items, lambda i: coalesce(i.description, '')), ' '))) t,
  lower(coalesce(array_to_string(list_transform(line_items, lambda i: coalesce(i.description, '')), ' '), '')) ls, coalesce(supplier, '') su, coalesce(invoice_or_po_number, '') nu, coalesce(issue_date, '') dt,
  coalesce(subtotal, '') <> '' OR coalesce(total_amount, '') <> '' pr FROM extracted_procurement)"""


def _hits(words: list[str]) -> str:
    return "(" + " + ".join(f"CASE WHEN contains(t, '{w}') THEN 1 ELSE 0 END" for w in words) + ")"


def _pt(cond: str, n: float) -> str:
    return f"CASE WHEN {cond} THEN {n} ELSE 0.0 END"


_P = f"""least((least({_hits(D.PROCUREMENT_WORDS)} / 2, 3.0) + {_pt("su <> ''", 2)} + {_pt("nu <> ''", 2)} + {_pt('pr', 2)} + {_pt("dt <> ''", 1)} + {_pt(S.has('t', 'total|subtotal|tax|cantidad|precio'), 1)}) / 10, 1.0)::DOUBLE"""
_S = f"""least(least((least({_hits(D.SPECIFICATION_WORDS)} / 2, 3.0) + {_pt("su = ''", 1.5)} + {_pt('NOT pr', 2)} + {_pt("dt = ''", 1.5)} + {_pt(S.has('t', 'specification|requirement|standard|norm|datasheet|technical|feature|characteristic'), 1)}
  + {_pt(S.has('t', 'material|dimension|weight|temperature|voltage|current'), 1)}) / 10, 1.0)::DOUBLE + {_pt(S.has('ls', R.TECHNICAL_LINE), 0.2)}::DOUBLE, 1.0)::DOUBLE"""


@query(
    f"""WITH {_RT}, sc AS (SELECT rec_id, ls, su, pr, {_P} procurement, {_S} specification FROM rt) SELECT rec_id AS doc, procurement, specification,
    CASE WHEN procurement > specification THEN 'procurement' WHEN specification > procurement THEN 'specification' WHEN su <> '' OR pr THEN 'procurement' WHEN {S.has('ls', R.TECHNICAL_FALLBACK)} OR NOT pr THEN 'specification' ELSE 'procurement' END AS route,
    CASE WHEN procurement <> specification THEN greatest(procurement, specification) ELSE 0.6 END AS confidence, CASE WHEN procurement <> specification THEN greatest(procurement, specification) ELSE 0.6 END >= {R.CONFIDENT} AS confident FROM sc"""
)
def route_records(spark: SparkSession, d: str) -> DataFrame:
    """Routes of extracted records by all signals; their kind, name and items stand for the text."""
    e = table(spark, d, "extracted_procurement")
    says = F.array_join(F.transform("line_items", lambda i: F.coalesce(i["description"], F.lit(""))), " ")
    e = e.withColumns({"text": F.concat_ws(" ", "document_type", "document_name", says), "lines": F.coalesce(says, F.lit(""))})
    record = {"supplier": "supplier", "number": "invoice_or_po_number", "date": "issue_date", "subtotal": "subtotal", "total": "total_amount"}
    priced = F.coalesce(F.col("subtotal") != "", F.lit(False)) | F.coalesce(F.col("total_amount") != "", F.lit(False))
    return R.route_records(e, "rec_id", "text", record, priced)


_CELL = "CASE " + " ".join(f"WHEN contains(x, '{m}') THEN '{m}'" for m in R.ROW_MARKS) + " " + " ".join(f"WHEN contains(upper(x), '{c}') THEN '{c}'" for c in R.ROW_CODES) + " END"


@query(f"WITH {records._CUT} SELECT doc, row_no, coalesce(list_filter(list_transform(cells, lambda x: {_CELL}), lambda v: v IS NOT NULL)[1], '') AS currency FROM rw")
def row_currency(spark: SparkSession, d: str) -> DataFrame:
    return records._rows(spark, d).select("doc", "row_no", R.row_currency(F.col("cells"), F.lit("")).alias("currency"))


_LU = f"lower({S.strip('unit_of_measurement')})"


@query("SELECT line_id, CASE " + " ".join(f"WHEN {S.has(_LU, f'^(?:{p})$')} THEN '{k}'" for k, p in R.UNIT_CLASSES.items()) + " END AS unit_class FROM normalized_procurement")
def unit_classes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "normalized_procurement").select("line_id", R.unit_class(F.col("unit_of_measurement")).alias("unit_class"))


@query(f"WITH {S.LINES} SELECT doc, line_no, " + ", ".join(f"nullif({S.group('line', p)}, '') AS {k}" for k, p in R.QUANTITY_FORMS.items()) + " FROM lines")
def line_quantities(spark: SparkSession, d: str) -> DataFrame:
    got = [F.nullif(F.regexp_extract("line", p, 1), F.lit("")).alias(k) for k, p in R.QUANTITY_FORMS.items()]
    return L.text_lines(_docs(spark, d), "doc_id", "text").select("doc", "line_no", *got)


@query(f"WITH {S.LINES} SELECT doc, line_no, " + ", ".join(f"nullif({S.squash(S.group('line', p))}, '') AS {k}" for k, p in R.DESCRIPTION_FORMS.items()) + " FROM lines")
def line_descriptions(spark: SparkSession, d: str) -> DataFrame:
    got = [F.nullif(fx.squash(F.regexp_extract("line", p, 1)), F.lit("")).alias(k) for k, p in R.DESCRIPTION_FORMS.items()]
    return L.text_lines(_docs(spark, d), "doc_id", "text").select("doc", "line_no", *got)


@query(f"SELECT line_id, try_cast(replace({S.group('item_description', R.PRICE_IN_TEXT)}, ',', '.') AS DOUBLE) AS price FROM normalized_procurement")
def price_in_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "normalized_procurement").select("line_id", R.price_in_text(F.col("item_description")).alias("price"))


@query("SELECT doc_id, coalesce(" + ", ".join(f"nullif({S.squash(S.group('text', '(?i)' + p))}, '')" for p in R.INVOICE_FORMS) + ") AS number FROM documents")
def invoice_number_forms(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", R.invoice_form(F.col("text")).alias("number"))


@query(f"WITH {S.LINES} SELECT doc, line_no, line FROM lines WHERE {S.has('lower(line)', R.SHORT_CANDIDATE)}")
def short_candidate_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.text_lines(_docs(spark, d), "doc_id", "text").where(F.lower("line").rlike(R.SHORT_CANDIDATE))


@query(f"SELECT line_id, coalesce({S.has('lower(item_description)', R.TECHNICAL_FLAG)}, FALSE) AS has_technical_requirements FROM normalized_procurement")
def technical_flag(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "normalized_procurement").select("line_id", R.technical(F.col("item_description")).alias("has_technical_requirements"))




@query(
    f"SELECT raw_id, {S.clean('pdf_name')} AS document_name, NULL::VARCHAR AS supplier_name, {S.clean('original_description')} AS item_description, CASE WHEN NOT isnan(quantity) THEN quantity END AS quantity, NULL::DOUBLE AS unit_price, NULL::DOUBLE AS total_price, "
    f"{records._CURR} AS currency, {records._DATE} AS delivery_date, {S.clean('item_id')} AS purchase_order_number, {S.clean('unit')} AS unit_of_measurement, {S.clean('technical_specifications')} AS technical_specifications FROM raw_extracted"
)
def normalised_records(spark: SparkSession, d: str) -> DataFrame:
    """All eleven fields of a normal record: supplier and prices are never found in a raw item."""
    n = Q.normalise(table(spark, d, "raw_extracted"))
    none = {"supplier_name": F.lit(None).cast("string"), "unit_price": F.lit(None).cast("double"), "total_price": F.lit(None).cast("double")}
    return n.withColumns({**none, "quantity": F.when(~F.isnan("quantity"), F.col("quantity"))})


@query(f"WITH {texts._MARK} SELECT arg_min(status, struct_pack(a := -n, b := status)) AS status, max(n) AS n FROM (SELECT status, count(*) n FROM m WHERE status <> 'SUCCESS' GROUP BY status)")
def most_common_failure(spark: SparkSession, d: str) -> DataFrame:
    """The status that most documents without success have, the first by name of equals; NULL where all succeed."""
    n = texts.marker_confidence(spark, d).where("status <> 'SUCCESS'").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.min_by("status", F.struct(-F.col("n"), F.col("status"))).alias("status"), F.max("n").alias("n"))


_P3 = f"SELECT doc AS doc_id, string_agg(lower(text), chr(10) ORDER BY page) AS text FROM pages WHERE page <= 3 GROUP BY doc"


@query(f"WITH {texts._PAGES} {_P3}")
def first_pages_text(spark: SparkSession, d: str) -> DataFrame:
    """The first three pages in lower case, as the router reads them."""
    docs = _docs(spark, d)
    kept = F.slice(F.filter(F.split("text", r"\n[ \t]*\n"), lambda x: fx.strip(x) != ""), 1, 3)
    return docs.select("doc_id", kept.alias("p")).where(F.size("p") > 0).select("doc_id", F.lower(F.array_join("p", "\n")).alias("text"))


_SC = S.sub(S.clean("item_description"), "([A-Za-z])0([A-Za-z])", r"\1O\2")
_FROM = f"coalesce(CASE {records._KNOWN} END, ".replace("text", "item_description") + ", ".join(f"nullif({S.strip(S.group('item_description', p))}, '')" for p in records._LABELS) + ")"
_STD = "CASE " + " ".join(f"WHEN upper(nm) = '{v}' THEN '{k}'" for k, vs in Q.SUPPLIERS.items() for v in vs) + " ELSE nm END"


@query(
    f"""WITH c AS (SELECT *, coalesce({S.clean('supplier_name')}, {S.clean(_FROM)}) nm, CASE WHEN contains({_SC}, 'll') THEN {S.sub(_SC, 'l+', '1')} ELSE {_SC} END de FROM normalized_procurement),
    m AS (SELECT *, de v FROM c), k AS (SELECT *, CASE {texts._CASES} END cm FROM m)
    SELECT line_id, {S.clean('document_name')} AS document_name, {_STD} AS supplier_name, de AS item_description, CASE WHEN NOT isnan(quantity) THEN quantity END AS quantity, unit_price, total_price,
    string_split(cm, '|')[1] AS currency, {', '.join(f"{S.clean(n)} AS {n}" for n in ('delivery_date', 'purchase_order_number', 'unit_of_measurement', 'technical_specifications'))},
    {', '.join(f'{n} AS "raw_value:{n}"' for n in Q.RECORD)}, string_split(cm, '|')[2] AS currency_name, string_split(cm, '|')[3] AS currency_raw_match,
    CASE WHEN isnan(quantity) THEN 'failed_numeric_conversion' WHEN quantity = 0 THEN 'quantity_is_zero' WHEN quantity > 1000000 THEN 'quantity_unusually_high' WHEN quantity < 0 THEN 'quantity_negative' END AS quantity_notes FROM k"""
)
def cleaned_records(spark: SparkSession, d: str) -> DataFrame:
    """Whole clean records with the entered twin of every field."""
    return Q.clean_records(spread(table(spark, d, "normalized_procurement")), "line_id")


_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_CAPS = f"x = upper(x) AND x <> lower(x) AND NOT {S.has('x', r'[\p{Ll}]')} AND length(x) >= 4 AND {S.words('x')} BETWEEN 3 AND 10"
_BY_LABEL = "coalesce(" + ", ".join(f"CASE WHEN length({S.squash(S.group('text', '(?i)' + p))}) >= 4 THEN {S.squash(S.group('text', '(?i)' + p))} END" for p in fx.SUPPLIER_LABELS) + ", '')"


@query(
    f"""WITH l AS (SELECT doc_id, text, {_BY_LABEL} by_label, list_filter(list_transform(regexp_split_to_array(text, {S.q(_ENDS)}), lambda x: {S.strip('x')}), lambda x: x <> '')[1:10] ls FROM documents),
    f AS (SELECT doc_id, by_label, list_filter(ls, lambda x: {_CAPS}) fit FROM l)
    SELECT doc_id, CASE WHEN by_label <> '' THEN by_label ELSE {S.squash(f"coalesce(list_filter(fit, lambda x: NOT {texts._TITLE})[1], fit[1], '')")} END AS supplier FROM f"""
)
def supplier_name(spark: SparkSession, d: str) -> DataFrame:
    """By label, else a line in capitals."""
    return texts.supplier_name(spark, d)


@query(f"WITH {records._LOG} SELECT pipeline, count(*) AS documents, sum(seconds) AS seconds, count(*) / sum(seconds) AS per_second FROM lg GROUP BY pipeline")
def batch_throughput(spark: SparkSession, d: str) -> DataFrame:
    """Documents, seconds and documents a second of the log; NULL where no time was taken."""
    n, took = F.count(F.lit(1)), F.sum("seconds")
    return records._logs(spark, d).groupBy("pipeline").agg(n.alias("documents"), took.alias("seconds"), F.try_divide(n, took).alias("per_second"))


@query(
    f"""SELECT doc, 'Document routed to ' || upper(route) || ' pipeline (confidence: ' || round(confidence * 100)::INT || '%)' AS explanation FROM ({SQL['route_records']})"""
)
def route_explanations(spark: SparkSession, d: str) -> DataFrame:
    """One sentence for each route."""
    percent = F.round(F.col("confidence") * 100).cast("int").cast("string")
    return route_records(spark, d).select("doc", F.concat(F.lit("Document routed to "), F.upper("route"), F.lit(" pipeline (confidence: "), percent, F.lit("%)")).alias("explanation"))


@query(f"WITH {texts._PAGES} SELECT doc, page, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {S.strip('x')}), lambda x: x <> '')[1:10], ' ') AS header FROM pages")
def page_headers(spark: SparkSession, d: str) -> DataFrame:
    return D.pages(_docs(spark, d)).select("doc", "page", C.page_header(F.col("text")).alias("header"))


@query()
def parsed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of tables by schema, scores and range repair; its parts have SQL or plain loops of their own."""
    r = records._rows(spark, d)
    return T.parse_rows(r, T.infer_schema(r))


@query()
def generated_documents(spark: SparkSession, d: str) -> DataFrame:
    """The four kinds of made documents, as many as there are in the table, through the marker check, by kind."""
    made = C.made_documents(spark, table(spark, d, "documents").count())
    return D.harness_metrics(D.marker_confidence(made), ["category"])


def _extraction_sql() -> str:
    """The whole chain from text to record, for two queries of plans.texts."""
    first = lambda k: f"coalesce({S.first_of('text', texts._F[k])}, '')"
    amount = texts._amount_sql
    gone = [f"CASE WHEN {n} = '' THEN '{n}' END" for n in D.MISSING_ORDER[:4]] + ["CASE WHEN n_items = 0 THEN 'line_items' END"] + [f"CASE WHEN coalesce({n}, 0) = 0 THEN '{n}' END" for n in D.MISSING_ORDER[5:]]
    return (
        texts._ITEMS
        + f""", ni AS (SELECT doc, count(*) n FROM f WHERE m <= 20 GROUP BY doc),
    ex AS (SELECT doc_id doc, {first('supplier')} supplier, {first('invoice_po')} invoice_or_po_number, {first('date')} issue_date, {first('currency')} currency, {amount('subtotal')} subtotal, {amount('tax')} tax,
      coalesce({amount('total')}, list_max({texts._PRICES})) total_amount, CAST({texts._CONF} AS INTEGER) quality, coalesce(n, 0) n_items FROM documents LEFT JOIN ni ON ni.doc = doc_id),
    ms AS (SELECT *, list_filter([{', '.join(gone)}], lambda x: x IS NOT NULL) mf FROM ex),
    xc AS (SELECT *, greatest(0, least(100, floor((8 - len(mf)) / 8 * 100) + floor(quality * 0.5) - 10 * len(list_filter(mf, lambda x: x IN ('supplier', 'invoice_or_po_number', 'total_amount')))))::INT confidence FROM ms)
    """
    )


SQL["extraction_confidence"] = _extraction_sql() + "SELECT doc, supplier, invoice_or_po_number, issue_date, currency, n_items, array_to_string(mf, ',') AS missing_fields, confidence FROM xc"
SQL["extraction_summary"] = _extraction_sql() + "SELECT count(*) AS total, avg(confidence) AS average_confidence, sum(n_items)::BIGINT AS line_items, sum(len(mf))::BIGINT AS missing FROM xc"
_S0 = _S.split("::DOUBLE + ")[0].removeprefix("least(") + "::DOUBLE"  # without the technical lines, which these texts don't have
SQL["route_with_signals"] = (
    _extraction_sql()
    + f""", rt AS (SELECT xc.doc, lower(text) t, supplier su, invoice_or_po_number nu, issue_date dt, subtotal IS NOT NULL OR total_amount IS NOT NULL pr FROM xc JOIN documents ON doc_id = xc.doc WHERE text IS NOT NULL)
    SELECT doc, {_P} AS procurement, {_S0} AS specification FROM rt"""
)
SQL["anti_join_text_items"] = (
    texts._ITEMS
    + f""", cl AS (SELECT doc, line_no, line description FROM lines WHERE {S.has('lower(line)', L.CANDIDATE)} OR ({S.has('line', L.NUMBER_LIKE)} AND length(line) > 20)),
    fr AS (SELECT *, row_number() OVER (PARTITION BY doc, description ORDER BY line_no) k FROM cl WHERE NOT EXISTS (SELECT 1 FROM f WHERE m <= 20 AND f.doc = cl.doc AND f.description = cl.description))
    SELECT doc, description, line_no FROM fr WHERE k = 1"""
)
