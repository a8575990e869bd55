"""Queries on records, tables of cells and logs, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.functions import fields as fx
from albaran.operators import audit as A
from albaran.operators import documents as D
from albaran.operators import lines as L
from albaran.operators import quality as Q
from albaran.operators import tables as T
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


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Normalized lines under the names of line records."""
    n = table(spark, d, "normalized_procurement")
    return n.select(
        "line_id", "document_name", "supplier_name", F.col("purchase_order_number").alias("invoice_or_po_number"), "item_description", "quantity", "unit_price",
        F.col("total_price").alias("total_amount"), "currency", "unit_of_measurement",
    )


_LN = """ln AS (SELECT line_id, document_name, supplier_name, purchase_order_number invoice_or_po_number, item_description, quantity, unit_price, total_price total_amount, currency,
  unit_of_measurement FROM normalized_procurement)"""
_TEXTS = ("supplier_name", "invoice_or_po_number", "item_description", "currency")


def _gone(f: str) -> str:
    return f"({f} IS NULL OR {S.strip(f)} = '')" if f in _TEXTS else f"({f} IS NULL OR isnan({f}))"


_MISS = "len(list_filter([" + ", ".join(f"CASE WHEN {_gone(f)} THEN '{f}' END" for f in Q.REQUIRED) + "], lambda x: x IS NOT NULL))"
_CLS = f"cl AS (SELECT *, {_MISS} n, CASE WHEN {_MISS} = 0 THEN 'VALID' WHEN {_MISS} <= 2 THEN 'PARTIAL' ELSE 'INVALID' END k FROM ln)"
_REP = "count(*) AS total_records, count(*) FILTER (k = 'VALID') AS valid_records, count(*) FILTER (k = 'PARTIAL') AS partial_records, count(*) FILTER (k = 'INVALID') AS invalid_records, sum(7 - n) / (count(*) * 7) AS completeness_score"


@query(f"WITH {_LN}, {_CLS} SELECT {_REP} FROM cl")
def record_quality_report(spark: SparkSession, d: str) -> DataFrame:
    return Q.quality_report(_lines(spark, d))


@query(f"WITH {_LN}, {_CLS} SELECT document_name, {_REP} FROM cl GROUP BY document_name")
def quality_by_document(spark: SparkSession, d: str) -> DataFrame:
    return Q.quality_report(_lines(spark, d), ["document_name"])


@query(f"WITH {_LN} " + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({_gone(f)}) AS missing FROM ln" for f in Q.REQUIRED))
def missing_fields_summary(spark: SparkSession, d: str) -> DataFrame:
    return Q.missing_summary(_lines(spark, d))


_FIELDS = ["supplier_name", "item_description", "quantity", "unit_price", "total_price", "currency", "delivery_date", "purchase_order_number", "unit_of_measurement", "technical_specifications"]
_COMPL = " UNION ALL ".join(f"SELECT '{f}' AS field, 100.0 * count({f}) / count(*) AS percent FROM normalized_procurement" for f in _FIELDS)


@query(_COMPL)
def completeness_by_field(spark: SparkSession, d: str) -> DataFrame:
    return Q.completeness(table(spark, d, "normalized_procurement"), _FIELDS)


@query(f"SELECT a AS average, CASE WHEN a >= 80 THEN 'EXCELLENT' WHEN a >= 60 THEN 'GOOD' WHEN a >= 40 THEN 'FAIR' ELSE 'POOR' END AS level FROM (SELECT avg(percent) a FROM ({_COMPL}))")
def quality_level(spark: SparkSession, d: str) -> DataFrame:
    return Q.quality_level(table(spark, d, "normalized_procurement"), _FIELDS)


_DD, _QQ = S.squash("coalesce(description, '')"), S.squash("coalesce(quantity, '')")
_UP = f"upper({_DD})"
_LIKE = f"({S.has(_UP, f'^(?:{T.HEADER_LIKE})(?: |$)')} OR ({_DD} = {_UP} AND {_UP} <> lower({_UP}) AND {S.words(_UP)} <= 3 AND {S.has(_UP, T.HEADER_LIKE)}))".replace(f"{_DD} = {_UP}", "TRUE")
_RC = f"""it AS (SELECT rec_id, i.description description, i.quantity quantity FROM (SELECT rec_id, unnest(line_items) i FROM extracted_procurement) WHERE i IS NOT NULL),
ck AS (SELECT rec_id, list_filter([
  CASE WHEN {S.sub(_DD, '[^0-9]')} <> '' AND {S.sub(_DD, '[^0-9]')} = replace({_DD}, ' ', '') THEN 'Description is numeric-only.' WHEN {_DD} <> '' AND {_LIKE} THEN 'Description appears header-like.' END,
  CASE WHEN {_QQ} <> '' AND NOT ({S.has(_QQ, '^[0-9]+$')} AND {S.safe_float(_QQ)} > 0) THEN 'Quantity is not a simple integer like 1 or 01.' END], lambda x: x IS NOT NULL) errors FROM it)"""


@query(f"WITH {_RC} SELECT rec_id, errors, CASE WHEN len(errors) = 0 THEN 'VALID' ELSE 'INVALID' END AS classification FROM ck")
def record_rule_check(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "extracted_procurement").select("rec_id", F.explode("line_items").alias("i")).where(F.col("i").isNotNull())
    return Q.record_checks(e.select("rec_id", "i.description", "i.quantity"), "rec_id", "description", "quantity")


_GC = ["document_name", "supplier_name", "unit_of_measurement", "currency"]


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value, count(*) AS n FROM normalized_procurement GROUP BY {f}" for f in _GC))
def dashboard_group_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.group_counts(table(spark, d, "normalized_procurement"), _GC)


@query("SELECT sum(v) AS total, avg(v) AS average, min(v) AS least, max(v) AS greatest, count(v) AS n FROM (SELECT CASE WHEN NOT isnan(quantity) THEN CAST(quantity AS DECIMAL(20,3)) END v FROM normalized_procurement)")
def quantity_metrics(spark: SparkSession, d: str) -> DataFrame:
    return Q.measures(table(spark, d, "normalized_procurement"), F.when(~F.isnan("quantity"), F.col("quantity").cast("decimal(20,3)")))


@query("SELECT sum(length(item_description))::BIGINT AS total, avg(length(item_description)) AS average, min(length(item_description)) AS least, max(length(item_description)) AS greatest, count(item_description) AS n FROM normalized_procurement")
def description_metrics(spark: SparkSession, d: str) -> DataFrame:
    return Q.measures(table(spark, d, "normalized_procurement"), F.length("item_description"))


def _pct(f: str) -> str:
    return f"100.0 * count(*) FILTER ({_gone(f)}) / count(*)"


def _full(f: str) -> str:
    return f"(NOT {_gone(f)} AND {f}::VARCHAR <> '0.0')"


@query(
    f"""WITH {_LN} SELECT document, total_records, missing_supplier_pct, missing_price_pct, missing_currency_pct, missing_number_pct, fields_seen,
    CASE WHEN h AND e >= greatest(1, floor(total_records * 0.6)) THEN 'HEADER_ONLY_DATA' ELSE 'SCATTERED_VALUES' END AS issue FROM (SELECT document_name document, count(*) total_records,
    {_pct('supplier_name')} missing_supplier_pct, {_pct('unit_price')} missing_price_pct, {_pct('currency')} missing_currency_pct, {_pct('invoice_or_po_number')} missing_number_pct,
    bool_or(NOT {_gone('supplier_name')})::INT + bool_or(NOT {_gone('unit_price')})::INT + bool_or(NOT {_gone('currency')})::INT + bool_or(NOT {_gone('invoice_or_po_number')})::INT fields_seen,
    bool_or({_full('supplier_name')} OR {_full('invoice_or_po_number')}) h, count(*) FILTER (NOT {_full('item_description')} AND NOT {_full('quantity')} AND NOT {_full('total_amount')}) e FROM ln GROUP BY 1)"""
)
def diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return Q.diagnostics(_lines(spark, d), "document_name", "supplier_name", "invoice_or_po_number", "item_description", "quantity", "unit_price", "total_amount", "currency")


_DC = S.clean("original_description")
_CURR = "CASE " + " ".join(f"WHEN {S.has(f'upper({_DC})', p)} THEN '{c}'" for c, p in fx.CURRENCY_SHORT) + " END"
_DATE = "coalesce(" + ", ".join(f"nullif({S.group(_DC, '(?i)' + p)}, '')" for p in fx.DATES) + ")"


@query(
    f"""SELECT raw_id, {S.clean('pdf_name')} AS document_name, {_DC} AS item_description, quantity, {_CURR} AS currency, {_DATE} AS delivery_date, {S.clean('item_id')} AS purchase_order_number,
    {S.clean('unit')} AS unit_of_measurement, {S.clean('technical_specifications')} AS technical_specifications FROM raw_extracted"""
)
def normalize_records(spark: SparkSession, d: str) -> DataFrame:
    return Q.normalise(table(spark, d, "raw_extracted"))


@query()
def clean_records(spark: SparkSession, d: str) -> DataFrame:
    return Q.clean(table(spark, d, "normalized_procurement"))


_NAMES = ["supplier_name", "quantity", "currency", "item_description", "purchase_order_number"]


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, count({f}) AS found, count(DISTINCT {f}) AS distinct_values, count(*) - count({f}) AS nulls FROM cleaned_procurement" for f in _NAMES))
def cleaning_report(spark: SparkSession, d: str) -> DataFrame:
    return Q.cleaning_report(table(spark, d, "cleaned_procurement"))


@query("SELECT count(*) AS total, count(DISTINCT document_name) AS documents, count(DISTINCT nullif(supplier_name, '')) AS suppliers, count(DISTINCT nullif(currency, '')) AS currencies, count(*) - count(quantity) AS null_quantities FROM normalized_procurement")
def normalization_summary(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "normalized_procurement")
    some = lambda c: F.count_distinct(F.nullif(F.col(c), F.lit("")))
    return n.agg(F.count(F.lit(1)).alias("total"), F.count_distinct("document_name").alias("documents"), some("supplier_name").alias("suppliers"), some("currency").alias("currencies"), F.count_if(F.col("quantity").isNull()).alias("null_quantities"))


_DICT = "(VALUES " + ", ".join(f"('{v}', '{k}')" for k, vs in Q.SUPPLIERS.items() for v in vs) + ") x(variant, standard)"


@query(f"SELECT line_id, supplier, standard FROM (SELECT line_id, {S.clean('supplier_name')} supplier FROM normalized_procurement) LEFT JOIN {_DICT} ON upper(supplier) = variant")
def supplier_dictionary_join(spark: SparkSession, d: str) -> DataFrame:
    return Q.standard_suppliers(table(spark, d, "normalized_procurement"), "line_id", "supplier_name")


_LABELS = [rf"(?i){w}[:\s]+([A-Za-záéíóúñüAÉÍÓÚÑÜ\s&,.]+?)(?:\n|$)" for w in Q.SUPPLIER_LABELS]
_KNOWN = " ".join(f"WHEN contains(upper(text), '{v}') THEN '{k}'" for k, vs in Q.SUPPLIERS.items() for v in vs)


@query(f"SELECT doc_id, coalesce(CASE {_KNOWN} END, " + ", ".join(f"nullif({S.strip(S.group('text', p))}, '')" for p in _LABELS) + ") AS supplier FROM documents")
def supplier_from_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", Q.supplier_from_text(F.col("text")).alias("supplier"))


_CUT = f"""tr AS (SELECT doc_id doc, generate_subscripts(string_split(text, chr(10)), 1) - 1 row_no, unnest(string_split(text, chr(10))) line FROM documents),
rw AS (SELECT doc, row_no, list_transform(string_split(line, '|'), lambda x: {S.strip('x')}) cells FROM tr WHERE contains(line, '|'))"""
_V = f"upper({S.strip('x')})"
_HEAD = f"""(len(list_filter(cells, lambda x: {S.has(_V, T.HEADER_LABELS)} OR (upper({_V}) = {_V} AND {_V} <> lower({_V}) AND length({_V}) <= 20 AND {S.words(_V)} <= 3 AND NOT {S.has(_V, T.NUMERIC)})))
  >= greatest(1, floor(len(cells) * 0.4)))"""


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return T.piped_rows(spread(table(spark, d, "documents")), "doc_id", "text")


@query(f"WITH {_CUT} SELECT doc, row_no, {_HEAD} AS is_header FROM rw")
def header_rows(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("doc", "row_no", T.is_header_row(F.col("cells")).alias("is_header"))


@query()
def merge_broken_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows merged to the width of five; tested against a plain loop."""
    return T.merge_broken_rows(_rows(spark, d), 5)


_CELL = "cell"
_CURCELL = f"({S.has('cell', '[$£€¥]')} OR {S.has('upper(cell)', T.SCHEMA_CODES)})"
_PR = f"(cell <> '' AND ({_CURCELL} OR {S.has('cell', '[0-9]')}))"
_DG = "replace(replace(cell, ',', ''), '.', '')"
_NC = S.sub("cell", "[^0-9.,]")
_GARB = f"(length({_NC}) > 15 OR {S.has(_NC, '|'.join(str(i) * 4 for i in range(10)))} OR {S.has('cell', '(?:[0-9][.][0-9]){4,}')})"


def _spn(c: str) -> str:
    from albaran.plans.texts import _safe_parse_sql

    return _safe_parse_sql(c)


_STATS = f"""{_CUT}, hd AS (SELECT *, {_HEAD} h FROM rw), bd AS (SELECT * FROM hd WHERE NOT h OR doc IN (SELECT doc FROM hd GROUP BY doc HAVING bool_and(h))),
ce AS (SELECT doc, generate_subscripts(cells, 1) - 1 col_idx, {S.squash('unnest(cells)')} cell FROM bd),
st AS (SELECT doc, col_idx, count(*) FILTER ({_PR}) price_count, count(*) FILTER ({S.has(_DG, '^[0-9]+$')} AND length({_DG}) <= 5) quantity_count, count(*) FILTER ({_PR} AND {_CURCELL}) currency_count,
  sum(length(cell))::BIGINT text_length, count(*) FILTER ({S.has('cell', T.NUMERIC)}) numeric_count, max(CASE WHEN {_PR} THEN {_spn('cell')} ELSE 0.0 END)::DOUBLE max_price_value FROM ce WHERE NOT {_GARB} GROUP BY ALL)"""


@query(f"WITH {_STATS} SELECT * FROM st")
def column_stats(spark: SparkSession, d: str) -> DataFrame:
    return T.column_statistics(_rows(spark, d))


def _best(order: str) -> str:
    return f"(list(col_idx ORDER BY {order}, col_idx))[1]"


_INF = f"""{_STATS}, b AS (SELECT doc, {_best('text_length DESC, numeric_count')} d, {_best('quantity_count DESC, price_count, text_length')} q,
  {_best('price_count DESC, currency_count DESC, numeric_count')} p, {_best('max_price_value DESC, price_count DESC, currency_count DESC')} t FROM st GROUP BY doc),
b1 AS (SELECT doc, d, t, CASE WHEN q = d THEN coalesce((SELECT min(col_idx) FROM st WHERE st.doc = b.doc AND col_idx <> d AND quantity_count > 0), q) ELSE q END q,
  CASE WHEN p = d THEN coalesce((SELECT min(col_idx) FROM st WHERE st.doc = b.doc AND col_idx <> d AND price_count > 0), p) ELSE p END p FROM b),
b2 AS (SELECT doc, d, q, p, CASE WHEN t = d THEN coalesce((SELECT min(col_idx) FROM st WHERE st.doc = b1.doc AND col_idx <> d AND price_count > 0), t) ELSE t END t FROM b1),
b3 AS (SELECT doc, d, q, p, CASE WHEN t = p THEN coalesce((SELECT min(col_idx) FROM st WHERE st.doc = b2.doc AND col_idx <> p AND price_count > 0), t) ELSE t END t FROM b2),
sc AS (SELECT doc, CASE WHEN (SELECT text_length FROM st WHERE st.doc = b3.doc AND col_idx = d) > 0 THEN d END::INT description, CASE WHEN (SELECT quantity_count FROM st WHERE st.doc = b3.doc AND col_idx = q) > 0 THEN q END::INT quantity,
  CASE WHEN (SELECT price_count FROM st WHERE st.doc = b3.doc AND col_idx = p) > 0 THEN p END::INT unit_price, CASE WHEN (SELECT price_count FROM st WHERE st.doc = b3.doc AND col_idx = t) > 0 THEN t END::INT total_amount FROM b3)"""


@query(f"WITH {_INF} SELECT * FROM sc")
def infer_schema(spark: SparkSession, d: str) -> DataFrame:
    return T.infer_schema(_rows(spark, d))


_MAP = "mp AS (SELECT rw.doc, row_no, cells, " + ", ".join(f"coalesce({S.squash(f'cells[sc.{r} + 1]')}, '') {r}" for r in T.ROLES) + " FROM rw LEFT JOIN sc USING (doc))"


@query(f"WITH {_INF}, {_MAP} SELECT * FROM mp")
def map_row_cells(spark: SparkSession, d: str) -> DataFrame:
    r = _rows(spark, d)
    return T.map_cells(r, T.infer_schema(r))


@query()
def score_fields(spark: SparkSession, d: str) -> DataFrame:
    """Scores of all cells for all roles; tested against a plain loop."""
    return T.score_cells(_rows(spark, d))


@query()
def resolve_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Roles to columns without conflicts and the values' checks; tested against a plain loop."""
    return T.scored_fields(_rows(spark, d))


@query()
def align_rows(spark: SparkSession, d: str) -> DataFrame:
    r = _rows(spark, d)
    return T.align_rows(r, T.infer_schema(r))


_OKS = f"list_sort(list_filter(list_transform(cells, lambda x: {S.safe_float(S.squash('x'))}), lambda v: v BETWEEN 1 AND 10000))"
_POS = f"list_filter(list_transform(cells, lambda x: {S.safe_float(S.squash('x'))}), lambda v: v > 0)"


def _fix(r: str, at: str) -> str:
    return f"CASE WHEN len(pos) > 1 AND len(oks) > 0 AND {r} <> '' AND NOT {S.safe_float(r)} BETWEEN 1 AND 10000 THEN {at}::VARCHAR ELSE {r} END AS {r}"


@query(f"WITH {_INF}, {_MAP}, rr AS (SELECT *, {_OKS} oks, {_POS} pos FROM mp) SELECT doc, row_no, description, {_fix('quantity', 'oks[1]')}, {_fix('unit_price', 'oks[len(oks) // 2 + 1]')}, {_fix('total_amount', 'oks[-1]')} FROM rr")
def range_repair(spark: SparkSession, d: str) -> DataFrame:
    r = _rows(spark, d)
    return T.range_repair(T.map_cells(r, T.infer_schema(r)))


@query()
def anti_join_text_items(spark: SparkSession, d: str) -> DataFrame:
    """Candidate lines of a text that are no line item of it yet."""
    docs = table(spark, d, "documents")
    texts = L.candidate_lines(docs, "doc_id", "text").withColumnRenamed("line", "description")
    return L.unseen_items(texts, L.line_items(docs, "doc_id", "text"))


@query(
    """WITH n AS (SELECT document_name, count(*) k FROM normalized_procurement GROUP BY 1), r AS (SELECT pdf_name document_name, count(*) k FROM raw_extracted GROUP BY 1)
    SELECT document_name, k AS n_lines, 'normalized' AS way FROM n UNION ALL SELECT document_name, k, 'raw' FROM r WHERE document_name NOT IN (SELECT document_name FROM n WHERE document_name IS NOT NULL) OR document_name IS NULL"""
)
def table_or_text_rows(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the first source a document has; the second only where the first has none."""
    n = table(spark, d, "normalized_procurement").groupBy("document_name").agg(F.count(F.lit(1)).alias("n_lines")).withColumn("way", F.lit("normalized"))
    r = table(spark, d, "raw_extracted").groupBy(F.col("pdf_name").alias("document_name")).agg(F.count(F.lit(1)).alias("n_lines")).withColumn("way", F.lit("raw"))
    return n.unionByName(r.join(n.select("document_name"), "document_name", "left_anti"))


def _num(c: str) -> str:
    return S.parse_numeric(f"nullif({S.strip(c)}, '')")


_VAL = f"""nm AS (SELECT *, {_num('subtotal')} + {_num('tax')} calc, {_num('total_amount')} tot, coalesce(len(line_items), 0) > 0 items, document_type = 'text' txt, coalesce(confidence_score, 0) score FROM extracted_procurement),
va AS (SELECT rec_id, list_filter([{', '.join(f"CASE WHEN txt AND coalesce({f}, '') = '' THEN 'missing {f}' END" for f in D.CRITICAL)}, CASE WHEN txt AND NOT items THEN 'no line items' END,
  CASE WHEN txt AND calc > 0 AND tot IS NOT NULL AND abs(calc - tot) / calc > 0.05 THEN 'amounts differ' END], lambda x: x IS NOT NULL) errors,
 list_filter([{', '.join(f"CASE WHEN NOT txt AND coalesce({f}, '') = '' THEN 'missing {f}' END" for f in D.CRITICAL)}, CASE WHEN NOT txt AND (score = 0 OR NOT items) THEN 'nothing extracted' END,
  CASE WHEN txt AND (calc IS NULL OR tot IS NULL) THEN 'amounts incomplete' END, CASE WHEN txt AND calc <= 0 AND tot IS NOT NULL AND calc <> tot THEN 'amounts differ' END,
  CASE WHEN document_type = 'scanned' AND score = 0 THEN 'confidence zero' WHEN document_type = 'scanned' AND score < 20 THEN 'confidence very low' END], lambda x: x IS NOT NULL) warnings,
 coalesce(txt AND calc IS NOT NULL AND tot IS NOT NULL AND ((calc = 0 AND tot = 0) OR (calc > 0 AND abs(calc - tot) / nullif(calc, 0) <= 0.05) OR (calc <= 0 AND calc = tot)), FALSE) subtotal_match FROM nm)"""


@query(f"WITH {_VAL} SELECT rec_id, len(errors) = 0 AS is_valid, errors, warnings, subtotal_match FROM va")
def validate_documents(spark: SparkSession, d: str) -> DataFrame:
    return D.validate(table(spark, d, "extracted_procurement"), "rec_id")


@query(f"WITH {_VAL} SELECT count(*) AS records, count(*) FILTER (len(errors) = 0) AS valid, sum(len(errors))::BIGINT AS errors, sum(len(warnings))::BIGINT AS warnings, 100 * count(*) FILTER (len(errors) = 0) // count(*) AS pass_percent FROM va")
def validation_totals(spark: SparkSession, d: str) -> DataFrame:
    v = validate_documents(spark, d)
    n, ok = F.count(F.lit(1)), F.count_if("is_valid")
    return v.agg(n.alias("records"), ok.alias("valid"), F.sum(F.size("errors")).alias("errors"), F.sum(F.size("warnings")).alias("warnings"), F.floor(F.try_divide(ok * 100, n)).alias("pass_percent"))


_GARBLED = S.has("i.description", r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}\-.,():/]|[\x00-\x1f]")


@query(
    f"""SELECT rec_id, coalesce(confidence_score, 0) < 20 AS confidence_very_low, coalesce(len(list_filter(line_items, lambda i: coalesce({_GARBLED}, FALSE))) > 0, FALSE) AS has_garbled_text,
    coalesce(len(line_items), 0) = 1 AS has_missing_rows FROM extracted_procurement WHERE document_type = 'scanned'"""
)
def ocr_checks(spark: SparkSession, d: str) -> DataFrame:
    return D.ocr_checks(table(spark, d, "extracted_procurement"), "rec_id")


_RULES = {
    "confidence_score range": "confidence_score NOT BETWEEN 0 AND 100",
    "currency form": f"currency <> '' AND NOT {S.has('currency', '^[A-Z]{3}$')}",
    "negative subtotal": f"{_num('subtotal')} < 0",
    "negative tax": f"{_num('tax')} < 0",
    "negative total_amount": f"{_num('total_amount')} < 0",
    "document_type kind": "document_type NOT IN ('text', 'scanned', 'unknown')",
    "empty description": "len(list_filter(line_items, lambda i: i IS NOT NULL AND coalesce(i.description, '') = '')) > 0",
}


@query(" UNION ALL ".join(f"SELECT rec_id, '{n}' AS violation FROM extracted_procurement WHERE {c}" for n, c in _RULES.items()))
def schema_violations(spark: SparkSession, d: str) -> DataFrame:
    return D.schema_violations(table(spark, d, "extracted_procurement"), "rec_id")


_LOG = """lg AS (SELECT event_id log_id, ts, CASE WHEN user_id % 2 = 0 THEN 'procurement' ELSE 'specification' END AS pipeline, value AS seconds, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS confidence,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'WARNING' WHEN 'signup' THEN 'REQUIRES_REVIEW' ELSE 'SUCCESS' END status FROM events)"""


def _logs(spark: SparkSession, d: str) -> DataFrame:
    return A.from_events(table(spark, d, "events"))


@query(f"WITH {_LOG} SELECT count(*) AS total_documents, count(*) FILTER (status = 'SUCCESS') AS successful, count(*) FILTER (status = 'WARNING') AS warnings, count(*) FILTER (status = 'FAILED') AS failed, 100.0 * count(*) FILTER (status = 'SUCCESS') / count(*) AS success_rate, avg(confidence) AS average_confidence FROM lg")
def execution_report(spark: SparkSession, d: str) -> DataFrame:
    return A.execution_report(_logs(spark, d))


@query(f"WITH {_LOG} SELECT pipeline, status, count(*) AS n, min(confidence) AS least_confidence, max(confidence) AS greatest_confidence FROM lg GROUP BY ALL")
def by_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return A.by_pipeline(_logs(spark, d))


@query(f"WITH {_LOG} SELECT status, avg(seconds) AS average, min(seconds) AS least, max(seconds) AS greatest, coalesce(stddev_samp(seconds), 0.0) AS deviation FROM lg GROUP BY status")
def resource_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.sample_statistics(_logs(spark, d), "status", "seconds")


@query("SELECT count(*) AS n, count(DISTINCT document_name) AS documents, coalesce(array_to_string(list_sort(list(DISTINCT extraction_method)), ','), '') AS methods FROM extracted_procurement WHERE coalesce(error, '') <> '' OR extraction_method IN ('ocr_unavailable', 'ocr_error', 'error')")
def degradation_summary(spark: SparkSession, d: str) -> DataFrame:
    return A.degradations(table(spark, d, "extracted_procurement"), "document_name", "extraction_method", "error")


@query(f"SELECT rec_id, coalesce({S.parse_numeric('total_amount')}, {S.safe_float('total_amount')}) AS amount, CASE WHEN {S.parse_numeric('total_amount')} IS NOT NULL THEN 1 ELSE 2 END AS attempts, CASE WHEN {S.parse_numeric('total_amount')} IS NOT NULL THEN 'primary' ELSE 'fallback' END AS method FROM extracted_procurement")
def retry_metadata(spark: SparkSession, d: str) -> DataFrame:
    """A primary reader and its fallback, with the way each value came."""
    from albaran.functions.numparse import parse_numeric, safe_float

    e = table(spark, d, "extracted_procurement").select("rec_id", "total_amount")
    c = F.col("total_amount")
    return A.with_fallback(e, parse_numeric(c), safe_float(c), "amount").drop("total_amount")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, min(value) AS least, max(value) AS greatest FROM events GROUP BY ALL")
def stream_event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Tumbling windows over a stream of the events' files, run to its end."""
    from albaran.streaming import events as E

    stream = E.read_files(spark, d, "events.parquet", table(spark, d, "events").schema)
    return E.run_to_end(E.window_counts(stream, "ts", "event_type", late="3650 days"), "events")


@query("SELECT violation, count(*) AS n, count(DISTINCT rec_id) AS records FROM (" + " UNION ALL ".join(f"SELECT rec_id, '{n}' AS violation FROM extracted_procurement WHERE {c}" for n, c in _RULES.items()) + ") GROUP BY violation")
def schema_violation_summary(spark: SparkSession, d: str) -> DataFrame:
    return schema_violations(spark, d).groupBy("violation").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("rec_id").alias("records"))


@query("SELECT rec_id, to_json(CASE WHEN error IS NULL THEN [] ELSE [error] END)::VARCHAR AS errors_json FROM extracted_procurement")
def errors_as_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_procurement").select("rec_id", F.to_json(F.array_compact(F.array("error"))).alias("errors_json"))


@query("SELECT document_type, count(*) AS records, avg(confidence_score) AS average_confidence, sum(coalesce(len(missing_fields), 0))::BIGINT AS missing, sum(coalesce(len(line_items), 0))::BIGINT AS items, count(*) FILTER (coalesce(error, '') <> '') AS with_error FROM extracted_procurement GROUP BY document_type")
def display_summary(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "extracted_procurement")
    size = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0))
    return e.groupBy("document_type").agg(
        F.count(F.lit(1)).alias("records"), F.avg("confidence_score").alias("average_confidence"), size("missing_fields").alias("missing"), size("line_items").alias("items"),
        F.count_if(F.coalesce("error", F.lit("")) != "").alias("with_error"),
    )
