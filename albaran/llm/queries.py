"""The queries of the problems on names, values, batches, tokens, mixes and languages, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from albaran.llm import batches, canonical, language, mixing, names, tokens
from albaran.session import cut, spread, table

Query = Callable[[SparkSession, str], DataFrame]


def _names(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "extracted_procurement").select(F.col("supplier").alias("name"))
    return a.unionByName(table(spark, d, "normalized_procurement").select(F.col("supplier_name").alias("name")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variants(_names(spark, d))


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """One row for each linked spelling: its class and the class's size."""
    clean = _names(spark, d).where(F.col("name").rlike(r"\p{L}")).select("name").distinct()
    cls = cut(names.variant_classes(clean))
    return cls.join(cls.groupBy("cls").agg(F.count(F.lit(1)).alias("spellings")), "cls").select("name", "cls", "spellings")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    ref = table(spark, d, "currency_reference")
    a = canonical.map_values(table(spark, d, "extracted_procurement"), "rec_id", "currency", "extracted", ref)
    b = canonical.map_values(table(spark, d, "cleaned_procurement"), "line_id", "raw_value:currency", "cleaned", ref)
    return a.unionByName(b)


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Report of the entries without a code: how many rows by source."""
    return p3_found(spark, d).where("code = 'NONE'").groupBy("src").agg(F.count(F.lit(1)).alias("n_rows"))


def p3_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct value of either column with all entries within its distance."""
    a, b = table(spark, d, "extracted_procurement").select("currency"), table(spark, d, "cleaned_procurement").select(F.col("`raw_value:currency`").alias("currency"))
    return canonical.within(a.unionByName(b), "currency", table(spark, d, "currency_reference"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return batches.pairs_by_batches(table(spark, d, "extracted_procurement"), table(spark, d, "sites"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each record with its class of deliveries of one document."""
    return batches.classes_by_batches(table(spark, d, "extracted_procurement"), table(spark, d, "sites"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(spread(table(spark, d, "documents")), "doc_id", "text")


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """doc_id and whether the decoded tokens give the text back (NULL counts as empty)."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = tokens.decode(tokens.encode(docs, "doc_id", "text"), "doc_id").select("doc_id", F.sha2("text", 256).alias("back"))
    return docs.select("doc_id", F.sha2("text", 256).alias("own")).join(back, "doc_id").select("doc_id", (F.col("own") == F.col("back")).alias("same"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[1]


def p9_marginals(spark: SparkSession, d: str) -> DataFrame:
    """Shares aimed at, of the raked weights and reached, by source, language and topic."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "source_targets"))[2]


def _segments(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return language.segments(spread(docs), language.train(docs))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return language.corrections(_segments(spark, d)).select("doc_id", "seg_no", "lang")


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every text and every paragraph of mixed ones with its language and confidence."""
    return _segments(spark, d).select("doc_id", "seg_no", "lang", F.round("confidence", 4).alias("confidence"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (p2_found, p2_classes, p3_found, p3_unmatched, p3_candidates, p5_found, p5_classes, p8_ids, p8_round_trip, p9_mix, p9_shares, p9_marginals, p10_found, p10_segments)
}


def _candidates_sql() -> str:
    """All values against all paths, by plain edit distance: what the automaton finds. Aliases of codes that aren't in the list don't count."""
    paths = [(line.partition(":")[0], canonical.fold(p)) for line in canonical.CURRENCY_ALIASES.strip().split("\n") for p in line.partition(":")[2].split(",") if p.strip()]
    alias = ", ".join("('" + c + "', '" + p.replace("'", "''") + "')" for c, p in paths)
    fold = lambda c: f"trim(regexp_replace(replace(strip_accents(lower({c})), 'ł', 'l'), '\\s+', ' ', 'g'))"
    return f"""WITH al(code, path) AS (VALUES {alias}), pt AS (SELECT code, path FROM al JOIN currency_reference USING (code) UNION SELECT code, {fold('name')} FROM currency_reference UNION SELECT code, lower(code) FROM currency_reference),
    vs AS (SELECT DISTINCT currency AS value FROM extracted_procurement WHERE currency <> '' UNION SELECT "raw_value:currency" FROM cleaned_procurement WHERE "raw_value:currency" <> ''),
    fv AS (SELECT value, {fold('value')} f FROM vs), ds AS (SELECT value, code, damerau_levenshtein(f, path) d, CASE WHEN length(f) <= 3 THEN 0 WHEN length(f) <= 6 THEN 1 ELSE 2 END most FROM fv, pt)
    SELECT value, code, min(d)::INT AS distance FROM ds WHERE d <= most GROUP BY value, code"""


SQL: dict[str, str] = {
    "p3_candidates": _candidates_sql(),
    "p8_round_trip": "SELECT doc_id, TRUE AS same FROM documents",
}
