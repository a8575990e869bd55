"""Fields out of running text: the first pattern of an ordered list that gives a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from albaran.functions.numparse import parse_decimal_legacy
from albaran.functions.text import spaced, squash, strip

_NAME = r"[A-Za-záéíóúñüAÉÍÓÚÑÜ\s,.&]"
# Patterns of the labelled fields, in the order in which they are tried.
FIELD_PATTERNS = {
    "invoice_po": [
        r"(?:Invoice|Factura)[\s#:]*([A-Z0-9\-]{4,20})",
        r"(?:PO|P\.O|ORDER)[\s#:]*([A-Z0-9\-]{4,20})",
        r"(?:Número|Ref|Reference)[\s#:]*([A-Z0-9\-]{4,20})",
    ],
    "date": [
        r"(?:Date|Fecha|Issue Date|Fecha de emisión)[:\s]+(\d{1,2}[-/]\d{1,2}[-/]\d{2,4})",
        r"(\d{1,2}[-/]\d{1,2}[-/]\d{2,4})",
    ],
    "supplier": [
        rf"(?:Supplier|Proveedor|Vendor|From)[:\s]+({_NAME}{{5,50}}?)(?:\n|,|$)",
        rf"(?:Company|Empresa|Organization)[:\s]+({_NAME}{{5,50}}?)(?:\n|,|$)",
    ],
    "currency": [r"(?:Currency|Moneda)[:\s]*([A-Z]{3})", r"[\s(]([A-Z]{3})[\s)]", r"(USD|EUR|GBP|MXN|COP|ARS)"],
    "quantity": [r"(?:Qty|Quantity|Cantidad)[:\s]*([\d,.]+)", r"([\d,.]+)(?:\s*(?:u|un|pcs|kg|m))"],
    "tax": [r"(?:Tax|VAT|IVA|Impuesto)[:\s]*\$?[\s]*([\d,.]+)"],
}
FIELD_PATTERNS = {k: [spaced(p) for p in v] for k, v in FIELD_PATTERNS.items()}
# A price, and amounts by their label.
PRICE = r"(?:[$€£]|USD|EUR|GBP|MXN|COP|ARS|CAD|AUD)?\s*([0-9]{1,3}(?:[.,][0-9]{3})*(?:[.,][0-9]{1,2})?)"
LABELLED_AMOUNTS = {
    "subtotal": r"(?:Subtotal|Sub-total|Sub Total)[:\s]*[$€£]?\s*([\d,.]+)",
    "tax": r"(?:Tax|VAT|IVA|Impuesto|Impuesto Ventas)[:\s]*[$€£]?\s*([\d,.]+)",
    "total": r"(?:Total Amount|Total|Total Due|Monto Total|Importe Total|Total a Pagar)[:\s]*[$€£]?\s*([\d,.]+)",
}
# Numbers of documents by their prefix, strict and loose.
STRICT_NUMBERS = [
    r"\bINV[-_]?([0-9A-Z]{4,15})\b",
    r"\bPO[-_]?([0-9A-Z]{4,15})\b",
    r"\bOC[-_]?([0-9A-Z]{4,15})\b",
    r"\bINVOICE\s*(?:NO\.?|NUMBER)[-_\s]?([0-9A-Z]{4,15})\b",
    r"\bPURCHASE\s*ORDER\s*(?:NO\.?|NUMBER)[-_\s]?([0-9A-Z]{4,15})\b",
    r"\bORDER\s*NO\.?[-_\s]?([0-9A-Z]{4,15})\b",
    r"\bREF(?:ERENCE)?\s*(?:NO\.?|NUMBER)[-_\s]?([0-9A-Z]{4,15})\b",
]
LOOSE_NUMBERS = [
    r"\binvoice(?:\s*no\.?|\s*number|\s*#)?\s*[:\-]?\s*([A-Z0-9\-/]+)",
    r"\bpo(?:\s*no\.?|\s*number|\s*#)?\s*[:\-]?\s*([A-Z0-9\-/]+)",
    r"\bpurchase order\s*[:\-]?\s*([A-Z0-9\-/]+)",
    r"\border\s*number\s*[:\-]?\s*([A-Z0-9\-/]+)",
    r"\bref(?:erence)?\s*[:\-]?\s*([A-Z0-9\-/]+)",
]
# Labels of a supplier.
SUPPLIER_LABELS = [
    r"\b(?:SUPPLIED?\s+BY|SUPPLIER|VENDOR|FROM)\b\s*[:\-]?\s*([A-Z][A-Z0-9\s&.,\-]{3,100})",
    r"\b(?:COMPANY|FIRM|FIRM NAME)\b\s*[:\-]?\s*([A-Z][A-Z0-9\s&.,\-]{3,100})",
]
# Currencies by their words, marks and codes, in the order they are looked for.
CURRENCY_MAP = [
    ("EUR", "€|EUR|EURO|€URO", "Euro"),
    ("USD", r"\$|USD|DÓLAR|DOLARES|DOLAR", "US Dollar"),
    ("GBP", "£|GBP|LIBRA|LIBRAS", "British Pound"),
    ("MXN", "MXN|PESO MX|PESOS", "Mexican Peso"),
    ("COP", "COP|PESO CO|PESOS", "Colombian Peso"),
    ("ARS", "ARS|PESO AR|PESOS", "Argentine Peso"),
]
CURRENCY_SHORT = [("EUR", "€|EUR|EURO"), ("USD", r"\$|USD|DÓLAR"), ("GBP", "£|GBP|LIBRA"), ("MXN", "MXN|PESO"), ("COP", "COP|PESO"), ("ARS", "ARS|PESO")]
CURRENCY_SYMBOLS = [("$", "USD"), ("£", "GBP"), ("€", "EUR"), ("¥", "JPY"), ("S/", "PEN")]
CURRENCY_CODES = "USD GBP EUR CAD AUD MXN COP ARS PEN BRL INR CNY JPY CHF SEK NOK DKK NZD ZAR HKD SGD THB MYR PHP IDR VND".split()
# Dates as they are written, kinds of documents, words of titles, key words of specifications.
DATES = [
    r"(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
    r"(\d{1,2}\s+(?:de\s+)?(?:enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre)\s+\d{4})",
]
DOCUMENT_TYPES = [
    ("invoice", r"\binvoice\b|\bamount due\b|\btotal due\b|\bamount payable\b"),
    ("po", r"\bpurchase order\b|\bpo number\b|\bpo\b|\border no\.?\b"),
    ("tender", r"\btender\b|\bbid\b|\bproposal\b|\brfq\b"),
]
TITLE_PHRASES = "TERMINO DE REFERENCIA|TERMS OF REFERENCE|STATEMENT OF WORK|REQUEST FOR QUOTATION|RFP|RFQ|INSTRUCTIONS TO BIDDERS|TERMS AND CONDITIONS|SCOPE OF WORK"
TITLE_WORDS = "TERMS|REFERENCIA|SCOPE|REQUEST|BID|TENDER|STATEMENT|INSTRUCTIONS|CONDITIONS"
SPEC_WORDS = "especificación característica dimensión material voltaje capacidad potencia marca modelo color grosor peso rendimiento altura ancho profundidad diámetro".split()


def first_of(c: Column, patterns: list[str], flags: str = "(?imd)", low: int = 2, high: int = 200) -> Column:
    """The first pattern's first match whose stripped value has a length in the range; NULL where there is none."""
    found = [strip(F.regexp_extract(c, flags + p, 1)) for p in patterns]
    return F.coalesce(*[F.when(F.length(v).between(low, high), v) for v in found])


def field(c: Column, name: str) -> Column:
    return first_of(c, FIELD_PATTERNS[name])


def prices(c: Column) -> Column:
    """All amounts over 0 and under ten million, in their order."""
    raw = F.regexp_extract_all(c, F.lit("(?i)" + PRICE), F.lit(1))
    return F.filter(F.transform(raw, parse_decimal_legacy), lambda v: (v > 0) & (v < 10_000_000))


def labelled_amount(c: Column, name: str) -> Column:
    return parse_decimal_legacy(F.nullif(F.regexp_extract(c, "(?i)" + LABELLED_AMOUNTS[name], 1), F.lit("")))


def strict_number(c: Column) -> Column:
    """A document number with an unmistakable prefix, at least four characters; '' where there is none."""
    u = F.upper(c)
    return F.coalesce(*[F.nullif(F.regexp_extract(u, p, 1), F.lit("")) for p in STRICT_NUMBERS], F.lit(""))


def loose_number(c: Column) -> Column:
    """The run after a number label, however short; '' where there is none."""
    return F.coalesce(*[F.when(c.rlike("(?i)" + p), F.regexp_extract(c, "(?i)" + p, 1)) for p in LOOSE_NUMBERS], F.lit(""))


def labelled_supplier(c: Column) -> Column:
    found = [squash(F.regexp_extract(c, "(?i)" + p, 1)) for p in SUPPLIER_LABELS]
    return F.coalesce(*[F.when(F.length(v) >= 4, v) for v in found], F.lit(""))


def is_title(line: Column) -> Column:
    u = F.upper(line)
    caps = (line == u) & (line != F.lower(line))
    few = F.size(F.split(squash(line), " ")) <= 6
    return u.rlike(TITLE_PHRASES) | (caps & few & u.rlike(TITLE_WORDS))


def caps_supplier(c: Column) -> Column:
    """An ALL-CAPS line of 3 to 10 words among the first ten lines; a title line only if there is no other."""
    lines = F.slice(F.filter(F.transform(F.split(c, "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), strip), lambda x: x != ""), 1, 10)
    words = lambda x: F.size(F.split(squash(x), " "))
    fit = F.filter(lines, lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) >= 4) & words(x).between(3, 10))
    return squash(F.coalesce(F.get(F.filter(fit, lambda x: ~is_title(x)), F.lit(0)), F.get(fit, F.lit(0)), F.lit("")))


def supplier_name(c: Column) -> Column:
    """By label, else by capitals; '' where there is none."""
    by_label = labelled_supplier(c)
    return F.when(by_label != "", by_label).otherwise(caps_supplier(c))


def currency_by_map(c: Column) -> Column:
    """STRUCT<code, name, raw>: the first entry of the ordered map that occurs; NULLs where none does."""
    u = F.upper(c)
    out = F.lit(None).cast("struct<code:string,name:string,raw:string>")
    for code, p, name in reversed(CURRENCY_MAP):
        hit = F.struct(F.lit(code).alias("code"), F.lit(name).alias("name"), F.regexp_extract(u, f"({p})", 1).alias("raw"))
        out = F.when(u.rlike(p), hit).otherwise(out)
    return out


def currency_short(c: Column) -> Column:
    u = F.upper(c)
    return F.coalesce(*[F.when(u.rlike(p), F.lit(code)) for code, p in CURRENCY_SHORT])


def currency_of_document(c: Column) -> Column:
    """Symbols before codes, as a code; '' where there is none."""
    u = F.upper(c)
    symbols = [F.when(c.contains(s), F.lit(code)) for s, code in CURRENCY_SYMBOLS]
    codes = [F.when(u.rlike(rf"(?:^|[^\p{{L}}\p{{N}}_]){code}(?:[^\p{{L}}\p{{N}}_]|$)"), F.lit(code)) for code in CURRENCY_CODES]
    return F.coalesce(*symbols, *codes, F.lit(""))


def currency_mark(c: Column) -> Column:
    """The symbol itself if there is one, else a code; '' where there is none."""
    u = F.upper(c)
    marks = [F.when(c.contains(s), F.lit(s)) for s in "£$€"]
    codes = [F.when(u.rlike(rf"(?:^|[^\p{{L}}\p{{N}}_]){code}(?:[^\p{{L}}\p{{N}}_]|$)"), F.lit(code)) for code in "USD GBP EUR CAD AUD MXN COP ARS".split()]
    return F.coalesce(*marks, *codes, F.lit(""))


def raw_date(c: Column) -> Column:
    """The first date as it is written; NULL where there is none."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, "(?i)" + p, 1), F.lit("")) for p in DATES])


def document_type(c: Column) -> Column:
    low = F.lower(c)
    return F.coalesce(*[F.when(low.rlike(p), F.lit(kind)) for kind, p in DOCUMENT_TYPES], F.lit("unknown"))


def specifications(c: Column, start: int | Column = 1) -> Column:
    """Up to three `word: value` of the 500 characters from a place on, joined; '' where there are none."""
    part = F.substring(c, start, 500)

    def one(w: str) -> Column:
        value = F.substring(strip(F.regexp_extract(part, rf"(?iu){w}[:\s\x0b]+([^\n.]+)", 1)), 1, 80)
        return F.when(F.length(value) > 2, F.concat(F.lit(f"{w}: "), value))

    return F.array_join(F.slice(F.array_compact(F.array(*[one(w) for w in SPEC_WORDS])), 1, 3), " | ")


# How an amount, a unit price and a quantity stand in a line; forms of item numbers.
AMOUNT_IN_LINE = r"([£$€]?\s*[0-9]{1,3}(?:[.,][0-9]{3})*(?:[.,][0-9]{2})?)"
UNIT_PRICE_IN_LINE = r"(?i)([£$€]?\s*[0-9]{1,3}(?:[.,][0-9]{3})*(?:[.,][0-9]{2})?)\s*(?:per|/|each|ea\b)"
QUANTITY_IN_LINE = r"\b([0-9]+(?:[.,][0-9]+)?)\b"
ITEM_IDS = [
    r"(?:REF|ART|COD|CÓDIGO|ID|Artículo)[:\s-]+([A-Z0-9\-]{3,20})",
    r"(?:SKU|EAN|UPC)[:\s-]+([A-Z0-9\-]{5,25})",
    r"(\d{4}[-/]\d{4}[-/][A-Z0-9])",
]


def line_amounts(c: Column) -> dict[str, Column]:
    """The first amount, unit price and quantity of a line as they are written; '' where there is none."""
    return {
        "amount": squash(F.regexp_extract(c, AMOUNT_IN_LINE, 1)),
        "unit_price": squash(F.regexp_extract(c, UNIT_PRICE_IN_LINE, 1)),
        "quantity": squash(F.regexp_extract(c, QUANTITY_IN_LINE, 1)),
    }


def item_id(c: Column) -> Column:
    """The first item number by label, SKU or form; NULL where there is none."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, "(?iu)" + p, 1), F.lit("")) for p in ITEM_IDS])


def header_block(c: Column, most: int = 8) -> Column:
    """The first lines without titles; lines of two and more capital words before others; all if nothing is left."""
    lines = F.slice(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), 1, most)
    plain = F.filter(lines, lambda x: ~is_title(x))
    caps = F.filter(plain, lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.size(F.split(squash(x), " ")) >= 2))
    return F.array_join(F.when(F.size(caps) > 0, caps).when(F.size(plain) > 0, plain).otherwise(lines), " ")
