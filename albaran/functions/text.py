"""Text cleaning and text measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of all scripts, written so that it reads the same in Java and RE2.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
# Words that mark a procurement text.
KEYWORDS = "INVOICE|FACTURA|TOTAL|SUBTOTAL|IVA|TAX|PROVEEDOR|SUPPLIER|FECHA|DATE|CANTIDAD|QUANTITY|MONEDA|CURRENCY"


def spaced(pattern: str) -> str:
    r"""The pattern with \x0b in every \s: Java's \s has it, RE2's has not."""
    out, inside, i = "", False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out += r"\s\x0b" if inside else r"[\s\x0b]"
        elif two[0] == "\\":
            out += two
        else:
            inside = True if two[0] == "[" else False if two[0] == "]" else inside
            out += two[0]
            i += 1
            continue
        i += 2
    return out


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def squash(c: Column) -> Column:
    """Stripped, runs of white space as one blank; NULL for NULL."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def clean_text(c: Column) -> Column:
    """Squashed text; NULL for NULL, empty and blank."""
    return F.nullif(squash(c), F.lit(""))


def repair_zero_l(c: Column) -> Column:
    """0 between letters becomes O; if two l stand together anywhere, every run of l becomes 1."""
    s = F.regexp_replace(c, "([A-Za-z])0([A-Za-z])", "$1O$2")
    return F.when(s.contains("ll"), F.regexp_replace(s, "l+", "1")).otherwise(s)


def clean_ocr(c: Column) -> Column:
    """Ordered substitutions of misread characters; hyphens and U+001F go, runs of white space become a blank."""
    s = F.regexp_replace(F.translate(c, "\r", "\n"), "[-\x1f]+", "")
    s = F.regexp_replace(s, r"(?<=\D)0(?=[A-ZÁÉÍÓÚÑÜ])", "O")
    s = F.regexp_replace(s, r"(?<=[A-Za-zÁÉÍÓÚÑÜ])1(?=[A-Za-zÁÉÍÓÚÑÜ])", "I")
    s = F.regexp_replace(s, r"(?<=\D)l(?=\d)", "1")
    s = F.regexp_replace(s, r"(?<=\d)O(?=\d)", "0")
    s = F.regexp_replace(s, "[‘’`´]", "'")
    return strip(F.regexp_replace(s, f"{SPACE}{{2,}}", " "))


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def ocr_score(c: Column) -> Column:
    """0..110: keywords, digit density, little noise, table marks; 0 for texts of under 20 characters."""
    words = F.least(count(c, f"(?i)(?:{KEYWORDS})") * 6, F.lit(40)).cast("double")
    digits = F.least(count(c, "[0-9]") / F.greatest(F.length(c), F.lit(1)) * 40, F.lit(40.0))
    noise = F.greatest(F.lit(0), 20 - count(c, r"[$@%&*#\^~]") * 2)
    table = F.when(c.contains("|") | c.contains("\t"), 10).otherwise(0)
    return F.when(F.length(strip(c)) >= 20, words + digits + noise + table).otherwise(F.lit(0.0))


def confidence(c: Column) -> Column:
    """0..60: keywords, quantity words, less the noise; 0 for texts of under 20 characters."""
    words = F.least(count(c, f"(?i)(?:{KEYWORDS}|ORDER|ORDEN)") * 8, F.lit(40))
    items = F.least(count(c, r"(?i)\b(?:Qty|Quantity|Cantidad|Unidad|Unit)\b") * 5, F.lit(20))
    noise = F.least(count(c, r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}\-:|.$€£,/]"), F.lit(15))
    return F.when(F.length(strip(c)) >= 20, F.greatest(F.lit(0), F.least(words + items - noise, F.lit(60)))).otherwise(F.lit(0)).cast("int")


def garbled(c: Column) -> Column:
    """Holds a character outside letters, digits, white space and common marks, or a control character."""
    return c.rlike(r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}\-.,():/]|[\x00-\x1f]")


def ocr_garbage(c: Column) -> Column:
    """Over 15 digits and separators, one digit four times in a row, or four times d.d."""
    s = squash(F.coalesce(c, F.lit("")))
    n = F.regexp_replace(s, "[^0-9.,]", "")
    return (F.length(n) > 15) | n.rlike(r"([0-9])\1{3,}") | s.rlike(r"([0-9]\.[0-9]){4,}")
