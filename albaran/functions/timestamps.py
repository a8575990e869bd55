"""Dates and times of mixed writing to one unambiguous form, inside the JVM.

All formats are one regular expression with named groups. One ``regexp_replace`` per value lays the components out
side by side; they are checked against the calendar and put together by integer day arithmetic. Only wall times with
a named zone or a site's zone go through the zone rules (``to_utc_timestamp``: of two instants the earlier, a skipped
time moves forward by the gap).

Defined results: NULL for NULL, empty, blank and unreadable values, for dates that are not in the calendar, for years
outside ``years``, and for values that need a site where none is given.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from albaran.functions.lookup import among, lookup

# Month names, January to December, in English, Spanish, Portuguese, French, German, Italian, Dutch.
MONTH_NAMES = """
january february march april may june july august september october november december
jan feb mar apr may jun jul aug sep oct nov dec
enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre
ene feb mar abr may jun jul ago set oct nov dic
janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro
jan fev mar abr mai jun jul ago set out nov dez
janvier février mars avril mai juin juillet août septembre octobre novembre décembre
janv févr mars avr mai juin juil août sept oct nov déc
januar februar märz april mai juni juli august september oktober november dezember
jan feb mär apr mai jun jul aug sep okt nov dez
gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre
gen feb mar apr mag giu lug ago set ott nov dic
januari februari maart april mei juni juli augustus september oktober november december
jan feb mrt apr mei jun jul aug sep okt nov dec
"""
# Minutes east of UTC of zone abbreviations.
ZONE_MINUTES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120, "EEST": 180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "PET": -300, "COT": -300,
    "BRT": -180, "ART": -180, "CLT": -240, "CLST": -180,
}
# Words that stand before a date without a colon.
LEAD_WORDS = "date fecha entrega emisión emision emitido data datum el le il am on vence vencimiento"

NUMBERS = "y m d yc mc dc hc ic sc a b yn dt yt du yu epoch serial h i s".split()
TEXTS = "mt mu ap off zone".split()
_D = "[0-9OoIlSB]"


def month_table() -> dict[str, int]:
    table: dict[str, int] = {}
    for line in MONTH_NAMES.split("\n"):
        for n, name in enumerate(line.split(), 1):
            plain = name.translate(str.maketrans("áçéèûôä", "aceeuoa"))
            table[name] = table[plain] = n
    return table


def pattern() -> str:
    """The alternation of all formats, with one name for each component."""
    months = r"\p{L}{3,12}"  # a word; the table says afterwards whether it is a month
    two, year = f"{_D}{{1,2}}", f"{_D}{{4}}"
    dates = [
        f"(?<y>{year})[-/.](?<m>{two})[-/.](?<d>{two})",
        f"(?<yc>{year})(?<mc>{_D}{{2}})(?<dc>{_D}{{2}})(?:T?(?<hc>{_D}{{2}})(?<ic>{_D}{{2}})(?<sc>{_D}{{2}})?)?",
        f"(?<a>{two})[-/.](?<b>{two})[-/.](?<yn>{year}|{_D}{{2}})",
        f"(?<dt>{two})(?:st|nd|rd|th|º|°|er)?[-/. ]*(?:\\s+de\\s+)?(?<mt>{months})\\.?,?[-/ ]*(?:\\s*de[l]?\\s+)?(?<yt>{year}|{_D}{{2}})",
        f"(?<mu>{months})\\.?\\s+(?<du>{two})(?:st|nd|rd|th)?,?\\s+(?<yu>{year})",
    ]
    clock = f"(?<h>{two}):(?<i>{_D}{{2}})(?::(?<s>{_D}{{2}})(?:[.,]{_D}+)?)?\\s*(?:(?<ap>[ap]\\.?m\\.?)(?!\\p{{L}}))?"
    offset = r"(?:UTC|GMT)?(?<off>[+-]\d{1,2}(?::?\d{2})?)"
    zone = r"\[?(?<zone>[A-Za-z]+(?:/[A-Za-z_+\-0-9]+)+|[A-Za-z]{1,4})\]?"
    lead = r"(?:[\p{L} ]{1,30}:\s*|(?:" + "|".join(LEAD_WORDS.split()) + r")\s+)?"
    day = r"(?:\p{L}{2,10}\.?,\s*)?"
    instant = f"{day}(?:{'|'.join(dates)})(?:(?:T|,?\\s+){clock})?\\s*(?:{offset}|{zone})?"
    return f"(?iu)^\\s*{lead}(?:{instant}|(?<epoch>{_D}{{10}}(?:{_D}{{3}})?)|(?<serial>{_D}{{5}}))\\s*$"


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 by integer arithmetic."""
    yy = y - F.when(m <= 2, 1).otherwise(0)
    doy = F.floor((153 * ((m + 9) % 12) + 2) / 5) + d - 1
    return yy * 365 + F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) + doy - 719468


def days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def _valid(y: Column, m: Column, d: Column) -> Column:
    return F.coalesce(m.between(1, 12) & (d >= 1) & (d <= days_in_month(y, m)), F.lit(False))


SEP, TURN = "\u0001", "\u0002"


def laid_out(value: Column) -> Column:
    """The components of a value side by side, numbers before texts; the value itself where no format fits."""
    return F.regexp_replace(value, pattern(), SEP.join(f"${{{g}}}" for g in NUMBERS) + TURN + SEP.join(f"${{{g}}}" for g in TEXTS))


def numbers(laid: Column) -> Column:
    """Array of the numeric components as texts, '' where there is none; misread digits are mended. NULL where no format fits."""
    digits = F.translate(F.substring_index(laid, TURN, 1), "OoIlSB", "001158")
    return F.when(F.instr(laid, TURN) > 0, F.split(digits, SEP))


def texts(laid: Column) -> Column:
    return F.when(F.instr(laid, TURN) > 0, F.split(F.substring_index(laid, TURN, -1), SEP))


def instant_text(seconds: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ssZ of seconds since 1970, whatever the session's zone."""
    rest = F.pmod(seconds, F.lit(86400)).cast("int")
    clock = F.format_string("T%02d:%02d:%02dZ", F.floor(rest / 3600).cast("int"), F.floor(rest / 60).cast("int") % 60, rest % 60)
    return F.concat(F.date_from_unix_date(F.floor(seconds / 86400).cast("int")).cast("string"), clock)


def stages(value: str, tz_name: str, date_order: str, years: tuple[int, int], out: str) -> list[dict[str, Column]]:
    """The columns to add, step by step; each step reads columns of the steps before."""
    col = lambda k: F.col(f"_ts_{k}")
    # a failing cast costs an exception, so what isn't there is not cast
    n = lambda g: F.nullif(F.get(col("n"), NUMBERS.index(g)), F.lit("")).try_cast("bigint")
    t = lambda g: F.nullif(F.get(col("t"), TEXTS.index(g)), F.lit(""))
    full = lambda y: F.when(y < 100, y + 2000).otherwise(y)
    month = lookup(month_table(), F.lower(F.coalesce(t("mt"), t("mu")))).cast("bigint")
    zones = sorted(z for z in zoneinfo.available_timezones() if "/" in z)
    a, b, year, order = col("a"), col("b"), col("y0"), F.col(date_order)
    dmy = _valid(year, b, a)
    mdy = _valid(year, a, b)
    y, m, d, h, i, s = (col(k) for k in ("y", "m", "d", "h", "i", "s"))
    digits = F.regexp_replace(t("off"), "[^0-9]", "")
    east = F.lpad(F.when(F.length(digits) <= 2, F.concat(digits, F.lit("00"))).otherwise(digits), 4, "0").try_cast("int")
    east = (F.floor(east / 100) * 60 + east % 100) * F.when(F.startswith(t("off"), F.lit("-")), -1).otherwise(1)
    low, high = ((yr - 1970) * 365 for yr in (years[0], years[1] + 1))
    epoch = F.when(n("epoch") >= 100_000_000_000, F.floor(n("epoch") / 1000)).otherwise(n("epoch"))
    ap = F.lower(F.substring(t("ap"), 1, 1))
    at_place = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(col("wall")), F.coalesce(col("place"), F.lit("UTC"))))
    return [
        {"_ts_laid": laid_out(F.col(value))},
        {"_ts_n": numbers(col("laid")), "_ts_t": texts(col("laid"))},
        {
            "_ts_a": n("a"),
            "_ts_b": n("b"),
            "_ts_y0": full(F.coalesce(n("y"), n("yc"), n("yn"), n("yt"), n("yu"))),
            "_ts_m0": F.coalesce(n("m"), n("mc"), month),
            "_ts_d0": F.coalesce(n("d"), n("dc"), n("dt"), n("du")),
            "_ts_h": F.when(ap.isNull(), F.coalesce(n("h"), n("hc"))).otherwise(F.when(n("h").between(1, 12), n("h") % 12 + F.when(ap == "p", 12).otherwise(0)).otherwise(99)),
            "_ts_i": F.coalesce(n("i"), n("ic")),
            "_ts_s": F.coalesce(n("s"), n("sc"), F.lit(0)),
            "_ts_epoch": epoch.cast("bigint"),
            "_ts_serial": (n("serial") - 25569).cast("int"),
            "_ts_zone": t("zone"),
            "_ts_off": F.coalesce(east, lookup(ZONE_MINUTES, F.upper(t("zone")))).cast("bigint"),
        },
        {"_ts_dmy": dmy, "_ts_mdy": mdy},
        {
            # True: day first; NULL: both orders are dates and no site says which
            "_ts_first": F.when(col("dmy") & col("mdy") & (a != b), F.when(order == "MDY", False).when(order == "DMY", True)).when(col("dmy"), True).when(col("mdy"), False)
        },
        {
            "_ts_y": year,
            "_ts_m": F.coalesce(col("m0"), F.when(col("first"), b).when(~col("first"), a)),
            "_ts_d": F.coalesce(col("d0"), F.when(col("first"), a).when(~col("first"), b)),
        },
        {
            "_ts_real": _valid(y, m, d) & y.between(*years) & (h.isNull() | F.coalesce(h.between(0, 23) & i.between(0, 59) & s.between(0, 59), F.lit(False))),
            "_ts_place": F.when(col("zone").contains("/"), F.when(among(zones, col("zone")), col("zone"))).when(col("zone").isNull(), F.col(tz_name)),
        },
        {"_ts_day": F.when(col("real"), days_from_civil(y, m, d).cast("bigint"))},
        {"_ts_wall": col("day") * 86400 + h * 3600 + i * 60 + s},
        {
            "_ts_at": F.when(F.floor(col("epoch") / 86400).between(low, high + 16), col("epoch"))
            .when(col("off").isNotNull(), col("wall") - col("off") * 60)
            .when(col("place").isNotNull(), at_place),
            "_ts_date": F.when(col("serial").between(low, high + 16), col("serial")).when(h.isNull() & col("off").isNull() & col("zone").isNull(), col("day").cast("int")),
        },
        {"_ts_text": F.coalesce(instant_text(col("at")), F.date_from_unix_date(col("date")).cast("string"))},
        {out: F.when(col("epoch").isNull() & col("serial").isNull() | F.substring(col("text"), 1, 4).cast("int").between(*years), col("text"))},
    ]
