"""Reading of dates and times in mixed notations, as native Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names by language, in calendar order.
MONTHS = {
    "en": ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"],
    "de": ["januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"],
    "fr": ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"],
    "es": ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"],
    "it": ["gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre"],
    "pt": ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"],
}
# Zone abbreviations and their offsets from UTC in minutes.
ZONE_ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "KST": 540, "JST": 540, "HKT": 480, "SGT": 480, "AWST": 480, "ACST": 570, "ACDT": 630,
    "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

_MON = r"(\p{L}{3,12})\.?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"(?:\s*(Z|[+\-]\d{2}:?\d{2}|[+\-]\d{2}|[A-Za-z]{2,5}))?"

#: name -> (pattern, groups).  Groups name what each capture holds; "a" and "b" are the two numbers before the year
#: of a slash date, whose order the country decides.
NOTATIONS: list[tuple[str, str, str]] = [
    ("epoch", r"^(\d{10}|\d{13}|\d{16}|\d{19})$", "n"),
    ("compact", r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})" + _ZONE + r"$", "y m d h i s z"),
    ("iso", r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[T\s]+" + _CLOCK + r"(?:\s*([+\-]\d{4})\s+[A-Z]{2,5}|" + _ZONE + r"))?$", "y m d h i s f z z"),
    ("slash", r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:,?\s+" + _CLOCK + r"\s*([AaPp]\.?[Mm]\.?)?" + _ZONE + r")?$", "a b y h i s f p z"),
    ("slash_year", r"^(\d{4})/(\d{1,2})/(\d{1,2})(?:,?\s+" + _CLOCK + r"\s*([AaPp]\.?[Mm]\.?)?" + _ZONE + r")?$", "y m d h i s f p z"),
    ("day_month", r"^(?:\p{L}+\.?,?\s+)?(\d{1,2})[.\-]?\s*(?:de\s+)?[\-]?" + _MON + r"[\-]?\s*(?:de\s+)?(\d{4})(?:,?\s+(?:à\s+|um\s+|a las\s+)?(\d{1,2})[:h](\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([AaPp]\.?[Mm]\.?)?(?:\s*Uhr)?" + _ZONE + r")?$", "d M y h i s f p z"),
    ("month_day", r"^(?:\p{L}+,?\s+)?" + _MON + r"\s+(\d{1,2})(?:st|nd|rd|th)?,\s+(\d{4})(?:,?\s+(?:at\s+)?" + _CLOCK + r"\s*([AaPp]\.?[Mm]\.?)?" + _ZONE + r")?$", "M d y h i s f p z"),
    ("ctime", r"^\p{L}{3}\s+(\p{L}{3})\s+(\d{1,2})\s+" + _CLOCK + r"(?:\s+([A-Z]{2,5}))?\s+(\d{4})$", "M d h i s f z y"),
    ("dots_year", r"^(\d{4})\.\s*(\d{1,2})\.\s*(\d{1,2})\.?(?:\s+" + _CLOCK + _ZONE + r")?$", "y m d h i s f z"),
    ("dots_day", r"^(\d{1,2})\.(\d{1,2})\.(\d{4})(?:,?\s+" + _CLOCK + r"(?:\s*Uhr)?" + _ZONE + r")?$", "d m y h i s f z"),
    ("korean", r"^(\d{4})년\s*(\d{1,2})월\s*(\d{1,2})일(?:\s*(오전|오후)?\s*(\d{1,2})(?::|시\s*)(\d{2})(?::(\d{2}))?분?)?$", "y m d p h i s"),
]


def ntz_micros(column: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, read as UTC whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


def _month_map() -> Column:
    pairs: dict[str, int] = {}
    for names in MONTHS.values():
        for i, name in enumerate(names, 1):
            pairs.setdefault(name, i)
            if len(name) > 3:
                pairs.setdefault(name[:3], i)
    pairs["sept"] = 9
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v))])


#: Order of the parts that every notation is rewritten to.
PARTS = ["n", "y", "m", "M", "d", "a", "b", "h", "i", "s", "f", "p", "z"]


def notation_parts(text: Column) -> Column:
    """Array of PARTS as strings ('' where the notation has no such part); null if no notation fits.

    One replacement per notation keeps the expression small: the parts are read from the resulting
    array, which the optimizer does not inline into its many uses.
    """
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")

    def rewritten(pattern: str, groups: str) -> Column:
        where: dict[str, str] = {}
        for i, g in enumerate(groups.split(), 1):
            where[g] = where.get(g, "") + f"${i}"
        return F.regexp_replace(t, pattern, "|".join(where.get(g, "") for g in PARTS))

    canon = reduce(lambda rest, n: F.when(t.rlike(n[1]), rewritten(n[1], n[2])).otherwise(rest), reversed(NOTATIONS), F.lit(None).cast("string"))
    return F.split(canon, r"\|")


def part(parts: Column, name: str) -> Column:
    x = parts[PARTS.index(name)]
    return F.when(x != "", x)


def epoch_number_ms(parts: Column) -> Column:
    """Milliseconds of a plain number of seconds, milliseconds, microseconds or nanoseconds."""
    n = part(parts, "n")
    return F.when(F.length(n) == 10, n.cast("bigint") * 1000).otherwise(F.substring(n, 1, 13).cast("bigint"))


def local_epoch_ms(parts: Column, month_first: Column) -> Column:
    """Milliseconds of the written wall clock as if it were UTC; null when the date or time cannot exist."""

    def num(name: str) -> Column:
        return part(parts, name).cast("int")

    named = F.try_element_at(_month_map(), F.lower(part(parts, "M")))
    month = F.coalesce(num("m"), named, F.when(month_first, num("a")).otherwise(num("b")))
    day = F.coalesce(num("d"), F.when(month_first, num("b")).otherwise(num("a")))
    half = F.lower(part(parts, "p"))
    pm = half.startswith("p") | (half == "오후")
    clock = F.coalesce(num("h"), F.lit(0))
    hour = F.when(half.isNull(), clock).when(clock > 12, F.lit(99)).otherwise(clock % 12 + F.when(pm, 12).otherwise(0))
    minute, second = F.coalesce(num("i"), F.lit(0)), F.coalesce(num("s"), F.lit(0))
    millis = F.substring(F.rpad(F.coalesce(part(parts, "f"), F.lit("")), 3, "0"), 1, 3).cast("bigint")
    date = F.try_to_date(F.concat_ws("-", num("y"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")
    days = F.datediff(date, F.expr("date'1970-01-01'")).cast("bigint")
    ok = hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59) & num("y").between(1900, 2100)
    return F.when(ok, ((days * 24 + hour) * 60 + minute) * 60000 + second * 1000 + millis)


def written_offset_minutes(zone: Column) -> Column:
    """Offset of '+09:00', '-0500', '+09' or a known abbreviation; null if absent or unknown."""
    table = F.create_map(*[x for k, v in ZONE_ABBREVIATIONS.items() for x in (F.lit(k), F.lit(v))])
    sign = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    digits = F.regexp_replace(zone, r"[+\-:]", "")
    minutes = F.when(F.length(digits) >= 4, F.substring(digits, 3, 2).cast("int")).otherwise(F.lit(0))
    numeric = F.when(zone.rlike(r"^[+\-]\d"), sign * (F.substring(digits, 1, 2).cast("int") * 60 + minutes))
    return F.coalesce(numeric, F.try_element_at(table, F.upper(zone)))
