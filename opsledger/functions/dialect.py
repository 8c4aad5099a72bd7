"""Scalar functions of the reports' SQL dialect that Spark spells otherwise, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat(*parts: Column) -> Column:
    """Joins texts; nulls count as empty."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def instr(text: Column, what: str, start: int = 1, nth: int = 1) -> Column:
    """Place of the nth ``what`` from ``start`` on, backwards from the end if ``start`` is negative; 0 if there is none."""
    n = len(what)
    if start < 0:
        back = instr(F.reverse(text), what[::-1], -start, nth)
        return F.when(back == 0, 0).otherwise(F.length(text) - back - n + 2)
    at = F.locate(what, text, start)
    for _ in range(nth - 1):
        here = at
        at = F.when(here == 0, 0).otherwise(F.call_function("locate", F.lit(what), text, here + 1))
    return at


def greatest(*c: Column) -> Column:
    """Null if any argument is."""
    anynull = c[0].isNull()
    for x in c[1:]:
        anynull = anynull | x.isNull()
    return F.when(~anynull, F.greatest(*c))


def days_between(a: Column, b: Column) -> Column:
    """a minus b in days, with the fraction."""
    return (F.unix_micros(a) - F.unix_micros(b)) / F.lit(86_400_000_000)


def add_months(ts: Column, n: int) -> Column:
    """Keeps the time of day; the last day of a month stays the last."""
    day = F.add_months(F.to_date(ts), n)
    day = F.when(F.to_date(ts) == F.last_day(ts), F.last_day(day)).otherwise(day)
    return F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + (F.unix_micros(ts) - F.unix_micros(F.date_trunc("day", ts))))


NAMES = {"DAY": ("EEEE", 9), "MONTH": ("MMMM", 9), "DY": ("EEE", 0), "MON": ("MMM", 0)}  # Java's pattern, and the width that names are padded to
NUMBERS = {"YYYY": "yyyy", "RRRR": "yyyy", "YY": "yy", "RR": "yy", "MM": "MM", "DDD": "DDD", "DD": "dd", "HH24": "HH", "HH12": "hh", "HH": "hh", "MI": "mm", "SS": "ss"}
PARTS = re.compile(r'"[^"]*"|FM|SSSSS|' + "|".join(sorted([*NAMES, *NUMBERS, "AM", "PM", "Q", "IW"], key=len, reverse=True)) + "|.", re.I | re.S)


def _elements(pattern: str) -> list[str]:
    return PARTS.findall(pattern)


def to_char(ts: Column, pattern: str) -> Column:
    """A timestamp by a pattern of the dialect's date elements.

    Names come in the case of their element, days and months padded to nine characters; FM turns
    padding, and zeros in front of numbers, off and on again. Text in quotes stays, as does what is no element.
    """
    out, full = [], True
    for e in _elements(pattern):
        u = e.upper()
        if u == "FM":
            full = not full
        elif u in NAMES:
            java, width = NAMES[u]
            name = F.date_format(ts, java)
            name = F.upper(name) if e.isupper() else F.lower(name) if e.islower() else name
            out.append(F.rpad(name, width, " ") if width and full else name)
        elif u in NUMBERS:
            x = F.date_format(ts, NUMBERS[u])
            out.append(x if full else F.regexp_replace(x, "^0+(?=[0-9])", ""))
        elif u == "SSSSS":
            x = (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("string")
            out.append(F.lpad(x, 5, "0") if full else x)
        elif u in ("AM", "PM"):
            x = F.when(F.hour(ts) < 12, "AM").otherwise("PM")
            out.append(x if e.isupper() else F.lower(x))
        elif u == "Q":
            out.append(F.quarter(ts).cast("string"))
        elif u == "IW":
            x = F.weekofyear(ts).cast("string")
            out.append(F.lpad(x, 2, "0") if full else x)
        else:
            out.append(F.lit(e[1:-1] if e.startswith('"') and len(e) > 1 else e))
    return F.when(ts.isNotNull(), F.concat(*out)) if out else F.lit("")


def number_char(n: Column, pattern: str) -> Column:
    """A number by a pattern of 9, 0, the point (. or D), the group (, or G), and FM, S or MI.

    The sign stands before the first digit, in a place of its own; FM drops that place, blanks, and
    zeros at the end where the pattern has nines. A number that doesn't fit is shown as #.
    """
    bare = pattern.upper()
    full = not bare.startswith("FM")
    bare = bare.removeprefix("FM")
    sign = "S" if bare.startswith("S") else "MI" if bare.endswith("MI") else ""
    bare = bare.removeprefix("S").removesuffix("MI")
    after = len(re.split("[.D]", bare)[1].replace(",", "")) if re.search("[.D]", bare) else 0
    x = F.round(n.cast("decimal(38,12)"), after)
    s = F.to_char(F.abs(x), F.lit(bare))
    wide = len(bare)
    s = F.when(s.contains("#"), F.lit("#" * wide)).otherwise(s)
    digits = F.when(F.ltrim(s) == "", "0").otherwise(F.ltrim(s))
    if not full and after and bare.endswith("9"):
        zeros = len(bare) - len(bare.rstrip("9"))
        digits = F.when(digits.startswith("#"), digits).otherwise(F.regexp_replace(digits, f"0{{1,{zeros}}}$", ""))
    negative = (x < 0) & ~digits.startswith("#")
    if sign == "MI":
        out = F.concat(digits, F.when(negative, "-").otherwise("" if not full else " "))
    else:
        plus = "+" if sign == "S" else ""
        out = F.concat(F.when(negative, "-").otherwise(plus), digits)
    width = wide + 1
    return F.when(digits.startswith("#"), F.lit("#" * width)).otherwise(F.lpad(out, width, " ") if full else out)


def humanize(n: Column) -> Column:
    k, m = n / 1024, n / (1024 * 1024)
    return F.when(n >= 1024 * 1024, F.concat(F.round(m, 1).cast("string"), F.lit(" MB"))).otherwise(F.concat(F.round(k, 1).cast("string"), F.lit(" KB")))


POSIX = {"[:alpha:]": r"\p{Alpha}", "[:digit:]": r"\d", "[:alnum:]": r"\p{Alnum}", "[:space:]": r"\s", "[:upper:]": r"\p{Upper}", "[:lower:]": r"\p{Lower}", "[:punct:]": r"\p{Punct}"}


def regexp_like(text: Column, pattern: str, flags: str = "") -> Column:
    for k, v in POSIX.items():
        pattern = pattern.replace(k, v)
    return text.rlike(("(?i)" if "i" in flags else "") + pattern)


def decode(x: Column, *cases: object, default: object = None) -> Column:
    """The value after the first key that equals ``x``, null equal to null: key, value, key, value..."""
    out: Column | None = None
    for k, v in zip(cases[::2], cases[1::2], strict=True):
        hit = x.eqNullSafe(F.lit(k))
        out = F.when(hit, F.lit(v)) if out is None else out.when(hit, F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def initcap(text: Column) -> Column:
    """Letters that start a run of letters and digits in upper case, the others in lower case."""
    parts = F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))), "")


def ltrim(text: Column, letters: str = " ") -> Column:
    return F.ltrim(text, F.lit(letters))


def rtrim(text: Column, letters: str = " ") -> Column:
    return F.rtrim(text, F.lit(letters))


def regexp_substr(text: Column, pattern: str, nth: int = 1) -> Column:
    """The nth match, null if there are fewer."""
    for k, v in POSIX.items():
        pattern = pattern.replace(k, v)
    return F.try_element_at(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), F.lit(nth))


def trunc(n: Column, digits: int = 0) -> Column:
    """Towards zero at ``digits`` places, left of the point if negative; by decimals, so 0.29 stays 0.29."""
    d = n.cast("decimal(38,12)")
    return F.when(d >= 0, F.floor(d, digits)).otherwise(F.ceil(d, digits)).cast("double")


def months_between(a: Column, b: Column) -> Column:
    """Whole months where the days agree or both are a month's last, else with a fraction by months of 31 days."""
    return F.months_between(a, b, False)


def trunc_date(ts: Column, unit: str = "DD") -> Column:
    """To the start of a year, quarter, month, week from Monday, day, hour or minute."""
    return F.date_trunc({"YYYY": "year", "YEAR": "year", "Q": "quarter", "MM": "month", "MONTH": "month", "IW": "week", "DD": "day", "HH24": "hour", "MI": "minute"}[unit], ts)


def round_date(ts: Column, unit: str = "DD") -> Column:
    """To the nearest start: years turn with July, months with the sixteenth, days with noon, hours with the half."""
    later = {"YYYY": F.month(ts) >= 7, "MM": F.dayofmonth(ts) >= 16, "DD": F.hour(ts) >= 12, "HH24": F.minute(ts) >= 30}[unit]
    step = {"YYYY": "INTERVAL 1 YEAR", "MM": "INTERVAL 1 MONTH", "DD": "INTERVAL 1 DAY", "HH24": "INTERVAL 1 HOUR"}[unit]
    start = trunc_date(ts, unit)
    return F.when(later, start + F.expr(step)).otherwise(start)


def next_day(ts: Column, day: str) -> Column:
    """The first ``day`` of the week after ``ts``."""
    return F.next_day(ts, day)


def to_date(text: Column, pattern: str) -> Column:
    """A timestamp by a pattern of the dialect's date elements; null if the text doesn't fit. RR takes years from 50 on to be of the last century."""
    java, names = "", {"DAY": "EEEE", "MONTH": "MMMM", "DY": "EEE", "MON": "MMM"}
    for e in _elements(pattern):
        u = e.upper()
        java += names[u] if u in names else NUMBERS[u] if u in NUMBERS else "a" if u in ("AM", "PM") else "" if u == "FM" else "'" + e.strip('"').replace("'", "''") + "'" if e[0].isalpha() or e[0] in "\"'" else e
    if any(n in pattern.upper() for n in names):
        text = F.initcap(text)
    ts = F.try_to_timestamp(text, F.lit(java))
    if "RR" in pattern.upper() and "RRRR" not in pattern.upper():
        ts = F.when(F.year(ts) >= 2050, ts - F.expr("interval 100 years")).otherwise(ts)
    return ts


def soundex(text: Column) -> Column:
    return F.soundex(text)


def substrb(text: Column, start: int, n: int) -> Column:
    """``n`` bytes of the text in UTF-8 from byte ``start`` on, from the end if negative; characters cut through are left out."""
    b = F.encode(text, "UTF-8")
    at = F.lit(start) if start >= 0 else F.octet_length(text) + start + 1
    return F.replace(F.make_valid_utf8(F.substr(b, at, F.lit(n)).cast("string")), F.lit("\ufffd"), F.lit(""))


def instrb(text: Column, what: str) -> Column:
    """The byte of the text in UTF-8 that ``what`` starts at, from 1; 0 if it isn't in it."""
    at = F.locate(what, text)
    return F.when(at == 0, 0).otherwise(F.octet_length(F.substr(text, F.lit(1), at - 1)) + 1)


# fixed values: hours of the dialect's time zones from Greenwich
ZONES = {"AST": -4, "ADT": -3, "BST": -11, "BDT": -10, "CST": -6, "CDT": -5, "EST": -5, "EDT": -4, "GMT": 0, "HST": -10, "HDT": -9, "MST": -7, "MDT": -6, "NST": -3.5, "PST": -8, "PDT": -7, "YST": -9, "YDT": -8}


def new_time(ts: Column, own: str, other: str) -> Column:
    """The time in zone ``other`` when it is ``ts`` in zone ``own``."""
    seconds = int((ZONES[other.upper()] - ZONES[own.upper()]) * 3600)
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(seconds * 1_000_000))


def to_number(text: Column, point: str = ".", group: str = ",") -> Column:
    """A number with its groups taken out; null if the text is none."""
    plain = F.replace(F.replace(F.trim(text), F.lit(group), F.lit("")), F.lit(point), F.lit("."))
    return F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), plain.cast("double"))


def number_text(n: Column, digits: int, grouped: bool = True) -> Column:
    """A number with ``digits`` after the point, in groups of three."""
    out = F.format_number(n, digits)
    return out if grouped else F.replace(out, F.lit(","), F.lit(""))


def to_hex(n: Column) -> Column:
    return F.lower(F.hex(n))


def wanted(column: Column, value: str | None) -> Column:
    """A report's filter by a parameter: all rows where it is null or empty."""
    return F.lit(True) if not value else column == F.lit(value)
