"""Free-form timestamp strings to a small structured reading.

``read_date`` handles one string; ``date_reading`` is the Arrow UDF around it. The reading keeps
apart what the string says itself (calendar day, clock, written offset) from what only the site can
tell (day/month order, zone), so that the relational side can settle those with joins.
"""

from __future__ import annotations

import re
from datetime import date

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Month names and short forms in English, German, French, Spanish, Portuguese and Dutch.
MONTH_NAMES = {
    1: "january jan januar jänner janvier janv enero ene janeiro januari",
    2: "february feb februar février fevrier févr fevr fév febrero fevereiro fev februari",
    3: "march mar märz maerz mär mrz mars marzo março marco maart mrt",
    4: "april apr avril avr abril abr",
    5: "may mai mayo maio mei",
    6: "june jun juni juin junio junho",
    7: "july jul juli juillet juil julio julho",
    8: "august aug août aout agosto ago augustus",
    9: "september sep sept septembre septiembre set setembro setiembre",
    10: "october oct oktober okt octobre octubre outubro out",
    11: "november nov novembre noviembre novembro",
    12: "december dec dezember dez décembre decembre déc diciembre dic dezembro",
}
MONTHS = {name: number for number, names in MONTH_NAMES.items() for name in names.split()}

_MONTH = "(" + "|".join(sorted(MONTHS, key=len, reverse=True)) + r")(?![^\W\d_])"
_DAY = r"(?<!\d)(\d{1,2})(?:st|nd|rd|th|er|º|ª|\.)?"
_LINK = r"[\s,.-]*(?:(?:de|del|of|do)\s+)?"
_CLOCK = r"(?<!\d)(\d{1,2})[:h](\d{2})(?!\d)(?::(\d{2})(?:[.,]\d+)?(?!\d))?\s*(a\.?m\b\.?|p\.?m\b\.?)?"

_COMPACT = re.compile(r"(?<!\d)(\d{4})(\d{2})(\d{2})[t ](\d{2})(\d{2})(\d{2})?(?:[.,]\d+)?(?!\d)")
_DIGITS = re.compile(r"(?<![\d.,:/+-])(\d{8,14})(?![\d,:/+-]|\.\d)")
_YMD = re.compile(r"(?<!\d)(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?!\d)")
_NUMERIC = re.compile(r"(?<!\d)(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})(?!\d)")
_D_M_Y = re.compile(_DAY + _LINK + r"\b" + _MONTH + _LINK + r"(\d{4})(?!\d)")
_M_D_Y = re.compile(r"\b" + _MONTH + r"[\s.-]*(\d{1,2})(?:st|nd|rd|th)?(?:,\s*|\s+|-)(\d{4})(?!\d)")
_Y_M_D = re.compile(r"(?<!\d)(\d{4})[\s-]+" + _MONTH + r"[\s.-]+(\d{1,2})(?:st|nd|rd|th)?(?![\d:])")
_CTIME = re.compile(r"\b" + _MONTH + r"\s+(\d{1,2})\s+(\d{1,2}:\d{2}(?::\d{2})?(?:\s+[a-z]{2,5}|\s+[+-]\d{4})?)\s+(\d{4})(?!\d)")
_M_Y = re.compile(r"\b" + _MONTH + r"\.?,?[\s-]*(?:(?:de|del|of)\s+)?(\d{4})(?!\d)")
_Y_M = re.compile(r"(?<!\d)(\d{4})([-/.])(\d{1,2})(?!\d)")
_YEAR = re.compile(r"(?<!\d)(\d{4})(?!\d)")
_TIME = re.compile(_CLOCK)
_NAMED_OFFSET = re.compile(r"\b(?:utc|gmt)\s*([+-])\s*(\d{1,2})(?::?(\d{2}))?(?!\d)")
_OFFSET = re.compile(r"([+-])(\d{2}):?(\d{2})?(?!\d)")
_ABBREVIATION = re.compile(r"(?<![^\W\d_])([A-Z]{1,5})(?![^\W\d_])")
_SPACES = re.compile(r"\s+")
_EPOCH_DAY = date(1970, 1, 1).toordinal()

READING = T.StructType([T.StructField(n, T.StringType() if n in ("prec", "txt", "abbr") else T.IntegerType()) for n in ("prec", "txt", "day_first", "month_first", "secs", "off", "abbr")])
NOTHING = (None, None, None, None, None, None, None)


def _day(year: int, month: int, day: int) -> int | None:
    """Days since 1970-01-01, or None for a day that the calendar doesn't have."""
    try:
        return date(year, month, day).toordinal() - _EPOCH_DAY if year >= 1000 else None
    except ValueError:
        return None


def read_date(raw: str | None) -> tuple:
    """One string to (prec, txt, day_first, month_first, secs, off, abbr).

    prec: Y, M, D, T (clock) or None where no real date is denoted. txt: the value for Y and M.
    day_first / month_first: epoch days under either order of an all-numeric date; the same number
    where the order is written. secs: clock in seconds. off: written offset in seconds. abbr: a zone
    abbreviation. Null, empty, relative and impossible values give all None; a text of any length is
    read, though one with digits besides one date and clock denotes none.
    """
    if raw is None:
        return NOTHING
    said = _SPACES.sub(" ", raw).strip()
    low = said.lower()
    if not any(c.isdigit() for c in low):
        return NOTHING
    if len(low) != len(said):  # a letter that grows when lowered would shift the positions
        said = low
    clock = None
    if m := _COMPACT.search(low):
        first = second = _day(int(m[1]), int(m[2]), int(m[3]))
        clock = (int(m[4]), int(m[5]), int(m[6] or 0), None)
        rest = (low[: m.start()] + " " + low[m.end() :], said[: m.start()] + " " + said[m.end() :])
    elif m := _DIGITS.search(low):
        n, rest = m[1], low[: m.start()] + low[m.end() :]
        if any(c.isdigit() for c in rest):
            return NOTHING
        if len(n) == 8:
            day = _day(int(n[:4]), int(n[4:6]), int(n[6:]))
            return ("D", None, day, day, None, None, None) if day is not None else NOTHING
        if len(n) == 14:
            day, h, mi, s = _day(int(n[:4]), int(n[4:6]), int(n[6:8])), int(n[8:10]), int(n[10:12]), int(n[12:])
            return ("T", None, day, day, h * 3600 + mi * 60 + s, 0, None) if day is not None and h < 24 and mi < 60 and s < 60 else NOTHING
        if len(n) == 11:
            return NOTHING
        at = int(n) // (1000 if len(n) > 10 else 1)
        return ("T", None, at // 86400, at // 86400, at % 86400, 0, None)
    else:
        inner = ""
        if m := _YMD.search(low):
            first = second = _day(int(m[1]), int(m[3]), int(m[4]))
        elif m := _NUMERIC.search(low):
            year = int(m[4]) + (2000 if len(m[4]) == 2 else 0)
            first, second = _day(year, int(m[3]), int(m[1])), _day(year, int(m[1]), int(m[3]))
        elif m := _CTIME.search(low):
            first = second = _day(int(m[4]), MONTHS[m[1]], int(m[2]))
            inner = (m.start(3), m.end(3))
        elif m := _D_M_Y.search(low):
            first = second = _day(int(m[3]), MONTHS[m[2]], int(m[1]))
        elif m := _M_D_Y.search(low):
            first = second = _day(int(m[3]), MONTHS[m[1]], int(m[2]))
        elif m := _Y_M_D.search(low):
            first = second = _day(int(m[1]), MONTHS[m[2]], int(m[3]))
        elif (m := _M_Y.search(low)) or (m := _Y_M.search(low)):
            named = m[1] in MONTHS
            year, month = (int(m[2]), MONTHS[m[1]]) if named else (int(m[1]), int(m[3]))
            rest = low[: m.start()] + " " + low[m.end() :]
            if any(c.isdigit() for c in rest) or not 1 <= month <= 12 or year < 1000:
                return NOTHING
            return ("M", f"{year:04d}-{month:02d}", None, None, None, None, None)
        elif m := _YEAR.search(low):
            if any(c.isdigit() for c in low[: m.start()] + low[m.end() :]) or not 1000 <= int(m[1]) <= 2999:
                return NOTHING
            return ("Y", m[1], None, None, None, None, None)
        else:
            return NOTHING
        keep = (low[inner[0] : inner[1]], said[inner[0] : inner[1]]) if inner else ("", "")
        rest = (low[: m.start()] + " " + keep[0] + " " + low[m.end() :], said[: m.start()] + " " + keep[1] + " " + said[m.end() :])
        if t := _TIME.search(rest[0]):
            clock = (int(t[1]), int(t[2]), int(t[3] or 0), t[4])
            rest = (rest[0][: t.start()] + "\x00" + rest[0][t.end() :], rest[1][: t.start()] + "\x00" + rest[1][t.end() :])
    if first is None and second is None:
        return NOTHING
    if clock is None:
        return NOTHING if any(c.isdigit() for c in rest[0]) else ("D", None, first, second, None, None, None)
    hour, minute, second_of, half = clock
    if half:
        if not 1 <= hour <= 12:
            return NOTHING
        hour = hour % 12 + (12 if half[0] == "p" else 0)
    if hour > 23 or minute > 59 or second_of > 59:
        return NOTHING
    secs, off, abbr, low, said = hour * 3600 + minute * 60 + second_of, None, None, *rest
    if (z := _NAMED_OFFSET.search(low)) or (z := _OFFSET.search(low)):
        off = (int(z[2]) * 3600 + int(z[3] or 0) * 60) * (-1 if z[1] == "-" else 1)
        if abs(off) > 18 * 3600:
            return NOTHING
        low = low[: z.start()] + low[z.end() :]
    else:
        for word in _ABBREVIATION.findall(said):
            if word in ("Z", "UTC", "GMT"):
                off = 0
                break
            if len(word) > 1:
                abbr = word
    if any(c.isdigit() for c in low):
        return NOTHING
    return ("T", None, first, second, secs, off, abbr if off is None else None)


@F.pandas_udf(READING)
def date_reading(raw: pd.Series) -> pd.DataFrame:
    """``read_date`` over an Arrow batch; equal strings of a batch are read once."""
    seen: dict = {}
    rows = []
    for x in raw:
        if x not in seen:
            seen[x] = read_date(x)
        rows.append(seen[x])
    out = pd.DataFrame(rows, columns=["prec", "txt", "day_first", "month_first", "secs", "off", "abbr"])
    return out.astype({"day_first": "Int32", "month_first": "Int32", "secs": "Int32", "off": "Int32"})
