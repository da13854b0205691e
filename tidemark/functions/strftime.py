"""Does a text parse with a strftime pattern: the date/time format rules.

A pattern becomes a regular expression (one group per directive, case
ignored, white space in the pattern matching any run of white space), matched
without backtracking over the whole text, as ``datetime.strptime`` matches;
then the fields must make a date: year, month and day, or a year with a day's
number, a week and a weekday, or an ISO year, week and weekday. Both steps are
built-in JVM expressions; one match of the regular expression gives all fields.

Names and the patterns of ``%c %x %X`` are those of the C locale; ``%Z`` takes
utc, gmt and the time zone names of the machine that builds the expression.
"""

from __future__ import annotations

import datetime as _dt
import re
import time

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
_MONTHS = ("January February March April May June July August September October "
           "November December").split()


def _names(names: list[str], short: bool) -> str:
    return "|".join(n[:3] if short else n for n in names)


# What each strftime directive matches (two-digit fields may
# drop a leading zero; names are those of the C locale).
DIRECTIVES = {
    "Y": r"\d\d\d\d",
    "y": r"\d\d",
    "m": r"1[0-2]|0[1-9]|[1-9]",
    "d": r"3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9]",
    "H": r"2[0-3]|[0-1]\d|\d",
    "I": r"1[0-2]|0[1-9]|[1-9]",
    "M": r"[0-5]\d|\d",
    "S": r"6[0-1]|[0-5]\d|\d",
    "f": r"[0-9]{1,6}",
    "j": r"36[0-6]|3[0-5]\d|[1-2]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9]",
    "U": r"5[0-3]|[0-4]\d|\d",
    "W": r"5[0-3]|[0-4]\d|\d",
    "V": r"5[0-3]|0[1-9]|[1-4]\d|\d",
    "G": r"\d\d\d\d",
    "u": r"[1-7]",
    "w": r"[0-6]",
    "z": r"[+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?|Z",
    "p": r"am|pm",
    "a": _names(_DAYS, True),
    "A": "|".join(sorted(_DAYS, key=len, reverse=True)),
    "b": _names(_MONTHS, True),
    "B": "|".join(sorted(_MONTHS, key=len, reverse=True)),
}


# The patterns that stand for the locale's (C).
LOCALE_FORMATS = {"c": "%a %b %d %H:%M:%S %Y", "x": "%m/%d/%y", "X": "%H:%M:%S"}
#: Between the fields of a match; no text of a pattern holds it but for an escape.
_MARK = "\u0001"
_LAST_YEAR = 9999


def zone_names() -> str:
    names = {"utc", "gmt", *(n.lower() for n in time.tzname)}
    return "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True) if n)


def bad_format(fmt: str) -> str | None:
    """Why ``strptime`` refuses the pattern itself; None if it takes it."""
    try:
        _dt.datetime.strptime("", fmt)
    except ValueError as error:
        if "does not match" not in str(error) and "unconverted" not in str(error):
            return str(error)
    except (re.error, KeyError, IndexError) as error:
        return str(error)
    return None


def to_regex(fmt: str) -> tuple[str, dict[str, int]] | None:
    """(regex, group number of each directive), or None for a pattern that
    ``strptime`` refuses too. A directive may occur once, as for ``strptime``."""
    out, groups, i = [], {}, 0
    fmt = re.sub("%(.)", lambda m: LOCALE_FORMATS.get(m[1], m[0]), fmt, flags=re.S)
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%" and i + 1 < len(fmt):
            d = fmt[i + 1]
            if d == "%":
                out.append("%")
            elif (d in DIRECTIVES or d == "Z") and d not in groups:
                groups[d] = len(groups) + 1
                out.append(f"({zone_names() if d == 'Z' else DIRECTIVES[d]})")
            else:
                return None
            i += 2
        elif ch.isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            out.append(r"\s+")
        else:
            out.append(re.escape(ch) if ch.isascii() and not ch.isalnum() else ch)
            i += 1
    # (?>...): the first way to match counts, without trying others to reach the end
    return f"(?iU)^(?>{''.join(out)})\\z", groups


def _place(text: Column, names: list[str], short: bool) -> Column:
    found = F.array(*[F.lit((n[:3] if short else n).lower()) for n in names])
    return F.array_position(found, F.lower(text)).cast("int")


class _Fields:
    """The fields of one match as numbers; of directives with the same meaning
    the last one in the pattern counts."""

    def __init__(self, groups: dict[str, int], of: Column):
        self.groups, self.of = groups, of

    def last(self, directives: str) -> str | None:
        return max((d for d in directives if d in self.groups), key=self.groups.get, default=None)

    def text(self, d: str) -> Column:
        return F.get(self.of, self.groups[d])

    def number(self, d: str) -> Column:
        return F.trim(self.text(d)).cast("int")

    def year(self) -> Column:
        d = self.last("Yy")
        if d is None:
            return F.lit(1900)
        return self.number("Y") if d == "Y" else F.when(self.number("y") < 69, self.number("y") + 2000).otherwise(self.number("y") + 1900)

    def month(self) -> Column:
        d = self.last("mbB")
        if d is None:
            return F.lit(1)
        return self.number("m") if d == "m" else _place(self.text(d), _MONTHS, d == "b")

    def weekday(self) -> Column | None:
        """0 for Monday."""
        d = self.last("aAwu")
        if d is None:
            return None
        if d in "aA":
            return _place(self.text(d), _DAYS, d == "a") - 1
        return (self.number(d) + (6 if d == "w" else -1)) % 7

    def real(self) -> Column | None:
        """Whether the fields make a date and time; None if any make a date."""
        date = self._date()
        return date & (self.number("S") < 60) if date is not None and "S" in self.groups else date

    def _date(self) -> Column | None:
        weekday = self.weekday()
        iso, week = ("G" in self.groups, "V" in self.groups), self.last("UW")
        if iso[0] and ("j" in self.groups or not iso[1] or weekday is None) or iso[1] and not iso[0]:
            return F.lit(False)  # the pattern parses, no value does
        if "j" in self.groups:
            return self._in_range(self.year(), self.number("j"))
        if week is not None and weekday is not None:
            return self._in_range(self.year(), self._day_of_week(week, weekday))
        if all(iso):
            return self._iso(self.number("G"), self.number("V"), weekday)
        if not any(d in self.groups for d in "Yymdb" "B"):
            return None
        day = self.number("d") if "d" in self.groups else F.lit(1)
        first = F.make_date(F.greatest(self.year(), F.lit(1)), self.month(), F.lit(1))
        return (self.year() >= 1) & ((day <= 28) | (day <= F.dayofmonth(F.last_day(first))))

    @staticmethod
    def _in_range(year: Column, day: Column) -> Column:
        """A day counted from the year's first one lies in the years 1 to 9999."""
        return (year >= 1) & ((year > 1) | (day >= 1)) & ((year < _LAST_YEAR) | (day <= 365))

    def _day_of_week(self, week: str, weekday: Column) -> Column:
        """Day of the year, 1 for the first, of a weekday in a week that begins
        with Sunday (U) or Monday (W); days before the first such week are week 0."""
        late = 0 if week == "W" else 1
        first = (F.weekday(F.make_date(F.greatest(self.year(), F.lit(1)), F.lit(1), F.lit(1))) + late) % 7
        day, n = (weekday + late) % 7, self.number(week)
        return F.when(n == 0, 1 + day - first).otherwise(1 + (7 - first) % 7 + 7 * (n - 1) + day)

    @staticmethod
    def _iso(year: Column, week: Column, weekday: Column) -> Column:
        """Weeks 1 to 52, and 53 in years that begin with a Thursday, or with a
        Wednesday if they are leap years; the last days of 9999's last week are in
        the year 10000."""
        safe = F.greatest(year, F.lit(1))
        first = F.weekday(F.make_date(safe, F.lit(1), F.lit(1)))
        leap = F.dayofmonth(F.last_day(F.make_date(safe, F.lit(2), F.lit(1)))) == 29
        long = (first == 3) | ((first == 2) & leap)
        return (year >= 1) & (week >= 1) & ((week < 53) | long) & ((year < _LAST_YEAR) | (week < 52) | (weekday <= 4))


def parses_with(c: Column, fmt: str) -> Column:
    """Boolean column: does the (string-cast) value parse with strftime ``fmt``.

    NULL for NULL input. ``fmt`` must be one that ``bad_format`` lets pass.
    """
    text = c.cast("string")
    parts = to_regex(fmt)
    if parts is None:
        raise ValueError(f"bad pattern {fmt!r}")
    pattern, groups = parts
    ok = text.rlike(pattern)
    if _Fields(groups, text).real() is None:
        if "S" in groups:  # 60 and 61 match, but are no seconds of a time
            leap = F.regexp_extract(text, pattern, groups["S"]).isin("60", "61")
            ok = ok & ~((text.contains("60") | text.contains("61")) & leap)
        return F.when(text.isNotNull(), ok)
    if _MARK in fmt:  # fields can't be told from the text by it
        fields = F.when(ok, F.array(F.lit(""), *[F.regexp_extract(text, pattern, k) for k in groups.values()]))
    else:
        marked = F.regexp_replace(text, pattern, _MARK + _MARK.join(f"${k}" for k in groups.values()))
        fields = F.when(~text.startswith(_MARK), F.split(marked, _MARK))
    # a text that doesn't match stays whole, or is split by marks of its own
    judged = F.transform(F.array(fields), lambda of: F.coalesce((F.size(of) == len(groups) + 1) & (F.get(of, F.lit(0)) == "") & _Fields(groups, of).real(), F.lit(False)))
    return F.when(text.isNotNull(), F.get(judged, F.lit(0)))
