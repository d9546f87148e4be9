"""Dates as they stand in Malay and English listings, read from their tokens."""

from __future__ import annotations

import re
from datetime import date
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: fixed values: month names and abbreviations of both languages, by month
MONTHS = {
    1: ("januari", "january", "jan"),
    2: ("februari", "february", "feb"),
    3: ("mac", "march", "mar"),
    4: ("april", "apr"),
    5: ("mei", "may"),
    6: ("jun", "june"),
    7: ("julai", "july", "jul"),
    8: ("ogos", "august", "ogo", "aug"),
    9: ("september", "sep", "sept"),
    10: ("oktober", "october", "okt", "oct"),
    11: ("november", "nov"),
    12: ("disember", "december", "dis", "dec"),
}
#: fixed values: Malay days of the week
DAYS = ("isnin", "selasa", "rabu", "khamis", "jumaat", "sabtu", "ahad")

_YEAR = r"((?:19|20)\d{2})"


def month_number(name: Column) -> Column:
    """1-12 of a month's name in either language, null otherwise."""
    known = F.create_map(*[F.lit(x) for m, names in MONTHS.items() for n in names for x in (n, m)])
    return F.try_element_at(known, F.lower(name))


#: two-digit years from here on belong to the last century
PIVOT = 70
_ISO = re.compile(r"\d{4}-\d{2}-\d{2}")
_TOKEN = re.compile(r"\w+|[^\w]+")
_ORDINAL = re.compile(r"(\d+)(?:st|nd|rd|th)$")
_JOINED = re.compile(r"(\d{1,2})([^\W\d_]+)$")
_NUMBERS = {name: m for m, names in MONTHS.items() for name in names}
#: forms of dates, in the order in which they are looked for, as classes of tokens and the signs that may stand
#: between two of them (+: one at least, 1: just one).  M a month's name, D one or two digits, Y a year, S two digits
#: for a year, C eight digits.
_FORMS = (
    ("DMY", (" .-", " ,.-")),
    ("MDY", (" .", "+ ,")),
    ("DDY", ("1/.-", "1/.-")),
    ("MY", (" ,.",)),
    ("YMD", (" ,./-", " ,./-")),
    ("YDD", ("1/.-", "1/.-")),
    ("DMS", (" .-", " ,.-")),
    ("DDS", ("1/.-", "1/.-")),
    ("C", ()),
    ("YM", (" ,./-",)),
    ("DY", ("1/.-",)),
    ("Y", ()),
)


def _tokens(text: str) -> list[tuple[frozenset[str], str, str]]:
    """(classes, token, what stands before it) of a label's words and numbers, but names of days."""
    out, gap = [], ""
    for token in _TOKEN.findall(text.lower()):
        if not (token[0].isalnum() or token[0] == "_"):
            gap += re.sub("[|•\\s]+", " ", token)
            continue
        if token in DAYS:
            gap += " "
            continue
        if m := _ORDINAL.match(token):
            token = m[1]
        parts = [token]
        if (m := _JOINED.match(token)) and m[2] in _NUMBERS:
            parts = [m[1], m[2]]
        for part in parts:
            kinds = ""
            if part in _NUMBERS:
                kinds = "M"
            elif part.isascii() and part.isdigit():
                n = len(part)
                kinds = ("D" if n <= 2 else "") + ("S" if n == 2 else "") + ("Y" if n == 4 and part[:2] in ("19", "20") else "") + ("C" if n == 8 else "")
            out.append((frozenset(kinds), part, re.sub(" +", " ", gap)))
            gap = ""
    return out


def _read(form: str, parts: list[str]) -> str | None:
    """The date that a form's tokens say, if there is such a day."""
    day, month, year = 1, 1, 0
    numbers = []
    for kind, part in zip(form, parts):
        if kind == "M":
            month = _NUMBERS[part]
        elif kind == "Y":
            year = int(part)
        elif kind == "S":
            year = int(part) + (1900 if int(part) >= PIVOT else 2000)
        elif kind == "C":
            year, month, day = int(part[:4]), int(part[4:6]), int(part[6:])
        else:
            numbers.append(int(part))
    if form in ("DDY", "DDS", "YDD"):  # days come first, unless only the other way round is a date
        day, month = numbers if form != "YDD" or numbers[1] <= 12 else numbers[::-1]
        if month > 12:
            day, month = month, day
    elif form == "DY":
        month = numbers[0]
    elif numbers:
        day = numbers[0]
    try:
        return date(year, month, day).isoformat()
    except ValueError:
        return None


def _between(signs: str, gap: str) -> bool:
    if signs[:1] == "1":
        return len(gap) == 1 and gap in signs[1:]
    return (bool(gap) or signs[:1] != "+") and all(c in signs for c in gap)


@lru_cache(maxsize=1 << 16)
def read_date(label: str) -> str:
    """The ISO date of a label, '' without one."""
    given = label.strip()
    if m := _ISO.match(given):
        return m[0]
    tokens = _tokens(given)
    for form, signs in _FORMS:
        for i in range(len(tokens) - len(form) + 1):
            here = tokens[i : i + len(form)]
            if all(k in t[0] for k, t in zip(form, here)) and all(_between(s, t[2]) for s, t in zip(signs, here[1:])):
                found = _read(form, [t[1] for t in here])
                if found is not None:
                    return found
                if form != "Y":
                    break  # the first place of a form is the only one that counts
    return ""


@F.pandas_udf(StringType())
def _read_labels(labels: pd.Series) -> pd.Series:
    which, distinct = pd.factorize(labels.fillna(""))
    return pd.Series([read_date(x) for x in distinct], dtype=object).take(which).reset_index(drop=True)


@F.pandas_udf(ArrayType(StringType()))
def _read_each(lists: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [read_date(t or "") for t in x] for x in lists], dtype=object)


def parse_date(text: Column) -> Column:
    """ISO text of the date in a listing's label, '' without one.  A leading ISO date stands as it is; then forms with a
    month's name, with numbers (days first, unless only the other order is a date), with years of two digits or all
    digits together, months with a year (first day) and a year (first of January) are looked for in the order of
    ``_FORMS``.  One pass of tokens over the distinct labels of an Arrow batch."""
    return _read_labels(text)


def iso_date(text: Column) -> Column:
    """Date part of an ISO date or timestamp (its offset is not converted), '' otherwise."""
    return F.coalesce(F.date_format(F.try_to_date(F.substring(F.trim(text), 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd"), F.lit(""))


def year_or_date(value: Column) -> Column:
    """A four-digit year is its first of January, anything else an ISO date."""
    return F.when(F.trim(value).rlike(r"^\d{4}$"), F.concat(F.trim(value), F.lit("-01-01"))).otherwise(iso_date(value))


def sitting_date(label: Column) -> Column:
    """Label of a sitting: a date with the day in brackets."""
    return parse_date(F.regexp_replace(label, r"\([^)]*\)", " "))


def range_start(label: Column) -> Column:
    """First day of ``17 Ogos - 20 Ogos 2015``; the year comes from the end when the start has none."""
    head, tail = F.trim(F.regexp_extract(label, r"^(.*?)\s+(?:-|–|hingga)\s+", 1)), F.regexp_extract(label, _YEAR + r"\D*$", 1)
    return F.when(head == "", parse_date(label)).otherwise(parse_date(F.when(head.rlike(_YEAR), head).otherwise(F.concat_ws(" ", head, tail))))


def name_date(name: Column) -> Column:
    """yyyy-mm-dd from a file name with ddmmyyyy, not checked against the calendar."""
    part = lambda i: F.regexp_extract(name, r"(\d{2})(\d{2})(\d{4})(?=\.[A-Za-z]+$)", i)
    return F.when(part(1) == "", F.lit("")).otherwise(F.concat_ws("-", part(3), part(2), part(1)))


def path_date(url: Column) -> Column:
    """Date of a /YYYY/MM/DD/ path."""
    part = lambda i: F.regexp_extract(url, r"/(\d{4})/(\d{2})/(\d{2})(?:/|$)", i)
    return F.when(part(1) == "", F.lit("")).otherwise(F.concat_ws("-", part(1), part(2), part(3)))


def title_date(title: Column) -> Column:
    """Date in a title: after "sehingga", else "bulan" month, else a date, month or year anywhere."""
    until = F.regexp_extract(F.lower(title), r"sehingga\s+(.*)$", 1)
    month = F.regexp_extract(F.lower(title), r"bulan\s+(.*)$", 1)
    return F.coalesce(*[F.nullif(parse_date(x), F.lit("")) for x in (until, month, title)], F.lit(""))


def feed_date(text: Column) -> Column:
    """Date of an RFC 822 time, in UTC."""
    s = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(F.date_format(F.coalesce(F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss z"))), "yyyy-MM-dd"), F.lit(""))


def since(date: Column, first: Column) -> Column:
    """False only for dates that parse and lie before ``first``."""
    return F.coalesce(F.try_to_date(date, "yyyy-MM-dd") >= first, F.lit(True))


def year_month(published: Column, discovered: Column) -> Column:
    return F.date_format(F.coalesce(published, discovered), "yyyy-MM")


def speech_date(title: Column, lines: Column, year: Column) -> Column:
    """Date of a speech: in brackets in its title, else the first of the lines below it that has one, else the first
    of January of its page's year, else ''."""
    bracketed = parse_date(F.regexp_extract(title, r"\(([^)]+)\)", 1))
    below = F.try_element_at(F.filter(_read_each(lines), lambda x: x != ""), F.lit(1))
    fallback = F.when(F.coalesce(year, F.lit("")) != "", F.concat(year, F.lit("-01-01")))
    return F.coalesce(F.nullif(bracketed, F.lit("")), below, fallback, F.lit(""))
