"""Time column expressions. All of them assume a UTC session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER_HOUR = 900


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def window_seed(ts: Column, seconds: int = QUARTER_HOUR) -> Column:
    """Number of the ``seconds``-long window a timestamp falls into."""
    return F.floor(F.unix_timestamp(ts) / seconds).cast("long")


def floor_window(ts: Column, seconds: int = QUARTER_HOUR) -> Column:
    """Start of the window a timestamp falls into (15 minutes by default)."""
    return F.timestamp_seconds(window_seed(ts, seconds) * seconds)


def _fraction(ts: Column) -> Column:
    """``.123456`` where a time has a fraction of a second, else nothing."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))


def iso_text(ts: Column) -> Column:
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), _fraction(ts), F.date_format(ts, "XXX")
    )


def second_text(ts: Column) -> Column:
    """``2024-01-31 10:20:30``, with the fraction if there is one; a missing time reads ``NaT``."""
    return F.coalesce(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), _fraction(ts)), F.lit("NaT"))


_CLOCK = r"( [0-9]+:[0-9]+(:[0-9]+)?)?$"
_YEAR = r"[+-]?[0-9]{4,}"

#: Written dates that Spark's own parser does not take, each with the look of the texts that its
#: parser takes; no text has two. With slashes the month comes first, unless the year does.
DATE_PATTERNS = (
    ("yyyy/M/d[ H:m[:s]]", f"^{_YEAR}/[0-9]+/[0-9]+"),
    ("M/d/yyyy[ H:m[:s]]", f"^[0-9]{{1,3}}/[0-9]+/{_YEAR}"),
    ("d.M.yyyy[ H:m[:s]]", f"^[0-9]+[.][0-9]+[.]{_YEAR}"),
    ("d MMM yyyy[ H:m[:s]]", f"^[0-9]+ [A-Za-z]{{3}} {_YEAR}"),
    ("d MMMM yyyy[ H:m[:s]]", f"^[0-9]+ [A-Za-z]{{4,}} {_YEAR}"),
    ("d-MMM-yyyy[ H:m[:s]]", f"^[0-9]+-[A-Za-z]{{3}}-{_YEAR}"),
    ("MMM d, yyyy[ H:m[:s]]", f"^[A-Za-z]{{3}} [0-9]+, {_YEAR}"),
    ("MMMM d, yyyy[ H:m[:s]]", f"^[A-Za-z]{{4,}} [0-9]+, {_YEAR}"),
)


def parse_timestamp(column: Column) -> Column:
    """Timestamp of loosely formatted text.

    A bare four-digit number (``1998`` or ``1998.0``) is a year and means its first day; eight
    digits are ``yyyyMMdd``. Anything else goes through Spark's own parser, then through the one
    of ``DATE_PATTERNS`` whose look it has; a parser that fails is dear, so no other is tried.
    What all reject becomes NULL, and so do other numbers of five and more digits, which would be
    taken for far-off years.
    """
    text = F.trim(column.cast("string"))
    year = F.regexp_extract(text, r"^([0-9]{4})(?:\.0*)?$", 1)
    first_day = F.make_date(year.try_cast("int"), F.lit(1), F.lit(1)).cast("timestamp")
    looks = F.when(text.rlike("^[0-9]{8}$"), F.lit("yyyyMMdd"))
    for pattern, look in DATE_PATTERNS:
        looks = looks.when(text.rlike(look + _CLOCK), F.lit(pattern))
    known = F.when(~text.rlike("^[+-]?[0-9]{5,}"), text).try_cast("timestamp")
    # the look is taken only where something else is written, as most times need no pattern
    written = F.when(text.rlike("[^0-9.]|^[0-9]{8}$|[.].*[.]"), looks)
    return F.coalesce(first_day, known, F.try_to_timestamp(text, written))


def start_of_year(ts: Column) -> Column:
    return F.date_trunc("year", ts)


def year_start(year: Column) -> Column:
    """First instant of an integer year."""
    return F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp")


def year_from_name(name: Column, strict: bool = False, default: int = 2000) -> Column:
    """Year in a file name.

    By default the first four of *all* digits in the name count, so ``v2_1998`` gives 2199.
    ``strict`` looks for a standalone 19xx/20xx instead.
    """
    if strict:
        found = F.regexp_extract(name, r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
    else:
        found = F.substring(F.regexp_replace(name, "[^0-9]", ""), 1, 4)
    return F.when(F.length(found) == 4, found.try_cast("int")).otherwise(F.lit(default))
