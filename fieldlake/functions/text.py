"""Text column expressions.

Word and blank classes are spelled out for Unicode instead of using ``\\w`` and ``\\s``, whose
meaning differs between regex engines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
TOKEN = r"\p{L}[\p{L}\p{N}_]*|[0-9]+(?:\.[0-9]+)?"


def word_count(text: Column) -> Column:
    """Number of blank-separated words; 0 for blank text."""
    return F.regexp_count(text, F.lit(rf"[^\s\x0b\x1c-\x1f\x85\p{{Z}}]+"))


def contains_any_case(lowered: Column, keyword: str) -> Column:
    return F.contains(lowered, F.lit(keyword.lower()))


def count_present(lowered: Column, keywords: list[str]) -> Column:
    """How many of the keywords occur at all (presence, not frequency)."""
    total: Column = F.lit(0)
    for keyword in keywords:
        total = total + contains_any_case(lowered, keyword).cast("int")
    return total


def present_keywords(lowered: Column, keywords: list[str]) -> Column:
    """Array of the keywords that occur."""
    hits = [F.when(contains_any_case(lowered, k), F.lit(k.lower())) for k in keywords]
    return F.array_compact(F.array(*hits))


def find_all(text: Column, pattern: str) -> Column:
    """All non-overlapping, case-insensitive matches of ``pattern`` in ``text``."""
    return F.regexp_extract_all(text, F.lit(f"(?i)({pattern})"), F.lit(1))


def phrase_patterns(stem: str) -> list[str]:
    """The stem with the word after it, and with the word before it."""
    quoted = re.escape(stem)
    return [rf"{quoted}{BLANK}+{WORD}+", rf"{WORD}+{BLANK}+{quoted}"]


def tokens(text: Column) -> Column:
    """Lower-case words and numbers of a text, in order, with repetitions."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), F.lit(1))


def title_words(name: Column) -> Column:
    """``crop_yield`` -> ``Crop Yield``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def fixed_text(number: Column, digits: int = 3) -> Column:
    """Number with a fixed count of decimals, the same in every engine."""
    return number.cast(f"decimal(20,{digits})").cast("string")
