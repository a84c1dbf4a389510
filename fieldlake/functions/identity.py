"""Ids and reproducible pseudo-random numbers from hashes.

Hashes of the row's own values replace seeded generators: the result is the same for any
partitioning, any retry and any engine that knows SHA-256.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlake.functions.numeric import hex_to_long, nan_to_null
from fieldlake.schema import SEED

def deterministic_score(*parts: Column, seed: int = SEED) -> Column:
    """Score in [0, 1) of the concatenated parts: the first 64 hash bits modulo 1e7, over 1e7.

    The modulo is read off as the last seven decimal digits of the unsigned number.
    """
    digest = F.sha2(F.concat(F.lit(str(seed)), *[p.cast("string") for p in parts]), 256)
    number = F.conv(F.substring(digest, 1, 16), 16, 10)
    return F.substring(number, -7, 7).cast("int") / F.lit(1e7)


def grid_field_id(lat: Column, lon: Column, precision: int = 3) -> Column:
    """``grid_<lat>_<lon>`` with rounded coordinates; a missing one reads ``nan``."""

    def text(value: Column) -> Column:
        rounded = F.round(nan_to_null(value.cast("double")), precision)
        return F.coalesce(rounded.cast("string"), F.lit("nan"))

    return F.concat(F.lit("grid_"), text(lat), F.lit("_"), text(lon))


def round_robin_field(index: Column, fields: int) -> Column:
    return F.concat(F.lit("field_"), (index % fields + 1).cast("string"))


def uniform(digest: Column, position: int) -> Column:
    """Uniform number in (0, 1) from the 8 hex digits starting at 1-based ``position``."""
    return (hex_to_long(F.substring(digest, position, 8)) + F.lit(0.5)) / F.lit(float(2**32))


def normals(digest: Column, count: int) -> list[Column]:
    """Up to 8 independent standard normals from one SHA-256 digest (Box-Muller)."""
    if count > 8:
        raise ValueError("one digest yields at most 8 normals")
    out: list[Column] = []
    for pair in range((count + 1) // 2):
        radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(digest, 16 * pair + 1)))
        angle = F.lit(2.0) * F.pi() * uniform(digest, 16 * pair + 9)
        out += [radius * F.cos(angle), radius * F.sin(angle)]
    return out[:count]


_DIGITS = "0123456789abcdef"


def draw_digits(seed: Column, bits: int = 3, draws: int = 64) -> Column:
    """``draws`` uniform integers of ``bits`` bits each, as a string of hex digits.

    Every digit of a SHA-256 digest is one draw (its lowest ``bits`` bits), so 64 draws cost one
    hash; more draws chain further digests.
    """
    if not 1 <= bits <= 4:
        raise ValueError("bits must be between 1 and 4")
    if draws < 1:
        raise ValueError("draws must be positive")
    blocks = [
        F.sha2(F.concat(seed.cast("string"), F.lit(f":{block}")), 256)
        for block in range((draws + 63) // 64)
    ]
    folded = "".join(_DIGITS[i % 2**bits] for i in range(16))
    return F.translate(F.substring(F.concat(*blocks), 1, draws), _DIGITS, folded)


def mean_of_digits(digits: Column, bits: int = 3, draws: int = 64) -> Column:
    """Mean of drawn digits, scaled to [0, 1]. Counting how often each of the 2**bits values
    occurs keeps the sum in generated code."""
    top = 2**bits - 1
    length = F.length(digits)
    terms = [
        (length - F.length(F.replace(digits, F.lit(_DIGITS[value]), F.lit("")))) * value
        for value in range(1, top + 1)
    ]
    return functools.reduce(Column.__add__, terms) / F.lit(float(draws * top))


def mean_of_draws(seed: Column, bits: int = 3, draws: int = 64) -> Column:
    return mean_of_digits(draw_digits(seed, bits, draws), bits, draws)
