"""Scalar column functions: number parsing, dates as text, geohash cells, stable hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the alphabet of geohash digits.
GEOHASH_DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"


def filled(text: Column) -> Column:
    """The text, or NULL if it is empty."""
    return F.nullif(text, F.lit(""))


def first_filled(*texts: Column) -> Column:
    return F.coalesce(*[filled(t) for t in texts])


def to_int(text: Column) -> Column:
    """Whole-number text as BIGINT, blanks around it allowed; anything else, "12.0" too, is NULL."""
    return F.when(F.trim(text).rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def parse_int(text: Column) -> Column:
    """Numeric text as BIGINT, cut toward zero; empty, NaN and infinite are NULL."""
    number = F.trim(text).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < 9.3e18), number).try_cast("bigint")


def to_float(text: Column) -> Column:
    """Numeric text as DOUBLE; NaN is missing. Suffixes such as "1.0d" are no numbers."""
    number = F.when(~F.trim(text).rlike("[dDfF]$") | F.trim(text).rlike("(?i)inf$"), text.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def leading_int(text: Column) -> Column:
    """The whole number that a text begins with, 0 if there is none, NULL for NULL."""
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1)
    return F.when(text.isNotNull(), F.coalesce(digits.try_cast("int"), F.lit(0)))


def year_of(event_date: Column) -> Column:
    return leading_int(F.substring(event_date, 1, 4))


def month_of(event_date: Column) -> Column:
    return leading_int(F.substring(event_date, 6, 2))


def valid_month(month: Column) -> Column:
    return F.when(month.between(1, 12), month)


def last_obs(year: Column, month: Column) -> Column:
    """(year, month) with month 0 as NULL; NULL without a year."""
    return F.when(year.isNotNull(), F.struct(year.cast("int").alias("year"), F.nullif(month.cast("int"), F.lit(0)).alias("month")))


def raw_line(columns: list[Column]) -> Column:
    """All source columns joined by tabs, NULL as empty text."""
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def _axis_index(value: Column, low: float, span: float, bits: int) -> Column:
    """Which of 2**bits equal parts of an axis a value is in; out-of-range values are in the outermost part, NaN in the first."""
    parts = 1 << bits
    guess = F.least(F.greatest(F.floor((F.nanvl(value, F.lit(low)) - low) / span * parts), F.lit(0)), F.lit(parts - 1)).cast("bigint")
    edge = lambda i: F.lit(low) + i * F.lit(span / parts)  # noqa: E731  exact: edges are dyadic fractions
    lower = F.when((guess > 0) & (value < edge(guess)), guess - 1).otherwise(guess)
    return F.when((lower < parts - 1) & (value >= edge(lower + 1)) & ~F.isnan(value), lower + 1).otherwise(lower)


def geohash_axes(lat: Column, lon: Column, precision: int) -> tuple[Column, Column]:
    """Places of a point on the longitude and the latitude axis of the cells of a precision."""
    bits = 5 * precision
    return _axis_index(lon, -180.0, 360.0, (bits + 1) // 2), _axis_index(lat, -90.0, 180.0, bits // 2)


def geohash_digits(x: Column, y: Column, precision: int) -> Column:
    """The cell's text from its places, whose bits alternate, longitude first. x and y should be columns, as each is used many times."""
    bits = 5 * precision
    digits = []
    for d in range(precision):
        value = F.lit(0).cast("bigint")
        for b in range(5 * d, 5 * d + 5):
            axis, left = (x, (bits + 1) // 2 - 1 - b // 2) if b % 2 == 0 else (y, bits // 2 - 1 - b // 2)
            value = value + F.shiftleft(F.shiftright(axis, left).bitwiseAND(F.lit(1)), 5 * d + 4 - b)
        digits.append(F.substring(F.lit(GEOHASH_DIGITS), value.cast("int") + 1, F.lit(1)))
    return F.concat(*digits)


def stable_hash(*parts: Column) -> Column:
    """An unsigned 32-bit hash of parts as text, the same in every run and engine; NULL counts as empty."""
    text = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def place_of(identifier: Column) -> Column:
    """A whole number that grows with the identifier, a quarter of it, so that differences of places fit BIGINT."""
    return F.shiftright(identifier.cast("bigint"), 2)


def stable_u32(*parts: Column) -> Column:
    """An unsigned 32-bit hash of parts as text, joined by unit separators, NULL as empty: BLAKE2b of four bytes, the first highest.

    For samples that must agree with ones drawn with this hash before; stable_hash is native, and faster. Parts that are
    doubles should be made text by whoever asks for it, as engines write them differently.
    """

    @F.arrow_udf("bigint")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [int.from_bytes(hashlib.blake2b(t.encode("utf-8", "ignore"), digest_size=4).digest(), "big") for t in texts.to_pylist()]
            yield pa.array(found, pa.int64())

    return digest(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
