"""Numeric expressions: percentages, clock-style numbers, units, site grids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def integer_text(text: Column) -> Column:
    """Canonical digits of the whole number in a text, of any size; null for anything else.

    Underscores may stand between digits. Leading zeros, a plus sign and the sign of zero are dropped, so
    equal numbers have equal texts.
    """
    digits = F.regexp_replace(F.replace(text, F.lit("_"), F.lit("")), r"^([+-]?)0+(?=\d)", "$1")
    signed = F.regexp_replace(digits, r"^\+|^-(?=0$)", "")
    return F.when(text.rlike(r"^[+-]?\d+(_\d+)*$"), signed)


def integer_or_null(text: Column) -> Column:
    """Whole number in a text, null for anything else; one that a bigint can't hold fails the job."""
    return integer_text(text).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole; null when there is nothing to divide by."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def percent_text(value: Column) -> Column:
    """Percent with two decimals, padded to six characters."""
    return F.format_string("%6.2f%%", value)


def fixed_text(value: Column, digits: int = 2) -> Column:
    """Rounded number with exactly ``digits`` decimals."""
    return F.format_string(f"%.{digits}f", F.round(value, digits))


def clock_hours(value: Column) -> Column:
    """A clock-style number such as 8.15 (for 8:15) as hours."""
    whole = F.floor(value)
    return whole + (value - whole) / 0.6


def mm_to_um(value: Column) -> Column:
    return value * 1000.0


def seconds_to_hours(value: Column) -> Column:
    return value / 3600.0


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / 6e7


def site_grid(site: Column, nx: Column, ny: Column, nz: Column, nt: Column, zero_based: bool = False) -> Column:
    """Struct (site_x, site_y, site_z, site_t) of a 1-based site number.

    The recorded grid wraps on the 1-based number, so the first site of a 2 x 2
    grid sits at (1, 0); ``zero_based`` gives the grid that starts at (0, 0).
    """
    n = site - 1 if zero_based else site

    def wrap(step: Column, size: Column) -> Column:
        return (F.floor(n / step) % size).cast("int")

    one = F.lit(1)
    return F.struct(
        wrap(one, nx).alias("site_x"),
        wrap(nx, ny).alias("site_y"),
        wrap(nx * ny, nz).alias("site_z"),
        wrap(nx * ny * nz, nt).alias("site_t"),
    )
