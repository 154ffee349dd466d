"""Number formats used in reports. Halves round up, before formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", F.round(value.cast("double"), 1))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def percent(share: Column, digits: int = 1) -> Column:
    """A share of one as a percentage, e.g. 0.125 → ``12.5%``."""
    return F.format_string(f"%.{digits}f%%", F.round(share.cast("double") * 100, digits))
