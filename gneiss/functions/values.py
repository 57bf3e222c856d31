"""Dates, rounding and casts used across plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(as_of) -> Column:
    """``as_of`` as a DATE column; the clock is used only when nothing is given."""
    if as_of is None:
        return F.current_date()
    return as_of.cast("date") if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp").cast("date")


def moment(as_of) -> Column:
    """``as_of`` as a TIMESTAMP column; the clock is used only when nothing is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of.cast("timestamp") if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def steady_round(value, digits: int = 2) -> Column:
    """Round a double half up after fixing six decimals.

    Distributed sums of doubles differ in their last bits from run to run; without the
    intermediate decimal a value lying on a half would round either way.
    """
    fixed = F.col(value) if isinstance(value, str) else value
    return F.round(fixed.cast("decimal(38,6)"), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL where the whole is 0 or NULL."""
    return F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0)))


def byte_count(size) -> int | None:
    """Bytes in a size such as ``100k``, ``2mb`` or ``10g``; plain numbers pass through."""
    if size is None or isinstance(size, int):
        return size
    units = {"": 0, "b": 0, "k": 1, "kb": 1, "m": 2, "mb": 2, "g": 3, "gb": 3, "t": 4, "tb": 4}
    text = size.strip().lower()
    digits = text.rstrip("bkmgt ")
    unit = text[len(digits):].strip()
    if not digits.isdigit() or unit not in units:
        raise ValueError(f"not a size: {size!r}")
    return int(digits) * 1024 ** units[unit]
