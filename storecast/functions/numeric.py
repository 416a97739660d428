"""Column helpers for rounding and ratios. All work on DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, digits: int) -> Column:
    """Round the scaled double half to even, as array libraries do.

    `bround` works on the decimal text instead and gives 1.02 for 1.015.
    """
    scale = float(10**digits)
    return F.rint(x.cast("double") * F.lit(scale)) / F.lit(scale)


def round_to_multiple(x: Column, unit: float) -> Column:
    """Nearest multiple of `unit`, halves to even."""
    return F.rint(x.cast("double") / F.lit(float(unit))) * F.lit(float(unit))


def pct_change(before: Column, after: Column, digits: int = 1) -> Column:
    """Change in percent; NULL where `before` is zero."""
    before, after = before.cast("double"), after.cast("double")
    return round_half_even(F.try_divide(after - before, before) * F.lit(100.0), digits)


def share_pct(part: Column, total: Column) -> Column:
    """`part` of `total` in percent; NULL for an empty total."""
    return F.try_divide(part.cast("double"), total.cast("double")) * F.lit(100.0)


def clip_low(x: Column, low: float = 0.0) -> Column:
    """Raise values below `low` to it; NULL stays NULL (`greatest` would drop it)."""
    return F.when(x < F.lit(low), F.lit(low)).otherwise(x)


def portable_hash(key: Column) -> Column:
    """32-bit multiplicative hash of a non-negative integer key.

    Reduced before the multiply, so that no key overflows a long.
    """
    return (key.cast("long") % F.lit(2**31) * F.lit(2654435761)) % F.lit(2**32)
