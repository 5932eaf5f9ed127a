"""Numeric expressions and casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.columns import as_col

# Fixed value: square metres to square feet.
SQFT_PER_M2 = 10.76391


def sqft(col, digits: int = 2) -> Column:
    """Area in m2 to ft2, rounded."""
    return F.round(as_col(col) * F.lit(SQFT_PER_M2), digits)


def half(col, decimal: str = "decimal(10,2)") -> Column:
    """Half of a non-zero score as a decimal; 0 otherwise."""
    c = as_col(col)
    return F.when(c.isNotNull() & (c != 0), c / 2).otherwise(F.lit(0)).cast(decimal)


def per_night(col, nights: int = 3, digits: int = 2) -> Column:
    """``abs(round(price / nights, digits))``."""
    return F.abs(F.round(as_col(col) / F.lit(nights), digits))


def round_to(col, digits: int = 2, dtype: str = "float") -> Column:
    """Fixed-digit rounding straight on the number (F16).  Rounding through
    ``format_number`` text fails for values >= 1000 under ANSI mode."""
    return F.round(as_col(col), digits).cast(dtype)


def to_type(col, dtype: str, safe: bool = False) -> Column:
    """Cast; ``safe=True`` yields null instead of an ANSI error."""
    c = as_col(col)
    return c.try_cast(dtype) if safe else c.cast(dtype)


def struct_text(col) -> Column:
    """A struct as JSON text (F17): stable, parseable, unlike the display text."""
    return F.to_json(as_col(col))
