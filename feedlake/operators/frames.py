"""Frame shaping: ordered select with casts, constants, filters, fills (P4-P7,
P11, P17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame, spec) -> DataFrame:
    """Ordered select with renames and casts (P4).  ``spec`` items are
    ``name`` | ``(name, source)`` | ``(name, source, type)`` where source is a
    column name or a Column."""
    cols = []
    for item in spec:
        if isinstance(item, str):
            cols.append(F.col(item))
            continue
        name, src, *t = item
        c = F.col(src) if isinstance(src, str) else src
        if t:
            c = c.cast(t[0])
        cols.append(c.alias(name))
    return df.select(*cols)


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    """Constants and typed nulls (P5): ``{name: (value, type)}``.  Every literal,
    null included, is cast, so no void-typed column reaches a sink."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in values.items()})


def only(df: DataFrame, predicate) -> DataFrame:
    """Filter (P6)."""
    return df.filter(predicate)


def fill_defaults(df: DataFrame, values: dict) -> DataFrame:
    """Frame-level default fill."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_from(df: DataFrame, suffix: str, cols) -> DataFrame:
    """Fill several columns each from a joined twin named ``col + suffix`` and
    drop the twins (P11), in one projection."""
    out = df.withColumns({c: F.coalesce(F.col(c), F.col(c + suffix)) for c in cols})
    return out.drop(*[c + suffix for c in cols])


def stamp(df: DataFrame, run_date: str, name: str = "updated_at") -> DataFrame:
    """Run-date stamp (P17); the date is a parameter of the run."""
    return df.withColumn(name, F.lit(run_date).cast("date"))
