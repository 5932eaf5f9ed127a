"""Struct helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.columns import as_col


def pack(fields) -> Column:
    """Struct from columns (P12).  ``fields`` is a list of names, or a dict
    output-name -> column."""
    if isinstance(fields, dict):
        return F.struct(*[as_col(c).alias(n) for n, c in fields.items()])
    return F.struct(*[as_col(c) for c in fields])


def pack_into(df: DataFrame, name: str, fields, drop_sources: bool = True) -> DataFrame:
    """Add a packed struct column and drop its loose source columns."""
    out = df.withColumn(name, pack(fields))
    if drop_sources:
        names = list(fields) if not isinstance(fields, dict) else [
            c for c in fields.values() if isinstance(c, str)]
        out = out.drop(*[n for n in names if n != name])
    return out


def replace_field(struct_col, name: str, value) -> Column:
    """The struct with one field replaced or added."""
    return as_col(struct_col).withField(name, value)


def guarded(cond, fields: dict, types: dict) -> Column:
    """Struct of the values where ``cond`` holds, else a struct of typed nulls."""
    values = F.struct(*[as_col(c).cast(types[n]).alias(n) for n, c in fields.items()])
    nulls = F.struct(*[F.lit(None).cast(types[n]).alias(n) for n in fields])
    return F.when(cond, values).otherwise(nulls)


def field(struct_col, name: str) -> Column:
    """Field of a struct by name."""
    return as_col(struct_col).getField(name)
