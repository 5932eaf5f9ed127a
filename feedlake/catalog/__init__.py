"""Registered queries: each is a Spark plan built from the library's operators
plus an independent ANSI SQL statement (run by DuckDB in the correctness
check) that computes the same answer straight from the flat tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Run parameters (P17, F14): fixed per run, never read from the clock.
RUN_DATE = "2025-02-18"
RUN_TS = "2025-02-18 00:00:00"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its SQL oracle."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it lies on disk; its layout sets the number of tasks."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str):
    return [table(spark, sf_dir, n) for n in names]


def sql_round(expr: str, digits: int = 2) -> str:
    """DuckDB spelling of Spark's ``round`` on a double: Spark rounds the
    shortest decimal text of the double half-up, DuckDB's double round works
    on the binary value; rounding through DECIMAL(38,10) agrees with Spark."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def sql_row_key(*exprs: str) -> str:
    """DuckDB spelling of ``row_key``: every part with its length, or a null mark."""
    parts = [f"coalesce(CAST(length({e}) AS VARCHAR) || ':' || ({e}), 'null')" for e in (f"CAST({x} AS VARCHAR)" for x in exprs)]
    return f"sha256(concat_ws(',', {', '.join(parts)}))"


def sql_initcap(expr: str) -> str:
    """DuckDB spelling of Spark's ``initcap``: lower-case, then upper-case the
    first letter after each space."""
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(w[1:1]) || w[2:]), ' ')")


def load_all() -> None:
    """Import the modules that register queries."""
    from feedlake.catalog import relational, domain, whole_run  # noqa: F401
