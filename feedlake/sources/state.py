"""Curated-state access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.operators.joins import restrict_to
from feedlake.sources.feeds import empty_like
from feedlake.sources.snapshots import current_name


def read_if_exists(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The curated table's ``schema`` columns when the table exists, else an
    empty frame of ``schema`` (S2).  Joining to the empty frame yields typed
    nulls, so the downstream plan is the same in both cases; missing columns
    of an existing table are added as typed nulls.  Reading changes nothing, and
    the frame keeps the version that was current when it was made."""
    name = current_name(spark, table)
    if name:
        t = spark.table(name)
        have = set(t.columns)
        return t.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in schema.fields])
    return empty_like(spark, schema)


def state_for_keys(state: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """State restricted to the batch's keys (S3): a left-semi join; no id list
    is collected to the driver."""
    return restrict_to(state, keys, key)
