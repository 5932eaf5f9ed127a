"""Sinks (S7-S10)."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.aggregates import dedupe
from feedlake.sources import snapshots as S

ATTEMPTS = 20            # times that an upsert merges again after a concurrent commit


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def merge_by_key(existing: DataFrame, changes: DataFrame, keys, order=None) -> DataFrame:
    """Keyed insert-or-update as a frame (S7 core): rows of ``changes`` replace
    rows of ``existing`` with the same key, new keys are added, and each key
    occurs once.  ``changes`` is de-duplicated first (greatest ``order`` wins).
    A null key part matches a null key part.  New columns of ``changes`` are added
    and null in the rows that stay; a column that it lacks or retypes is an error."""
    keys = _keys(keys)
    added = S.merged_schema(existing.schema, changes.schema, "changes")
    changes = dedupe(changes, keys, order)
    ck = changes.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    cond = None
    for k in keys:
        c = existing[k].eqNullSafe(ck[f"_k_{k}"])
        cond = c if cond is None else cond & c
    kept = existing.join(ck, cond, "left_anti")
    return kept.unionByName(changes.select(*existing.columns, *added), allowMissingColumns=True)


def merge_condition(table: str, keys) -> Column:
    """Null-safe key equality of a MERGE: the target by its table name, the source as ``s``."""
    name = table.split(".")[-1].strip("`")
    return F.expr(" AND ".join(f"`{name}`.`{k}` <=> s.`{k}`" for k in _keys(keys)))


def merge_into(df: DataFrame, table: str, keys, order=None) -> None:
    """Row-level ``MERGE INTO`` of ``df``; any error of the catalog surfaces.  New
    columns go to the table with the catalog's schema evolution."""
    added = S.merged_schema(df.sparkSession.table(table).schema, df.schema, table)
    merge = dedupe(df, _keys(keys), order).alias("s").mergeInto(table, merge_condition(table, keys))
    merge = merge.whenMatched().updateAll().whenNotMatched().insertAll()
    (merge.withSchemaEvolution() if added else merge).merge()


def supports_merge(spark: SparkSession, table: str) -> bool:
    """Whether the table's catalog declares row-level operations for it."""
    leaf = spark.table(table)._jdf.queryExecution().analyzed().collectLeaves().head()
    if not leaf.getClass().getSimpleName().startswith("DataSourceV2Relation"):
        return False
    kinds = spark.sparkContext._jvm.java.lang.Class.forName(
        "org.apache.spark.sql.connector.catalog.SupportsRowLevelOperations")
    return kinds.isInstance(leaf.table())


def _merged(df: DataFrame, table: str, base: int | None, keys: list[str], order, parts: list[str]) -> DataFrame:
    """The rows of the next version: all, or those of the partitions that ``df`` touches."""
    if base is None:
        return dedupe(df, keys, order)
    existing = df.sparkSession.table(S.version_name(table, base))
    if parts:
        touched = df.select(*[F.col(p).alias(f"_p_{p}") for p in parts]).distinct()
        cond = None
        for p in parts:
            c = existing[p].eqNullSafe(touched[f"_p_{p}"])
            cond = c if cond is None else cond & c
        existing = existing.join(touched, cond, "left_semi")
    return merge_by_key(existing, df, keys, order)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that the job which writes it gathers on the way (A10):
    ``observation.get["n_rows"]`` after the write, without a job of its own."""
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def upsert(df: DataFrame, table: str, keys, order=None, partition_by=None, buckets: int | None = None) -> int | None:
    """Keyed upsert into a catalog table (S7); returns the rows written, where they were counted on the way.

    Tables whose catalog declares row-level operations take a ``MERGE INTO``.
    Others are kept as snapshots (``snapshots``): the merged rows are written under
    a name of this writer and one pointer change shows them, so readers see the
    rows before or after and never a gap, and a writer that dies changes nothing.
    If another writer committed in the meantime, the merge is done again on top of
    its version.  With ``partition_by`` (columns of the key, so a key never moves)
    only the partitions that ``df`` touches are read and written.  With ``buckets``
    every version is dealt into that many files by the key (as the version before,
    if not given), so later joins by the key, state lookups above all (S3, J1, J14),
    read it without an exchange.
    """
    spark = df.sparkSession
    keys, parts = _keys(keys), list(partition_by or [])
    if not set(parts) <= set(keys):
        raise ValueError(f"partition columns {parts} must belong to the key {keys}")
    if S.current_name(spark, table) == table:
        if supports_merge(spark, table):
            merge_into(df, table, keys, order)
            return None
        S.adopt(spark, table, parts)
    for _ in range(ATTEMPTS):
        known = S.versions(spark, table)
        base = known[-1] if known else None
        rows, seen = counted(_merged(df, table, base, keys, order, parts))
        snapshot = S.write_snapshot(rows, table, parts, base, (buckets, keys) if buckets else S.bucketing(spark, table, base))
        try:
            S.commit(spark, table, snapshot, (base or 0) + 1)
            return seen.get["n_rows"]
        except S.Conflict:
            S.discard(spark, table, snapshot)
    raise S.Conflict(f"{table}: {ATTEMPTS} merges in a row met a concurrent commit")


def append(df: DataFrame, table: str, batch: str) -> bool:
    """Append the rows of one batch to a catalog table, once.

    The table is partitioned by ``batch_id``.  A batch is written to a folder of its
    writer's own, and adding its partition, which the catalog does once, shows it as
    a whole; a retry or a second writer of the batch adds nothing and gets False.
    Tables of catalogs with row-level operations overwrite the batch's rows instead.
    New columns are added to the table; dropped or retyped ones are an error.
    """
    spark = df.sparkSession
    if not re.fullmatch(r"[\w .:/+-]+", batch):
        raise ValueError(f"a batch is named by letters, digits and . : / + - only, not {batch!r}")
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], df.schema).withColumn("batch_id", F.lit(batch))
        empty.write.mode("ignore").partitionBy("batch_id").saveAsTable(table)
    have = spark.table(table).schema
    if "batch_id" not in have.names:
        raise ValueError(f"{table} has no column batch_id; append keeps its ledger there")
    added = S.merged_schema(have, df.withColumn("batch_id", F.lit(batch)).schema, table)
    if supports_merge(spark, table):
        df.withColumn("batch_id", F.lit(batch)).writeTo(table).overwrite(F.col("batch_id") == batch)
        return True
    spec = f"batch_id = '{batch}'"
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").count():
        return False
    if added:
        kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({kinds})")
    folder = f"{S.data_root(spark, table)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    try:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION '{folder}'")
        return True
    except AnalysisException as e:
        S.delete_folder(spark, folder)
        if e.getCondition() != "PARTITIONS_ALREADY_EXIST":
            raise
        return False


def write_worklist(df: DataFrame, path: str) -> None:
    """The ids still missing a location, as CSV with a header (S9).  Written by
    the executors; nothing is collected to the driver."""
    df.write.mode("overwrite").option("header", True).csv(path)


def sample(df: DataFrame, n: int, order) -> DataFrame:
    """A deterministic cap for debug runs (S10): the first ``n`` rows by
    ``order`` (a per-partition top-n, then one merge)."""
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*order).limit(n)
