"""Curated tables as snapshots: new files, then one pointer change.

A curated table ``t`` is a view.  ``t__v00000007`` is a view too, on the external
table ``t__s_<writer>`` that one writer filled under a name of its own.  A commit is
``CREATE VIEW t__v<n + 1>``, which the catalog lets one writer do and which makes the
complete snapshot visible at once; then ``t`` is replaced by a view on it.  A writer
that finds its version taken merges again, on top of the version that took it.  A
writer that dies leaves either nothing that a reader sees or a whole version.

Readers take the highest version (``current_name``) and change nothing.  Snapshots
never change, so a reader keeps its rows while others commit.  A partitioned snapshot
holds the partitions that its writer touched and names the folders of the others.
``expire`` drops old versions and the files that no kept one names.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEEP = 3                 # versions that ``expire`` keeps
ADD_AT_ONCE = 100        # partitions named in one statement
RETIRED = "feedlake.retired"


class Conflict(Exception):
    """Another writer took the version."""


def split_name(table: str) -> tuple[str, str]:
    """(namespace with its dot, name without quotes)."""
    head, _, name = table.rpartition(".")
    return f"{head}." if head else "", name.strip("`")


def version_name(table: str, number: int) -> str:
    head, name = split_name(table)
    return f"{head}{name}__v{number:08d}"


def versions(spark: SparkSession, table: str) -> list[int]:
    """The committed versions, ascending."""
    head, name = split_name(table)
    where = f" IN {head[:-1]}" if head else ""
    found = spark.sql(f"SHOW TABLES{where} LIKE '{name.lower()}__v*'").collect()
    pattern = re.compile(re.escape(name.lower()) + r"__v(\d{8})")
    return sorted(int(m[1]) for r in found if (m := pattern.fullmatch(r["tableName"].lower())))


def current_name(spark: SparkSession, table: str) -> str | None:
    """The name to read the current rows by: the highest version, else the table itself if there is one."""
    known = _known(spark, table)
    if known:
        return version_name(table, known[-1])
    return table if spark.catalog.tableExists(table) else None


def _known(spark: SparkSession, table: str) -> list[int]:
    try:
        return versions(spark, table)
    except AnalysisException as e:
        if e.getCondition() == "SCHEMA_NOT_FOUND":
            return []
        raise


def is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "VIEW"


def data_root(spark: SparkSession, table: str) -> str:
    """The folder of the table's files, in its database's location (the shared warehouse)."""
    head, name = split_name(table)
    db = spark.catalog.getDatabase(head[:-1] if head else spark.catalog.currentDatabase())
    return f"{db.locationUri.rstrip('/')}/{name}__data"


def _snapshot_of(spark: SparkSession, table: str, number: int) -> str:
    """The external table behind a version: its name is the version's comment."""
    return spark.catalog.getTable(version_name(table, number)).description


def _partitions(spark: SparkSession, snapshot: str) -> list[str]:
    return [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {snapshot}").collect()]


def partition_columns(spark: SparkSession, snapshot: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(snapshot) if c.isPartition]


def _spec(partition: str, schema: T.StructType) -> str:
    """``a=x/b=1``, as SHOW PARTITIONS escapes it, as the specification of SQL statements."""
    out = []
    for part in partition.split("/"):
        name, _, value = part.partition("=")
        value = re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)
        kind = schema[name].dataType.simpleString()
        quoted = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        out.append(f"`{name}` = " + ("NULL" if value == "__HIVE_DEFAULT_PARTITION__" else quoted if kind == "string" else f"CAST({quoted} AS {kind})"))
    return ", ".join(out)


def _location(spark: SparkSession, snapshot: str, spec: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {snapshot} PARTITION ({spec})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def bucketing(spark: SparkSession, table: str, number: int | None) -> tuple[int, list[str]] | None:
    """(buckets, their columns) of a version, if it has any."""
    if number is None:
        return None
    said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_snapshot_of(spark, table, number)}").collect()}
    count = int(said.get("Num Buckets") or 0)
    return (count, re.findall("`([^`]+)`", said["Bucket Columns"])) if count > 0 else None


def write_snapshot(rows: DataFrame, table: str, partition_by: list[str], base: int | None,
                   buckets: tuple[int, list[str]] | None = None) -> str:
    """Write ``rows`` under a name of this writer; with partitions, name those of ``base`` that they do not hold.
    With ``buckets`` (number, columns) the rows are dealt by these columns and each file is sorted."""
    spark = rows.sparkSession
    head, name = split_name(table)
    if partition_by and base is not None and partition_columns(spark, _snapshot_of(spark, table, base)) != partition_by:
        raise ValueError(f"{table} is not partitioned by {partition_by}")
    own = f"{name}__s_{uuid.uuid4().hex}"
    snapshot = head + own
    if buckets and partition_by:
        raise ValueError("a table has partitions or buckets, not both")
    if buckets:
        writer = rows.repartition(buckets[0], *buckets[1]).write.bucketBy(buckets[0], *buckets[1]).sortBy(*buckets[1])
    else:
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
    writer.option("path", f"{data_root(spark, table)}/{own}").saveAsTable(snapshot)
    if partition_by and base is not None:
        old, schema = _snapshot_of(spark, table, base), spark.table(snapshot).schema
        written = set(_partitions(spark, snapshot))
        kept = [_spec(p, schema) for p in _partitions(spark, old) if p not in written]
        for k in range(0, len(kept), ADD_AT_ONCE):
            spark.sql(f"ALTER TABLE {snapshot} ADD " + " ".join(
                f"PARTITION ({s}) LOCATION '{_location(spark, old, s)}'" for s in kept[k:k + ADD_AT_ONCE]))
    return snapshot


def commit(spark: SparkSession, table: str, snapshot: str, number: int) -> None:
    """Make ``snapshot`` the version ``number`` and point the table to the highest version."""
    try:
        spark.sql(f"CREATE VIEW {version_name(table, number)} COMMENT '{snapshot}' AS SELECT * FROM {snapshot}")
    except AnalysisException as e:
        if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
            raise
        raise Conflict(f"version {number} of {table} was committed by another writer") from e
    point(spark, table)


def point(spark: SparkSession, table: str) -> None:
    """Let the table's name show the highest version; a commit in between is seen by looking again."""
    if spark.catalog.tableExists(table) and not is_view(spark, table):
        head, name = split_name(table)
        spark.sql(f"ALTER TABLE {table} RENAME TO {head}{name}__adopted")
    shown = None
    while shown != (newest := versions(spark, table)[-1]):
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version_name(table, newest)}")
        shown = newest


def adopt(spark: SparkSession, table: str, partition_by: list[str]) -> None:
    """Copy an existing plain table to version 1; the table stays as ``<table>__adopted``.

    Readers by ``current_name`` see no gap.  The name itself is missing for the moment between two
    statements, once; where others read it, call this ahead of the first ``upsert``.
    """
    if is_view(spark, table):
        raise ValueError(f"{table} is a view of someone else's; an upsert keeps its own")
    commit(spark, table, write_snapshot(spark.table(table), table, partition_by, None), 1)


def discard(spark: SparkSession, table: str, snapshot: str) -> None:
    """Drop a snapshot that no version names, with its own files."""
    own = split_name(snapshot)[1]
    spark.sql(f"DROP TABLE IF EXISTS {snapshot}")
    delete_folder(spark, f"{data_root(spark, table)}/{own}")


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def expire(spark: SparkSession, table: str, keep: int = KEEP) -> list[int]:
    """Drop all but the ``keep`` newest versions, and the files that no kept one names.

    A reader of a dropped version fails, so ``keep`` covers the longest job.  A snapshot
    whose files are still named by a kept version is marked and goes in a later call;
    what a running writer has not committed is not touched.
    """
    known = versions(spark, table)
    for n in known[:-keep]:
        snapshot = _snapshot_of(spark, table, n)
        spark.sql(f"DROP VIEW IF EXISTS {version_name(table, n)}")
        spark.sql(f"ALTER TABLE {snapshot} SET TBLPROPERTIES ('{RETIRED}' = 'true')")
    used = set()
    for n in known[-keep:]:
        snapshot = _snapshot_of(spark, table, n)
        if partition_columns(spark, snapshot):
            schema = spark.table(snapshot).schema
            used |= {m[1].lower() for p in _partitions(spark, snapshot)
                     if (m := re.search(r"__data/([^/]+__s_[0-9a-f]{32})/", _location(spark, snapshot, _spec(p, schema))))}
    head, name = split_name(table)
    for r in spark.sql(f"SHOW TABLES{' IN ' + head[:-1] if head else ''} LIKE '{name.lower()}__s_*'").collect():
        snapshot = head + r["tableName"]
        marked = any(p["key"] == RETIRED for p in spark.sql(f"SHOW TBLPROPERTIES {snapshot}").collect())
        if marked and r["tableName"].lower() not in used:
            discard(spark, table, snapshot)
    return known[:-keep]


def drop(spark: SparkSession, table: str) -> None:
    """Remove a table of snapshots: its name, its versions, all its snapshots and files."""
    head, name = split_name(table)
    for n in _known(spark, table):
        spark.sql(f"DROP VIEW IF EXISTS {version_name(table, n)}")
    for r in spark.sql(f"SHOW TABLES{' IN ' + head[:-1] if head else ''} LIKE '{name.lower()}__s_*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {head}{r['tableName']}")
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP {'VIEW' if is_view(spark, table) else 'TABLE'} IF EXISTS {table}")
    delete_folder(spark, data_root(spark, table))


def merged_schema(have: T.StructType, new: T.StructType, what: str) -> list[str]:
    """Columns of ``new`` that ``have`` lacks.  A column that is missing in ``new`` or has another type there is an error."""
    old, given = {f.name: f.dataType for f in have}, {f.name: f.dataType for f in new}
    dropped = [c for c in old if c not in given]
    retyped = [f"{c} {old[c].simpleString()} -> {given[c].simpleString()}" for c in old
               if c in given and not _same_type(old[c], given[c])]
    if dropped or retyped:
        raise ValueError(f"{what}: columns dropped {dropped}, retyped {retyped}; only new columns are taken up")
    return [c for c in given if c not in old]


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability."""
    return a.simpleString() == b.simpleString()
