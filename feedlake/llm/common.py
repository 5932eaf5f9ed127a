"""Helpers shared by the operators: shared staging folder, ASCII lower-casing."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master without that setting (tests) gets a scratch folder.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="feedlake-llm-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of repeating
    the work, and every later pass sees the same rows.  The files are scratch
    data of the run, below ``spark.checkpoint.dir``.  With ``partition_by`` a filter
    on that column reads only its rows' files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class StagedTable:
    """A staged table bucketed and sorted by ``key``: joins and groups by the key read it without a shuffle.

    ``deal`` sends the rows to one task a bucket first (one file each); without it
    every task writes the buckets it holds.  ``drop`` removes table and files.
    """

    def __init__(self, df: DataFrame, key: str, buckets: int | None = None, deal: bool = True):
        self.spark = df.sparkSession
        n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"llm_stage_{uuid.uuid4().hex}"
        self.path = f"{shared_dir(self.spark)}/llm/{self.name}"
        rows = df.repartition(n, key) if deal else df
        w = rows.write.option("path", self.path).option("compression", "zstd").bucketBy(n, key)
        (w.sortBy(key) if deal else w).saveAsTable(self.name)

    def df(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does this fast where a text is all ASCII;
    elsewhere it would also change other letters, so ``translate`` is used."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows to groups (one row a key, ``size`` rows each of ``total``) without a hot task.

    Fewer than 1,000 keys can hold more than a thousandth of all rows, so those
    groups are broadcast and their rows stay where they are; every other key is
    small and is joined by a shuffle as usual.  ``rows`` and ``groups`` are read
    more than once and should be staged.
    """
    large = F.col(size) * 1000 > F.lit(total)
    hot = F.broadcast(groups.where(large))
    rest = rows.join(F.broadcast(groups.where(large).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(groups.where(~large), key, how))


def join_hot_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """As ``join_groups``, with the keys of the large groups, fewer than 1,000, as a constant of the plan:
    without such a group this is one join, and the others pass no join but their own."""
    large = F.col(size) * 1000 > F.lit(total)
    hot = [r[0] for r in groups.where(large).select(key).collect()]
    if not hot:
        return rows.join(groups, key, how)
    of_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return rows.where(of_hot).join(F.broadcast(groups.where(large)), key).unionByName(rows.where(~of_hot).join(groups.where(~large), key, how))


GONE_ROWS = 2_000_000        # rows of an id and a hash (32 MB) that ``without`` broadcasts


def without(docs: DataFrame, gone: DataFrame, id_col: str, mark: Column) -> DataFrame:
    """``docs`` without the rows whose (id, ``mark``) is in staged ``gone`` (_gone, _gone_mark: long).

    Up to ``GONE_ROWS`` of these are broadcast, so that the documents do not move; more are joined by a shuffle.
    """
    own = f"_mark_{uuid.uuid4().hex}"         # a column, so that a text is hashed once and not in every comparison
    rows = docs.withColumn(own, mark)
    gone = F.broadcast(gone) if gone.count() <= GONE_ROWS else gone
    return rows.join(gone, rows[id_col].eqNullSafe(gone["_gone"]) & (rows[own] == gone["_gone_mark"]), "left_anti").drop(own)
