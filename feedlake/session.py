"""Session helpers.

Library code never creates its own session: every operator takes DataFrames
and the caller's session.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run wants, whatever the cluster size.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "feedlake") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
          .config("spark.driver.memory", os.environ.get("FEEDLAKE_DRIVER_MEMORY", "16g"))
          .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="feedlake-wh-"))
          .config("spark.driver.extraJavaOptions", "-Dderby.system.home=" + tempfile.mkdtemp(prefix="feedlake-derby-")))
    # Local runs only: a scratch folder stands in for the cluster's shared one.
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="feedlake-ckpt-"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the platform and is read from the
    session.  Only when it is unset (local tests) is a scratch folder chosen.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: configure the cluster's shared "
                               "checkpoint folder; a machine-local folder would not survive executor loss")
        current = tempfile.mkdtemp(prefix="feedlake-ckpt-")   # local runs only
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return spark.sparkContext.getCheckpointDir() or current


def stage(df, name: str, bucket_by: str | None = None, buckets: int | None = None):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage of a frame that several sinks consume, so a lost executor
    re-reads the staged files instead of recomputing the whole plan.  With
    ``bucket_by`` the rows are dealt by that key first and written as a table
    with one sorted file per bucket, so later joins on the key read it co-located
    instead of shuffling the staged rows again.  ``unstage`` removes it.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    if not bucket_by:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, bucket_by).write.mode("overwrite").option("path", path)
       .bucketBy(n, bucket_by).sortBy(bucket_by).saveAsTable(_stage_table(name)))
    return spark.table(_stage_table(name))


def staged(spark: SparkSession, name: str):
    """The bucketed frame staged under ``name``, if its table is still there."""
    return spark.table(_stage_table(name)) if spark.catalog.tableExists(_stage_table(name)) else None


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage/{name}"


def _stage_table(name: str) -> str:
    return "stage_" + "".join(ch if ch.isalnum() else "_" for ch in name)


def unstage(spark: SparkSession, name: str, path: str) -> None:
    """Drop a staged table and delete its files; frames that read them are void."""
    spark.sql(f"DROP TABLE IF EXISTS {_stage_table(name)}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
