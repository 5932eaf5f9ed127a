"""The journal of runs: which steps of a run are done.

A step is one idempotent ``append`` to the journal table, made after the step's own
commit.  A run that died is started again under the same run id: done steps are
passed over, the others repeated, which for keyed upserts gives the same rows.  A
finished run counts as an attempt; the same id then starts anew.  One run id is
run by one process at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedlake.sources.sinks import append

FINISHED = "finished"
KIND = "run_id string, attempt long, step string, n_rows long"


class Journal:
    """Steps of one attempt of a run."""

    def __init__(self, spark: SparkSession, table: str, run_id: str):
        self.spark, self.table, self.run_id = spark, table, run_id
        rows = []
        if spark.catalog.tableExists(table):
            rows = spark.table(table).where(F.col("run_id") == run_id).collect()       # a few rows an attempt
        self.attempt = 1 + sum(r["step"] == FINISHED for r in rows)
        self.rows = {r["step"]: r["n_rows"] for r in rows if r["attempt"] == self.attempt}

    def done(self, step: str) -> bool:
        return step in self.rows

    def mark(self, step: str, n_rows: int | None = None) -> None:
        line = self.spark.createDataFrame([(self.run_id, self.attempt, step, n_rows)], KIND).coalesce(1)
        append(line, self.table, f"{self.run_id}/{self.attempt}/{step}")
        self.rows[step] = n_rows

    def once(self, step: str, action: Callable[[], int | None]) -> None:
        """Do a step unless it is done; what it returns is noted as its number of rows."""
        if not self.done(step):
            self.mark(step, action())
