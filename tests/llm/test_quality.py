"""The quality classifier: held-out accuracy, label hygiene, awkward rows."""

import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from feedlake.llm import quality
from tests.conftest import SF_CHECK
from tests.llm.cases import documents, empty, texts


def tables(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet"), spark.read.parquet(f"{SF_CHECK}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    scored = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 50
    right = sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in scored)
    assert right >= 0.95 * len(scored)
    good = [r["score"] for r in scored if r["quality"] == 1]
    bad = [r["score"] for r in scored if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = tables(spark)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    moved = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    b = {r["doc_id"]: r["score"] for r in quality.score(moved, quality.fit(moved, flipped)).collect()}
    assert a == b
    held = {r["doc_id"]: r["held_out"] for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items())


def test_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(3 * i + 1, None if i % 9 == 0 else i % 2, "clash") for i in range(120)] * 2 + [(4, 0, "x"), (None, 1, "x")],
                                   "doc_id long, quality int, text string")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    by_text = {}
    for r, t in zip(sorted(quality.score(documents(spark, repeat_rows=False), model).collect()), texts(), strict=True):
        by_text.setdefault(t or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())           # equal texts, equal scores; null as empty
    assert quality.score(empty(spark), model).count() == 0
    none = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    kept = quality.keep_good(docs, model, least=0.0)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_fit_is_bounded(spark):
    docs, labels = tables(spark)
    few = quality.fit(docs, labels, max_rows=40)
    assert 0 < len(np.flatnonzero(few.part)) < len(np.flatnonzero(quality.fit(docs, labels).part))


def test_fit_holds_the_features_once():
    """The driver's memory: four bytes a feature of the sample, besides a few vectors of DIMS numbers."""
    draw = np.random.default_rng(3)
    pool = np.array([f"w{i}" for i in range(200_000)])
    sample = [" ".join(draw.choice(pool, 2500)).encode() for _ in range(1600)]
    labels = np.arange(len(sample)) % 2
    count = sum(len(quality.features([t])[0]) for t in sample)
    assert count > 3_500_000
    tracemalloc.start()
    try:
        model = quality.Model(sample, labels).close()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.constant is None and peak < 4 * count + 8 * 8 * quality.DIMS


def test_log_ratios_count_texts():
    sets = [np.array([1, 5, 9], dtype=np.int32), np.array([5], dtype=np.int32), np.array([], dtype=np.int32), np.array([5, 9], dtype=np.int32)]
    got = quality._log_ratios(sets, np.array([1.0, 1.0, -1.0, -1.0]))
    good, bad = quality.DIMS + 4, quality.DIMS + 2
    for feature, a, b in ((1, 2, 1), (5, 3, 2), (9, 2, 2), (7, 1, 1)):
        assert np.isclose(got[feature], np.log(a / good) - np.log(b / bad))
