"""The registered queries' columns and the pipeline against brute force."""

import re
from collections import Counter

import pytest

from tests.conftest import SF_SMALL
from tests.llm.test_near import brute
from tests.oracle_check import compare, duck

CONTRACT = {
    "op1": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op4": "page_id bigint, host string, path string, rule string, verdict string",
    "op5": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op6": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op7": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op8": "page_id bigint, url string, text string, n_chars bigint",
    "op9": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op10": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op11": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
            "repaired_sha256 string",
    "op12": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op13": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}
TABLE = {"op4": "pages", "op8": "pages", "op11": "conversations", "op12": "embeddings"}


@pytest.mark.parametrize("op", CONTRACT)
def test_contract(spark, op):
    from feedlake.llm.queries import ORACLE, QUERIES
    name = next(n for n in QUERIES if n.startswith(op + "_"))
    df = QUERIES[name](spark, SF_SMALL)
    want = [tuple(c.split(" ")) for c in CONTRACT[op].split(", ")]
    assert df.dtypes[:len(want)] == want
    table = spark.read.parquet(f"{SF_SMALL}/{TABLE.get(op, 'documents')}.parquet")
    rows = table.select("conv_id").distinct().count() if op == "op11" else table.count()
    assert df.count() == rows or op == "op7" and df.select("doc_id").distinct().count() == rows
    if name in ORACLE:
        ok, said = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
        assert ok, said


def test_registered(spark):
    from __spark_entry__ import queries
    names = list(queries())
    assert "pipeline" in names and all(sum(n.startswith(f"{op}_") for n in names) == 1 for op in CONTRACT)


def test_native_operators_run_no_python(spark):
    from feedlake.llm.queries import QUERIES
    for name, query in QUERIES.items():
        if name.split("_")[0] in ("op1", "op4", "op5", "op6"):
            plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan), name


def test_stages(spark):
    import corpus_pipeline
    from feedlake.llm import quality
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    want = {r["doc_id"]: tuple(r) for r in docs.collect()}
    text = docs.columns.index("text")
    good = {r["doc_id"] for r in quality.score(docs, quality.fit(docs, labels)).collect() if r["score"] >= 0.3}
    left = {i for i in want if i in good}
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in bench.collect():
        w = word.findall(low(r["text"]))
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()

    def after(name, rows):
        if name == "exact_dedup":
            last = {}
            for i in sorted(rows):
                last[low(want[i][text])] = i
            return set(last.values())
        if name == "near_dedup":
            return {k[0] for k in brute([(i, want[i][text]) for i in rows], 5, 80) if k[3]}
        if name == "decontamination":
            def hit(i):
                w = word.findall(low(want[i][text]))
                return any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
            return {i for i in rows if not hit(i)}
        return rows

    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        got = docs.collect()
        if name == "packing":
            assert {r["doc_id"] for r in got} == left
            assert sum(r["length"] for r in got) == sum({r["doc_id"]: r["doc_tokens"] for r in got}.values())
        else:
            assert docs.columns == list(spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns)
            left = after(name, left)
            assert Counter(map(tuple, got)) == Counter(want[i] for i in left), name
            docs = spark.createDataFrame(got, docs.schema)
            sizes.append(len(left))
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == 4        # every stage takes rows out
    run = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in run} == left
