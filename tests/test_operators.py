"""Properties of the relational operators."""

from pyspark.sql import functions as F

from feedlake import rules
from feedlake.operators import (
    dedupe, explode_path, lookup_elements, lookup_left, fan_out, row_counts,
)
from feedlake.sources import merge_by_key, upsert
from tests.conftest import SF_SMALL


def test_dedupe_unique_and_latest(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = dedupe(ev, "user_id", ["ts", "event_id"])
    assert out.count() == out.select("user_id").distinct().count() == ev.select("user_id").distinct().count()
    latest = ev.groupBy("user_id").agg(F.max("ts").alias("ts"))
    assert out.join(latest, ["user_id", "ts"], "left_anti").count() == 0


def test_left_lookup_keeps_rows(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    n = spark.read.parquet(f"{SF_SMALL}/nation.parquet").withColumnRenamed("n_nationkey", "c_nationkey")
    assert lookup_left(c, n.filter(F.col("c_nationkey") < 10), "c_nationkey").count() == c.count()


def test_parameter_lookups_are_bounded(spark):
    import pytest
    from feedlake.functions import literal_map
    from feedlake.sources import parameter_frame
    plan = spark.range(100).join(parameter_frame(spark, [(1,)], "id long"), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()
    with pytest.raises(ValueError):
        parameter_frame(spark, [(i,) for i in range(10_001)], "id long")
    with pytest.raises(ValueError):
        literal_map({i: i for i in range(1001)})


def test_upsert_frame_idempotent(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_acctbal")
    changes = c.filter(F.col("c_acctbal") > 5000).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    once = merge_by_key(c, changes, "c_custkey")
    twice = merge_by_key(once, changes, "c_custkey")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == once.select("c_custkey").distinct().count() == c.count()


def test_upsert_table_twice_equals_once(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_acctbal")
    t = _fresh(spark, "t_upsert_prop")
    upsert(c, t, "c_custkey")
    changes = c.filter(F.col("c_acctbal") > 5000).withColumn("c_acctbal", F.lit(0.0))
    upsert(changes, t, "c_custkey")
    first = sorted(spark.table(t).collect())
    upsert(changes, t, "c_custkey")
    assert sorted(spark.table(t).collect()) == first
    assert len(first) == c.count()


def test_lookup_elements_paths_agree(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.split(F.lower("text"), r"\s+").alias("words"))
    syn = spark.createDataFrame([(k, c) for k, v in rules.WORD_SYNONYMS.items()
                                 for c in (v if isinstance(v, list) else [v])], "word string, cat string")
    a = lookup_elements(docs, "doc_id", "words", rules.WORD_SYNONYMS, "cats", flatten_values=True)
    b = lookup_elements(docs, "doc_id", "words", syn, "cats", dim_key="word", value="cat")
    norm = lambda df: sorted((r[0], tuple(sorted(r[1] or []))) for r in df.select("doc_id", "cats").collect())
    assert norm(a) == norm(b)


def test_explode_path_matches_chained_explode(spark):
    df = spark.createDataFrame([(1, [[[1, 2], [3]], [[4]]]), (2, []), (3, None)], "id int, a array<array<array<int>>>")
    df = df.select("id", F.transform("a", lambda x: F.struct(F.transform(x, lambda y: F.struct(y.alias("c"))).alias("b"))).alias("a"))
    out = explode_path(df, ["a", "b", "c"], "leaf")
    assert sorted((r["id"], r["leaf"]) for r in out.collect()) == [(1, 1), (1, 2), (1, 3), (1, 4)]


def test_fan_out_and_counts(spark):
    n = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    assert fan_out(n, rules.LANGUAGES).count() == 4 * n.count()
    rc = {r["table_name"]: (r["n_rows"], r["is_empty"]) for r in row_counts({"n": n, "e": n.limit(0)}).collect()}
    assert rc == {"n": (n.count(), False), "e": (0, True)}


def test_independent_of_shuffle_partitions(spark):
    from __spark_entry__ import queries
    q = queries()["q_child_rollup"]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = sorted(q(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    b = sorted(q(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_append_and_worklist_sinks(spark, tmp_path):
    from feedlake.sources import append, write_worklist
    t = "t_append_prop"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    df = spark.range(5).withColumnRenamed("id", "k")
    assert append(df, t, "day/1") and append(df, t, "day/2")
    assert spark.table(t).count() == 10
    write_worklist(df, str(tmp_path / "wl"))
    assert spark.read.option("header", True).csv(str(tmp_path / "wl")).count() == 5


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the rows: dedupe, first-by-order and rollups stay
    exact, and every aggregate runs with a partial (map-side) phase."""
    from feedlake.operators import first_non_null, rollup_children
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    d = dedupe(hot, "user_id", ["ts", "event_id"])
    want = hot.filter(F.col("user_id") == -1).orderBy(F.col("ts").desc(), F.col("event_id").desc()).first()
    got = d.filter(F.col("user_id") == -1).first()
    assert got["event_id"] == want["event_id"]
    r = rollup_children(hot, "user_id", sums=["value"], counts="n")
    assert r.filter(F.col("user_id") == -1).first()["n"] == hot.filter(F.col("user_id") == -1).count()
    f = hot.groupBy("user_id").agg(first_non_null("event_id", ["ts", "event_id"]).alias("first_event"))
    for df in (d, r, f):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan


def test_read_feed_and_empty_like(spark, tmp_path):
    from feedlake import schemas
    from feedlake.sources import empty_like, read_feed, read_if_exists
    e = empty_like(spark, schemas.LOCATION)
    assert e.count() == 0 and e.schema == schemas.LOCATION
    assert read_if_exists(spark, "no_such_table_xyz", schemas.LOCATION).schema == schemas.LOCATION
    doc = '[{"id": 1, "name": "a", "brands": [{"id": 7, "name": "b"}]},\n {"id": 2, "name": "c", "brands": []}]'
    (tmp_path / "chains.json").write_text(doc)
    rows = read_feed(spark, str(tmp_path), schemas.CHAINS).orderBy("id").collect()
    assert [(r["id"], len(r["brands"])) for r in rows] == [(1, 1), (2, 0)]


def test_dedupe_is_total(spark):
    """Without an order the survivor depends on the rows alone, not on their layout."""
    rows = [(i % 7, f"v{i}", {"k": str(i)}) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v string, m map<string,string>")
    a = sorted(map(str, dedupe(df.repartition(5), "k").collect()))
    b = sorted(map(str, dedupe(df.orderBy(F.rand(3)).repartition(3), "k").collect()))
    assert a == b and len(a) == 7


def test_dedupe_fetches_whole_rows_late(spark, tmp_path):
    """Winners by narrow columns: the same survivors, whole rows neither sorted nor turned into text."""
    from feedlake.operators import LOCATOR, located
    rows = [(None if i % 9 == 8 else i % 7, i % 5, f"v{i % 3}", {"b": i % 2, "a": None}, [{"x": "y"}]) for i in range(300)]
    kind = "k int, o int, v string, m map<string,int>, l array<map<string,string>>"
    spark.createDataFrame(rows, kind).repartition(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for keys, order, keep in (("k", "o", "last"), (["k", "o"], None, "first"), ("k", None, "last")):
        late = dedupe(located(df), keys, order, keep, locator=LOCATOR)
        assert late.columns == dedupe(df, keys, order, keep).columns
        assert sorted(map(str, late.collect())) == sorted(map(str, dedupe(df, keys, order, keep).collect()))
    plan = dedupe(located(df), "k", "o", locator=LOCATOR)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "to_json" not in plan and "SortMergeJoin" not in plan
    import re
    for node in re.findall(r"SortAggregate\(.*", plan):
        assert "map_entries" not in node and "m#" not in node, node           # what is sorted holds the hash only


def test_row_hash_sees_every_value(spark):
    from feedlake.operators import row_hash
    rows = [(1, {"a": 1, "b": 2}, [None]), (1, {"b": 2, "a": 1}, [None]), (1, {"a": 1}, [None]), (1, None, None), (1, {"a": 1, "b": 2}, [("x", {"k": 1})]),
            (1, {"a": 1, "b": 2}, [("x", {"k": 2})])]
    df = spark.createDataFrame(rows, "i int, m map<string,int>, l array<struct<s:string,m:map<string,int>>>")
    h = [r[0] for r in df.select(row_hash(df, df.columns)).collect()]
    assert h[0] == h[1] and len(set(h)) == 5


def test_lookup_of_many_keys(spark):
    """A literal lookup gives what a dict gives, at any number of keys, for texts, integers and lists."""
    import pytest
    from feedlake.functions import literal_lookup, map_lookup
    for n in (3, 17, 2000, 100_000):
        names = {f"k{i} é'\"\\": (f"v{i}\n" if i % 3 else None) for i in range(n)}
        df = spark.range(50).select(F.concat(F.lit("k"), (F.col("id") * 41 % (2 * n)).cast("string"), F.lit(" é'\"\\")).alias("k"))
        df = df.unionByName(spark.createDataFrame([(None,), ("",)], "k string"))
        got = df.select("k", literal_lookup(names)(F.col("k")).alias("v"))
        assert all(r["v"] == names.get(r["k"]) for r in got.collect())
        assert "from_json" not in got._jdf.queryExecution().optimizedPlan().toString()      # one constant
    numbers = {i: [i, -i] for i in range(5000)}
    got = spark.range(1).select(map_lookup(F.array(F.lit(7), F.lit(-1), F.lit(None).cast("int"), F.lit(4999)), numbers, key_type=None)).first()[0]
    assert got == [[7, -7], [4999, -4999]]
    assert dict(spark.range(1).select(literal_lookup({f"{i}": 1.5 for i in range(40)})(F.lit("7")).alias("x")).dtypes) == {"x": "double"}
    with pytest.raises(ValueError):
        literal_lookup({i: i for i in range(200_001)})
    with pytest.raises(TypeError):
        literal_lookup({i: "a" if i else 1 for i in range(40)})


def test_keywords_in_one_pass(spark):
    import random
    from feedlake.functions import contains_any, keyword_lists_found
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("ab c.é*") for _ in range(n))
    texts = [word(draw.randrange(40)) for _ in range(200)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for lists in ([[word(draw.randrange(1, 5)) for _ in range(draw.randrange(9))] for _ in range(7)], [["a"], []], [[]], [["", "zz"], ["b"]],
                  [["ab c", "ab", "b c", " c", "abab"], ["ab"], ["b"]]):
        got = df.select("t", keyword_lists_found("t", lists).alias("f"), *[contains_any("t", ws).alias(f"l{i}") for i, ws in enumerate(lists)]).collect()
        for r in got:
            want = [i for i, ws in enumerate(lists) if r["t"] is not None and any(w in r["t"] for w in ws)]
            assert r["f"] == want and [i for i in range(len(lists)) if r[f"l{i}"]] == want, (r, lists)


def test_row_key_tells_positions_apart(spark):
    from feedlake.functions import row_key
    df = spark.createDataFrame([("a", None, "x"), ("a", "x", None), ("a", "", "x"), ("a", "null", "x"), ("a,1:b", None, "x")],
                               "p string, q string, r string")
    assert df.select(row_key("p", "q", "r").alias("id")).distinct().count() == 5


def _fresh(spark, name):
    from feedlake.sources import snapshots
    snapshots.drop(spark, name)
    return name


def test_upsert_matches_null_key_parts(spark):
    t = _fresh(spark, "t_upsert_null")
    kind = "a string, b string, v int"
    upsert(spark.createDataFrame([("x", None, 1), ("x", "y", 2)], kind), t, ["a", "b"])
    upsert(spark.createDataFrame([("x", None, 3), (None, None, 4)], kind), t, ["a", "b"])
    upsert(spark.createDataFrame([(None, None, 5)], kind), t, ["a", "b"])
    assert sorted(map(str, spark.table(t).collect())) == sorted(map(str, spark.createDataFrame(
        [("x", None, 3), ("x", "y", 2), (None, None, 5)], kind).collect()))


def test_upsert_touches_only_its_partitions(spark):
    import pytest
    t = _fresh(spark, "t_upsert_parts")
    kind = "k int, p string, v int"
    upsert(spark.createDataFrame([(1, "a", 1), (2, "a", 1), (1, "b", 1)], kind), t, ["k", "p"], partition_by=["p"])
    before = {f for f in spark.table(t).where("p = 'b'").inputFiles()}
    upsert(spark.createDataFrame([(2, "a", 9), (7, "c", 9)], kind), t, ["k", "p"], partition_by=["p"])
    assert {f for f in spark.table(t).where("p = 'b'").inputFiles()} == before
    assert sorted(map(tuple, spark.table(t).select("k", "p", "v").collect())) == [(1, "a", 1), (1, "b", 1), (2, "a", 9), (7, "c", 9)]
    with pytest.raises(ValueError):
        upsert(spark.createDataFrame([(2, "a", 9)], kind), t, ["k"], partition_by=["p"])


def test_merge_condition_resolves_and_errors_surface(spark):
    import pytest
    from pyspark.errors import AnalysisException
    from feedlake.sources.sinks import merge_into, supports_merge
    t = _fresh(spark, "t_upsert_merge")
    spark.range(3).selectExpr("id AS k", "0 AS v").write.saveAsTable(t)
    assert not supports_merge(spark, t)                        # a plain Parquet table declares no row-level operations
    with pytest.raises(Exception) as e:                        # asked for anyway: the catalog's refusal surfaces,
        merge_into(spark.range(3).selectExpr("id AS k", "1 AS v"), t, "k")
    assert "UNRESOLVED" not in str(e.value)                    # and the condition was resolved before it
    with pytest.raises((AnalysisException, ValueError)):
        upsert(spark.range(3).selectExpr("id AS other"), t, "k")
    assert spark.table(t).count() == 3
