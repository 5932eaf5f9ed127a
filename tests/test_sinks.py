"""Snapshots, schema evolution, batch appends, rejects and the run journal."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.catalog import RUN_DATE
from feedlake.catalog import adapters as A
from feedlake.plans import run as R
from feedlake.sources import (append, current_name, land_feed, load_reference, merge_by_key, read_feed, read_if_exists, snapshots,
                              sinks, upsert)
from tests.conftest import SF_SMALL

KIND = "k int, p string, v int"


def fresh(spark, name):
    snapshots.drop(spark, name)
    return name


def rows(spark, values, kind=KIND):
    return spark.createDataFrame(values, kind)


def content(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_writers_and_readers_at_once(spark):
    """Two writers and a reader: every read sees whole versions only, and no change is lost."""
    t = fresh(spark, "t_snap_race")
    upsert(rows(spark, [(k, "a", 0) for k in range(20)]), t, "k")
    seen, errors, stop = [], [], threading.Event()

    def write(session, first):
        try:
            for i in range(3):
                # 20 old keys get a new value together, and 10 keys are new
                upsert(session.range(20).selectExpr("CAST(id AS INT) AS k", "'a' AS p", f"{first + i} AS v")
                       .unionByName(session.range(10).selectExpr(f"CAST(id + {1000 * (first + i)} AS INT) AS k", "'a' AS p", "-1 AS v")), t, "k")
        except Exception as e:      # noqa: BLE001
            errors.append(e)

    def read(session):
        try:
            while not stop.is_set():
                for name in (t, current_name(session, t)):
                    got = session.table(name).collect()
                    seen.append((len(got), len({r["v"] for r in got if r["v"] >= 0})))
        except Exception as e:      # noqa: BLE001
            errors.append(e)

    writers = [threading.Thread(target=write, args=(spark.newSession(), f)) for f in (1, 101)]
    reader = threading.Thread(target=read, args=(spark.newSession(),))
    for x in (reader, *writers):
        x.start()
    for x in writers:
        x.join()
    stop.set()
    reader.join()
    assert not errors
    assert spark.table(t).count() == 20 + 6 * 10 and snapshots.versions(spark, t) == list(range(1, 8))
    assert {n % 10 for n, _ in seen} == {0} and {v for _, v in seen} == {1}     # whole commits, one value at a time
    assert min(n for n, _ in seen) >= 20


def test_reader_changes_nothing_and_keeps_its_version(spark):
    t = fresh(spark, "t_snap_reader")
    upsert(rows(spark, [(1, "a", 1)]), t, "k")
    names = {r.name for r in spark.catalog.listTables()}
    # another run is half-way: its snapshot is written, not committed
    waiting = snapshots.write_snapshot(rows(spark, [(1, "a", 2)]), t, [], 1)
    before = read_if_exists(spark, t, spark.table(t).schema)
    assert content(before, "k", "v") == [(1, 1)]
    assert {r.name for r in spark.catalog.listTables()} == names | {waiting}
    snapshots.commit(spark, t, waiting, 2)
    assert content(before, "k", "v") == [(1, 1)] and content(spark.table(t), "k", "v") == [(1, 2)]
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, t, waiting, 2)


def test_writer_that_dies(spark, monkeypatch):
    t = fresh(spark, "t_snap_kill")
    upsert(spark.range(10).selectExpr("id AS k", "0 AS v"), t, "k")
    changes = spark.range(8, 12).selectExpr("id AS k", "1 AS v")

    def die(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", die)                    # all written, nothing committed
        with pytest.raises(KeyboardInterrupt):
            upsert(changes, t, "k")
    assert spark.table(t).count() == read_if_exists(spark, t, spark.table(t).schema).count() == 10
    with monkeypatch.context() as m:
        m.setattr(snapshots, "point", die)                     # committed, the name not moved
        with pytest.raises(KeyboardInterrupt):
            upsert(changes, t, "k")
    assert spark.table(t).count() == 10 and read_if_exists(spark, t, spark.table(t).schema).count() == 12
    upsert(spark.range(1).selectExpr("id AS k", "9 AS v"), t, "k")       # the next writer builds on it
    assert spark.table(t).count() == 12 and spark.table(t).where("v = 1").count() == 4


def test_partitions_and_expiry(spark):
    t = fresh(spark, "t_snap_parts")
    odd = "x=1/ 'q' %41\\"
    upsert(rows(spark, [(1, "a", 1), (2, odd, 1), (3, None, 1)]), t, ["k", "p"], partition_by=["p"])
    for i in range(4):
        upsert(rows(spark, [(1, "a", 10 + i)]), t, ["k", "p"], partition_by=["p"])
    want = sorted([(1, "a", 13), (2, odd, 1), (3, None, 1)], key=str)
    assert content(spark.table(t), "k", "p", "v") == want
    assert snapshots.expire(spark, t, keep=2) == [1, 2, 3]
    assert snapshots.versions(spark, t) == [4, 5] and content(spark.table(t), "k", "p", "v") == want
    left = [r.name for r in spark.catalog.listTables() if r.name.startswith(f"{t}__s_")]
    assert len(left) == 3                # two versions, and the first one's files, which both still name
    upsert(rows(spark, [(2, odd, 7), (3, None, 7)]), t, ["k", "p"], partition_by=["p"])
    assert snapshots.expire(spark, t, keep=1) == [4, 5]
    assert content(spark.table(t), "k", "p", "v") == sorted([(1, "a", 13), (2, odd, 7), (3, None, 7)], key=str)
    assert len([r for r in spark.catalog.listTables() if r.name.startswith(f"{t}__s_")]) == 2
    with pytest.raises(ValueError, match="not partitioned"):
        upsert(rows(spark, [(1, "a", 1)]), t, ["k", "v"], partition_by=["v"])


def test_plain_table_is_adopted(spark):
    t = fresh(spark, "t_snap_adopt")
    rows(spark, [(1, "a", 1), (2, "b", 1)]).write.partitionBy("p").saveAsTable(t)
    upsert(rows(spark, [(2, "b", 2), (3, "c", 2)]), t, ["k", "p"], partition_by=["p"])
    assert content(spark.table(t), "k", "p", "v") == [(1, "a", 1), (2, "b", 2), (3, "c", 2)]
    snapshots.expire(spark, t, keep=1)
    assert spark.table(t).count() == 3
    spark.sql("CREATE OR REPLACE VIEW t_snap_foreign AS SELECT 1 AS k, 'a' AS p, 2 AS v")
    with pytest.raises(ValueError, match="view"):
        upsert(rows(spark, [(2, "b", 2)]), "t_snap_foreign", "k")


def test_schema_evolution(spark):
    t = fresh(spark, "t_snap_schema")
    upsert(rows(spark, [(1, "a", 1), (2, "b", 1)]), t, ["k", "p"], partition_by=["p"])
    upsert(rows(spark, [(2, "b", 2, {"x": 1}), (3, "c", 2, None)], f"{KIND}, w map<string,int>"), t, ["k", "p"], partition_by=["p"])
    assert content(spark.table(t), "k", "p", "v", "w") == [(1, "a", 1, None), (2, "b", 2, {"x": 1}), (3, "c", 2, None)]
    for bad, kind in (([(1, "a", 1)], KIND), ([(1, "a", "1", None)], "k int, p string, v string, w map<string,int>"),
                      ([(1, "a", 1, None)], f"{KIND}, w map<string,long>")):
        with pytest.raises(ValueError, match="dropped|retyped"):
            upsert(rows(spark, bad, kind), t, ["k", "p"], partition_by=["p"])
    assert snapshots.versions(spark, t) == [1, 2]
    merged = merge_by_key(rows(spark, [(1, "a", 1), (2, "b", 2)]), rows(spark, [(2, "c", 3, 0.5)], f"{KIND}, w double"), "k")
    assert content(merged, "k", "p", "v", "w") == [(1, "a", 1, None), (2, "c", 3, 0.5)]


def test_state_lookup_has_no_exchange_of_the_state(spark):
    """A bucketed state joins a batch by id where it lies: only the batch is shuffled, through several versions."""
    from feedlake.operators import join_state
    from feedlake.sources import state_for_keys
    t = fresh(spark, "t_snap_buckets")
    state = spark.range(2000).selectExpr("concat('BC-', id) AS id", "CAST(id AS INT) AS v")
    upsert(state, t, "id", buckets=8)
    upsert(state.where("v < 10").withColumn("v", F.col("v") + 5000), t, "id")         # keeps the buckets
    assert snapshots.bucketing(spark, t, 2) == (8, ["id"]) and len(spark.table(t).inputFiles()) <= 2 * 8
    batch = spark.range(0, 4000, 4).selectExpr("concat('BC-', id) AS id", "id AS w")
    kept = read_if_exists(spark, t, spark.table(t).schema)
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        for made, n in ((join_state(batch, kept), 1000), (state_for_keys(kept, batch.select("id")), 500)):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
            assert made.count() == n
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert join_state(batch, kept).where("v >= 5000").count() == 3
    with pytest.raises(ValueError, match="not both"):
        upsert(rows(spark, [(1, "a", 1)]), fresh(spark, "t_snap_both"), ["k", "p"], partition_by=["p"], buckets=2)


def test_run_time_filter_on_the_state(spark, tmp_path):
    """A selective batch prunes the state by a Bloom filter of its keys before the join, where the state is large."""
    from feedlake.sources import state_for_keys
    spark.range(20000).selectExpr("id", "id % 7 AS v").write.parquet(str(tmp_path / "state"))
    spark.range(500).selectExpr("id * 3 AS id", "id % 5 AS kind").write.parquet(str(tmp_path / "batch"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        keys = spark.read.parquet(str(tmp_path / "batch")).where("kind = 1").select("id")
        found = state_for_keys(spark.read.parquet(str(tmp_path / "state")), keys)
        assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() == 100
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_upsert_counts_on_the_way(spark):
    t = fresh(spark, "t_snap_counts")
    assert upsert(rows(spark, [(1, "a", 1), (1, "a", 1), (2, "b", 1)]), t, ["k", "p"], partition_by=["p"]) == 2
    assert upsert(rows(spark, [(7, "a", 1)]), t, ["k", "p"], partition_by=["p"]) == 2       # the touched partition's rows


def test_append_is_idempotent(spark, monkeypatch):
    t = "t_append_batches"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    one, two = rows(spark, [(1, "a", 1), (1, "a", 1)]), rows(spark, [(2, None, 2, 0.5)], f"{KIND}, w double")
    assert append(one, t, "2024-01-01/1") and not append(one, t, "2024-01-01/1")
    assert append(two, t, "2024-01-01/2") and not append(two, t, "2024-01-01/2")
    assert content(spark.table(t), "k", "p", "v", "w", "batch_id") == [
        (1, "a", 1, None, "2024-01-01/1"), (1, "a", 1, None, "2024-01-01/1"), (2, None, 2, 0.5, "2024-01-01/2")]

    real = snapshots.data_root

    def overtaken(*a):          # another writer of the batch comes first
        monkeypatch.setattr(snapshots, "data_root", real)
        append(rows(spark, [(9, "z", 9, 0.5)], f"{KIND}, w double"), t, "b3")
        return real(*a)

    monkeypatch.setattr(snapshots, "data_root", overtaken)
    assert not append(two, t, "b3")
    assert spark.table(t).where("batch_id = 'b3'").count() == 1
    with pytest.raises(ValueError, match="retyped"):
        append(rows(spark, [(1, "a", "x", 0.5)], "k int, p string, v string, w double"), t, "b4")
    with pytest.raises(ValueError, match="batch"):
        append(two, t, "b'5")


BAD = {"cut.json": '{"id": 5, "name": "cut', "typed.json": '{"id": "not a number", "name": "t"}', "empty.json": "", "blank.json": " \n",
       "keyless.json": '{"name": "no id"}', "list.json": '[{"id": 1, "name": "a", "brands": [{"id": 7, "name": "b"}]},\n {"id": 2, "name": "c"}]',
       "one.json": '{"id": 3, "name": "é", "other": 1}'}


def test_rejects(spark, tmp_path):
    for name, text in BAD.items():
        (tmp_path / name).write_text(text)
    good, rejects = land_feed(spark, str(tmp_path), schemas.CHAINS, "chains", key="id")
    assert good.columns == schemas.CHAINS.names and content(good, "id", "name") == [(1, "a"), (2, "c"), (3, "é")]
    assert good.select("id").where("id is null").count() == 0       # few columns of the plan: the same rows
    found = {r["source_file"].rsplit("/", 1)[1]: (r["reason"], r["record"]) for r in rejects.collect()}
    assert found.pop("blank.json")[0] in ("empty", "malformed", "no id")
    assert {k: v[0] for k, v in found.items()} == {"cut.json": "malformed", "typed.json": "malformed", "empty.json": "empty", "keyless.json": "no id"}
    assert found["cut.json"][1] == BAD["cut.json"] and json.loads(found["keyless.json"][1])["name"] == "no id"
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_feed(spark, str(tmp_path), schemas.CHAINS).collect()


def test_lookup_names_are_checked(spark):
    with pytest.raises(ValueError, match="themse"):
        load_reference(spark, themse={})


FEED_SOURCES = {"details": A.listing_feed, "review_scores": A.scores_feed, "search": A.search_feed, "chains": A.chains_feed,
                "reviews": A.reviews_feed, "city_map": A.city_map, "country_map": A.country_map, "assigned_locations": A.assigned_locations}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    for name, make in FEED_SOURCES.items():
        make(spark, SF_SMALL).write.json(f"{root}/{name}")
    return {name: f"{root}/{name}" for name in FEED_SOURCES}


def outputs(prefix):
    tables = {s: f"{prefix}_{s}" for s in ("localize_table", "location_table", "listing_table", "reviews_table", "price_history_table")}
    return R.Sinks(**tables, price_state_table=tables["listing_table"], journal_table=f"{prefix}_journal"), list(tables.values())


def whole(spark, tables):
    out = []
    for t in tables:
        df = spark.table(t)
        out.append(sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)))).collect()))
    return out


def test_run_resumes_after_each_sink(spark, folders, monkeypatch):
    """Killed after its k-th commit, before the journal notes it, and started again: as if nothing had happened."""
    paths, ref = R.FeedPaths(**folders, multiline=False), A.reference(spark)
    sinks_, tables = outputs("j_plain")
    counts = R.run(spark, paths, ref, RUN_DATE, sinks_)
    want = whole(spark, tables)
    assert counts["localized"] == len(want[0]) and counts["staged"] == len(want[2])
    stages = []
    real_stage, real_upsert = R.stage, R.upsert
    monkeypatch.setattr(R, "stage", lambda *a, **k: (stages.append(1), real_stage(*a, **k))[1])
    sinks_, tables = outputs("j_killed")
    for k in range(5):
        made = []

        def upsert_and_die(df, table, *a, **kw):
            real_upsert(df, table, *a, **kw)
            made.append(table)
            raise KeyboardInterrupt

        monkeypatch.setattr(R, "upsert", upsert_and_die)
        with pytest.raises(KeyboardInterrupt):
            R.run(spark, paths, ref, RUN_DATE, sinks_)
        # each time the sink that was not noted is written again; then let one more step through
        monkeypatch.setattr(R, "upsert", lambda df, table, *a, **kw: real_upsert(df, table, *a, **kw) if table == made[-1] else _stop())
        if k < 4:
            with pytest.raises(RuntimeError, match="stopped"):
                R.run(spark, paths, ref, RUN_DATE, sinks_)
    monkeypatch.setattr(R, "upsert", real_upsert)
    R.run(spark, paths, ref, RUN_DATE, sinks_)
    assert whole(spark, tables) == want
    assert len(stages) == 1                                    # every start went on from the same staged listings
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stage_enriched")]


def _stop():
    raise RuntimeError("stopped")


def test_run_writes_rejects(spark, folders, tmp_path):
    bad = tmp_path / "details"
    bad.mkdir()
    lines = [r["value"] for r in spark.read.text(folders["details"]).collect()]
    (bad / "a.json").write_text("\n".join([*lines[:5], '{"id": 1, "na', '{"id": "x"}', '{"name": {"en-us": "keyless"}}']))
    paths = R.FeedPaths(**{**folders, "details": str(bad)}, multiline=False, on_reject="write")
    sinks_, tables = outputs("j_rejects")
    with pytest.raises(ValueError, match="rejects_table"):
        R.run(spark, paths, A.reference(spark), RUN_DATE, sinks_)
    sinks_.rejects_table = "j_rejects_rejects"
    counts = R.run(spark, paths, A.reference(spark), RUN_DATE, sinks_)
    assert counts["staged"] == 5 and counts["rejects"] == 3
    assert content(spark.table("j_rejects_rejects"), "feed", "reason") == [("details", "malformed")] * 2 + [("details", "no id")]
    with pytest.raises(Exception, match="(?i)malformed|without id"):
        R.run(spark, R.FeedPaths(**{**folders, "details": str(bad)}, multiline=False), A.reference(spark), RUN_DATE, outputs("j_strict")[0])
    R.abandon(spark, outputs("j_strict")[0], f"{RUN_DATE} 00:00:00 batch")


def test_sinks_module_has_no_staging_names():
    assert not hasattr(sinks, "recover")
