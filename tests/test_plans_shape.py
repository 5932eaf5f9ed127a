"""Plan checks: no Python evaluation, in-row rollups without an
exchange, broadcast lookups."""

import pytest

from tests.conftest import SF_SMALL


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def all_queries():
    from feedlake.catalog import QUERIES, load_all
    load_all()
    return QUERIES


def test_no_python_evaluation(spark, all_queries):
    for name, q in all_queries.items():
        plan = physical(q(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, f"{name} evaluates Python ({node})"


def test_photos_and_rooms_rollups_have_no_exchange(spark):
    from feedlake.catalog import adapters as A
    from feedlake.plans import listing as P
    df = A.listing_feed(spark, SF_SMALL)
    plan = physical(df.transform(P.hotel_photos).transform(P.rooms).select("id", "images", "bedroom_count"))
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_building_a_plan_starts_no_job(spark, all_queries):
    """Only Spark's sizes and AQE pick strategies: no operator counts rows while a plan is built
    (reading a table's schema from its footer is the reader's own job)."""
    tracker = spark.sparkContext.statusTracker()
    for name, q in all_queries.items():
        spark.sparkContext.setJobGroup(f"build::{name}", name)
        q(spark, SF_SMALL)
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build::{name}")]
        tasks = sum(tracker.getStageInfo(s).numTasks for j in jobs if j for s in j.stageIds if tracker.getStageInfo(s))
        scans = 14      # at most one single-task footer job per table read
        assert tasks <= scans * 4, f"{name} runs {len(jobs)} jobs, {tasks} tasks while it is built"


def test_dimension_lookups_broadcast(spark, all_queries):
    plan = physical(all_queries["q_broadcast_feature"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    plan = physical(all_queries["q_type_category"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_dedupe_has_partial_aggregation(spark, all_queries):
    plan = physical(all_queries["q_dedupe"](spark, SF_SMALL))
    assert "partial_max_by" in plan


def test_filters_and_columns_pushed_to_scan(spark, all_queries):
    plan = physical(all_queries["q_semi_state"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_wide_listing_shuffled_once_at_scale(spark, all_queries):
    """With automatic broadcasts off (as for inputs far above the threshold), the
    enrichment joins of the details chain all key on ``id``: the wide listing
    frame is hash-partitioned once and every later sort-merge join reuses that
    partitioning, so only the narrow right sides are shuffled."""
    import re
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = all_queries["d_listing"](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = physical(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    smj_on_id = len(re.findall(r"SortMergeJoin \[id#\d+\], \[id#\d+\]", plan))
    shuffles_on_id = len(re.findall(r"Exchange hashpartitioning\(id#\d+, \d+\)", plan))
    # state, review scores and search are joined by id: three joins, the wide frame crosses one exchange
    assert smj_on_id == 2
    assert shuffles_on_id == smj_on_id + 1


def test_wide_documents_shuffled_once_from_ingestion(spark):
    """From the raw feed on: the de-duplication's shuffle by listing id serves the joins by id."""
    import re
    from feedlake.catalog import RUN_DATE, adapters as A
    from feedlake.plans import location as LOC
    from feedlake.plans.run import details, ingest_details
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        raw = A.listing_feed(spark, SF_SMALL)
        df, _ = LOC.location_begin(ingest_details(raw), A.location_state(spark, SF_SMALL))
        df = details(df, A.reference(spark), A.scores_feed(spark, SF_SMALL), A.chains_feed(spark, SF_SMALL),
                     A.search_feed(spark, SF_SMALL), A.stored_prices(spark, SF_SMALL), RUN_DATE)
        df.write.format("noop").mode("overwrite").save()
        plan = physical(df)
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    final = plan.split("== Initial Plan ==")[0]
    by_id = re.findall(r"SortMergeJoin \[id#\d+\], \[id#\d+\], LeftOuter", final)
    assert len(by_id) == 4                                       # state, scores, search, stored price
    # one exchange by listing id (the documents) and one by id for each narrow right side
    assert len(re.findall(r"Exchange hashpartitioning\(listing_id#\d+, \d+\)", final)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+, \d+\)", final)) == 4


def test_localized_wide_rows_shuffled_once_at_scale(spark, all_queries):
    """Localise path with automatic broadcasts off: the feature-summary map is
    joined to the listing rows by id before the language fan-out, so the wide
    rows cross one exchange (and the narrow per-id map the other)."""
    import re
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = all_queries["d_localized"](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = physical(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert len(re.findall(r"SortMergeJoin \[id#\d+\], \[id#\d+\], LeftOuter", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(id#\d+, \d+\)", plan)) == 2
    # the language fan-out (Generate explode) sits above the join, not below it
    join_at = plan.index("SortMergeJoin [id#")
    assert "Generate explode([en-us" in plan[:join_at]   # the (constant-folded) language array
