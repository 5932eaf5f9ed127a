"""D35 smoke test: the whole run on fixture JSON in a scratch folder."""

import tempfile

from pyspark.sql import functions as F

from feedlake.catalog import RUN_DATE
from feedlake.catalog import adapters as A
from feedlake.plans.run import FeedPaths, Sinks, run
from tests.conftest import SF_SMALL


def test_run_twice_is_stable(spark):
    root = tempfile.mkdtemp(prefix="feedlake-run-")
    d = SF_SMALL
    feeds = {"details": A.listing_feed(spark, d), "review_scores": A.scores_feed(spark, d),
             "search": A.search_feed(spark, d), "chains": A.chains_feed(spark, d), "reviews": A.reviews_feed(spark, d),
             "city_map": A.city_map(spark, d), "country_map": A.country_map(spark, d),
             "assigned_locations": A.assigned_locations(spark, d)}
    for name, df in feeds.items():
        df.write.mode("overwrite").json(f"{root}/{name}")
    # Spark writes JSON Lines (one document per line), so multiLine is off here
    paths = FeedPaths(**{k: f"{root}/{k}" for k in feeds}, multiline=False)
    names = ("localize", "location", "listing", "reviews", "history")
    for t in names:
        spark.sql(f"DROP TABLE IF EXISTS r_{t}")
    ref = A.reference(spark)
    # two locales without a language name: their rows stay apart by language_code
    ref.locales = {k: {**v, "disabled": v["code"] in ("fr", "es")} for k, v in ref.locales.items()}
    # the listing table is the price state of the next run; all five sinks are on
    sinks = Sinks(localize_table="r_localize", location_table="r_location", listing_table="r_listing",
                  reviews_table="r_reviews", price_history_table="r_history", price_state_table="r_listing",
                  worklist_path=f"{root}/worklist")
    run(spark, paths, ref, RUN_DATE, sinks)
    loc = spark.table("r_localize")
    n1 = loc.count()
    assert n1 == feeds["details"].count() * 4
    assert loc.select("property_id", "language_code").distinct().count() == n1
    assert loc.where("language is null").count() == n1 // 2
    history = spark.table("r_history").count()
    assert history > 0 and spark.table("r_listing").count() == feeds["details"].count()
    assert spark.table("r_reviews").count() > 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stage_enriched")]
    assert spark.read.option("header", True).csv(f"{root}/worklist/batch").count() > 0
    cols = ("property_id", "language_code", "property_slug")
    first = sorted(map(tuple, loc.select(*cols).collect()), key=repr)
    run(spark, paths, ref, RUN_DATE, sinks)                  # replayed: same rows, same history ids
    assert sorted(map(tuple, spark.table("r_localize").select(*cols).collect()), key=repr) == first
    zero = spark.table("r_listing").where("usd_price <= 0").count()
    run(spark, paths, ref, RUN_DATE, sinks, run_ts=f"{RUN_DATE} 12:00:00")
    grown = spark.table("r_history").count()                 # a later run adds rows for prices still taken from search
    assert grown >= history and (zero == 0 or grown > history)
    newloc = spark.table("r_location")
    assert newloc.count() == newloc.select("id").distinct().count()


def test_stream_matches_batch(spark):
    from feedlake.streaming.feed_stream import start
    root = tempfile.mkdtemp(prefix="feedlake-stream-")
    d = SF_SMALL
    feeds = {"details": A.listing_feed(spark, d), "review_scores": A.scores_feed(spark, d),
             "search": A.search_feed(spark, d), "chains": A.chains_feed(spark, d), "reviews": A.reviews_feed(spark, d),
             "city_map": A.city_map(spark, d), "country_map": A.country_map(spark, d)}
    for name, df in feeds.items():
        df.write.mode("overwrite").json(f"{root}/{name}")
    paths = FeedPaths(**{k: f"{root}/{k}" for k in feeds}, multiline=False)
    sinks = Sinks(localize_table="s_localize", location_table="s_location", price_state_table=None)
    for t in ("s_localize", "s_location"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    q = start(spark, paths, A.reference(spark), RUN_DATE, sinks, name="t_stream")
    q.awaitTermination(600)
    got = spark.table("s_localize")
    assert got.count() == feeds["details"].count() * 4


def test_staged_frame_bucketed_by_id(spark):
    from feedlake.session import stage
    df = spark.range(1000).selectExpr("concat('BC-', id) AS id", "id % 7 AS v")
    staged = stage(df, "t_bucket_probe", bucket_by="id", buckets=8)
    other = spark.range(1000).selectExpr("concat('BC-', id) AS id", "id AS w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = staged.join(other, "id", "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    # one file per bucket, and only the other side is shuffled; the staged side is read co-located
    assert len(staged.inputFiles()) == 8
    assert plan.count("Exchange hashpartitioning") == 1
