"""Price pipelines D21-D22."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import rules
from feedlake.functions import per_night, query_param, row_key, run_epoch, safe_date
from feedlake.operators import dedupe, enrich_left, match, reconcile
from feedlake.plans.listing import prefixed_id


def resolve_price(stored: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Full outer join of stored and fresh prices (J7).  The stored price wins
    when positive; ``from_search`` is decided from the stored side, before the
    price is replaced."""
    r = reconcile(stored.select(key, "usd_price"), fresh.select(key, "search_usd_price"), key)
    take = F.coalesce((F.col("usd_price").isNull() | (F.col("usd_price") <= 0)) & (F.col("search_usd_price") >= 0),
                      F.lit(False))
    r = r.withColumn("from_search", take)
    return r.select(key, F.round(F.when(F.col("from_search"), F.col("search_usd_price"))
                                 .otherwise(F.col("usd_price")), 2).alias("usd_price"), "from_search")


def changed_price_history(resolved: DataFrame, search: DataFrame, key: str) -> DataFrame:
    """Rows whose price came from search, with stay dates parsed from the deep
    link (J8, F12, F13)."""
    changed = resolved.filter(F.col("from_search"))
    out = match(changed, search, key)
    link = F.col("deep_link_url")
    return out.withColumns({"checkin": safe_date(query_param(link, "checkin")),
                            "checkout": safe_date(query_param(link, "checkout"))})


def search_facts(search: DataFrame, *extra: str) -> DataFrame:
    """What the details steps need of the search feed (one row per id), keyed by
    listing id: the fresh price, the price struct, stay dates, and ``extra`` columns."""
    link = F.col("deep_link_url")
    fresh = per_night(F.col("price.book"), rules.PRICE_NIGHTS)
    return search.select(
        prefixed_id("id").alias("id"), *extra, F.coalesce(fresh, F.lit(0)).alias("search_usd_price"),
        F.col("price").alias("search_price"), safe_date(query_param(link, "checkin")).alias("stay_checkin"),
        safe_date(query_param(link, "checkout")).alias("stay_checkout"))


def price_columns(df: DataFrame, stored: DataFrame | None) -> DataFrame:
    """``usd_price`` and ``from_search`` of rows that carry the search facts.

    ``stored`` holds the curated (id, feed_provider_id, usd_price) rows; absent
    on a first run, in which case every search price is new.  The stored price
    wins when positive.  Only listings of the batch are kept, so a left join on
    the listing id replaces a full outer one, and the decision is made in the row.
    """
    if stored is None:
        df = df.withColumn("_stored", F.lit(None).cast("double"))
    else:
        keyed = stored.select(prefixed_id("feed_provider_id").alias("id"), F.col("usd_price").alias("_stored"))
        df = enrich_left(df, dedupe(keyed, "id", ["_stored"]), "id")
    fresh, old = F.col("search_usd_price"), F.col("_stored")
    take = F.coalesce((old.isNull() | (old <= 0)) & (fresh >= 0), F.lit(False))
    return df.withColumn("from_search", take).withColumn(
        "usd_price", F.coalesce(F.round(F.when(F.col("from_search"), fresh).otherwise(old), 2), F.lit(0))).drop(
        "_stored", "search_usd_price")


# Columns that carry the price history through the staged frame.
HISTORY_COLUMNS = ["from_search", "search_price", "stay_checkin", "stay_checkout"]


def usd_price(df: DataFrame, search: DataFrame, stored: DataFrame | None = None, run_ts: str = "1970-01-01 00:00:00"):
    """USD price per listing and the price-history rows of the run (D21 + D22)."""
    out = price_columns(enrich_left(df, search_facts(search), "id"), stored)
    return out.drop(*HISTORY_COLUMNS), price_history(out, run_ts)


def price_history(df: DataFrame, run_ts: str) -> DataFrame:
    """Price-history rows: a filter over listings that carry ``HISTORY_COLUMNS``
    (D22).  The row id holds the run's time, so a later price for the same stay,
    or for a link without dates, is a new row; a repeated run gives the same ids."""
    return df.where("from_search").select(
        F.col("id").alias("property_id"), F.col("search_price").alias("price"), F.col("stay_checkin").alias("checkin"),
        F.col("stay_checkout").alias("checkout"), "feed", "country_code",
        row_key("id", "stay_checkin", "stay_checkout", run_epoch(run_ts)).alias("id"))
