"""The whole run (D35) as a composition without sinks, and wide comparisons.

Each output of ``plans.run.compose`` is a query.  Where an output equals one of
the step queries, its SQL is that query's; wide listing rows are compared with
the step queries' SQL joined by id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import rules
from feedlake.catalog import ORACLE, RUN_DATE, RUN_TS, query, sql_round
from feedlake.catalog import adapters as A
from feedlake.catalog import domain as D
from feedlake.functions import sorted_text
from feedlake.plans import listing as P
from feedlake.plans import localize as LZ
from feedlake.plans.run import compose, details, ingest_details


def composed(spark, d):
    """All outputs of a run on the adapters' feeds."""
    feeds = {
        "details": ingest_details(A.listing_feed(spark, d)), "scores": A.scores_feed(spark, d),
        "search": A.search_feed(spark, d), "chains": A.chains_feed(spark, d), "reviews": A.reviews_feed(spark, d),
        "city_map": A.city_map(spark, d), "country_map": A.country_map(spark, d),
        "assigned": A.assigned_locations(spark, d),
    }
    return compose(feeds, A.reference(spark), RUN_DATE, RUN_TS, A.location_state(spark, d), A.stored_prices(spark, d))


@query("d_run_worklist", ORACLE["d_location_begin"])
def d_run_worklist(spark, d):
    return composed(spark, d)["worklist"]


@query("d_run_new_locations", ORACLE["d_new_locations"])
def d_run_new_locations(spark, d):
    return composed(spark, d)["new_locations"].withColumn("parent_path", F.array_join("parent_path", "/"))


@query("d_run_reviews", ORACLE["d_reviews"])
def d_run_reviews(spark, d):
    return composed(spark, d)["reviews"].select(
        "id", "property_id", "language_code", "score", F.md5("summary").alias("summary_md5"), "reviewer",
        "review_date", "country_code", "feed")


@query("d_run_price_history", ORACLE["d_price_history"])
def d_run_price_history(spark, d):
    return composed(spark, d)["price_history"].select(
        "property_id", F.col("price.book").alias("price_book"), "checkin", "checkout", "feed", "country_code", "id")


@query("d_run_listings", f"""
SELECT f.*, u.usd_price, c.chain_name, c.brand_name, m.commission, m.meal_plan
FROM ({ORACLE["d_location_finish"]}) f JOIN ({ORACLE["d_usd_price_update"]}) u USING (id)
     JOIN ({ORACLE["d_chain_brand"]}) c USING (id) JOIN ({ORACLE["d_meal_plan"]}) m USING (id)""")
def d_run_listings(spark, d):
    return composed(spark, d)["listings"].select(
        "id", "latlon", "zip_code", "country", "city", "location_id", F.array_join("parent_path", "/").alias("parent_path"),
        "categories", "state", "state_abbr", "display", "property_name", "usd_price",
        F.col("chain_and_brand.chain_name").alias("chain_name"), F.col("chain_and_brand.brand_name").alias("brand_name"),
        F.round("commission", 2).alias("commission"), sorted_text("meal_plan").alias("meal_plan"))


@query("d_run_localized", f"""
WITH t AS ({ORACLE["d_localize_text"]}), f AS ({ORACLE["d_location_finish"]}),
n AS (SELECT t.*, CASE WHEN locale_code = 'en' THEN f.property_name ELSE localize_property_name END AS filled
      FROM t JOIN f USING (id))
SELECT id AS property_id, language_code, {D._locale_name_sql("locale_code")} AS language, filled AS property_name,
       lower(regexp_replace(trim(filled), '[^a-zA-Z0-9]+', '-', 'g')) AS property_slug, description_md5, address
FROM n""")
def d_run_localized(spark, d):
    return composed(spark, d)["localized"].select(
        "property_id", "language_code", "language", "property_name", "property_slug",
        F.md5("property_description").alias("description_md5"), "address")


def localized(spark, d, locales=None):
    ref = A.reference(spark)
    if locales is not None:
        ref.locales = locales
    df = D.listing(spark, d).transform(P.property_name).transform(lambda x: P.property_types(x, ref))
    df = df.transform(P.url_and_licence).transform(lambda x: P.amenities(x, ref)).transform(P.policies)
    return LZ.localize(df, ref, RUN_DATE)


# Two locales without a language name: rows stay apart by language_code.
TWO_DISABLED = {name: {**v, "disabled": v["code"] in ("fr", "de")} for name, v in rules.LOCALES.items()}
_ENABLED = " ".join(f"WHEN locale_code = '{v['code']}' THEN '{k}'" for k, v in TWO_DISABLED.items() if not v["disabled"])


@query("d_localized_disabled", f"""
SELECT id AS property_id, language_code, CASE {_ENABLED} END AS language, localize_property_slug AS property_slug, address
FROM ({ORACLE["d_localize_text"]})""")
def d_localized_disabled(spark, d):
    return localized(spark, d, TWO_DISABLED).select("property_id", "language_code", "language", "property_slug", "address")


POLICY = ["other_policy", "cancellation_policy", "is_pet_friendly", "adult_only", "infant_policy", "child_policy",
          "checkin_policy", "pet_policy", "adult_policy", "payment_policy"]


@query("d_localized_policies", f"""
WITH t AS ({ORACLE["d_localize_text"]}), p AS ({ORACLE["d_policies"]})
SELECT t.id AS property_id, t.language_code,
       t.other_policy AS other_policy_text,
       CASE WHEN t.locale_code <> 'en' THEN t.other_policy ELSE coalesce(t.other_policy, p.other_policy) END AS other_policy,
       {", ".join(f"CASE WHEN t.locale_code = 'en' THEN CAST(p.{c} AS VARCHAR) END AS {c}" for c in POLICY[1:])}
FROM t JOIN p ON p.id = t.id""")
def d_localized_policies(spark, d):
    out = localized(spark, d)
    return out.select("property_id", "language_code", F.get_json_object("policies", "$.other_policy").alias("other_policy_text"),
                      *[F.get_json_object("policies", f"$.{c}").alias(c) for c in POLICY])


@query("d_localized_rooms", ORACLE["d_room_arrangement"])
def d_localized_rooms(spark, d):
    return D.room_columns(localized(spark, d).select(F.col("property_id").alias("id"), "language_code",
                                                     F.explode("room_arrangement").alias("r")))


_STEPS = ["d_init_keys", "d_rating", "d_names", "d_amenities", "d_policies", "d_photos", "d_rooms", "d_chain_brand", "d_meal_plan",
          "d_usd_price_first", "d_property_flags"]
# Columns that later steps of the run replace, or that a later query holds as well.
_REPLACED = {"d_rating": "number_of_review, review_score, review_score_general, is_preferred",
             "d_amenities": "amenity_categories", "d_policies": "is_pet_friendly, adult_only",
             "d_usd_price_first": "feed_provider_id"}


@query("d_listing_wide", "SELECT * FROM " + " JOIN ".join(
    f"(SELECT {'* EXCLUDE (' + _REPLACED[s] + ')' if s in _REPLACED else '*'} FROM ({ORACLE[s]})) {s}"
    + (" USING (id)" if i else "") for i, s in enumerate(_STEPS))
    + f" JOIN ({ORACLE['d_review_scores']}) d_review_scores USING (id)")
def d_listing_wide(spark, d):
    df = details(D.listing(spark, d), A.reference(spark), A.scores_feed(spark, d), A.chains_feed(spark, d),
                 A.search_feed(spark, d), None, RUN_DATE)
    wanted = [
        "id", "feed", "feed_provider_id", "currency", "owner_id", "country_code", "feed_provider_url", "license_number",
        "published", "min_stay", "checkin_from", "checkin_to", "checkout_from", "checkout_to",
        F.array_join("languages", ",").alias("languages"), "star_rating", "property_name", "property_slug", "updated_at",
        "room_type", "property_type", "property_type_category",
        F.array_join("property_type_categories", ",").alias("property_type_categories"),
        F.array_join("themes", ",").alias("themes"), F.array_join("amenities", ",").alias("amenities"),
        sorted_text("amenity_categories").alias("amenity_categories"),
        *[F.col(f"policy.{c}").alias(c) for c in POLICY if c not in ("is_pet_friendly", "adult_only")],
        F.size("images").alias("n_images"), F.array_join("images", ",").alias("images"), "feature_image",
        "bedroom_count", "bathroom_count", "max_occupancy", "occupancy", "room_size_sqft",
        sorted_text("bedrooms").alias("bedrooms"), "chain_and_brand.*", F.round("commission", 2).alias("commission"),
        sorted_text("meal_plan").alias("meal_plan"), "usd_price", "property_flags.*",
        "review_score", "review_score_general", "number_of_review", "review_scores.*"]
    return df.select(*wanted)
