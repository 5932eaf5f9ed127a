"""Listing pipelines D1-D20: one enriched row per listing.

Child collections (photos, rooms, meals, amenities) are rolled up inside the
row with higher-order functions: the listing document already holds its
children, so exploding, regrouping by id and joining back would add two
shuffles per rollup for the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import rules
from feedlake.functions import (
    add_tag, before_first, blank_to_null, classify, constant_array, default,
    empty_to_null, first_element, first_where, flag, flat_distinct, humanize, join_present,
    keyword_lists_found, literal_lookup, localized, map_lookup, matches_any, normalize_text, override_if, pluck,
    remap_code, round_to, run_date as run_date_col, sentence, slugify, slugify_all, sqft, half,
)
from feedlake.operators import (
    dedupe, enrich_left, join_first_element,
)


def prefixed_id(c) -> Column:
    return F.concat(F.lit(rules.ID_PREFIX), (F.col(c) if isinstance(c, str) else c).cast("string"))


# D1
def init_keys(df: DataFrame) -> DataFrame:
    """feed, feed_provider_id, prefixed id, currency default, typed null owner.
    Rows that ingestion keyed by ``listing_id`` take that column as their id, so
    joins by id reuse the partitioning of the ingestion's de-duplication."""
    key = F.col("listing_id") if "listing_id" in df.columns else prefixed_id("id")
    return df.withColumns({
        "feed": F.lit(rules.FEED_ID).cast("int"),
        "feed_provider_id": F.col("id"),
        "currency": default("currency", rules.DEFAULT_CURRENCY),
        "owner_id": F.lit(None).cast("string"),
        "id": key,
    }).drop("listing_id")


# D2
def country_code(df: DataFrame) -> DataFrame:
    """Trimmed, upper-cased country with the remap applied first (the reference's
    remap sat behind a branch that caught every non-null value)."""
    return df.withColumn("country_code", remap_code(F.col("location.country"), rules.COUNTRY_REMAP))


# D4
def property_name(df: DataFrame) -> DataFrame:
    return df.withColumn("property_name", localized("name", "en-us"))


def property_name_fill(df: DataFrame) -> DataFrame:
    """Missing name -> '<type> in <display>' when both are non-blank."""
    fill = F.when(blank_to_null(F.col("property_type")).isNotNull() & blank_to_null(F.col("display")).isNotNull(),
                  F.concat(F.col("property_type"), F.lit(" in "), F.col("display")))
    return df.withColumn("property_name", F.coalesce(F.col("property_name"), fill))


# D5
def checkin_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(f"checkin_checkout_times.{c}")
                           for c in ("checkin_from", "checkin_to", "checkout_from", "checkout_to")})


# D6
def rating_and_score(df: DataFrame) -> DataFrame:
    score = round_to(F.coalesce(F.col("rating.review_score"), F.lit(0.0)), 2, "float")
    return df.withColumns({
        "number_of_review": F.coalesce(F.col("rating.number_of_reviews"), F.lit(0)).cast("int"),
        "star_rating": F.coalesce(F.floor(F.col("rating.stars")), F.lit(0).cast("long")),
        "review_score": score,
        "review_score_general": half(score, "decimal(10,2)"),
        "is_preferred": F.coalesce(F.col("rating.preferred"), F.lit(False)),
    })


# D7
def property_slug(df: DataFrame, run_date: str) -> DataFrame:
    return df.withColumns({"property_slug": slugify("property_name"), "updated_at": run_date_col(run_date)})


# D8
def room_type(df: DataFrame) -> DataFrame:
    return df.withColumn("room_type", classify([
        (matches_any("property_name", rules.SHARED_ROOM_KEYWORDS), "Shared room"),
        (matches_any("property_name", rules.SHARED_SPACE_KEYWORDS), "Shared space"),
    ]).cast("string"))


# D9 (U1-U3)
def property_type(df: DataFrame, types, key_col: str = "accommodation_type") -> DataFrame:
    """Property type from a type table (U1).  ``types`` is a dict (literal map,
    evaluated in the row) or a (code, property_type) frame that is joined."""
    key = F.col(key_col).cast("string")
    if isinstance(types, dict):
        return df.withColumn("property_type", literal_lookup({str(k): v for k, v in types.items()})(key))
    t = types.select(F.col(types.columns[0]).cast("string").alias("_type_code"), F.col("property_type"))
    return df.join(t, key == t["_type_code"], "left").drop("_type_code")


def type_category(df: DataFrame, categories) -> DataFrame:
    """Category of the property type, "Other" when unknown."""
    if isinstance(categories, dict):
        cat = literal_lookup(categories)(F.col("property_type"))
        return df.withColumn("property_type_category", F.coalesce(cat, F.lit(rules.OTHER_CATEGORY)))
    c = categories.select(F.col("property_type").alias("_pt"), "property_type_category")
    out = df.join(c, F.col("property_type") == c["_pt"], "left").drop("_pt")
    return out.withColumn("property_type_category", default("property_type_category", rules.OTHER_CATEGORY))


def type_categories(df: DataFrame, category_rules: dict) -> DataFrame:
    """Several labels per listing from keyword rules over name, type and
    category (U3); ``category_rules`` maps label -> keywords."""
    text = normalize_text(F.concat_ws(" ", "property_name", "property_type", "property_type_category"))
    labels = constant_array(category_rules)
    found = keyword_lists_found(text, list(category_rules.values()))
    return df.withColumn("property_type_categories", F.filter(labels, lambda lab, i: F.array_contains(found, i)))


def property_types(df: DataFrame, ref) -> DataFrame:
    df = property_type(df, ref.property_types)
    df = type_category(df, ref.type_categories)
    return type_categories(df, ref.category_rules)


# D10
def amenities(df: DataFrame, ref) -> DataFrame:
    """Theme and amenity names from ids (unknown ids dropped), and the amenity
    categories through slugged synonyms, distinct."""
    themes_en = {int(k): v["name"]["en-us"] for k, v in ref.themes.items()}
    fac_en = {int(k): v["name"]["en-us"] for k, v in ref.facilities.items() if (v.get("name") or {}).get("en-us")}
    syn = {k: (list(v) if isinstance(v, (list, tuple)) else [v]) for k, v in ref.amenity_synonyms.items()}
    df = df.withColumns({
        "themes": map_lookup("themes", themes_en, key_type=None),
        "amenity_ids": pluck("facilities", "id"),
    })
    df = df.withColumn("amenities", map_lookup("amenity_ids", fac_en, key_type=None))
    cats = flat_distinct(map_lookup(slugify_all("amenities"), syn, key_type=None))
    return df.withColumn("amenity_categories", F.coalesce(cats, F.array().cast("array<string>")))


# D11
def policies(df: DataFrame) -> DataFrame:
    """Policy texts and flags, packed into the ``policy`` struct."""
    p = "policies"
    age = F.col(f"{p}.minimum_guest_age")
    cot = first_element(F.col(f"{p}.cots_and_extra_beds"))
    a_from, a_to, price = cot["age"]["from"], cot["age"]["to"], cot["price"]
    pets, mode = F.col(f"{p}.pets.allowed"), F.col(f"{p}.pets.charge_mode")
    df = df.withColumn("amenity_categories", add_tag("amenity_categories", rules.CHILD_FRIENDLY_TAG, age == 0))
    pet_policy = classify([
        (pets == "yes", "Pets are allowed."),
        (pets == "upon_request", F.concat(F.lit("Pets are allowed upon request"),
                                          F.when(mode.isNotNull(), F.concat(F.lit(" and "), humanize(mode)))
                                          .otherwise(F.lit(".")))),
        (pets == "no", "Pets are not allowed."),
    ]).cast("string")
    infant = F.when(
        (F.size(F.col(f"{p}.cots_and_extra_beds")) > 0) & a_to.isNotNull() & (a_to <= 2) & (a_from < a_to),
        F.concat(F.lit("Cots are available from age "), a_from.cast("string"), F.lit(" to "), a_to.cast("string"),
                 F.when(price.isNotNull() & (price > 0), F.concat(F.lit(" with price "), price.cast("string")))
                 .otherwise(F.lit(" without price")),
                 F.lit(" in "), cot["type"]))
    child = F.when((a_to > 2) & (a_from < a_to),
                   sentence("Children aged ", a_to, " years and above are considered adults at this property."))
    checkin = join_present(" and ",
                           F.when(F.col(f"{p}.minimum_checkin_age").isNotNull(),
                                  sentence("The minimum age for check-in is ", F.col(f"{p}.minimum_checkin_age"))),
                           F.when(F.col(f"{p}.maximum_checkin_age").isNotNull(),
                                  sentence("The maximum age for check-in is ", F.col(f"{p}.maximum_checkin_age"))))
    adult = F.when(age.isNotNull() & (age >= 18), sentence("Minimum guest age is ", age))
    cash = F.col("payment.methods.cash")
    payment = F.when(cash.isNotNull() & ~cash, F.lit("Credit Card Required"))
    other = F.trim(localized(F.col("description.important_information"), "en-us"))
    return df.withColumn("policy", F.struct(
        other.alias("other_policy"),
        F.lit(None).cast("string").alias("cancellation_policy"),
        flag(pets == "yes").alias("is_pet_friendly"),
        flag(age >= 18).alias("adult_only"),
        infant.alias("infant_policy"),
        child.alias("child_policy"),
        checkin.alias("checkin_policy"),
        pet_policy.alias("pet_policy"),
        adult.alias("adult_policy"),
        payment.alias("payment_policy"),
    ))


# D12
def min_stay(df: DataFrame) -> DataFrame:
    return df.withColumn("min_stay", F.lit(1))


# D13
def hotel_photos(df: DataFrame) -> DataFrame:
    """All standard image URLs in document order; the feature image is the first
    main photo, else the first image."""
    imgs = F.filter(F.transform(F.coalesce("photos", F.array()), lambda x: F.struct(
        x["url"]["standard"].alias("u"), x["main_photo"].alias("m"))), lambda x: x["u"].isNotNull())
    feature = first_where(imgs, lambda x: x["m"] == F.lit(True), first_element(imgs))
    return df.withColumns({"images": F.transform(imgs, lambda x: x["u"]), "feature_image": feature["u"]})


# D14
def rooms(df: DataFrame) -> DataFrame:
    """Per-listing room rollup: bedroom/bathroom/occupancy sums, mean size in
    square feet, distinct bedroom counts.  A room with 0 bedrooms counts 1
    bedroom below 5 guests and is left out of the bedroom sum otherwise."""
    per_room = F.transform(F.col("rooms"), lambda r: F.struct(
        sqft(F.coalesce(r["size"], F.lit(0.0))).alias("sqft"),
        F.coalesce(r["maximum_occupancy"]["total_guests"], r["maximum_occupancy"]["adults"], F.lit(0)).alias("occ"),
        F.coalesce(r["number_of_rooms"]["bathrooms"], F.lit(0)).alias("bath"),
        F.coalesce(r["number_of_rooms"]["bedrooms"], F.lit(0)).alias("bed")))
    per_room = F.transform(per_room, lambda r: r.withField(
        "bed", F.when(r["bed"] == 0, F.when(r["occ"] < 5, F.lit(1))).otherwise(r["bed"])))
    has = F.size(F.col("rooms")) > 0

    def total(field):
        vals = F.filter(F.transform(per_room, lambda r: r[field].cast("long")), lambda x: x.isNotNull())
        return F.when(has & (F.size(vals) > 0), F.aggregate(vals, F.lit(0).cast("long"), lambda a, x: a + x))

    sq = F.aggregate(per_room, F.lit(0.0), lambda a, r: a + r["sqft"])
    beds = F.filter(F.transform(per_room, lambda r: r["bed"]), lambda x: x.isNotNull())
    return df.withColumns({
        "bedroom_count": total("bed"),
        "bathroom_count": total("bath"),
        "max_occupancy": total("occ"),
        "occupancy": total("occ"),
        "room_size_sqft": F.when(has, F.round(sq / F.size(per_room), 2)),
        "bedrooms": F.when(has, F.array_distinct(beds)),
    })


# D15
def url_and_licence(df: DataFrame) -> DataFrame:
    lic = F.col("description.license_numbers")
    return df.withColumns({
        "feed_provider_url": before_first("url", "=", rules.AFFILIATE_SUFFIX),
        "license_number": F.when(lic.isNotNull(), F.concat_ws(", ", lic)),
        "languages": constant_array(rules.LANGUAGES),
    })


# D16
def is_published(df: DataFrame) -> DataFrame:
    u = F.col("feed_provider_url")
    return df.withColumn("published", flag(u.isNotNull() & (u != "")))


# D17
def review_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Breakdown struct from the scores feed; score, half score and count are
    replaced where the feed's value is non-null and non-zero.  Feeds hold one
    row per id (de-duplicated at ingestion, ``plans.run.prepare``)."""
    names = ["cleanliness", "comfort", "facilities", "free_wifi", "location", "staff", "value_for_money"]
    s = scores.select(
        prefixed_id("id").alias("id"),
        F.struct(*[F.col(f"breakdown.{n}.score").cast("float").alias(n) for n in names]).alias("review_scores"),
        F.col("score").cast("float").alias("review_score_new"),
        F.round(F.col("score") / 2, 1).cast("decimal(12,2)").alias("review_score_general_new"),
        F.col("number_of_reviews").cast("int").alias("number_of_review_new"))
    out = enrich_left(df, s, "id")
    out = out.withColumns({
        "review_score": override_if("review_score_new", "review_score"),
        "review_score_general": override_if("review_score_general_new", "review_score_general"),
        "number_of_review": override_if("number_of_review_new", "number_of_review"),
    })
    return out.drop("review_score_new", "review_score_general_new", "number_of_review_new")


# D18 (U4)
def property_flags(df: DataFrame, keyword_lists: dict) -> DataFrame:
    """Keyword flags over normalised text blobs, policy flags, and the
    ``property_flags`` struct.  Every flag is a non-null boolean."""
    # normalising drops characters one by one, so it distributes over the
    # space-joined parts: each part (the description is the long one) is
    # normalised once and the three text blobs are joined afterwards
    parts = {
        "name": normalize_text(F.col("property_name")),
        "desc": normalize_text(localized(F.col("description.text"), "en-us")),
        "type": normalize_text(F.col("property_type")),
        "amen": normalize_text(F.array_join("amenities", " ")),      # null amenities are no part at all
        "other": normalize_text(F.col("policy.other_policy")),
    }
    df = df.withColumns({f"_n_{k}": v for k, v in parts.items()})
    n = lambda *ks: F.concat_ws(" ", *[F.col(f"_n_{k}") for k in ks])
    blobs = {
        "c3": n("name", "type", "amen"),
        "c4": n("name", "desc", "type", "amen"),
        "c5": n("name", "desc", "type", "amen", "other"),
        "name": F.col("_n_name"),
    }
    target = {"is_all_inclusive_type": "c5", "is_hotel_type": "c3", "is_promoting_escort": "name"}
    df = df.withColumns({f"_{k}": v for k, v in blobs.items()})
    # each blob is scanned once for the keywords of all its flags
    of_blob = {b: [f for f in keyword_lists if target.get(f, "c4") == b] for b in blobs}
    df = df.withColumns({f"_found_{b}": keyword_lists_found(F.col(f"_{b}"), [keyword_lists[f] for f in fs]) for b, fs in of_blob.items() if fs})
    flags = {f: F.array_contains(f"_found_{target.get(f, 'c4')}", of_blob[target.get(f, "c4")].index(f)) for f in keyword_lists}
    if "is_business_travel" in flags and "is_work_friendly" in flags:
        flags["is_business_travel"] = flags["is_work_friendly"] | flags["is_business_travel"]
    pol = F.col("policy")
    flags.update({
        "is_pet_friendly": flag(pol["is_pet_friendly"]),
        "has_cancellation_policy": flag(pol["cancellation_policy"].isNotNull()),
        "is_other_type": flag(F.col("property_type_category") == rules.OTHER_CATEGORY),
        "adult_only": flag(pol["adult_only"]),
        "is_preferred": flag(F.col("is_preferred")),
    })
    df = df.withColumn("property_flags", F.struct(*[v.alias(k) for k, v in flags.items()]))
    return df.drop(*[f"_{k}" for k in blobs], *[f"_found_{k}" for k in blobs], *[f"_n_{k}" for k in parts])


# D19
def chain_and_brand(df: DataFrame, chains: DataFrame) -> DataFrame:
    """Chain and brand of the listing's first brand id."""
    flat = chains.select(F.col("id").cast("long").alias("chain_id"), F.col("name").cast("string").alias("chain_name"),
                         F.explode("brands").alias("b"))
    flat = flat.select("chain_id", "chain_name", F.col("b.id").cast("long").alias("brand_id"),
                       F.col("b.name").cast("string").alias("brand_name"))
    flat = dedupe(flat, "brand_id", ["chain_id"], keep="first")       # one chain per brand: row count kept
    out = join_first_element(df, "brands", flat, "brand_id")
    out = out.withColumn("chain_and_brand", F.struct("chain_id", "chain_name", "brand_id", "brand_name"))
    return out.drop("chain_id", "chain_name", "brand_id", "brand_name")


# D20
def commission_and_meal_plan(df: DataFrame, search: DataFrame) -> DataFrame:
    """Commission and products from search (one row per id); meals title-cased
    and de-duplicated, null when there are none.  Products without meals are
    ignored."""
    s = search.select(prefixed_id("id").alias("id"), "commission", "products")
    return meal_plan(enrich_left(df, s, "id"))


def meal_plan(df: DataFrame) -> DataFrame:
    """Meal plan from the joined ``products`` column."""
    meals = F.col("products.policies.meal_plan.meals")
    return df.withColumn("meal_plan", empty_to_null(flat_distinct(meals, F.initcap)))
