"""Golden cases (FIXTURES section 2) for the column functions and listing steps."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from feedlake import rules, schemas
from feedlake.functions import (
    add_tag, first_nonblank, join_present, map_lookup, override_if, query_param, remap_code, safe_date, slugify,
)
from feedlake.plans import listing as P
from feedlake.plans import price as PR


def one(spark, col, data="x", schema="v string"):
    return spark.createDataFrame([(data,)], schema).select(col.alias("r")).first()["r"]


def test_slugify(spark):
    assert one(spark, slugify(F.lit("  Hôtel & Spa! "))) == "h-tel-spa-"
    assert one(spark, slugify(F.lit("Hôtel"), per_char=True)) == "h-tel"


def test_remap_code(spark):
    df = spark.createDataFrame([(" us ",), ("xa",), (None,)], "c string")
    got = [r[0] for r in df.select(remap_code("c", rules.COUNTRY_REMAP)).collect()]
    assert got == ["US", "GE", None]


def test_map_lookup_drops_unknown(spark):
    df = spark.createDataFrame([([1, 2, 99],)], "a array<int>")
    assert df.select(map_lookup("a", {1: "A", 2: "B"}, key_type=None)).first()[0] == ["A", "B"]


def test_override(spark):
    df = spark.createDataFrame([(0.0, 5.0), (None, 6.0), (7.0, 8.0)], "n double, o double")
    assert [r[0] for r in df.select(override_if("n", "o")).collect()] == [5.0, 6.0, 7.0]


def test_query_param_and_date(spark):
    df = spark.createDataFrame([("https://x?checkin=2025-02-18&x=1",), ("https://x?y=1",), (None,)], "u string")
    got = df.select(safe_date(query_param("u", "checkin"))).collect()
    import datetime
    assert [r[0] for r in got] == [datetime.date(2025, 2, 18), None, None]


def test_display(spark):
    df = spark.createDataFrame([(None, "", "TX", "USA", "US")], "city string, state string, abbr string, country string, cc string")
    got = df.select(join_present(", ", first_nonblank("city"), first_nonblank("state", "abbr"),
                                 first_nonblank("country", "cc"))).first()[0]
    assert got == "TX, USA"


def test_add_tag(spark):
    df = spark.createDataFrame([(["Pool"], 0), (["Pool", "Child Friendly"], 0), (["Pool"], 5)], "a array<string>, age int")
    got = [r[0] for r in df.select(add_tag("a", "Child Friendly", F.col("age") == 0)).collect()]
    assert got == [["Pool", "Child Friendly"], ["Pool", "Child Friendly"], ["Pool"]]


def listing_row(spark, **kw):
    base = {f.name: None for f in schemas.DETAILS.fields}
    base["id"] = 7
    base.update(kw)
    return spark.createDataFrame([base], schemas.DETAILS)


def test_init_keys(spark):
    r = P.init_keys(listing_row(spark)).first()
    assert (r["id"], r["feed_provider_id"], r["feed"], r["currency"], r["owner_id"]) == ("BC-7", 7, 11, "USD", None)


def test_rating(spark):
    df = listing_row(spark, rating={"number_of_reviews": None, "stars": 4.5, "review_score": 8.456, "preferred": None})
    r = P.rating_and_score(df).first()
    import decimal
    assert r["number_of_review"] == 0 and r["star_rating"] == 4
    assert abs(r["review_score"] - 8.46) < 1e-6
    assert r["review_score_general"] == decimal.Decimal("4.23")
    assert r["is_preferred"] is False


def test_room_type(spark):
    df = spark.createDataFrame([("Cosy Hostel",), ("Sea Flat",), ("Inn",)], "property_name string")
    assert [r[0] for r in P.room_type(df).select("room_type").collect()] == ["Shared room", "Shared space", None]


def test_url_and_licence(spark):
    df = spark.createDataFrame([Row(url="https://x/y?aid=9&z=1", description=None), Row(url=None, description=None)],
                               "url string, description struct<license_numbers: array<string>>")
    got = [r[0] for r in P.url_and_licence(df).select("feed_provider_url").collect()]
    assert got == ["https://x/y?aid=affiliate_id", None]


def _pol(spark, **policies):
    p = {"minimum_guest_age": None, "minimum_checkin_age": None, "maximum_checkin_age": None,
         "pets": None, "cots_and_extra_beds": None}
    p.update(policies)
    df = listing_row(spark, policies=p)
    return P.policies(df.withColumn("amenity_categories", F.array(F.lit("Pool")))).first()


def test_policies(spark):
    r = _pol(spark, pets={"allowed": "upon_request", "charge_mode": "may_apply"})
    assert r["policy"]["pet_policy"] == "Pets are allowed upon request and may apply"
    r = _pol(spark, pets={"allowed": "upon_request", "charge_mode": None})
    assert r["policy"]["pet_policy"] == "Pets are allowed upon request."
    r = _pol(spark, cots_and_extra_beds=[{"age": {"from": 0, "to": 2}, "price": None, "type": "crib"}])
    assert r["policy"]["infant_policy"] == "Cots are available from age 0 to 2 without price in crib"
    r = _pol(spark, cots_and_extra_beds=[])
    assert r["policy"]["infant_policy"] is None
    r = _pol(spark, cots_and_extra_beds=[{"age": {"from": 3, "to": 12}, "price": None, "type": "crib"}])
    assert r["policy"]["child_policy"] == "Children aged 12 years and above are considered adults at this property."
    r = _pol(spark, minimum_checkin_age=18)
    assert r["policy"]["checkin_policy"] == "The minimum age for check-in is 18"
    r = _pol(spark)
    assert r["policy"]["checkin_policy"] == ""
    r = _pol(spark, minimum_guest_age=0)
    assert r["amenity_categories"] == ["Pool", "Child Friendly"]


def test_photos(spark):
    ph = lambda u, m=False: {"url": {"standard": u}, "main_photo": m}
    rows = [listing_row(spark, photos=[ph("a"), ph("b", True)]), listing_row(spark, photos=[ph("a"), ph("b")]),
            listing_row(spark, photos=[])]
    got = [P.hotel_photos(r).select("images", "feature_image").first() for r in rows]
    assert [tuple(g) for g in got] == [(["a", "b"], "b"), (["a", "b"], "a"), ([], None)]


def test_rooms(spark):
    room = lambda size, bed, guests: {"size": size, "number_of_rooms": {"bedrooms": bed},
                                      "maximum_occupancy": {"total_guests": guests}}
    r = P.rooms(listing_row(spark, rooms=[room(10.0, 3, 2)])).first()
    assert r["room_size_sqft"] == 107.64
    r = P.rooms(listing_row(spark, rooms=[room(None, 0, 4)])).first()
    assert r["bedroom_count"] == 1
    r = P.rooms(listing_row(spark, rooms=[room(None, 0, 6)])).first()
    assert r["bedroom_count"] is None and r["max_occupancy"] == 6


def test_meal_plan(spark):
    prod = lambda meals: {"policies": {"meal_plan": {"meals": meals}}}
    search = spark.createDataFrame(
        [(1, [prod(["breakfast"]), prod(["breakfast", "dinner"])]), (2, [prod(["breakfast"]), prod(None)]),
         (3, [prod([])])], "id long, products array<struct<policies:struct<meal_plan:struct<meals:array<string>>>>>")
    search = search.withColumn("commission", F.lit(None).cast("double"))
    df = spark.createDataFrame([("BC-1",), ("BC-2",), ("BC-3",)], "id string")
    got = {r["id"]: r["meal_plan"] for r in P.commission_and_meal_plan(df, search).collect()}
    assert got == {"BC-1": ["Breakfast", "Dinner"], "BC-2": ["Breakfast"], "BC-3": None}


def test_usd_price(spark):
    search = spark.createDataFrame([(1, 100.0), (2, None)], "id long, book double").select(
        "id", F.struct("book").alias("price"), F.lit("x").alias("deep_link_url"))
    df = spark.createDataFrame([("BC-1", 1, 11, "US"), ("BC-2", 2, 11, "US")],
                               "id string, feed_provider_id long, feed int, country_code string")
    out, _ = PR.usd_price(df, search)
    assert {r["id"]: r["usd_price"] for r in out.collect()} == {"BC-1": 33.33, "BC-2": 0.0}
    stored = spark.createDataFrame([("BC-1", 1, 50.0), ("BC-2", 2, 0.0)], schemas.STORED_PRICE)
    search2 = spark.createDataFrame([(1, 120.0), (2, 120.0)], "id long, book double").select(
        "id", F.struct("book").alias("price"), F.lit("https://b?checkin=2025-02-18&checkout=2025-02-21").alias("deep_link_url"))
    out, hist = PR.usd_price(df, search2, stored)
    assert {r["id"]: r["usd_price"] for r in out.collect()} == {"BC-1": 50.0, "BC-2": 40.0}
    h = hist.collect()
    assert [r["property_id"] for r in h] == ["BC-2"] and str(h[0]["checkin"]) == "2025-02-18"


def test_locale_code_and_language(spark):
    from feedlake.plans.localize import language_name, localize_codes
    df = spark.createDataFrame([(["en-us", "en-gb", "fr", "es"],)], "languages array<string>")
    out = language_name(localize_codes(df), rules.LOCALES).select("locale_code", "language").collect()
    assert [tuple(r) for r in out] == [("en", "English"), ("en", "English"), ("fr", "French"), ("es", None)]


def test_facility_fallback(spark):
    from feedlake.sources import lookup_frame
    rows = lookup_frame(spark, {1: {"name": {"fallback": "Pool"}}, 2: {"name": {}}}, ["fr"], "facility_id").collect()
    assert [(r["facility_id"], r["language_code"], r["name"]) for r in rows] == [("1", "fr", "Pool")]


def test_reviews_orphans_dropped(spark):
    from feedlake.plans.reviews import reviews
    owners = spark.createDataFrame([("BC-1", 1, "US")], "id string, feed_provider_id long, country_code string")
    feed = spark.createDataFrame([(1, [("r1", "en")]), (9, [("r9", "en")])],
                                 "id long, reviews array<struct<id:string, language:string>>")
    out = reviews(owners, feed).collect()
    assert [(r["id"], r["property_id"], r["feed"]) for r in out] == [("r1", "BC-1", 11)]


def test_location_finish_country_display_and_name_fill(spark):
    from feedlake.plans.location import location_finish
    loc = {"country": "us", "city": 5, "postal_code": "", "coordinates": {"latitude": 1.5, "longitude": 2.0},
           "address": None}
    df = listing_row(spark, location=loc).select(
        F.lit("BC-7").alias("id"), "location", F.lit("US").alias("country_code"),
        *[F.lit(None).cast("string").alias(c) for c in ("location_id", "categories", "state", "state_abbr")],
        F.lit(None).cast("array<string>").alias("parent_path"),
        F.lit(None).cast("string").alias("property_name"), F.lit("Hotel").alias("property_type"))
    cities = spark.createDataFrame([(5, "")], schemas.CITY_MAP)
    countries = spark.createDataFrame([("US", "United States")], schemas.COUNTRY_MAP)
    assigned = spark.createDataFrame([("BC-7", "L1", ["world"], "c", "", "TX")], schemas.LOCATION)
    out, new_rows = location_finish(df, cities, countries, assigned)
    r = P.property_name_fill(out).first()
    assert (r["latlon"], r["zip_code"], r["country"], r["display"]) == ("1.5,2.0", None, "USA", "TX, USA")
    assert r["location_id"] == "L1" and r["property_name"] == "Hotel in TX, USA"
    assert new_rows.count() == 1
    empty = out.withColumn("country", F.lit(None).cast("string")).withColumn("country_code", F.lit(""))
    blank = empty.withColumn("state_abbr", F.lit(None).cast("string"))
    from feedlake.functions import blank_to_null, first_nonblank, join_present
    d = blank.select(blank_to_null(join_present(", ", first_nonblank("city"), first_nonblank("state", "state_abbr"),
                                                first_nonblank("country", "country_code")))).first()[0]
    assert d is None
