"""Nested feed shapes built from the driver's flat tables.

The driver has no hotel feed, so each feed of the schemas in
``feedlake.schemas`` is derived from one table with deterministic rules,
inside each row (arrays from ``sequence`` / ``array``), plus small dimension
joins.  Nothing is grouped, so no feed row gathers an unbounded set of rows.
The SQL oracles re-derive the same values straight from the flat tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.catalog import table
from feedlake.operators import lookup_left

NUL = "\x00"


def _pick(values, idx):
    """element_at(array(values), idx + 1) with null entries allowed."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), idx + 1)


def _arr(values) -> str:
    return "array(" + ", ".join("CAST(NULL AS STRING)" if v is None else f"'{v}'" for v in values) + ")"


_SUFFIXES = ["hostel", "flat", "suites", "house", "dormitory", "lodge", "condo"]
_COUNTRIES = [" af", "am ", "xa", " eu", "mi", "as"]

# The listing document of one part row, as Spark SQL expressions (parsed once
# on the JVM side instead of being assembled call by call from Python).
_ROOM = """named_struct(
    'id', CAST(p_partkey * 10 + i AS BIGINT),
    'name', map('en-us', concat('Room ', i), 'fr', concat('Chambre ', i),
                'es', IF(i = 1, 'Habitacion', CAST(NULL AS STRING)), 'de', concat('Zimmer ', i)),
    'room_type', CAST((p_size + i) % 5 AS BIGINT),
    'size', IF(i != 2, CAST(p_size * i AS DOUBLE) / 2, CAST(NULL AS DOUBLE)),
    'attributes', array('wifi', concat('floor-', i)),
    'number_of_rooms', named_struct('bedrooms', (p_size + i) % 3, 'bathrooms', IF(i != 3, 1, CAST(NULL AS INT)),
                                    'living_rooms', i % 2),
    'maximum_occupancy', named_struct('adults', 2, 'children', i - 1,
                                      'total_guests', IF(i != 2, i + p_size % 6, CAST(NULL AS INT))),
    'cribs_and_extra_beds', named_struct('are_allowed', i % 2 = 0),
    'bed_options', array(named_struct('bed_configurations', array(named_struct('configuration', array(
        named_struct('bed_type', CAST((p_size + i) % 4 AS BIGINT), 'number_of_beds', i),
        named_struct('bed_type', CAST(1 AS BIGINT), 'number_of_beds', 1)))))))"""

_NAME_EN = f"concat(p_name, ' ', element_at({_arr(_SUFFIXES)}, p_size % 7 + 1))"

LISTING_EXPRS = [
    "p_partkey AS id",
    f"""map('en-us', IF(p_size <= 45, {_NAME_EN}, CAST(NULL AS STRING)), 'fr', concat('fr ', {_NAME_EN}),
            'es', IF(p_size % 2 = 0, concat('es ', {_NAME_EN}), CAST(NULL AS STRING)),
            'de', concat('de ', {_NAME_EN})) AS name""",
    "p_type AS accommodation_type",
    "IF(p_size <= 40, 'EUR', CAST(NULL AS STRING)) AS currency",
    """IF(p_size >= 3, concat('https://feed.example/hotel/', p_partkey, '.html?aid=', p_size, '&label=x'),
          CAST(NULL AS STRING)) AS url""",
    "array(CAST(regexp_extract(p_brand, '#(\\\\d+)', 1) AS BIGINT)) AS brands",
    "array(p_size % 5, p_size % 7) AS themes",
    """IF(p_size % 17 != 5, array(named_struct('id', CAST(p_size % 25 AS BIGINT)), named_struct('id', CAST((p_size + 7) % 25 AS BIGINT))),
          CAST(NULL AS ARRAY<STRUCT<id: BIGINT>>)) AS facilities""",
    f"""named_struct(
        'country', element_at({_arr(_COUNTRIES)}, p_size % 6 + 1),
        'city', CAST(p_size % 30 AS BIGINT),
        'postal_code', IF(p_size % 4 = 0, '', concat('Z', p_size)),
        'coordinates', named_struct('latitude', IF(p_size % 7 != 0, p_retailprice / 50, CAST(NULL AS DOUBLE)),
                                    'longitude', p_size * 1.5D),
        'address', map('en-us', concat(' ', p_size, ' Main St', char(0), ' '), 'fr', concat(p_size, ' rue Principale'),
                       'de', IF(p_size % 2 = 0, concat(p_size, ' Hauptstr.'), CAST(NULL AS STRING)))) AS location""",
    """named_struct('number_of_reviews', IF(p_size % 10 != 0, p_size * 3, CAST(NULL AS INT)),
                    'stars', p_retailprice / 400,
                    'review_score', IF(p_size % 9 != 0, p_retailprice / 210, CAST(NULL AS DOUBLE)),
                    'preferred', IF(p_size % 3 != 0, p_size > 25, CAST(NULL AS BOOLEAN))) AS rating""",
    """named_struct('checkin_from', concat(lpad(CAST(p_size % 24 AS STRING), 2, '0'), ':00'), 'checkin_to', '23:00',
                    'checkout_from', '07:00', 'checkout_to', '11:00') AS checkin_checkout_times""",
    """named_struct(
        'text', IF(_dlang IS NOT NULL, map(IF(_dlang = 'en', 'en-us', _dlang), concat(_dtext, char(0))),
                   CAST(NULL AS MAP<STRING, STRING>)),
        'important_information', map('en-us', concat('  Quiet hours ', p_size, ' '),
                                     'fr', IF(p_size % 3 = 0, 'Calme', CAST(NULL AS STRING))),
        'license_numbers', IF(p_size % 3 = 0, array(concat('LIC-', p_partkey), concat('REG-', p_size)),
                              CAST(NULL AS ARRAY<STRING>))) AS description""",
    f"""named_struct(
        'minimum_guest_age', p_size % 20,
        'minimum_checkin_age', IF(p_size > 10, 18, CAST(NULL AS INT)),
        'maximum_checkin_age', IF(p_size > 40, 99, CAST(NULL AS INT)),
        'pets', named_struct('allowed', element_at({_arr(["yes", "no", "upon_request"])}, p_size % 3 + 1),
                             'charge_mode', IF(p_size % 2 = 0, 'may_apply', CAST(NULL AS STRING))),
        'cots_and_extra_beds', IF(p_size % 5 != 0, array(named_struct(
            'age', named_struct('from', p_size % 3, 'to', p_size % 13),
            'price', IF(p_size % 2 = 1, p_retailprice / 100, CAST(NULL AS DOUBLE)), 'type', 'crib')),
            CAST(NULL AS ARRAY<STRUCT<age: STRUCT<`from`: INT, `to`: INT>, price: DOUBLE, type: STRING>>))
      ) AS policies""",
    """named_struct('methods', named_struct('cash', IF(p_size % 4 != 0, p_size % 2 = 0, CAST(NULL AS BOOLEAN)))) AS payment""",
    """IF(p_size % 4 > 0, transform(sequence(1, p_size % 4), i -> named_struct(
          'url', named_struct('standard', IF(i != 3, concat('https://img.example/', p_partkey, '/', i, '.jpg'),
                                             CAST(NULL AS STRING))),
          'main_photo', i = 2)),
        array()) AS photos""",
    f"IF(p_size % 6 != 0, transform(sequence(1, p_size % 3 + 1), i -> {_ROOM}), array()) AS rooms",
]


def listing_feed(spark, d) -> DataFrame:
    """Listing documents (schemas.DETAILS) from part, with the description of
    the document sharing the part's key."""
    part = table(spark, d, "part")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("p_partkey"), F.col("lang").alias("_dlang"),
                                               F.col("text").alias("_dtext"))
    from feedlake import schemas
    out = part.join(docs, "p_partkey", "left").selectExpr(*LISTING_EXPRS)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.DETAILS.fields])


def scores_feed(spark, d) -> DataFrame:
    lab = table(spark, d, "labels")
    q, t = F.col("quality"), F.col("toxic")
    sc = lambda c: F.struct(c.cast("double").alias("score"))
    return lab.select(
        F.col("doc_id").alias("id"),
        F.when(t == 1, F.lit(0.0)).otherwise(q * 6.5 + 2.25).alias("score"),
        (q * 10 + t).cast("int").alias("number_of_reviews"),
        F.struct(sc(q * 8.0).alias("cleanliness"), sc(t * 2.0).alias("comfort"), sc(F.lit(7.5)).alias("facilities"),
                 sc(F.lit(6.0)).alias("free_wifi"), sc(q + 5.5).alias("location"), sc(F.lit(9.0)).alias("staff"),
                 sc(F.lit(8.25)).alias("value_for_money")).alias("breakdown"))


def reviews_feed(spark, d) -> DataFrame:
    conv = table(spark, d, "conversations")
    # listing id = conv_id * 25, so part of the reviews belong to no listing (orphans)
    return conv.select((F.col("conv_id") * 25).alias("id"), F.array(F.struct(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.when(F.col("role") == "user", F.lit("en")).otherwise(F.lit("fr")).alias("language"),
        F.col("turn").cast("double").alias("score"), F.col("text").alias("summary"),
        F.lit(None).cast("string").alias("negative"), F.lit(None).cast("string").alias("positive"),
        F.col("role").alias("reviewer"), F.lit("2024-01-01").alias("date"))).alias("reviews"))


def _meals(values):
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def search_feed(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    m1 = (F.when(pr == "1-URGENT", _meals(["breakfast"])).when(pr == "2-HIGH", _meals(["breakfast", "dinner"]))
          .when(pr == "4-NOT SPECIFIED", _meals([])).when(pr == "5-LOW", _meals(["lunch"])))
    m2 = F.when(st == "F", _meals(["dinner", "BREAKFAST"]))
    prod = lambda m: F.struct(F.struct(F.struct(m.alias("meals")).alias("meal_plan")).alias("policies"))
    base = F.concat(F.lit("https://book.example/h/"), F.col("o_orderkey").cast("string"))
    return o.select(
        F.col("o_orderkey").alias("id"), F.round(F.col("o_totalprice") / 10000, 2).alias("commission"),
        F.when(st != "P", F.concat(base, F.lit("?checkin="), day.cast("string"), F.lit("&checkout="),
                                   F.date_add(day, 3).cast("string"), F.lit("&group=2"))).otherwise(base)
        .alias("deep_link_url"),
        F.struct(F.when(pr != "5-LOW", F.col("o_totalprice")).alias("book")).alias("price"),
        F.array(prod(m1), prod(m2)).alias("products"))


def stored_prices(spark, d) -> DataFrame:
    o = table(spark, d, "orders").filter(F.col("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
    return o.select(F.concat(F.lit("BC-"), F.col("o_orderkey").cast("string")).alias("id"),
                    F.col("o_orderkey").alias("feed_provider_id"),
                    F.when(F.col("o_orderstatus") == "F", F.round(F.col("o_totalprice") / 4, 2))
                    .otherwise(F.lit(0.0)).alias("usd_price"))


def chains_feed(spark, d) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    nr = lookup_left(n, r.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return nr.select(F.col("n_regionkey").cast("long").alias("id"), F.col("r_name").alias("name"),
                     F.array(F.struct(F.col("n_nationkey").cast("long").alias("id"),
                                      F.col("n_name").alias("name"))).alias("brands"))


def city_map(spark, d) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("city_code"),
                                            F.initcap("n_name").alias("city"))


def country_map(spark, d) -> DataFrame:
    r = table(spark, d, "region")
    return r.select(F.upper(F.substring("r_name", 1, 2)).alias("Code"),
                    F.when(F.col("r_name") == "AMERICA", F.lit("United States")).otherwise(F.initcap("r_name")).alias("Name"))


def location_state(spark, d) -> DataFrame:
    c = table(spark, d, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    return c.select(F.concat(F.lit("BC-"), F.col("c_custkey").cast("string")).alias("id"),
                    F.concat(F.lit("LOC-"), F.col("c_custkey").cast("string")).alias("location_id"),
                    F.array(F.lit("world"), F.col("c_mktsegment")).alias("parent_path"),
                    F.lit("existing").alias("categories"),
                    F.concat(F.lit("State "), F.col("c_nationkey").cast("string")).alias("state"),
                    F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state_abbr"))


def assigned_locations(spark, d) -> DataFrame:
    c = table(spark, d, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"))
    return c.select(F.concat(F.lit("BC-"), F.col("c_custkey").cast("string")).alias("id"),
                    F.concat(F.lit("NEW-"), F.col("c_custkey").cast("string")).alias("location_id"),
                    F.array(F.lit("world")).alias("parent_path"), F.col("c_mktsegment").alias("categories"),
                    F.when(F.col("c_acctbal") > 3000, F.concat(F.lit("State "), F.col("c_nationkey").cast("string")))
                    .otherwise(F.lit("")).alias("state"),
                    F.when(F.col("c_acctbal") > 0, F.concat(F.lit("S"), F.col("c_nationkey").cast("string")))
                    .alias("state_abbr"))


def reference(spark):
    from feedlake import rules
    from feedlake.sources import load_reference
    return load_reference(
        spark, themes=rules.THEMES, facilities=rules.FACILITIES, facility_types=rules.FACILITY_TYPES,
        bed_types=rules.BED_TYPES, amenity_synonyms=rules.AMENITY_SYNONYMS, locales=rules.LOCALES,
        keyword_lists=rules.KEYWORD_LISTS, property_types=rules.PART_TYPE_TO_PROPERTY,
        type_categories=rules.PROPERTY_CATEGORY, category_rules=rules.CATEGORY_RULES)
