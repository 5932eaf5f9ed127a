"""Domain-pipeline queries (D1-D35) on feeds derived from the driver tables.

Spark side: adapter feed -> plan functions of ``feedlake.plans``.
SQL side: the same answer re-derived straight from the flat tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import rules
from feedlake.catalog import RUN_DATE, RUN_TS, query, sql_initcap, sql_round, sql_row_key
from feedlake.catalog import adapters as A
from feedlake.functions import sorted_text
from feedlake.plans import listing as P
from feedlake.plans import localize as LZ
from feedlake.plans import location as LOC
from feedlake.plans import price as PR
from feedlake.plans.reviews import reviews


# ------------------------------------------------------------ SQL building

def _lst(vals) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in vals) + "]"


def _case(mapping: dict, expr: str, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default} END)"


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(cols)}))"


SUFFIXES = ["hostel", "flat", "suites", "house", "dormitory", "lodge", "condo"]
COUNTRIES = [" af", "am ", "xa", " eu", "mi", "as"]

# Per-listing flat columns derived from part (+ documents): the SQL twin of
# adapters.listing_feed followed by D1/D2.
BASE = f"""
base AS (
  SELECT p.p_partkey AS k, p.p_size AS s, p.p_retailprice AS pr, p.p_type AS ptype,
         CAST(regexp_extract(p.p_brand, '#(\\d+)', 1) AS BIGINT) AS brand,
         p.p_name || ' ' || ({_lst(SUFFIXES)})[p.p_size % 7 + 1] AS name_en0,
         d.lang AS dlang, d.text AS dtext
  FROM part p LEFT JOIN documents d ON d.doc_id = p.p_partkey),
b0 AS (
  SELECT *, 'BC-' || CAST(k AS VARCHAR) AS id, CASE WHEN s <= 45 THEN name_en0 END AS property_name,
         upper(trim(({_lst(COUNTRIES)})[s % 6 + 1])) AS cc0,
         {_case(rules.PART_TYPE_TO_PROPERTY, "ptype")} AS property_type
  FROM base),
l AS (
  SELECT *, {_case(rules.COUNTRY_REMAP, "cc0", "cc0")} AS country_code,
         coalesce({_case(rules.PROPERTY_CATEGORY, "property_type")}, 'Other') AS property_type_category
  FROM b0)"""

THEMES_SQL = _values([(k, v["name"]["en-us"]) for k, v in rules.THEMES.items()], ["tid", "tname"])
FAC_EN_SQL = _values([(k, v["name"]["en-us"]) for k, v in rules.FACILITIES.items() if v["name"].get("en-us")],
                     ["fid", "fname"])
SYN_SQL = _values([(k, c) for k, v in rules.AMENITY_SYNONYMS.items() for c in (v if isinstance(v, list) else [v])],
                  ["slug", "category"])

# amenity names of each listing (facility ids s % 25 and (s + 7) % 25, in that order)
AMEN = f"""
am AS (
  SELECT l.k, f1.fname AS a1, f2.fname AS a2
  FROM l LEFT JOIN {FAC_EN_SQL} f1 ON f1.fid = l.s % 25 AND l.s % 17 <> 5
         LEFT JOIN {FAC_EN_SQL} f2 ON f2.fid = (l.s + 7) % 25 AND l.s % 17 <> 5),
amc AS (
  SELECT k, list_sort(list_distinct(list(category))) AS cats FROM (
    SELECT am.k, s.category FROM am JOIN {SYN_SQL} s ON s.slug = lower(regexp_replace(am.a1, '[^a-zA-Z0-9]', '-', 'g'))
    UNION ALL
    SELECT am.k, s.category FROM am JOIN {SYN_SQL} s ON s.slug = lower(regexp_replace(am.a2, '[^a-zA-Z0-9]', '-', 'g')))
  GROUP BY k)"""


def listing(spark, d):
    """Listing feed after D2 + D1 (keys, country code)."""
    return P.init_keys(P.country_code(A.listing_feed(spark, d)))


# ------------------------------------------------------------------ queries

@query("d_init_keys", f"""
WITH {BASE}
SELECT id, CAST(11 AS INTEGER) AS feed, k AS feed_provider_id,
       coalesce(CASE WHEN s <= 40 THEN 'EUR' END, 'USD') AS currency, CAST(NULL AS VARCHAR) AS owner_id,
       country_code,
       CASE WHEN s >= 3 THEN 'https://feed.example/hotel/' || CAST(k AS VARCHAR) || '.html?aid=affiliate_id' END AS feed_provider_url,
       CASE WHEN s % 3 = 0 THEN 'LIC-' || CAST(k AS VARCHAR) || ', REG-' || CAST(s AS VARCHAR) END AS license_number,
       s >= 3 AS published, CAST(1 AS INTEGER) AS min_stay,
       lpad(CAST(s % 24 AS VARCHAR), 2, '0') || ':00' AS checkin_from, '23:00' AS checkin_to, '07:00' AS checkout_from,
       '11:00' AS checkout_to, 'en-us,fr,es,de' AS languages
FROM l""")
def d_init_keys(spark, d):
    df = listing(spark, d).transform(P.url_and_licence).transform(P.is_published)
    df = df.transform(P.min_stay).transform(P.checkin_times)
    return df.select("id", "feed", "feed_provider_id", "currency", "owner_id", "country_code", "feed_provider_url",
                     "license_number", "published", "min_stay", "checkin_from", "checkin_to", "checkout_from",
                     "checkout_to", F.array_join("languages", ",").alias("languages"))


_RS = f"CAST(ROUND(CAST(coalesce(CASE WHEN s % 9 <> 0 THEN pr / 210 END, 0.0) AS DECIMAL(38,10)), 2) AS FLOAT)"
_RATING = f"""
rt AS (
  SELECT id, k, CAST(coalesce(CASE WHEN s % 10 <> 0 THEN s * 3 END, 0) AS INTEGER) AS number_of_review,
         CAST(coalesce(floor(pr / 400), 0) AS BIGINT) AS star_rating, {_RS} AS review_score,
         CAST(CAST(CASE WHEN {_RS} <> 0 THEN CAST({_RS} AS DOUBLE) / 2 ELSE 0 END AS DECIMAL(38,10)) AS DECIMAL(10,2))
           AS review_score_general,
         coalesce(CASE WHEN s % 3 <> 0 THEN s > 25 END, false) AS is_preferred
  FROM l)"""


@query("d_rating", f"WITH {BASE}, {_RATING} SELECT id, number_of_review, star_rating, review_score, "
                   f"review_score_general, is_preferred FROM rt")
def d_rating(spark, d):
    return listing(spark, d).transform(P.rating_and_score).select(
        "id", "number_of_review", "star_rating", "review_score", "review_score_general", "is_preferred")


_NORM = "lower(regexp_replace({x}, '[^a-zA-Z0-9\\s]', '', 'g'))"


def _contains_any_sql(expr, words):
    return "coalesce(" + " OR ".join(f"contains({expr}, '{w}')" for w in words) + ", false)"


@query("d_names", f"""
WITH {BASE}
SELECT id, property_name, lower(regexp_replace(trim(property_name), '[^a-zA-Z0-9]+', '-', 'g')) AS property_slug,
       DATE '{RUN_DATE}' AS updated_at,
       CASE WHEN regexp_matches(lower(property_name), '{"|".join(rules.SHARED_ROOM_KEYWORDS)}') THEN 'Shared room'
            WHEN regexp_matches(lower(property_name), '{"|".join(rules.SHARED_SPACE_KEYWORDS)}') THEN 'Shared space'
       END AS room_type,
       property_type, property_type_category,
       concat_ws(',', {", ".join(
           f"CASE WHEN {_contains_any_sql(_NORM.format(x="concat_ws(' ', property_name, property_type, property_type_category)"), ws)} THEN '{lab}' END"
           for lab, ws in rules.CATEGORY_RULES.items())}) AS property_type_categories
FROM l""")
def d_names(spark, d):
    ref = A.reference(spark)
    df = listing(spark, d).transform(P.property_name).transform(lambda x: P.property_slug(x, RUN_DATE))
    df = df.transform(lambda x: P.property_types(x, ref)).transform(P.room_type)
    return df.select("id", "property_name", "property_slug", "updated_at", "room_type", "property_type",
                     "property_type_category",
                     F.array_join("property_type_categories", ",").alias("property_type_categories"))


@query("d_amenities", f"""
WITH {BASE}, {AMEN}
SELECT l.id, concat_ws(',', t1.tname, t2.tname) AS themes,
       CASE WHEN l.s % 17 <> 5 THEN concat_ws(',', am.a1, am.a2) END AS amenities,
       array_to_string(coalesce(amc.cats, []), ',') AS amenity_categories
FROM l LEFT JOIN {THEMES_SQL} t1 ON t1.tid = l.s % 5 LEFT JOIN {THEMES_SQL} t2 ON t2.tid = l.s % 7
       LEFT JOIN am ON am.k = l.k LEFT JOIN amc ON amc.k = l.k""")
def d_amenities(spark, d):
    df = listing(spark, d).transform(lambda x: P.amenities(x, A.reference(spark)))
    return df.select("id", F.array_join("themes", ",").alias("themes"), F.array_join("amenities", ",").alias("amenities"),
                     sorted_text("amenity_categories").alias("amenity_categories"))


_POL = f"""
pol AS (
  SELECT l.*, s % 20 AS age, CASE WHEN s % 5 <> 0 THEN s % 3 END AS a_from, CASE WHEN s % 5 <> 0 THEN s % 13 END AS a_to,
         CASE WHEN s % 5 <> 0 AND s % 2 = 1 THEN pr / 100 END AS cot_price,
         (['yes', 'no', 'upon_request'])[s % 3 + 1] AS pets, CASE WHEN s % 2 = 0 THEN 'may_apply' END AS mode,
         CASE WHEN s % 4 <> 0 THEN s % 2 = 0 END AS cash
  FROM l)"""


@query("d_policies", f"""
WITH {BASE}, {AMEN}, {_POL}
SELECT pol.id,
       array_to_string(list_sort(CASE WHEN age = 0 THEN list_distinct(list_append(coalesce(amc.cats, []), 'Child Friendly'))
                                      ELSE coalesce(amc.cats, []) END), ',') AS amenity_categories,
       trim('  Quiet hours ' || CAST(s AS VARCHAR) || ' ') AS other_policy,
       CAST(NULL AS VARCHAR) AS cancellation_policy,
       coalesce(pets = 'yes', false) AS is_pet_friendly, coalesce(age >= 18, false) AS adult_only,
       CASE WHEN a_to IS NOT NULL AND a_to <= 2 AND a_from < a_to THEN
            'Cots are available from age ' || CAST(a_from AS VARCHAR) || ' to ' || CAST(a_to AS VARCHAR) ||
            CASE WHEN cot_price IS NOT NULL AND cot_price > 0 THEN ' with price ' || CAST(cot_price AS VARCHAR)
                 ELSE ' without price' END || ' in crib' END AS infant_policy,
       CASE WHEN a_to > 2 AND a_from < a_to THEN
            'Children aged ' || CAST(a_to AS VARCHAR) || ' years and above are considered adults at this property.' END AS child_policy,
       concat_ws(' and ', CASE WHEN s > 10 THEN 'The minimum age for check-in is 18' END,
                          CASE WHEN s > 40 THEN 'The maximum age for check-in is 99' END) AS checkin_policy,
       CASE pets WHEN 'yes' THEN 'Pets are allowed.'
                 WHEN 'upon_request' THEN 'Pets are allowed upon request' ||
                      CASE WHEN mode IS NOT NULL THEN ' and ' || replace(mode, '_', ' ') ELSE '.' END
                 WHEN 'no' THEN 'Pets are not allowed.' END AS pet_policy,
       CASE WHEN age >= 18 THEN 'Minimum guest age is ' || CAST(age AS VARCHAR) END AS adult_policy,
       CASE WHEN cash IS NOT NULL AND NOT cash THEN 'Credit Card Required' END AS payment_policy
FROM pol LEFT JOIN amc ON amc.k = pol.k""")
def d_policies(spark, d):
    df = listing(spark, d).transform(lambda x: P.amenities(x, A.reference(spark))).transform(P.policies)
    return df.select("id", sorted_text("amenity_categories").alias("amenity_categories"), "policy.*")


@query("d_photos", f"""
WITH {BASE}
SELECT id, CAST(CASE s % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS INTEGER) AS n_images,
       CASE s % 4 WHEN 0 THEN ''
                  WHEN 1 THEN 'https://img.example/' || CAST(k AS VARCHAR) || '/1.jpg'
                  ELSE 'https://img.example/' || CAST(k AS VARCHAR) || '/1.jpg,https://img.example/' || CAST(k AS VARCHAR) || '/2.jpg'
       END AS images,
       CASE WHEN s % 4 >= 2 THEN 'https://img.example/' || CAST(k AS VARCHAR) || '/2.jpg'
            WHEN s % 4 = 1 THEN 'https://img.example/' || CAST(k AS VARCHAR) || '/1.jpg' END AS feature_image
FROM l""")
def d_photos(spark, d):
    df = listing(spark, d).transform(P.hotel_photos)
    return df.select("id", F.size("images").alias("n_images"), F.array_join("images", ",").alias("images"),
                     "feature_image")


_ROOMS = """
rm AS (
  SELECT k, i, round(CAST(coalesce(CASE WHEN i <> 2 THEN (s * i) / 2.0 END, 0.0) * 10.76391 AS DECIMAL(38,10)), 2) AS sqft,
         coalesce(CASE WHEN i <> 2 THEN i + s % 6 END, 2, 0) AS occ,
         coalesce(CASE WHEN i <> 3 THEN 1 END, 0) AS bath, (s + i) % 3 AS bed0
  FROM (SELECT k, s, unnest(range(1, s % 3 + 2)) AS i FROM l WHERE s % 6 <> 0)),
rb AS (SELECT *, CASE WHEN bed0 = 0 THEN CASE WHEN occ < 5 THEN 1 END ELSE bed0 END AS bed FROM rm)"""


@query("d_rooms", f"""
WITH {BASE}, {_ROOMS},
agg AS (SELECT k, CAST(sum(bed) AS BIGINT) AS bedroom_count, CAST(sum(bath) AS BIGINT) AS bathroom_count,
               CAST(sum(occ) AS BIGINT) AS max_occupancy,
               {sql_round("avg(CAST(sqft AS DOUBLE))")} AS room_size_sqft,
               array_to_string(list_sort(list_distinct(list(bed))), ',') AS bedrooms
        FROM rb GROUP BY k)
SELECT l.id, bedroom_count, bathroom_count, max_occupancy, max_occupancy AS occupancy, room_size_sqft, bedrooms
FROM l LEFT JOIN agg ON agg.k = l.k""")
def d_rooms(spark, d):
    df = listing(spark, d).transform(P.rooms)
    return df.select("id", "bedroom_count", "bathroom_count", "max_occupancy", "occupancy", "room_size_sqft",
                     sorted_text("bedrooms").alias("bedrooms"))


@query("d_review_scores", f"""
WITH {BASE}, {_RATING},
sc AS (SELECT doc_id, CAST(CASE WHEN toxic = 1 THEN 0.0 ELSE quality * 6.5 + 2.25 END AS FLOAT) AS new_score,
              CAST(ROUND(CAST((CASE WHEN toxic = 1 THEN 0.0 ELSE quality * 6.5 + 2.25 END) / 2 AS DECIMAL(38,10)), 1)
                   AS DECIMAL(12,2)) AS new_general,
              CAST(quality * 10 + toxic AS INTEGER) AS new_count, CAST(quality * 8.0 AS FLOAT) AS cleanliness,
              CAST(toxic * 2.0 AS FLOAT) AS comfort, CAST(7.5 AS FLOAT) AS facilities, CAST(6.0 AS FLOAT) AS free_wifi,
              CAST(quality + 5.5 AS FLOAT) AS location, CAST(9.0 AS FLOAT) AS staff, CAST(8.25 AS FLOAT) AS value_for_money
       FROM labels)
SELECT rt.id, coalesce(CASE WHEN new_score <> 0 THEN new_score END, review_score) AS review_score,
       CAST(coalesce(CASE WHEN new_general <> 0 THEN new_general END, review_score_general) AS DECIMAL(12,2)) AS review_score_general,
       coalesce(CASE WHEN new_count <> 0 THEN new_count END, number_of_review) AS number_of_review,
       cleanliness, comfort, facilities, free_wifi, location, staff, value_for_money
FROM rt LEFT JOIN sc ON sc.doc_id = rt.k""")
def d_review_scores(spark, d):
    df = listing(spark, d).transform(P.rating_and_score)
    df = P.review_scores(df, A.scores_feed(spark, d))
    return df.select("id", "review_score", "review_score_general", "number_of_review", "review_scores.*")


def _flag_sql(col_sql: str, words) -> str:
    return _contains_any_sql(col_sql, words)


_AM_TXT = "CASE WHEN pol.s % 17 <> 5 THEN concat_ws(' ', am.a1, am.a2) END"
_DESC = "CASE WHEN dlang = 'en' THEN dtext || chr(0) END"
_T3 = _NORM.format(x=f"concat_ws(' ', property_name, property_type, {_AM_TXT})")
_T4 = _NORM.format(x=f"concat_ws(' ', property_name, {_DESC}, property_type, {_AM_TXT})")
_T5 = _NORM.format(x=f"concat_ws(' ', property_name, {_DESC}, property_type, {_AM_TXT}, trim('  Quiet hours ' || CAST(s AS VARCHAR) || ' '))")
_TN = _NORM.format(x="property_name")
_KW = rules.KEYWORD_LISTS


@query("d_property_flags", f"""
WITH {BASE}, {AMEN}, {_POL}, {_RATING.replace("FROM l)", "FROM pol)").replace("rt AS", "rt2 AS")}
SELECT pol.id,
       {_flag_sql(_T5, _KW["is_all_inclusive_type"])} AS is_all_inclusive_type,
       {_flag_sql(_T3, _KW["is_hotel_type"])} AS is_hotel_type,
       {_flag_sql(_TN, _KW["is_promoting_escort"])} AS is_promoting_escort,
       {_flag_sql(_T4, _KW["is_work_friendly"])} AS is_work_friendly,
       {_flag_sql(_T4, _KW["is_work_friendly"])} OR {_flag_sql(_T4, _KW["is_business_travel"])} AS is_business_travel,
       coalesce(pets = 'yes', false) AS is_pet_friendly, false AS has_cancellation_policy,
       property_type_category = 'Other' AS is_other_type, coalesce(age >= 18, false) AS adult_only,
       rt2.is_preferred AS is_preferred
FROM pol LEFT JOIN am ON am.k = pol.k LEFT JOIN rt2 ON rt2.k = pol.k""")
def d_property_flags(spark, d):
    ref = A.reference(spark)
    df = listing(spark, d).transform(P.property_name).transform(P.rating_and_score)
    df = df.transform(lambda x: P.property_types(x, ref)).transform(lambda x: P.amenities(x, ref))
    df = df.transform(P.policies).transform(lambda x: P.property_flags(x, ref.keyword_lists))
    return df.select("id", "property_flags.*")


@query("d_chain_brand", f"""
WITH {BASE}
SELECT id, CAST(n_regionkey AS BIGINT) AS chain_id, r_name AS chain_name, CAST(n_nationkey AS BIGINT) AS brand_id,
       n_name AS brand_name
FROM l LEFT JOIN nation ON n_nationkey = brand LEFT JOIN region ON r_regionkey = n_regionkey""")
def d_chain_brand(spark, d):
    df = P.chain_and_brand(listing(spark, d), A.chains_feed(spark, d))
    return df.select("id", "chain_and_brand.*")


_MEALS = """
CASE o_orderpriority WHEN '1-URGENT' THEN ['breakfast'] WHEN '2-HIGH' THEN ['breakfast', 'dinner']
                     WHEN '4-NOT SPECIFIED' THEN [] WHEN '5-LOW' THEN ['lunch'] END"""


@query("d_meal_plan", f"""
WITH {BASE},
m AS (SELECT o_orderkey, round(o_totalprice / 10000, 2) AS commission,
             list_concat(coalesce({_MEALS}, []), coalesce(CASE WHEN o_orderstatus = 'F' THEN ['dinner', 'BREAKFAST'] END, [])) AS meals
      FROM orders)
SELECT l.id, {sql_round("o_totalprice_c", 2).replace("o_totalprice_c", "m.commission")} AS commission,
       nullif(array_to_string(list_sort(list_distinct(list_transform(m.meals, lambda x: upper(x[1:1]) || lower(x[2:])))), ','), '')
         AS meal_plan
FROM l LEFT JOIN m ON m.o_orderkey = l.k""")
def d_meal_plan(spark, d):
    df = P.commission_and_meal_plan(listing(spark, d), A.search_feed(spark, d))
    return df.select("id", F.round("commission", 2).alias("commission"), sorted_text("meal_plan").alias("meal_plan"))


_FRESH = f"""
fr AS (SELECT o_orderkey AS fk, coalesce(abs({sql_round("(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END) / 3")}), 0) AS f
       FROM orders)"""
_STORED = f"""
st AS (SELECT o_orderkey AS sk, CASE WHEN o_orderstatus = 'F' THEN {sql_round("o_totalprice / 4")} ELSE 0.0 END AS sp
       FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00')"""


@query("d_usd_price_first", f"""
WITH {BASE}, {_FRESH}
SELECT l.id, l.k AS feed_provider_id, coalesce({sql_round("fr.f")}, 0) AS usd_price FROM l LEFT JOIN fr ON fr.fk = l.k""")
def d_usd_price_first(spark, d):
    df, _ = PR.usd_price(listing(spark, d), A.search_feed(spark, d))
    return df.select("id", "feed_provider_id", "usd_price")


@query("d_usd_price_update", f"""
WITH {BASE}, {_FRESH}, {_STORED}
SELECT l.id, l.k AS feed_provider_id,
       coalesce({sql_round("CASE WHEN (st.sp IS NULL OR st.sp <= 0) AND fr.f >= 0 THEN fr.f ELSE st.sp END")}, 0) AS usd_price
FROM l LEFT JOIN fr ON fr.fk = l.k LEFT JOIN st ON st.sk = l.k""")
def d_usd_price_update(spark, d):
    df, _ = PR.usd_price(listing(spark, d), A.search_feed(spark, d), A.stored_prices(spark, d))
    return df.select("id", "feed_provider_id", "usd_price")


@query("d_price_history", f"""
WITH {BASE}, {_FRESH}, {_STORED},
h AS (
  SELECT l.id AS property_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price_book,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS checkin,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 3 END AS checkout, l.country_code
  FROM l JOIN fr ON fr.fk = l.k LEFT JOIN st ON st.sk = l.k JOIN orders ON o_orderkey = l.k
  WHERE (st.sp IS NULL OR st.sp <= 0) AND fr.f >= 0)
SELECT property_id, price_book, checkin, checkout, CAST(11 AS INTEGER) AS feed, country_code,
       {sql_row_key("property_id", "checkin", "checkout", f"epoch(TIMESTAMP '{RUN_TS}')::BIGINT")} AS id
FROM h""")
def d_price_history(spark, d):
    _, hist = PR.usd_price(listing(spark, d), A.search_feed(spark, d), A.stored_prices(spark, d), RUN_TS)
    return hist.select("property_id", F.col("price.book").alias("price_book"), "checkin", "checkout", "feed",
                       "country_code", "id")


@query("d_reviews", f"""
WITH {BASE}
SELECT CAST(c.conv_id AS VARCHAR) || '-' || CAST(c.turn AS VARCHAR) AS id, l.id AS property_id,
       CASE WHEN c.role = 'user' THEN 'en' ELSE 'fr' END AS language_code, CAST(c.turn AS DOUBLE) AS score,
       md5(c.text) AS summary_md5, c.role AS reviewer, '2024-01-01' AS review_date, l.country_code,
       CAST(11 AS INTEGER) AS feed
FROM conversations c JOIN l ON l.k = c.conv_id * 25""")
def d_reviews(spark, d):
    owners = listing(spark, d).select("id", "feed_provider_id", "country_code")
    out = reviews(owners, A.reviews_feed(spark, d))
    return out.select("id", "property_id", "language_code", "score", F.md5("summary").alias("summary_md5"),
                      "reviewer", "review_date", "country_code", "feed")


@query("d_location_begin", f"""
WITH {BASE}
SELECT id, coalesce(CASE WHEN s % 7 <> 0 THEN pr / 50 END, 0.0) AS lat, CAST(s * 1.5 AS DOUBLE) AS lon, country_code
FROM l WHERE id NOT IN (SELECT 'BC-' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def d_location_begin(spark, d):
    _, worklist = LOC.location_begin(A.listing_feed(spark, d), A.location_state(spark, d))
    return worklist


_LOCFIN = f"""
WITH {BASE},
ex AS (SELECT 'BC-' || CAST(c_custkey AS VARCHAR) AS cid, 'LOC-' || CAST(c_custkey AS VARCHAR) AS location_id,
              'world/' || c_mktsegment AS parent_path, 'existing' AS categories,
              'State ' || CAST(c_nationkey AS VARCHAR) AS state, 'S' || CAST(c_nationkey AS VARCHAR) AS state_abbr
       FROM customer WHERE c_mktsegment = 'MACHINERY'),
dl AS (SELECT 'BC-' || CAST(c_custkey AS VARCHAR) AS cid, 'NEW-' || CAST(c_custkey AS VARCHAR) AS location_id,
              'world' AS parent_path, c_mktsegment AS categories,
              CASE WHEN c_acctbal > 3000 THEN 'State ' || CAST(c_nationkey AS VARCHAR) ELSE '' END AS state,
              CASE WHEN c_acctbal > 0 THEN 'S' || CAST(c_nationkey AS VARCHAR) END AS state_abbr
       FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')),
cm AS (SELECT upper(substring(r_name, 1, 2)) AS code,
              CASE WHEN r_name = 'AMERICA' THEN 'United States' ELSE {sql_initcap("r_name")} END AS cname FROM region),
f AS (
  SELECT l.*, CASE WHEN s % 7 <> 0 THEN CAST(pr / 50 AS VARCHAR) || ',' || CAST(s * 1.5 AS VARCHAR) END AS latlon,
         CASE WHEN s % 4 = 0 THEN NULL ELSE 'Z' || CAST(s AS VARCHAR) END AS zip_code,
         CASE WHEN cm.cname = 'United States' THEN 'USA' ELSE cm.cname END AS country,
         {sql_initcap("n_name")} AS city,
         coalesce(ex.location_id, dl.location_id) AS location_id, coalesce(ex.parent_path, dl.parent_path) AS parent_path,
         coalesce(ex.categories, dl.categories) AS categories, coalesce(ex.state, dl.state) AS state,
         coalesce(ex.state_abbr, dl.state_abbr) AS state_abbr
  FROM l LEFT JOIN cm ON cm.code = l.country_code LEFT JOIN nation ON n_nationkey = s % 30
         LEFT JOIN ex ON ex.cid = l.id LEFT JOIN dl ON dl.cid = l.id),
g AS (SELECT *, nullif(concat_ws(', ', nullif(city, ''), coalesce(nullif(state, ''), nullif(state_abbr, '')),
                                  coalesce(nullif(country, ''), nullif(country_code, ''))), '') AS display FROM f)"""


@query("d_location_finish", _LOCFIN + """
SELECT id, latlon, zip_code, country, city, location_id, parent_path, categories, state, state_abbr, display,
       coalesce(property_name, CASE WHEN property_type IS NOT NULL AND property_type <> '' AND display IS NOT NULL
                                    THEN property_type || ' in ' || display END) AS property_name
FROM g""")
def d_location_finish(spark, d):
    df, _ = _location_finished(spark, d)
    return df.select("id", "latlon", "zip_code", "country", "city", "location_id",
                     F.array_join("parent_path", "/").alias("parent_path"), "categories", "state", "state_abbr",
                     "display", "property_name")


def _location_finished(spark, d):
    ref = A.reference(spark)
    df, _ = LOC.location_begin(A.listing_feed(spark, d), A.location_state(spark, d))
    df = df.transform(P.property_name).transform(lambda x: P.property_type(x, ref.property_types))
    df, new_rows = LOC.location_finish(df, A.city_map(spark, d), A.country_map(spark, d), A.assigned_locations(spark, d))
    return P.property_name_fill(df), new_rows


@query("d_new_locations", """
SELECT 'BC-' || CAST(c_custkey AS VARCHAR) AS id, 'NEW-' || CAST(c_custkey AS VARCHAR) AS location_id,
       'world' AS parent_path, c_mktsegment AS categories,
       CASE WHEN c_acctbal > 3000 THEN 'State ' || CAST(c_nationkey AS VARCHAR) ELSE '' END AS state,
       CASE WHEN c_acctbal > 0 THEN 'S' || CAST(c_nationkey AS VARCHAR) END AS state_abbr
FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')""")
def d_new_locations(spark, d):
    _, new_rows = _location_finished(spark, d)
    return new_rows.withColumn("parent_path", F.array_join("parent_path", "/"))


# ------------------------------------------------------------- localisation

_LANGS = f"langs AS (SELECT unnest({_lst(rules.LANGUAGES)}) AS language_code)"
_LL = f"""
ll AS (
  SELECT l.*, language_code,
         CASE WHEN language_code IN ('en-us', 'en-gb') THEN 'en' ELSE language_code END AS locale_code,
         CASE WHEN language_code IN ('en-us', 'en-gb') THEN property_name
              WHEN language_code = 'fr' THEN 'fr ' || name_en0
              WHEN language_code = 'es' THEN CASE WHEN s % 2 = 0 THEN 'es ' || name_en0 END
              WHEN language_code = 'de' THEN 'de ' || name_en0 END AS lname,
         CASE WHEN (CASE WHEN dlang = 'en' THEN 'en-us' ELSE dlang END) = language_code THEN md5(dtext) END AS description_md5,
         CASE language_code WHEN 'en-us' THEN '  Quiet hours ' || CAST(s AS VARCHAR) || ' '
                            WHEN 'fr' THEN CASE WHEN s % 3 = 0 THEN 'Calme' END END AS other_policy,
         CASE language_code WHEN 'en-us' THEN CAST(s AS VARCHAR) || ' Main St'
                            WHEN 'fr' THEN CAST(s AS VARCHAR) || ' rue Principale'
                            WHEN 'de' THEN CASE WHEN s % 2 = 0 THEN CAST(s AS VARCHAR) || ' Hauptstr.' END END AS address
  FROM l, langs)"""


def localized_listing(spark, d):
    ref = A.reference(spark)
    df = listing(spark, d).transform(P.property_name).transform(lambda x: P.property_types(x, ref))
    df = df.transform(P.url_and_licence).transform(lambda x: P.amenities(x, ref)).transform(P.policies)
    return LZ.localize_codes(df), ref


@query("d_localize_text", f"""
WITH {BASE}, {_LANGS}, {_LL}
SELECT id, language_code, locale_code, lname AS localize_property_name, description_md5, other_policy,
       lower(regexp_replace(trim(lname), '[^a-zA-Z0-9]+', '-', 'g')) AS localize_property_slug, address
FROM ll""")
def d_localize_text(spark, d):
    df, _ = localized_listing(spark, d)
    df = df.transform(LZ.localize_text).transform(lambda x: LZ.localize_slug(x, RUN_DATE)).transform(LZ.address)
    return df.select("id", "language_code", "locale_code", "localize_property_name",
                     F.md5("localize_property_description").alias("description_md5"),
                     F.get_json_object("localize_policies", "$.other_policy").alias("other_policy"),
                     "localize_property_slug", "address")


def _facility_rows_sql():
    rows = []
    for fid, v in rules.FACILITIES.items():
        names = v.get("name") or {}
        for lang in rules.LANGUAGES:
            rows.append((fid, v["facility_type"], lang, names.get(lang), names.get("fallback")))
    return _values(rows, ["fid", "ftype", "lang", "raw", "fb"])


def _type_rows_sql():
    rows = []
    for tid, v in rules.FACILITY_TYPES.items():
        for lang in rules.LANGUAGES:
            rows.append((tid, lang, v["name"].get(lang), v["name"].get("fallback")))
    return _values(rows, ["tid", "lang", "raw", "fb"])


_FEATURES = f"""
fac AS (SELECT fid, ftype, lang, trim(coalesce(nullif(raw, ''), fb, '')) AS name FROM {_facility_rows_sql()}),
fac2 AS (SELECT * FROM fac WHERE name <> ''),
typ AS (SELECT tid, lang, trim(coalesce(nullif(raw, ''), fb, '')) AS type_name FROM {_type_rows_sql()}),
typ2 AS (SELECT * FROM typ WHERE type_name <> ''),
grp AS (SELECT ftype, lang, string_agg(DISTINCT name, chr(10) ORDER BY name) AS fdescription FROM fac2 GROUP BY ftype, lang),
feat AS (SELECT fac2.fid, fac2.lang, replace(typ2.type_name, '_', ' ') AS fname, grp.fdescription
         FROM fac2 JOIN grp ON grp.ftype = fac2.ftype AND grp.lang = fac2.lang
                   JOIN typ2 ON typ2.tid = fac2.ftype AND typ2.lang = fac2.lang),
lf AS (SELECT DISTINCT l.k, langs.language_code, unnest([l.s % 25, (l.s + 7) % 25]) AS fid FROM l, langs
       WHERE l.s % 17 <> 5),
items AS (SELECT DISTINCT lf.k, lf.language_code, fname, fdescription
          FROM lf JOIN feat ON feat.fid = lf.fid AND feat.lang = lf.language_code),
fsum AS (SELECT k, language_code,
                string_agg(fname || ':' || replace(fdescription, chr(10), '|'), ';' ORDER BY fname, fdescription) AS feature_summary
         FROM items GROUP BY k, language_code)"""


def _summary_text(c):
    return F.array_join(F.transform(F.coalesce(c, F.array()), lambda x: F.concat(
        x["name"], F.lit(":"), F.regexp_replace(x["description"], "\n", "|"))), ";")


@query("d_feature_summary", f"""
WITH {BASE}, {_LANGS}, {_FEATURES}
SELECT l.id, langs.language_code, coalesce(fsum.feature_summary, '') AS feature_summary
FROM l CROSS JOIN langs LEFT JOIN fsum ON fsum.k = l.k AND fsum.language_code = langs.language_code""")
def d_feature_summary(spark, d):
    ref = A.reference(spark)
    df = LZ.feature_summary(listing(spark, d).transform(P.url_and_licence), ref)
    df = LZ.pick_feature_summary(LZ.localize_codes(df))
    return df.select("id", "language_code", _summary_text("feature_summary").alias("feature_summary"))


def _type_name_sql(expr_id, lang):
    rows = [(tid, lg, v["name"][lg]) for tid, v in rules.FACILITY_TYPES.items()
            for lg in rules.LANGUAGES if v["name"].get(lg) is not None]
    return f"(SELECT tn FROM {_values(rows, ['tid', 'lg', 'tn'])} x WHERE x.tid = {expr_id} AND x.lg = {lang})"


def _bed_name_sql(expr_id, lang):
    rows = [(bid, lg, v["name"][lg]) for bid, v in rules.BED_TYPES.items()
            for lg in rules.LANGUAGES if v["name"].get(lg) is not None]
    vals = _values(rows, ["bid", "lg", "bn"])
    return (f"coalesce((SELECT bn FROM {vals} x WHERE x.bid = {expr_id} AND x.lg = {lang}), "
            f"(SELECT bn FROM {vals} x WHERE x.bid = {expr_id} AND x.lg = 'en-us'))")


@query("d_room_arrangement", f"""
WITH {BASE}, {_LANGS},
r AS (SELECT l.k, l.id, l.s, langs.language_code, unnest(range(1, l.s % 3 + 2)) AS i
      FROM l, langs WHERE l.s % 6 <> 0),
r2 AS (SELECT *, (s + i) % 4 AS t1, language_code IN ('en-us', 'en-gb') AS en FROM r)
SELECT id, language_code, CAST(k * 10 + i AS VARCHAR) AS room_id,
       CASE language_code WHEN 'en-us' THEN 'Room ' || CAST(i AS VARCHAR) WHEN 'fr' THEN 'Chambre ' || CAST(i AS VARCHAR)
                          WHEN 'es' THEN CASE WHEN i = 1 THEN 'Habitacion' END
                          WHEN 'de' THEN 'Zimmer ' || CAST(i AS VARCHAR) END AS room_name,
       {_type_name_sql("(s + i) % 5", "language_code")} AS room_type,
       concat_ws(',', {_bed_name_sql("t1", "language_code")} || ':' || CAST(i AS VARCHAR),
                 CASE WHEN NOT (i = 1 AND t1 = 1) THEN {_bed_name_sql("1", "language_code")} || ':1' END) AS beds,
       i % 2 = 0 AS cribs,
       CASE WHEN en THEN (CASE s % 4 WHEN 0 THEN ''
                                     WHEN 1 THEN 'https://img.example/' || CAST(k AS VARCHAR) || '/1.jpg'
                                     ELSE 'https://img.example/' || CAST(k AS VARCHAR) || '/1.jpg,https://img.example/' || CAST(k AS VARCHAR) || '/2.jpg' END)
       END AS photos,
       CASE WHEN en THEN 'wifi,floor-' || CAST(i AS VARCHAR) END AS attributes,
       CASE WHEN en THEN CAST((s + i) % 3 AS VARCHAR) END AS bedrooms,
       CASE WHEN en AND i <> 2 THEN CAST(i + s % 6 AS VARCHAR) END AS total_guests,
       CAST(coalesce(CASE WHEN i <> 2 THEN CAST(s * i AS DOUBLE) / 2 END, 0.0) AS VARCHAR) AS size
FROM r2""")
def d_room_arrangement(spark, d):
    df, ref = localized_listing(spark, d)
    return room_columns(LZ.room_arrangement(df, ref).select("id", "language_code",
                                                            F.explode("room_arrangement_arr_struct").alias("r")))


def room_columns(df):
    """Flat columns of one room ``r`` per row."""
    beds = F.array_join(F.transform("r.bed_options.configuration", lambda c: F.concat(
        c["bed_type"], F.lit(":"), c["number_of_beds"].cast("string"))), ",")
    return df.select("id", "language_code", F.col("r.id").alias("room_id"), F.col("r.name").alias("room_name"),
                     F.col("r.room_type").alias("room_type"), beds.alias("beds"),
                     F.col("r.bed_options.cribs_and_extra_beds").alias("cribs"),
                     F.array_join("r.photos", ",").alias("photos"), F.array_join("r.attributes", ",").alias("attributes"),
                     F.col("r.number_of_rooms.bedrooms").alias("bedrooms"),
                     F.col("r.maximum_occupancy.total_guests").alias("total_guests"), F.col("r.size").alias("size"))


def _locale_name_sql(expr):
    whens = " ".join(f"WHEN {expr} = '{v['code']}' THEN '{k}'" for k, v in rules.LOCALES.items() if not v.get("disabled"))
    return f"(CASE {whens} END)"


@query("d_localized", f"""
WITH {BASE}, {_LANGS}, {_LL}, {_FEATURES}, {_POL}
SELECT ll.id AS property_id, CAST(11 AS INTEGER) AS feed, lname AS property_name, ll.property_type, ll.country_code,
       {_locale_name_sql("locale_code")} AS language,
       lower(regexp_replace(trim(lname), '[^a-zA-Z0-9]+', '-', 'g')) AS property_slug,
       description_md5, other_policy AS policies_other,
       CASE WHEN locale_code = 'en' THEN
         CASE pol.pets WHEN 'yes' THEN 'Pets are allowed.'
                       WHEN 'upon_request' THEN 'Pets are allowed upon request' ||
                            CASE WHEN pol.mode IS NOT NULL THEN ' and ' || replace(pol.mode, '_', ' ') ELSE '.' END
                       WHEN 'no' THEN 'Pets are not allowed.' END END AS policies_pet,
       CAST(CASE WHEN ll.s % 6 <> 0 THEN ll.s % 3 + 1 END AS INTEGER) AS n_rooms, DATE '{RUN_DATE}' AS updated_at,
       address, '' AS captions, '' AS area_description, true AS is_translated,
       coalesce(fsum.feature_summary, '') AS feature_summary, '' AS display
FROM ll LEFT JOIN fsum ON fsum.k = ll.k AND fsum.language_code = ll.language_code
        LEFT JOIN pol ON pol.k = ll.k""")
def d_localized(spark, d):
    ref = A.reference(spark)
    df = listing(spark, d).transform(P.property_name).transform(lambda x: P.property_types(x, ref))
    df = df.transform(P.url_and_licence).transform(lambda x: P.amenities(x, ref)).transform(P.policies)
    out = LZ.localize(df, ref, RUN_DATE)
    return out.select("property_id", "feed", "property_name", "property_type", "country_code", "language",
                      "property_slug", F.md5("property_description").alias("description_md5"),
                      F.get_json_object("policies", "$.other_policy").alias("policies_other"),
                      F.get_json_object("policies", "$.pet_policy").alias("policies_pet"),
                      F.when(F.col("room_arrangement").isNotNull(), F.size("room_arrangement")).alias("n_rooms"), "updated_at", "address", "captions",
                      "area_description", "is_translated", _summary_text("feature_summary").alias("feature_summary"),
                      "display")


# ---------------------------------------------------------- full listing

@query("d_listing", f"""
WITH {BASE}, {AMEN}, {_POL}, {_RATING}, {_ROOMS}, {_FRESH},
rooms_agg AS (SELECT k, CAST(sum(bed) AS BIGINT) AS bedroom_count FROM rb GROUP BY k),
sc AS (SELECT doc_id, CAST(CASE WHEN toxic = 1 THEN 0.0 ELSE quality * 6.5 + 2.25 END AS FLOAT) AS new_score,
              CAST(quality * 10 + toxic AS INTEGER) AS new_count FROM labels),
m AS (SELECT o_orderkey, list_concat(coalesce({_MEALS}, []),
                                     coalesce(CASE WHEN o_orderstatus = 'F' THEN ['dinner', 'BREAKFAST'] END, [])) AS meals
      FROM orders)
SELECT pol.id, pol.property_name,
       CASE WHEN regexp_matches(lower(pol.property_name), '{"|".join(rules.SHARED_ROOM_KEYWORDS)}') THEN 'Shared room'
            WHEN regexp_matches(lower(pol.property_name), '{"|".join(rules.SHARED_SPACE_KEYWORDS)}') THEN 'Shared space'
       END AS room_type,
       pol.property_type_category, rt.star_rating,
       coalesce(CASE WHEN new_score <> 0 THEN new_score END, rt.review_score) AS review_score,
       coalesce(CASE WHEN new_count <> 0 THEN new_count END, rt.number_of_review) AS number_of_review,
       pol.s >= 3 AS published, CAST(CASE pol.s % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS INTEGER) AS n_images,
       rooms_agg.bedroom_count, CAST(1 AS INTEGER) AS min_stay,
       array_to_string(list_sort(CASE WHEN age = 0 THEN list_distinct(list_append(coalesce(amc.cats, []), 'Child Friendly'))
                                      ELSE coalesce(amc.cats, []) END), ',') AS amenity_categories,
       r_name AS chain_name,
       nullif(array_to_string(list_sort(list_distinct(list_transform(m.meals, lambda x: upper(x[1:1]) || lower(x[2:])))), ','), '')
         AS meal_plan,
       coalesce({sql_round("fr.f")}, 0) AS usd_price
FROM pol LEFT JOIN amc ON amc.k = pol.k LEFT JOIN rt ON rt.k = pol.k LEFT JOIN rooms_agg ON rooms_agg.k = pol.k
         LEFT JOIN sc ON sc.doc_id = pol.k LEFT JOIN nation ON n_nationkey = pol.brand
         LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN m ON m.o_orderkey = pol.k
         LEFT JOIN fr ON fr.fk = pol.k""")
def d_listing(spark, d):
    from feedlake.plans.run import details
    ref = A.reference(spark)
    df = details(listing(spark, d), ref, A.scores_feed(spark, d), A.chains_feed(spark, d), A.search_feed(spark, d),
                 None, RUN_DATE)
    return df.select("id", "property_name", "room_type", "property_type_category", "star_rating", "review_score",
                     "number_of_review", "published", F.size("images").alias("n_images"), "bedroom_count", "min_stay",
                     sorted_text("amenity_categories").alias("amenity_categories"),
                     F.col("chain_and_brand.chain_name").alias("chain_name"),
                     sorted_text("meal_plan").alias("meal_plan"), "usd_price")
