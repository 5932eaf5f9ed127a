"""Explicit schemas for the feeds and curated tables.

Feeds are read with these schemas instead of inference: inference costs a full
pass over the input and drops fields absent from the sampled documents.
Language-keyed texts are ``map<string,string>`` so any language code (with
hyphens) is a key, not a field name.
"""

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TEXT = T.MapType(S, S)


def _f(name, t):
    return T.StructField(name, t, True)


def struct(*fields):
    return T.StructType([_f(n, t) for n, t in fields])


BED = struct(("bed_type", L), ("number_of_beds", I))
BED_CONFIG = struct(("configuration", T.ArrayType(BED)))
BED_OPTION = struct(("bed_configurations", T.ArrayType(BED_CONFIG)))
ROOM = struct(
    ("id", L), ("name", TEXT), ("room_type", L), ("size", D),
    ("attributes", T.ArrayType(S)),
    ("number_of_rooms", struct(("bedrooms", I), ("bathrooms", I), ("living_rooms", I))),
    ("maximum_occupancy", struct(("adults", I), ("children", I), ("total_guests", I))),
    ("cribs_and_extra_beds", struct(("are_allowed", B))),
    ("bed_options", T.ArrayType(BED_OPTION)),
)
COT = struct(("age", struct(("from", I), ("to", I))), ("price", D), ("type", S))
PHOTO = struct(("url", struct(("standard", S))), ("main_photo", B))

DETAILS = struct(
    ("id", L), ("name", TEXT), ("accommodation_type", S), ("currency", S), ("url", S),
    ("brands", T.ArrayType(L)), ("themes", T.ArrayType(I)),
    ("facilities", T.ArrayType(struct(("id", L)))),
    ("location", struct(("country", S), ("city", L), ("postal_code", S),
                        ("coordinates", struct(("latitude", D), ("longitude", D))),
                        ("address", TEXT))),
    ("rating", struct(("number_of_reviews", I), ("stars", D), ("review_score", D), ("preferred", B))),
    ("checkin_checkout_times", struct(("checkin_from", S), ("checkin_to", S),
                                      ("checkout_from", S), ("checkout_to", S))),
    ("description", struct(("text", TEXT), ("important_information", TEXT),
                           ("license_numbers", T.ArrayType(S)))),
    ("policies", struct(("minimum_guest_age", I), ("minimum_checkin_age", I),
                        ("maximum_checkin_age", I),
                        ("pets", struct(("allowed", S), ("charge_mode", S))),
                        ("cots_and_extra_beds", T.ArrayType(COT)))),
    ("payment", struct(("methods", struct(("cash", B))))),
    ("photos", T.ArrayType(PHOTO)),
    ("rooms", T.ArrayType(ROOM)),
)

SCORE = struct(("score", D))
REVIEW_SCORES = struct(
    ("id", L), ("score", D), ("number_of_reviews", I),
    ("breakdown", struct(*[(n, SCORE) for n in (
        "cleanliness", "comfort", "facilities", "free_wifi", "location", "staff", "value_for_money")])),
)

REVIEW = struct(("id", S), ("language", S), ("score", D), ("summary", S), ("negative", S),
                ("positive", S), ("reviewer", S), ("date", S))
REVIEWS = struct(("id", L), ("reviews", T.ArrayType(REVIEW)))

SEARCH = struct(
    ("id", L), ("commission", D), ("deep_link_url", S), ("price", struct(("book", D))),
    ("products", T.ArrayType(struct(("policies", struct(("meal_plan", struct(("meals", T.ArrayType(S))))))))),
)

CHAINS = struct(("id", L), ("name", S), ("brands", T.ArrayType(struct(("id", L), ("name", S)))))
CITY_MAP = struct(("city_code", L), ("city", S))
COUNTRY_MAP = struct(("Code", S), ("Name", S))

LOCATION = struct(("id", S), ("location_id", S), ("parent_path", T.ArrayType(S)),
                  ("categories", S), ("state", S), ("state_abbr", S))
STORED_PRICE = struct(("id", S), ("feed_provider_id", L), ("usd_price", D))

# Curated outputs
PRICE_HISTORY = struct(("property_id", S), ("price", struct(("book", D))), ("checkin", T.DateType()),
                       ("checkout", T.DateType()), ("feed", I), ("country_code", S), ("id", S))
