"""Location pipelines D3 and D24."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import rules
from feedlake.functions import blank_to_null, first_nonblank, join_present, literal_lookup
from feedlake.operators import dedupe, fill_from, join_state, lookup_left
from feedlake.plans.listing import country_code, init_keys

LOCATION_COLS = ["location_id", "parent_path", "categories", "state", "state_abbr"]


def missing_state(df: DataFrame, state: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``df`` without a state row (a left-anti join)."""
    return df.join(state.select(key), key, "left_anti")


def location_begin(df: DataFrame, state: DataFrame):
    """Keys, country code and coordinates; existing location state joined on;
    returns (listings, worklist) where the worklist holds the listings still
    without a location id (id, lat, lon, country_code), one row per id."""
    df = init_keys(country_code(df))
    df = df.withColumns({"lat": F.coalesce(F.col("location.coordinates.latitude"), F.lit(0.0)),
                         "lon": F.coalesce(F.col("location.coordinates.longitude"), F.lit(0.0))})
    df = join_state(df, state.select("id", *LOCATION_COLS), "id")
    worklist = dedupe(df.filter(F.col("location_id").isNull()).select("id", "lat", "lon", "country_code"), "id")
    return df, worklist


def location_finish(df: DataFrame, city_map: DataFrame, country_map: DataFrame, assigned: DataFrame):
    """latlon text, zip code, country name, city, assigned-location fill and the
    display text; returns (listings, new_location_rows)."""
    lat, lon = F.col("location.coordinates.latitude"), F.col("location.coordinates.longitude")
    df = df.withColumns({
        "latlon": F.when(lat.isNotNull() & lon.isNotNull(), F.concat_ws(",", lat, lon)),
        "zip_code": blank_to_null(F.col("location.postal_code")),
        "city_code": F.col("location.city"),
    })
    countries = dedupe(country_map.select(F.col("Code").alias("country_code"), F.col("Name").alias("country_name")),
                       "country_code", ["country_name"], keep="first")
    df = lookup_left(df, countries, "country_code")
    df = df.withColumn("country", F.coalesce(literal_lookup(rules.COUNTRY_NAME_REMAP)(F.col("country_name")),
                                             F.col("country_name"))).drop("country_name")
    cities = dedupe(city_map.select("city_code", "city"), "city_code", ["city"], keep="first")
    df = lookup_left(df, cities, "city_code").drop("city_code")
    dl = dedupe(assigned.select("id", *LOCATION_COLS), "id")
    twin = dl.select("id", *[F.col(c).alias(c + "_dl") for c in LOCATION_COLS])
    df = fill_from(df.join(twin, "id", "left"), "_dl", LOCATION_COLS)
    display = join_present(", ", first_nonblank("city"), first_nonblank("state", "state_abbr"),
                           first_nonblank("country", "country_code"))
    df = df.withColumn("display", blank_to_null(display))
    return df, dl.select("id", *LOCATION_COLS)
