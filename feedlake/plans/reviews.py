"""Review rows D23."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import rules
from feedlake.operators import children_with_owner, explode_rows

# output column -> field of a review
REVIEW_FIELDS = {"language_code": "language", "score": "score", "summary": "summary", "negative": "negative",
                 "positive": "positive", "reviewer": "reviewer", "review_date": "date"}


def reviews(owners: DataFrame, feed: DataFrame) -> DataFrame:
    """One row per review with its owner's keys; reviews of unknown listings are
    dropped (an inner join).  ``owners`` holds id, feed_provider_id,
    country_code; ``feed`` holds id and the nested ``reviews`` array, whose
    structs may lack some of the fields."""
    each = explode_rows(feed.select(F.col("id").alias("feed_provider_id"), "reviews"), "reviews", "review")  # G1
    owned = children_with_owner(each, owners.withColumnRenamed("id", "property_id"), "feed_provider_id")     # J12
    has = set(each.schema["review"].dataType.names)
    fields = [F.col("review")[f].alias(c) for c, f in REVIEW_FIELDS.items() if f in has]
    return owned.select(F.col("review.id").alias("id"), *fields, "property_id", "country_code",
                        F.lit(rules.FEED_ID).cast("int").alias("feed"))
