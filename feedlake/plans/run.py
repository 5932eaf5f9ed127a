"""Whole-run compositions D32, D33, D35."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from feedlake import schemas
from feedlake.operators import dedupe, enrich_left
from feedlake.plans import listing as P
from feedlake.plans import localize as LZ
from feedlake.plans import location as LOC
from feedlake.plans import price as PR
from feedlake.plans.reviews import reviews
from feedlake.session import stage, stage_path, staged, unstage
from feedlake.sources import (append, counted, empty_like, land_feed, read_feed, read_if_exists, require_key, upsert,
                              write_worklist)
from feedlake.sources.journal import FINISHED, Journal
from feedlake.sources.snapshots import expire, versions


# D32
def basic(df: DataFrame, ref, run_date: str) -> DataFrame:
    """The basic listing steps, in the order of the reference's step wrappers."""
    steps = [
        P.property_name, P.rating_and_score, P.checkin_times,
        lambda x: P.property_slug(x, run_date), lambda x: P.property_types(x, ref), P.room_type,
        lambda x: P.amenities(x, ref), P.policies, P.min_stay, P.hotel_photos, P.rooms,
        P.url_and_licence, P.is_published,
    ]
    for step in steps:
        df = df.transform(step)
    return df


# D33
def details(df: DataFrame, ref, scores: DataFrame, chains: DataFrame, search: DataFrame,
            stored_prices: DataFrame | None, run_date: str) -> DataFrame:
    """Basic steps, review scores, flags, chain and brand, meal plan, USD price.
    The search feed is joined once; the listings carry ``PR.HISTORY_COLUMNS``."""
    df = basic(df, ref, run_date)
    df = P.review_scores(df, scores)
    df = P.property_flags(df, ref.keyword_lists)
    df = P.meal_plan(enrich_left(df, PR.search_facts(search, "commission", "products"), "id"))
    df = PR.price_columns(df, stored_prices)
    # last: this join is keyed by brand and breaks the partitioning by id
    return P.chain_and_brand(df, chains)


@dataclass
class FeedPaths:
    """Input folders of one run (multiline JSON documents)."""
    details: str
    review_scores: str
    search: str
    chains: str
    reviews: str
    city_map: str
    country_map: str
    assigned_locations: str | None = None
    multiline: bool = True      # one JSON document per file (False: JSON Lines)
    # Documents that do not parse or lack their key: "fail" the run, or "write" them to ``Sinks.rejects_table``.
    on_reject: str = "fail"


@dataclass
class Sinks:
    """Output names of one run."""
    localize_table: str = "rental_property_localize"
    location_table: str = "rental_property_location"
    listing_table: str | None = None          # disabled in the reference's driver
    reviews_table: str | None = None           # disabled in the reference's driver
    price_history_table: str | None = None     # disabled in the reference's driver
    price_state_table: str = "rental_property"
    worklist_path: str | None = None
    rejects_table: str | None = None            # needed with FeedPaths.on_reject = "write"
    journal_table: str = "feedlake_run_journal"
    keep_versions: int = 3                      # versions of each output that stay readable
    # Buckets by id of the tables that the next run looks up (locations, prices), at least the shuffle partitions.
    state_buckets: int | None = None
    extra: dict = field(default_factory=dict)


def ingest_details(raw: DataFrame) -> DataFrame:
    """Listing documents, one per id.  They are keyed by the listing id that all
    later joins use, so the wide documents cross one shuffle."""
    return dedupe(raw.withColumn("listing_id", P.prefixed_id("id")), "listing_id")


# Each feed's schema, and the key that its rows are merged by.
FEEDS = {
    "details": (schemas.DETAILS, "id"), "review_scores": (schemas.REVIEW_SCORES, "id"), "search": (schemas.SEARCH, "id"),
    "chains": (schemas.CHAINS, None), "reviews": (schemas.REVIEWS, None), "city_map": (schemas.CITY_MAP, None),
    "country_map": (schemas.COUNTRY_MAP, None), "assigned_locations": (schemas.LOCATION, "id"),
}


def read_all(spark: SparkSession, paths: FeedPaths, names: list[str]) -> tuple[dict, DataFrame | None]:
    """(feeds, rejects) by the rule for documents that do not parse or lack the key they are merged by."""
    if paths.on_reject not in ("fail", "write"):
        raise ValueError(f'on_reject is "fail" or "write", not {paths.on_reject!r}')
    feeds, rejects = {}, None
    for name in names:
        schema, key = FEEDS[name]
        if paths.on_reject == "fail":
            rows = read_feed(spark, getattr(paths, name), schema, multiline=paths.multiline)
            feeds[name] = require_key(rows, key, name) if key else rows
        else:
            feeds[name], bad = land_feed(spark, getattr(paths, name), schema, name, multiline=paths.multiline, key=key)
            rejects = bad if rejects is None else rejects.unionByName(bad)
    return feeds, rejects


def prepare(spark: SparkSession, paths: FeedPaths, skip: tuple = ()) -> dict:
    """Read every feed (but those to ``skip``) with its explicit schema and de-duplicate at ingestion."""
    names = [n for n in FEEDS if n not in skip and getattr(paths, n)]
    read, rejects = read_all(spark, paths, names)
    feeds = {"scores": dedupe(read["review_scores"], "id"), "search": dedupe(read["search"], "id"), "rejects": rejects,
             **{n: read[n] for n in ("chains", "reviews", "city_map", "country_map")},
             "assigned": read["assigned_locations"] if "assigned_locations" in read else empty_like(spark, schemas.LOCATION)}
    if "details" in read:
        feeds["details"] = ingest_details(read["details"])
    return feeds


# D35
def compose(feeds: dict, ref, run_date: str, run_ts: str, state: DataFrame, stored: DataFrame | None,
            cut=lambda listings: listings) -> dict:
    """The whole run as frames, without sinks: listings, localized, new_locations,
    reviews, price_history and worklist.  ``cut`` may stage the enriched listings,
    which feed all outputs but the worklist."""
    begun, worklist = LOC.location_begin(feeds["details"], state)
    enriched = cut(details(begun, ref, feeds["scores"], feeds["chains"], feeds["search"], stored, run_date))
    listings, new_locations = LOC.location_finish(enriched.drop(*PR.HISTORY_COLUMNS), feeds["city_map"],
                                                  feeds["country_map"], feeds["assigned"])
    listings = P.property_name_fill(listings)
    return {
        "worklist": worklist,
        "listings": listings,
        "localized": LZ.localize(listings, ref, run_date),
        "new_locations": new_locations,
        "reviews": reviews(enriched.select("id", "feed_provider_id", "country_code"), feeds["reviews"]),
        "price_history": PR.price_history(enriched, run_ts),
    }


def run(spark: SparkSession, paths: FeedPaths, ref, run_date: str, sinks: Sinks | None = None,
        run_ts: str | None = None, run_id: str | None = None) -> dict:
    """The whole batch: read, enrich, localise, upsert.  Returns the rows written per step."""
    return run_frames(spark, prepare(spark, paths), ref, run_date, sinks or Sinks(), run_ts=run_ts, run_id=run_id)


def run_frames(spark: SparkSession, feeds: dict, ref, run_date: str, sinks: Sinks, tag: str = "batch",
               run_ts: str | None = None, run_id: str | None = None) -> dict:
    """The run on already-read feeds (shared by the batch and streaming drivers).

    The enriched listings feed every output, so they are staged once to the shared
    checkpoint folder before the first sink is touched: no output reads a table
    that this run has already changed, and outputs of one run agree.  The journal
    notes every step.  A run that died goes on under the same id (by default made
    of date, time and tag) from its staged listings with the steps that are not
    done, so its outputs are those of an undisturbed run; the staged table is
    dropped when the last step is noted.
    """
    run_ts = run_ts or f"{run_date} 00:00:00"
    journal = Journal(spark, sinks.journal_table, run_id or f"{run_ts} {tag}")
    name = staged_name(journal)
    state = read_if_exists(spark, sinks.location_table, schemas.LOCATION)
    stored = read_if_exists(spark, sinks.price_state_table, schemas.STORED_PRICE) if sinks.price_state_table else None

    def cut(listings: DataFrame) -> DataFrame:
        if journal.done("staged"):
            kept = staged(spark, name)
            if kept is None:
                raise RuntimeError(f"run {journal.run_id}: its staged listings are gone, and some outputs may be written; abandon() it")
            return kept
        rows, seen = counted(listings)
        kept = stage(rows, name, bucket_by="id")
        journal.mark("staged", seen.get["n_rows"])
        return kept

    if feeds.get("rejects") is not None:
        if not sinks.rejects_table:
            raise ValueError("rejected documents are written only with Sinks.rejects_table")
        rejects, seen = counted(feeds["rejects"])
        batch = f"{journal.run_id}/{journal.attempt}"
        journal.once("rejects", lambda: seen.get["n_rows"] if append(rejects, sinks.rejects_table, batch) else None)
    out = compose(feeds, ref, run_date, run_ts, state, stored, cut=cut)
    if sinks.worklist_path:      # before the location table changes
        journal.once("worklist", lambda: write_worklist(out["worklist"], f"{sinks.worklist_path.rstrip('/')}/{tag}"))
    tables = [("localized", sinks.localize_table, ["property_id", "language_code"], ["language_code"]),
              ("reviews", sinks.reviews_table, "id", None), ("price_history", sinks.price_history_table, "id", None),
              ("listings", sinks.listing_table, "id", None), ("new_locations", sinks.location_table, "id", None)]
    looked_up = {sinks.location_table, sinks.price_state_table}
    for step, table, keys, parts in tables:
        if table:
            buckets = sinks.state_buckets if table in looked_up else None
            journal.once(step, lambda: upsert(out[step], table, keys, partition_by=parts, buckets=buckets))
    done = dict(journal.rows)
    journal.mark(FINISHED)
    unstage(spark, name, stage_path(spark, name))
    for table in {t for _, t, _, _ in tables if t}:
        if versions(spark, table):
            expire(spark, table, sinks.keep_versions)
    return done


def staged_name(journal: Journal) -> str:
    text = "".join(ch if ch.isalnum() else "_" for ch in journal.run_id)
    return f"enriched_{text}_{journal.attempt}"


def abandon(spark: SparkSession, sinks: Sinks, run_id: str) -> None:
    """Give up a run that died: drop its staged listings and let the id start anew.  What it wrote stays."""
    journal = Journal(spark, sinks.journal_table, run_id)
    name = staged_name(journal)
    unstage(spark, name, stage_path(spark, name))
    if journal.rows:
        journal.mark(FINISHED)
