"""Secret scan with corpus-wide ownership frequency.

Base patterns (assignments, access keys, long hex) are matched in whole texts;
positions come from splitting a text at its matches and adding up lengths, all
in SQL functions.  The value of every candidate is hashed and counted over the
corpus by distinct repositories (documents) and owners (sources): a value that
many owners carry is a widely copied example, one with a single owner looks
live.  The method also looks at bare tokens (16 or more characters, letters and
digits mixed, high variety) and adds those whose value has one owner only and
occurs in at most ``max_repos`` repositories, as spans of kind ``live``.

Null text counts as empty.  Owners that are null count as one owner.  Rows
repeated in full count as one repository but are each reported.  An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import join_groups, stage

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# Runs shorter than the least length would only be found to be dropped; a maximal
# run found by {32,} starts and ends where the one found by + does.
HEX = r"[0-9a-f]{32,}"
# A whole token of 16 or more characters with a digit and a letter; the lookbehind
# lets each token be looked through once, however long it is.
BARE = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}")
# kind, pattern, group with the value, least characters of the value.
KINDS = [("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32), ("live", BARE, 0, 16)]
LIVE = 3
PARTS = "array<struct<kind:int,pos:int,gap:int,len:int,value:string>>"


def _parts(text: Column, kind: int) -> Column:
    """The leftmost non-overlapping matches: length of the text before each since the last, its length, its value."""
    _, pattern, group, _ = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)).alias("g"), whole.alias("w"), value.alias("v"))
    parts = F.transform(zipped, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("pos"), F.char_length(x["g"]).alias("gap"),
        F.char_length(x["w"]).alias("len"), x["v"].alias("value")))
    return F.when(text.rlike(pattern), parts).otherwise(F.array().cast(PARTS))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """Per row: row number, doc_id, owner and the parts of all kinds."""
    t = F.col("t")
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).alias("owner"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner",
                    F.concat(*[_parts(t, k) for k in range(len(KINDS))]).alias("parts")))


def spans_of(found: DataFrame) -> DataFrame:
    """One row a span that counts: row, doc_id, owner, kind, start, end, value (hash)."""
    order = Window.partitionBy("row", "kind").orderBy("pos")
    rows = (found.where(F.size("parts") > 0).select("row", "doc_id", "owner", F.inline("parts"))
            .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order)))
    size, enough = F.char_length("value"), F.lit(False)
    for k, (_, _, _, least) in enumerate(KINDS):
        enough = F.when(F.col("kind") == k, size >= least).otherwise(enough)
    varied = F.size(F.array_distinct(F.split("value", ""))) >= 10
    return (rows.where(enough & ((F.col("kind") != LIVE) | varied))
            .select("row", "doc_id", "owner", "kind", (F.col("end") - F.col("len")).alias("start"), "end",
                    F.xxhash64("value").alias("value")))


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: repos and owners that carry it, and its number of spans."""
    # Distinct triples, then counts per owner, then per value: every step combines
    # map-side and a hot value is spread over its (owner, document) pairs first.
    per_owner = (spans.groupBy("value", "owner", "doc_id").agg(F.count(F.lit(1)).alias("spans"))
                 .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("spans").alias("spans")))
    return per_owner.groupBy("value").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"),
                                          F.sum("spans").alias("spans"))


def _text(spans: Column) -> Column:
    """kind:start:end of sorted (start, kind, end), comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, *, max_repos: int = 5, id_col: str = "doc_id", text_col: str = "text",
                 owner_col: str = "source") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_shared.

    ``n_live`` counts the values with one owner in at most ``max_repos`` documents,
    ``n_shared`` the other values found.
    """
    found = stage(candidates(docs, id_col, text_col, owner_col), "candidates")
    spans = stage(spans_of(found), "spans")
    live = (F.col("owners") == 1) & (F.col("repos") <= max_repos)
    base = F.col("kind") != LIVE
    place = F.struct("start", "kind", "end")
    owned = stage(ownership(spans), "ownership")
    per_row = (join_groups(spans, owned, "value", "spans", spans.count()).groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(base | live, place))).alias("all"),
        F.sort_array(F.collect_list(F.when(base, place))).alias("base"),
        F.size(F.collect_set(F.when(live, F.col("value")))).cast("long").alias("n_live"),
        F.size(F.collect_set(F.when(~live, F.col("value")))).cast("long").alias("n_shared")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    joined = (found.select("doc_id", "row").join(per_row, "row", "left")
              .withColumn("base", F.coalesce("base", none)).withColumn("all", F.coalesce("all", none)))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind][0]}")

    n = [count(k) for k in range(LIVE)]
    return joined.select("doc_id", *n, F.sha2(_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                         _text(F.col("all")).alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"),
                         F.coalesce("n_shared", F.lit(0)).alias("n_shared"))
