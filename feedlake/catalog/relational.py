"""Operator-level queries on the driver's flat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import rules
from feedlake.catalog import ORACLE, RUN_DATE, RUN_TS, query, sql_initcap, sql_round, sql_row_key, table, tables
from feedlake.functions import (
    add_tag, blank_to_null, by_language, classify, clean_case, contains_any, constant_array,
    default, empty_to_null, first_nonblank, flag, flat_distinct,
    guarded, join_array, join_present, localized, map_lookup, matches_any, nested, normalize_text,
    override_if, pack, pluck, query_param, remap_code, replace_field, row_key,
    run_epoch, safe_date, sentence, slugify, slugify_all, sorted_text, sqft, strip_nul,
    humanize, before_first, to_type, struct_text, field, per_night, round_to, half,
)
from feedlake.operators import (
    LOCATOR, attach, collect_distinct_structs, collect_flat_distinct, collect_sets, enrich_left,
    collect_sorted, dedupe, distinct_elements, explode_path, fan_out,
    fill_defaults, fill_from, first_non_null, first_where_agg, join_first_element, join_state,
    lookup_elements, lookup_left, lookup_left_on, located, match, only,
    rollup_children, row_counts, shape, stamp, with_constants,
)
from feedlake.sources import localized_rows, merge_by_key, parameter_frame, sample


def money(c, digits: int = 2):
    """Average over 2-digit decimals, rounded, as double (exact in both engines)."""
    return F.round(c, digits).cast("double")


# --------------------------------------------------------------------------
# Flagship slice: scan, dedupe, rollup, rejoin, lookup, defaults, slug, struct
# --------------------------------------------------------------------------

def customer_profile(customer, orders, nation):
    orders = dedupe(orders, "o_orderkey", ["o_orderdate", "o_totalprice"])           # A8
    per_cust = (orders.groupBy("o_custkey")                                            # A7, A3
                .agg(F.count(F.lit(1)).alias("n_orders"),
                     F.sum("o_totalprice").alias("total_price"),
                     F.avg(F.col("o_totalprice").cast("decimal(18,2)")).alias("avg_price"),
                     F.sort_array(F.collect_set("o_orderstatus")).alias("statuses"))
                .withColumnRenamed("o_custkey", "c_custkey"))
    out = attach(customer, per_cust, "c_custkey")                                       # J6
    out = lookup_left_on(out, nation.select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey")  # J2/J13
    out = fill_defaults(out, {"n_orders": 0, "total_price": 0.0})                       # P7
    out = out.withColumn("profile", pack({"n_orders": "n_orders",                      # P12
                                          "total_price": F.round("total_price", 2),
                                          "avg_price": money(F.col("avg_price")),
                                          "statuses": F.array_join("statuses", ",")}))
    return out.select(
        "c_custkey",
        slugify("c_name").alias("customer_slug"),                                       # F1
        F.col("n_name").alias("nation"),
        F.col("profile.n_orders").alias("n_orders"),
        F.col("profile.total_price").alias("total_price"),
        F.col("profile.avg_price").alias("avg_price"),
        F.col("profile.statuses").alias("statuses"),
    )


@query("q_customer_profile", f"""
WITH o AS (
  SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_price,
         avg(CAST(o_totalprice AS DECIMAL(18,2))) AS avg_price,
         string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses
  FROM orders GROUP BY o_custkey)
SELECT c.c_custkey,
       lower(regexp_replace(trim(c.c_name), '[^a-zA-Z0-9]+', '-', 'g')) AS customer_slug,
       n.n_name AS nation,
       coalesce(o.n_orders, 0) AS n_orders,
       {sql_round("coalesce(o.total_price, 0.0)")} AS total_price,
       {sql_round("o.avg_price")} AS avg_price,
       o.statuses AS statuses
FROM customer c
LEFT JOIN o ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = CAST(c.c_nationkey AS VARCHAR)
""")
def q_customer_profile(spark, d):
    customer, orders, nation = tables(spark, d, "customer", "orders", "nation")
    return customer_profile(customer, orders, nation)


def _cases(mapping: dict, expr: str, default: str = "NULL") -> str:
    """SQL CASE for a lookup dict (values must be str)."""
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default} END)"


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# ---------------------------------------------------------------- text (F)

@query("q_slugify", """
SELECT p_partkey,
       lower(regexp_replace(trim(p_name), '[^a-zA-Z0-9]+', '-', 'g')) AS name_slug,
       lower(regexp_replace(trim(concat_ws(' ', p_brand, p_type)), '[^a-zA-Z0-9]+', '-', 'g')) AS brand_type_slug
FROM part""")
def q_slugify(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", slugify("p_name").alias("name_slug"),
        slugify(F.concat_ws(" ", "p_brand", "p_type")).alias("brand_type_slug"))


@query("q_case_fns", f"""
SELECT p_partkey AS key, 'part' AS kind, upper(p_name) AS upper_text, lower(p_brand) AS lower_text,
       {sql_initcap("p_name")} AS initcap_text, trim('  ' || p_type || ' ') AS trim_text FROM part
UNION ALL
SELECT s_suppkey, 'supplier', upper(s_name), lower(s_name), {sql_initcap("s_name")},
       trim('  ' || s_name || '  ') FROM supplier""")
def q_case_fns(spark, d):
    part, supplier = tables(spark, d, "part", "supplier")
    a = part.select(F.col("p_partkey").alias("key"), F.lit("part").alias("kind"),
                    clean_case("p_name", "upper").alias("upper_text"),
                    clean_case("p_brand", "lower").alias("lower_text"),
                    clean_case("p_name", "initcap").alias("initcap_text"),
                    clean_case(F.concat(F.lit("  "), "p_type", F.lit(" ")), "trim").alias("trim_text"))
    b = supplier.select(F.col("s_suppkey").alias("key"), F.lit("supplier").alias("kind"),
                        clean_case("s_name", "upper").alias("upper_text"),
                        clean_case("s_name", "lower").alias("lower_text"),
                        clean_case("s_name", "initcap").alias("initcap_text"),
                        clean_case(F.concat(F.lit("  "), "s_name", F.lit("  ")), "trim").alias("trim_text"))
    return a.unionByName(b)


_PART_CLASS_SQL = " ".join(
    f"WHEN regexp_matches(lower(p_name), '{'|'.join(ws)}') THEN '{label}'" for label, ws in rules.PART_CLASSES)


@query("q_case", f"""
SELECT p_partkey, p_name, (CASE {_PART_CLASS_SQL} ELSE NULL END) AS part_class FROM part""")
def q_case(spark, d):
    part = table(spark, d, "part")
    cls = classify([(matches_any("p_name", ws), label) for label, ws in rules.PART_CLASSES])
    return part.select("p_partkey", "p_name", cls.cast("string").alias("part_class"))


def _sql_contains_any(expr: str, words) -> str:
    return "coalesce(" + " OR ".join(f"contains({expr}, '{w}')" for w in words) + ", false)"


_NORM_SQL = "lower(regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g'))"


@query("q_flags", "SELECT doc_id, " + ", ".join(
    f"{_sql_contains_any('norm', ws)} AS {flag_name}" for flag_name, ws in rules.DOC_KEYWORDS.items())
    + f" FROM (SELECT doc_id, {_NORM_SQL} AS norm FROM documents)")
def q_flags(spark, d):
    docs = table(spark, d, "documents").withColumn("norm", normalize_text("text"))
    return docs.select("doc_id", *[contains_any("norm", ws).alias(n) for n, ws in rules.DOC_KEYWORDS.items()])


_LABEL_RULES = [  # (label, spark condition, sql condition), alphabetical by label
    ("english", lambda: F.col("lang") == "en", "lang = 'en'"),
    ("has_digits", lambda: F.col("text").rlike("[0-9]"), "regexp_matches(text, '[0-9]')"),
    ("long", lambda: F.col("n_chars") > 5000, "n_chars > 5000"),
    ("the", lambda: normalize_text("text").contains("the"), f"contains({_NORM_SQL}, 'the')"),
]


@query("q_multi_label", "SELECT doc_id, concat_ws(',', " + ", ".join(
    f"CASE WHEN {sql} THEN '{lab}' END" for lab, _, sql in _LABEL_RULES) + ") AS labels FROM documents")
def q_multi_label(spark, d):
    docs = table(spark, d, "documents")
    labels = F.filter(F.array(*[F.when(cond(), F.lit(lab)) for lab, cond, _ in _LABEL_RULES]),
                      lambda x: x.isNotNull())
    return docs.select("doc_id", sorted_text(labels).alias("labels"))


@query("q_strip", """
SELECT o_orderkey AS key, 'order' AS kind, o_orderpriority || o_orderstatus AS cleaned,
       CAST(length(o_orderpriority || o_orderstatus) AS INTEGER) AS n_chars,
       replace(o_orderpriority, '-', ' ') AS label FROM orders
UNION ALL
SELECT doc_id, 'document', md5(text), CAST(length(text) AS INTEGER), source FROM documents""")
def q_strip(spark, d):
    orders, docs = tables(spark, d, "orders", "documents")
    nul = F.lit("\x00")
    o = orders.select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind"),
                      strip_nul(F.concat("o_orderpriority", nul, "o_orderstatus")).alias("cleaned"),
                      humanize("o_orderpriority", "-").alias("label"))
    o = o.withColumn("n_chars", F.length("cleaned"))
    t = docs.select(F.col("doc_id").alias("key"), F.lit("document").alias("kind"),
                    strip_nul(F.concat(nul, "text", nul)).alias("_clean"),
                    humanize("source", "_").alias("label"))
    t = t.select("key", "kind", F.md5("_clean").alias("cleaned"), F.length("_clean").alias("n_chars"), "label")
    return o.select("key", "kind", "cleaned", "n_chars", "label").unionByName(t)


@query("q_display", """
SELECT c_custkey, concat_ws(', ',
   nullif(CASE WHEN c_acctbal > 5000 THEN c_mktsegment ELSE '' END, ''),
   coalesce(nullif(CASE WHEN c_acctbal > 2000 THEN n_name ELSE '' END, ''),
            nullif(CASE WHEN c_acctbal > 0 THEN 'N' || CAST(n_nationkey AS VARCHAR) END, '')),
   coalesce(nullif(CASE WHEN c_mktsegment <> 'BUILDING' THEN r_name ELSE '' END, ''),
            nullif(substring(r_name, 1, 2), ''))) AS display
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
              LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_display(spark, d):
    customer, nation, region = tables(spark, d, "customer", "nation", "region")
    df = lookup_left_on(customer, nation, "c_nationkey", "n_nationkey", key_type="int")
    df = lookup_left_on(df, region, "n_regionkey", "r_regionkey", key_type="int")
    bal = F.col("c_acctbal")
    df = df.withColumns({
        "city": F.when(bal > 5000, F.col("c_mktsegment")).otherwise(""),
        "state": F.when(bal > 2000, F.col("n_name")).otherwise(""),
        "state_abbr": F.when(bal > 0, F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))),
        "country": F.when(F.col("c_mktsegment") != "BUILDING", F.col("r_name")).otherwise(""),
        "country_code": F.substring("r_name", 1, 2),
    })
    display = join_present(", ", first_nonblank("city"), first_nonblank("state", "state_abbr"),
                           first_nonblank("country", "country_code"))
    return df.select("c_custkey", display.alias("display"))


@query("q_blank", """
SELECT c_custkey, nullif(trim(substring(c_mktsegment, 9, 10)), '') AS segment_tail FROM customer""")
def q_blank(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", blank_to_null(F.trim(F.substring("c_mktsegment", 9, 10))).alias("segment_tail"))


_REMAP = {**rules.COUNTRY_REMAP, "EN": "GB"}


@query("q_remap", f"""
SELECT doc_id, {_cases(_REMAP, "upper(trim(lang))", "upper(trim(lang))")} AS code FROM documents""")
def q_remap(spark, d):
    return table(spark, d, "documents").select("doc_id", remap_code("lang", _REMAP).alias("code"))


@query("q_policy_text", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       'Return flag ' || l_returnflag || ' for ' || CAST(l_quantity AS VARCHAR) || ' units' AS return_text,
       CASE WHEN l_discount > 0 THEN 'Discount of ' || CAST(l_discount AS VARCHAR) END AS discount_text,
       concat_ws(' and ',
         CASE WHEN l_quantity >= 25 THEN 'Quantity is ' || CAST(l_quantity AS VARCHAR) END,
         CASE WHEN l_tax > 0.05 THEN 'Tax is ' || CAST(l_tax AS VARCHAR) END) AS policy,
       CASE WHEN l_returnflag = 'R' THEN 'Returned.'
            WHEN l_returnflag = 'A' THEN 'Accepted' ||
                 CASE WHEN l_discount > 0 THEN ' with ' || replace(CAST(l_discount AS VARCHAR), '.', '_') ELSE '.' END
       END AS flag_text
FROM lineitem""")
def q_policy_text(spark, d):
    li = table(spark, d, "lineitem")
    flag_text = classify([
        (F.col("l_returnflag") == "R", "Returned."),
        (F.col("l_returnflag") == "A",
         F.concat(F.lit("Accepted"),
                  F.when(F.col("l_discount") > 0,
                         F.concat(F.lit(" with "), F.regexp_replace(F.col("l_discount").cast("string"), r"\.", "_")))
                  .otherwise(F.lit(".")))),
    ])
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        sentence("Return flag ", F.col("l_returnflag"), " for ", F.col("l_quantity"), " units").alias("return_text"),
        F.when(F.col("l_discount") > 0, sentence("Discount of ", F.col("l_discount"))).alias("discount_text"),
        join_present(" and ",
                     F.when(F.col("l_quantity") >= 25, sentence("Quantity is ", F.col("l_quantity"))),
                     F.when(F.col("l_tax") > 0.05, sentence("Tax is ", F.col("l_tax")))).alias("policy"),
        flag_text.cast("string").alias("flag_text"))


@query("q_url_rewrite", """
SELECT page_id,
       CASE WHEN url IS NOT NULL THEN split_part(url, '=', 1) || '=affiliate_id' END AS feed_provider_url,
       coalesce(url IS NOT NULL AND url <> '', false) AS published
FROM pages""")
def q_url_rewrite(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id",
                        before_first("url", "=", rules.AFFILIATE_SUFFIX).alias("feed_provider_url"),
                        flag(F.col("url").isNotNull() & (F.col("url") != "")).alias("published"))


@query("q_query_param", """
SELECT page_id, page, TRY_CAST(page AS INTEGER) AS page_no,
       CAST(try_strptime('2024-01-' || lpad(page, 2, '0'), '%Y-%m-%d') AS DATE) AS page_day
FROM (SELECT page_id, nullif(regexp_extract(url, 'page=([\\d-]+)', 1), '') AS page FROM pages)""")
def q_query_param(spark, d):
    pages = table(spark, d, "pages").select("page_id", query_param("url", "page").alias("page"))
    return pages.select("page_id", "page", F.col("page").try_cast("int").alias("page_no"),
                        safe_date(F.concat(F.lit("2024-01-"), F.lpad("page", 2, "0")), "yyyy-MM-dd").alias("page_day"))


# ---------------------------------------------------------- numbers / casts

@query("q_math", f"""
SELECT p_partkey AS key, 'part' AS kind, CAST(floor(p_retailprice / 100) AS BIGINT) AS band,
       {sql_round("p_size * 10.76391")} AS size_sqft,
       CAST(CAST(CASE WHEN p_retailprice <> 0 THEN p_retailprice / 2 ELSE 0 END AS DECIMAL(38,10)) AS DECIMAL(10,2)) AS half_value,
       abs({sql_round("(p_retailprice - 1500) / 3")}) AS per_night,
       CAST({sql_round("p_retailprice")} AS FLOAT) AS rounded
FROM part
UNION ALL
SELECT o_orderkey, 'order', CAST(floor(o_totalprice / 1000) AS BIGINT),
       {sql_round("(o_totalprice / 1000) * 10.76391")},
       CAST(CAST(CASE WHEN o_totalprice <> 0 THEN o_totalprice / 2 ELSE 0 END AS DECIMAL(38,10)) AS DECIMAL(10,2)),
       abs({sql_round("(o_totalprice - 250000) / 3")}),
       CAST({sql_round("o_totalprice")} AS FLOAT)
FROM orders""")
def q_math(spark, d):
    part, orders = tables(spark, d, "part", "orders")
    a = part.select(F.col("p_partkey").alias("key"), F.lit("part").alias("kind"),
                    F.floor(F.col("p_retailprice") / 100).alias("band"),
                    sqft("p_size").alias("size_sqft"),
                    half_value("p_retailprice"),
                    per_night(F.col("p_retailprice") - 1500, 3).alias("per_night"),
                    round_to("p_retailprice", 2, "float").alias("rounded"))
    b = orders.select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind"),
                      F.floor(F.col("o_totalprice") / 1000).alias("band"),
                      sqft(F.col("o_totalprice") / 1000).alias("size_sqft"),
                      half_value("o_totalprice"),
                      per_night(F.col("o_totalprice") - 250000, 3).alias("per_night"),
                      round_to("o_totalprice", 2, "float").alias("rounded"))
    return a.unionByName(b)


def half_value(c):
    return half(c).alias("half_value")


@query("q_casts", """
SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS price_int, CAST(o_custkey AS INTEGER) AS cust_int,
       CAST(o_totalprice AS FLOAT) AS price_float,
       CAST(CAST(o_totalprice AS DECIMAL(38,10)) AS DECIMAL(12,2)) AS price_decimal,
       CAST(o_totalprice AS VARCHAR) AS price_text, CAST(o_orderdate AS DATE) AS order_date,
       TRY_CAST(o_orderpriority AS INTEGER) AS priority_int,
       to_json(struct_pack(o_orderkey := o_orderkey, o_orderstatus := o_orderstatus)) AS struct_json
FROM orders""")
def q_casts(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey", to_type("o_totalprice", "int").alias("price_int"),
        to_type("o_custkey", "int").alias("cust_int"),
        to_type("o_totalprice", "float").alias("price_float"),
        to_type("o_totalprice", "decimal(12,2)").alias("price_decimal"),
        to_type("o_totalprice", "string").alias("price_text"),
        to_type("o_orderdate", "date").alias("order_date"),
        to_type("o_orderpriority", "int", safe=True).alias("priority_int"),
        struct_text(F.struct("o_orderkey", "o_orderstatus")).alias("struct_json"))


# ------------------------------------------------------- defaults / consts

@query("q_defaults", """
SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic,
       coalesce(CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'poor' END, 'unlabelled') AS label_state
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_defaults(spark, d):
    docs, labels = tables(spark, d, "documents", "labels")
    df = lookup_left(docs.select("doc_id"), labels, "doc_id")
    df = df.withColumn("label_state", default(classify([(F.col("quality") == 1, "good"),
                                                        (F.col("quality") == 0, "poor")]), "unlabelled"))
    return fill_defaults(df, {"quality": 0, "toxic": 0}).select("doc_id", "quality", "toxic", "label_state")


@query("q_constants", f"""
SELECT r_regionkey, r_name, CAST(11 AS INTEGER) AS feed, CAST(NULL AS VARCHAR) AS owner_id,
       CAST(1 AS INTEGER) AS min_stay, 'USD' AS currency, DATE '{RUN_DATE}' AS updated_at,
       CAST(epoch(TIMESTAMP '{RUN_TS}') AS BIGINT) AS run_epoch
FROM region""")
def q_constants(spark, d):
    r = table(spark, d, "region")
    r = with_constants(r, {"feed": (rules.FEED_ID, "int"), "owner_id": (None, "string"),
                           "min_stay": (1, "int"), "currency": (rules.DEFAULT_CURRENCY, "string")})
    r = stamp(r, RUN_DATE).withColumn("run_epoch", run_epoch(RUN_TS))
    return r


@query("q_surrogate_key", f"""
SELECT o_orderkey,
       {sql_row_key("o_orderkey", "o_custkey", "CAST(o_orderdate AS DATE)")} AS row_id,
       'BC-' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(CAST(epoch(TIMESTAMP '{RUN_TS}') AS BIGINT) AS VARCHAR) AS history_id
FROM orders""")
def q_surrogate_key(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey",
                    row_key("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date")).alias("row_id"),
                    F.concat_ws("-", F.concat(F.lit(rules.ID_PREFIX), F.col("o_orderkey").cast("string")),
                                run_epoch(RUN_TS).cast("string")).alias("history_id"))


# ------------------------------------------------------------- structs (P)

@query("q_json_extract", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_extract(spark, d):
    ev = table(spark, d, "events")
    ev = ev.withColumn("meta", F.struct("event_type", F.from_json("props", "k INT").alias("payload")))
    return ev.select("event_id", nested("meta.event_type").alias("event_type"), nested("meta.payload.k").alias("k"))


@query("q_pack", "SELECT c_custkey, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def q_pack(spark, d):
    from feedlake.functions import pack_into
    c = pack_into(table(spark, d, "customer"), "info",
                  {"name": "c_name", "balance": "c_acctbal", "segment": "c_mktsegment"})
    return c.select("c_custkey", field("info", "name").alias("name"), field("info", "balance").alias("balance"),
                    field("info", "segment").alias("segment"))


@query("q_withfield", f"""
SELECT c_custkey, c_name AS name, {sql_round("c_acctbal * 1.1")} AS balance, c_mktsegment AS segment
FROM customer""")
def q_withfield(spark, d):
    c = table(spark, d, "customer").withColumn(
        "info", pack({"name": "c_name", "balance": "c_acctbal", "segment": "c_mktsegment"}))
    c = c.withColumn("info", replace_field("info", "balance", F.round(F.col("info.balance") * 1.1, 2)))
    return c.select("c_custkey", "info.*")


@query("q_guarded_struct", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS fulfilled_total,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS fulfilled_priority
FROM orders""")
def q_guarded_struct(spark, d):
    o = table(spark, d, "orders")
    g = guarded(F.col("o_orderstatus") == "F",
                {"total": "o_totalprice", "priority": "o_orderpriority"},
                {"total": "double", "priority": "string"})
    return o.select("o_orderkey", g.alias("g")).select(
        "o_orderkey", F.col("g.total").alias("fulfilled_total"), F.col("g.priority").alias("fulfilled_priority"))


@query("q_final_select", """
SELECT 'BC-' || CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id,
       o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(38,10)) AS DECIMAL(12,2)) AS total,
       CAST(o_orderdate AS DATE) AS ordered_on
FROM orders""")
def q_final_select(spark, d):
    o = table(spark, d, "orders")
    return shape(o, [("order_id", F.concat(F.lit(rules.ID_PREFIX), F.col("o_orderkey").cast("string")), "string"),
                     ("customer_id", "o_custkey", "int"), ("status", "o_orderstatus"),
                     ("total", "o_totalprice", "decimal(12,2)"), ("ordered_on", "o_orderdate", "date")])


# ------------------------------------------------------------------ joins (J)

@query("q_dim_lookup", """
SELECT c_custkey, n_name, r_name
FROM customer LEFT JOIN nation ON CAST(c_nationkey AS VARCHAR) = CAST(n_nationkey AS VARCHAR)
              LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_dim_lookup(spark, d):
    customer, nation, region = tables(spark, d, "customer", "nation", "region")
    df = lookup_left_on(customer, nation, "c_nationkey", "n_nationkey")                 # J13
    df = lookup_left(df, region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")  # J2
    return df.select("c_custkey", "n_name", "r_name")


@query("q_type_category", f"""
SELECT p_partkey, property_type,
       coalesce({_cases(rules.PROPERTY_CATEGORY, "property_type")}, 'Other') AS property_type_category,
       coalesce({_cases(rules.PROPERTY_CATEGORY, "property_type")}, 'Other') = 'Other' AS is_other_type
FROM (SELECT p_partkey, {_cases(rules.PART_TYPE_TO_PROPERTY, "p_type")} AS property_type FROM part)""")
def q_type_category(spark, d):
    from feedlake.plans.listing import property_type, type_category
    part = table(spark, d, "part")
    types = parameter_frame(spark, list(rules.PART_TYPE_TO_PROPERTY.items()), "code string, property_type string")
    cats = parameter_frame(spark, list(rules.PROPERTY_CATEGORY.items()),
                           "property_type string, property_type_category string")
    df = property_type(part, types, "p_type")                                                   # U1
    df = type_category(df, cats)                                                                # U2
    return df.select("p_partkey", "property_type", "property_type_category",
                     flag(F.col("property_type_category") == rules.OTHER_CATEGORY).alias("is_other_type"))


@query("q_state_left", """
WITH s AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01 00:00:00')
SELECT c_custkey, s.o_orderkey AS state_orderkey, CAST(s.o_orderdate AS DATE) AS state_orderdate,
       s.o_totalprice AS state_total
FROM customer LEFT JOIN s ON s.o_custkey = c_custkey AND s.rn = 1""")
def q_state_left(spark, d):
    customer, orders = tables(spark, d, "customer", "orders")
    state = (orders.filter(F.col("o_orderdate") < _ts("1997-01-01 00:00:00"))
             .select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("state_orderkey"),
                     F.col("o_orderdate").alias("_od"), F.col("o_totalprice").alias("state_total")))
    df = join_state(customer.select("c_custkey"), state, "c_custkey", order=["_od", "state_orderkey"])   # J1
    return df.select("c_custkey", "state_orderkey", F.col("_od").cast("date").alias("state_orderdate"), "state_total")


@query("q_semi_state", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_semi_state(spark, d):
    from feedlake.sources import state_for_keys
    customer, orders = tables(spark, d, "customer", "orders")
    keys = customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return state_for_keys(orders, keys, "o_custkey").select("o_orderkey", "o_custkey", "o_totalprice")  # S3/J14


@query("q_worklist", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_worklist(spark, d):
    from feedlake.plans.location import missing_state
    docs, labels = tables(spark, d, "documents", "labels")
    return missing_state(docs.select("doc_id", "lang", "source", "n_chars"), labels.select("doc_id"), "doc_id")


@query("q_override", f"""
WITH a AS (SELECT o_custkey, avg(CAST(o_totalprice AS DECIMAL(18,2))) AS avg_price FROM orders GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN c_acctbal IS NOT NULL AND c_acctbal > 0 THEN c_acctbal
                       ELSE {sql_round("a.avg_price")} END AS balance
FROM customer LEFT JOIN a ON a.o_custkey = c_custkey""")
def q_override(spark, d):
    customer, orders = tables(spark, d, "customer", "orders")
    avg = (orders.groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(money(F.avg(F.col("o_totalprice").cast("decimal(18,2)"))).alias("avg_price")))
    df = attach(customer, avg, "c_custkey")                                               # J3
    return df.select("c_custkey", override_if("c_acctbal", "avg_price", keep="positive").alias("balance"))  # P10


@query("q_fill_twin", """
SELECT c_custkey,
       coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END, s_name) AS name,
       coalesce(CASE WHEN c_acctbal > 0 THEN c_nationkey END, s_nationkey) AS nationkey,
       coalesce(CASE WHEN c_acctbal > 1000 THEN c_acctbal END, s_acctbal) AS acctbal
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def q_fill_twin(spark, d):
    supplier, customer = tables(spark, d, "supplier", "customer")
    base = customer.select("c_custkey",
                           F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
                           F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("nationkey"),
                           F.when(F.col("c_acctbal") > 1000, F.col("c_acctbal")).alias("acctbal"))
    twin = supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name_twin"),
                           F.col("s_nationkey").alias("nationkey_twin"), F.col("s_acctbal").alias("acctbal_twin"))
    return fill_from(enrich_left(base, twin, "c_custkey"), "_twin", ["name", "nationkey", "acctbal"])   # P11


@query("q_first_elem_join", """
SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, p_name
FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey""")
def q_first_elem_join(spark, d):
    orders, li, part = tables(spark, d, "orders", "lineitem", "part")
    li = li.withColumn("ids", F.array("l_partkey", "l_suppkey"))
    df = join_first_element(li, "ids", part.select("p_partkey", "p_name"), "p_partkey")      # J4
    df = match(df, orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey")  # J8
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", "p_name")


def _stored_and_fresh(orders, li):
    stored = (orders.filter(F.col("o_orderstatus") == "F")
              .select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("usd_price")))
    fresh = (li.filter(F.col("l_shipdate") >= _ts("1998-01-01 00:00:00"))
             .groupBy(F.col("l_orderkey").alias("key"))
             .agg(F.sum("l_extendedprice").alias("book"))
             .select("key", per_night("book", rules.PRICE_NIGHTS).alias("search_usd_price"))
             .fillna({"search_usd_price": 0}))
    return stored, fresh


_RESOLVE_SQL = f"""
WITH stored AS (SELECT o_orderkey AS key, o_totalprice AS usd_price FROM orders WHERE o_orderstatus = 'F'),
fresh AS (SELECT l_orderkey AS key, abs({sql_round("sum(l_extendedprice) / 3")}) AS search_usd_price
          FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY l_orderkey),
r AS (SELECT coalesce(stored.key, fresh.key) AS key, stored.usd_price, fresh.search_usd_price,
             coalesce((stored.usd_price IS NULL OR stored.usd_price <= 0) AND fresh.search_usd_price >= 0, false) AS from_search
      FROM stored FULL OUTER JOIN fresh ON stored.key = fresh.key)"""


@query("q_price_resolve", _RESOLVE_SQL + f"""
SELECT key, {sql_round("CASE WHEN from_search THEN search_usd_price ELSE usd_price END")} AS usd_price, from_search FROM r""")
def q_price_resolve(spark, d):
    from feedlake.plans.price import resolve_price
    orders, li = tables(spark, d, "orders", "lineitem")
    stored, fresh = _stored_and_fresh(orders, li)
    return resolve_price(stored, fresh, "key")                                             # J7


@query("q_price_history", _RESOLVE_SQL + f"""
SELECT 'BC-' || CAST(key AS VARCHAR) AS property_id,
       {sql_round("CASE WHEN from_search THEN search_usd_price ELSE usd_price END")} AS price,
       CAST(o_orderdate AS DATE) AS checkin, CAST(o_orderdate AS DATE) + 3 AS checkout, CAST(11 AS INTEGER) AS feed,
       {sql_row_key("'BC-' || CAST(key AS VARCHAR)", "CAST(o_orderdate AS DATE)", "CAST(o_orderdate AS DATE) + 3")} AS id
FROM r JOIN orders ON o_orderkey = key WHERE from_search""")
def q_price_history(spark, d):
    from feedlake.plans.price import resolve_price, changed_price_history
    orders, li = tables(spark, d, "orders", "lineitem")
    stored, fresh = _stored_and_fresh(orders, li)
    resolved = resolve_price(stored, fresh, "key")
    checkin = F.col("o_orderdate").cast("date")
    search = orders.select(
        F.col("o_orderkey").alias("key"),
        F.concat(F.lit("https://book.example/h?checkin="), checkin.cast("string"),
                 F.lit("&checkout="), F.date_add(checkin, 3).cast("string"), F.lit("&rooms=1")).alias("deep_link_url"))
    hist = changed_price_history(resolved, search, "key")                                  # J8, F12, F13
    hist = hist.withColumn("property_id", F.concat(F.lit(rules.ID_PREFIX), F.col("key").cast("string")))
    hist = hist.withColumn("feed", F.lit(rules.FEED_ID).cast("int"))
    return hist.select("property_id", F.col("usd_price").alias("price"), "checkin", "checkout", "feed",
                       row_key("property_id", "checkin", "checkout").alias("id"))            # F19


@query("q_reviews", """
SELECT CAST(c.conv_id AS VARCHAR) || '-' || CAST(c.turn AS VARCHAR) AS id, 'BC-' || CAST(d.doc_id AS VARCHAR) AS property_id,
       c.role AS language_code, CAST(length(c.text) AS INTEGER) AS summary_chars, d.source AS country_code,
       CAST(11 AS INTEGER) AS feed
FROM conversations c JOIN documents d ON d.doc_id = c.conv_id AND d.lang = 'en'""")
def q_reviews(spark, d):
    from feedlake.plans.reviews import reviews
    conv, docs = tables(spark, d, "conversations", "documents")
    # review feed rows: each turn is one review held in the row's nested array
    feed = conv.select(F.col("conv_id").alias("id"),
                       F.array(F.struct(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
                                        F.col("role").alias("language"), F.col("text").alias("summary"))).alias("reviews"))
    owners = docs.filter(F.col("lang") == "en").select(
        F.concat(F.lit(rules.ID_PREFIX), F.col("doc_id").cast("string")).alias("id"),
        F.col("doc_id").alias("feed_provider_id"), F.col("source").alias("country_code"))
    out = reviews(owners, feed)                                                            # G1 + J12
    return out.select("id", "property_id", "language_code", F.length("summary").alias("summary_chars"),
                      "country_code", "feed")


# ------------------------------------------------------------ aggregates (A)

@query("q_child_rollup", f"""
WITH l AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
                  avg(CAST(l_extendedprice AS DECIMAL(18,2))) AS avg_price,
                  string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS line_numbers
           FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_totalprice, coalesce(n_lines, 0) AS n_lines, {sql_round("sum_qty")} AS sum_qty,
       {sql_round("avg_price")} AS avg_price, line_numbers
FROM orders LEFT JOIN l ON l.l_orderkey = o_orderkey""")
def q_child_rollup(spark, d):
    orders, li = tables(spark, d, "orders", "lineitem")
    li = li.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_linenumber",
                   F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    sums = rollup_children(li, "o_orderkey", sums=["l_quantity"], avgs=["price"], counts="n_lines",   # A7
                           lists={"lines": "l_linenumber"})                                          # A1
    df = attach(orders.select("o_orderkey", "o_totalprice"), sums, "o_orderkey")                     # J6
    return df.select("o_orderkey", "o_totalprice", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                     F.round("l_quantity", 2).alias("sum_qty"), money(F.col("avg_price")).alias("avg_price"),
                     F.array_join("lines", ",").alias("line_numbers"))


_FIRST_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


@query("q_first_flagged", f"""
WITH r AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_FIRST_ORDER)}) AS rn_all,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END,
                            {", ".join(_FIRST_ORDER)}) AS rn_flag
  FROM lineitem)
SELECT l_orderkey, max(CASE WHEN rn_flag = 1 THEN l_partkey END) AS feature_partkey,
       max(CASE WHEN rn_all = 1 THEN l_linenumber END) AS first_linenumber, count(*) AS n_lines
FROM r GROUP BY l_orderkey""")
def q_first_flagged(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(
        first_where_agg("l_partkey", F.col("l_returnflag") == "R", _FIRST_ORDER).alias("feature_partkey"),  # A6
        first_non_null("l_linenumber", _FIRST_ORDER).alias("first_linenumber"),                           # A5
        F.count(F.lit(1)).alias("n_lines"))


@query("q_collect_set", """
SELECT p_brand, array_to_string(list_sort(list_distinct(list(p_type))), ',') AS types,
       array_to_string(list_sort(list_distinct(list(p_size))), ',') AS sizes, count(*) AS n_parts
FROM part GROUP BY p_brand""")
def q_collect_set(spark, d):
    part = table(spark, d, "part")
    sets = collect_sets(part, "p_brand", ["p_type", "p_size"], counts="n_parts")              # A3
    return sets.select(
        "p_brand", F.array_join("p_type_set", ",").alias("types"), F.array_join("p_size_set", ",").alias("sizes"),
        "n_parts")


@query("q_struct_set", """
WITH p AS (SELECT l_orderkey, string_agg(DISTINCT l_returnflag || '/' || l_linestatus, ','
                                         ORDER BY l_returnflag || '/' || l_linestatus) AS pairs
           FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_orderstatus, coalesce(pairs, '') AS pairs FROM orders LEFT JOIN p ON p.l_orderkey = o_orderkey""")
def q_struct_set(spark, d):
    orders, li = tables(spark, d, "orders", "lineitem")
    sets = collect_distinct_structs(li.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey",
                                    ["l_returnflag", "l_linestatus"], alias="items")          # A4
    df = attach(orders.select("o_orderkey", "o_orderstatus"), sets, "o_orderkey")
    text = F.array_join(F.transform(F.coalesce("items", F.array()),
                                    lambda x: F.concat(x["l_returnflag"], F.lit("/"), x["l_linestatus"])), ",")
    return df.select("o_orderkey", "o_orderstatus", text.alias("pairs"))


def _synonym_values_sql(mapping: dict) -> str:
    rows = []
    for k, v in mapping.items():
        for c in (v if isinstance(v, list) else [v]):
            rows.append(f"('{k}', '{c}')")
    return "VALUES " + ", ".join(rows)


@query("q_elem_lookup", f"""
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS word FROM documents),
s AS (SELECT * FROM ({_synonym_values_sql(rules.WORD_SYNONYMS)}) t(slug, category)),
m AS (SELECT doc_id, string_agg(DISTINCT category, ',' ORDER BY category) AS categories
      FROM w JOIN s ON lower(regexp_replace(w.word, '[^a-zA-Z0-9]', '-', 'g')) = s.slug GROUP BY doc_id)
SELECT d.doc_id, coalesce(m.categories, '') AS categories FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id""")
def q_elem_lookup(spark, d):
    # per-character slug of every word; slugging the whole text once (keeping
    # whitespace) before splitting gives the same words as slugging each word
    slugged = F.regexp_replace(F.lower("text"), r"[^a-zA-Z0-9\s]", "-")
    docs = table(spark, d, "documents").select("doc_id", F.split(slugged, r"\s+").alias("slugs"))
    out = lookup_elements(docs, "doc_id", "slugs", rules.WORD_SYNONYMS, "categories", flatten_values=True)  # J5
    return out.select("doc_id", sorted_text("categories").alias("categories"))


@query("q_map_lookup", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       concat_ws(',', lower(regexp_replace({_cases(rules.CODE_NAMES, "l_returnflag")}, '[^a-zA-Z0-9]', '-', 'g')),
                      lower(regexp_replace({_cases(rules.CODE_NAMES, "l_linestatus")}, '[^a-zA-Z0-9]', '-', 'g'))) AS code_slugs,
       CAST((CASE WHEN l_returnflag IN ({", ".join(f"'{k}'" for k in rules.CODE_NAMES)}) THEN 1 ELSE 0 END)
          + (CASE WHEN l_linestatus IN ({", ".join(f"'{k}'" for k in rules.CODE_NAMES)}) THEN 1 ELSE 0 END) AS INTEGER) AS n_known
FROM lineitem""")
def q_map_lookup(spark, d):
    li = table(spark, d, "lineitem")
    names = map_lookup(F.array("l_returnflag", "l_linestatus"), rules.CODE_NAMES)             # R1 R2
    li = li.withColumn("names", names)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.array_join(slugify_all("names"), ",").alias("code_slugs"),              # R10
                     F.size("names").alias("n_known"))


@query("q_array_pluck", """
SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles,
       CAST(sum(len(string_split(text, ' '))) AS INTEGER) AS n_words, count(*) AS n_turns
FROM conversations GROUP BY conv_id""")
def q_array_pluck(spark, d):
    conv = table(spark, d, "conversations")
    # only (turn, role) is collected; words are counted in the row and summed
    turns = conv.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("turns"),                    # A1
        F.sum(F.size(F.split("text", " "))).cast("int").alias("n_words"),
        F.count(F.lit(1)).alias("n_turns"))
    return turns.select("conv_id", F.array_join(pluck("turns", "role"), ",").alias("roles"),      # P3
                        "n_words", "n_turns")


_MEAL_IN = ", ".join(f"'{w}'" for w in rules.MEAL_WORDS)


@query("q_array_clean", f"""
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents),
m AS (SELECT doc_id, string_agg(DISTINCT upper(word[1:1]) || word[2:], ','
                                ORDER BY upper(word[1:1]) || word[2:]) AS meal_plan
      FROM w WHERE word IN ({_MEAL_IN}) GROUP BY doc_id)
SELECT d.doc_id, m.meal_plan FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id""")
def q_array_clean(spark, d):
    docs = table(spark, d, "documents")
    whole_words = F.lit(f"(?<![a-z])(?:{'|'.join(rules.MEAL_WORDS)})(?![a-z])")
    # one inner array per line; empty lines give a null inner array
    per_line = F.transform(F.split("text", "\n"), lambda line: F.when(
        F.length(line) > 0, F.regexp_extract_all(F.lower(line), whole_words, F.lit(0))))
    meals = empty_to_null(flat_distinct(per_line, F.initcap))                                  # R7 R5
    return docs.select("doc_id", F.array_join(F.sort_array(meals), ",").alias("meal_plan"))


@query("q_array_union", """
SELECT d.doc_id, d.lang || ',' || d.source || CASE WHEN l.quality = 1 THEN ',quality' ELSE '' END AS tags,
       CAST(CASE WHEN l.quality = 1 THEN 3 ELSE 2 END AS INTEGER) AS n_tags
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_array_union(spark, d):
    docs, labels = tables(spark, d, "documents", "labels")
    df = enrich_left(docs.select("doc_id", "lang", "source"), labels, "doc_id")
    tags = add_tag(F.array("lang", "source"), "quality", F.col("quality") == 1)                  # R6
    df = df.withColumn("tags", tags).withColumn("tags", add_tag("tags", "en", F.col("toxic") == 2))
    return df.select("doc_id", F.array_join("tags", ",").alias("tags"), F.size("tags").alias("n_tags"))


@query("q_distinct_explode", """
SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents""")
def q_distinct_explode(spark, d):
    docs = table(spark, d, "documents")
    return distinct_elements(docs, F.split(F.lower("text"), "[^a-z]+"), "word")               # A9


# ---------------------------------------------------- generators / language

@query("q_fanout", """
SELECT n_nationkey, language_code,
       CASE WHEN language_code IN ('en-us', 'en-gb') THEN 'en' ELSE language_code END AS locale_code
FROM nation, (SELECT unnest(['en-us', 'fr', 'es', 'de']) AS language_code)""")
def q_fanout(spark, d):
    from feedlake.plans.localize import localize_codes
    nation = table(spark, d, "nation")
    return localize_codes(nation.withColumn("languages", constant_array(rules.LANGUAGES))).select(   # G3 R8
        "n_nationkey", "language_code", "locale_code")


def _locale_sql(expr: str) -> str:
    whens = " ".join(f"WHEN {expr} = '{v['code']}' THEN '{k}'" for k, v in rules.LOCALES.items() if not v.get("disabled"))
    return f"(CASE {whens} END)"


@query("q_locale", f"""
SELECT doc_id, lang, {_locale_sql("CASE WHEN lang IN ('en-us', 'en-gb') THEN 'en' ELSE lang END")} AS language
FROM documents""")
def q_locale(spark, d):
    from feedlake.plans.localize import language_name
    docs = table(spark, d, "documents").withColumn(
        "locale_code", F.when(F.col("lang").isin(*rules.ENGLISH_CODES), "en").otherwise(F.col("lang")))
    return language_name(docs, rules.LOCALES).select("doc_id", "lang", "language")             # F18


@query("q_localize", """
SELECT n_nationkey, language_code,
       coalesce(CASE language_code WHEN 'en-us' THEN n_name
                                  WHEN 'fr' THEN CASE WHEN n_regionkey <> 0 THEN 'fr:' || n_name END
                                  WHEN 'es' THEN CASE WHEN n_regionkey <> 1 THEN 'es:' || n_name END
                                  WHEN 'de' THEN 'de:' || n_name END, n_name) AS local_name,
       CASE language_code WHEN 'en-us' THEN n_name WHEN 'fr' THEN lower(n_name) END AS map_name
FROM nation, (SELECT unnest(['en-us', 'fr', 'es', 'de']) AS language_code)""")
def q_localize(spark, d):
    nation = table(spark, d, "nation")
    df = nation.withColumns({
        "name_en": F.col("n_name"),
        "name_fr": F.when(F.col("n_regionkey") != 0, F.concat(F.lit("fr:"), "n_name")),
        "name_es": F.when(F.col("n_regionkey") != 1, F.concat(F.lit("es:"), "n_name")),
        "name_de": F.concat(F.lit("de:"), "n_name"),
        "names": F.create_map(F.lit("en-us"), F.col("n_name"), F.lit("fr"), F.lower("n_name")),
    })
    df = fan_out(df, rules.LANGUAGES)
    by_lang = by_language({"en-us": "name_en", "fr": "name_fr", "es": "name_es", "de": "name_de"}, "language_code")  # R3
    return df.select("n_nationkey", "language_code", F.coalesce(by_lang, F.col("name_en")).alias("local_name"),
                     localized("names", F.col("language_code")).alias("map_name"))             # P2


@query("q_lookup_fallback", f"""
WITH r AS (
  SELECT r_regionkey, language_code,
         trim(coalesce(nullif(CASE language_code WHEN 'en-us' THEN r_name
                                                 WHEN 'fr' THEN CASE WHEN length(r_name) > 5 THEN lower(r_name) END
                                                 WHEN 'es' THEN '' END, ''),
                       CASE WHEN r_regionkey <> 4 THEN {sql_initcap("r_name")} END, '')) AS name
  FROM region, (SELECT unnest(['en-us', 'fr', 'es', 'de']) AS language_code))
SELECT n_nationkey, nl.language_code, r.name AS region_name
FROM (SELECT n_nationkey, n_regionkey, language_code FROM nation, (SELECT unnest(['en-us', 'fr', 'es', 'de']) AS language_code)) nl
JOIN r ON r.r_regionkey = nl.n_regionkey AND r.language_code = nl.language_code
WHERE r.name <> ''""")
def q_lookup_fallback(spark, d):
    nation, region = tables(spark, d, "nation", "region")
    names = F.create_map(F.lit("en-us"), F.col("r_name"),
                         F.lit("fr"), F.when(F.length("r_name") > 5, F.lower("r_name")),
                         F.lit("es"), F.lit(""),
                         F.lit("fallback"), F.when(F.col("r_regionkey") != 4, F.initcap("r_name")))
    rows = localized_rows(region.select("r_regionkey", names.alias("names")), "names", rules.LANGUAGES)  # S4
    rows = rows.select(F.col("r_regionkey").alias("n_regionkey"), "language_code", F.col("name").alias("region_name"))
    fan = fan_out(nation.select("n_nationkey", "n_regionkey"), rules.LANGUAGES)
    return match(fan, rows, ["n_regionkey", "language_code"]).select("n_nationkey", "language_code", "region_name")  # J9


@query("q_broadcast_feature", f"""
WITH langs AS (SELECT unnest(['en-us', 'fr', 'es', 'de']) AS language_code),
fac AS (  -- facility catalogue: a nation is a facility of its region's type
  SELECT n_nationkey AS facility_id, n_regionkey AS type_id, language_code,
         CASE WHEN language_code = 'fr' THEN lower(n_name) ELSE n_name END AS name
  FROM nation, langs),
grp AS (SELECT type_id, language_code, string_agg(DISTINCT name, chr(10) ORDER BY name) AS fdescription
        FROM fac GROUP BY type_id, language_code),
feat AS (SELECT f.facility_id, f.language_code, replace(replace(r_name, ' ', '_'), '_', ' ') AS fname, g.fdescription
         FROM fac f JOIN grp g ON g.type_id = f.type_id AND g.language_code = f.language_code
         JOIN region ON r_regionkey = f.type_id),
cf AS (SELECT DISTINCT c_custkey, language_code, unnest([c_nationkey, (c_nationkey + 3) % 25]) AS facility_id
       FROM customer, langs),
items AS (SELECT DISTINCT cf.c_custkey, cf.language_code, feat.fname, feat.fdescription
          FROM cf JOIN feat ON feat.facility_id = cf.facility_id AND feat.language_code = cf.language_code)
SELECT c.c_custkey, l.language_code,
       coalesce((SELECT string_agg(fname || ':' || replace(fdescription, chr(10), '|'), ';' ORDER BY fname, fdescription)
                 FROM items i WHERE i.c_custkey = c.c_custkey AND i.language_code = l.language_code), '') AS feature_summary
FROM customer c, langs l""")
def q_broadcast_feature(spark, d):
    from feedlake.plans.localize import feature_summary_from_frames
    nation, region, customer = tables(spark, d, "nation", "region", "customer")
    facilities = fan_out(nation, rules.LANGUAGES).select(
        F.col("n_nationkey").cast("string").alias("facility_id"),
        F.col("n_regionkey").cast("string").alias("facility_type_id"), "language_code",
        F.when(F.col("language_code") == "fr", F.lower("n_name")).otherwise(F.col("n_name")).alias("name"))
    types = fan_out(region, rules.LANGUAGES).select(
        F.col("r_regionkey").cast("string").alias("facility_type_id"), "language_code",
        F.regexp_replace("r_name", " ", "_").alias("type_name"))
    listings = customer.select(
        F.col("c_custkey").alias("id"), constant_array(rules.LANGUAGES).alias("languages"),
        F.array(F.struct(F.col("c_nationkey").cast("long").alias("id")),
                F.struct(((F.col("c_nationkey") + 3) % 25).cast("long").alias("id"))).alias("facilities"))
    out = feature_summary_from_frames(listings, facilities, types)                             # A3 J9 J10 J11 A4 F11
    text = F.array_join(F.transform(F.coalesce("feature_summary", F.array()), lambda x: F.concat(
        x["name"], F.lit(":"), F.regexp_replace(x["description"], "\n", "|"))), ";")
    return out.select(F.col("id").alias("c_custkey"), "language_code", text.alias("feature_summary"))


@query("q_deep_explode", """
WITH l AS (
  SELECT l_orderkey, l_linenumber AS room_id, l_linestatus AS bed_type, CAST(l_quantity AS INTEGER) AS number_of_beds FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_returnflag, 1 FROM lineitem)
SELECT l.l_orderkey, CAST(room_id AS BIGINT) AS room_id, bed_type, number_of_beds, c_custkey, n_name
FROM l JOIN orders ON o_orderkey = l.l_orderkey JOIN customer ON c_custkey = o_custkey
       LEFT JOIN nation ON n_nationkey = c_nationkey""")
def q_deep_explode(spark, d):
    orders, customer, nation, li = tables(spark, d, "orders", "customer", "nation", "lineitem")
    bed = lambda t, n: F.struct(t.alias("bed_type"), n.alias("number_of_beds"))
    rooms = F.array(F.struct(
        F.col("l_linenumber").cast("long").alias("id"),
        F.array(F.struct(F.array(F.struct(F.array(
            bed(F.col("l_linestatus"), F.col("l_quantity").cast("int")),
            bed(F.col("l_returnflag"), F.lit(1))).alias("configuration"))).alias("bed_configurations"))).alias("bed_options")))
    nested_rows = li.select("l_orderkey", rooms.alias("rooms"))
    flat = explode_path(nested_rows, ["rooms", "bed_options", "bed_configurations", "configuration"], "bed",
                        keep={"room_id": (0, "id")})                                          # G4
    flat = flat.select("l_orderkey", "room_id", "bed.bed_type", "bed.number_of_beds")
    flat = match(flat, orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")), "l_orderkey")
    flat = match(flat, customer.select("c_custkey", "c_nationkey"), "c_custkey")
    flat = lookup_left_on(flat, nation.select("n_nationkey", "n_name"), "c_nationkey", "n_nationkey", key_type="int")
    return flat.select("l_orderkey", "room_id", "bed_type", "number_of_beds", "c_custkey", "n_name")


# -------------------------------------------------------------- dedupe etc.

@query("q_dedupe", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_dedupe(spark, d):
    ev = located(table(spark, d, "events")).select("user_id", "event_id", "ts", "event_type", "value", LOCATOR)
    return dedupe(ev, "user_id", ["ts", "event_id"], locator=LOCATOR)                        # A8


@query("q_topn_sample", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def q_topn_sample(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sample(o, 100, [F.col("o_totalprice").desc(), F.col("o_orderkey")])                # S10


@query("q_upsert", """
WITH changes AS (SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal, c_mktsegment FROM customer
                 WHERE c_mktsegment = 'BUILDING')
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
WHERE c_acctbal < 5000 AND c_custkey NOT IN (SELECT c_custkey FROM changes)
UNION ALL SELECT * FROM changes""")
def q_upsert(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    existing = c.filter(F.col("c_acctbal") < 5000)
    changes = (c.filter(F.col("c_mktsegment") == "BUILDING")
               .withColumn("c_acctbal", F.col("c_acctbal") + 100))
    return merge_by_key(existing, changes, "c_custkey")                                      # S7


@query("q_counts", """
SELECT 'events' AS table_name, count(*) AS n_rows, count(*) = 0 AS is_empty FROM events
UNION ALL SELECT 'region', count(*), count(*) = 0 FROM region
UNION ALL SELECT 'labels_quality_2', count(*), count(*) = 0 FROM labels WHERE quality > 1""")
def q_counts(spark, d):
    ev, region, labels = tables(spark, d, "events", "region", "labels")
    return row_counts({"events": ev, "region": region,
                       "labels_quality_2": labels.filter(F.col("quality") > 1)})               # A10


# --------------------------------------------- operators on their own

@query("q_state_absent", """
SELECT c_custkey, CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS VARCHAR) AS parent_path, CAST(NULL AS VARCHAR) AS state
FROM customer""")
def q_state_absent(spark, d):
    from feedlake import schemas
    from feedlake.sources import read_if_exists
    state = read_if_exists(spark, "feedlake_no_such_state", schemas.LOCATION)                # S2 S5
    keyed = table(spark, d, "customer").select("c_custkey", F.concat(F.lit(rules.ID_PREFIX), F.col("c_custkey")).alias("id"))
    return join_state(keyed, state, "id").select("c_custkey", "location_id",
                                                 F.array_join("parent_path", "/").alias("parent_path"), "state")


@query("q_only", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_quantity > 45 AND l_returnflag = 'R'""")
def q_only(spark, d):
    li = table(spark, d, "lineitem")
    kept = only(li, (F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R"))             # P6
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("q_flat_distinct", """
SELECT l_suppkey, array_to_string(list_sort(list_distinct(flatten(list([l_returnflag, l_linestatus])))), ',') AS codes
FROM lineitem GROUP BY l_suppkey""")
def q_flat_distinct(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", F.array("l_returnflag", "l_linestatus").alias("codes"))
    return collect_flat_distinct(li, "l_suppkey", "codes", alias="codes").select(             # A2
        "l_suppkey", F.array_join("codes", ",").alias("codes"))


@query("q_elem_lookup_join", ORACLE["q_elem_lookup"])
def q_elem_lookup_join(spark, d):
    slugged = F.regexp_replace(F.lower("text"), r"[^a-zA-Z0-9\s]", "-")
    docs = table(spark, d, "documents").select("doc_id", F.split(slugged, r"\s+").alias("slugs"))
    rows = [(k, c) for k, v in rules.WORD_SYNONYMS.items() for c in (v if isinstance(v, list) else [v])]
    dim = parameter_frame(spark, rows, "slug string, category string")
    out = lookup_elements(docs, "doc_id", "slugs", dim, "categories", dim_key="slug", value="category")  # J5 G2
    return out.select("doc_id", F.array_join("categories", ",").alias("categories"))


@query("q_join_array", """
SELECT c_custkey, c_name || ' | ' || c_mktsegment AS label FROM customer""")
def q_join_array(spark, d):
    c = table(spark, d, "customer").withColumn("parts", F.array("c_name", "c_mktsegment"))
    return c.select("c_custkey", join_array("parts", " | ").alias("label"))                   # F10
