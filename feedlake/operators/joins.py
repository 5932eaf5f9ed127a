"""Equi-join operators.

No operator picks a join strategy by counting rows: Spark's byte threshold and
AQE's runtime sizes decide, and building a plan starts no job.  Only lookups
made from run parameters (``sources.feeds.lookup_frame``, at most
``LOOKUP_MAX_KEYS`` keys) carry a broadcast hint, set where they are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.operators.aggregates import dedupe


def _keys(on):
    return [on] if isinstance(on, str) else list(on)


def lookup_left(df: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Left dimension lookup on one or more same-named keys.
    Row count of ``df`` is kept provided the dimension key is unique."""
    return df.join(dim, _keys(on), "left")


def lookup_left_on(df: DataFrame, dim: DataFrame, left_key, right_key: str, key_type: str = "string") -> DataFrame:
    """Left lookup where the keys differ in name or type (J13): both sides are
    cast to ``key_type`` so a text key never meets a numeric one under ANSI rules."""
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    return df.join(dim, lk.cast(key_type) == dim[right_key].cast(key_type), "left")


def enrich_left(df: DataFrame, other: DataFrame, key="id") -> DataFrame:
    """Left enrichment by entity id."""
    return df.join(other, _keys(key), "left")


def join_first_element(df: DataFrame, array_col: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Left join on the first element of an array column (J4); an empty or null
    array matches nothing."""
    return df.join(dim, F.get(F.col(array_col), 0) == dim[dim_key], "left")


def attach(df: DataFrame, agg: DataFrame, key="id") -> DataFrame:
    """Re-join child aggregates to the parent."""
    return df.join(agg, _keys(key), "left")


def reconcile(stored: DataFrame, fresh: DataFrame, key) -> DataFrame:
    """Full outer join of stored and fresh rows on ``key``."""
    return stored.join(fresh, _keys(key), "full_outer")


def match(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Inner join on one key or a composite key."""
    return df.join(other, _keys(keys), "inner")


def attach_keep_left(df: DataFrame, other: DataFrame, keys, cols) -> DataFrame:
    """Composite left join that keeps every left column and adds ``cols`` from
    the right (J11)."""
    keys = _keys(keys)
    right = other.select(*keys, *cols)
    return df.join(right, keys, "left")


def children_with_owner(children: DataFrame, owners: DataFrame, key) -> DataFrame:
    """Children whose owner exists (J12): an inner join; orphans are dropped."""
    return children.join(owners, _keys(key), "inner")


def restrict_to(state: DataFrame, keys: DataFrame, key="id") -> DataFrame:
    """State rows whose key occurs in ``keys`` (J14, S3): a left-semi join, so no
    key list is ever collected to the driver."""
    k = _keys(key)
    return state.join(keys.select(*k), k, "left_semi")


def join_state(df: DataFrame, state: DataFrame, key="id", order=None) -> DataFrame:
    """Left join to existing state with at most one state row per key.
    The state is de-duplicated first (keeping the greatest ``order``), so the
    join cannot multiply batch rows."""
    return df.join(dedupe(state, _keys(key), order), _keys(key), "left")


def lookup_elements(df: DataFrame, key: str, array_col: str, dim, out: str,
                    dim_key: str | None = None, value: str | None = None,
                    flatten_values: bool = False) -> DataFrame:
    """Per-element lookup of an array column.

    * ``dim`` a dict: translated inside the row through a literal lookup; no
      explode and no shuffle.  ``flatten_values`` flattens list values.
    * ``dim`` a DataFrame: distinct elements exploded (outer), joined to ``dim``,
      regrouped per ``key`` as sets (which combine map-side) and re-attached.
    Unknown elements are dropped and the result is de-duplicated.
    """
    from feedlake.functions.arrays import map_lookup, flat_distinct

    if isinstance(dim, dict):
        if flatten_values:
            lists = {k: list(v) if isinstance(v, (list, tuple)) else [v] for k, v in dim.items()}
            looked = map_lookup(F.col(array_col), lists, key_type=None)
            return df.withColumn(out, flat_distinct(looked))
        return df.withColumn(out, F.array_distinct(map_lookup(F.col(array_col), dim, key_type=None)))

    from feedlake.operators.generators import explode_rows
    distinct = df.select(key, F.array_distinct(array_col).alias("_elems"))
    elems = explode_rows(distinct, "_elems", "_elem", outer=True).select(key, "_elem")  # G2
    values = dim.select(F.col(dim_key).alias("_elem"), F.col(value).alias("_val"))
    if flatten_values and dict(values.dtypes)["_val"].startswith("array"):
        values = values.select("_elem", F.explode("_val").alias("_val"))
    grouped = elems.join(values, "_elem", "left").groupBy(key).agg(F.sort_array(F.collect_set("_val")).alias(out))
    return df.join(grouped, key, "left")
