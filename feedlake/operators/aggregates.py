"""Aggregation and de-duplication (A1-A10).

Every aggregate here has a partial (map-side) phase: ``min_by`` / ``max_by`` /
``sum`` / ``collect_set`` combine before the shuffle, so a hot key holding a
large share of the rows does not land on one task as raw rows.  ``min_by`` and
``max_by`` over whole rows plan as sort aggregates, the others as (object) hash
aggregates; ``collect_sorted`` keeps every row of a key by its nature.  Ordering is explicit wherever the reference relied on the
undefined order of ``first`` / ``collect_list`` after a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in ([cs] if isinstance(cs, (str, Column)) else cs)]


def _names(cs):
    return [cs] if isinstance(cs, str) else list(cs)


def order_key(order) -> Column:
    """A struct of the ordering columns; structs compare field by field."""
    return F.struct(*_cols(order))


def row_hash(df: DataFrame, columns) -> Column:
    """A 64-bit hash of the columns' values; maps are hashed as their sorted entries."""
    return F.xxhash64(*[_hashable(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns])


def _hashable(c: Column, kind: T.DataType) -> Column:
    """``c`` without maps, which have no order and hence no hash of their own."""
    if not _holds_map(kind):
        return c
    if isinstance(kind, T.MapType):
        entry = F.transform(F.map_entries(c), lambda e: F.struct(
            _hashable(e["key"], kind.keyType).alias("k"), _hashable(e["value"], kind.valueType).alias("v")))
        return F.sort_array(entry)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _hashable(x, kind.elementType))
    return F.when(c.isNotNull(), F.struct(*[_hashable(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]))


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


LOCATOR = "_locator"


def located(df: DataFrame) -> DataFrame:
    """``df``, read straight from Parquet files, with each row's place (file, row) as ``LOCATOR``."""
    return df.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(LOCATOR))


def dedupe(df: DataFrame, keys, order=None, keep: str = "last", locator: str | None = None) -> DataFrame:
    """One row per key.

    The row with the greatest (``keep='last'``) or least (``keep='first'``)
    ordering struct survives.  A hash of the whole row comes last in the order,
    so the choice is total: rows that tie are equal, and computing the frame
    twice gives the same survivors.

    Without a ``locator`` this is a ``max_by``/``min_by`` over a struct of the row,
    which aggregates partially before the shuffle, but sorts whole rows; later joins
    by the key profit from that order.  With a ``locator``, a column that names each
    row and is the same whenever the frame is computed (``located``), the winner is
    chosen among (key, order, locator) alone, and the whole rows are fetched by a
    hash join with the winners: they cross one shuffle at most and are never sorted.
    """
    keys = _names(keys)
    rest = [c for c in df.columns if c not in keys and c != locator]
    if not rest:
        return df.select(*keys).distinct()
    pick = F.max_by if keep == "last" else F.min_by
    order, tie = _cols(order or []), row_hash(df, rest)
    if locator is None:
        row = F.struct(*[F.col(c) for c in rest])
        return (df.groupBy(*keys)
                  .agg(pick(row, F.struct(*order, tie)).alias("_row"))
                  .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]))
    narrow = df.select(*keys, F.struct(*order).alias("_order"), tie.alias("_tie"), locator) if order else df.select(*keys, tie.alias("_tie"), locator)
    # The hash is named twice: an expression used once would be computed in the aggregate, above a sort of whole rows.
    place = F.struct(*(["_order"] if order else []), "_tie", locator, F.col("_tie").alias("_again"))
    winners = narrow.groupBy(*keys).agg(pick(F.col(locator), place).alias("_winner")).select("_winner")
    fetched = df.join(winners.hint("shuffle_hash"), F.col(locator) == F.col("_winner"), "left_semi")
    return fetched.select(*keys, *rest)


def collect_sorted(df: DataFrame, key, col: str, order=None, alias: str | None = None) -> DataFrame:
    """List of ``col`` per key (A1), in ``order`` (default: the values themselves)."""
    alias = alias or f"{col}_list"
    if order is None:
        agg = F.sort_array(F.collect_list(col))
    else:
        pairs = F.sort_array(F.collect_list(F.struct(order_key(order).alias("o"), F.col(col).alias("v"))))
        agg = F.transform(pairs, lambda x: x["v"])
    return df.groupBy(*_names(key)).agg(agg.alias(alias))


def collect_flat_distinct(df: DataFrame, key, array_col: str, alias: str | None = None) -> DataFrame:
    """Distinct elements over all arrays of a key (A2); null arrays are ignored."""
    alias = alias or f"{array_col}_distinct"
    keys = _names(key)
    elements = df.select(*keys, F.explode_outer(array_col).alias("_e"))
    return elements.groupBy(*keys).agg(F.sort_array(F.collect_set("_e")).alias(alias))


def collect_sets(df: DataFrame, keys, cols, counts: str | None = None) -> DataFrame:
    """Several sorted ``collect_set`` at once (A3), with an optional row count;
    sets de-duplicate map-side."""
    aggs = [F.sort_array(F.collect_set(c)).alias(f"{c}_set") for c in _names(cols)]
    if counts:
        aggs.append(F.count(F.lit(1)).alias(counts))
    return df.groupBy(*_names(keys)).agg(*aggs)


def collect_distinct_structs(df: DataFrame, keys, fields, alias: str = "items",
                             drop_all_null: bool = True) -> DataFrame:
    """Sorted distinct list of structs per key (A4).  Structs whose fields are all
    null (unmatched lookups) are left out when ``drop_all_null``."""
    fields = _names(fields)
    s = F.struct(*[F.col(f) for f in fields])
    if drop_all_null:
        any_set = None
        for f in fields:
            any_set = F.col(f).isNotNull() if any_set is None else (any_set | F.col(f).isNotNull())
        s = F.when(any_set, s)
    return df.groupBy(*_names(keys)).agg(F.sort_array(F.collect_set(s)).alias(alias))


def first_non_null(col, order) -> Column:
    """Aggregate: the non-null value of ``col`` with the least ``order`` (A5)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.min_by(c, F.when(c.isNotNull(), order_key(order)))


def first_where_agg(col, pred: Column, order, fallback_first: bool = True) -> Column:
    """Aggregate: ``col`` of the first row (by ``order``) where ``pred`` holds,
    else of the first row overall (A6, grouped form)."""
    c = F.col(col) if isinstance(col, str) else col
    hit = F.min_by(c, F.when(pred & c.isNotNull(), order_key(order)))
    return F.coalesce(hit, first_non_null(c, order)) if fallback_first else hit


def rollup_children(df: DataFrame, key, sums=(), avgs=(), digits: int = 2,
                    counts: str | None = None, lists: dict | None = None) -> DataFrame:
    """Sums, rounded averages, an optional row count and sorted lists
    (``{alias: column}``) per key, in one aggregate (A7)."""
    aggs = [F.sum(c).alias(c) for c in sums] + [F.round(F.avg(c), digits).alias(f"avg_{c}") for c in avgs]
    if counts:
        aggs.append(F.count(F.lit(1)).alias(counts))
    aggs += [F.sort_array(F.collect_list(c)).alias(alias) for alias, c in (lists or {}).items()]
    return df.groupBy(*_names(key)).agg(*aggs)


def distinct_elements(df: DataFrame, array_col, alias: str = "element") -> DataFrame:
    """Distinct values of an array column across all rows."""
    c = F.col(array_col) if isinstance(array_col, str) else array_col
    return df.select(F.explode(c).alias(alias)).distinct()


def row_counts(frames: dict) -> DataFrame:
    """One row per named frame: (table_name, n_rows, is_empty) (A10).  Each count
    is a distributed aggregate; the frames are combined by union, not by a join."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table_name"), "n_rows",
                       (F.col("n_rows") == 0).alias("is_empty"))
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
