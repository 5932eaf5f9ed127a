"""Array / map expressions, all evaluated inside the row (no explode, no
shuffle).  These replace explode + regroup + rejoin wherever the lookup is a
bounded literal map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.columns import as_col, literal_lookup
from feedlake.functions.text import slugify


def pluck(col, field: str) -> Column:
    """Field of every element of an array of structs."""
    return F.transform(as_col(col), lambda x: x[field])


def map_lookup(col, mapping, key_type: str | None = "string") -> Column:
    """Translate every element through a map, dropping unknown ones.
    ``mapping`` is a dict (``literal_lookup``), a function of the key column or a MapType Column."""
    look_up = literal_lookup(mapping) if isinstance(mapping, dict) else mapping if callable(mapping) else lambda x: mapping[x]
    translated = F.transform(as_col(col), lambda x: look_up(x.cast(key_type) if key_type else x))
    return F.filter(translated, lambda x: x.isNotNull())


def by_language(columns: dict, lang_col) -> Column:
    """Map built from per-language columns, indexed by each row's own language.
    ``columns`` maps language code -> column."""
    pairs = []
    for lang, c in columns.items():
        pairs += [F.lit(lang), as_col(c)]
    return F.create_map(*pairs)[as_col(lang_col)]


def first_element(col) -> Column:
    """Element 0, null for an empty or null array (R4).  ``arr[0]`` raises on an
    empty array under ANSI mode; ``get`` does not."""
    return F.get(as_col(col), 0)


def empty_to_null(col) -> Column:
    """Null for a null or empty array."""
    c = as_col(col)
    return F.when(F.size(c) > 0, c)


def add_tag(col, tag: str, cond) -> Column:
    """Append ``tag`` once where ``cond`` holds."""
    c = as_col(col)
    return F.when(cond, F.array_union(c, F.array(F.lit(tag)))).otherwise(c)


def flat_distinct(col, fn=None) -> Column:
    """Flatten an array of arrays, ignoring null inner arrays, optionally map each
    element, then de-duplicate (R7)."""
    parts = F.filter(as_col(col), lambda x: x.isNotNull())
    out = F.flatten(parts)
    if fn is not None:
        out = F.transform(out, fn)
    return F.array_distinct(out)


def constant_array(values) -> Column:
    """Array literal."""
    return F.array(*[F.lit(v) for v in values])


def slugify_all(col) -> Column:
    """Per-character slug of every element."""
    return F.transform(as_col(col), lambda x: slugify(x, per_char=True))


def first_where(col, pred, fallback=None) -> Column:
    """First element satisfying ``pred`` (A6), else ``fallback`` (a Column), else
    null.  Works in the row: no explode and no regroup."""
    hit = F.get(F.filter(as_col(col), pred), 0)
    return F.coalesce(hit, fallback) if fallback is not None else hit


def sorted_text(col, sep: str = ",") -> Column:
    """Sorted array as text, for comparisons across engines."""
    return F.array_join(F.sort_array(as_col(col)), sep)
