"""Scalar column helpers: defaults, blanks, overrides, classification, keys."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


# Most keys of a literal map, and of a lookup in buckets; fewest keys that are worth buckets.
LITERAL_MAP_MAX = 1000
LOOKUP_MAX = 200_000
BUCKETS_FROM = 16


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def nested(path: str) -> Column:
    """Struct path extraction, e.g. ``nested('location.coordinates.latitude')``.
    Field names holding a hyphen (language codes such as ``en-us``) are quoted."""
    parts = path.split(".")
    quoted = ".".join(f"`{p}`" if "-" in p else p for p in parts)
    return F.col(quoted)


def localized(col, lang) -> Column:
    """Value of a language-keyed text (P2): ``map[lang]`` on a MapType column or
    field access on a struct whose field names are language codes.  ``lang`` may be
    a literal code or a column holding the code per row."""
    c = as_col(col)
    key = F.lit(lang) if isinstance(lang, str) else lang
    return c[key]


def default(col, value) -> Column:
    """``coalesce(c, value)``."""
    return F.coalesce(as_col(col), value if isinstance(value, Column) else F.lit(value))


def blank_to_null(col) -> Column:
    """'' becomes null."""
    return F.nullif(as_col(col), F.lit(""))


def first_nonblank(*cols) -> Column:
    """First argument that is neither null nor '' (P9); null when none is."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def override_if(new, old, keep: str = "nonzero") -> Column:
    """The new value where it qualifies, else the old one (P10).

    ``keep='nonzero'`` : new is non-null and != 0 (the reference rule)
    ``keep='positive'``: new is non-null and > 0
    """
    n, o = as_col(new), as_col(old)
    ok = (n != 0) if keep == "nonzero" else (n > 0)
    return F.coalesce(F.when(n.isNotNull() & ok, n), o)


def classify(cases, default_value=None) -> Column:
    """Multi-branch categorisation (P15): ``cases`` is [(condition, value), ...]."""
    expr = None
    for cond, value in cases:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default_value if isinstance(default_value, Column) else F.lit(default_value)
    return expr.otherwise(d) if expr is not None else d


def flag(cond) -> Column:
    """A derived boolean that is never null."""
    return F.coalesce(cond, F.lit(False))


def first_match(cases) -> Column:
    """``coalesce(when(c1, v1), when(c2, v2), ...)``."""
    return F.coalesce(*[F.when(c, v if isinstance(v, Column) else F.lit(v)) for c, v in cases])


def literal_map(mapping: dict) -> Column:
    """A literal MapType column from a small driver-side dict (R2).  Keys and
    values keep their Python types.  The map is searched entry by entry, so it
    takes few keys; ``literal_lookup`` takes many."""
    if len(mapping) > LITERAL_MAP_MAX:
        raise ValueError(f"a literal map takes at most {LITERAL_MAP_MAX} keys, got {len(mapping)}; use literal_lookup or join a frame")
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def literal_lookup(mapping: dict) -> Callable[[Column], Column]:
    """A function from a key column to the mapping's value, null for other keys.

    The mapping, run parameters of at most ``LOOKUP_MAX`` keys, is one constant of
    the plan: an array of buckets, each a small map, picked by the key's CRC-32, so
    the time of a lookup does not grow with the number of keys.  Keys are texts or
    integers; values are texts, integers, floats or booleans, or lists of these.
    A few keys stay a plain literal map.
    """
    if len(mapping) > LOOKUP_MAX:
        raise ValueError(f"a lookup from parameters takes at most {LOOKUP_MAX} keys, got {len(mapping)}; join a frame")
    kinds = {type(k) for k in mapping}
    if len(mapping) <= BUCKETS_FROM or not kinds <= {str, int}:
        m = literal_map(mapping)
        return lambda key: m[key]
    n = 1 << (len(mapping) // 2).bit_length()
    buckets: list[dict] = [{} for _ in range(n)]
    for k, v in mapping.items():
        buckets[zlib.crc32(str(k).encode()) % n][str(k)] = list(v) if isinstance(v, (list, tuple)) else v
    constant = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{_value_kind(mapping.values())}>>")

    def look_up(key: Column) -> Column:
        text = key.cast("string")
        return F.get(constant, (F.crc32(text.cast("binary")) % n).cast("int"))[text]

    return look_up


def _value_kind(values) -> str:
    """The SQL type that holds all values, as literals have it."""
    values = [v for v in values if v is not None]
    if any(isinstance(v, (list, tuple)) for v in values):
        return f"array<{_value_kind([x for v in values for x in v])}>"
    kinds = {type(v) for v in values}
    if kinds <= {str}:
        return "string"
    if kinds == {bool}:
        return "boolean"
    if kinds == {int}:
        return "int" if all(-(1 << 31) <= v < 1 << 31 for v in values) else "bigint"
    if kinds <= {int, float}:
        return "double"
    raise TypeError(f"values of a lookup have one type; these have {sorted(k.__name__ for k in kinds)}")


def remap_code(col, mapping: dict) -> Column:
    """Trimmed, upper-cased code with listed codes replaced."""
    code = F.upper(F.trim(as_col(col)))
    if not mapping:
        return code
    return F.coalesce(literal_lookup(mapping)(code), code)


def row_key(*business_keys) -> Column:
    """Repeatable row id: SHA-256 over the business keys, each with its length or
    a null mark, so that no two key lists share a text (F19).  Unlike a clock +
    counter id it survives task retries and re-runs."""
    parts = []
    for k in business_keys:
        text = as_col(k).cast("string")
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("null")))
    return F.sha2(F.concat_ws(",", *parts), 256)


def run_epoch(run_ts: str) -> Column:
    """The run's timestamp (UTC wall time) as epoch seconds (F14); a parameter,
    not the clock.  The explicit zone makes it independent of the session's
    time zone."""
    return F.unix_seconds(F.lit(run_ts.strip() + "Z").cast("timestamp"))


def run_date(value: str) -> Column:
    """The run date stamp (P17) as a DATE literal."""
    return F.lit(value).cast("date")
