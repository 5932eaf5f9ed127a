"""Text expressions (Column -> Column).  All are native Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.columns import as_col, literal_lookup

# Fixed patterns (values that must equal the reference's behaviour).
SLUG_RUN = r"[^a-zA-Z0-9]+"          # slug: one separator per run of other characters
SLUG_CHAR = r"[^a-zA-Z0-9]"          # slug of a lookup key: one separator per character


def slugify(col, sep: str = "-", per_char: bool = False) -> Column:
    """``lower(regexp_replace(trim(c), '[^a-zA-Z0-9]+', sep))`` (F1).

    ``per_char=True`` is the lookup-key variant: one separator per character
    and no trim (used to slug amenity names before the synonym lookup).
    """
    c = as_col(col)
    if per_char:
        return F.lower(F.regexp_replace(c, SLUG_CHAR, sep))
    return F.lower(F.regexp_replace(F.trim(c), SLUG_RUN, sep))


def normalize_text(col) -> Column:
    """Drop everything but ASCII letters, digits and whitespace, then lower (F2).

    Same result as ``regexp_replace(c, '[^a-zA-Z0-9\\s]', '')``, spelled as two
    cheaper passes: non-ASCII runs first, then the ASCII characters that are
    neither letters, digits nor whitespace (controls and punctuation)."""
    no_ascii = F.regexp_replace(as_col(col), r"[^\x00-\x7f]+", "")
    return F.lower(F.regexp_replace(no_ascii, _ASCII_DROP, ""))


# ASCII controls other than \t-\r, and the punctuation ranges !-/ :-@ [-` {-~ and DEL
_ASCII_DROP = "[\x00-\x08\x0e-\x1f!-/:-@\\[-`{-\x7f]+"


def strip_nul(col) -> Column:
    """Remove NUL characters."""
    return F.regexp_replace(as_col(col), "\x00", "")


def clean_case(col, how: str) -> Column:
    """trim / upper / lower / initcap, or a '+'-joined chain such as 'trim+upper' (F4)."""
    fns = {"trim": F.trim, "upper": F.upper, "lower": F.lower, "initcap": F.initcap}
    c = as_col(col)
    for step in how.split("+"):
        c = fns[step](c)
    return c


def matches_any(col, words, lower: bool = True) -> Column:
    """Regex alternation test over a keyword list (F5): ``rlike('a|b|c')``."""
    c = F.lower(as_col(col)) if lower else as_col(col)
    return c.rlike("|".join(words))


def contains_any(col, words) -> Column:
    """Literal substring test, OR over a keyword list (F6).  Never null for a
    null input: the result is coalesced to false.  More than a few keywords are
    looked for in one pass, so their number hardly matters."""
    c = as_col(col)
    if not words:
        return F.lit(False)
    if "" in words:
        return c.isNotNull()
    if len(words) > PASSES:
        test = c.rlike(keyword_pattern(words))
    else:
        test = reduce(lambda a, b: a | b, [c.contains(w) for w in words])
    return F.coalesce(test, F.lit(False))


PASSES = 4          # keywords that are cheaper to look for one by one


def keyword_pattern(words) -> str:
    """One pattern for a keyword list: a trie, so that keywords share the test of their
    common starts.  It matches the longest keyword at a place."""
    trie: dict = {}
    for w in words:
        at = trie
        for ch in w:
            at = at.setdefault(ch, {})
        at[""] = {}

    def fold(node: dict) -> str:
        ways = [_escape(ch) + fold(child) for ch, child in sorted(node.items()) if ch]
        if not ways:
            return ""
        return (ways[0] if len(ways) == 1 and "" not in node else f"(?:{'|'.join(ways)})") + ("?" if "" in node else "")

    return fold(trie)


def keyword_lists_found(col, lists) -> Column:
    """Which of several keyword lists have a keyword in the text, as the sorted array of
    their positions (F6, U3, U4); empty for null.

    The text is scanned once for all keywords: at every place the longest keyword that
    starts there is taken, and a keyword that is the start of a found one is there as well.
    """
    c, words = as_col(col), sorted({w for ws in lists for w in ws if w})
    always = F.array(*[F.lit(i) for i, ws in enumerate(lists) if "" in ws]).cast("array<int>")
    if not words:
        return F.when(c.isNotNull(), always).otherwise(F.array().cast("array<int>"))
    owners: dict = {w: {i for i, ws in enumerate(lists) if w in ws} for w in words}
    for w in words:                  # sorted: a start comes before the words that it starts
        for k in range(1, len(w)):
            owners[w] |= owners.get(w[:k], set())
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?=({keyword_pattern(words)}))"), F.lit(1)))
    look_up = literal_lookup({w: sorted(own) for w, own in owners.items()})
    places = F.flatten(F.transform(found, lambda w: look_up(w)))
    return F.coalesce(F.array_sort(F.array_union(places, always)), F.array().cast("array<int>"))


def before_first(col, sep: str, suffix: str) -> Column:
    """Text up to the first ``sep`` plus ``suffix``; null for null input."""
    c = as_col(col)
    return F.when(c.isNotNull(), F.concat(F.substring_index(c, sep, 1), F.lit(suffix)))


def sentence(*parts) -> Column:
    """Null-strict concatenation (F8): any null part makes the result null.
    Non-string parts are cast to string; plain ``str`` parts are literals."""
    cols = [F.lit(p) if isinstance(p, str) else as_col(p).cast("string") for p in parts]
    return F.concat(*cols)


def join_present(sep: str, *cols) -> Column:
    """Null-skipping join of scalars or arrays (F9); '' when all are null."""
    return F.concat_ws(sep, *[as_col(c) for c in cols])


def join_array(col, sep: str = " ") -> Column:
    """``array_join`` of a string array."""
    return F.array_join(as_col(col), sep)


def humanize(col, char: str = "_") -> Column:
    """Replace ``char`` by a space, only when present."""
    c = as_col(col)
    return F.when(F.instr(c, char) > 0, F.regexp_replace(c, _escape(char), " ")).otherwise(c)


def query_param(col, name: str) -> Column:
    """Value of ``name=`` made of digits and dashes; null when absent."""
    v = F.regexp_extract(as_col(col), name + r"=([\d-]+)", 1)
    return F.nullif(v, F.lit(""))


def safe_date(col, fmt: str | None = None) -> Column:
    """String to date; text that does not parse becomes null."""
    c = as_col(col)
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def _escape(s: str) -> str:
    import re
    return re.escape(s)
