"""Row generators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, col: str, alias: str, outer: bool = False) -> DataFrame:
    """One row per element (G1); ``outer=True`` keeps rows with a null or empty
    array as a single row with a null element (G2)."""
    fn = F.explode_outer if outer else F.explode
    return df.withColumn(alias, fn(F.col(col)))


def fan_out(df: DataFrame, languages, name: str = "language_code") -> DataFrame:
    """One row per input row and language."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(x) for x in languages])))


def explode_path(df: DataFrame, path, alias: str = "leaf", keep: dict | None = None) -> DataFrame:
    """Explode through nested arrays.

    ``path`` lists the array field at each level, e.g.
    ``["rooms", "bed_options", "bed_configurations", "configuration"]``.  The
    nesting is flattened inside the row with ``transform`` + ``flatten`` and
    exploded once, so no intermediate frame is materialised per level.
    ``keep`` maps output names to a field of an intermediate level,
    ``{name: (level_index, field)}``, carried down to each leaf.  Null or empty
    arrays at any level yield no leaf (inner-explode semantics).
    """
    keep = keep or {}

    def descend(elem, depth, carried):
        carried = dict(carried)
        carried.update({n: elem[f] for n, (lvl, f) in keep.items() if lvl == depth})
        if depth == len(path) - 1:
            return F.array(F.struct(elem.alias("_leaf"), *[v.alias(n) for n, v in carried.items()]))
        child = F.filter(elem[path[depth + 1]], lambda x: x.isNotNull())
        return F.flatten(F.transform(child, lambda x: descend(x, depth + 1, carried)))

    top = F.filter(F.col(path[0]), lambda x: x.isNotNull())
    leaves = F.flatten(F.transform(top, lambda x: descend(x, 0, {})))
    out = df.withColumn("_leaf_row", F.explode(leaves))
    out = out.withColumns({alias: F.col("_leaf_row._leaf"),
                           **{n: F.col(f"_leaf_row.{n}") for n in keep}})
    return out.drop("_leaf_row")
