"""K-d tree sharding by bytes.

The rows of a node are split at the weighted median (weight: bytes) of the
node's widest metadata dimension, recursively, until each leaf holds its target
bytes.  A node that must give an odd number of leaves is split in that
proportion.  The split key of a row is (coordinate, hash of id and text
checksum), so a hot value of a dimension, even a third of all rows, is split
inside the value.

Medians are found by distributed histograms: one aggregation per pass sums the
bytes per (node, bin) with map-side combine, the bin that holds the median is
kept and cut into ``BINS`` finer bins, until it weighs less than ``TOLERANCE``
of a leaf or holds one key only.  Only the tree (one row per node) reaches the driver.

Dimensions are columns; numbers are used as they are, other types by the first
six bytes of their text (order-preserving).  Nulls sort before all values.  An
empty table has no rows in any shard.  Rows repeated in full fall into one shard.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from .common import stage

BINS = 2048
TOLERANCE = 0.0005
HASH_RANGE = 1 << 40
SLOT_ROWS = 20_000     # rows numbered by one task at a time


def coordinate(df: DataFrame, col: str) -> Column:
    """A dimension as a long from 0 on, null lowest."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.BooleanType):
        value = F.col(col).cast("long")
    elif isinstance(kind, (T.NumericType,)):
        value = F.least(F.greatest(F.col(col).cast("double"), F.lit(-(2.0 ** 52))), F.lit(2.0 ** 52)).cast("long")
    else:
        six = F.rpad(F.hex(F.substring(F.col(col).cast("string").cast("binary"), 1, 6)), 12, "0")
        value = F.conv(six, 16, 10).cast("long")
    return F.coalesce(value, F.lit(-(2 ** 53)))


def measured(docs: DataFrame, dims: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow rows: doc_id, size, text_crc32, tie-break hash and the coordinates d0, d1, ..."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    crc = F.crc32(raw)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"), crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), crc), F.lit(HASH_RANGE)).alias("tie"),
        *[coordinate(docs, c).alias(f"d{i}") for i, c in enumerate(dims)])


def _lookup(df: DataFrame, rows: list[dict], schema: str, how: str = "inner") -> DataFrame:
    """Add the columns of one tree level (at most one row per leaf, so its size is bounded) by node."""
    if [r["node"] for r in rows] == [1]:       # the root holds all rows: its values are literals
        names = [f.split(":") for f in schema.split(",")[1:]]
        return df.withColumns({n: F.lit(rows[0][n]).cast(kind) for n, kind in names})
    level = (df.sparkSession.range(1)
             .select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*"))
    return df.join(F.broadcast(level), "node", how)


def _ranges(rows: DataFrame, n_dims: int) -> dict[int, dict]:
    """Bytes and coordinate ranges of each node."""
    aggs = [F.sum("size").alias("w")]
    for i in range(n_dims):
        aggs += [F.min(f"d{i}").alias(f"lo{i}"), F.max(f"d{i}").alias(f"hi{i}")]
    return {r["node"]: r.asDict() for r in rows.groupBy("node").agg(*aggs).collect()}


def _medians(rows: DataFrame, todo: dict[int, dict], n_dims: int) -> None:
    """Fill in ``cut`` and ``tie_cut`` of every node in ``todo``.

    A row goes left if (coordinate, tie) < (cut, tie_cut).  Each open node is
    searched in [lo, hi] of its coordinate first and, once that is one value,
    in the range of the tie-break hash.
    """
    pick = F.element_at(F.array(*[F.col(f"d{i}") for i in range(n_dims)]), F.col("dim") + 1)
    schema = "node:long,dim:int,value:long,lo:long,hi:long,on_tie:boolean,step:long,want:double"
    live = dict(todo)
    while live:
        state = [{"node": n, "dim": s["dim"], "value": s.get("value", 0), "lo": s["lo"], "hi": s["hi"],
                  "on_tie": s["on_tie"], "step": max(1, -(-(s["hi"] - s["lo"] + 1) // BINS)), "want": s["want"]}
                 for n, s in live.items()]
        at = F.when(F.col("on_tie"), F.col("tie")).otherwise(pick)
        seen = (_lookup(rows, state, schema).withColumn("at", at)
                .where(F.col("at").between(F.col("lo"), F.col("hi")) & (~F.col("on_tie") | (pick == F.col("value")))))
        hist = (seen.withColumn("bin", F.expr("(at - lo) div step"))
                .groupBy("node", "bin").agg(F.sum("size").alias("w"), F.min("at").alias("lo"), F.max("at").alias("hi"),
                                            F.max("want").alias("want")))
        # The bin in which the running sum first reaches what is still wanted: at most BINS rows a node.
        order = Window.partitionBy("node").orderBy("bin")
        found = (hist.withColumn("upto", F.sum("w").over(order))
                 .where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("w") < F.col("want"))).collect())
        for r in found:
            s = live[r["node"]]
            s["want"] -= r["upto"] - r["w"]
            if r["w"] <= s["tol"]:           # fine enough: cut on the nearer side of this bin
                whole = s["want"] * 2 >= r["w"]
                edge = r["hi"] + 1 if whole else r["lo"]
                s["cut"], s["tie_cut"] = (s["value"], edge) if s["on_tie"] else (edge, 0)
                del live[r["node"]]
            elif r["lo"] < r["hi"]:
                s["lo"], s["hi"] = r["lo"], r["hi"]
            elif not s["on_tie"]:            # one heavy value: split inside it
                s |= {"value": r["lo"], "on_tie": True, "lo": 0, "hi": HASH_RANGE - 1}
            else:                            # one key: it cannot be split, it goes where it fits better
                whole = s["want"] * 2 >= r["w"]
                s["cut"], s["tie_cut"] = s["value"], r["hi"] + 1 if whole else r["lo"]
                del live[r["node"]]


def build_tree(rows: DataFrame, n_dims: int, leaves: int) -> list[list[dict]]:
    """Levels of splits; a node is a number, its children are 2n and 2n+1, a leaf knows its shard."""
    levels, level = [], {1: (0, leaves)}      # node: (first shard, shards)
    full = None
    while any(k > 1 for _, k in level.values()):
        nodes = _ranges(route(rows, levels), n_dims)
        full = full or nodes.get(1)
        if not full:
            return levels
        todo = {}
        for n, (_, k) in level.items():
            if k < 2 or n not in nodes:
                continue
            r = nodes[n]
            wide = [(r[f"hi{i}"] - r[f"lo{i}"]) / max(1, full[f"hi{i}"] - full[f"lo{i}"]) for i in range(n_dims)]
            dim = wide.index(max(wide))
            todo[n] = {"dim": dim, "lo": r[f"lo{dim}"], "hi": r[f"hi{dim}"], "on_tie": False, "value": 0,
                       "want": r["w"] * (k // 2) / k, "tol": TOLERANCE * r["w"] / k}
        _medians(route(rows, levels), todo, n_dims)
        levels.append([{"node": n, "dim": s["dim"], "cut": s["cut"], "tie_cut": s["tie_cut"]} for n, s in todo.items()])
        below = {}
        for n, (first, k) in level.items():
            if n in todo:
                below |= {2 * n: (first, k // 2), 2 * n + 1: (first + k // 2, k - k // 2)}
            elif k == 1:
                below[n] = (first, k)
        level = below
    return levels


def route(rows: DataFrame, levels: list[list[dict]]) -> DataFrame:
    """Send rows down the tree; ``node`` is where they arrive."""
    n_dims = sum(c.startswith("d") and c[1:].isdigit() for c in rows.columns)
    out = rows.withColumn("node", F.lit(1).cast("long"))
    at = F.element_at(F.array(*[F.col(f"d{i}") for i in range(n_dims)]), F.col("dim") + 1)
    left = (at < F.col("cut")) | ((at == F.col("cut")) & (F.col("tie") < F.col("tie_cut")))
    for level in levels:
        out = (_lookup(out, level, "node:long,dim:int,cut:long,tie_cut:long", "left")
               .withColumn("node", F.when(F.col("dim").isNull(), F.col("node"))
                           .otherwise(F.col("node") * 2 + F.when(left, 0).otherwise(1)))
               .drop("dim", "cut", "tie_cut"))
    return out


def _leaf_shards(leaves: int, levels: list[list[dict]]) -> dict[int, int]:
    level = {1: (0, leaves)}
    for splits in levels:
        cut = {s["node"] for s in splits}
        level = {c: v for n, (f, k) in level.items() for c, v in (
            {2 * n: (f, k // 2), 2 * n + 1: (f + k // 2, k - k // 2)} if n in cut else {n: (f, k)}).items()}
    return {n: f for n, (f, _) in level.items()}


def kd_shards(docs: DataFrame, dims: list[str], *, target_bytes: int | None = None, shards: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (gapless in the shard, from 0).

    Give the bytes a leaf should hold or the number of leaves.
    """
    rows = stage(measured(docs, dims, id_col, text_col), "measured")
    total = rows.agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n")).first()
    leaves = shards or max(1, -(-(total["w"] or 0) // target_bytes))
    levels = build_tree(rows, len(dims), leaves)
    places = _leaf_shards(leaves, levels)
    names = [{"node": n, "shard": s} for n, s in places.items()]
    # Numbering in two steps, so no task holds a whole shard: rows of a (shard, block)
    # are numbered together, blocks by their running count.
    blocks = max(1, -(-(total["n"] or 0) // SLOT_ROWS))
    placed = (_lookup(route(rows, levels), names, "node:long,shard:int")
              .select("doc_id", "size", "text_crc32", "shard", "tie",
                      F.pmod(F.xxhash64("tie", "size"), F.lit(blocks)).alias("block")))
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "block", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("tie", "doc_id", "text_crc32", "size"))
    return (placed.withColumn("rank", inside).join(starts, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - 1).alias("slot")))
