"""Product quantisation with LAESA pivots.

Components become integers floor(scale * x); a vector is cut into equal consecutive
parts and each part position has its own codebook, learnt by rounds of assigning
every part to its nearest entry (squared Euclidean distance, ties to the lower
index) and moving each entry to its parts' floored mean.

``PIVOTS`` parts of the first codebook, far from each other, stay fixed as pivots.
Each part's distances to them are computed once and staged with the part.  A round
computes only the distances between pivots and the current entries: by the triangle
inequality the largest difference of the two is a lower bound for the distance
between part and entry.  Entries are visited by rising bound, and a part is done
when the next bound is above its best exact distance, which is evaluated in
integers.  Bounds are taken a little lower than computed, so rounding never prunes
an entry that could win or tie.

Tasks send one partial sum per used entry and component; the codebooks, which are
the model (parts x entries x components), are all that reaches the driver and that
is broadcast.  Rows without a vector or with null or non-finite components are
dropped.  Rows repeated in full are coded each; in the first codebook ids come in
ascending order, nulls last, equal ids by their vectors.  With fewer rows than
entries the codebooks have as many entries as rows; an empty table gives no rows.
Vectors of different lengths, of a length that the number of parts does not divide,
or too large for exact 64-bit distances are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import join_groups, stage

PIVOTS = 8
ROWS = 2048               # vectors compared at a time


def whole_vectors(rows: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """``rows`` with their vector as integers (``q``); rows without a finite vector are dropped."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return rows.where(F.col(vector_col).isNotNull() & finite).withColumn("q", F.transform(x, lambda v: F.floor(v * scale)))


def far_apart(entries: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the entries, each the farthest from those before (ties to the lower index)."""
    chosen = [0]
    near = squares(entries, entries[0])
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squares(entries, entries[chosen[-1]]))
    return entries[chosen]


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) Euclidean distances."""
    return np.sqrt(np.stack([squares(parts, p) for p in pivots], axis=1).astype(np.float64))


def nearest(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance, exact evaluations made) of each part."""
    between = pivot_distances(entries, pivots)                                    # entries x pivots
    bound = np.zeros((len(parts), len(entries)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - between[None, :, p]), out=bound)
    bound -= (bound + max(float(to_pivots.max(initial=0)), float(between.max(initial=0)))) * 2.0 ** -40
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    best, index = np.full(len(parts), np.iinfo(np.int64).max), np.zeros(len(parts), dtype=np.int64)
    going, made = np.arange(len(parts)), 0
    for k in range(len(entries)):
        if k:
            going = going[bound[going, k] <= np.sqrt(best[going].astype(np.float64)) * (1 + 2.0 ** -40)]
            if not len(going):
                break
        entry = order[going, k]
        d = squares(parts.take(going, axis=0), entries.take(entry, axis=0))
        made += len(going)
        better = (d < best[going]) | ((d == best[going]) & (entry < index[going]))
        best[going[better]], index[going[better]] = d[better], entry[better]
    return index, best, made


def _whole(column: pa.Array, kind: type, shape: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, *shape)


class Codebooks:
    """Entries (parts, entries, components) and the pivots (parts, pivots, components)."""

    def __init__(self, first: np.ndarray, parts: int):
        n, dim = first.shape
        self.entries = np.ascontiguousarray(first.reshape(n, parts, dim // parts).transpose(1, 0, 2))
        self.pivots = np.stack([far_apart(e, PIVOTS) for e in self.entries])

    def moved(self, totals: dict[tuple, int]) -> None:
        """Every used entry becomes its parts' floored mean; ``totals`` has counts at position -1."""
        parts, n, dim = self.entries.shape
        for p in range(parts):
            for e in range(n):
                count = totals.get((p, e, -1), 0)
                if count:
                    self.entries[p, e] = [totals[p, e, k] // count for k in range(dim)]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, q: np.ndarray, far: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part position, entry, squared distance) of all rows of a batch."""
        for p, (entries, pivots) in enumerate(zip(self.entries, self.pivots, strict=True)):
            found = [nearest(q[a:a + ROWS, p], far[a:a + ROWS, p], entries, pivots)[:2] for a in range(0, len(q), ROWS)]
            yield p, np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _measured(rows: DataFrame, books: Codebooks, id_kind: str, label_kind: str) -> DataFrame:
    """(vec_id, label, q, far): vectors as packed integers with their distances to the pivots, staged."""
    parts, n_pivots, dim = books.pivots.shape
    pivots = books.pivots

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = b.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, dim)
            far = np.stack([pivot_distances(q[:, p], pivots[p]) for p in range(parts)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([x.astype("<i8").tobytes() for x in q], pa.binary()),
                 pa.array([x.astype("<f8").tobytes() for x in far], pa.binary())], names=["vec_id", "label", "q", "far"])

    return stage(rows.mapInArrow(measure, f"vec_id {id_kind}, label {label_kind}, q binary, far binary"), "measured")


def _batch(b: pa.RecordBatch, shape: tuple) -> tuple[np.ndarray, np.ndarray]:
    parts, n_pivots, dim = shape
    return _whole(b.column("q"), np.dtype("<i8"), (parts, dim)), _whole(b.column("far"), np.dtype("<f8"), (parts, n_pivots))


def _totals(rows: DataFrame, books: Codebooks) -> dict[tuple, int]:
    """Counts (position -1) and sums per (part, entry, position) over all rows."""
    shape, held = books.pivots.shape, rows.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        parts, n, dim = own.entries.shape
        sums, counts = np.zeros((parts, n, dim), dtype=np.int64), np.zeros((parts, n), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                q, far = _batch(b, shape)
                for p, entry, _ in own.assign(q, far):
                    np.add.at(sums[p], entry, q[:, p])
                    counts[p] += np.bincount(entry, minlength=n)
        p, e = np.nonzero(counts)
        rows = [np.repeat(p, dim + 1), np.repeat(e, dim + 1), np.tile(np.arange(-1, dim), len(p)),
                np.concatenate((counts[p, e][:, None], sums[p, e]), axis=1).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int64)) for r in rows], names=["part", "entry", "pos", "value"])

    found = (rows.select("q", "far").mapInArrow(add, "part long, entry long, pos long, value long")
             .groupBy("part", "entry", "pos").agg(F.sum("value").alias("value")).collect())      # at most the size of the model
    return {(r["part"], r["entry"], r["pos"]): r["value"] for r in found}


def _coded(rows: DataFrame, books: Codebooks, id_kind: str, label_kind: str) -> DataFrame:
    shape, held = books.pivots.shape, rows.sparkSession.sparkContext.broadcast(books)

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                q, far = _batch(b, shape)
                found = list(held.value.assign(q, far))
                codes = np.stack([entry for _, entry, _ in found], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), b.column("label"), pa.array(codes.astype(np.int32).tolist(), pa.list_(pa.int32())),
                     pa.array(sum(d for _, _, d in found))], names=["vec_id", "label", "codes", "error"])

    return rows.mapInArrow(code, f"vec_id {id_kind}, label {label_kind}, codes array<int>, error long")


def compress(rows: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """(coded rows: vec_id, label, codes, error, label_error; the codebooks, none for an empty table)."""
    kept = whole_vectors(rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")), "v", scale)
    id_kind, label_kind = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    kept = kept.select("vec_id", "label", "q")
    size = kept.agg(F.min(F.size("q")).alias("low"), F.max(F.size("q")).alias("high"), F.count(F.lit(1)).alias("n"),
                    F.max(F.array_max(F.transform("q", lambda v: F.abs(v)))).alias("most")).first()
    if not size["n"]:
        out = kept.select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"),
                          F.lit(None).cast("long").alias("label_error"))
        return out, None
    dim = size["high"]
    if size["low"] != dim or not dim or dim % parts:
        raise ValueError(f"vectors need one length that {parts} divides; these have {size['low']} to {dim} components")
    if dim * (2 * size["most"]) ** 2 >= 1 << 62:
        raise ValueError("components are too large for exact 64-bit distances")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    books = Codebooks(np.array([r["q"] for r in first], dtype=np.int64), parts)
    measured = _measured(kept, books, id_kind, label_kind)
    for _ in range(rounds):
        books.moved(_totals(measured, books))
    coded = stage(_coded(measured, books, id_kind, label_kind).withColumn(
        "label_key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))), "coded")
    sums = stage(coded.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")), "labels")
    found = join_groups(coded, sums, "label_key", "rows", size["n"])
    return found.select("vec_id", "label", "codes", "error", "label_error"), books


def hex_codes(codes: str = "codes"):
    """Codes below 256 as two hex digits each."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))
