"""Vector codes against plain rounds over all entries."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedlake.llm import pivot_codes as C
from tests.conftest import SF_SMALL

KIND = "vec_id long, embedding array<float>, label int, q string, far int, codes string, label_key string, rows long"


def plain(rows, entries=256, rounds=4):
    """(Counter of (vec_id, code, error, label_error), digest of the codebooks)."""
    kept = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(1024 * v) for v in r[1]]))
    if not kept:
        return Counter(), None
    x = np.array([[math.floor(1024 * v) for v in r[1]] for r in kept], dtype=np.int64).reshape(len(kept), 4, -1)
    books = [x[:entries, p].copy() for p in range(4)]

    def assign(p):
        d = np.stack([((x[:, p] - e) ** 2).sum(axis=1) for e in books[p]], axis=1)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p in range(4):
            own, _ = assign(p)
            for e in set(own.tolist()):
                books[p][e] = x[own == e, p].sum(axis=0) // int((own == e).sum())
    found = [assign(p) for p in range(4)]
    errors = sum(f[1] for f in found).tolist()
    per_label = defaultdict(int)
    for r, e in zip(kept, errors, strict=True):
        per_label[r[2]] += e
    text = ",".join(str(v) for b in books for v in b.ravel().tolist())
    return Counter((r[0], "".join(f"{int(found[p][0][i]):02x}" for p in range(4)), errors[i], per_label[r[2]])
                   for i, r in enumerate(kept)), hashlib.sha256(text.encode()).hexdigest()


def vectors(n, dim=12, seed=3):
    draw = np.random.default_rng(seed)
    base = draw.normal(0, 0.4, (40, dim))
    rows = [(int(i * 7 % n), (base[i % 40] + draw.normal(0, 0.02 if i % 3 else 0.3, dim)).astype(np.float32).tolist(), None if i % 5 == 0 else int(i % 4))
            for i in range(n)]
    hot = rows[0][1]
    rows += [(n + i, hot, 9) for i in range(n // 2)]                       # a third of all rows hold one vector
    rows += [(None, hot, 1), (None, rows[5][1], None), rows[3], rows[3]]     # ids that are null or repeated
    rows += [(9000, None, 1), (9001, [float("nan"), *hot[1:]], 1), (9002, [float("inf"), *hot[1:]], None), (9003, [None, *hot[1:]], 2)]
    return rows


@pytest.mark.parametrize("n", [30, 700])
def test_codes(spark, n):
    rows = vectors(n)
    df = spark.createDataFrame([(*r, "clash", 1, "clash", "clash", 5) for r in rows], KIND).repartition(5)
    coded, books = C.compress(df)
    assert coded.columns == ["vec_id", "label", "codes", "error", "label_error"]
    got = Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in coded.withColumn("code", C.hex_codes()).collect())
    want, digest = plain(rows)
    assert got == want and books.digest() == digest


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None, 1, "", 0, "", "", 0)], KIND)
    for rows in (df, df.limit(0)):
        coded, books = C.compress(rows)
        assert books is None and coded.count() == 0


def test_vectors_without_one_length_are_refused(spark):
    df = spark.createDataFrame([(1, [0.5] * 8), (2, [0.5] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="one length"):
        C.compress(df, label_col="vec_id")
    with pytest.raises(ValueError, match="one length"):
        C.compress(df.where("vec_id = 2"), parts=3, label_col="vec_id")
    with pytest.raises(ValueError, match="too large"):
        C.compress(spark.createDataFrame([(1, [1e300] * 4)], df.schema), label_col="vec_id")


def test_bounds_prune_and_keep_ties():
    draw = np.random.default_rng(0)
    centres = draw.integers(-3000, 3000, (64, 8))
    parts = np.concatenate([c + draw.integers(-40, 40, (30, 8)) for c in centres] + [centres, centres])
    entries = np.concatenate((centres, centres[::-1], draw.integers(-3000, 3000, (100, 8))))       # every centre twice
    pivots = C.far_apart(entries, C.PIVOTS)
    index, best, made = C.nearest(parts, C.pivot_distances(parts, pivots), entries, pivots)
    d = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert made < 0.1 * d.size


def test_query(spark):
    from feedlake.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, digest = plain(rows)
    got = QUERIES["op12_laesa_codes"](spark, SF_SMALL).collect()
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}
