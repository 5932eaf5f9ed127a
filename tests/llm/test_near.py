"""Near copies against brute force, with large groups that are no clique."""

import random
from collections import Counter

import numpy as np
import pytest

from feedlake.llm import near_dedup
from feedlake.llm.components import components
from tests.llm.cases import documents, edited, empty, prose, texts


def brute(rows, size, percent):
    """(doc_id, n_shingles, component, kept) of every row."""
    sets, parent = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return Counter((i, len(sets[i]), root(i), root(i) == i) for i, _ in rows)


def group(seed=4):
    """Copies with few to many edits of one base and of its copies: some linked by chains, some by nothing."""
    draw = random.Random(seed)
    base = prose(draw, 90)
    out = [base]
    for _ in range(110):
        out.append(edited(draw, draw.choice(out), draw.randrange(1, 4)))
    return out + [edited(draw, base, 12) for _ in range(40)]


@pytest.mark.parametrize("small,block", [(32, 1024), (2, 7), (1000, 1024)])
def test_large_group(spark, monkeypatch, small, block):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", block)
    docs = documents(spark, group() + texts()[:60], repeat_rows=False)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 4, 80)
    assert max(Counter(k[2] for k in want).values()) > 20 and sum(k[3] for k in want) > 60
    got = near_dedup.near_groups(docs, shingle=4, percent=80)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == want


def test_awkward_rows(spark):
    docs = documents(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
    assert Counter(map(tuple, near_dedup.near_groups(docs).collect())) == want
    left = near_dedup.drop_near_copies(documents(spark, repeat_rows=False))
    assert left.columns == docs.columns and left.count() == len({k[0] for k in want if k[3]})
    assert near_dedup.near_groups(empty(spark)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert Counter(map(tuple, near_dedup.near_groups(nulls).collect())) == Counter(
        [(None, 2, None, True), (3, 2, 3, True), (None, 0, None, True)])


def test_reused_ids_lose_no_text(spark):
    """Rows that share an id, or have none, leave only with their own text."""
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty " * 3
    rows = [(3, long), (7, long + "more"), (7, "nothing like the others at all, not one word in common here"), (None, long), (None, None), (7, None),
            (9, "short"), (9, "short"), (4, "SHORT"), (7, "a text of its own that has some words again")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, _gone long")
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["_gone"] for r in left.collect()) == [0, 2, 3, 4, 5, 8, 9]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_groups(docs).collect()}
    assert (9, 1, 4, False) in got and (4, 1, 4, True) in got and (7, 21, 3, False) in got and (7, 6, 7, True) in got
    # two unlike texts of one id, each the least of its component
    twice = spark.createDataFrame([(5, long), (5, rows[2][1]), (6, long + "x"), (6, rows[2][1] + " x")], "doc_id long, text string")
    assert sorted(r["text"] for r in near_dedup.drop_near_copies(twice).collect()) == sorted([long, rows[2][1]])


def test_links_grow_with_the_group(spark, monkeypatch):
    """What the block comparison of a near-copy group gives is at most linear in the group."""
    seen = {}
    real = near_dedup._joined

    def joined(group, links):
        seen[size] = seen.get(size, 0) + links.count()
        return real(group, links)

    monkeypatch.setattr(near_dedup, "_joined", joined)
    for size in (250, 500, 1000):
        draw = random.Random(size)
        base = prose(draw, 90)
        texts_ = [edited(draw, base, draw.randrange(1, 4)) for _ in range(size)]
        docs = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
        got = Counter(map(tuple, near_dedup.near_groups(docs).collect()))
        assert sum(got.values()) == size
        if size == 250:
            assert got == brute(list(enumerate(texts_)), 5, 80)
    assert all(n <= 2 * size for size, n in seen.items()), seen


def test_bounds():
    assert near_dedup.miss_chance(0.8) < 1e-7
    draw = np.random.default_rng(0)
    least = near_dedup.batch_bounds(80)
    assert least == sorted(least)
    a = draw.integers(0, 1 << 32, (4000, near_dedup.HASHES), dtype=np.uint32)
    b = np.where(draw.random(a.shape) < 0.8, a, a ^ np.uint32(1))      # similarity 0.8
    assert len(near_dedup.likely(a, b, least)) == 4000
    far = np.where(draw.random(a.shape) < 0.4, a, a ^ np.uint32(1))
    assert len(near_dedup.likely(a, far, least)) < 20


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(1)
    common, own = draw.integers(0, 1 << 63, 800, dtype=np.uint64), draw.integers(0, 1 << 63, 400, dtype=np.uint64)
    x, y = np.concatenate((common, own[:200])), np.concatenate((common, own[200:]))
    same = (near_dedup.signature(x) == near_dedup.signature(y)).mean()
    assert abs(same - 800 / 1200) < 0.15


def test_components(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 180)] + [
        (draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(120)] + [(5, 5), (3, 2), (2, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {n: root(n) for n in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
