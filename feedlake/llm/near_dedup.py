"""Near-duplicate documents: MinHash bands with sequential Bayesian verification.

1. Every text gets its set of distinct word shingles and a MinHash signature.
   Equal sets form a class; only one member, the smallest id, goes on.
2. Classes that agree in one of ``BANDS`` bands of ``ROWS`` hashes share a bucket.
   A pair at the threshold misses all buckets with probability ``miss_chance()``
   (4.6e-8 for the values here).
3. A candidate pair is compared batch by batch of its signatures and dropped as
   soon as the posterior probability (uniform prior) that it reaches the threshold
   falls below ``MISS``.  Survivors are confirmed on their full sets.
4. Pairs within a bucket are never all formed.  First each member meets the
   bucket's smallest node.  Buckets whose members then lie in one component are
   done, as further links could not change it.  In the others every class is
   closed that cannot reach the threshold with any open one because too few of its
   shingles occur in another open class (an exact bound).  In a large open bucket,
   the members outside its main component are the queries, which are compared with
   the bucket block by block inside tasks by step 3's tests; members that a call has
   already joined are not compared again, and a call gives a spanning forest: one
   link for each two old components that it joins, never more links than it has
   members.  Small buckets that are still open after this form pairs of members of
   different components, of which only the pair of components goes on.  So no link
   that joins two components is lost, whatever a bucket's size.

Texts are lower-cased in A-Z and split at ASCII white space.  A text with fewer
words than a shingle is one shingle; a text without words (or null) has an empty
set and is linked with nothing, as is a row with a null id.  Rows with one id and
different sets are different members; a component is named by its smallest id.
Rows repeated in full are each reported.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W
from .common import StagedTable, join_hot_groups, stage, without
from .components import components

HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
BATCH = 32                # hashes compared at a time
MISS = 1e-6               # posterior probability at which a pair is dropped
SMALL = 32                # members of a bucket whose open pairs are formed by a join
BLOCK_MEMBERS = 1024      # members of a larger bucket compared by one call
BLOCK_BYTES = 1 << 20
GROUP_HASHES = 1 << 20    # shingles one task counts

_draw = np.random.default_rng(41)
_XOR = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_MUL = (_draw.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_BAND = _draw.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def miss_chance(similarity: float = 0.8) -> float:
    """Probability that a pair of this similarity shares no bucket."""
    return (1 - similarity ** ROWS) ** BANDS


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, bounds = W.word_hashes([t.lower() for t in texts], W.WHITE)
    grams = W.gram_hashes(words, size)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= size:
            out.append(np.unique(grams[lo:hi - size + 1]))
        else:
            out.append(W.gram_hashes(words[lo:hi] + np.uint64(1), hi - lo) if hi > lo else words[:0])
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES minima over a set."""
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(low, ((x[None, at:at + 2048] ^ _XOR) * _MUL).min(axis=1), out=low)
    return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys of (rows, HASHES) signatures; a key belongs to one band."""
    wide = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), BANDS, ROWS // 2)
    key = np.broadcast_to(_BAND, wide.shape[:2]).copy()
    for k in range(ROWS // 2):
        key = W.mix(key + wide[:, :, k])
    return key.view(np.int64)


def least_matches(hashes: int, similarity: float, miss: float) -> int:
    """Fewest matches of ``hashes`` at which P(similarity reached | matches) is at least ``miss``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum.
    """
    total = 0.0
    for m in range(hashes + 1):
        total += math.comb(hashes + 1, m) * similarity ** m * (1 - similarity) ** (hashes + 1 - m)
        if total >= miss:
            return m
    return hashes


def signed(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, n, digest, sig); digest and sig are null for empty sets.  ``mark`` is a hash of the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("binary").alias("text"))

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.blocks(batches, "text", BLOCK_BYTES):
            sets = shingle_sets(W.utf8(part.column("text")), size)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "mark", "n", "digest", "sig"])

    return rows.mapInArrow(sign, "doc_id long, mark long, n long, digest binary, sig binary")


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the wanted (rep, digest, node)."""
    rows = (docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("binary").alias("text"))
            .join(wanted, "rep"))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.blocks(batches, "text", BLOCK_BYTES):
            sets = shingle_sets(W.utf8(part.column("text")), size)
            own = [_digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["node", "shingles"])
            yield out.filter(pa.array(own))

    return rows.select("node", "text", "digest").mapInArrow(build, "node long, shingles binary")


def likely(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Rows at which signatures a and b stay likely to reach the threshold through all batches."""
    alive, matches = np.arange(len(b)), np.zeros(len(b), dtype=np.int64)
    for k, need in enumerate(least):
        at = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + ((a[alive, at] if a.ndim == 2 else a[at]) == b[alive, at]).sum(axis=1)
        going = matches >= need
        alive, matches = alive[going], matches[going]
    return alive


def batch_bounds(percent: int) -> list[int]:
    return [least_matches(n, percent / 100, MISS) for n in range(BATCH, HASHES + 1, BATCH)]


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, HASHES)


def _both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    for side in "uv":
        pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def _likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (u, v) that pass the sizes' and the signatures' test."""
    least = batch_bounds(percent)

    def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            alive = likely(_signatures(b.column("sig_u")), _signatures(b.column("sig_v")), least)
            yield b.select(["u", "v"]).take(pa.array(alive))

    near = _both(pairs, classes, ["n", "sig"])
    near = near.where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
    return near.select("u", "v", "sig_u", "sig_v").mapInArrow(test, "u long, v long")


def reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets of distinct values reach the threshold."""
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(both) - same)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the threshold on their full sets."""
    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("shingles_u").to_pylist(), b.column("shingles_v").to_pylist(), strict=True):
                keep.append(reaches(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return _both(pairs, sets, ["shingles"]).select("u", "v", "shingles_u", "shingles_v").mapInArrow(exact, "u long, v long")


def _shared_shingles(sets: DataFrame, open_nodes: DataFrame, total: int) -> DataFrame:
    """(node, shared): how many of a document's shingles occur in another open document.

    Hashes travel as packed arrays, dealt by their leading bits into groups of about GROUP_HASHES.
    """
    bits = (total // GROUP_HASHES).bit_length()

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for node, s in zip(b.column("node").to_pylist(), b.column("shingles").to_pylist(), strict=True):
                h = np.frombuffer(s, dtype=np.uint64)
                group = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), dtype=np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(h)]
                rows += [(int(group[lo]), node, h[lo:hi].tobytes()) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                                             names=["part", "node", "hashes"])

    def count(t: pa.Table) -> pa.Table:
        nodes = t.column("node").to_pylist()
        lists = [np.frombuffer(h, dtype=np.uint64) for h in t.column("hashes").to_pylist()]
        sizes = np.array([len(x) for x in lists])
        every, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), sizes)
        order = np.argsort(every, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], np.diff(every[order]) != 0)))
        times = np.diff(np.append(new, len(every)))
        shared = np.bincount(owner[order], weights=np.repeat(times > 1, times), minlength=len(lists))
        return pa.table({"node": pa.array(nodes, pa.int64()), "shared": pa.array(shared.astype(np.int64))})

    own = sets.join(open_nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])
    return (own.mapInArrow(deal, "part long, node long, hashes binary")
            .groupBy("part").applyInArrow(count, "node long, shared long")
            .groupBy("node").agg(F.sum("shared").alias("shared")))


def _labelled(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, mark, n, component (its smallest id) and first (whether its set is the one that names it)."""
    rows = stage(signed(docs, shingle, id_col, text_col), "signed")
    # The signature is a function of the set, so any member's will do.  Nodes are numbered as
    # they lie in files, so that a repeated task gives the same numbers.
    found = stage(rows.where("n > 0 and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("members")), "classes")
    class_table = StagedTable(found.withColumn("node", F.monotonically_increasing_id()), "node")
    try:
        classes = class_table.df()
        group = _components(docs, classes, shingle, percent, id_col, text_col)
        named = classes.select("digest", "members", "rep", "node").join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = stage(named.drop("node"), "nodes")
        names = stage(named.groupBy("component").agg(F.min(F.struct("rep", "digest")).alias("least"), F.count(F.lit(1)).alias("classes")), "names")
        named = join_hot_groups(named, names, "component", "classes", named.count())
        named = stage(named.select("digest", "members", F.col("least.rep").alias("component"),
                                   (F.col("digest") == F.col("least.digest")).alias("first")), "named")
    finally:
        class_table.drop()
    # Classes with few members are joined by a shuffle, the few heavy ones stay in place; rows without a class do not move.
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    found = join_hot_groups(rows.where(linked).select("doc_id", "mark", "n", "digest"), named, "digest", "members", rows.count())
    alone = rows.where(~linked).select("doc_id", "mark", "n", F.col("doc_id").alias("component"), F.lit(True).alias("first"))
    return found.select("doc_id", "mark", "n", "component", "first").unionByName(alone)


def near_groups(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    found = _labelled(docs, shingle, percent, id_col, text_col)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def _components(docs: DataFrame, classes: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, component) of the classes that have links."""
    def banded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = band_keys(_signatures(b.column("sig")))
                node, n = (np.repeat(b.column(c).to_numpy(), BANDS) for c in ("node", "n"))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node), pa.array(n)], names=["key", "node", "n"])

    bands = stage(classes.select("node", "n", "sig").mapInArrow(banded, "key long, node long, n long"), "bands")
    counted = stage(bands.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("first")).where("m > 1"), "buckets")
    members = stage(join_hot_groups(bands, counted, "key", "m", bands.count()), "members")          # only buckets with company
    touched = members.select("node").distinct().join(classes.select("node", "rep", "digest"), "node")
    set_table = StagedTable(_full_sets(docs, touched, shingle, id_col, text_col), "node")
    try:
        sets = set_table.df()

        def confirm(pairs: DataFrame) -> DataFrame:
            return stage(_confirmed(stage(pairs, "likely"), sets, percent), "links")

        first = members.where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v")).distinct()
        group = stage(components(confirm(_likely_pairs(first, classes, percent))), "components")
        open_rows = _open(members.where("m > 2").select("key", "node", "n", "m"), group)
        if not open_rows.isEmpty():
            open_rows = _open(_closed(_open(_closed(open_rows, sets, percent)), sets, percent))
            large = stage(_block_links(open_rows, classes, sets, percent).distinct(), "links")
            group = _joined(group, large)
            small = _open(open_rows.where(F.col("m") <= SMALL).select("key", "node", "n", "m"), group)
            links = confirm(_likely_pairs(_small_pairs(small, percent), classes, percent))
            group = _joined(group, _between(links, group))
    finally:
        set_table.drop()
    return group


def _between(links: DataFrame, group: DataFrame) -> DataFrame:
    """The pairs of components that links join."""
    for side in "uv":
        own = group.select(F.col("node").alias(side), F.col("component").alias("_c"))
        links = links.join(own, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")
    return links.where("u <> v").distinct()


def _joined(group: DataFrame, links: DataFrame) -> DataFrame:
    """Components after links between them (a component is named by its least node)."""
    moved = stage(components(links).withColumnRenamed("component", "to").withColumnRenamed("node", "component"), "moved")
    known = group.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    # A component that is one node without links so far has no row in ``group``.
    new = moved.join(group.select(F.col("node").alias("component")), "component", "left_anti").select(
        F.col("component").alias("node"), F.col("to").alias("component"))
    return stage(known.unionByName(new), "components")


def _open(rows: DataFrame, group: DataFrame | None = None) -> DataFrame:
    """The members (key, node, n, m, component) of buckets that hold more than one component, staged."""
    if group is not None:
        rows = rows.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = stage(rows.select("key", "node", "n", "m", "component"), "placed")
    mixed = stage(rows.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("here"))
                  .where("a <> b").select("key", "here"), "mixed")
    return stage(join_hot_groups(rows, mixed, "key", "here", rows.count()).drop("here"), "open")


def _closed(open_rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Open members without those that cannot reach the threshold with any other open class.

    A partner of size k needs percent / (100 + percent) of n + k shingles in common,
    and k is at least the smallest open size and percent of n.
    """
    nodes = open_rows.groupBy("node").agg(F.max("n").alias("n"))
    total = nodes.agg(F.sum("n")).first()[0] or 0
    shared = stage(_shared_shingles(sets, nodes, total), "shared")
    smallest = stage(open_rows.groupBy("key").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("here")), "smallest")
    sized = join_hot_groups(open_rows.select("key", "node", "n"), smallest, "key", "here", open_rows.count())
    bound = (sized.groupBy("node").agg(F.max("n").alias("n"), F.min("least").alias("least"))
             .join(shared, "node").withColumn("k", F.greatest("least", F.ceil(F.col("n") * percent / 100))))
    alive = bound.where((100 + percent) * F.col("shared") >= percent * (F.col("n") + F.col("k"))).select("node")
    return open_rows.join(alive, "node", "left_semi")


def _small_pairs(open_rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in buckets of at most SMALL members."""
    a = open_rows.select("key", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "component")])
    b = open_rows.select("key", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "component")])
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return a.join(b, "key").where(apart & sizes).select(F.col("node_a").alias("u"), F.col("node_b").alias("v")).distinct()


class _Forest:
    """Components that a call has joined."""

    def __init__(self, components: np.ndarray):
        self.names, at = np.unique(components, return_inverse=True)
        self.root = np.arange(len(self.names))
        self.links: list[tuple[int, int]] = []
        self.at = at

    def join(self, a: int, b: int) -> None:
        """Note that the components of members a and b are linked, unless they are joined already."""
        x, y = self.root[self.at[a]], self.root[self.at[b]]
        if x != y:
            self.links.append((int(self.names[self.at[a]]), int(self.names[self.at[b]])))
            self.root[self.root == max(x, y)] = min(x, y)


def _block_links(open_rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components in larger buckets: members outside the bucket's main component against all its members.

    Both sides are dealt into blocks of about BLOCK_MEMBERS; one call compares one
    block of queries with one of members: by signatures, and what these leave by
    full sets, until the two are in one component.
    """
    rows = stage(open_rows.where(F.col("m") > SMALL), "large")
    total = rows.count()
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    main = stage(sizes.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("main"),
                                          F.sum("c").alias("all"), F.max("c").alias("most")), "main")
    rows = join_hot_groups(rows, main, "key", "all", total).join(classes.select("node", "sig"), "node").join(sets, "node")
    blocks = F.ceil(F.col("all") / BLOCK_MEMBERS).cast("int")
    asked = F.ceil((F.col("all") - F.col("most")) / BLOCK_MEMBERS).cast("int")
    own = F.xxhash64("node")
    cols = ["key", "node", "n", "component", "sig", "shingles"]
    members = rows.select(*cols, F.pmod(own, blocks).cast("int").alias("mb"), F.explode(F.sequence(F.lit(0), asked - 1)).alias("qb"))
    queries = rows.where("component <> main").select(*[F.col(c).alias(c) for c in cols], F.pmod(own, asked).cast("int").alias("qb"),
                                                     F.explode(F.sequence(F.lit(0), blocks - 1)).alias("mb"))
    least = batch_bounds(percent)

    def compare(q: pa.Table, m: pa.Table) -> pa.Table:
        links = []
        if q.num_rows and m.num_rows:
            (n_q, c_q), (n_m, c_m) = ([t.column(c).to_numpy() for c in ("n", "component")] for t in (q, m))
            sig_q, sig_m = (_signatures(t.column("sig").combine_chunks()) for t in (q, m))
            set_q, set_m = ([np.frombuffer(b, dtype=np.uint64) for b in t.column("shingles").to_pylist()] for t in (q, m))
            forest = _Forest(np.concatenate((c_q, c_m)))
            at_m = forest.at[len(c_q):]
            for i in range(len(n_q)):
                apart = forest.root[at_m] != forest.root[forest.at[i]]
                fit = np.flatnonzero(apart & (100 * np.minimum(n_m, n_q[i]) >= percent * np.maximum(n_m, n_q[i])))
                for j in fit[likely(sig_q[i], sig_m[fit], least)].tolist():
                    if forest.root[at_m[j]] != forest.root[forest.at[i]] and reaches(set_q[i], set_m[j], percent):
                        forest.join(i, len(c_q) + j)
            links = forest.links
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    return queries.groupBy("key", "qb", "mb").cogroup(members.groupBy("key", "qb", "mb")).applyInArrow(compare, "u long, v long")


def drop_near_copies(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One document of each group stays (its smallest id), with all its columns.

    A row leaves only if a row with its id and its text does, so null or reused ids
    cost no other text; rows that share both id and text stay or go together.
    """
    found = _labelled(docs, shingle, percent, id_col, text_col)
    stays = F.col("first") & F.col("doc_id").eqNullSafe(F.col("component"))
    gone = stage(found.where(~stays).select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_gone_mark")).distinct(), "gone")
    return without(docs, gone, id_col, F.xxhash64(docs[text_col]))
