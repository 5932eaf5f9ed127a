"""Benchmark decontamination with suffix arrays.

Each shard (a few megabytes of training text inside a task) gets a suffix array
over its words: the suffixes that start with a benchmark word n-gram, sorted by
their first ``window`` words.  Every suffix of every test item is binary-searched
in it, which gives all occurrences of its first ``window`` words; occurrences on
one diagonal are joined into longest verbatim matches with their locations.
Then affected documents are marked or removed.

The documents are read once a test block and their texts never shuffled.  The
test items are the stated query set: they are sent to the tasks in blocks of at
most ``BLOCK_WORDS`` words (a longer item is a block of its own), one broadcast a
block.  With several blocks the rows are staged once with a row number, and the
blocks' results are joined by it: every row is judged on its own at any size.

Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z in
lower case, compared by 64-bit hashes.  Null and empty texts have no words;
items without words never match; a null item id is the empty string.  Rows that
repeat in full are each reported.  Empty tables give no rows, an empty benchmark
no hits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W
from .common import stage

WINDOW = 10
BLOCK_WORDS = 500_000
SHARD_BYTES = 4 << 20
_ROW = ("row long, doc_id {id}, n_words long, spans array<struct<start:int,end:int>>, items array<string>, "
        "matches array<struct<item:string,start:int,length:int>>")


class TestBlock:
    """Searchable suffixes of some test items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        names, texts = [n for n, _ in items], [t for _, t in items]
        hashes, bounds = W.word_hashes([t.lower() for t in texts], W.ALNUM)
        sizes = np.diff(bounds)
        self.names, self.window = np.array(names, dtype=object), window
        self.vocab = np.unique(hashes)
        at, item, depth = [], [], []
        for i, n in enumerate(sizes.tolist()):
            if n:
                k = max(1, n - window + 1)
                at.append(bounds[i] + np.arange(k))
                item.append(np.full(k, i))
                depth.append(np.full(k, min(n, window)))
        empty = np.empty(0, dtype=np.int64)
        at, self.depth = (np.concatenate(x) if x else empty for x in (at, depth))
        self.item = np.concatenate(item) if item else empty
        self.offset = at - bounds[self.item] if len(at) else empty
        ranks = np.searchsorted(self.vocab, hashes).astype(np.uint32) + 1
        grid = at[:, None] + np.arange(window)
        inside = np.arange(window) < self.depth[:, None]
        keys = np.where(inside, ranks[np.minimum(grid, max(0, len(ranks) - 1))] if len(ranks) else 0, 0).astype(">u4")
        self.low = np.ascontiguousarray(keys).view(f"S{4 * window}").ravel()
        self.high = np.ascontiguousarray(np.where(inside, keys, 0xFFFFFFFF).astype(">u4")).view(f"S{4 * window}").ravel()
        # The shortest start that all test suffixes have, to pick a shard's suffixes.
        self.gram = int(min(3, self.depth.min())) if len(at) else 0
        if self.gram:
            starts = np.unique(W.gram_hashes(hashes, self.gram)[at])
            self.starts = starts
            self.table = np.zeros(1 << 20, dtype=bool)
            self.table[starts & np.uint64((1 << 20) - 1)] = True

    def search(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in the shard, numbers of the test suffixes) of all occurrences."""
        none = np.empty(0, dtype=np.int64)
        if not self.gram or len(hashes) < self.gram:
            return none, none
        grams = W.gram_hashes(hashes, self.gram)
        maybe = np.flatnonzero(self.table[grams & np.uint64((1 << 20) - 1)])
        g = grams[maybe]
        place = np.minimum(np.searchsorted(self.starts, g), len(self.starts) - 1)
        first = maybe[self.starts[place] == g]
        if not len(first):
            return none, none
        ends = bounds[np.searchsorted(bounds, first, side="right")]          # end of the suffix's document
        grid = first[:, None] + np.arange(self.window)
        inside = grid < ends[:, None]
        near = hashes[np.minimum(grid, len(hashes) - 1)]
        rank = np.minimum(np.searchsorted(self.vocab, near), len(self.vocab) - 1)
        known = self.vocab[rank] == near
        keys = np.where(inside, np.where(known, rank + 1, 0xFFFFFFFE), 0).astype(">u4")
        keys = np.ascontiguousarray(keys).view(f"S{4 * self.window}").ravel()
        order = np.argsort(keys, kind="stable")                              # the shard's suffix array
        keys = keys[order]
        lo = np.searchsorted(keys, self.low, side="left")
        hi = np.searchsorted(keys, self.high, side="right")
        n = hi - lo
        tests = np.repeat(np.arange(len(n)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pos = first[order[np.repeat(lo, n) + inner]]
        # A short item's suffix may not run over the end of a document.
        fits = pos + self.depth[tests] <= bounds[np.searchsorted(bounds, pos, side="right")]
        return pos[fits], tests[fits]


def _spans(pos: np.ndarray, depth: np.ndarray) -> list[tuple[int, int]]:
    """Union of [pos, pos + depth) as sorted disjoint spans."""
    order = np.argsort(pos, kind="stable")
    start, end = pos[order], np.maximum.accumulate((pos + depth)[order])
    new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    last = np.concatenate((new[1:] - 1, [len(start) - 1]))
    return list(zip(start[new].tolist(), end[last].tolist(), strict=True))


def _matches(block: TestBlock, pos: np.ndarray, tests: np.ndarray) -> list[tuple[str, int, int]]:
    """Longest verbatim matches: runs of occurrences on one diagonal of one item."""
    item, diagonal = block.item[tests], pos - block.offset[tests]
    order = np.lexsort((pos, diagonal, item))
    pos, item, diagonal, depth = pos[order], item[order], diagonal[order], block.depth[tests][order]
    same = (item[1:] == item[:-1]) & (diagonal[1:] == diagonal[:-1]) & (pos[1:] == pos[:-1] + 1)
    new = np.flatnonzero(np.concatenate(([True], ~same)))
    last = np.concatenate((new[1:] - 1, [len(pos) - 1]))
    return [(block.names[i], s, e - s) for i, s, e in zip(
        item[new].tolist(), pos[new].tolist(), (pos[last] + depth[last]).tolist(), strict=True)]


def test_blocks(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> Iterator[TestBlock]:
    """The test items in blocks; the driver holds one or two at a time."""
    held, size = [], 0
    for row in benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")),
                                F.coalesce(F.col(text_col), F.lit("")).cast("binary")).toLocalIterator():
        text = bytes(row[1])
        n = len(text) // 2 + 1                    # at most so many words
        if held and size + n > BLOCK_WORDS * 4:
            yield TestBlock(held, window)
            held, size = [], 0
        held.append((row[0], text))
        size += n
    yield TestBlock(held, window)


def _scan(docs: DataFrame, block, id_type: str, only_hits: bool) -> DataFrame:
    """Rows (row, doc_id, n_words, spans, items, matches) of documents against one block."""
    schema = _ROW.format(id=id_type)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = block.value
        for part in W.blocks(batches, "text", SHARD_BYTES):
            hashes, bounds = W.word_hashes([t.lower() for t in W.utf8(part.column("text"))], W.ALNUM)
            pos, tests = test.search(hashes, bounds)
            doc = np.searchsorted(bounds, pos, side="right") - 1
            order = np.argsort(doc, kind="stable")
            pos, tests, doc = pos[order], tests[order], doc[order]
            rows, firsts, counts = np.unique(doc, return_index=True, return_counts=True)
            lasts = firsts + counts
            n = part.num_rows
            spans, items, matches = [[]] * n, [[]] * n, [[]] * n
            for d, lo, hi in zip(rows.tolist(), firsts.tolist(), lasts.tolist(), strict=True):
                own, at = tests[lo:hi], pos[lo:hi] - bounds[d]
                spans[d] = [{"start": a, "end": b} for a, b in _spans(at, test.depth[own])]
                items[d] = sorted(set(test.names[test.item[own]]))
                matches[d] = [{"item": i, "start": s, "length": k} for i, s, k in _matches(test, at, own)]
            out = pa.RecordBatch.from_arrays([
                part.column("row"), part.column("doc_id"), pa.array(np.diff(bounds), pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(items, pa.list_(pa.string())),
                pa.array(matches, pa.list_(pa.struct([("item", pa.string()), ("start", pa.int32()), ("length", pa.int32())])))],
                names=["row", "doc_id", "n_words", "spans", "items", "matches"])
            yield out.take(pa.array(rows)) if only_hits else out

    return docs.mapInArrow(scan, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items (sorted), matches, contaminated."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    blocks = test_blocks(benchmark, window, item_col, item_text)
    head, more = next(blocks), next(blocks, None)
    if more is not None:      # every block has to see the same row numbers
        rows = stage(rows, "rows")
    found = _scan(rows, sc.broadcast(head), id_type, only_hits=False)
    if more is not None:
        for block in chain([more], blocks):
            found = found.unionByName(_scan(rows, sc.broadcast(block), id_type, only_hits=True))
        found = (found.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.flatten(F.collect_list("matches")).alias("matches"))
            .withColumn("spans", _union(F.col("spans"))))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", length.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sort_array("items").alias("items"), "matches", (F.size("spans") > 0).alias("contaminated"))


def _union(spans):
    """Sorted disjoint spans from any spans of one document."""
    kind = "array<struct<start:int,end:int>>"

    def add(acc, s):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= s["start"]), joined).otherwise(
            F.concat(acc, F.array(s)))

    return F.aggregate(F.sort_array(spans), F.array().cast(kind), add)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without any occurrence of a test window, with all their columns; nothing is shuffled."""
    sc = docs.sparkSession.sparkContext
    for block in test_blocks(benchmark, window, item_col, item_text):
        held = sc.broadcast(block)

        def clean(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for part in W.blocks(batches, text_col, SHARD_BYTES):
                hashes, bounds = W.word_hashes([t.lower() for t in W.utf8(part.column(text_col))], W.ALNUM)
                pos, _ = held.value.search(hashes, bounds)
                keep = np.ones(part.num_rows, dtype=bool)
                keep[np.searchsorted(bounds, pos, side="right") - 1] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
