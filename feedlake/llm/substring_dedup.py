"""Substring de-duplication with difference-cover anchors.

A word is removed if a window of ``window`` words that covers it also starts in a
document with a smaller id.  Anchors are shorter word sequences hashed only at
positions whose number modulo a period lies in a difference cover: whatever the
two places of a repeated window, some shift below the period puts both on cover
positions, so the two share an aligned anchor inside the window.  Anchors found
in more than one document open the windows around them; only those are hashed
whole, compared over the corpus and give the words to remove.

Documents are staged once in chunks (a table bucketed by chunk), so the three
passes over them need no shuffle.  What is shuffled are packed arrays of hashes,
combined per chunk first: a sequence that a third of all documents repeat costs
one entry a chunk, never a pair.  Windows are compared by 64-bit hashes.

Texts are split at ASCII white space and otherwise unchanged.  Null and empty texts
have no words.  A null id counts as larger than all others.  Rows that share an
id never remove words from each other.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W
from .common import StagedTable, stage

# Perfect difference covers: every number modulo the period is a difference of two members.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
CHUNK_ROWS = 4096
BUCKET_BYTES = 24 << 20         # text per bucket of the staged table
GROUP_HASHES = 1 << 20          # hashes one task compares
NO_ID = np.iinfo(np.int64).max


def _period(window: int) -> int:
    """The longest period that leaves anchors at least half a window long."""
    fit = [p for p in COVERS if window - p + 1 >= max(1, window // 2)]
    return max(fit, default=1)


class _Chunk:
    """Words of some documents, and where they lie."""

    def __init__(self, rows: pa.Table):
        self.ids = rows.column("doc_id").combine_chunks()
        self.key = np.array([NO_ID if v is None else v for v in self.ids.to_pylist()], dtype=np.int64)
        self.texts = [v or b"" for v in rows.column("text").to_pylist()]
        self.words, self.bounds = W.word_hashes(self.texts, W.WHITE)
        self.sizes = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(self.words)) - self.bounds[:-1][self.doc]

    def starts(self, n: int) -> np.ndarray:
        """Positions at which n words of one document follow."""
        return np.flatnonzero(self.place + n <= self.sizes[self.doc])

    def anchors(self, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors at cover positions."""
        n = window - period + 1
        cover = np.zeros(period, dtype=bool)
        cover[list(COVERS.get(period, (0,)))] = True
        at = self.starts(n)
        at = at[cover[self.place[at] % period]]
        return at, W.gram_hashes(self.words, n)[at] if len(at) else np.empty(0, dtype=np.uint64)


def _first_of(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, smallest key of each, whether two keys differ)."""
    if not len(hashes):
        return hashes, keys, np.empty(0, dtype=bool)
    order = np.argsort(hashes, kind="stable")
    hashes, keys = hashes[order], keys[order]
    new = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    low, high = np.minimum.reduceat(keys, new), np.maximum.reduceat(keys, new)
    return hashes[new], low, low != high


def _slices(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(group, from, to) of sorted hashes, by their leading bits."""
    if bits == 0:
        yield 0, 0, len(hashes)
        return
    group = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(hashes)], strict=True):
        if hi > lo:
            yield int(group[lo]), lo, hi


def _short(hashes: np.ndarray) -> bytes:
    """The low 48 bits; the group holds the leading ones."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(short: bytes, group: int, bits: int) -> np.ndarray:
    out = np.zeros((len(short) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(short, dtype=np.uint8).reshape(-1, 6)
    lead = np.uint64(group << (64 - bits)) if bits else np.uint64(0)
    low = np.uint64((1 << 48) - 1)
    return (out.view("<u8").ravel() & low) | (lead & ~low)


def _cut48(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Hashes as _long gives them back."""
    low = np.uint64((1 << 48) - 1)
    lead = ~np.uint64((1 << (64 - bits)) - 1) if bits else np.uint64(0)
    return (hashes & low) | (hashes & lead & ~low)


def _staged(docs: DataFrame, id_col: str, text_col: str) -> tuple[StagedTable, int]:
    """(documents in chunks, bytes of text); a task writes the chunks it reads, nothing is shuffled."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = F.monotonically_increasing_id()
    row = F.pmod(number, F.lit(1 << 33))
    chunk = F.shiftright(number, 33) * F.lit(1 << 20) + F.floor(row / CHUNK_ROWS)
    return StagedTable(rows.withColumn("chunk", chunk), "chunk", max(1, -(-size // BUCKET_BYTES)), deal=False), size


def remove_repeats(docs: DataFrame, *, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, removed (spans of words), kept (the words left, joined by a space).

    The result is read from files in the shared folder.
    """
    period = _period(window)
    table, size = _staged(docs, id_col, text_col)
    a_bits = max(0, (size // 14 // GROUP_HASHES)).bit_length()       # about one anchor in 14 bytes
    w_bits = a_bits

    def anchors(rows: pa.Table) -> pa.Table:
        c = _Chunk(rows)
        at, hashes = c.anchors(window, period)
        hashes, _, several = _first_of(hashes, c.key[c.doc[at]])
        out = [(g, _short(hashes[lo:hi]), np.packbits(several[lo:hi]).tobytes()) for g, lo, hi in _slices(hashes, a_bits)]
        return _table([("chunk", pa.int64(), [rows.column("chunk")[0].as_py()] * len(out)), ("part", pa.int32(), [x[0] for x in out]),
                       ("hashes", pa.binary(), [x[1] for x in out]), ("several", pa.binary(), [x[2] for x in out])])

    def repeated_anchors(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        hashes = [_long(h, part, a_bits) for h in rows.column("hashes").to_pylist()]
        several = np.concatenate([np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=len(h)) for s, h in
                                  zip(rows.column("several").to_pylist(), hashes, strict=True)])
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], np.diff(every[order]) != 0)))
        count = np.diff(np.append(new, len(every)))
        hot = (count > 1) | (np.maximum.reduceat(several[order], new) > 0)
        keep = np.sort(order[np.repeat(hot, count)])
        return _answers(rows, every[keep], owner[keep], None, part)

    def windows(rows: pa.Table, found: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py() if rows.num_rows else 0
        out = []
        if rows.num_rows and found.num_rows:
            c = _Chunk(rows)
            at, hashes = c.anchors(window, period)
            known = np.sort(np.concatenate([_long(h, p, a_bits) for p, h in zip(
                found.column("part").to_pylist(), found.column("hashes").to_pylist(), strict=True)]))
            open_at = at[_isin(_cut48(hashes, a_bits), known)]
            reach = np.zeros(len(c.words) + 1, dtype=np.int32)       # windows that hold an open anchor
            np.add.at(reach, np.maximum(open_at - period + 1, c.bounds[:-1][c.doc[open_at]]), 1)
            np.add.at(reach, open_at + 1, -1)
            near = np.cumsum(reach[:-1]) > 0
            start = c.starts(window)
            start = start[near[start]]
            hashes = W.gram_hashes(c.words, window)[start] if len(start) else np.empty(0, dtype=np.uint64)
            hashes, low, several = _first_of(hashes, c.key[c.doc[start]])
            out = [(g, hashes[lo:hi].tobytes(), low[lo:hi].tobytes(), np.packbits(several[lo:hi]).tobytes())
                   for g, lo, hi in _slices(hashes, w_bits)]
        return _table([("chunk", pa.int64(), [chunk] * len(out)), ("part", pa.int32(), [x[0] for x in out]),
                       ("hashes", pa.binary(), [x[1] for x in out]), ("low", pa.binary(), [x[2] for x in out]),
                       ("several", pa.binary(), [x[3] for x in out])])

    def repeated_windows(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(h, dtype=np.uint64) for h in rows.column("hashes").to_pylist()]
        low = np.concatenate([np.frombuffer(h, dtype=np.int64) for h in rows.column("low").to_pylist()])
        several = np.concatenate([np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=len(h)) for s, h in
                                  zip(rows.column("several").to_pylist(), hashes, strict=True)])
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], np.diff(every[order]) != 0)))
        count = np.diff(np.append(new, len(every)))
        first = np.repeat(np.minimum.reduceat(low[order], new), count)
        # A chunk needs the answer if a document of it comes after the first one.
        need = (several[order] > 0) | (low[order] > first)
        first_of = np.empty_like(first)
        first_of[order] = first
        keep = np.sort(order[need])
        return _answers(rows, every[keep], owner[keep], first_of[keep], 0)

    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _result([], [], [], [], [])
        c = _Chunk(rows)
        covered = np.zeros(len(c.words) + 1, dtype=np.int32)
        if found.num_rows:
            known = np.concatenate([np.frombuffer(h, dtype=np.uint64) for h in found.column("hashes").to_pylist()])
            first = np.concatenate([np.frombuffer(h, dtype=np.int64) for h in found.column("low").to_pylist()])
            order = np.argsort(known, kind="stable")
            known, first = known[order], first[order]
            start = c.starts(window)
            hashes = W.gram_hashes(c.words, window)[start] if len(start) else np.empty(0, dtype=np.uint64)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            gone = start[(known[at] == hashes) & (first[at] < c.key[c.doc[start]])]
            np.add.at(covered, gone, 1)
            np.add.at(covered, gone + window, -1)
        covered = np.cumsum(covered[:-1]) > 0
        removed = np.diff(np.concatenate(([0], np.cumsum(covered)))[c.bounds])
        spans, kept = [], []
        for i, text in enumerate(c.texts):
            own = text.split()
            if not removed[i]:
                spans.append([])
                kept.append(b" ".join(own))
                continue
            mask = covered[c.bounds[i]:c.bounds[i + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0])))).tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            kept.append(b" ".join([w for w, g in zip(own, mask.tolist(), strict=True) if not g]))
        return _result(c.ids, c.sizes, removed, spans, kept)

    chunks = table.df().groupBy("chunk")
    pairs = (chunks.applyInArrow(anchors, "chunk long, part int, hashes binary, several binary")
             .groupBy("part").applyInArrow(repeated_anchors, "chunk long, part int, hashes binary, low binary"))
    opened = (chunks.cogroup(pairs.groupBy("chunk"))
              .applyInArrow(windows, "chunk long, part int, hashes binary, low binary, several binary"))
    first = opened.groupBy("part").applyInArrow(repeated_windows, "chunk long, part int, hashes binary, low binary")
    result = (chunks.cogroup(first.groupBy("chunk"))
              .applyInArrow(cut, "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string"))
    out = stage(result, "kept")
    table.drop()
    return out


def _isin(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _table(columns: list[tuple]) -> pa.Table:
    return pa.table({name: pa.array(values, kind) for name, kind, values in columns})


def _answers(rows: pa.Table, hashes: np.ndarray, owner: np.ndarray, low: np.ndarray | None, part: int) -> pa.Table:
    """One row for each chunk of ``rows`` that gets hashes; ``owner`` numbers the rows, in order."""
    chunk = rows.column("chunk").to_pylist()
    cuts = np.searchsorted(owner, np.arange(len(chunk) + 1))
    some = [i for i in range(len(chunk)) if cuts[i + 1] > cuts[i]]
    pack = _short if low is None else np.ndarray.tobytes
    return _table([("chunk", pa.int64(), [chunk[i] for i in some]), ("part", pa.int32(), [part] * len(some)),
                   ("hashes", pa.binary(), [pack(hashes[cuts[i]:cuts[i + 1]]) for i in some]),
                   ("low", pa.binary(), [None if low is None else low[cuts[i]:cuts[i + 1]].tobytes() for i in some])])


def _result(ids, sizes, removed, spans, kept) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes, pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()),
                     "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     "kept": pa.array(kept, pa.binary()).cast(pa.string())})
