"""Sequence packing by non-negative least squares over length combinations.

A document of n tokens gives n // window full pieces and a tail.  The tails'
length histogram (at most window - 1 numbers, all documents counted) goes to the
driver, where shallow combinations of lengths that fill a window exactly are
enumerated, their repeat counts fitted to the histogram by non-negative least
squares (coordinate descent) and rounded down.  Tail number k of its length, in a
numbering made by counting per input partition, then belongs to a fixed place of
a fixed combination.  What no combination takes is packed greedily, longest
first, end to end with cuts at the window; the last, incomplete window is cut
into powers of two, which need no padding.

Only lengths and plans reach the driver; tokens stay in the tasks.  Null and empty
texts have the end id only.  Rows repeated in full are packed each.  An empty
table gives no rows.  Sequence ids are unique, not gapless: full windows are
numbered per input partition from ``1 << 40`` up.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import words as W
from .common import StagedTable, stage

MEMO = 1_200_000            # words a worker remembers ...
MEMO_IDS = 16 * MEMO        # ... and their ids
BLOCK_BYTES = 2 << 20
BUFFER = 1 << 18            # bytes looked up at a time: their arrays stay in a core's cache
SWEEPS = 60


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True
_SECOND = np.zeros(256, dtype=bool)                  # second byte of a Latin-1 letter whose first is 0xC3
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_OTHER, _WHITE, _PUNCTUATION = range(3)
_KINDS = bytes(_WHITE if W.WHITE[c] else _PUNCTUATION if 0x21 <= c < 0x7F and not chr(c).isalnum() else _OTHER for c in range(256))

# Letters of ASCII (lower-case) and Latin-1, as UTF-8: composed, and lower-cased each by itself.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# Byte-level text: visible bytes stand for themselves, the others for the next characters from 256 on; spaces stay.
_BYTE_LEVEL = np.arange(256, dtype="<u4")
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
_BYTE_LEVEL[_HIDDEN] = np.arange(256, 256 + len(_HIDDEN))
_BYTE_LEVEL[0x20] = 0x20

# A word of up to SHORT bytes is two numbers: its bytes, padded with zeros, with its length in the last byte.
SHORT = 15
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_SPREAD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]


class WordTokens:
    """Token ids of texts, by words: a word between ASCII white space is tokenised
    once and remembered.  Right for tokenizers that lower-case, drop white space,
    never join or change text across it, and split letters from punctuation.

    Short words are found in a hash table of arrays, a whole buffer at a time and
    by all their bytes; longer ones, which are rare, in a dictionary.
    """

    def __init__(self, definition: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.end = Tokenizer.from_str(definition), end
        # A model that marks word ends codes a list of plain words in one go: no normaliser
        # or splitting pattern changes those, and the marks tell the words apart.
        suffix = json.loads(definition)["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix and '"ByteLevel"' in definition:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
            self.ends = np.array([t.endswith(suffix) for t in names])
        self._clear()

    def _clear(self) -> None:
        """Words are numbered from 1; a slot with 0 is free."""
        self.known, self.long = 0, {}
        self.slots = np.zeros(1 << 15, dtype=np.int32)
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.low, self.high = np.zeros(1 << 14, dtype=np.uint64), np.zeros(1 << 14, dtype=np.uint64)
        self.start, self.size = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def _homes(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = low * _SPREAD[0] + high * _SPREAD[1]
        h = (h ^ (h >> np.uint64(32))) * _SPREAD[2]
        return (h >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of short words, 0 where unknown."""
        home = self._homes(low, high)
        at = self.slots[home].astype(np.int64)
        rest = np.flatnonzero((at > 0) & ((self.low[at] != low) | (self.high[at] != high)))
        while len(rest):
            home[rest] = (home[rest] + 1) & (len(self.slots) - 1)
            some = self.slots[home[rest]]
            at[rest] = some
            rest = rest[(some > 0) & ((self.low[some] != low[rest]) | (self.high[some] != high[rest]))]
        return at

    def _place(self, at: np.ndarray) -> None:
        """Give different short words, by number, their slots."""
        home = self._homes(self.low[at], self.high[at])
        while len(at):
            free = self.slots[home] == 0
            self.slots[home[free]] = at[free]
            lost = self.slots[home] != at
            at, home = at[lost], (home[lost] + 1) & (len(self.slots) - 1)

    def _coded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each)."""
        coded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        ids = [e.ids for e in coded]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _coded_plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of plain letters, as byte-level text."""
        text = b" ".join(words).decode()
        if not text.isascii():
            text = _BYTE_LEVEL[np.frombuffer(text.lower().encode(), dtype=np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def _learn(self, new: list[bytes], low: np.ndarray, high: np.ndarray) -> None:
        plain, other = [], []
        for k, w in enumerate(new):
            (plain if self.ends is not None and (w.isalpha() or _PLAIN.fullmatch(w)) else other).append(k)
        for some, coded in ((plain, self._coded_plain), (other, self._coded)):
            if some:
                words = [new[k] for k in some]
                self._keep(words, low[some], high[some], *coded(words))

    def _keep(self, new: list[bytes], low: np.ndarray, high: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        n, used, upto = self.known + 1, self.used, self.known + 1 + len(new)
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while upto > len(self.start):
            self.start, self.size, self.low, self.high = (
                np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.size, self.low, self.high))
        self.flat[used:used + len(ids)] = ids
        self.start[n:upto] = used + np.cumsum(sizes) - sizes
        self.size[n:upto] = sizes
        short = np.fromiter(map(len, new), dtype=np.int64, count=len(new)) <= SHORT
        self.low[n:upto], self.high[n:upto] = np.where(short, low, 0), np.where(short, high, 0)
        for k in np.flatnonzero(~short).tolist():
            self.long[new[k]] = n + k
        self.known, self.used = upto - 1, used + len(ids)
        if 2 * upto > len(self.slots):
            self.slots = np.zeros(1 << (2 * upto).bit_length(), dtype=np.int32)
            self._place(np.flatnonzero(self.high[:upto]))
        else:
            self._place(n + np.flatnonzero(short))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by the end id; bounds)."""
        if self.known > MEMO or self.used > MEMO_IDS:
            self._clear()
        parts, owner, whole = [], [], {}
        for i, t in enumerate(texts):
            cut = None if b"<|" in t else _cut(t.lower())
            if cut is None:              # the name of a special token, or a word beyond a chunk: as it is
                whole[i] = self._coded([t])[0]
            else:
                parts += cut
                owner += [i] * len(cut)
        ids, counts = self._buffers(parts)
        lengths = np.bincount(np.array(owner, dtype=np.int64), weights=counts, minlength=len(texts)).astype(np.int64)
        for i, own in whole.items():
            lengths[i] = len(own)
        bounds = np.concatenate(([0], np.cumsum(lengths + 1)))
        out = np.full(bounds[-1], self.end, dtype=np.uint32)
        text = np.ones(len(out), dtype=bool)
        text[bounds[1:] - 1] = False
        for i, own in whole.items():
            out[bounds[i]:bounds[i] + len(own)] = own
            text[bounds[i]:bounds[i] + len(own)] = False
        out[text] = ids
        return out, bounds

    def _buffers(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per part), joining parts into buffers; a longer part stands alone."""
        ids, counts, i = [np.empty(0, dtype=np.uint32)], [np.empty(0, dtype=np.int64)], 0
        while i < len(parts):
            size, j = 0, i
            while j < len(parts) and (j == i or size + len(parts[j]) < BUFFER):
                size += len(parts[j]) + 1
                j += 1
            some, n = self._buffer(parts[i:j])
            ids.append(some)
            counts.append(n)
            i = j
        return np.concatenate(ids), np.concatenate(counts)

    def _buffer(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for one buffer: its words are looked up together, and new ones learnt."""
        raw = b" ".join([b"", *parts, b" " * 16])                # 16 bytes can be read from any word on
        starts, ends = _spans(raw)
        lengths = ends - starts
        eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        low = eight[starts] & _KEEP[np.minimum(lengths, 8)]
        high = eight[starts + 8] & _KEEP[np.clip(lengths - 8, 0, 7)] | lengths.astype(np.uint64) << np.uint64(56)
        at = self._find(low, high)
        long = np.flatnonzero(lengths > SHORT)
        at[long] = [self.long.get(raw[a:b], 0) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        new = np.flatnonzero(at == 0)
        if len(new):
            words = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            first = dict(zip(reversed(words), reversed(new.tolist()), strict=True))
            self._learn(list(first), low[[*first.values()]], high[[*first.values()]])
            at[new] = self._find(low[new], high[new])
            long = np.flatnonzero(lengths[new] > SHORT)
            at[new[long]] = [self.long[words[k]] for k in long.tolist()]
        sizes = self.size[at]
        upto = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.start[at] - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)]
        part_ends = np.cumsum([len(t) + 1 for t in parts]) + 1
        return ids, np.diff(np.concatenate(([0], upto))[np.searchsorted(starts, part_ends)], prepend=0)


def _spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of lower-cased text that starts and ends with white space.

    Punctuation at the end of a word, after a letter of ASCII or Latin-1 or an ASCII digit, is a word of its own.
    """
    buf, kinds = np.frombuffer(raw, dtype=np.uint8), np.frombuffer(raw.translate(_KINDS), dtype=np.uint8)
    white = kinds == _WHITE
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    some = np.flatnonzero(kinds[ends - 1] == _PUNCTUATION)
    solid = np.flatnonzero(kinds != _PUNCTUATION)
    stop = solid[np.searchsorted(solid, ends[some]) - 1]              # the last byte before it
    tail = (stop >= starts[some]) & (_LETTER[buf[stop]] | (_SECOND[buf[stop]] & (buf[stop - 1] == 0xC3)))
    some, at = some[tail], stop[tail] + 1
    return np.insert(starts, some + 1, at), np.insert(ends, some, at)


def _cut(text: bytes) -> list[bytes] | None:
    """A text in parts shorter than a chunk, cut at white space; none if a word is too long."""
    out = []
    while len(text) >= W.CHUNK:
        at = max(text.rfind(c, 0, W.CHUNK - 1) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        if at < 0:
            return None
        out.append(text[:at])
        text = text[at + 1:]
    return [*out, text]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_coders: dict[tuple, WordTokens] = {}


def tokenised(docs: DataFrame, definition: str, end: int, window: int, id_col: str, text_col: str) -> DataFrame:
    """Per document: its full pieces' checksums, its tail, and its number among tails of that length in the partition."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(definition)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (zlib.crc32(held.value.encode()), end)
        if key not in _coders:                 # a worker that is reused keeps its words
            _coders[key] = WordTokens(held.value, end)
        coder = _coders[key]
        part = TaskContext.get().partitionId()
        seen, fulls = np.zeros(window, dtype=np.int64), 0
        for block in W.blocks(batches, "text", BLOCK_BYTES):
            ids, bounds = coder.encode(W.utf8(block.column("text")))
            lengths = np.diff(bounds)
            full, rest = lengths // window, lengths % window
            order = np.argsort(rest, kind="stable")                # number tails of one length in turn
            run = np.concatenate(([0], np.cumsum(np.bincount(rest, minlength=window))))[:-1]
            rank = np.empty(len(rest), dtype=np.int64)
            rank[order] = np.arange(len(rest)) - run[rest[order]]
            rank += seen[rest]
            seen += np.bincount(rest, minlength=window)
            sums = [[crc(ids[a + k * window:a + (k + 1) * window]) for k in range(f)]
                    for a, f in zip(bounds[:-1].tolist(), full.tolist(), strict=True)]
            tails = [ids[b - r:b].astype("<u4").tobytes() for b, r in zip(bounds[1:].tolist(), rest.tolist(), strict=True)]
            before = fulls + np.cumsum(full) - full
            fulls += int(full.sum())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(lengths), pa.array(sums, pa.list_(pa.int64())),
                 pa.array(before), pa.array(np.full(len(rest), part, dtype=np.int32)), pa.array(rest.astype(np.int32)),
                 pa.array(rank), pa.array(tails, pa.binary())],
                names=["doc_id", "tokens", "sums", "before", "part", "rest", "rank", "tail"])

    return rows.mapInArrow(encode, f"doc_id {kind}, tokens long, sums array<long>, before long, part int, rest int, "
                                   "rank long, tail binary")


def combinations(window: int, lengths: np.ndarray) -> list[dict[int, int]]:
    """Shallow combinations that fill the window: {length: times}, of lengths that occur."""
    have, out = set(lengths.tolist()), set()
    for a in sorted(have):
        for times in range(1, 7):                    # a, several times, and one or two equal parts for the rest
            left = window - a * times
            if left < 0:
                break
            for parts in (0, 1, 2):
                if parts and left < parts or not parts and left:
                    continue
                extra = [] if not parts else [left] if parts == 1 else [left // 2, left - left // 2]
                if all(x in have for x in extra):
                    out.add(tuple(sorted([a] * times + extra)))
    return [{x: c.count(x) for x in set(c)} for c in sorted(out)]


def fit_repeats(hist: np.ndarray, combos: list[dict[int, int]]) -> np.ndarray:
    """Whole repeat counts of combinations that never use more tails than there are.

    Minimises |hist - A x|^2 over x >= 0 by coordinate descent, rounds down and
    then lets each combination take what is still left whole.
    """
    x, left = np.zeros(len(combos)), hist.astype(float)
    norms = [sum(k * k for k in c.values()) for c in combos]
    for _ in range(SWEEPS):
        moved = 0.0
        for j, c in enumerate(combos):
            step = max(-x[j], sum(k * left[r] for r, k in c.items()) / norms[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for r, k in c.items():
                    left[r] -= k * step
        if moved < 0.05:
            break
    whole = np.floor(x + 1e-9).astype(np.int64)
    left = hist.astype(np.int64).copy()
    for j in np.argsort(-whole, kind="stable").tolist():
        whole[j] = min(int(whole[j]), *(int(left[r]) // k for r, k in combos[j].items()))
        for r, k in combos[j].items():
            left[r] -= k * whole[j]
    for j, c in enumerate(combos):
        more = min(int(left[r]) // k for r, k in c.items())
        if more:
            whole[j] += more
            for r, k in c.items():
                left[r] -= k * more
    return whole


class Plan:
    """Where tail number g of length r goes."""

    def __init__(self, hist: np.ndarray, window: int):
        self.window, combos = window, combinations(window, np.flatnonzero(hist))
        repeats = fit_repeats(hist, combos)
        taken, places = np.zeros(window, dtype=np.int64), {}
        self.sequences = 0
        for c, times in zip(combos, repeats.tolist(), strict=True):
            if times:
                offset = 0
                for r, k in sorted(c.items()):
                    for _ in range(k):
                        places.setdefault(r, []).append((int(taken[r]), self.sequences, offset))
                        taken[r] += times
                        offset += r
                self.sequences += times
        self.taken = taken
        self.places = {r: np.array(v, dtype=np.int64) for r, v in places.items()}
        left = hist - taken
        order = np.arange(window)[::-1]                         # greedy: longest first
        size = left[order] * order
        self.base = np.zeros(window, dtype=np.int64)
        self.base[order] = np.cumsum(size) - size
        total = int(size.sum())
        # Ends of the cut windows: the window as often as it fits, then powers of two.
        self.whole, self.edges, at = total // window, [], total // window * window
        for bit in reversed(range(window.bit_length())):
            if (total - total // window * window) >> bit & 1:
                at += 1 << bit
                self.edges.append(at)

    def pieces(self, r: int, g: int) -> list[tuple[int, int, int, int]]:
        """(start in the tail, length, sequence, offset) of the tail's pieces."""
        if g < self.taken[r]:
            p = self.places[r]
            first, sequence, offset = p[np.searchsorted(p[:, 0], g, side="right") - 1].tolist()
            return [(0, r, sequence + g - first, offset)]
        at, out, start = int(self.base[r] + (g - self.taken[r]) * r), [], 0
        while start < r:
            pos = at + start
            k = pos // self.window
            if k < self.whole:
                low, high = k * self.window, (k + 1) * self.window
            else:
                i = next(i for i, e in enumerate(self.edges) if pos < e)
                low, high = self.edges[i - 1] if i else self.whole * self.window, self.edges[i]
                k = self.whole + i
            size = min(r - start, high - pos)
            out.append((start, size, self.sequences + k, pos - low))
            start += size
        return out


def pack(docs: DataFrame, tokenizer_path: str, *, window: int = 2048, end: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (read from files in the shared folder)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    # Bucketed by the task that wrote them: the tails stay where they are when they learn their numbers.
    table = StagedTable(tokenised(docs, definition, end, window, id_col, text_col), "part", deal=False)
    try:
        return stage(_packed(table.df(), window), "pieces")
    finally:
        table.drop()


def _packed(coded: DataFrame, window: int) -> DataFrame:
    counts = coded.where("rest > 0").groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"))
    hist = np.zeros(window, dtype=np.int64)
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect():     # fewer rows than the window has tokens
        hist[r["rest"]] = r["n"]
    plan = coded.sparkSession.sparkContext.broadcast(Plan(hist, window))
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    # One row a part, with less than a window of entries.
    first = first.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("rest", "first"))).alias("firsts"))
    placed = coded.join(first.hint("shuffle_hash"), "part", "left").withColumn("first", F.col("firsts")[F.col("rest")])
    kind = coded.schema["doc_id"].dataType
    order = ["doc_id", "tokens", "sums", "before", "part", "rest", "rank", "tail", "first"]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            ids, rows = batch.column(0), []
            for i, (tokens, sums, before, part, r, rank, tail, start) in enumerate(
                    zip(*(batch.column(c).to_pylist() for c in range(1, 9)), strict=True)):
                for k, s in enumerate(sums):
                    rows.append((i, k * window, window, s, tokens, ((part + 1) << 40) + before + k, 0))
                if r:
                    full = tokens - r
                    for at, size, sequence, offset in p.pieces(r, start + rank):
                        rows.append((i, full + at, size, zlib.crc32(tail[4 * at:4 * (at + size)]), tokens, sequence, offset))
            if rows:
                columns = [np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(columns[0])), *map(pa.array, columns[1:])],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.select(*order).mapInArrow(
        cut, f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long")
