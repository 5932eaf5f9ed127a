"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A file of ranks (base64 token, rank) is turned into the library's model once, on
the driver: every byte stands for one visible character (the byte table), and a
token's merge is the pair that the lower ranks leave of it.  ``encode`` gives ids
with the offsets of every token in code points; a token that holds only part of a
character has that character's offsets.  ``decode`` goes back through the byte
table and joins bytes before any character is read, so characters that are split
between tokens come back whole.

Texts are cut into units where the pattern starts a new match whatever stands
around (``unit_starts``).  A unit is coded once a worker and remembered, so ids and
offsets are those of the whole text, whatever its length.  Null
text counts as empty and has no ids.  Rows, repeated ones and null ids included,
are coded each; other columns are not read.  Empty input gives no rows.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import words as W

BLOCK_BYTES = 1 << 19
MEMO = 250_000            # units that a worker remembers
LEARN = 8192             # units coded in one call

# Bytes that stand for themselves; the others stand for the characters from 256 on, in order.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
BYTE_TO_CHAR = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + k) for k, b in enumerate(_HIDDEN)}
CHAR_TO_BYTE = {c: b for b, c in BYTE_TO_CHAR.items()}


def as_chars(token: bytes) -> str:
    return "".join(BYTE_TO_CHAR[b] for b in token)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that merges of lower rank leave of a token."""
    parts, own = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True)))
        if rank >= own:
            raise ValueError(f"token {token!r} of rank {own} is not made of two tokens of lower rank")
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def definition(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizer as the library's JSON: ranks as vocabulary and merges, the pattern before them."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the ranks hold no token for the bytes {missing[:5]}")
    merges = [[as_chars(p) for p in last_merge(t, ranks)] for t in sorted(ranks, key=ranks.__getitem__) if len(t) > 1]
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
             "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
             "vocab": {as_chars(t): r for t, r in ranks.items()}, "merges": merges}
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    return json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
                       "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, level]},
                       "post_processor": None, "decoder": None, "model": model})


# ASCII letters, digits and the rest, which the pattern never joins; 0: white space and bytes beyond ASCII.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[:128] = 3
_KIND[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_KIND[[*b"0123456789"]] = 2
_KIND[[*b" \t\n\x0b\x0c\r"]] = 0


def unit_starts(buf: np.ndarray) -> np.ndarray:
    """Whether a match of the pattern surely starts at each byte.

    It does at ASCII white space after anything but white space, and between an ASCII letter,
    digit or other sign and one of another kind, but for letters after an apostrophe.
    """
    before = np.concatenate((np.full(3, 0x20, dtype=np.uint8), buf))
    c1, c2, c3 = before[2:-1], before[1:-2], before[:-3]          # the bytes one, two and three places before
    wide = (c3 == 0xE2) & (((c2 == 0x80) & ((c1 <= 0x8A) | (c1 == 0xA8) | (c1 == 0xA9) | (c1 == 0xAF))) | ((c2 == 0x81) & (c1 == 0x9F)))
    wide |= ((c3 == 0xE1) & (c2 == 0x9A) & (c1 == 0x80)) | ((c3 == 0xE3) & (c2 == 0x80) & (c1 == 0x80))
    wide |= (c2 == 0xC2) & ((c1 == 0x85) | (c1 == 0xA0))
    space = W.WHITE[buf] & ~W.WHITE[c1] & ~wide
    own, last = _KIND[buf], _KIND[c1]
    return space | ((own != last) & (own > 0) & (last > 0) & ~((c1 == 0x27) & (own == 1)))


class Decoder:
    """Bytes of every id, from the definition's vocabulary by the reversed byte table."""

    def __init__(self, text: str):
        vocab = json.loads(text)["model"]["vocab"]
        tokens = [b""] * (max(vocab.values()) + 1)
        self.known = np.zeros(len(tokens), dtype=bool)
        for name, i in vocab.items():
            tokens[i] = bytes(CHAR_TO_BYTE[c] for c in name)
            self.known[i] = True
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; an id outside the vocabulary is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.sizes[ids]
        upto = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)
        return self.bytes[at].tobytes()


class Coder:
    """Encoder of one definition, as a worker holds it.

    A unit, from one sure start of a match to the next, has the same tokens wherever
    it stands, so it is coded once and remembered (at most ``MEMO`` units).
    """

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark runs one task a core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(text)
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.flat, self.used = np.zeros((1 << 16, 3), dtype=np.int32), 0         # id, start, end
        self.first, self.count = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def _coded(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """((tokens, 3) ids and offsets in code points, number of tokens per unit)."""
        coded = self.tokenizer.encode_batch([u.decode() for u in units], add_special_tokens=False)
        counts = np.array([len(e.ids) for e in coded], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(e.ids for e in coded), dtype=np.int32, count=int(counts.sum()))
        offsets = np.array([o for e in coded for o in e.offsets], dtype=np.int32).reshape(-1, 2)
        return np.concatenate((ids[:, None], offsets), axis=1), counts

    def _coded_at_once(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for units that end in no white space, coded as one text.

        A match starts at white space after such a unit; a unit that does not start with
        white space gets a line feed before it, which is a match, and a token, of its own.
        """
        lead = np.array([not u[0].isspace() for u in units])
        sizes = np.array([len(u) for u in units]) + lead
        text = "".join("\n" + u if alone else u for u, alone in zip(units, lead.tolist(), strict=True))
        coded = self.tokenizer.encode_batch([text], add_special_tokens=False)[0]
        rows = np.empty((len(coded.ids), 3), dtype=np.int64)
        rows[:, 0] = coded.ids
        rows[:, 1:] = np.fromiter(chain.from_iterable(coded.offsets), dtype=np.int64, count=2 * len(rows)).reshape(-1, 2)
        ends = np.cumsum(sizes)
        own = np.searchsorted(ends, rows[:, 1], side="right")
        rows[:, 1:] -= (ends - sizes + lead)[own][:, None]
        own, rows = own[rows[:, 1] >= 0], rows[rows[:, 1] >= 0]
        return rows, np.bincount(own, minlength=len(units))

    def _learn(self, units: list[bytes]) -> None:
        joined = [not u.decode()[-1].isspace() for u in units]
        some = [u for u, j in zip(units, joined, strict=True) if j]
        for lo in range(0, len(some), LEARN):
            self._keep(some[lo:lo + LEARN], *self._coded_at_once([u.decode() for u in some[lo:lo + LEARN]]))
        rest = [u for u, j in zip(units, joined, strict=True) if not j]
        if rest:
            self._keep(rest, *self._coded(rest))

    def _keep(self, units: list[bytes], rows: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.memo)
        while self.used + len(rows) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while n + len(units) > len(self.first):
            self.first, self.count = (np.concatenate((x, np.zeros_like(x))) for x in (self.first, self.count))
        self.flat[self.used:self.used + len(rows)] = rows
        self.first[n:n + len(units)] = self.used + np.cumsum(counts) - counts
        self.count[n:n + len(units)] = counts
        self.memo.update(zip(units, range(n, n + len(units)), strict=True))
        self.used += len(rows)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, (tokens, 2) offsets, bounds): the tokens of text i are ids[bounds[i]:bounds[i + 1]]."""
        if len(self.memo) > MEMO:
            self._forget()
        parts = [(i, at, part) for i, t in enumerate(texts) for at, part in cuts(t)]
        found, counts = [np.empty((0, 3), dtype=np.int64)], np.zeros(len(texts) + 1, dtype=np.int64)
        for lo, hi in _batches([len(p) for _, _, p in parts]):
            rows, sizes = self._buffer([p for _, _, p in parts[lo:hi]])
            rows[:, 1:] += np.repeat(np.array([at for _, at, _ in parts[lo:hi]]), sizes)[:, None]
            found.append(rows)
            np.add.at(counts, [i + 1 for i, _, _ in parts[lo:hi]], sizes)
        every = np.concatenate(found)
        return every[:, 0].astype(np.int32), every[:, 1:], np.cumsum(counts)

    def _buffer(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """((tokens, 3) ids and offsets within the part, number of tokens per part)."""
        raw = b"".join(parts)
        if len(raw) > W.CHUNK:               # one part, and in it one unit, beyond a buffer
            rows, counts = self._coded(parts)
            return rows.astype(np.int64), counts
        buf = np.frombuffer(raw, dtype=np.uint8)
        part_ends = np.cumsum([len(p) for p in parts])
        part_starts = part_ends - [len(p) for p in parts]
        marks = unit_starts(buf)
        marks[part_starts[part_starts < part_ends]] = True
        starts = np.flatnonzero(marks)
        ends = np.append(starts[1:], len(buf)) if len(starts) else starts
        _, first, at = np.unique(W.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        units = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        new = [u for u in units if u not in self.memo]
        if new:
            self._learn(new)
        own = np.fromiter(map(self.memo.__getitem__, units), dtype=np.int64, count=len(units))[at]
        sizes = self.count[own]
        upto = np.cumsum(sizes)
        rows = self.flat[np.repeat(self.first[own] - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)].astype(np.int64)
        chars = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
        part = np.searchsorted(part_ends, starts, side="right")
        rows[:, 1:] += np.repeat(chars[starts] - chars[part_starts[part]], sizes)[:, None]
        return rows, np.bincount(part, weights=sizes, minlength=len(parts)).astype(np.int64)


def cuts(text: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset in code points, part) of a text in parts of at most BLOCK_BYTES, or of one longer unit."""
    if len(text) <= BLOCK_BYTES:
        yield 0, text
        return
    at, chars = 0, 0
    starts = np.flatnonzero(unit_starts(np.frombuffer(text, dtype=np.uint8)))
    while at < len(text):
        near = np.searchsorted(starts, at + BLOCK_BYTES, side="right") - 1
        if near < 0 or starts[near] <= at:          # the unit that starts here is longer
            near += 1
        end = int(starts[near]) if near < len(starts) and len(text) - at > BLOCK_BYTES else len(text)
        part = text[at:end]
        yield chars, part
        chars += len(part.decode())
        at = end


def _batches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about BLOCK_BYTES bytes."""
    lo, size = 0, 0
    for hi, n in enumerate(sizes):
        if hi > lo and size + n > BLOCK_BYTES:
            yield lo, hi
            lo, size = hi, 0
        size += n
    if lo < len(sizes):
        yield lo, len(sizes)


_held: dict[tuple, object] = {}


def _kept(kind: type, text: str):
    """The coder or decoder of a definition; a worker that is reused keeps it."""
    key = kind, zlib.crc32(text.encode())
    if key not in _held:
        _held[key] = kind(text)
    return _held[key]


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, tokenizer: str, *, round_trip: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids, starts and ends (of each token, in code points), split_tokens.

    ``tokenizer`` is a ``definition``.  ``split_tokens`` counts tokens that share a character with the token before.
    With ``round_trip`` also packed (the ids as token files have them, see ``little_endian``) and decoded (the bytes
    that ``decode`` gives for the ids), made in the same pass, block by block.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(tokenizer)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "ids", "starts", "ends", "split_tokens", *(["packed", "decoded"] if round_trip else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _kept(Coder, held.value)
        for block in W.blocks(batches, "text", BLOCK_BYTES):
            texts = [t.decode("utf-8", "replace").encode() for t in W.utf8(block.column("text"))]      # valid from here on
            ids, offsets, bounds = coder.encode(texts)
            # A text starts at 0 and a whole character ends before the next starts.
            shared = np.concatenate(([False], offsets[1:, 0] < offsets[:-1, 1])) if len(ids) else np.zeros(0, dtype=bool)
            shared[bounds[:-1][bounds[:-1] < len(ids)]] = False
            upto = np.concatenate(([0], np.cumsum(shared)))
            columns = [block.column("doc_id"), _lists(bounds, ids), _lists(bounds, offsets[:, 0]), _lists(bounds, offsets[:, 1]),
                       pa.array(np.diff(upto[bounds]))]
            if round_trip:
                own = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                decoder = _kept(Decoder, held.value)
                columns += [pa.array([_packed(x) for x in own], pa.binary()), pa.array([decoder.decode(x) for x in own], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    extra = ", packed binary, decoded binary" if round_trip else ""
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>, split_tokens long{extra}")


def decode(coded: DataFrame, tokenizer: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``coded`` with the bytes of its ids as ``out_col`` (null ids give none)."""
    held = coded.sparkSession.sparkContext.broadcast(tokenizer)

    @F.arrow_udf(T.BinaryType())
    def run(column: pa.Array) -> pa.Array:
        decoder = _kept(Decoder, held.value)
        return pa.array([decoder.decode(_numbers(x)) for x in column], pa.binary())

    return coded.withColumn(out_col, run(F.col(ids_col)))


def _numbers(ids: pa.ListScalar) -> np.ndarray:
    return ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.empty(0, dtype=np.int32)


def _packed(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


@F.arrow_udf(T.BinaryType())
def little_endian(column: pa.Array) -> pa.Array:
    """Ids as little-endian unsigned 32-bit integers, the form that token files have."""
    return pa.array([_packed(_numbers(x)) for x in column], pa.binary())
