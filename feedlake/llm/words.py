"""Words and word n-grams of many texts at once, as 64-bit hashes (numpy).

Texts are UTF-8 bytes.  A word's hash is a polynomial over random per-byte
values, taken from running sums over a whole buffer, so no Python object is made
per word; an n-gram's hash combines the hashes of its words.  All constants are
drawn from a fixed seed, so hashes agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_draw = np.random.default_rng(20250218)
_BYTE = _draw.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_draw.integers(1, 1 << 62)) * 2 + 1
_BACK = pow(_BASE, -1, 1 << 64)
_GRAM = _draw.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 1 << 20                 # bytes hashed at a time


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, CHUNK + 1), _powers(_BACK, CHUNK + 1)

# Word separators: white space (space and 0x09-0x0D) ...
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
# ... or all ASCII but letters and digits.
_PUNCT = np.ones(256, dtype=bool)
_PUNCT[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]] = False
WHITE, ALNUM = _SPACE, _PUNCT


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 | 1)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hash_buffer(buf: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, start offsets) of the words of a buffer that is at most CHUNK bytes long."""
    starts, ends = word_spans(buf, separators)
    return span_hashes(buf, starts, ends), starts


def word_spans(buf: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of a buffer."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], separators[buf], [True]))))
    return edge[::2], edge[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of a buffer that is at most CHUNK bytes long."""
    run = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * _UP[:len(buf)], out=run[1:])
    return mix((run[ends] - run[starts]) * _DOWN[starts])


def _long_word(buf: bytes) -> np.uint64:
    """The hash of one word of any length, as _hash_buffer gives it."""
    a, total, shift = np.frombuffer(buf, dtype=np.uint8), 0, 1
    for k in range(0, len(a), CHUNK):
        part = a[k:k + CHUNK]
        total = (total + shift * int(np.sum(_BYTE[part] * _UP[:len(part)], dtype=np.uint64))) % (1 << 64)
        shift = shift * pow(_BASE, CHUNK, 1 << 64) % (1 << 64)
    return mix(np.array([total], dtype=np.uint64))[0]


def _one(text: bytes, separators: np.ndarray) -> np.ndarray:
    """Word hashes of a text of any length, cut only at separators."""
    if len(text) <= CHUNK:
        return _hash_buffer(np.frombuffer(text, dtype=np.uint8), separators)[0]
    a, out, at = np.frombuffer(text, dtype=np.uint8), [], 0
    while at < len(a):
        end = min(at + CHUNK, len(a))
        if end < len(a):
            gaps = np.flatnonzero(separators[a[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:                       # one word over a whole chunk
                rest = np.flatnonzero(separators[a[end:]])
                end = end + int(rest[0]) if len(rest) else len(a)
                out.append(np.array([_long_word(text[at:end])], dtype=np.uint64))
                at = end
                continue
        out.append(_hash_buffer(a[at:end], separators)[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def word_hashes(texts: list[bytes], separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, bounds): words of text i are hashes[bounds[i]:bounds[i + 1]]."""
    hashes, counts = [], []
    i = 0
    while i < len(texts):
        if len(texts[i]) >= CHUNK:
            h = _one(texts[i], separators)
            hashes.append(h)
            counts.append([len(h)])
            i += 1
            continue
        size, j = 0, i
        while j < len(texts) and size + len(texts[j]) + 1 <= CHUNK:
            size += len(texts[j]) + 1
            j += 1
        buf = b" ".join(texts[i:j])
        h, starts = _hash_buffer(np.frombuffer(buf, dtype=np.uint8), separators)
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
        hashes.append(h)
        counts.append(np.diff(np.searchsorted(starts, ends), prepend=0))
        i = j
    every = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
    bounds = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1)
    return every, bounds.astype(np.int64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n consecutive words from each position on (len(words) - n + 1 values)."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    size = len(words) - n + 1
    total = words[:size] * _GRAM[0]
    for k in range(1, n):
        total += words[k:k + size] * _GRAM[k]
    return mix(total)


def blocks(batches: Iterable[pa.RecordBatch], text_col: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices with about ``size`` bytes of text; a longer text stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // size)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8, null as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]
