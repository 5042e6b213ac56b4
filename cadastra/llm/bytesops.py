"""numpy kernels over the raw UTF-8 buffers of Arrow string columns.

All text operators that need Python work on these buffers: no Python string is made per document
or word.  A batch is walked in pieces of a few hundred kilobytes, so memory stays bounded by the
largest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
PIECE_BYTES = 1 << 19

#: ASCII white space that ends a word: U+0020 and U+0009..U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = _inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(29))) * U64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> U64(32))


def release() -> None:
    """Give unused memory of Arrow and of the C library back to the system, where it can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not the GNU library
        pass


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another and the n+1 offsets; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, values = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8)[off[0] : off[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes each (one longer document stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def sliced(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of slices and the text that each slice is of.  A text of more than ``limit`` bytes is
    cut at the first white space after every ``limit`` bytes, so no word is cut."""
    long = np.flatnonzero(np.diff(offsets) > limit)
    if not len(long):
        return offsets, np.arange(len(offsets) - 1)
    cuts, owner, done = [], [], 0
    for d in long:
        cuts.append(offsets[done : d + 1])
        owner.append(np.arange(done, d + 1))
        at, end, own = int(offsets[d]), int(offsets[d + 1]), []
        while end - at > limit:
            at = next((a + int(hit[0]) for a in range(at + limit, end, 1 << 16) if len(hit := np.flatnonzero(SPACE[data[a : min(end, a + (1 << 16))]]))), end)
            if at < end:
                own.append(at)
        cuts.append(np.array(own, np.int64))
        owner.append(np.full(len(own), d))
        done = d + 1
    cuts.append(offsets[done:])
    owner.append(np.arange(done, len(offsets) - 1))
    return np.concatenate(cuts), np.concatenate(owner)


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and the n+1 offsets, read slice by slice."""
    cuts, owner = sliced(data, offsets)
    out, n = [], np.zeros(len(offsets) - 1, np.int64)
    for i, j in pieces(cuts):
        part, off = LOWER[data[cuts[i] : cuts[j]]], cuts[i : j + 1] - cuts[i]
        starts, ends, first = word_spans(part, off)
        out.append(word_hashes(part, starts, ends))
        np.add.at(n, owner[i:j], np.diff(first))
    return np.concatenate([np.zeros(0, np.uint64), *out]), np.concatenate(([0], np.cumsum(n)))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, PIECE_BYTES + 1)
        for name, base in (("_powers", _BASE), ("_inverse", _BASE_INV)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            globals()[name] = np.multiply.accumulate(t)
    return _powers, _inverse


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each document the index of its first word (n+1)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    gap = SPACE[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = gap[:-1], gap[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    before[filled] = True
    after[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    starts, ends = np.flatnonzero(before & ~gap), np.flatnonzero(after & ~gap) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, by differences of a running polynomial sum."""
    powers, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside a document, document after document, and the n+1
    offsets.  A document of fewer words, but not none, has one shingle: its whole sequence."""
    n_words = np.diff(first)
    n = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    out_first = np.concatenate(([0], np.cumsum(n)))
    if not len(words):
        return np.zeros(0, np.uint64), out_first
    run = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for i in range(k):
        run += words[i : i + len(run)] * U64(2 * i + 3) * _BASE
        run = (run ^ (run >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    doc = np.repeat(np.arange(len(n)), n)
    place = first[:-1][doc] + (np.arange(out_first[-1]) - out_first[:-1][doc])
    out = np.zeros(out_first[-1], np.uint64)
    full = n_words[doc] >= k
    out[full] = run[place[full]]
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):
        h = np.array([n_words[d]], np.uint64)
        for w in words[first[d] : first[d + 1]]:
            h = mix(h * U64(0x94D049BB133111EB) ^ w)
        out[out_first[d]] = h[0]
    return mix(out), out_first


def count_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of words of each document."""
    cuts, owner = sliced(data, offsets)
    out = np.zeros(len(offsets) - 1, np.int64)
    for i, j in pieces(cuts):
        a, b = cuts[i], cuts[j]
        np.add.at(out, owner[i:j], np.diff(word_spans(data[a:b], cuts[i : j + 1] - a)[2]))
    return out
