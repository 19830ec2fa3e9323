"""Vectorised byte-level text kernels on Arrow string columns.

Texts are handled as one UTF-8 buffer with offsets, cut into slices of a few MB, so the memory of a task
depends on the slice and on its longest single text, never on the number of rows.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE = 4 << 20
_BLOCK = 1 << 17
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
_STEP = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); a bijection, so equal results mean equal inputs."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, tag: int) -> np.ndarray:
    """n odd 64-bit constants that depend on tag alone."""
    return mix(np.arange(1, n + 1, dtype=U) * _STEP + U(tag)) | U(1)


#: Places in a span that have codes of their own; a longer span is hashed by pieces of so many bytes.
LANE = 32
#: A code for each place and byte; the second table gives A-Z the codes of a-z.
EXACT = mix(np.arange(1, LANE * 256 + 1, dtype=U) * _STEP + U(11))
FOLDED = EXACT.reshape(LANE, 256).copy()
FOLDED[:, 65:91] = FOLDED[:, 97:123]
FOLDED = FOLDED.reshape(-1)

#: Bytes of words between ASCII white space, and of words of digits, letters and non-ASCII characters.
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[10] = False


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def released(run):
    """run, a function of batches; once a task's rows are through, its worker gives back to the machine what it doesn't hold any more."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def slices(col, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them), some MB at a time; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, ends, data = col.buffers()
    offs = np.frombuffer(ends, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def spans(buf: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in `inside` that stay in one row, and each row's first run (one more at the end)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    m = inside[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offs] = True
    left, right = m.copy(), m.copy()
    left[1:] &= ~m[:-1] | cut[1:-1]
    right[:-1] &= ~m[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(left), np.flatnonzero(right) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _sums(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of LANE bytes at most: the sum of the codes of its bytes in their places, mixed with its length."""
    out = np.empty(len(starts), U)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _BLOCK, "right")))
        base = starts[a]
        s, e = starts[a:b] - base, ends[a:b] - base
        size = int(e[-1])
        place = np.arange(size, dtype=np.uint16)  # wraps around, which places modulo LANE don't notice
        place -= np.repeat(s.astype(np.uint16), np.diff(np.append(s, size)))
        place &= np.uint16(LANE - 1)
        place <<= np.uint16(8)
        place |= buf[base : base + size]
        total = np.empty(size + 1, U)
        total[0] = 0
        np.cumsum(codes.take(place), out=total[1:])
        out[a:b] = total[e] - total[s]
        a = b
    out += (ends - starts).astype(U) * _STEP
    return mix(out)


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = EXACT) -> np.ndarray:
    """A 64-bit hash of each span (spans ascend, aren't empty and don't overlap): tabulated by byte and place, so structure in the bytes makes no collisions; two given spans collide with odds of about 2**-64."""
    n = ends - starts
    parts = (n + LANE - 1) // LANE
    if not len(n) or parts.max() == 1:
        return _sums(buf, starts, ends, codes)
    first = np.concatenate(([0], np.cumsum(parts)))
    inner = np.arange(first[-1]) - np.repeat(first[:-1], parts)
    s = np.repeat(starts, parts) + inner * LANE
    h = _sums(buf, s, np.minimum(s + LANE, np.repeat(ends, parts)), codes)
    out = h[first[:-1]]
    long = np.flatnonzero(parts > 1)
    at = gather(first[long], parts[long])
    own = mix(h[at] + inner[at].astype(U) * _SHINGLE[0])
    out[long] = mix(np.add.reduceat(own, np.cumsum(parts[long]) - parts[long]) + n[long].astype(U) * _STEP)
    return out


_SHINGLE = seeds(64, 23)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row's k-word shingles (of all its words, if fewer), and each row's first one (one more at the end)."""
    n = len(first) - 1
    s = np.zeros(0, U)
    if len(h) >= k:
        s = h[: len(h) - k + 1] * _SHINGLE[0]
        for j in range(1, k):
            s += h[j : len(h) - k + 1 + j] * _SHINGLE[j]
        s = mix(s)
    out, ends = [], np.zeros(n + 1, np.int64)
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            x = np.sort(s[a : b - k + 1])
            x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        elif b > a:
            x = mix(np.array([(h[a:b] * _SHINGLE[: b - a]).sum() + U(b - a)], U))
        else:
            x = h[:0]
        out.append(x)
        ends[i + 1] = ends[i] + len(x)
    return (np.concatenate(out) if out else s[:0]), ends


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... for each (start, count), one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)


def strings(parts: list[bytes]) -> pa.Array:
    offs = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offs[1:])
    return pa.StringArray.from_buffers(len(parts), pa.py_buffer(offs), pa.py_buffer(b"".join(parts)))
