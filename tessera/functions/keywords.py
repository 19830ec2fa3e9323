"""Many keywords in one pass: an Aho-Corasick automaton in flat arrays, run over bytes in lanes.

A state's row of the table has its successor for each class of bytes, so a byte is one look-up. A slice of texts is cut
into lanes that are read side by side; each starts as many bytes early as the longest keyword has, after which its state
is what it would be had all before been read. States that end a keyword have the highest numbers.
"""

from __future__ import annotations

import ctypes
import functools
import os
import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import FOLDED

#: Cells of a table: a block of keywords whose states and classes might take more is cut in two.
CELLS = 1 << 24
#: Bytes of text that are read in one go, and lanes they are cut into.
_SLICE, _LANES = 4 << 20, 1 << 13


class Automaton(NamedTuple):
    """classes: of each byte (0: in no keyword). table: where each state and class leads, times the number of classes. ends: the first state that ends a keyword, likewise. first, found: the keywords that each such state ends. size: each keyword's bytes; doubled: whether it can overlap itself."""

    classes: np.ndarray
    n_classes: int
    table: np.ndarray
    ends: int
    first: np.ndarray
    found: np.ndarray
    size: np.ndarray
    doubled: np.ndarray


def _doubled(word: bytes) -> bool:
    return any(word.startswith(word[k:]) for k in range(1, len(word)))


def build(words: list[bytes]) -> Automaton:
    """The automaton of distinct words, none of them empty."""
    if not all(words) or len(set(words)) < len(words):
        raise ValueError("keywords are distinct and not empty")
    used = np.unique(np.frombuffer(b"".join(words), np.uint8)) if words else np.zeros(0, np.uint8)
    classes = np.zeros(256, np.uint8)
    classes[used] = np.arange(1, len(used) + 1)
    n = len(used) + 1
    # A trie, a level at a time: words in order, a new node wherever a prefix isn't the one before it.
    order = sorted(range(len(words)), key=words.__getitem__)
    node = np.zeros(len(words), np.int64)
    levels, last, own = [], 1, np.zeros(len(words), np.int64)
    lengths = np.array([len(words[i]) for i in order], np.int64)
    flat = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
    begin = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    for depth in range(int(lengths.max(initial=0))):
        at = np.flatnonzero(lengths > depth)
        c = classes[flat[begin[at] + depth]].astype(np.int64)
        key = node[at] * n + c
        new = np.concatenate(([True], key[1:] != key[:-1]))
        ids = last + np.cumsum(new) - 1
        levels.append((node[at][new], c[new], ids[new]))
        last = int(ids[-1]) + 1
        node[at] = ids
        done = at[lengths[at] == depth + 1]
        own[done] = node[done]
    if last * n > 8 * CELLS:
        raise ValueError(f"{last} states of {n} classes are too many for one table")
    table, fail = np.zeros((last, n), np.int32), np.zeros(last, np.int64)
    ending = [[] for _ in range(last)] if words else [[]]
    for i, s in zip(order, own.tolist(), strict=True):
        ending[s].append(i)
    for depth, (parent, c, ids) in enumerate(levels):
        if depth:
            fail[ids] = table[fail[parent], c]  # rows of parents' failures are whole by now
        if depth == 0:
            table[0, c] = ids
        else:
            table[parent, c] = ids
        # A node's row is its failure's, but for its children, which the next level puts in.
        table[ids] = table[fail[ids]]
        for s, f in zip(ids.tolist(), fail[ids].tolist(), strict=True):
            if ending[f]:
                ending[s] = ending[s] + ending[f]
    has = np.array([bool(e) for e in ending])
    renamed = np.empty(last, np.int64)
    by = np.concatenate((np.flatnonzero(~has), np.flatnonzero(has)))
    renamed[by] = np.arange(last)
    table = (renamed[table[by]] * n).astype(np.int32)
    lists = [ending[i] for i in np.flatnonzero(has).tolist()]
    first = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    found = np.array([i for x in lists for i in x], np.int32)
    return Automaton(classes, n, table.reshape(-1), int((~has).sum()) * n, first, found, np.array([len(w) for w in words], np.int32), np.array([_doubled(w) for w in words], bool))


def scan(a: Automaton, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, keyword, occurrences without overlaps) of each keyword that a row holds; rows end at offs[1:]."""
    none = np.zeros(0, np.int64)
    if not len(a.size) or not len(buf):
        return none, none, none
    early = int(a.size.max()) - 1
    step = max(256, 4 * early, -(-len(buf) // _LANES))
    lanes = -(-len(buf) // step)
    padded = np.zeros(early + lanes * step, np.uint8)
    padded[early : early + len(buf)] = a.classes[buf]
    side = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded, (lanes, early + step), (step, 1)).T)
    state, at, lane, state_at = np.zeros(lanes, np.int32), [], [], []
    to = np.empty(lanes, np.int32)
    for p in range(early + step):
        np.add(state, side[p], out=to)
        a.table.take(to, out=state, mode="clip")
        if p >= early:
            hit = np.flatnonzero(state >= a.ends)
            if len(hit):
                at.append(np.full(len(hit), p - early))
                lane.append(hit)
                state_at.append(state[hit])
    if not at:
        return none, none, none
    end = np.concatenate(lane) * step + np.concatenate(at) + 1
    which = (np.concatenate(state_at) - a.ends) // a.n_classes
    n = a.first[which + 1] - a.first[which]
    before = np.cumsum(n) - n
    word = a.found[np.repeat(a.first[which] - before, n) + np.arange(int(n.sum()))].astype(np.int64)
    end = np.repeat(end, n)
    row = np.searchsorted(offs[1:], end, "left")
    inside = end - a.size[word] >= offs[row]  # not from the row before
    row, word, end = row[inside], word[inside], end[inside]
    key = row * len(a.size) + word
    twice = a.doubled[word]
    if twice.any():  # of those that may overlap, each that starts before the last one that counts has ended is dropped
        rest = np.flatnonzero(twice)
        rest = rest[np.lexsort((end[rest], key[rest]))]
        keep, held, until = np.ones(len(key), bool), -1, 0
        for i, k, e, size in zip(rest.tolist(), key[rest].tolist(), end[rest].tolist(), a.size[word[rest]].tolist(), strict=True):
            if k == held and e - size < until:
                keep[i] = False
            else:
                held, until = k, e
        key = key[keep]
    key, count = np.unique(key, return_counts=True)
    return key // len(a.size), key % len(a.size), count


_ASCII = np.arange(256, dtype=np.uint8)
_ASCII[65:91] += 32
_GONE, _ODD = np.uint32(0xFFFFFFFF), np.uint32(0xFFFFFFFE)


@functools.cache
def _fold_table() -> np.ndarray:
    """Of each character of the basic plane, in lower case without diacritics: nothing, or what must be looked at with what is around it, or takes several characters, or more bytes."""
    letters, bases = FOLDED
    base = {ord(c): ord(bases[i]) if i < len(bases) else int(_GONE) for i, c in enumerate(letters)}
    out = np.arange(0x10000, dtype=np.uint32)
    for i in range(0x80, 0x10000):
        if 0xD800 <= i < 0xE000:
            continue
        low = chr(i).lower()
        to = base.get(ord(low), ord(low)) if len(low) == 1 and i != 0x3A3 else int(_ODD)
        out[i] = int(_ODD) if to < 0x10000 and len(chr(to).encode()) > len(chr(i).encode()) else to
    return out


def normal_bytes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts in lower case without diacritics, as functions.text.normal has them, and their new ends."""
    out = _ASCII[buf]
    lead = np.flatnonzero(buf >= 0xC0)
    if not len(lead):
        return out, offs
    first = buf[lead].astype(np.uint32)
    wide = np.full(len(lead), 4)
    wide[first < 0xF0], wide[first < 0xE0] = 3, 2
    two, three = lead[wide == 2], lead[wide == 3]
    code = np.zeros(len(lead), np.uint32)
    code[wide == 2] = (buf[two].astype(np.uint32) & 0x1F) << 6 | buf[two + 1] & 0x3F
    code[wide == 3] = (buf[three].astype(np.uint32) & 0xF) << 12 | (buf[three + 1].astype(np.uint32) & 0x3F) << 6 | buf[three + 2] & 0x3F
    to = _fold_table()[code]
    far = {bytes(buf[i : i + 4]).decode() for i in lead[wide == 4].tolist()}
    if (to == _ODD).any() or any(c.lower() != c for c in far):
        return _normal_slowly(buf, offs)
    moved = np.flatnonzero((to != code) & (wide < 4))
    at, was, to = lead[moved], wide[moved], to[moved]
    now = np.where(to == _GONE, 0, 1 + (to > 0x7F) + (to > 0x7FF))
    one, two, three = (np.flatnonzero(now == k) for k in (1, 2, 3))
    out[at[one]] = to[one]
    out[at[two]], out[at[two] + 1] = 0xC0 | to[two] >> 6, 0x80 | to[two] & 0x3F
    out[at[three]], out[at[three] + 1], out[at[three] + 2] = 0xE0 | to[three] >> 12, 0x80 | to[three] >> 6 & 0x3F, 0x80 | to[three] & 0x3F
    less = was - now
    gone = np.repeat(at + now - np.cumsum(less) + less, less) + np.arange(int(less.sum()))
    keep = np.ones(len(buf), bool)
    keep[gone] = False
    return out[keep], offs - np.searchsorted(gone, offs)


def _normal_slowly(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw, (letters, bases) = buf.tobytes(), FOLDED
    table = {ord(c): bases[i] if i < len(bases) else None for i, c in enumerate(letters)}
    parts = [raw[x:y].decode().lower().translate(table).encode() for x, y in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def slices(col: pa.Array):
    """(first row, end row, bytes, row ends) of some MB of texts at a time; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return
    _, ends, data = col.buffers()
    offs = np.frombuffer(ends, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + _SLICE, "right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it


def give_back() -> None:
    """A worker's unused memory goes back to the machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def sums(a: Automaton, weights: np.ndarray, col: pa.Array) -> np.ndarray:
    """Each text's sums over keywords of occurrences times weights (a row a keyword, a column a sum)."""
    out = np.zeros((len(col), weights.shape[1]), np.int64)
    for lo, _, buf, offs in slices(col):
        row, word, n = scan(a, *normal_bytes(buf, offs))
        np.add.at(out, lo + row, n[:, None] * weights[word])
    return out


def sums_column(text: Column, words: list[tuple[int, str, int]], groups: int) -> Column:
    """An array of a sum for each group of (group, keyword, weight), all keywords folded; of a null, zeros."""
    merged = list(dict.fromkeys(w for _, w, _ in words))
    a, weights = build([w.encode() for w in merged]), np.zeros((len(merged), groups), np.int64)
    for g, w, n in words:
        weights[merged.index(w), g] += n

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        out = sums(a, weights, texts)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * groups), pa.array(out.reshape(-1).astype(np.int32)))

    return run(text)


#: Bytes of a gram, and bits of the hashed table of those that texts have (8 MB).
GRAM, GRAMS = 6, 26
#: A shorter keyword is known by its first bytes.
_SHORT = 3


def _grams(buf: np.ndarray, size: int) -> np.ndarray:
    """A cell's number for each run of `size` bytes."""
    n = max(0, len(buf) - size + 1)
    x = np.zeros(n, np.uint64)
    for k in range(size):
        x |= buf[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    x = (x + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - GRAMS)).astype(np.int64)


def seen(col: pa.Array, table: np.ndarray) -> None:
    """Marks in table (a byte a cell) the runs of GRAM and of _SHORT bytes of folded texts; those across two texts too, which does no harm."""
    for _, _, buf, offs in slices(col):
        buf, _ = normal_bytes(buf, offs)
        for a in range(0, len(buf), 1 << 18):  # so that what is computed stays in the cache
            table[_grams(buf[a : a + (1 << 18) + GRAM - 1], GRAM)] = 1
            table[_grams(buf[a : a + (1 << 18) + _SHORT - 1], _SHORT)] = 1


def possible(words: pa.Array, table: np.ndarray) -> np.ndarray:
    """Whether each keyword's runs are all among those seen (bits, packed); True if it is shorter than any run."""
    out = np.ones(len(words), bool)
    for lo, _, buf, offs in slices(words):
        n = np.diff(offs)
        for size, own in ((GRAM, n >= GRAM), (_SHORT, (n >= _SHORT) & (n < GRAM))):
            cell = _grams(buf, size)
            missing = np.concatenate(([0], np.cumsum((table[cell >> 3] >> (cell & 7).astype(np.uint8) & 1) == 0)))
            at = np.flatnonzero(own)
            out[lo + at] = missing[offs[at + 1] - size + 1] == missing[offs[at]]
    return out


class Block(NamedTuple):
    """A part of a dictionary: its automaton, and the (category, weight) entries of each keyword, from first on."""

    automaton: Automaton
    first: np.ndarray
    category: np.ndarray
    weight: np.ndarray
    names: list[str]


def blocks(words: list[str], entries: list[list[tuple[str, int]]], cells: int):
    """Packed blocks of a dictionary's keywords and entries, each of which takes `cells` cells at most; a single keyword may take more."""
    encoded = [w.encode() for w in words]
    classes = len(set(b"".join(encoded))) + 1
    shared = [0, *(len(_common(a, b)) for a, b in zip(encoded, encoded[1:], strict=False))] if words else []
    states, a = 0, 0
    for b in range(len(words) + 1):
        more = len(encoded[b]) - shared[b] if b < len(words) else 0
        if b > a and (b == len(words) or (states + len(encoded[b])) * classes > cells):
            own = entries[a:b]
            names = sorted({c for e in own for c, _ in e})
            codes = {c: i for i, c in enumerate(names)}
            first = np.concatenate(([0], np.cumsum([len(e) for e in own])))
            block = Block(build(encoded[a:b]), first, np.array([codes[c] for e in own for c, _ in e], np.int64), np.array([w for e in own for _, w in e], np.int64), names)
            yield zstandard.ZstdCompressor(level=1).compress(pickle.dumps((tuple(block.automaton), *block[1:]), protocol=5))
            states, a = 0, b
            more = len(encoded[b]) if b < len(words) else 0
        states += more


def opened(content: bytes) -> Block:
    automaton, *rest = pickle.loads(zstandard.decompress(content))
    return Block(Automaton(*automaton), *rest)


def _common(a: bytes, b: bytes) -> bytes:
    return os.path.commonprefix([a, b])


def scores(block: Block, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, category's number, sum) of each category whose sum in a text isn't zero."""
    rows, groups, totals = [], [], []
    for lo, _, buf, offs in slices(col):
        row, word, n = scan(block.automaton, *normal_bytes(buf, offs))
        many = block.first[word + 1] - block.first[word]
        entry = np.repeat(block.first[word] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        key, back = np.unique(np.repeat(lo + row, many) * max(1, len(block.names)) + block.category[entry], return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, back, np.repeat(n, many) * block.weight[entry])
        key, total = key[total != 0], total[total != 0]
        rows.append(key // max(1, len(block.names)))
        groups.append(key % max(1, len(block.names)))
        totals.append(total)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, groups, totals))
