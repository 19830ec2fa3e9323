"""Byte-level BPE: encoding with a local rank or tokenizer file, and decoding to raw bytes.

A text is first cut at safe boundaries: before ASCII white space that follows a character which is neither white
space nor might be. No match of the pre-splitting pattern crosses such a place (white space only ever joins what
follows it, and looks no further than the next character), so the pieces' ids, one after another, are the text's ids.
Pieces repeat a lot, so each worker encodes a distinct piece once; texts of any length take memory by the slice.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text as tx

#: Distinct pieces, and their bytes, that a worker remembers before it forgets those that the texts at hand don't repeat.
CACHE_PIECES, CACHE_BYTES = 300_000, 32 << 20
_SLICE = 2 << 20


def pieces(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces between safe boundaries, each row's first (one more at the end), and which pieces begin and end at a safe boundary."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64), np.zeros(0, bool)
    space = ~tx.SOLID[buf]
    firm = buf > 32  # how a piece may end; not the last byte of anything that could be non-ASCII white space
    firm[1:] &= ~((buf[:-1] == 0xC2) & ((buf[1:] == 0x85) | (buf[1:] == 0xA0)))
    if n > 2:
        firm[2:] &= ~((buf[:-2] >= 0xE1) & (buf[:-2] <= 0xE3) & ((buf[1:-1] == 0x9A) | (buf[1:-1] == 0x80) | (buf[1:-1] == 0x81)))
    begin = np.zeros(n + 1, bool)
    begin[1:-1] = space[1:] & firm[:-1]
    begin[offs[:-1]] = True
    begin[n] = False
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(starts, offs), space[starts] & firm[ends - 1]


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes, where each stands first, and which of them each is."""
    n = len(h)
    low = tx.U((1 << max(1, n - 1).bit_length()) - 1)
    key = np.sort(h & ~low | np.arange(n, dtype=tx.U))  # many times as fast as an order of the hashes; their low bits are looked at below
    place = (key & low).astype(np.int64)
    h = h[place]
    new = np.concatenate(([True], (key[1:] ^ key[:-1]) > low))
    if not np.array_equal(new[1:], h[1:] != h[:-1]):
        by = np.argsort(h, kind="stable")
        place, h = place[by], h[by]
        new = np.concatenate(([True], h[1:] != h[:-1]))
    back = np.empty(n, np.int64)
    back[place] = np.cumsum(new) - 1
    return h[new], place[new], back


class Encoder:
    """Ids of pieces, remembered by hash. `encode` gives the ids of one text, `widths` the bytes of each id; each occurrence of one of `added` becomes its id, and texts are cut there before anything else."""

    def __init__(self, encode, widths: np.ndarray, added: dict[bytes, int] | None = None):
        self.encode, self.widths, self.added = encode, widths, added or {}
        # Leftmost first, of those the longest, as the library finds them.
        self.literal = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.reset()

    def reset(self) -> None:
        self.known: dict[int, int] = {}
        self.ids, self.at = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64)
        self.n = self.bytes = 0  # at[:n + 1] are the starts in ids

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        end = self.at[self.n]
        while end + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.n + len(counts) + 1 > len(self.at):
            self.at = np.concatenate((self.at, np.zeros_like(self.at)))
        self.ids[end : end + len(ids)] = ids
        self.at[self.n + 1 : self.n + 1 + len(counts)] = end + np.cumsum(counts)
        self.n += len(counts)

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, one after another, and the number of each row's."""
        raw = buf.tobytes() if self.literal else b""
        if not self.literal or not self.literal.search(raw):
            return self._pieced(buf, offs)
        spots = []
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            own = [(m.start(), m.end(), self.added[m[0]]) for m in self.literal.finditer(raw[a:b])]
            spots += [(a + s, a + e, i) for s, e, i in own]
        # The stretches between occurrences are rows of their own; an occurrence is one without ids to which its id is given.
        gone = np.array(spots, np.int64).reshape(-1, 3)
        keep = np.ones(len(buf), bool)
        keep[tx.gather(gone[:, 0], gone[:, 1] - gone[:, 0])] = False
        left = np.concatenate(([0], np.cumsum(keep)))
        edges = np.concatenate((offs[:-1], gone[:, 1]))
        kind = np.concatenate((np.full(len(offs) - 1, -1), gone[:, 2]))
        row = np.concatenate((np.arange(len(offs) - 1), np.searchsorted(offs, gone[:, 0], "right") - 1))
        by = np.lexsort((edges, row))  # stable: a row's own start comes before an occurrence
        kind, row = kind[by], row[by]
        ids, n = self._pieced(buf[keep], np.append(left[edges[by]], left[-1]))
        at = np.concatenate(([0], np.cumsum(n)))[:-1][kind >= 0]
        ids = np.insert(ids, at, kind[kind >= 0].astype(ids.dtype))
        return ids, np.bincount(row, weights=n + (kind >= 0), minlength=len(offs) - 1).astype(np.int64)

    def _pieced(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, first, plain = pieces(buf, offs)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
        kinds, one, back = _distinct(tx.hashes(buf, starts, ends))
        place = np.array([self.known.get(h, -1) for h in kinds.tolist()], np.int64)
        if self.n > CACHE_PIECES or self.bytes > CACHE_BYTES:
            old = np.flatnonzero(place >= 0)
            counts = self.at[place[old] + 1] - self.at[place[old]]
            ids = self.ids[tx.gather(self.at[place[old]], counts)]
            self.reset()
            self._add(ids, counts)
            place[old] = np.arange(len(old))
            self.known = dict(zip(kinds[old].tolist(), place[old].tolist(), strict=True))
            self.bytes = int((ends - starts)[one[old]].sum())
        new = np.flatnonzero(place < 0)
        if len(new):
            # Plain pieces start with white space and end without: side by side, they're still cut apart.
            many, few = new[plain[one[new]]], new[~plain[one[new]]]
            s, size = starts[one[many]], (ends - starts)[one[many]]
            text = buf[tx.gather(s, size)].tobytes()
            ids = np.asarray(self.encode(text.decode()), np.int32) if text else np.zeros(0, np.int32)
            edges = np.concatenate(([0], np.cumsum(self.widths[ids])))
            cuts = np.searchsorted(edges, np.concatenate(([0], np.cumsum(size))))
            if edges[-1] != len(text) or not np.array_equal(edges[cuts], np.concatenate(([0], np.cumsum(size)))):
                raise ValueError("a token crosses a safe boundary")
            place[many] = self.n + np.arange(len(many))
            self._add(ids, np.diff(cuts))
            for k in few.tolist():
                own = np.asarray(self.encode(buf[starts[one[k]] : ends[one[k]]].tobytes().decode()), np.int32)
                place[k] = self.n
                self._add(own, np.array([len(own)]))
            self.known.update(zip(kinds[new].tolist(), place[new].tolist(), strict=True))
            self.bytes += int((ends - starts)[one[new]].sum())
        place = place[back]
        counts = (self.at[1:] - self.at[:-1])[place] if self.n + 1 == len(self.at) else (self.at[1 : self.n + 1] - self.at[: self.n])[place]
        ids = self.ids[tx.gather(self.at[place], counts)]
        total = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(total[first])


_loaded: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def tiktoken_encoder(path: str, pattern: str) -> tuple[Encoder, list[bytes]]:
    """The worker's encoder of a rank file, and the bytes of each id."""
    key = ("ranks", path, pattern)
    if key not in _loaded:
        import tiktoken

        ranks = load_ranks(path)
        enc = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        words = [b""] * (max(ranks.values()) + 1)
        for w, i in ranks.items():
            words[i] = w
        _loaded[key] = Encoder(enc.encode_ordinary, np.array([len(w) for w in words])), words
    return _loaded[key]


def tokenizer_encoder(path: str, recognise: bool = False) -> Encoder:
    """The worker's encoder of a tokenizers file with a byte-level vocabulary; recognise: the file's added tokens become their ids, as is the library's default, instead of text like any other."""
    key = ("file", path, recognise)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        widths = np.zeros(tok.get_vocab_size(), np.int64)
        for w, i in tok.get_vocab().items():
            widths[i] = len(w)  # one character of a byte-level vocabulary stands for one byte
        added = {}
        if recognise:
            with open(path, encoding="utf-8") as f:
                tokens = json.load(f).get("added_tokens") or []
            if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["special"] for t in tokens):
                raise ValueError("an added token isn't found by its bytes alone")
            added = {t["content"].encode(): t["id"] for t in tokens}
        _loaded[key] = Encoder(lambda text: tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, widths, added)
    return _loaded[key]


def decode(ids: np.ndarray, table: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The bytes of ids, as they are: token boundaries may lie within a character."""
    return table[tx.gather(starts[ids], (starts[1:] - starts[:-1])[ids])]


def _round(path: str, pattern: str, digest: bool, keep: tuple[str, ...] = ()):
    def run(batches):
        encoder, words = tiktoken_encoder(path, pattern)
        starts = np.concatenate(([0], np.cumsum([len(w) for w in words])))
        table = np.frombuffer(b"".join(words), np.uint8)
        text = np.array([f"{i}," for i in range(len(words))], "S").view(np.uint8).reshape(len(words), -1)
        digits = (text != 0).sum(1)
        at = np.concatenate(([0], np.cumsum(digits)))
        flat = text[text != 0]
        for batch in batches:
            for lo, hi, buf, offs in tx.slices(batch.column(1), _SLICE):
                ids, n = encoder(buf, offs)
                ends = np.concatenate(([0], np.cumsum(n)))
                raw = decode(ids, table, starts)
                if len(raw) != len(buf) or not np.array_equal(raw, buf):
                    raise ValueError("decoding doesn't give back the texts")
                cols = [batch.column(0).slice(lo, hi - lo), pa.array(n)]
                if digest:
                    joined = flat[tx.gather(at[ids], digits[ids])]
                    marks = np.concatenate(([0], np.cumsum(digits[ids])))[ends]
                    cols.append(pa.array([hashlib.sha256(joined[a : max(a, b - 1)]).hexdigest() for a, b in zip(marks[:-1], marks[1:], strict=True)]))
                    width = np.concatenate(([0], np.cumsum(encoder.widths[ids])))[ends]
                    cols.append(pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(width[:-1], width[1:], strict=True)]))
                else:
                    cols.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)))
                    width = np.concatenate(([0], np.cumsum(encoder.widths[ids])))[ends]
                    raw = raw.tobytes()
                    cols.append(tx.strings([raw[a:b] for a, b in zip(width[:-1].tolist(), width[1:].tolist(), strict=True)]))
                cols += [batch.column(2 + i).slice(lo, hi - lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")), *keep])

    return tx.released(run)


def _select(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs, docs.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids (array of int), without special tokens, decoded (the text that the ids' bytes make), and the columns in keep (names without dots, other than these).

    A null text is an empty one, with no ids; ids of rows may be null or repeat; other columns are ignored. Every
    slice is decoded again and must give back its bytes.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    fields = [T.StructField("doc_id", own.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return own.mapInArrow(_round(path, pattern, False, keep), T.StructType([*fields, *(own.schema[c] for c in keep)]))


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode() and decode_ids() in one pass: doc_id, n_tokens, ids_sha256 (of the comma-joined ids), decoded_sha256 (of the decoded bytes)."""
    docs, kind = _select(docs, id_col, text_col)
    return docs.mapInArrow(_round(path, pattern, True), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _bytes(path: str, pattern: str):
    def run(batches):
        _, words = tiktoken_encoder(path, pattern)
        for batch in batches:
            rows = (b"".join(map(words.__getitem__, ids or ())) for ids in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(rows), pa.binary())], ["doc_id", "content"])

    return tx.released(run)


def decode_ids(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, content (binary): the raw bytes of each row's ids; nulls and empty lists give no bytes. An id beyond the vocabulary is an error."""
    encoded = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return encoded.mapInArrow(_bytes(path, pattern), f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, content binary")
