"""Benchmark decontamination by a generalised suffix automaton over the words of normalised test items.

Every training text is streamed through the automaton, which tracks the length of the longest suffix read so far
that occurs in some item. A window is `window` consecutive words of an item, or a whole shorter item.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import cut

U = np.uint64
#: Bytes of item text in one automaton, which the driver builds from dictionaries (some 600 bytes a word) and packs into arrays (some 60); automata that a pass over the documents holds at once. A larger benchmark takes several passes.
BLOCK_BYTES, GROUP = 2 << 20, 4


class Automaton:
    """Generalised suffix automaton over integer words, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items = [i for i, _ in items]
        for _, words in items:
            last = 0
            for w in words.tolist():
                last = self._extend(last, w)
        # States of full windows, and of short items by length, with their items.
        full, short = defaultdict(list), defaultdict(lambda: defaultdict(list))
        pairs, singles = set(), set()
        for k, (_, words) in enumerate(items):
            words = words.tolist()
            singles.update(words)
            pairs.update(zip(words, words[1:], strict=False))
            if len(words) >= window:
                for s in self._windows(words):
                    if not full[s] or full[s][-1] != k:
                        full[s].append(k)
            elif words:
                s = 0
                for w in words:
                    s = self.next[s][w]
                short[s][len(words)].append(k)
        self.least = min([min(len(w), window) for _, w in items if len(w)], default=0)
        self.words = np.sort(np.array(sorted(singles), U)) if singles else np.zeros(0, U)
        self.pairs = np.sort(_pair(np.array([p for p, _ in pairs], U), np.array([q for _, q in pairs], U)))
        self._pack(full, short)

    def _pack(self, full, short) -> None:
        """Arrays instead of dictionaries: transitions by state and word, items by state, and for each state the nearest one on its chain of suffixes where short items end."""
        n = len(self.next)
        state = np.repeat(np.arange(n), [len(x) for x in self.next])
        word = np.fromiter((w for x in self.next for w in x), U, len(state))
        to = np.fromiter((t for x in self.next for t in x.values()), np.int32, len(state))
        del self.next
        key = _step(state.astype(U), word)
        by = np.argsort(key)
        self.keys, self.to = key[by], to[by]
        self.link, self.length = np.array(self.link, np.int32), np.array(self.length, np.int32)
        self.ends = np.array(sorted(full), np.int32)  # states of full windows, and where each one's items begin
        self.at = np.concatenate(([0], np.cumsum([len(full[s]) for s in self.ends.tolist()]))).astype(np.int32)
        self.own = np.fromiter((k for s in self.ends.tolist() for k in full[s]), np.int32, self.at[-1])
        self.short = {s: [(size, np.array(x, np.int32)) for size, x in sorted(own.items())] for s, own in short.items()}
        self.near = np.full(n, -1, np.int32)
        for s in np.argsort(self.length, kind="stable").tolist():
            self.near[s] = s if s in self.short else self.near[self.link[s]] if s else -1

    def _go(self, s: int, w: int) -> int:
        """The state after a word, or -1."""
        key = _step(np.array([s], U), np.array([w], U))[0]
        at = int(np.searchsorted(self.keys, key))
        return int(self.to[at]) if at < len(self.keys) and self.keys[at] == key else -1

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = c
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _windows(self, words: list[int]):
        """While building: the state of each full window of an item."""
        s, nxt, link, length, window = 0, self.next, self.link, self.length, self.window
        for i, w in enumerate(words):
            s = nxt[s][w]
            if i + 1 >= window:
                while length[link[s]] >= window:
                    s = link[s]
                yield s

    def _walk(self, words: list[int]):
        """For each word read: the state of the last full window (or None), and the state and length of the longest match."""
        s, n = 0, 0
        link, length, window = self.link, self.length, self.window
        for w in words:
            t = self._go(s, w)
            while s and t < 0:
                s = int(link[s])
                n = int(length[s])
                t = self._go(s, w)
            if t >= 0:
                s, n = t, n + 1
            at = None
            if n >= window:
                at = s
                while length[link[at]] >= window:
                    at = int(link[at])
            yield at, (s, n)

    def hits(self, words: list[int]) -> tuple[np.ndarray, set[int]]:
        """Which words lie in an occurrence of a window, and the items of those windows."""
        hit, found = np.zeros(len(words), bool), set()
        for i, (at, (s, n)) in enumerate(self._walk(words)):
            if at is not None:
                hit[i + 1 - self.window : i + 1] = True
                k = int(np.searchsorted(self.ends, at))
                found.update(self.own[self.at[k] : self.at[k + 1]].tolist())
            s = int(self.near[s])
            while s > 0:
                for size, own in self.short[s]:
                    if size <= n:
                        hit[i + 1 - size : i + 1] = True
                        found.update(own.tolist())
                s = int(self.near[self.link[s]])
        return hit, found

    def scan(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """hits() for each row of word hashes. Stretches without a word pair (or word) of an item can't match and aren't streamed."""
        hit, found = np.zeros(len(h), bool), defaultdict(set)
        if not self.least or not len(h):
            return hit, found
        known = _member(h, self.words)
        joined = np.zeros(len(h), bool)  # this word and the one before form a pair of some item
        joined[1:] = known[1:] & known[:-1]
        at = np.flatnonzero(joined)
        joined[at] = _member(_pair(h[at - 1], h[at]), self.pairs)
        joined[first[:-1][first[:-1] < len(h)]] = False
        starts = np.flatnonzero(known & ~joined)
        ends = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
        long = ends - starts >= self.least
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            own, items = self.hits(h[a:b].tolist())
            if items:
                hit[a:b] |= own
                found[int(np.searchsorted(first, a, "right")) - 1] |= items
        return hit, found


def _step(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    return tx.mix(state * U(0x632BE59BD9B4E019) ^ word)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return tx.mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _member(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    quick = np.zeros(1 << 16, bool)
    quick[(known >> np.uint64(48)).astype(np.int64)] = True
    out = quick[(x >> np.uint64(48)).astype(np.int64)]
    at = np.flatnonzero(out)
    out[at] = known[np.minimum(np.searchsorted(known, x[at]), len(known) - 1)] == x[at]
    return out


def _words(buf, offs):
    starts, ends, first = tx.spans(buf, offs, tx.ALNUM)
    return starts, ends, first, tx.hashes(buf, starts, ends, tx.FOLDED)


def _scan(shared, rewrite: bool):
    """Per document: words, hit words, items, hit spans in bytes, and (rewrite) the text without those spans."""

    def run(batches):
        automata_ = shared.value
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, offs in tx.slices(batch.column(1)):
                starts, ends, first, h = _words(buf, offs)
                hit, found = np.zeros(len(h), bool), defaultdict(set)
                for auto in automata_:
                    more, own = auto.scan(h, first)
                    hit |= more
                    for i, ks in own.items():
                        found[i].update(auto.items[k] for k in ks)
                n = np.diff(first)
                total = np.concatenate(([0], np.cumsum(hit)))
                items = [sorted(found.get(i, ())) for i in range(hi - lo)]
                cuts, texts = [], []
                for i in range(hi - lo):
                    a, b = first[i], first[i + 1]
                    own = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].view(np.int8), [0])))) if i in found else np.zeros(0, np.int64)
                    pairs = [(int(starts[a + s] - offs[i]), int(ends[a + e - 1] - offs[i])) for s, e in zip(own[::2], own[1::2], strict=True)]
                    cuts.append([x for p in pairs for x in p])
                    if rewrite:
                        raw, kept, at = buf[offs[i] : offs[i + 1]].tobytes(), [], 0
                        for s, e in pairs:
                            kept.append(raw[at:s])
                            at = e
                        texts.append(b"".join([*kept, raw[at:]]))
                cols = [ids.slice(lo, hi - lo), pa.array(n), pa.array(np.diff(total[first])), pa.array(items, pa.list_(pa.string())), pa.array(cuts, pa.list_(pa.int64()))]
                names = ["doc_id", "n_words", "n_hit", "items", "cuts"]
                if rewrite:
                    cols, names = [*cols, tx.strings(texts)], [*names, "clean"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return tx.released(run)


def automata(items: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int | None = None, group: int | None = None):
    """Lists of `group` automata at most, each over block_bytes of item text at most (or one longer item); one list in memory at a time. There's always one list."""
    block_bytes, group = block_bytes or BLOCK_BYTES, group or GROUP
    block, size, own = [], 0, []
    rows = items.select(F.col(id_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).filter(F.col(id_col).isNotNull())
    for item, text in rows.toLocalIterator():
        raw = np.frombuffer(text.encode(), np.uint8)
        words = _words(raw, np.array([0, len(raw)]))[3]
        if block and size + len(raw) > block_bytes:
            own.append(Automaton(block, window))
            block, size = [], 0
            if len(own) == group:
                yield own
                own = []
        block.append((item, words))
        size += len(raw)
    yield [*own, Automaton(block, window)]


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items (ids, sorted as strings), contaminated, cuts.

    Words are runs of digits, letters and non-ASCII characters, with A-Z lower-cased. cuts holds the byte offsets
    (start, end, start, ...) of the runs of hit words. A null or empty text has no words; items without words or with
    a null id have no windows; an empty benchmark hits nothing; items that share an id are one item of several texts.
    Null or repeated doc ids are scanned like any other row, and other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, n_words long, n_hit long, items array<string>, cuts array<long>"
    groups = automata(items, item_id_col, item_text_col, window)
    first, second = next(groups), next(groups, None)
    if second is not None:
        docs = cut(docs.withColumn("row", F.monotonically_increasing_id()))
        return _blocks(docs, chain([first, second], groups), kind)
    return _tidy(docs.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(first), False), fields))


def _tidy(df: DataFrame) -> DataFrame:
    items = F.array_sort(F.array_distinct("items"))
    return df.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), items.alias("items"), (F.col("n_hit") > 0).alias("contaminated"), "cuts")


def _blocks(docs: DataFrame, groups: Iterable[list[Automaton]], kind: str) -> DataFrame:
    """The same for a benchmark of several lists of automata: one pass a list, whose hit spans are united for each document."""
    sc, parts = docs.sparkSession.sparkContext, []
    fields = "doc_id long, n_words long, n_hit long, items array<string>, cuts array<long>"
    for group in groups:
        parts.append(cut(docs.select("row", "text").mapInArrow(_scan(sc.broadcast(group), False), fields).filter("n_hit > 0")))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    hits = hits.groupBy("doc_id").agg(F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("cuts")).alias("cuts"))
    both = docs.join(hits.withColumnRenamed("doc_id", "hit_row"), F.col("row") == F.col("hit_row"), "left").select("doc_id", "text", "items", "cuts")
    return _tidy(both.mapInArrow(_united, f"doc_id {kind}, n_words long, n_hit long, items array<string>, cuts array<long>"))


@tx.released
def _united(batches):
    for batch in batches:
        for lo, hi, buf, offs in tx.slices(batch.column(1)):
            starts, ends, first = tx.spans(buf, offs, tx.ALNUM)
            hits, cuts = [], []
            for i, own in enumerate(batch.column(3).slice(lo, hi - lo).to_pylist()):
                s, e = starts[first[i] : first[i + 1]] - offs[i], ends[first[i] : first[i + 1]] - offs[i]
                hit = np.zeros(len(s) + 1, np.int64)
                for a, b in zip((own or [])[::2], (own or [])[1::2], strict=True):
                    hit[np.searchsorted(s, a)] += 1
                    hit[np.searchsorted(e, b) + 1] -= 1
                hit = np.cumsum(hit[:-1]) > 0
                runs = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                cuts.append([int(x) for p, q in zip(runs[::2], runs[1::2], strict=True) for x in (s[p], e[q - 1])])
                hits.append(int(hit.sum()))
            items = [x or [] for x in batch.column(2).slice(lo, hi - lo).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(cuts, pa.list_(pa.int64()))], ["doc_id", "n_words", "n_hit", "items", "cuts"])


def remove(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """docs without benchmark passages: the spans of hit words are cut out of the texts, and a document of whose words more than max_coverage were hit goes altogether.

    All columns are kept; texts without a hit (null ones too) stay as they are, byte for byte. Hits are those of the
    whole benchmark on the texts as they come, whether it takes one block or several.
    """
    groups = automata(items, item_id_col, item_text_col, window)
    first, second = next(groups), next(groups, None)
    if second is not None:
        return _rewrite_blocks(docs, chain([first, second], groups), text_col, max_coverage)
    return docs.mapInArrow(_rewrite(docs.sparkSession.sparkContext.broadcast(first), docs.columns.index(text_col), max_coverage), docs.schema)


def _rewrite_blocks(docs: DataFrame, groups: Iterable[list[Automaton]], text_col: str, max_coverage: float) -> DataFrame:
    """The same for a benchmark of several lists of automata: hit spans are united for each row, then cut out at once."""
    rows = cut(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"), F.col(f"`{text_col}`").cast("string").alias("text"), F.monotonically_increasing_id().alias("row")))
    found = _blocks(rows.select(F.col("row").alias("doc_id"), "text", "row"), groups, "long")
    hits = found.filter("n_hit > 0").select(F.col("doc_id").alias("hit_row"), "n_words", "n_hit", "cuts")
    both = rows.join(hits, F.col("row") == F.col("hit_row"), "left").filter(F.col("n_hit").isNull() | (F.col("n_hit") <= F.lit(float(max_coverage)) * F.col("n_words")))
    out = both.select("text", "cuts", "whole").mapInArrow(_without, f"text string, whole {rows.schema['whole'].dataType.simpleString()}")
    return out.select(*(F.col("text").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col(f"whole.`{c}`").alias(c) for c in docs.columns))


@tx.released
def _without(batches):
    """(text, whole) from (text, cuts, whole): the text without the spans of bytes in cuts."""
    for batch in batches:
        texts = []
        for text, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if cuts:
                raw, at = text.encode(), [0, *cuts, None]
                text = b"".join(raw[a:b] for a, b in zip(at[::2], at[1::2], strict=True)).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(2)], ["text", "whole"])


def _rewrite(shared, at: int, max_coverage: float):
    def run(batches):
        scan_ = _scan(shared, True)
        for batch in batches:
            text = batch.column(at)
            done = list(scan_(iter([pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), text], ["i", "text"])])))
            if not done:
                yield batch
                continue
            table = pa.Table.from_batches(done)
            n, hit = (table.column(c).to_numpy() for c in ("n_words", "n_hit"))
            new = pa.compute.if_else(pa.array(hit > 0), table.column("clean").combine_chunks().cast(text.type), text)
            new = new.combine_chunks() if isinstance(new, pa.ChunkedArray) else new
            cols = [new if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names).filter(pa.array(hit <= max_coverage * n))

    return tx.released(run)

