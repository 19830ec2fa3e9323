"""Document quality by co-training.

Two views of a document, its text (telling words and the make-up of its characters) and its page metadata (source,
language, length and layout), each get a linear classifier. Over some rounds each view labels all unlabelled documents,
and those it is surest of join the other view's training rows. Each view is then calibrated on out-of-fold predictions
of the labelled rows, and a last linear model combines the calibrated views to score all documents. The labelled rows
are bounded (SAMPLE, drawn by a hash of the ids), and so is what a view hands over a round (HANDED, the surest of all);
everything that is broadcast has a fixed size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm import linear
from tessera.llm._spark import cut

#: Labelled rows to fit on, rounds, documents that a view hands over a round, folds, cells.
SAMPLE, ROUNDS, HANDED, FOLDS, MOST_CELLS = 6_000, 3, 300, 4, 1024
#: Cells of the hashed metadata values.
META = 1 << 12
_SLICE = 1 << 20


def _shape(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Make-up of the characters of each row: shares of capitals, digits, marks, line feeds; mean word length; share of distinct words."""
    kinds = np.zeros(256, np.int64)
    kinds[65:91], kinds[48:58], kinds[10] = 1, 2, 4
    kinds[33:48] = kinds[58:65] = kinds[91:97] = kinds[123:127] = 3
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    size = np.maximum(np.diff(offs), 1)
    count = np.bincount(row * 5 + kinds[buf], minlength=5 * (len(offs) - 1)).reshape(-1, 5)
    starts, ends, first = tx.spans(buf, offs, tx.SOLID)
    h = tx.hashes(buf, starts, ends, tx.FOLDED)
    words = np.maximum(np.diff(first), 1)
    distinct = np.array([len(np.unique(h[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)])
    return np.column_stack((count[:, 1:] / size[:, None], np.diff(offs) / words / 10, distinct / words, np.log1p(words) / 10))


def _meta(columns: list, lengths: np.ndarray, feeds: np.ndarray) -> list[np.ndarray]:
    """Hashed metadata of each row: its values, and its length and number of lines by powers of two."""
    out = []
    for i in range(len(lengths)):
        keys = [f"{k}={c[i]}" for k, c in enumerate(columns)]
        keys += [f"size={int(np.log2(lengths[i] + 1))}", f"lines={int(np.log2(feeds[i] + 1))}"]
        out.append(np.unique([zlib.crc32(k.encode()) % META for k in keys]))
    return out


def _views(buf, offs, columns, wanted=None):
    cell, at = linear.cells(buf, offs, wanted)
    total = np.concatenate(([0], np.cumsum(buf == 10)))
    return cell, at, _shape(buf, offs), _meta(columns, np.diff(offs), np.diff(total[offs]))


@tx.released
def _featured(batches):
    """(text, id, label, metadata...) -> (id, label, cells, shape, meta)"""
    for batch in batches:
        for lo, hi, buf, offs in tx.slices(batch.column(0), _SLICE):
            cell, at, shape, meta = _views(buf, offs, [c.slice(lo, hi - lo).to_pylist() for c in batch.columns[3:]])
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(cell.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), lists, pa.array(list(shape), pa.list_(pa.float64())), pa.array(meta, pa.list_(pa.int32()))], ["id", "label", "cells", "shape", "meta"])


class Views:
    """A model of each view, its calibration, and what combines them.

    Fitted on labelled rows; `hand` gives a view rows that the other has labelled, `finish` calibrates and combines.
    """

    def __init__(self, cells: list[np.ndarray], shape: np.ndarray, meta: list[np.ndarray], y: np.ndarray):
        self.known = y.astype(float)
        self.rate = float(y.mean()) if len(y) else 1.0
        self.constant = not len(y) or y.min() == y.max()
        self.handed = [0, 0]
        if self.constant:
            return
        self.mean, self.sd = shape.mean(0), shape.std(0) + 1e-6
        self.keep = linear.telling(linear.Sparse(cells), self.known, MOST_CELLS)
        self.place = np.full(linear.CELLS, -1)
        self.place[self.keep] = np.arange(len(self.keep))
        self.lists, self.dense = [[], []], [np.zeros((0, shape.shape[1])), np.zeros((0, 0))]
        self.rows, self.labels = [np.zeros(0, np.int64)] * 2, [np.zeros(0)] * 2
        self.scale, self.mix = [np.array([1.0, 0.0])] * 2, np.array([0.5, 0.5, 0.0])
        at = self._append(cells, shape, meta)
        self.rows, self.labels = [at, at], [self.known, self.known]
        self.fit()

    def _append(self, cells, shape, meta) -> np.ndarray:
        n = len(self.lists[0])
        self.lists[0] += [self.place[c][self.place[c] >= 0] for c in cells]
        self.lists[1] += list(meta)
        self.dense = [np.concatenate((self.dense[0], (shape - self.mean) / self.sd)), np.zeros((n + len(cells), 0))]
        self.x = [linear.Sparse(v) for v in self.lists]
        return np.arange(n, n + len(cells))

    def hand(self, v: int, cells, shape, meta, labels: np.ndarray) -> None:
        """View v learns from more rows, as the other view has labelled them."""
        at = self._append(cells, shape, meta)
        self.rows[v], self.labels[v] = np.concatenate((self.rows[v], at)), np.concatenate((self.labels[v], labels))
        self.handed[v] += len(at)

    def _model(self, v: int, rows: np.ndarray, labels: np.ndarray):
        return linear.fit(self.x[v].take(rows), self.dense[v][rows], labels, (len(self.keep), META)[v], rounds=40)

    def _logit(self, v: int, m, rows: np.ndarray) -> np.ndarray:
        return self.x[v].take(rows).dot(m[0]) + self.dense[v][rows] @ m[1][:-1] + m[1][-1]

    def fit(self) -> None:
        self.models = [self._model(v, self.rows[v], self.labels[v]) for v in (0, 1)]

    def finish(self) -> None:
        n = len(self.known)
        fold, oof = np.arange(n) % FOLDS, np.zeros((n, 2))
        for f in range(FOLDS):
            out = np.flatnonzero(fold == f)
            for v in (0, 1):
                rest = np.concatenate((fold != f, np.ones(len(self.rows[v]) - n, bool)))
                oof[out, v] = self._logit(v, self._model(v, self.rows[v][rest], self.labels[v][rest]), out)
        none = linear.Sparse([np.zeros(0, np.int64)] * n)
        self.scale = [linear.fit(none, np.clip(oof[:, [v]], -30, 30), self.known, 0, ridge=1e-3)[1] for v in (0, 1)]
        both = np.column_stack([self.calibrated(v, oof[:, v]) for v in (0, 1)])
        self.mix = linear.fit(none, both, self.known, 0, ridge=1e-3)[1]
        self.oof = linear.sigmoid(both @ self.mix[:-1] + self.mix[-1])

    def calibrated(self, v: int, z: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of a view."""
        return np.clip(z, -30, 30) * self.scale[v][0] + self.scale[v][1]

    def packed(self):
        if self.constant:
            return self.rate
        table, meta = np.zeros(linear.CELLS), self.models[1][0]
        table[self.keep] = self.models[0][0]
        return table, meta, self.mean, self.sd, [m[1] for m in self.models], self.scale, self.mix


def _score(shared):
    def run(batches):
        model = shared.value
        if not isinstance(model, float):
            table, meta_w, mean, sd, dense, scale, mix = model
            wanted = table != 0
        for batch in batches:
            for lo, hi, buf, offs in tx.slices(batch.column(1), _SLICE):
                if isinstance(model, float):
                    p = [np.full(hi - lo, model)] * 3
                else:
                    cell, at, shape, meta = _views(buf, offs, [c.slice(lo, hi - lo).to_pylist() for c in batch.columns[2:]], wanted)
                    row = np.repeat(np.arange(hi - lo), np.diff(at))
                    z = [np.bincount(row, weights=table[cell], minlength=hi - lo) + (shape - mean) / sd @ dense[0][:-1] + dense[0][-1], linear.Sparse(meta).dot(meta_w) + dense[1][-1]]
                    z = [np.clip(z[v], -30, 30) * scale[v][0] + scale[v][1] for v in (0, 1)]
                    p = [linear.sigmoid(x) for x in (*z, np.column_stack(z) @ mix[:-1] + mix[-1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, p)], ["doc_id", "p_text", "p_metadata", "p_quality"])

    return tx.released(run)


def _named(docs: DataFrame, id_col: str, text_col: str, meta_cols: tuple[str, ...]) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).cast("string").alias(f"m{i}") for i, c in enumerate(meta_cols)))


def _features(rows: DataFrame, of: DataFrame) -> tuple:
    """Labels, cells, shapes and metadata of the documents in `of` (of, label), a bounded frame; of rows that share an id, the least."""
    rest = [c for c in rows.columns if c != "doc_id"]
    rows = rows.join(of, F.col("doc_id") == F.col("of")).groupBy("of", "label").agg(F.min(F.struct(*rest)).alias("s")).select("s.text", F.col("of").alias("id"), "label", *(f"s.{m}" for m in rest[1:]))
    got = rows.mapInArrow(_featured, f"id {rows.schema['id'].dataType.simpleString()}, label int, cells array<int>, shape array<double>, meta array<int>").toArrow().sort_by("id")
    cells, shape, meta = ([x.values.to_numpy() for x in got.column(c).combine_chunks()] if len(got) else [] for c in ("cells", "shape", "meta"))
    return got.column("label").to_numpy(), cells, np.array(shape).reshape(len(got), 7), [x.astype(np.int64) for x in meta]


def _scored(rows: DataFrame, views: Views) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(views.packed())
    return rows.mapInArrow(_score(shared), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, p_text double, p_metadata double, p_quality double")


def train(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = ("source", "lang"), label_id: str = "doc_id", sample: int = SAMPLE, handed: int = HANDED) -> Views:
    """The two views, from at most `sample` labelled documents (label: SQL over the label table) and all others; nulls in labels count as unlabelled.

    In each round both views score every unlabelled document, and the `handed` ones of which a view is surest, of all
    there are, go to the other.
    """
    rows = _named(docs, id_col, text_col, meta_cols)
    own = labels.select(F.col(label_id).alias("of"), F.expr(label).cast("int").alias("label")).dropna().groupBy("of").agg(F.max("label").alias("label"))
    ids = rows.select("doc_id").dropna().distinct()
    known = linear.sample(own.join(ids, F.col("of") == F.col("doc_id"), "left_semi"), "of", sample)
    y, *parts = _features(rows, known)
    views = Views(*parts, y)
    if views.constant:
        return views
    given: list = []  # ids that a view has been given, at most ROUNDS times twice `handed`
    for _ in range(ROUNDS):
        pool = _scored(rows, views).join(own, F.col("doc_id") == F.col("of"), "left_anti").filter(F.col("doc_id").isNotNull())
        pool = cut(pool.groupBy("doc_id").agg(F.min("p_text").alias("p_0"), F.min("p_metadata").alias("p_1")))
        left = pool.filter(~F.col("doc_id").isin(given)) if given else pool
        high = round(handed * views.rate)  # as many of each label as the labelled rows have
        for v in (0, 1):
            p = f"p_{v}"
            sure = [(r.doc_id, 1) for r in left.filter(f"{p} > 0.9").orderBy(F.desc(p), "doc_id").limit(high).collect()]
            sure += [(r.doc_id, 0) for r in left.filter(f"{p} < 0.1").orderBy(p, "doc_id").limit(handed - high).collect()]
            if sure:
                given += [i for i, _ in sure]
                picked = rows.sparkSession.createDataFrame(sure, f"of {rows.schema['doc_id'].dataType.simpleString()}, label int")
                as_, *parts = _features(rows, F.broadcast(picked))  # `handed` rows at most
                views.hand(1 - v, *parts, as_.astype(float))
        views.fit()
    views.finish()
    return views


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = ("source", "lang"), label_id: str = "doc_id", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of docs: doc_id, p_text, p_metadata (the calibrated views), p_quality (both), kept (p_quality is threshold or more).

    Null or empty texts and null metadata are values like others; null and repeated ids are scored like any other.
    Without labelled rows of both kinds every document gets the rate of the one kind (1 without labels at all).
    Columns other than those named are ignored.
    """
    out = _scored(_named(docs, id_col, text_col, meta_cols), train(docs, labels, label, id_col, text_col, meta_cols, label_id, sample))
    return out.withColumn("kept", F.col("p_quality") >= threshold)
