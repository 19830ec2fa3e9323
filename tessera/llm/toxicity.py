"""Toxicity by classifier chains: linear models of the categories, one after another, each fed the earlier ones' probabilities.

The models are fitted on a bounded sample of labelled rows (SAMPLE); while fitting, what a later model sees of an
earlier category are out-of-fold predictions, so it learns from honest probabilities. Words are hashed to 2**18 cells,
of which a model keeps the telling ones; the broadcast weights have that fixed size. Unless one is given, the threshold
of the rejecting category is the one with the best F1 on its out-of-fold probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text as tx
from tessera.llm import linear

#: Labelled rows to fit on, folds, cells a model keeps, and its ridge.
SAMPLE, FOLDS, MOST_CELLS, RIDGE = 10_000, 5, 2048, 0.1


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on rejecting has the best F1: midway to the next lower one, between 0.05 and 0.95."""
    by = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[by])
    last = np.append(p[by][1:] != p[by][:-1], True)
    k = int(np.argmax(np.where(last, 2 * hits / (np.arange(1, len(p) + 1) + y.sum()), -1)))
    return float(np.clip((p[by][k] + (p[by][k + 1] if k + 1 < len(p) else 0)) / 2, 0.05, 0.95))


class Chain:
    """One model a category: cells, their weights, the weights of the earlier probabilities, and a bias."""

    def __init__(self, names: list[str]):
        self.names, self.models, self.cuts = names, [], []

    def fit(self, lists: list[np.ndarray], labels: np.ndarray, folds: int = FOLDS) -> np.ndarray:
        """Fits on rows of cells and a 0/1 matrix of labels; the out-of-fold probabilities."""
        n = len(lists)
        x, before = linear.Sparse(lists), np.zeros((n, 0))
        fold = np.arange(n) % folds
        for k in range(len(self.names)):
            y = labels[:, k].astype(float)
            if n == 0 or y.min() == y.max():
                rate = float(y.mean()) if n else 0.0
                self.models.append((np.zeros(0, np.int64), np.zeros(0), np.zeros(k), 40.0 if rate else -40.0))
                before = np.column_stack((before, np.full(n, rate)))
                self.cuts.append(0.5)
                continue
            oof = np.zeros(n)
            for f in range(folds):
                out, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                model = self._one(x.take(rest), before[rest], y[rest])
                oof[out] = self._p(model, x.take(out), before[out])
            self.models.append(self._one(x, before, y))
            self.cuts.append(best_cut(oof, y))
            before = np.column_stack((before, oof))
        return before

    @staticmethod
    def _one(x: linear.Sparse, before: np.ndarray, y: np.ndarray):
        keep = linear.telling(x, y, MOST_CELLS)
        place = np.full(linear.CELLS, -1)
        place[keep] = np.arange(len(keep))
        own = [place[c][place[c] >= 0] for c in (x.cols[x.at[i] : x.at[i + 1]] for i in range(len(y)))]
        w, d = linear.fit(linear.Sparse(own), before, y, len(keep), ridge=RIDGE)
        return keep, w, d[:-1], float(d[-1])

    @staticmethod
    def _p(model, x: linear.Sparse, before: np.ndarray) -> np.ndarray:
        keep, w, chain, bias = model
        table = np.zeros(linear.CELLS)
        table[keep] = w
        return linear.sigmoid(x.dot(table) + before @ chain + bias)

    def packed(self) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, float]]]:
        """Which cells any model wants, and each model's table of weights, chain weights and bias."""
        wanted, out = np.zeros(linear.CELLS, bool), []
        for keep, w, chain, bias in self.models:
            wanted[keep] = True
            table = np.zeros(linear.CELLS, np.float64)
            table[keep] = w
            out.append((table, chain, bias))
        return wanted, out


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", sample: int = SAMPLE) -> tuple[Chain, np.ndarray, np.ndarray]:
    """The chain for categories (name -> SQL over the label table, true where it holds), out-of-fold probabilities, and the labels.

    Only rows with an id, where every expression is non-null, are used; of documents that share an id, the least text.
    """
    names = list(categories)
    rows = labels.select(F.col(label_id).alias("of"), *(F.expr(e).cast("int").alias(f"y{i}") for i, e in enumerate(categories.values()))).dropna()
    rows = linear.sample(rows.groupBy("of").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(names)))), "of", sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(rows, F.col("id") == F.col("of")).groupBy("of", *(f"y{i}" for i in range(len(names)))).agg(F.min("text").alias("text"))
    got = linear.features(texts.select("text", "of", *(f"y{i}" for i in range(len(names))))).toArrow().sort_by("of")
    y = np.column_stack([got.column(f"y{i}").to_numpy() for i in range(len(names))]) if names else np.zeros((0, 0))
    chain = Chain(names)
    column = got.column("cells").combine_chunks() if len(got) else None
    return chain, chain.fit([x.values.to_numpy() for x in column] if column is not None else [], y), y


def _score(shared, at: int, names: list[str]):
    """Appends a probability for each category to the rows, in columns of these names; the text is column `at`."""

    def run(batches):
        wanted, models = shared.value
        for batch in batches:
            for lo, hi, buf, offs in tx.slices(batch.column(at)):
                cell, first = linear.cells(buf, offs, wanted)
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                before = np.zeros((hi - lo, 0))
                for table, chain, bias in models:
                    z = np.bincount(row, weights=table[cell], minlength=hi - lo) + before @ chain + bias
                    before = np.column_stack((before, linear.sigmoid(z)))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(before[:, k]) for k in range(before.shape[1]))], [*batch.schema.names, *names])

    return tx.released(run)


def _scored(docs: DataFrame, chain: Chain, text_col: str) -> tuple[DataFrame, list[str]]:
    """docs with a probability for each category, and the names of those columns, which docs doesn't have."""
    shared, taken = docs.sparkSession.sparkContext.broadcast(chain.packed()), {c.lower() for c in docs.columns}
    names = []
    for k in range(len(chain.names)):
        names.append(f"_p{k}")
        while names[-1] in taken:
            names[-1] = "_" + names[-1]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    return docs.mapInArrow(_score(shared, docs.columns.index(text_col), names), schema), names


def _cut(chain: Chain, reject: str, threshold: float | None) -> float:
    return chain.cuts[chain.names.index(reject)] if threshold is None else threshold


def score(docs: DataFrame, labels: DataFrame, categories: dict[str, str], reject: str, threshold: float | None = None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """One row for each row of docs: doc_id, p_<category> for each, and rejected (the probability of `reject` is threshold or more).

    A null or empty text has no words, so its probabilities are those of a text without telling words; null and
    repeated ids are scored like any other. Without labelled rows nothing is rejected; a category that is the same in
    all labelled rows gets that answer everywhere. Columns other than the id and the text are ignored.
    """
    chain, _, _ = train(docs, labels, categories, id_col, text_col, label_id, sample)
    out, names = _scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), chain, "text")
    return out.select("doc_id", *(F.col(n).alias(f"p_{c}") for n, c in zip(names, chain.names, strict=True)), (F.col(names[chain.names.index(reject)]) >= _cut(chain, reject, threshold)).alias("rejected"))


def keep(docs: DataFrame, labels: DataFrame, categories: dict[str, str], reject: str, threshold: float | None = None, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """docs, with all columns whatever their names, without the documents that score() rejects; null texts and ids, and repeated rows, are scored like any other."""
    chain, _, _ = train(docs, labels, categories, id_col, text_col, "doc_id", sample)
    out, names = _scored(docs, chain, text_col)
    return out.filter(F.col(names[chain.names.index(reject)]) < _cut(chain, reject, threshold)).select(*(F.col(f"`{c}`") for c in docs.columns))
