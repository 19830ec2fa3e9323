"""Hashed word features and logistic regression on bounded samples, and scoring of whole tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx

U = np.uint64
BITS = 18
STEM = 5
CELLS = 1 << BITS


def cells(buf: np.ndarray, offs: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells of each row, and each row's first (one more at the end); only the wanted ones, if given.

    A word (a run of digits, letters and non-ASCII characters) has a cell, and so have the first STEM bytes of a longer one.
    """
    starts, ends, first = tx.spans(buf, offs, tx.ALNUM)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    long = np.flatnonzero(ends - starts > STEM)
    stems = tx.mix(tx.hashes(buf, starts[long], starts[long] + STEM, tx.FOLDED) + U(9))
    cell = (np.concatenate((tx.hashes(buf, starts, ends, tx.FOLDED), stems)) >> U(64 - BITS)).astype(np.int64)
    row = np.concatenate((row, row[long]))
    if wanted is not None:
        at = np.flatnonzero(wanted[cell])
        cell, row = cell[at], row[at]
    key = np.sort(row << BITS | cell)
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return key & (CELLS - 1), np.searchsorted(key >> BITS, np.arange(len(offs)))


@tx.released
def _features(batches):
    for batch in batches:
        for lo, hi, buf, offs in tx.slices(batch.column(0)):
            cell, at = cells(buf, offs)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(cell.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, *(c.slice(lo, hi - lo) for c in batch.columns[1:])], ["cells", *batch.schema.names[1:]])


def features(df: DataFrame) -> DataFrame:
    """df with its column text replaced by the column cells."""
    names = [c for c in df.columns if c != "text"]
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "text")
    return df.select("text", *names).mapInArrow(_features, f"cells array<int>, {rest}")


def sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """At most `size` of rows, drawn by a hash of their key, so alike in every run."""
    return rows.orderBy(F.xxhash64(key), key).limit(size)


class Sparse:
    """Binary rows: the columns of row i are cols[at[i]:at[i + 1]]."""

    def __init__(self, lists: list[np.ndarray]):
        self.at = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        self.cols = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
        self.row = np.repeat(np.arange(len(lists)), np.diff(self.at))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.cols], minlength=len(self.at) - 1)

    def pull(self, r: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.cols, weights=r[self.row], minlength=n)

    def take(self, rows: np.ndarray) -> Sparse:
        return Sparse([self.cols[self.at[i] : self.at[i + 1]] for i in rows.tolist()])


def telling(x: Sparse, y: np.ndarray, most: int, least: int = 4) -> np.ndarray:
    """The (at most `most`) cells, each in `least` rows or more, whose presence says most about y by its chi-square; those under 11 (one in a thousand by chance) never."""
    n, pos = len(y), y.sum()
    have, hits = np.bincount(x.cols, minlength=CELLS), np.bincount(x.cols, weights=y[x.row], minlength=CELLS)
    with np.errstate(divide="ignore", invalid="ignore"):
        want = have * pos / n
        chi = np.nan_to_num((hits - want) ** 2 * n * n / (have * (n - have) * (pos / n) * (n - pos)))
    chi[have < least] = 0
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(best[chi[best] > 11])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Sparse, dense: np.ndarray, y: np.ndarray, n: int, ridge: float = 1.0, rounds: int = 60, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights of n sparse columns, and of the dense ones with a bias last: ridge logistic regression by L-BFGS."""
    dense = np.column_stack((dense, np.ones(len(y))))
    weight = np.ones(len(y)) if weight is None else weight
    penal = np.full(n + dense.shape[1], ridge)
    penal[-1] = 1e-6

    def loss(w):
        z = x.dot(w[:n]) + dense @ w[n:]
        r = (sigmoid(z) - y) * weight
        value = (weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penal * w * w).sum()
        return value, np.concatenate((x.pull(r, n), dense.T @ r)) + penal * w

    w = np.zeros(len(penal))
    value, g = loss(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        d, alphas = g.copy(), []
        for s, t, rho in reversed(past):
            alphas.append(rho * (s @ d))
            d -= alphas[-1] * t
        if past:
            s, t, _ = past[-1]
            d *= (s @ t) / (t @ t)
        else:
            d /= max(1.0, np.abs(g).max())
        for (s, t, rho), a in zip(past, reversed(alphas), strict=True):
            d += s * (a - rho * (t @ d))
        step, slope = 1.0, g @ d
        while True:
            new = w - step * d
            v2, g2 = loss(new)
            if v2 <= value - 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, t = new - w, g2 - g
        if s @ t > 1e-12:
            past = [*past[-9:], (s, t, 1 / (s @ t))]
        done = abs(value - v2) <= 1e-10 * max(1.0, abs(value))
        w, value, g = new, v2, g2
        if done:
            break
    return w[:n], w[n:]


