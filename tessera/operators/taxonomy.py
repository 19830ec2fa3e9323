"""Weighted keyword taxonomies and dictionaries: scores and tags of texts."""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import keywords as K
from tessera.functions import text as T
from tessera.sources.shared import cut

# Environmental categories come first, then social, then governance ones, then others.
ORDER = "ESG"
THRESHOLD = 2
#: Classes of bytes that a dictionary's first division into blocks reckons with.
_LETTERS = 40


class Keyword(NamedTuple):
    category: str
    keyword: str
    weight: int


# The taxonomy of the reference tables of this domain.
ESG = {
    "E_Emissions": {"khi nha kinh": 2, "phat thai": 1, "co2": 1, "kwh": 1, "net zero": 2, "trung hoa carbon": 2, "nang luong tai tao": 2},
    "E_Resources": {"tieu thu nuoc": 1, "quan ly chat thai": 2, "kinh te tuan hoan": 2},
    "S_Labor": {"tai nan lao dong": 2, "an toan lao dong": 2, "phuc loi nhan vien": 1, "binh dang gioi": 2},
    "S_Community": {"trach nhiem xa hoi": 2, "cong dong dia phuong": 1},
    "G_Governance": {"hoi dong quan tri": 1, "kiem toan doc lap": 2, "chong tham nhung": 2, "minh bach": 1, "thanh vien doc lap": 2},
}


def keywords(categories: dict[str, dict[str, int]]) -> list[Keyword]:
    """Normalised entries, in the order of the categories."""
    import unicodedata

    plain = lambda s: "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c)).replace("đ", "d")
    return [Keyword(c, plain(k), int(w)) for c, own in categories.items() for k, w in own.items() if k]


def load(spark: SparkSession, path: str) -> list[Keyword]:
    """From a JSON file {categories: {name: [{keyword, weight}]}}, anywhere Spark can read."""
    whole = spark.read.text(path, wholetext=True).first()[0]
    return keywords({c: {e["keyword"]: e["weight"] for e in own} for c, own in json.loads(whole)["categories"].items()})


def frame(spark: SparkSession, words: list[Keyword]) -> DataFrame:
    return spark.createDataFrame([(i, *w) for i, w in enumerate(words)], "ord int, category string, keyword string, weight int")


def _categories(words: list[Keyword]) -> list[str]:
    return list(dict.fromkeys(w.category for w in words))


def score(normal: Column, words: list[Keyword]) -> dict[str, Column]:
    """Each category's summed weights times occurrences in a normalised text."""
    out = {}
    for c in _categories(words):
        terms = [T.occurrences(normal, w.keyword) * w.weight for w in words if w.category == c]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        out[c] = total
    return out


def tags(normal: Column, words: list[Keyword], threshold: int = THRESHOLD) -> Column:
    """The categories that reach the threshold, E, S, G, others; in the taxonomy's order within each."""
    found = score(normal, words)
    rank = lambda c: ORDER.index(c[0]) if c and c[0] in ORDER else len(ORDER)
    return F.array_compact(F.array(*(F.when(found[c] >= threshold, F.lit(c)) for c in sorted(found, key=rank))))


def scored(text: Column, words: list[Keyword]) -> Column:
    """An array of each category's score in a raw text, all keywords found in one pass over its bytes."""
    own = _categories(words)
    return K.sums_column(text, [(own.index(w.category), w.keyword, w.weight) for w in words], len(own))


def tagged(rows: DataFrame, text_col: str, words: list[Keyword], threshold: int = THRESHOLD, out: str = "matched_tags") -> DataFrame:
    """rows that have a tag, with their tags; a text is read once (the generator keeps the filter from repeating it)."""
    own = _categories(words)
    rank = lambda c: ORDER.index(c[0]) if c and c[0] in ORDER else len(ORDER)
    named = lambda s: F.array_compact(F.array(*(F.when(s[own.index(c)] >= threshold, F.lit(c)) for c in sorted(own, key=rank))))
    return rows.withColumn(out, F.explode(F.transform(F.array(scored(F.col(text_col), words)), named))).filter(F.size(out) > 0)


def _possible(own: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of own (keyword, ...) whose keyword may occur in a text."""
    pieces, each = 16, (1 << K.GRAMS) // 8 // 16

    def marked(batches):
        table = np.zeros(1 << K.GRAMS, np.uint8)
        for batch in batches:
            K.seen(batch.column(0), table)
        bits = np.packbits(table, bitorder="little").reshape(pieces, each)
        yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array([zstandard.compress(b.tobytes(), 1) for b in bits], pa.binary())], ["piece", "bits"])

    def merged(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits = np.frombuffer(zstandard.decompress(b), np.uint8)
                found[i] = found[i] | bits if i in found else bits
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([b.tobytes() for b in found.values()], pa.binary())], ["piece", "bits"])

    kinds = "piece int, bits binary"
    table = np.zeros((pieces, each), np.uint8)
    for row in texts.mapInArrow(marked, kinds).repartition(pieces, "piece").mapInArrow(merged, kinds).toLocalIterator():
        table[row.piece] = np.frombuffer(row.bits, np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(table.reshape(-1))

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(K.possible(batch.column(0), shared.value)))

    return own.mapInArrow(kept, own.schema)


def joined_scores(rows: DataFrame, id_cols: list[str], text_col: str, dictionary: DataFrame, cells: int = K.CELLS) -> DataFrame:
    """The same scores for a dictionary of any size held as a table (category, keyword, weight): (ids, category, score), without scores of 0.

    Automata are built by tasks, for ranges of keywords, in blocks of a checked size (`cells`, 64 MB at most in a
    worker); a block at a time is broadcast, and the texts are read once for each. Keywords are folded as texts are;
    entries that repeat count as often; empty keywords and nulls are left out. Only keywords whose runs of bytes all
    occur in some text (a hashed table of fixed size, which may let others through) get into a block, so the number
    of blocks grows with what texts can hold, not with the dictionary; if it all fits in one block, that isn't looked at.
    """
    spark = rows.sparkSession
    entries = dictionary.select(F.col("category").cast("string").alias("category"), T.normal(F.col("keyword")).alias("keyword"), F.col("weight").cast("long").alias("weight")).filter("keyword <> '' and category is not null and weight is not null")
    own = entries.groupBy("keyword", "category").agg(F.sum("weight").alias("weight")).groupBy("keyword").agg(F.collect_list(F.struct("category", "weight")).alias("own"))
    weighed = lambda: (own.agg(F.sum(F.octet_length("keyword"))).first()[0] or 0) * _LETTERS
    room = weighed()
    if room > cells:
        own = cut(_possible(own, rows.select(F.col(text_col).cast("string"))))
        room = weighed()
    n = max(1, -(-room // cells))

    def built(batches):
        words, own = [], []
        for batch in batches:
            words += batch.column(0).to_pylist()
            own += [[(e["category"], e["weight"]) for e in x] for x in batch.column(1).to_pylist()]
        order = sorted(range(len(words)), key=lambda i: words[i].encode())
        for content in K.blocks([words[i] for i in order], [own[i] for i in order], cells):
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

    blocks = cut(own.repartitionByRange(n, "keyword").coalesce(n).mapInArrow(built, "content binary"))  # n tasks even where a session deals into more
    texts = rows.select(*id_cols, F.col(text_col).cast("string").alias("_text"))
    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in id_cols)
    fields = f"{kinds}, category string, score long"

    def found(shared):
        def run(batches):
            block = K.opened(shared.value)
            names = pa.array(block.names, pa.string())
            for batch in batches:
                row, group, total = K.scores(block, batch.column(batch.num_columns - 1))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(len(id_cols))), names.take(pa.array(group)), pa.array(total)], [*id_cols, "category", "score"])

        return run

    out, several = None, blocks.count() > 1
    for block in blocks.toLocalIterator():
        shared = spark.sparkContext.broadcast(bytes(block.content))
        part = texts.mapInArrow(found(shared), fields)
        if several:  # so that no more than one block is held at a time
            part = cut(part)
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    if out is None:
        return texts.select(*id_cols, F.lit("").alias("category"), F.lit(0).cast("long").alias("score")).filter("false")
    return out.groupBy(*id_cols, "category").agg(F.sum("score").alias("score")).filter("score <> 0")
