"""Heading-aware chunks of at most `limit` tokens.

The packing is a fold whose reset depends on its own running sum, so no window frame expresses it. The default runs
cleaning and packing in one Arrow pass that crosses into Python once; pack_native() is the same packing as a JVM
fold over arrays, and the tests hold the two against each other.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.keywords import give_back, slices
from tessera.operators import ordered

CHUNK = "array<struct<heading:string,text:string,token_count:int>>"
# The patterns of functions.text, as Python writes them.
_HEADING = re.compile(r"(?i)^(?:(?:I{1,3}|IV|V|VI{0,3}|IX|X)\.|\d{1,2}\.|\d{1,2}\.\d{1,2}\.?)\s")
_FOOTER = re.compile(r"(?im)^\s*(?:trang|page)\s*\d+.*$")
_WRAP = re.compile(r"(?<!\n)\n(?!\n)")
_END = re.compile(r"(?<=[.!?…])\s+")

Piece = tuple[str, int]


def words_of(text: str) -> int:
    return len(text.split())


def subwords_of(path: str) -> Callable[[str], int]:
    """A counter by a tokenizers file, loaded once in each worker; a missing library or file is an error, so that all rows of a table are counted alike."""

    def count(text: str) -> int:
        if path not in _tokenizers:
            from tokenizers import Tokenizer

            _tokenizers[path] = Tokenizer.from_file(path)
        return len(_tokenizers[path].encode(text, add_special_tokens=False).ids)

    return count


_tokenizers: dict = {}


class Tray:
    """What is being packed: texts and their tokens, up to a limit."""

    def __init__(self, limit: int):
        self.limit, self.texts, self.total = limit, [], 0

    def take(self) -> list[Piece]:
        """The piece so far, if there is any, and an empty tray."""
        out = [(" ".join(self.texts), self.total)] if self.texts else []
        self.texts, self.total = [], 0
        return out

    def put(self, text: str, n: int) -> list[Piece]:
        """Adds a text; if it doesn't fit, what had to make way."""
        out = self.take() if self.texts and self.total + n > self.limit else []
        self.texts.append(text)
        self.total += n
        return out


def _packed(parts: Iterable[str], limit: int, count: Callable[[str], int]) -> Iterator[Piece]:
    tray = Tray(limit)
    for part in parts:
        yield from tray.put(part, count(part))
    yield from tray.take()


def split_to_limit(text: str, limit: int = T.MAX_TOKENS, count: Callable[[str], int] = words_of) -> list[Piece]:
    """Sentences packed up to the limit; a longer sentence is packed by words, and nothing joins its last piece."""
    out, tray = [], Tray(limit)
    for sentence in filter(None, _END.split(text.strip())):
        n = count(sentence)
        if n > limit:
            out += tray.take()
            out += _packed(sentence.split(), limit, count)
        else:
            out += tray.put(sentence, n)
    return out + tray.take()


def chunks(paragraphs: Iterable[str], heading: str = T.DEFAULT_HEADING, limit: int = T.MAX_TOKENS, count: Callable[[str], int] = words_of) -> Iterator[tuple[str, str, int]]:
    """(heading, text, tokens). A heading closes the chunk before and heads those that follow; of a paragraph over the limit all pieces but the last are closed."""
    tray = Tray(limit)
    for p in paragraphs:
        if _HEADING.match(p):
            done, heading_next = tray.take(), p
        else:
            n, heading_next = count(p), heading
            if n > limit:
                pieces = split_to_limit(p, limit, count)
                done = tray.take() + pieces[:-1]
                tray.put(*pieces[-1])
            else:
                done = tray.put(p, n)
        for text, total in done:
            yield heading, text, total
        heading = heading_next
    for text, total in tray.take():
        yield heading, text, total


def clean(text: str) -> list[str]:
    """As functions.text.paragraphs, after NFC."""
    text = _WRAP.sub(" ", _FOOTER.sub("", text if text.isascii() else unicodedata.normalize("NFC", text)))
    return [p for p in map(str.strip, text.split("\n")) if p]


def _listed(texts: pa.Array, kind: pa.StructType, pieces: Callable[[int, str], Iterable[tuple]]) -> pa.Array:
    """An array of each text's list of pieces (its number and itself to tuples of kind's fields); only the pieces of some MB of texts are Python's at a time."""
    give_back()  # what the batch before took
    done = []
    for lo, hi, *_ in slices(texts):
        ends, columns = [0], [[] for _ in kind]
        for i, x in enumerate(texts.slice(lo, hi - lo).to_pylist(), lo):
            for piece in pieces(i, x or ""):
                for column, v in zip(columns, piece, strict=True):
                    column.append(v)
            ends.append(len(columns[0]))
        structs = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind))
        done.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs))
    return pa.concat_arrays(done) if done else pa.array([], pa.list_(kind))


_PIECE = pa.struct([("text", pa.string()), ("token_count", pa.int32())])
_CHUNK = pa.struct([("heading", pa.string()), *_PIECE])


def chunk_column(text: Column, heading: Column, limit: int = T.MAX_TOKENS, count: Callable[[str], int] = words_of) -> Column:
    """The chunks of a raw text, cleaned and packed in one Arrow pass; of a null, none. `count` may be a subword tokenizer's."""

    @F.arrow_udf(CHUNK)
    def run(texts: pa.Array, headings: pa.Array) -> pa.Array:
        named = lambda i: T.DEFAULT_HEADING if headings[i].as_py() is None else headings[i].as_py()
        return _listed(texts, _CHUNK, lambda i, x: chunks(clean(x), named(i), limit, count))

    return run(text, heading)


def split_column(text: Column, limit: int = T.MAX_TOKENS, count: Callable[[str], int] = words_of) -> Column:
    """The pieces of a text of one paragraph; of a null, none. `count` may be a subword tokenizer's."""

    @F.arrow_udf("array<struct<text:string,token_count:int>>")
    def run(texts: pa.Array) -> pa.Array:
        return _listed(texts, _PIECE, lambda _, x: split_to_limit(x, limit, count))

    return run(text)


def pack_native(parts: Column, limit: int = T.MAX_TOKENS) -> Column:
    """Pieces (text, n) of struct<text, n> parts, none over the limit, as one JVM fold."""
    empty = F.struct(F.expr("cast(array() as array<struct<text:string,n:int>>)").alias("out"), F.lit("").alias("text"), F.lit(0).alias("n"))

    def step(acc, p):
        over = (acc.text != "") & (acc.n + p.n > limit)
        return F.struct(
            F.when(over, F.concat(acc.out, F.array(F.struct(acc.text.alias("text"), acc.n.alias("n"))))).otherwise(acc.out).alias("out"),
            F.when(over | (acc.text == ""), p.text).otherwise(F.concat(acc.text, F.lit(" "), p.text)).alias("text"),
            F.when(over, p.n).otherwise(acc.n + p.n).alias("n"),
        )

    return F.aggregate(parts, empty, step, lambda a: F.when(a.text == "", a.out).otherwise(F.concat(a.out, F.array(F.struct(a.text.alias("text"), a.n.alias("n"))))))


def heading_rows(rows: DataFrame, key: str, order: str, text_col: str, default: str = T.DEFAULT_HEADING, hot: int = ordered.HOT) -> DataFrame:
    """rows with the heading that each paragraph stands under (its own text, if it is one) and whether it is one; a document of `hot` paragraphs or more is split."""
    rows = rows.withColumn("is_heading", T.is_heading(F.col(text_col)))
    out = ordered.running(rows, [key], [F.col(order)], {"heading": ("last", F.when(F.col("is_heading"), F.col(text_col)))}, inclusive=True, hot=hot)
    return out.withColumn("heading", F.coalesce("heading", F.lit(default)))


def chunk_rows(docs: DataFrame, text_col: str, heading: Column | None = None, limit: int = T.MAX_TOKENS) -> DataFrame:
    """docs with a row for each chunk, in order: chunk_pos, heading, text, token_count; narrow, without a shuffle."""
    heading = F.lit(T.DEFAULT_HEADING) if heading is None else heading
    keep = [c for c in docs.columns if c != text_col]
    return docs.select(*keep, F.posexplode(chunk_column(F.col(text_col), heading, limit)).alias("chunk_pos", "_c")).select(*keep, "chunk_pos", F.col("_c.heading").alias("heading_context"), F.col("_c.text").alias("filtered_chunk_text"), F.col("_c.token_count").alias("token_count"))
