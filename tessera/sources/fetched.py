"""Data sources of what is fetched: a partition for each key, retries where the fetching is done, filters that reach it.

fetched() makes a Spark data source of two functions: one that lists keys (issuers, feed files, pages of an archive), and
one that fetches a key's rows. Read as a batch, the keys that a filter leaves are fetched, each by a task; read as a
stream, the keys that sort after the last ones (files named by their time, as landed feeds are).
"""

from __future__ import annotations

import hashlib
import os
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from tessera.sources.errors import CorruptDocument
from tessera.sources.files import MAGIC, MAX_BYTES
from tessera.sources.landed import NEWS, retried

# Fixed value: what is searched for.
SEARCH = '{} "bao cao thuong nien" OR "bao cao phat trien ben vung" {} filetype:pdf'

Keys = Callable[[], Iterable[str]]
Fetch = Callable[[str], Iterable[tuple]]


class _Key(InputPartition):
    def __init__(self, key: str):
        super().__init__(key)
        self.key = key


class _Batch(DataSourceReader):
    def __init__(self, keys: Keys, fetch: Callable[[str], list[tuple]], key_col: str | None):
        self.keys, self.fetch, self.key_col, self.wanted = keys, fetch, key_col, None

    def partitions(self) -> list[_Key]:
        return [_Key(k) for k in self.keys() if self.wanted is None or k in self.wanted]

    def read(self, partition: _Key | None) -> Iterator[tuple]:
        if partition is not None:  # where no key is left, Spark reads one empty partition
            yield from self.fetch(partition.key)


class _Filtered(_Batch):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = f.value if isinstance(f, In) else [f.value] if isinstance(f, EqualTo) else None
            if values is None or f.attribute != (self.key_col,):
                yield f  # Spark's to apply
            else:
                self.wanted = set(values) if self.wanted is None else self.wanted & set(values)


class _Stream(DataSourceStreamReader):
    """Offsets are the last key that was there; keys() must not come to list smaller ones later."""

    def __init__(self, keys: Keys, fetch: Callable[[str], list[tuple]]):
        self.keys, self.fetch = keys, fetch

    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        return {"last": max(self.keys(), default="")}

    def partitions(self, start: dict, end: dict) -> list[_Key]:
        return [_Key(k) for k in sorted(self.keys()) if start["last"] < k <= end["last"]]

    def read(self, partition: _Key) -> Iterator[tuple]:
        yield from self.fetch(partition.key)

    def commit(self, end: dict) -> None:
        pass


def fetched(name: str, schema: str, keys: Keys, fetch: Fetch, key_col: str | None = None, attempts: int = 3, least: float = 2, most: float = 10, sleep: Callable[[float], None] = time.sleep) -> type[DataSource]:
    """A data source class, to be registered with spark.dataSource.register() and read as format(name).

    A key's rows are fetched whole before the first is passed on, so that a failure halfway leaves none; `attempts`
    times, with waits that double from `least` to `most` seconds. key_col names the column that holds the key: equality
    filters on it keep the other keys from being fetched; Spark asks for spark.sql.python.filterPushdown.enabled then.
    """
    struct = StructType.fromDDL(schema)

    def whole(key: str) -> list[tuple]:
        return retried(lambda: list(fetch(key)), attempts, least, most, sleep)

    class Fetched(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return struct

        def reader(self, schema: StructType) -> DataSourceReader:
            return (_Filtered if key_col else _Batch)(keys, whole, key_col)

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _Stream(keys, whole)

    return Fetched


def feed_items(source: str, content: bytes) -> list[tuple]:
    """(source, title, link, published, body_text) of an RSS document's items; the body is the summary or else the description; missing fields are empty."""
    out = []
    for item in ET.fromstring(content).iter("item"):
        text = lambda tag: item.findtext(tag) or ""  # noqa: B023, E731
        out.append((source, text("title"), text("link"), text("pubDate"), text("summary") or text("description")))
    return out


def feed_files(name: str, folder: str, **retries) -> type[DataSource]:
    """A source of the feed files in a folder that driver and executors share, {time}_{source}.xml, as NEWS rows."""

    def keys() -> list[str]:
        return [f for f in os.listdir(folder) if f.endswith(".xml")]

    def fetch(key: str) -> list[tuple]:
        with open(os.path.join(folder, key), "rb") as f:
            return feed_items(key.removesuffix(".xml").split("_", 1)[-1], f.read())

    return fetched(name, NEWS, keys, fetch, **retries)


HITS = "ticker string, year int, pos int, href string, official_domain string, met_quota boolean"


def searches(name: str, requests: Iterable[tuple[str, int, str]], search: Callable[[str, int], Iterable[str]], most: int = 10) -> type[DataSource]:
    """A source of search hits for (ticker, year, official domain): search(query, most) gives the links of each, in order.

    An error whose class is named after a rate limit is a row of its own with met_quota, for the run to halt at; any
    other error is a search without hits, and no failure of the others.
    """
    asked = {f"{t}\x1f{y}": (t, int(y), d) for t, y, d in requests}

    def fetch(key: str) -> Iterator[tuple]:
        ticker, year, domain = asked[key]
        try:
            found = list(search(SEARCH.format(ticker, year), most))[:most]
        except Exception as e:
            if "ratelimit" in type(e).__name__.lower():
                yield ticker, year, None, None, domain, True
            return
        for pos, href in enumerate(found):
            yield ticker, year, pos, href, domain, False

    return fetched(name, HITS, lambda: list(asked), fetch, attempts=1)


FILES = "url string, content binary, content_hash string, error string"


def downloads(name: str, urls: Iterable[str], get: Callable[[str], Iterable[bytes]], expect_pdf: bool = True, clean: Callable[[bytes], bool] | None = None, max_bytes: int = MAX_BYTES, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> type[DataSource]:
    """A source of files: get(url) gives a file's bytes piece by piece, and is left off as soon as they're more than max_bytes.

    What can't be had after `attempts` tries, is too large, isn't clean or isn't a PDF is a row with its error and no
    content; the url is the key_col, so filters on it keep other files from being fetched.
    """
    listed = list(dict.fromkeys(urls))

    def whole(url: str) -> bytes:
        out = bytearray()
        for piece in get(url):
            out += piece
            if len(out) > max_bytes:
                raise CorruptDocument(f"more than {max_bytes} bytes")
        if clean and not clean(bytes(out)):
            raise CorruptDocument("malware")
        if expect_pdf and not out.startswith(MAGIC):
            raise CorruptDocument("not a PDF")
        return bytes(out)

    def fetch(url: str) -> Iterator[tuple]:
        try:
            content = retried(lambda: whole(url), attempts, sleep=sleep, final=(CorruptDocument,))
            yield url, content, hashlib.sha256(content).hexdigest(), None
        except Exception as e:
            yield url, None, None, f"{type(e).__name__}: {e}"

    return fetched(name, FILES, lambda: listed, fetch, "url", attempts=1)
