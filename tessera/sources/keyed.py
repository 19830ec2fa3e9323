"""A table with a key that is written in place of a database's: upserts, lookups by key, and commits that are whole or not at all.

Rows lie in buckets of their key's hash, each bucket in a folder of Parquet files. An upsert writes the buckets that it
touches anew and leaves all others as they are; then one small file, the next version's manifest, names each bucket's
folder. It's created only if no other writer has created it, so a writer that died before that has changed nothing, and
one that lost a race is told so. Readers take the newest manifest there is.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.errors import PipelineError
from tessera.sources.shared import cut


class Conflict(PipelineError):
    """Another writer has committed the version that this one set out to write."""


class KeyedTable:
    """Rows of `schema`, one for each value of `key`, under `path`; `buckets` is fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 16):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = StructType.fromDDL(schema)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        _, made = self._manifest()
        self.buckets = made["buckets"] if made else buckets

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return self._manifest()[0]

    def _manifest(self) -> tuple[int, dict]:
        at = self._path(f"{self.path}/versions")
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        newest = max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)
        if not newest:
            return 0, {}
        return newest, self._content(newest)

    def _content(self, version: int) -> dict:
        file = self._fs.open(self._path(f"{self.path}/versions/{version:010d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def _commit(self, version: int, folders: dict[str, str]) -> None:
        sc, hadoop = self.spark.sparkContext, self.spark.sparkContext._jvm.org.apache.hadoop.fs
        to, staged = (self._path(f"{self.path}/versions/{n}") for n in (f"{version:010d}.json", f".{uuid.uuid4().hex}"))
        out = self._fs.create(staged, False)
        out.write(bytearray(json.dumps({"buckets": self.buckets, "folders": folders}).encode()))
        out.close()
        files = hadoop.FileContext.getFileContext(self._fs.getUri(), sc._jsc.hadoopConfiguration())
        try:  # one step that fails where the target is there; the content was whole before it
            files.rename(staged, to, sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
        except Py4JJavaError as e:
            if self._fs.exists(staged):
                self._fs.delete(staged, False)
            if self._fs.exists(to):
                raise Conflict(f"version {version} of {self.path}") from e
            raise

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self) -> DataFrame:
        """All rows of the newest version; a frame keeps to its version whatever is committed later."""
        return self._read(sorted(self._manifest()[1].get("folders", {}).values()))

    def get(self, value: object) -> DataFrame:
        """The row with a key, if there is one; only its bucket is read."""
        bucket = self.spark.range(1).select(self.bucket_of(F.lit(value).cast(self.schema[self.key].dataType))).first()[0]
        folder = self._manifest()[1].get("folders", {}).get(str(bucket))
        return self._read([folder] if folder else []).filter(F.col(self.key) == value)

    def upsert(self, changes: DataFrame, defaults: dict[str, object] | None = None, replace: tuple[str, ...] = ()) -> int:
        """Merges changes (a row a key, of any of the columns) and commits; the new version, or the old one if there are none.

        Of a known key each column that isn't null in changes takes its value, a column in `replace` also where it's null;
        a new key has nulls, or `defaults`, where changes has none. Rows without a key are left out.
        """
        version, made = self._manifest()
        folders = dict(made.get("folders", {}))
        new = cut(changes.filter(F.col(self.key).isNotNull()).withColumn("_bucket", self.bucket_of(F.col(self.key).cast(self.schema[self.key].dataType))))
        touched = [str(r._bucket) for r in new.select("_bucket").distinct().collect()]  # as many as there are buckets at most
        if not touched:
            return version
        columns = [f.name for f in self.schema if f.name != self.key]
        given = [c for c in columns if c in changes.columns]
        old = self._read([folders[b] for b in touched if b in folders]).withColumn("_known", F.lit(True))
        theirs = new.select(F.col(self.key).cast(self.schema[self.key].dataType).alias("_key"), *(F.col(c).cast(self.schema[c].dataType).alias(f"_new_{c}") for c in given))
        both = old.join(theirs, F.col(self.key) == F.col("_key"), "full")

        def value(c: str) -> Column:
            fresh = F.lit((defaults or {}).get(c)).cast(self.schema[c].dataType)
            if c not in given:
                return F.when(F.col("_known").isNull(), fresh).otherwise(F.col(c))
            if c in replace:
                return F.when(F.col("_key").isNull(), F.col(c)).otherwise(F.col(f"_new_{c}"))
            return F.coalesce(f"_new_{c}", F.when(F.col("_known").isNull(), fresh).otherwise(F.col(c)))

        key = F.coalesce(self.key, "_key").alias(self.key)
        rows = both.select(*(key if f.name == self.key else value(f.name).alias(f.name) for f in self.schema)).withColumn("_bucket", self.bucket_of(F.col(self.key)))
        data = f"data/{uuid.uuid4().hex}"
        rows.repartition("_bucket").sortWithinPartitions("_bucket", self.key).write.partitionBy("_bucket").parquet(f"{self.path}/{data}")
        folders |= {b: f"{data}/_bucket={b}" for b in touched}
        self._commit(version + 1, folders)
        return version + 1

    def vacuum(self, keep: int = 1) -> None:
        """Removes all but the newest versions, and the data that none of them names (of writers at work too, so none may be)."""
        version, _ = self._manifest()
        named = set()
        for v in range(max(1, version - keep + 1), version + 1):
            named |= {f.split("/")[1] for f in self._content(v)["folders"].values()}
        for s in self._fs.listStatus(self._path(f"{self.path}/versions")) if version else []:
            name = s.getPath().getName()
            if name.endswith(".json") and int(name.removesuffix(".json")) <= version - keep:
                self._fs.delete(s.getPath(), False)
        for s in self._fs.listStatus(self._path(f"{self.path}/data")) if version else []:
            if s.getPath().getName() not in named:
                self._fs.delete(s.getPath(), True)


DOCUMENTS = "doc_id string, ticker string, fiscal_year int, storage_path string, pdf_type_flag string, content_hash string, state string, error_message string, updated_at timestamp"
CACHE = "cache_key string, url string, at timestamp"


def documents(spark: SparkSession, path: str, buckets: int = 16) -> KeyedTable:
    return KeyedTable(spark, path, DOCUMENTS, "doc_id", buckets)


def search_cache(spark: SparkSession, path: str, buckets: int = 16) -> KeyedTable:
    return KeyedTable(spark, path, CACHE, "cache_key", buckets)
