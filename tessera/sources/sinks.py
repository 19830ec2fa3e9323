"""Writers, and what they report."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.metrics import ALERT
from tessera.sources.shared import cut

PARTS = ("ticker", "fiscal_year")


def write_records(records: DataFrame, path: str, fields: tuple[str, ...] | None = None, order: tuple[str, ...] = (), by: tuple[str, ...] = PARTS) -> int:
    """Records as JSON lines (UTF-8, not escaped) of all fields, nulls included, a folder for each issuer and year and in it by order; only the folders written are replaced. The count comes from the same pass."""
    seen = Observation()
    line = F.to_json(F.struct(*(fields or records.columns)), {"ignoreNullFields": "false"})
    rows = records.observe(seen, F.count(F.lit(1)).alias("n")).repartition(*by).sortWithinPartitions(*by, *order).select(*by, line.alias("value"))
    # The JSON writer would take the folders' columns out of the lines. One CSV column without quotes is the line itself: JSON escapes what could end or split it.
    plain = {"extension": "json", "sep": "\x01", "quote": "\x00", "escape": "\x00", "emptyValue": ""}
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).options(**plain).csv(path)
    return seen.get["n"]


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def split_rejects(rows: DataFrame, good: str, reject_path: str) -> DataFrame:
    """The rows that meet the condition `good`; the others go to reject_path. The rows are computed once, and held in shared storage for both."""
    held = cut(rows.withColumn("_good", F.coalesce(F.expr(good), F.lit(False))))
    held.filter("not _good").drop("_good").write.mode("append").parquet(reject_path)
    return held.filter("_good").drop("_good")


def alert(failed: int, total: int, webhook: str | None, post: Callable[[str, bytes], None] | None = None) -> bool:
    """Posts a message if the error rate calls for one and a webhook is set; whether it was sent. A network failure is none of the run's."""
    rate = 100 * failed / total if total > 0 else 0.0
    if rate < ALERT or not webhook:
        return False
    body = json.dumps({"text": f"{failed} of {total} failed ({rate:.1f} %)"}).encode()
    try:
        (post or _post)(webhook, body)
    except OSError:
        return False
    return True


def _post(url: str, body: bytes) -> None:
    urllib.request.urlopen(urllib.request.Request(url, body, {"Content-Type": "application/json"}), timeout=10).close()
