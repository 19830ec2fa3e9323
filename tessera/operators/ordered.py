"""Order across tasks: ranks, running values and as-of joins in which a key of any size is many blocks.

Rows are dealt by range and sorted, so a block is a task's share of the order whatever the keys are. Each block is
summed up on its own, the sums (a row for each key of a block) are scanned, and what came before is added to each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.shared import cut

#: Rows of a key that one task takes in its stride; with more in any key, work goes by blocks.
HOT = 2_000_000
_BEFORE = (Window.unboundedPreceding, -1)


def blocks(rows: DataFrame, by: list[Column], n: int | None = None) -> DataFrame:
    """rows with _block and _pos: dealt by range and sorted by `by`, held in shared storage (a range is sampled, so it must not be dealt twice)."""
    n = n or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    return cut(at).select(*(f"`{c}`" for c in rows.columns), F.shiftright("_at", 33).cast("int").alias("_block"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_pos"))


def ranked(rows: DataFrame, by: list[Column], n: int | None = None, out: str = "rank") -> DataFrame:
    """rows with their places from 1 in the whole order, without a task that sees them all; the blocks' sizes alone are summed up."""
    own = blocks(rows, by, n)
    sizes = own.groupBy(F.col("_block").alias("_of")).agg(F.count("*").alias("_n"))
    before = sizes.select("_of", F.coalesce(F.sum("_n").over(Window.orderBy("_of").rowsBetween(*_BEFORE)), F.lit(0)).alias("_before"))
    return own.join(before, F.col("_block") == F.col("_of")).withColumn(out, F.col("_before") + F.col("_pos") + 1).drop("_block", "_pos", "_of", "_n", "_before")


_KINDS = {"max": (F.max, F.greatest), "min": (F.min, F.least), "last": (lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a)), "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b))}


def has_hot(rows: DataFrame, key: list[str], hot: int = HOT) -> bool:
    """Whether a key has `hot` rows or more; counts are combined before they're shuffled."""
    return not rows.groupBy(*key).count().filter(F.col("count") >= hot).isEmpty()


def running(rows: DataFrame, key: list[str], by: list[Column], values: dict[str, tuple[str, Column]], n: int | None = None, inclusive: bool = False, hot: int = HOT) -> DataFrame:
    """rows with a running value of each key in the order of `by`: values has name: (max, min, last or sum, column), over the rows before (inclusive: and the row's own); nulls are passed over.

    Null keys are one key. The order among rows that are alike in `by` is free but the same for all values. Where no
    key has `hot` rows, a window for each key does; else the keys are split, with the same result.
    """
    end = 0 if inclusive else -1
    if not has_hot(rows, key, hot):
        w = Window.partitionBy(*key).orderBy(*by).rowsBetween(Window.unboundedPreceding, end)
        return rows.select("*", *(_KINDS[kind][0](c).over(w).alias(name) for name, (kind, c) in values.items()))
    held = rows.select("*", *(c.alias(f"_v_{name}") for name, (_, c) in values.items()))
    own = blocks(held, [*map(F.col, key), *by], n)
    mine = Window.partitionBy(*key, "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, end)
    inner = own.select("*", *(_KINDS[kind][0](F.col(f"_v_{name}")).over(mine).alias(f"_i_{name}") for name, (kind, _) in values.items()))

    def total(kind: str, name: str) -> Column:
        v = F.col(f"_v_{name}")  # the last one by place, for an aggregate sees rows in no order
        return F.max_by(v, F.when(v.isNotNull(), F.col("_pos"))) if kind == "last" else _KINDS[kind][0](v)

    sums = own.groupBy(*key, "_block").agg(*(total(kind, name).alias(f"_s_{name}") for name, (kind, _) in values.items()))
    earlier = Window.partitionBy(*key).orderBy("_block").rowsBetween(*_BEFORE)  # a row a block
    carried = sums.select(*(F.col(k).alias(f"_k_{k}") for k in key), F.col("_block").alias("_of"), *(_KINDS[kind][0](F.col(f"_s_{name}")).over(earlier).alias(f"_c_{name}") for name, (kind, _) in values.items()))
    same = F.col("_block") == F.col("_of")
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    both = inner.join(carried.filter(" or ".join(f"_c_{name} is not null" for name in values)), same, "left")
    return both.select(*(f"`{c}`" for c in rows.columns), *(_KINDS[kind][1](F.col(f"_c_{name}"), F.col(f"_i_{name}")).alias(name) for name, (kind, _) in values.items()))


def asof(left: DataFrame, right: DataFrame, key: list[str], time: str, columns: list[str], forward: bool = False, n: int | None = None, hot: int = HOT) -> DataFrame:
    """left with `columns` of the last row of right (of the same key) at or before its time; forward: the first at or after it; nulls where there is none.

    Both sides are put in one order and the last value is carried along, so that no hot key meets in one task. Rows of
    right without a time are passed over; rows of left without one get nulls. Of rows of right at one time the one with
    the largest columns comes last (forward: the smallest comes first).
    """
    value = F.struct(*(F.col(c) for c in columns))
    theirs = right.filter(F.col(time).isNotNull()).select(*key, F.col(time).alias("_t"), value.alias("_given"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    ours = left.select(*key, F.col(time).alias("_t"), F.lit(None).cast(theirs.schema["_given"].dataType).alias("_given"), F.struct("*").alias("_row"))
    side = F.col("_row").isNotNull().cast("int")
    order = [F.col("_t").desc_nulls_first(), side.asc(), F.col("_given").desc()] if forward else [F.col("_t").asc_nulls_first(), side.asc(), F.col("_given").asc()]
    out = running(theirs.unionByName(ours), key, order, {"_found": ("last", F.col("_given"))}, n, hot=hot).filter("_row is not null")
    return out.select(*(F.col(f"_row.`{c}`").alias(c) for c in left.columns), *(F.col(f"_found.`{c}`").alias(c) for c in columns))
