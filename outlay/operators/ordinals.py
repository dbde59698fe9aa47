"""Row numbers over data too large for one task.

``row_number()`` sends each window partition to one task: the whole table without partition keys,
a hot key with them. Here the table is range-sorted instead, which cuts it wherever the sort key
allows, and the sorted partitions are numbered from their lengths. The sorted table is written
out with each row's partition and place, so both uses of it see the same ones, also after an
executor is lost, and the lengths come from one column.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outlay.sources.scratch import staged

_PART, _POS, _OFFSET = "_part", "_pos", "_offset"
_POSITION_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id: row within partition


def _sorted_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    return staged(
        df.orderBy(*order).select(
            "*",
            F.spark_partition_id().alias(_PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias(_POS),
        ),
        "sorted",
    )


def global_rank(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Number all rows ``start, start + 1, ...`` by ``order``, which should leave no ties."""
    parts = _sorted_parts(df, order)
    # One row per sorted partition; its running total needs no partition keys.
    before = Window.partitionBy(F.lit(0)).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFFSET))
    )
    return (
        parts.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col(_OFFSET) + F.col(_POS) + F.lit(start))
        .drop(_PART, _POS, _OFFSET)
    )


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number()`` over ``keys`` by ``order``, with a hot key spread over many tasks.

    Rows are numbered inside each (sorted partition, key); only a key cut by a partition border
    needs an offset, so there are fewer offsets than sorted partitions.
    """
    parts = _sorted_parts(df, [*[F.col(k).asc_nulls_first() for k in keys], *order])
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(_PART, *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(_PART, *keys, F.sum("_n").over(earlier).alias(_OFFSET))
        .filter(F.col(_OFFSET).isNotNull())
    )
    local = Window.partitionBy(_PART, *keys).orderBy(_POS)
    numbered = parts.withColumn(name, F.row_number().over(local).cast("bigint"))
    r = offsets.select(*[F.col(c).alias(f"_r_{c}") for c in offsets.columns])
    same = F.col(_PART) == F.col(f"_r_{_PART}")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return numbered.join(F.broadcast(r), same, "left").select(
        *df.columns, (F.col(name) + F.coalesce(F.col(f"_r_{_OFFSET}"), F.lit(0))).alias(name)
    )
