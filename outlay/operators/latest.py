"""Keep the latest row of each key."""

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outlay.sources.scratch import new_table_path

_HASH = "_key_hash"


def _newest_first(order: list[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in order]


def keep_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that is greatest by ``order``, NULLs counting as smallest.

    The filter on rank 1 lets Spark trim every map task to one row per key before the shuffle, so
    a key that holds a third of the table does not arrive as one oversized group.
    """
    newest = Window.partitionBy(*keys).orderBy(*_newest_first(order))
    rank = "_rank"
    return df.withColumn(rank, F.row_number().over(newest)).filter(F.col(rank) == 1).drop(rank)


def keep_latest_max_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same rows as :func:`keep_latest`, found by an aggregate with map-side combine."""
    rest = [name for name in df.columns if name not in keys]
    winner = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(winner.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def latest_state(latest: DataFrame, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Latest rows, one per key, as a table in ``buckets`` by key, at ``path`` or in the shared folder.

    It is read as :func:`merge_latest` needs it: without a shuffle, however large it has grown.
    """
    spark = latest.sparkSession
    name = f"latest_{uuid.uuid4().hex}"
    (
        latest.withColumn(_HASH, F.xxhash64(*keys))
        .repartition(buckets, _HASH)
        .write.bucketBy(buckets, _HASH)
        .sortBy(_HASH)
        .option("path", path or new_table_path(spark, "state"))
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name)


def merge_latest(state: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key of ``state`` (:func:`latest_state`) and of ``rows`` that came since.

    Of rows that are equal by ``order`` the new one stays. Only the new rows are shuffled, to the
    state's buckets, one row per key; NULL keys are keys like any other. The result is what
    :func:`keep_latest` gives for all rows ever, and can be the next state.
    """
    columns = [c for c in state.columns if c != _HASH]
    new = keep_latest(rows.select(*columns), keys, order).withColumn(_HASH, F.xxhash64(*keys))
    new = new.select(*[F.col(c).alias(f"_new_{c}") for c in new.columns])
    same = state[_HASH] == F.col(f"_new_{_HASH}")
    for key in keys:
        # Written without an equality, which would become a join key that the buckets do not have.
        both = F.col(key).isNull() & F.col(f"_new_{key}").isNull()
        differ = (F.col(key) < F.col(f"_new_{key}")) | (F.col(key) > F.col(f"_new_{key}"))
        same = same & (both | ~F.coalesce(differ, F.lit(True)))
    joined = state.join(new, same, "full_outer")
    as_new = F.struct(*[F.col(f"_new_{c}") for c in order]) >= F.struct(*order)
    takes_new = state[_HASH].isNull() | (F.col(f"_new_{_HASH}").isNotNull() & as_new)
    return joined.select(*[F.when(takes_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns])
