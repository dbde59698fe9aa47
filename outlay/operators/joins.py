"""Joins of a fact table with a lookup table whose size is measured first."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.sources.scratch import new_table_path

# Largest lookup table, in measured bytes, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

_SLOT = 16  # bytes counted per value besides the text itself


def _width(schema: T.StructType) -> Column:
    """Bytes of a row's values."""
    width = F.lit(_SLOT * len(schema)).cast("bigint")
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return width


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values, from one distributed aggregate over the lookup table."""
    return df.agg(F.sum(_width(df.schema))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return limit > 0 and measured_bytes(df) <= limit


def lookup_table(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` as a lookup table, and whether it is small enough to be sent to every executor.

    It is computed once: written to the shared folder, its bytes added up by the tasks that write it.
    With a limit of 0 nothing is written, and it is part of the plan that joins it.
    """
    if limit <= 0:
        return df, False
    spark, size = df.sparkSession, Observation()
    path = new_table_path(spark, "lookup")
    df.observe(size, F.sum(_width(df.schema)).alias("bytes")).write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return table, (size.get["bytes"] or 0) <= limit


def left_join(facts: DataFrame, lookup: DataFrame, on: Column, small: bool) -> DataFrame:
    """Left outer join that keeps every fact: broadcast if ``small``, else a shuffled merge join.

    The choice is spelled out either way. Spark's own estimate ignores how much an unrolled table
    grows and may broadcast one that is far too large. In the shuffled join, adaptive execution
    splits the partitions of hot keys; ``on`` must not compare columns that either side is already
    grouped by, or that side has no shuffle to split.
    """
    return facts.join(F.broadcast(lookup) if small else lookup.hint("merge"), on, "left")


def left_lookup(
    facts: DataFrame, lookup: DataFrame, on: Column, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """:func:`left_join` with a lookup table written once, and broadcast up to ``limit`` measured
    bytes."""
    table, small = lookup_table(lookup, limit)
    return left_join(facts, table, on, small)
