"""What the operators share: staged tables, measured joins, components of a graph, rows by key."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from outlay.operators.joins import fits_broadcast
from outlay.sources import scratch

# Largest lookup table, in measured bytes, that is sent to every executor.
SMALL_BYTES = 16 * 1024 * 1024
# Rows of two columns, such as the minima of a graph's nodes, that are sent to every executor.
FEW_ROWS = 1 << 16
# Rows handed to Python at a time, at most. A batch lies outside the heap of the executor and, once
# more, in its Python worker, so thousands of texts each for every task add up there.
BATCH_ROWS = 2000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

# What a worker process keeps from task to task, by :func:`kept`.
_KEPT: dict[Hashable, Any] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def measured(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """``df`` as a join's lookup side: sent to all executors if its measured size allows it, else
    merge-joined, where adaptive execution can split the partitions of a hot key."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df.hint("merge")


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def same_row(key: str = "doc_id", text: str = "text") -> list[Column]:
    """What tells documents apart: the id (null is an id of its own) and a hash of the text."""
    return [
        F.coalesce(F.col(key).cast("string"), F.lit("-")).alias("_id"),
        F.xxhash64(text_of(text)).alias("_text"),
    ]


def without(docs: DataFrame, dropped: DataFrame, repeats: DataFrame | None = None) -> DataFrame:
    """``docs`` without the rows whose key (:func:`same_row`) is in ``dropped``.

    ``repeats`` holds keys of documents that occur as several equal rows: one row of each stays.
    Columns are carried as one struct, so their names may be anything.
    """
    key, text = same_row()
    rows = docs.select(F.struct("*").alias("_row"), key, text)
    if repeats is None:
        return rows.join(measured(dropped), ["_id", "_text"], "left_anti").select("_row.*")
    gone = rows.join(measured(dropped.unionByName(repeats)), ["_id", "_text"], "left_anti")
    once = rows.join(measured(repeats), ["_id", "_text"], "left_semi").dropDuplicates()
    return gone.unionByName(once).select("_row.*")


def staged(df: DataFrame, name: str) -> DataFrame:
    """:func:`scratch.staged`, with at most ``BATCH_ROWS`` rows handed to Python at a time."""
    conf = df.sparkSession.conf
    before = conf.get(_BATCH_CONF)
    if 0 < int(before) <= BATCH_ROWS:
        return scratch.staged(df, name)
    conf.set(_BATCH_CONF, BATCH_ROWS)
    try:
        return scratch.staged(df, name)
    finally:
        conf.set(_BATCH_CONF, before)


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` makes, kept by this process for later tasks until one of another kind comes
    (:func:`arrow_rows`): workers are used again by all that a session runs."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Returns memory that is free but still held by this process, for tasks to come, to the system:
    beside idle workers, the executor and its other workers need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def arrow_rows(
    batches: Iterator[pa.RecordBatch], rows: int, keeps: bool = False
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``rows`` rows, so that long texts stay few at once.

    ``keeps``: what :func:`kept` holds stays, for tasks like this one. Other tasks drop it first and
    give free memory back when they have read their rows.
    """
    if not keeps and _KEPT:
        _KEPT.clear()
        give_back()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        batch = None  # else it is still there when the next one is read
    if not keeps:
        give_back()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the graph with edges (``a``, ``b``): rows (``node``, ``root``).

    ``root`` is the smallest node of the component; nodes are ordered values of one type. Alternating
    large-star and small-star steps: every edge is hung on the smallest neighbour seen, until each
    component is a star. Each step is a shuffled minimum, map-side first, and a join with it, which
    needs no shuffle where the minima are few; each is written to the shared folder, so neither
    lineage nor the driver grows with the graph.
    """
    a, b = F.col("a"), F.col("b")
    once = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now, mark = _marked(once, "edges")
    for _ in range(rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least, (nodes, _) = _marked(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
                                    .select("u", F.least("u", "m").alias("m")), "least")
        hung = (
            both.join(_few(least, nodes), a == F.col("u"))
            .where(b > a)
            .select(b.alias("a"), F.col("m").alias("b"))
            .where(a != b)
        )
        hung, hung_mark = _marked(hung, "large")
        least, (nodes, _) = _marked(hung.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "least")
        # as it was, and every node hung on one other: stars
        if hung_mark == mark and nodes == mark[0]:
            break
        rehung = hung.join(_few(least, nodes), a == F.col("u"))
        now, mark = _marked(
            rehung.where(b != F.col("m"))
            .select(b.alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .distinct(),
            "small",
        )
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(b.alias("node"), b.alias("root")).distinct()
    return now.select(a.alias("node"), b.alias("root")).unionByName(roots)


def _marked(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """``df`` written as by :func:`staged`, with its number of rows and a sum over their hashes, which
    the tasks that write it take."""
    seen = Observation()
    total = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    table = staged(df.observe(seen, F.count(F.lit(1)).alias("rows"), total.alias("hash")), name)
    return table, (seen.get["rows"], seen.get["hash"])


def _few(table: DataFrame, rows: int) -> DataFrame:
    """A join's side of two short columns: sent to all executors if it has few rows."""
    return F.broadcast(table) if rows <= FEW_ROWS else table.hint("merge")
