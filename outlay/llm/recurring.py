"""Records whose key occurs again, found by packed arrays in buckets of keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import arrow_rows, give_back
from outlay.llm.shingles import mix

ROWS_AT_ONCE = 256
PACKED_TOGETHER = 500_000  # records a task packs at a time
BUCKET_BYTES = 16 << 20  # records of a bucket

_ARROW = {"u": pa.int64(), "i": pa.int32(), "b": pa.bool_()}
_SQL = {"u": "bigint", "i": "int", "b": "boolean"}

# What a record is to the bucket of its key: one to be counted; one to be counted whose key is known
# to occur again; one that is only passed on.
COUNTED, KNOWN, PASSED = 0, 1, 2


def _distinct(records: np.ndarray, fields: list[str]) -> np.ndarray:
    """Records in order of the fields, of those equal in all of them the one with the highest kind."""
    records = records[np.lexsort([records[f] for f in reversed([*fields, "kind"])])]
    last = np.ones(len(records), bool)
    differ = np.zeros(max(0, len(records) - 1), bool)
    for f in fields:
        differ |= records[f][1:] != records[f][:-1]
    last[:-1] = differ
    return records[last]


def _heads(key: np.ndarray) -> np.ndarray:
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.flatnonzero(new)


def recurring(
    rows: DataFrame, columns: list[str], records: Callable[[pa.RecordBatch], np.ndarray], dtype: list,
    identity: list[str], size: int, sure: str | None = None,
) -> DataFrame:
    """The records that ``records`` makes from batches of ``rows`` and whose ``key`` several of them
    have, as rows with the fields of ``dtype`` (unsigned 64 bits become bigint).

    The first field is ``key``; records equal in ``identity`` count as one, though they may come back
    as several rows. ``size`` is the number of records expected, which decides how many buckets there
    are and nothing else. Records for which the field ``sure`` is true count as recurring.

    A task packs half a million records at a time. Of a key that occurs again among those, one
    record goes to the bucket of the key and the others, known to recur, to buckets by their other
    fields; so a bucket gets at most one record of a hot key from each packing.
    """
    whole = np.dtype([*dtype, ("kind", "u1")])
    buckets = max(8, -(-size * whole.itemsize // BUCKET_BYTES))

    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        found = np.zeros(sum(map(len, parts)), whole)
        for f, _ in dtype:
            found[f] = np.concatenate([p[f] for p in parts])
        found = _distinct(found, identity)
        heads = _heads(found["key"])
        sizes = np.diff(np.append(heads, len(found)))
        found["kind"] = np.where(np.repeat(sizes, sizes) > 1, PASSED, COUNTED)
        found["kind"][heads[sizes > 1]] = KNOWN
        if sure:
            found["kind"][found[sure] & (found["kind"] == COUNTED)] = KNOWN
        spread = found["key"].copy()
        passed = found["kind"] == PASSED
        for f in identity[1:]:
            spread[passed] = mix(spread[passed] ^ found[f][passed].astype(np.uint64))
        bucket = (mix(spread) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        found, bucket = found[order], bucket[order]
        cuts = _heads(bucket)
        data = [found[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(found)), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts]), pa.array(data, pa.binary())], ["bucket", "data"]
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            parts.append(records(batch))
            if sum(map(len, parts)) >= PACKED_TOGETHER:
                yield packed(parts)
                parts = []
        if sum(map(len, parts)):
            yield packed(parts)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = b"".join(x for b in batches for x in b.column("data").to_pylist())
        found = _distinct(np.frombuffer(data, whole), identity)
        counted = np.flatnonzero(found["kind"] != PASSED)
        heads = _heads(found["key"][counted])
        sizes = np.diff(np.append(heads, len(counted)))
        keep = found["kind"] != COUNTED
        keep[counted[np.repeat(sizes, sizes) > 1]] = True
        found = found[keep]
        for at in range(0, len(found), 100_000):
            part = found[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[f].view(np.int64) if part[f].dtype.kind == "u" else part[f],
                          _ARROW[part[f].dtype.kind]) for f, _ in dtype],
                [f for f, _ in dtype],
            )
        del data, found, counted, heads, sizes, keep
        give_back()

    schema = ", ".join(f"{f} {_SQL[np.dtype(t).kind]}" for f, t in dtype)
    return (
        rows.select(*columns)
        .mapInArrow(pack, "bucket int, data binary")
        .repartition(buckets, "bucket")
        .mapInArrow(again, schema)
    )
