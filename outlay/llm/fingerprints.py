"""Context-triggered piecewise fingerprints of texts and their likeness."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import arrow_rows, staged, text_of

SIGNATURE = 64  # chunks of a signature at most
WINDOW = 8  # bytes the rolling hash sees
COMMON = 4  # signatures without a common run of so many chunks are unlike by chance
ROWS_AT_ONCE = 128
ALPHABET = np.frombuffer(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8
)


def _random(n: int, seed: int) -> np.ndarray:
    """``n`` well-mixed 64-bit numbers, the same everywhere."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_ROLL = _random(256, 1).astype(np.uint32)
_CHUNK = _random(256, 2)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def rolling(data: np.ndarray) -> np.ndarray:
    """At every byte, a hash of it and the ``WINDOW - 1`` bytes before (none before the first)."""
    h = _ROLL[data]
    factor, width = 0x01000193, 1
    while width < WINDOW:  # a hash of twice as many bytes from two of half as many
        h[width:] += h[:-width] * np.uint32(factor)
        factor, width = factor * factor % 2**32, 2 * width
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(12))


def _signature(cuts: np.ndarray, sums: np.ndarray, n: int) -> str:
    """One letter a chunk. ``sums[i]`` is the running sum that a chunk's hash is a difference of."""
    ends = cuts + 1
    if not len(ends) or ends[-1] < n:
        ends = np.append(ends, n)
    starts = np.concatenate(([0], ends[:-1]))
    # the sums weigh byte i with base^i; dividing by base^start makes the chunk's place irrelevant
    value = (sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return ALPHABET[(value >> np.uint64(58)).astype(np.intp)].tobytes().decode()


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64 or more of them, kept for the next texts."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(1 << 17, 2 * n), base, np.uint64)
        factors[0] = 1
        known = _POWERS[base] = np.cumprod(factors)
    return known


def parts(text: str) -> tuple[int, str, str]:
    """Block size, signature at the block size, signature at twice the block size.

    The block size is the smallest power of two at which the cuts found in the text make
    ``SIGNATURE`` chunks or fewer, so every part of the text has its letter.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    if not n:
        return 1, "", ""
    h = rolling(data)
    # cuts by the largest block size that still has them, then their number by block size
    cut = np.bitwise_count(~h & (h - np.uint32(1)))
    found = np.cumsum(np.bincount(cut, minlength=33)[::-1])[::-1]
    chunks = found + (cut[-1] < np.arange(33))  # and what follows the last cut
    level = int(np.flatnonzero(chunks[:31] <= SIGNATURE)[0]) if (chunks[:31] <= SIGNATURE).any() else 30
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CHUNK[data] * _powers(_BASE, n)[:n], out=sums[1:])
    one = np.flatnonzero((h & np.uint32((1 << level) - 1)) == 0)
    two = one[(h[one] & np.uint32((1 << (level + 1)) - 1)) == 0]
    return 1 << level, _signature(one, sums, n), _signature(two, sums, n)


def fingerprint(text: str | None) -> str:
    """``blocksize:signature:signature at twice the block size``; equal texts have equal ones."""
    return "{}:{}:{}".format(*parts(text or ""))


def _signature_likeness(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 without a common run of ``COMMON`` chunks."""
    longest = F.greatest(F.length(a), F.length(b))
    run = F.least(F.lit(COMMON), F.length(a), F.length(b))
    places = F.sequence(F.lit(1), F.greatest(F.length(a) - run + 1, F.lit(1)))
    grams = F.transform(places, lambda i: F.substring(a, i, run))
    common = F.exists(grams, lambda gram: F.contains(b, gram))
    return F.when(longest == 0, 1.0).otherwise(
        F.when(common, 1 - F.levenshtein(a, b) / longest).otherwise(0.0)
    )


def likeness(a: Column, b: Column) -> Column:
    """Likeness, 0 to 1, of two fingerprints: by edit distance at the block sizes they share.

    Block sizes more than a factor of two apart are not compatible: 0. Equal fingerprints: 1.
    """
    pa_, pb = F.split(a, ":"), F.split(b, ":")
    ba, bb = pa_[0].cast("bigint"), pb[0].cast("bigint")
    same = F.greatest(_signature_likeness(pa_[1], pb[1]), _signature_likeness(pa_[2], pb[2]))
    return (
        F.when(a == b, 1.0)
        .when(ba == bb, same)
        .when(ba == 2 * bb, _signature_likeness(pa_[1], pb[2]))
        .when(bb == 2 * ba, _signature_likeness(pa_[2], pb[1]))
        .otherwise(0.0)
    )


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


ROW = (
    "doc_id {id}, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, next_fingerprint string, edge int, part int, text string"
)
FIRST, LAST = 1, 2  # edges: the row is the first or the last of its partition


def _row(key: object, text: str, own: str, following: str, next_print: str) -> list:
    changed = edited(text, following)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return [key, len(text), sha, own, own if changed == text else fingerprint(changed), next_print]


def edit_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: how like its fingerprint is to that of its edited text and to the next.

    The edited text is :func:`edited` with the next document in ascending order of ``key`` (nulls
    first, repeated keys in an order fixed by their texts); after the last comes the first, also
    where it is the only one. Null texts are empty. Columns: ``key``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``;
    other columns are ignored, and an empty table gives no rows.

    The documents are sorted once into ranges of the key, and every task looks one row ahead. Only
    the last document of a range has its successor elsewhere: first and last texts, two a
    partition, are set aside and paired in a second, small step.
    """
    id_type = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    ranges = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions(
        "doc_id", "_hash", "text"
    )
    schema = ROW.format(id=id_type.simpleString())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kinds = TaskContext.get().partitionId(), None
        held = None  # the row that waits for its successor: key, text, fingerprint
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            kinds, out = batch.schema.field("doc_id").type, []
            for k, t in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                own = held[2] if held and held[1] == t else fingerprint(t)
                if held is None:
                    out.append([k, None, None, own, None, None, FIRST, part, t])
                else:
                    out.append(_row(*held, t, own) + [None, None, None])
                held = (k, t, own)
            yield _made(out, kinds)
        if held is not None:
            yield _made([[held[0], None, None, held[2], None, None, LAST, part, held[1]]], kinds)

    done = staged(
        ranges.select("doc_id", "text").mapInArrow(walk, schema), "fingerprints"
    )

    def join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            out = [
                _row(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_fp"])
                + [None, None, None]
                for r in batch.to_pylist()
            ]
            yield _made(out, batch.schema.field("doc_id").type)

    # One row per partition: its range's first document, and which partition comes after it.
    edges = done.where(F.col("edge").isNotNull())
    numbers = edges.where(F.col("edge") == FIRST).select("part")
    order = (
        numbers.agg(F.array_sort(F.collect_list("part")).alias("all"))
        .select("all", F.size("all").alias("n"), F.posexplode("all").alias("i", "part"))
        .select("part", F.element_at("all", (F.col("i") + 1) % F.col("n") + 1).alias("after"))
    )
    firsts = edges.where(F.col("edge") == FIRST).select(
        F.col("part").alias("after"), F.col("text").alias("next_text"),
        F.col("fingerprint").alias("next_fp"),
    )
    lasts = (
        edges.where(F.col("edge") == LAST)
        .select("doc_id", "text", "fingerprint", "part")
        .join(order, "part")
        .join(firsts, "after")
        .select("doc_id", "text", "fingerprint", "next_text", "next_fp")
        .mapInArrow(join_edges, schema)
    )
    return (
        done.where(F.col("edge").isNull())
        .unionByName(lasts)
        .select(
            F.col("doc_id").alias(key),
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        )
    )


def _made(rows: list[list], key_type: pa.DataType) -> pa.RecordBatch:
    s, i = pa.string(), pa.int32()
    kinds = [key_type, pa.int64(), s, s, s, s, i, i, s]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "next_fingerprint", "edge", "part", "text"]
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names
    )
