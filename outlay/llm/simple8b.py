"""Token ids as Simple-8b words in binary files, and their way back."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outlay.llm import binary_files
from outlay.llm.common import arrow_rows, staged, text_of
from outlay.llm.tokens import crc, encoder
from outlay.sources.scratch import new_table_path

# Ids in a word and bits of each, by selector 1..14. Selector 15 is the escape: the
# word after it is one id of up to 64 bits.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
BLOCK = 512  # ids a block; blocks are what is decoded side by side
MAGIC = b"S8B2"
# magic, partition, record in it, documents, those of them without an id (the first), ids, words
HEAD = struct.Struct("<4sIIQQQQ")
RECORD_IDS = 1 << 17  # ids after which a record ends; a document is never split
RECORDS_PER_FILE = 16
ROWS_AT_ONCE = 256


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the offset of every block's first word, for unsigned ids of up to 64 bits.

    Each word takes the selector that packs the most of the next ids. That choice is made for every
    place at once, from running maxima of the ids' widths; then all blocks step from word to word
    together. A word may reach past its block's end, over zeros that are not counted.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    blocks = -(-n // BLOCK)
    padded = np.zeros((blocks, BLOCK + int(COUNTS[0])), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = ids
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    width = np.zeros(padded.shape, np.int8)
    for bit in (32, 16, 8, 4, 2, 1):  # bit length, by halving
        high = (padded >> (width.astype(np.uint64) + np.uint64(bit))) > 0
        width += (high * bit).astype(np.int8)
    width += (padded > 0).astype(np.int8)
    chosen = np.full(padded.shape, ESCAPE, np.int8)
    most = {1: width}
    for s in range(len(COUNTS) - 1, -1, -1):  # later selectors hold more ids and overrule
        count, bits = int(COUNTS[s]), int(WIDTHS[s])
        top = _running_max(most, count)
        np.copyto(chosen, np.int8(s + 1), where=top <= bits)
    # all blocks step together
    steps = np.append(COUNTS, 1)
    where, row = np.zeros(blocks, np.int64), np.arange(blocks)
    starts, owners, selectors = [], [], []
    while len(row):
        s = chosen[row, where]
        starts.append(where)
        owners.append(row)
        selectors.append(s)
        where = where + steps[s - 1]
        live = where < BLOCK
        where, row = where[live], row[live]
    order = np.argsort(np.concatenate(owners), kind="stable")
    owner = np.concatenate(owners)[order]
    start, selector = np.concatenate(starts)[order], np.concatenate(selectors)[order]
    size = 1 + (selector == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = selector.astype(np.uint64) << np.uint64(60)
    for s in range(len(COUNTS)):
        at = np.flatnonzero(selector == s + 1)
        if len(at):
            take = padded[owner[at][:, None], start[at][:, None] + np.arange(COUNTS[s])]
            shift = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s])
            words[place[at]] |= np.bitwise_or.reduce(take << shift, axis=1)
    at = np.flatnonzero(selector == ESCAPE)
    words[place[at] + 1] = padded[owner[at], start[at]]
    offsets = place[np.searchsorted(owner, np.arange(blocks))]
    return words, offsets.astype(np.uint32)


def _running_max(most: dict[int, np.ndarray], count: int) -> np.ndarray:
    """Of each place and the ``count - 1`` after it in its row, by joining shorter runs."""
    if count not in most:
        half = max(c for c in most if c < count)
        first, second = most[half], most[half] if 2 * half >= count else None
        if second is None:  # the longest known run is shorter than half
            second = _running_max(most, count - half)
            shift = half
        else:
            shift = count - half
        joined = first.copy()
        np.maximum(first[:, :-shift], second[:, shift:], out=joined[:, :-shift])
        most[count] = joined
    return most[count]


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of :func:`encode`, all blocks at once: words of one selector together."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    # The word after an escape is data. Runs of such look-alikes are settled block by block.
    data = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == ESCAPE):
        if not data[at]:
            data[at + 1] = True
    lead = np.flatnonzero(~data)
    selector = selector[lead]
    count = np.append(np.append(0, COUNTS), 1)[selector]
    block = np.searchsorted(offsets, lead, side="right") - 1
    before = np.cumsum(count) - count
    first = np.searchsorted(lead, offsets)
    inside = before - before[first][block]
    out = np.zeros((len(offsets), BLOCK + int(COUNTS[0])), np.uint64)
    for s in range(len(COUNTS)):
        at = np.flatnonzero(selector == s + 1)
        if len(at):
            shift = np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s])
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            values = (words[lead[at]][:, None] >> shift) & mask
            out[block[at][:, None], inside[at][:, None] + np.arange(COUNTS[s])] = values
    at = np.flatnonzero(selector == ESCAPE)
    out[block[at], inside[at]] = words[lead[at] + 1]
    return out[:, :BLOCK].reshape(-1)[:n]


def record(part: int, number: int, keys: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One record: head, document ids, their counts, words, block offsets, without the last byte.

    Documents without an id come first; the head says how many they are.
    """
    unnamed = sum(key is None for key in keys)
    if any(key is None for key in keys[unnamed:]):
        raise ValueError("documents without an id come first")
    flat = np.concatenate(ids).astype(np.uint64)
    words, offsets = encode(flat)
    return b"".join(
        [
            HEAD.pack(MAGIC, part, number, len(keys), unnamed, len(flat), len(words)),
            np.array([0] * unnamed + keys[unnamed:], "<i8").tobytes(),
            np.array([len(x) for x in ids], "<u4").tobytes(),
            words.astype("<u8").tobytes(),
            offsets.astype("<u4").tobytes(),
        ]
    )


def records(content: bytes) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """Partition, number, document ids, counts and all ids of every record of a file."""
    at = 0
    while at < len(content):
        magic, part, number, docs, unnamed, n, n_words = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no record at {at}")
        at += HEAD.size
        fields = []
        blocks = -(-n // BLOCK)
        for kind, size in (("<i8", docs), ("<u4", docs), ("<u8", n_words), ("<u4", blocks)):
            fields.append(np.frombuffer(content, kind, size, at))
            at += fields[-1].nbytes
        keys, counts, words, offsets = fields
        if content[at : at + 1] != binary_files.END:
            raise ValueError("record of another length than announced")
        at += 1
        named = pa.array(keys, mask=np.arange(docs) < unnamed)
        yield part, number, named, counts, decode(words, offsets, n)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """The ids of every text of ``docs`` (``doc_id``, ``text``), ``end_id`` after each, in files
    under ``path``, in ascending order of ``doc_id``.

    Documents are sorted into ranges of ids (repeated ids by their texts); a range is a partition,
    whose number its records carry, so the order holds across files whatever their names. A null
    text has only the end id. Documents without ``doc_id`` come before all others, by their texts.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       text_of("text").alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    ranges = rows.repartitionByRange("doc_id", "_hash").sortWithinPartitions(
        "doc_id", "_hash", "text"
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        keys, ids, held = [], [], 0
        tokens = encoder(tokenizer)
        for batch in arrow_rows(batches, ROWS_AT_ONCE, keeps=True):
            found = tokens.ids(batch.column("text").to_pylist())
            for key, x in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                keys.append(key)
                ids.append(np.append(x, end_id))
                held += len(x) + 1
                if held >= RECORD_IDS:
                    yield _one(record(part, number, keys, ids))
                    keys, ids, held, number = [], [], 0, number + 1
        if keys:
            yield _one(record(part, number, keys, ids))

    packed = ranges.select("doc_id", "text").mapInArrow(pack, "record binary")
    binary_files.write(packed, "record", path, RECORDS_PER_FILE)


def _one(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["record"])


ROW = "part int, number int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrow_rows(batches, 1, keeps=True):
        content = batch.column("content")[0].as_py()
        for part, number, keys, counts, ids in records(content):
            counts = counts.astype(np.int64)
            ends = np.cumsum(counts)
            starts = ends - counts
            crcs = [crc(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
            size = len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, part, np.int32)), pa.array(np.full(size, number, np.int32)),
                 keys, pa.array(starts), pa.array(counts), pa.array(crcs, pa.int64())],
                ["part", "number", "doc_id", "before", "n_tokens", "ids_crc32"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """What the files under ``path`` hold, per document: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens``, ``ids_crc32``.

    Every file is decoded by itself. The place of a record follows from the ids of the records
    before it; that sum runs over one row a record, first inside a partition, then over partitions,
    and is joined back.
    """
    found = staged(binary_files.read(spark, path).mapInArrow(_unpack, ROW), "ids")
    sizes = staged(found.groupBy("part", "number").agg(F.sum("n_tokens").alias("ids")), "sizes")
    earlier = F.coalesce(
        F.sum("ids").over(
            Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    # one row per partition of the writer, however many documents there are
    below = F.coalesce(
        F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", below.alias("below"))
    places = (
        sizes.select("part", "number", earlier.alias("earlier"))
        .join(parts, "part")
        .select("part", "number", (F.col("below") + F.col("earlier")).alias("offset"))
    )
    return found.join(staged(places, "places"), ["part", "number"]).select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def through_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``docs`` written as files of ids in the shared folder and read back."""
    path = new_table_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(docs.sparkSession, path)
