"""Documents packed into sequences of a fixed length by minimum bin slack."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import arrow_rows, staged, text_of
from outlay.llm.tokens import KNOWN, crc, encoder

LENGTH = 1024
GROUP = 4096  # documents whose ends are packed together
ROWS_AT_ONCE = 256


def fullest(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """How many items of each length fill a window closest to ``capacity``.

    ``lengths`` descend; the longest item left is always in the window, which keeps the hard ones
    from being left over. Subset sums are a bitset: bit ``s`` is set if some multiset of items
    reaches ``s``. Items come in, length by length and one by one, until the capacity itself is
    reached or nothing is left; walking the saved bitsets backwards tells how many of each were used.
    """
    used = np.zeros(len(lengths), np.int64)
    left = np.flatnonzero(counts)
    first = left[0]
    room = capacity - int(lengths[first])
    used[first] = 1
    mask, reach = (1 << (room + 1)) - 1, 1
    saved: list[tuple[int, int]] = []  # the item's place, the sums reachable before it
    for i in left[np.searchsorted(-lengths[left], -room) :]:
        size = int(lengths[i])
        for _ in range(min(int(counts[i]) - int(used[i]), room // size)):
            grown = reach | (reach << size) & mask
            if grown == reach:
                break
            saved.append((i, reach))
            reach = grown
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    for i, before in reversed(saved):
        if not before >> total & 1:
            used[i] += 1
            total -= int(lengths[i])
    return used


def windows(sizes: np.ndarray, capacity: int = LENGTH) -> list[list[int]]:
    """Places in ``sizes`` (each 1 to ``capacity``) put into windows, every place in one of them."""
    order = np.argsort(-sizes, kind="stable")
    lengths, starts, counts = np.unique(-sizes[order], return_index=True, return_counts=True)
    lengths, counts, at = -lengths, counts.copy(), starts.copy()
    out, left = [], len(sizes)
    while left:
        used = fullest(lengths, counts, capacity)
        window = []
        for i in np.flatnonzero(used):
            window += order[at[i] : at[i] + used[i]].tolist()
        at += used
        counts -= used
        left -= len(window)
        out.append(window)
    return out


TOKENIZED = "doc_id string, doc_tokens bigint, crcs array<bigint>"
PIECES = (
    "doc_id string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", known: int = KNOWN
) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences of ``LENGTH`` ids.

    A document's ids are those of its text (null: none) and ``end_id``. It is cut every ``LENGTH``
    ids; full pieces are sequences of their own, and the ends, shorter than that, are packed by
    :func:`windows`. Columns: ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``. Keys may be null or repeat: every row is packed for itself. Other
    columns are ignored; an empty table gives no rows.

    Ends meet in groups of about ``GROUP`` documents, dealt by a hash of the row, so a group's work
    and its one unfilled window are bounded and any number of groups run side by side. Only counts
    and checksums are shuffled, no ids. ``known``: pieces of text whose ids a process keeps
    (:class:`tokens.Encoder`), which decides memory and time and nothing else.
    """
    id_type = docs.schema[key].dataType.simpleString()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer, known)
        for batch in arrow_rows(batches, ROWS_AT_ONCE, keeps=True):
            sizes, crcs = [], []
            for ids in tokens.ids(batch.column("text").to_pylist()):
                ids = np.append(ids, end_id)
                sizes.append(len(ids))
                crcs.append([crc(ids[i : i + LENGTH]) for i in range(0, len(ids), LENGTH)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64()))],
                ["doc_id", "doc_tokens", "crcs"],
            )

    done = staged(
        docs.select(F.col(key).cast("string").alias("doc_id"), text_of("text").alias("text")).mapInArrow(
            tokenize, TOKENIZED
        ),
        "tokenized",
    )
    groups = -(-done.count() // GROUP)

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["grp"].iloc[0])
        total = rows["doc_tokens"].to_numpy(np.int64)
        full, rest = total // LENGTH, total % LENGTH
        # full pieces first, each a sequence of its own
        owner = np.repeat(np.arange(len(rows)), full)
        start = (np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)) * LENGTH
        number, offset = np.arange(len(owner)), np.zeros(len(owner), np.int64)
        length = np.full(len(owner), LENGTH)
        ends = np.flatnonzero(rest)
        parts = [(owner, start, length, number, offset)]
        for sequence, window in enumerate(windows(rest[ends]), len(owner)):
            item = ends[window]
            size = rest[item]
            parts.append(
                (item, full[item] * LENGTH, size, np.full(len(item), sequence),
                 np.cumsum(size) - size)
            )
        owner, start, length, number, offset = map(np.concatenate, zip(*parts, strict=True))
        crcs = rows["crcs"].to_numpy()
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy()[owner],
                "start": start,
                "length": length,
                "ids_crc32": [int(crcs[o][s // LENGTH]) for o, s in zip(owner, start, strict=True)],
                "doc_tokens": total[owner],
                "sequence_id": (group << 32) + number,
                "offset": offset,
            }
        )

    row = F.monotonically_increasing_id()  # of a written table: the same when a task runs again
    dealt = done.withColumn("grp", F.pmod(F.xxhash64("doc_id", row), F.lit(max(1, groups))))
    return (
        dealt.groupBy("grp")
        .applyInPandas(place, PIECES)
        .select(F.col("doc_id").cast(id_type).alias(key), *[x.split()[0] for x in PIECES.split(", ")][1:])
    )
