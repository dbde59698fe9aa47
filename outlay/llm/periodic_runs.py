"""Words that repeat with a period, found while a text grows: catchers over dyadic blocks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import arrow_rows, text_of
from outlay.llm.shingles import mix

LEAST_LENGTH = 6  # words of a run, at least
LEAST_PERIODS = 4  # periods of a run, at least
ROWS_AT_ONCE = 128
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

Run = tuple[int, int, int]  # start, length, smallest period


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


class Catchers:
    """Runs of a sequence of numbers that is appended to.

    For every power of two, each completed block of that size is a catcher: it waits for the same
    words at a distance of one to two block sizes. Of each size there is exactly one block at such a
    distance from the suffix that ends with a new word, so an appended word costs one comparison
    (of hashes) a size. A suffix equal to its block, with the words between them, is the beginning
    of a square whose period is their distance; squares that go on from block to block are caught
    once, compared word by word as far as they reach, and merged into runs of one period. A run of
    ``LEAST_PERIODS`` (three or more) periods holds a whole block of its size with its repetition,
    so none is missed, however the sequence was cut for appending.
    """

    def __init__(self, longest: int | None = None):
        self.longest = longest  # no run is longer than this; None: not known
        self.words = np.zeros(0, np.int64)
        self._sums = np.zeros(1, np.uint64)
        self._inverse = np.zeros(0, np.uint64)
        self._ends: dict[tuple[int, int], int] = {}  # by start and period
        self._pending: set[tuple[int, int]] = set()  # caught, too short as yet
        self._cover_end = np.zeros(0, np.int64)
        self._cover_period = np.zeros(0, np.int64)

    def append(self, words: np.ndarray) -> None:
        old, n = len(self.words), len(self.words) + len(words)
        self.words = np.concatenate((self.words, np.asarray(words, np.int64)))
        self._inverse = _powers(_INVERSE, n)
        terms = mix(self.words[old:].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n)[old:]
        self._sums = np.concatenate((self._sums, self._sums[-1] + np.cumsum(terms)))
        grown = np.zeros(len(words), np.int64)
        self._cover_end = np.concatenate((self._cover_end, grown))
        self._cover_period = np.concatenate((self._cover_period, grown))
        for (start, period), end in list(self._ends.items()):
            if end == old:  # it may go on
                self._ends[start, period] = self._right(end, period)
        for at, period in sorted(self._pending, key=lambda x: x[1]):
            self._pending.discard((at, period))
            self._extend(at, period)
        size = 1
        while 2 * size <= n and (self.longest is None or LEAST_PERIODS * size <= self.longest):
            for at, period in self._caught(old, size):
                self._extend(at, period)
            size *= 2

    def _hash(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self._sums[at + size] - self._sums[at]) * self._inverse[at]

    def _caught(self, old: int, size: int) -> list[tuple[int, int]]:
        """Blocks of ``size`` that a suffix ending with a new word is equal to, and the distance."""
        n = len(self.words)
        at = np.arange(max(size, old - size + 1), n - size + 1)
        if not len(at):
            return []
        block = (at - size) // size * size
        firsts = np.arange(block[0], block[-1] + 1, size)
        same = self._hash(at, size) == self._hash(firsts, size)[(block - block[0]) // size]
        begins = same.copy()
        begins[size:] &= ~same[:-size]  # the block before was caught at this distance
        found = np.flatnonzero(begins)
        block, period = block[found], at[found] - block[found]
        # multiples of the period of a run that is known already
        q, end = self._cover_period[block], self._cover_end[block]
        known = (q > 0) & (q <= size) & (end >= block + period + size)
        known[known] = period[known] % q[known] == 0
        block, period = block[~known], period[~known]
        # the first block of a run is followed by three periods of it
        whole = block + 3 * period <= n
        self._pending |= set(zip(block[~whole].tolist(), period[~whole].tolist(), strict=True))
        block, period = block[whole], period[whole]
        cube = self._hash(block, 2 * period) == self._hash(block + period, 2 * period)
        return list(zip(block[cube].tolist(), period[cube].tolist(), strict=True))

    def _extend(self, at: int, period: int) -> None:
        end = self._right(at + period, period)
        start = self._left(at, period)
        if (start, period) in self._ends:
            return
        if end - start >= max(LEAST_LENGTH, LEAST_PERIODS * period):
            self._ends[start, period] = end
            free = self._cover_period[start:end] == 0
            self._cover_period[start:end][free] = period
            self._cover_end[start:end][free] = end
        elif end == len(self.words):
            self._pending.add((at, period))

    def _right(self, at: int, period: int) -> int:
        """The first place from ``at`` on whose word differs from that a period before."""
        words, n, step = self.words, len(self.words), 32
        while at < n:
            stop = min(n, at + step)
            other = np.flatnonzero(words[at:stop] != words[at - period : stop - period])
            if len(other):
                return at + int(other[0])
            at, step = stop, 2 * step
        return n

    def _left(self, at: int, period: int) -> int:
        """How far before ``at`` every word is the same as that a period after."""
        words, step = self.words, 32
        while at > 0:
            stop = max(0, at - step)
            other = np.flatnonzero(words[stop:at] != words[stop + period : at + period])
            if len(other):
                return stop + int(other[-1]) + 1
            at, step = stop, 2 * step
        return 0

    def runs(self) -> list[Run]:
        """All runs so far, by start, then period. One and the same stretch has its smallest period:
        with four periods in it, every other period of it is a multiple of that."""
        least: dict[tuple[int, int], int] = {}
        for (start, period), end in self._ends.items():
            least[start, end] = min(period, least.get((start, end), period))
        return sorted(((a, b - a, q) for (a, b), q in least.items()), key=lambda r: (r[0], r[2]))


Edit = Callable[[object, list[bytes]], list[bytes]]


def _numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words as one sequence of numbers, equal for equal words, with a number of its own
    after each text; and where each text begins."""
    known: dict[bytes, int] = {}
    for words in texts:
        known |= dict.fromkeys(words, 0)
    known = {w: i for i, w in enumerate(known)}
    get, ends = known.__getitem__, len(known)
    out: list[int] = []
    firsts = []
    for i, words in enumerate(texts):
        firsts.append(len(out))
        out.extend(map(get, words))
        out.append(ends + i)
    return np.array(out, np.int64), np.array(firsts, np.int64)


def _kept(words: list[bytes], runs: list[Run]) -> list[bytes]:
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def word_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Edit | None = None
) -> DataFrame:
    """One row per document: ``key``, ``n_words``, ``runs`` (structs of ``start``, ``length`` and
    ``period`` in words, by start, then period), ``collapsed`` (the words with every run cut to its
    first period, joined by single spaces).

    Words are what stands between ASCII white space, compared byte by byte. A run is a stretch of
    words with a smallest period q (words q apart are equal) of at least ``LEAST_LENGTH`` words and
    ``LEAST_PERIODS`` periods that neither neighbouring word continues. ``edit`` may replace a
    document's words, given its key, before they are searched. Null, empty and blank texts have no
    words, no runs and an empty ``collapsed``; rows that repeat give the same row again; other
    columns are ignored, whatever their names; an empty table gives no rows.

    Documents are independent of one another: no shuffle, and the work of a task is in proportion to
    its words times the logarithm of the longest text. A slice of documents is one sequence for
    :class:`Catchers`, with a word between them that occurs nowhere else.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"_key {kind}, n_words bigint, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    run_type = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            texts = [t.encode("utf-8", "surrogatepass").split() for t in batch.column("_text").to_pylist()]
            if edit:
                texts = [edit(k, t) for k, t in zip(batch.column("_key").to_pylist(), texts, strict=True)]
            numbers, firsts = _numbers(texts)
            catchers = Catchers(longest=max(map(len, texts), default=0))
            catchers.append(numbers)
            runs: list[list[Run]] = [[] for _ in texts]
            found = catchers.runs()
            owners = np.searchsorted(firsts, [r[0] for r in found], side="right") - 1
            for owner, (start, length, period) in zip(owners.tolist(), found, strict=True):
                runs[owner].append((start - int(firsts[owner]), length, period))
            collapsed = [
                b" ".join(_kept(t, r) if r else t).decode("utf-8", "surrogatepass")
                for t, r in zip(texts, runs, strict=True)
            ]
            rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(rows, run_type), pa.array(collapsed, pa.string())],
                ["_key", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    return rows.mapInArrow(find, schema).withColumnRenamed("_key", key)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as whole numbers; of ties the first."""
    return F.aggregate(
        runs,
        F.get(runs, 0),
        lambda best, r: F.when(
            r["length"] * best["period"] > best["length"] * r["period"], r
        ).otherwise(best),
    )


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, the strongest run and digests of what :func:`word_runs` found, a row per document."""
    lines = F.transform(
        "runs",
        lambda r: F.concat(
            F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]), F.lit("\n")
        ),
    )
    best = strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def repeat_some(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Of every tenth document, by the CRC-32 of its id, the words from some place on repeat with
    some period. A null id leaves its document as it is."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
