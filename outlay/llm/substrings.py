"""Passages that documents share: paragraphs that are alike, and equal runs of words inside them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import SMALL_BYTES, arrow_rows, components, measured, same_row, staged, text_of
from outlay.llm.ngram_join import linked_sets
from outlay.llm.recurring import recurring
from outlay.llm.shingles import mix, rolled, shingle_sets, word_hashes
from outlay.sources.scratch import new_table_path, scope

WORDS = 5  # of a shingle
PERCENT = 80  # Jaccard similarity of paragraphs that count as one
BANDS, ROWS = 8, 3  # of a signature: 0.997 of all pairs at 0.8 share a band
CROWDED = 64  # paragraphs in a band of several clusters; larger ones are joined by prefixes
MIN_RUN = 20  # words of a passage, at least
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 256
TEXT_BYTES_A_RECORD = 40  # expected, for the number of buckets

_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
_FACTORS = mix(_SEEDS) | np.uint64(1)


class Windows:
    """All runs of ``MIN_RUN`` words of a batch of texts, whatever lines they stand in.

    The anchor of a window is the smallest hash of the ``WORDS``-word shingles in it. Windows in a
    row that share their anchor are one segment, about nine of them. Equal windows have one anchor,
    so only segments whose anchor occurs again can hold a window that does.
    """

    def __init__(self, texts: list[str]):
        words, owner, *_ = word_hashes(texts)
        n = max(0, len(words) - MIN_RUN + 1)
        least, width = rolled(words, WORDS), 1
        while n and width < MIN_RUN - WORDS + 1:
            step = min(width, MIN_RUN - WORDS + 1 - width)
            least, width = np.minimum(least[:-step], least[step:]), width + step
        at = np.flatnonzero(owner[:n] == owner[MIN_RUN - 1 :]) if n else np.zeros(0, np.int64)
        value = rolled(words, MIN_RUN)[at]
        self.anchor, owner_of = least[at], owner[at]
        new = np.ones(len(at), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (owner_of[1:] != owner_of[:-1])
        head = np.flatnonzero(new)
        self.size = np.diff(np.append(head, len(at)))
        self.owner, self.anchor = owner_of[head], self.anchor[head]
        self.word = at[head] - np.searchsorted(owner, self.owner)
        number = np.repeat(np.arange(len(head)), self.size)
        inner = mix((np.arange(len(at)) - head[number] + 1).astype(np.uint64))
        sums = np.add.reduceat(mix(value ^ inner), head) if len(at) else value
        self.segment = mix(sums)
        # segments that hold a window twice, as texts do that repeat a few words over and over
        order = np.lexsort((value, number))
        same = (value[order][1:] == value[order][:-1]) & (number[order][1:] == number[order][:-1])
        self.twice = np.zeros(len(head), bool)
        self.twice[number[order][1:][same]] = True


SEGMENT = [("key", "u8"), ("seg", "u8"), ("text", "u8"), ("word", "i4"), ("size", "i4"), ("twice", "?")]


def _segments(batch: pa.RecordBatch) -> np.ndarray:
    w = Windows(batch.column("text").to_pylist())
    found = np.zeros(len(w.anchor), SEGMENT)
    texts = np.asarray(batch.column("_text"), np.int64).view(np.uint64)
    columns = (w.anchor, w.segment, texts[w.owner], w.word, w.size, w.twice)
    for (name, _), values in zip(SEGMENT, columns, strict=True):
        found[name] = values
    return found


class Paragraphs:
    """The paragraphs of a batch of texts: lines, those of fewer than ``WORDS`` words glued to such
    lines beside them. ``cls`` tells sequences of words apart."""

    def __init__(self, texts: list[str]):
        self.words, owner, self.start, self.end, line = word_hashes(texts)
        n = len(self.words)
        first = np.ones(n, bool)
        first[1:] = line[1:] != line[:-1]
        heads = np.flatnonzero(first)
        short = np.diff(np.append(heads, n)) < WORDS
        glued = np.zeros(len(heads), bool)
        glued[1:] = short[1:] & short[:-1] & (owner[heads[1:]] == owner[heads[:-1]])
        self.heads = heads[~glued]
        self.sizes = np.diff(np.append(self.heads, n))
        self.owner = owner[self.heads]
        self.word = self.heads - np.searchsorted(owner, self.owner)
        places = np.arange(n) - np.repeat(self.heads, self.sizes)
        each = mix(self.words ^ mix((places + 1).astype(np.uint64)))
        self.cls = mix(np.add.reduceat(each, self.heads)) if n else self.words

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """The paragraphs that have shingles, and the keys of their bands, one row a band."""
        have = np.flatnonzero(self.sizes >= WORDS)
        if not len(have):
            return have, np.zeros((BANDS, 0), np.uint64)
        counts = self.sizes[have] - (WORDS - 1)
        firsts = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) + np.repeat(self.heads[have] - firsts, counts)
        shingles = rolled(self.words, WORDS)[at]
        keys = np.zeros((BANDS, len(have)), np.uint64)
        for i in range(BANDS * ROWS):
            least = np.minimum.reduceat((shingles ^ _SEEDS[i]) * _FACTORS[i], firsts)
            keys[i // ROWS] = mix(keys[i // ROWS] ^ mix(least ^ _SEEDS[i]))
        return have, keys


BAND = [("key", "u8"), ("cls", "u8")]


def _bands(batch: pa.RecordBatch) -> np.ndarray:
    p = Paragraphs(batch.column("text").to_pylist())
    have, keys = p.signatures()
    found = np.zeros(keys.size, BAND)
    found["key"], found["cls"] = keys.ravel(), np.tile(p.cls[have], BANDS)
    return found


def _paragraphs(table: DataFrame) -> DataFrame:
    """Place, size and words of every paragraph."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            p = Paragraphs(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_text").take(pa.array(p.owner)), pa.array(p.word.astype(np.int32)),
                 pa.array(p.sizes.astype(np.int32)), pa.array(p.cls.view(np.int64))],
                ["_text", "word", "size", "cls"],
            )

    return table.select("_text", "text").mapInArrow(
        extract, "_text bigint, word int, size int, cls bigint"
    )


def _with_texts(table: DataFrame, reps: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts (``text``) that ``wanted`` (``no``) asks something of."""
    keys = staged(wanted.join(reps.select("no", "_id", "_text").hint("merge"), "no"), "keys")
    return table.join(measured(keys, SMALL_BYTES), ["_id", "_text"])


def _paragraph_texts(table: DataFrame, reps: DataFrame, places: DataFrame) -> DataFrame:
    """The text of paragraphs (``cls``, ``no``, ``word``, ``size``)."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            cls, parts = [], []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(),
                                    strict=True):
                data = text.encode("utf-8", "surrogatepass")
                _, _, start, end, _ = word_hashes([text])
                for x in wanted:
                    cls.append(x["cls"])
                    part = data[start[x["word"]] : end[x["word"] + x["size"] - 1]]
                    parts.append(part.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.int64()), pa.array(parts, pa.string())], ["cls", "text"]
            )

    wanted = places.groupBy("no").agg(F.collect_list(F.struct("cls", "word", "size")).alias("wanted"))
    found = _with_texts(table, reps, wanted).select("text", "wanted")
    # repeated rows carry the same text
    return found.mapInArrow(extract, "cls bigint, text string").dropDuplicates(["cls"])


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those ``pairs`` (``a``, ``b``: paragraphs) that are alike, by their sets of shingles."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, PAIRS_AT_ONCE):
            a, b = (shingle_sets(batch.column(c).to_pylist(), WORDS) for c in ("ta", "tb"))
            keep = []
            for x, y in zip(a, b, strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a")
    return joined.select("a", "b", "ta", "tb").mapInArrow(verify, "a bigint, b bigint")


def _clusters(texts: DataFrame, bands: DataFrame) -> DataFrame:
    """Paragraphs (``node``) alike, directly or through others, with their cluster (``root``).

    In each band every paragraph is compared with the smallest one first. Bands that still hold
    several clusters are joined with themselves, but for those of more than ``CROWDED`` paragraphs:
    these are joined by :func:`ngram_join.linked_sets`, which misses no pair.
    """
    leaders = bands.groupBy("key").agg(F.min("cls").alias("b"))
    stars = staged(
        bands.join(leaders.hint("merge"), "key").where("cls <> b")
        .select(F.col("cls").alias("a"), "b").distinct(),
        "stars",
    )
    links = staged(_alike(stars, texts), "links")
    roots = staged(components(links), "roots")
    placed = staged(
        bands.join(roots.withColumnRenamed("node", "cls").hint("merge"), "cls", "left")
        .select("key", "cls", F.coalesce("root", "cls").alias("root")),
        "placed",
    )
    counts = placed.groupBy("key").agg(
        F.count("cls").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")
    )
    open_bands = staged(counts.where("least <> most").select("key", "n"), "open-bands")
    few = placed.join(open_bands.where(F.col("n") <= CROWDED).hint("merge"), "key").drop("n")
    few = staged(few, "few")
    sides = [few.select("key", *[F.col(c).alias(s + c) for c in ("cls", "root")]) for s in "ab"]
    more = (
        sides[0].join(sides[1].hint("merge"), "key").where("acls < bcls and aroot <> broot")
        .select(F.col("acls").alias("a"), F.col("bcls").alias("b")).distinct()
        .join(stars.select(F.col("b").alias("a"), F.col("a").alias("b")).hint("merge"), ["a", "b"], "left_anti")
    )
    more = staged(more, "more")
    found = links
    if more.limit(1).count():
        found = found.unionByName(staged(_alike(more, texts), "more-links"))
    many = open_bands.where(F.col("n") > CROWDED)
    if many.limit(1).count():
        crowd = staged(
            placed.join(many.select("key").hint("merge"), "key", "left_semi").select("cls").distinct(), "crowd"
        )
        rows, sets = linked_sets(
            texts.join(crowd.hint("merge"), "cls").select(
                F.lit("").alias("_id"), F.col("cls").alias("_text"), "text"
            ),
            WORDS, PERCENT,
        )
        alike = rows.join(sets.withColumnRenamed("node", "cls").hint("merge"), "cls").select(
            "_text", F.col("root").alias("set")
        )
        alike = staged(alike, "alike")
        least = alike.groupBy("set").agg(F.min("_text").alias("b"))
        found = found.unionByName(
            alike.join(least.hint("merge"), "set").select(F.col("_text").alias("a"), "b")
        )
    if found is links:
        return roots
    return staged(components(found), "roots")


# What repeats: ``size`` words from ``word`` on, the copy that stays, or windows in it with theirs.
MARK = "struct<k:int,value:bigint,no:bigint,word:int>"
PLACE = "struct(no, word)"


def _ranges(size: Column, cluster: str, marks: Column | None = None) -> list[Column]:
    none = F.lit(None)
    low = [F.col("low.no"), F.col("low.word")] if marks is None else [none.cast("bigint"), none.cast("int")]
    return [
        F.col("no"), F.col("word"), size.cast("int").alias("size"), F.col(cluster).alias("cluster"),
        low[0].alias("low_no"), low[1].alias("low_word"),
        (none.cast(f"array<{MARK}>") if marks is None else marks).alias("marks"),
    ]


def _equal_runs(table: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """The words of all windows that occur again, as ranges."""
    found = recurring(table, ["_text", "text"], _segments, SEGMENT, ["key", "text", "word"], size, "twice")
    found = found.withColumnRenamed("text", "_text").join(reps.select("_text", "no").hint("merge"), "_text")
    places = staged(found.select("key", "seg", "no", "word", "size", "twice"), "places")
    segs = staged(
        places.groupBy("key", "seg").agg(
            F.expr(f"min({PLACE})").alias("low"), F.expr(f"max({PLACE})").alias("high"), F.first("size").alias("size"),
            F.max("twice").alias("twice"),
        ),
        "segs",
    )
    mixed = segs.groupBy("key").agg(
        ((F.min("seg") != F.max("seg")) | F.max("twice")).alias("mixed")
    )
    segs = staged(segs.join(mixed.hint("merge"), "key"), "mixed")
    # Where all segments of an anchor are the same one, its windows are repeated if it is.
    alone = segs.where("not mixed and low <> high").select("seg", "low")
    whole = places.join(alone.hint("merge"), "seg")
    ranges = whole.select(*_ranges(F.col("size") + (MIN_RUN - 1), "seg"))
    # Of the others, windows are compared, once for each distinct segment.
    wanted = segs.where("mixed").groupBy("low.no").agg(
        F.collect_list(F.struct("seg", "low.word", "size")).alias("wanted")
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            words, owner, *_ = word_hashes(batch.column("text").to_pylist())
            values = rolled(words, MIN_RUN).view(np.int64)
            lists = batch.column("wanted")
            flat = lists.flatten()
            of = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            sizes = np.asarray(flat.field("size"))
            firsts = np.searchsorted(owner, of) + np.asarray(flat.field("word"))
            ends = np.cumsum(sizes)
            at = np.arange(sizes.sum()) + np.repeat(firsts - ends + sizes, sizes)
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [flat.field("seg"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[at]))],
                ["seg", "values"],
            )

    texts = _with_texts(table, reps, wanted).select("text", "wanted")
    values = staged(
        texts.mapInArrow(windows, "seg bigint, values array<bigint>").dropDuplicates(["seg"])
        .join(segs.where("mixed").select("seg", "low", "high").hint("merge"), "seg")
        .select("seg", "low", "high", F.posexplode("values").alias("k", "value"))
        .select("seg", "k", "value", _moved("low").alias("low"), _moved("high").alias("high")),
        "values",
    )
    again = staged(
        values.groupBy("value").agg(F.min("low").alias("keep"), F.max("high").alias("high"))
        .where("keep <> high").select("value", "keep"),
        "again",
    )
    marks = staged(
        values.select("seg", "k", "value").join(again.hint("merge"), "value").groupBy("seg")
        .agg(F.collect_list(F.struct("k", "value", "keep.no", "keep.word")).cast(f"array<{MARK}>").alias("marks")),
        "marks",
    )
    parts = places.join(marks.hint("merge"), "seg")
    return ranges.unionByName(parts.select(*_ranges(F.col("size"), "seg", F.col("marks"))))


def _moved(place: str) -> Column:
    return F.struct(F.col(f"{place}.no").alias("no"), (F.col(f"{place}.word") + F.col("k")).alias("word"))


def _like_paragraphs(table: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """The words of all paragraphs that are like another, as ranges."""
    found = staged(
        _paragraphs(table).join(reps.select("_text", "no").hint("merge"), "_text")
        .select("no", "word", "size", "cls").distinct(),
        "paragraphs",
    )
    bands = staged(
        recurring(table, ["_text", "text"], _bands, BAND, ["key", "cls"], size).distinct(), "bands"
    )
    firsts = staged(
        found.groupBy("cls").agg(F.min(F.struct("no", "word", "size")).alias("low"),
                                 F.expr(f"max({PLACE})").alias("high")),
        "firsts",
    )
    wanted = firsts.join(bands.select("cls").distinct().hint("merge"), "cls").select("cls", "low.*")
    texts = staged(_paragraph_texts(table, reps, wanted), "texts")
    roots = _clusters(texts, bands)
    clustered = staged(
        firsts.join(roots.withColumnRenamed("node", "cls").hint("merge"), "cls", "left")
        .select("cls", F.struct("low.no", "low.word").alias("low"), "high",
                F.coalesce("root", "cls").alias("cluster")),
        "clustered",
    )
    kept = staged(
        clustered.groupBy("cluster").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low <> high").select("cluster", "low"),
        "kept",
    )
    sets = clustered.select("cls", "cluster").join(kept.hint("merge"), "cluster")
    sets = staged(sets, "repeated")
    return found.join(sets.hint("merge"), "cls").select(*_ranges(F.col("size"), "cluster"))


SPANS = (
    "_id string, _text bigint, first int, last int, words int, removed boolean, "
    "cluster_id bigint, keep_no bigint"
)


class Runs:
    """Runs of words of the documents of a batch (``doc``: row in it), with the cluster and the kept
    copy of each."""

    def __init__(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray, cluster: np.ndarray, keep: np.ndarray):
        self.columns = [np.asarray(x, np.int64) for x in (doc, a, b, cluster, keep)]

    def where(self, chosen: np.ndarray) -> Runs:
        return Runs(*[x[chosen] for x in self.columns])

    def plus(self, other: Runs) -> Runs:
        return Runs(*[np.concatenate(x) for x in zip(self.columns, other.columns, strict=True)])

    def joined(self) -> Runs:
        """In order, those that touch as one, with the cluster and the copy of the first."""
        runs = self.where(np.lexsort(self.columns[::-1]))
        doc, a, b, cluster, keep = runs.columns
        if not len(doc):
            return runs
        apart = doc * (b.max() + 2)  # runs of two documents never touch
        ends = np.maximum.accumulate(b + apart)
        new = np.append(True, a[1:] + apart[1:] > ends[:-1])
        last = np.append(new[1:], True)
        return Runs(doc[new], a[new], (ends - apart)[last], cluster[new], keep[new])

    def between(self, docs: np.ndarray, sizes: np.ndarray, cluster: np.ndarray, no: np.ndarray) -> Runs:
        """What the windows of ``docs`` (of ``sizes`` words) cover that are not whole inside these
        runs, which are joined."""
        gone = self.where(np.isin(self.columns[0], docs))
        doc, a, b = gone.columns[:3]
        of = np.concatenate((docs, doc))
        size = dict(zip(docs.tolist(), sizes.tolist(), strict=True))
        n = np.array([size[d] for d in doc.tolist()], np.int64)
        firsts = np.concatenate((np.zeros(len(docs), np.int64), np.maximum(0, b - MIN_RUN + 1)))
        lasts = np.concatenate((sizes, np.minimum(n, a + MIN_RUN - 1)))
        order = np.lexsort((firsts, of))
        firsts, lasts, of = firsts[order], lasts[np.lexsort((lasts, of))], of[order]
        at = np.searchsorted(docs, of)
        return Runs(of, firsts, lasts, cluster[at], no[at]).where(lasts - firsts >= MIN_RUN)


def _passages(batch: pa.RecordBatch, sizes: np.ndarray) -> tuple[Runs, Runs]:
    """The passages of documents of ``sizes`` words: those that go and those that stay."""

    def numbers(column: pa.Array) -> np.ndarray:
        return np.asarray(column.fill_null(-1), np.int64)

    def owners(lists: pa.Array) -> np.ndarray:
        return np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))

    text, no, head = (numbers(batch.column(c)) for c in ("_text", "no", "head"))
    copy, copied = (np.asarray(batch.column(c).fill_null(False)) for c in ("copy", "copied"))
    ranges = batch.column("ranges")
    doc, flat = owners(ranges), ranges.flatten()
    word, size, cluster, low_no, low_word = (
        numbers(flat.field(c)) for c in ("word", "size", "cluster", "low_no", "low_word")
    )
    moved = (low_no != no[doc]) | (low_word != word)
    whole = np.asarray(flat.field("marks").is_null())
    runs, gone = Runs(doc, word, word + size, cluster, low_no).where(whole), moved[whole]
    at, marks = owners(flat.field("marks")), flat.field("marks").flatten()
    k, value, keep, place = (numbers(marks.field(c)) for c in ("k", "value", "no", "word"))
    first = word[at] + k
    runs = runs.plus(Runs(doc[at], first, first + MIN_RUN, value, keep))
    gone = np.concatenate((gone, (keep != no[doc[at]]) | (place != first)))
    gone, stay = runs.where(gone).joined(), runs.where(~gone)
    # of a text with copies all windows occur again; those that do not go stay
    docs = np.flatnonzero(copied & ~copy)
    stay = stay.plus(gone.between(docs, sizes[docs], text[docs], no[docs]))
    docs = np.flatnonzero(copy)
    gone = gone.plus(Runs(docs, np.zeros(len(docs)), sizes[docs], text[docs], head[docs]))
    return gone, stay.joined()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of words of one document, all removed or all kept, that touch, as spans of bytes."""
    names = [x.split()[0] for x in SPANS.split(", ")]
    for batch in arrow_rows(batches, ROWS_AT_ONCE):
        _, owner, start, end, _ = word_hashes(batch.column("text").to_pylist())
        sizes = np.bincount(owner, minlength=batch.num_rows)
        firsts = np.cumsum(sizes) - sizes
        for removed, runs in zip((True, False), _passages(batch, sizes), strict=True):
            doc, a, b, *_ = runs.columns
            doc, a, b, cluster, keep = runs.where(b - a >= MIN_RUN).columns
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(rows), batch.column("_text").take(rows),
                 pa.array(start[firsts[doc] + a].astype(np.int32)),
                 pa.array(end[firsts[doc] + b - 1].astype(np.int32)),
                 pa.array((b - a).astype(np.int32)), pa.array(np.full(len(doc), removed)),
                 pa.array(cluster), pa.array(keep)],
                names,
            )


def _alone(ranges: Callable[..., DataFrame], table: DataFrame, *more) -> DataFrame:  # noqa: ANN002
    """What ``ranges`` finds, written, and the tables it made on the way removed."""
    spark = table.sparkSession
    path = new_table_path(spark, "found")
    with scope(spark):
        found = ranges(table, *more)
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def repeated_passages(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per passage that occurs more than once, in every place it occurs: ``key``,
    ``start``, ``end`` (bytes of the UTF-8 text, end excluded), ``n_words``, ``removed``,
    ``cluster_id``, ``keep_id`` (the document whose copy of the passage's beginning stays),
    ``_id``, ``_text``.

    Two things are repeated: paragraphs (lines) whose sets of ``WORDS``-word shingles have a Jaccard
    similarity of at least ``PERCENT`` / 100 with another's, directly or through others; and
    ``MIN_RUN`` words in a row that occur elsewhere (words as in :func:`shingles.word_hashes`, lines
    do not matter). Lines of fewer words are glued to such lines beside them and, if still too
    short, are alike only if equal. A passage is what repeated words and paragraphs cover without a
    gap, ``MIN_RUN`` words or more. Of each run or cluster the copy in the document with the
    smallest key (null last), in its first place, stays; where what stays overlaps what another
    document or place has already, the words they share are in a removed passage as well. A text
    that an earlier document has is one removed passage. Null and blank texts have no passages; rows
    that repeat key and text count as one document. Other columns are ignored; an empty table gives
    no rows.

    Paragraphs meet in the bands of their MinHash signatures, ``BANDS`` of ``ROWS`` values, and are
    verified on their texts (:func:`_clusters`); a pair just alike enough is missed in 3 cases of
    1000, and found all the same where it shares a run. Runs are found by :class:`Windows` and none
    is missed: segments with an anchor that recurs, then, where segments of an anchor differ, the
    windows of each distinct one.
    """
    table = docs.select(*same_row(key), text_of("text").alias("text"))
    ids = docs.schema[key].dataType
    own = F.when(F.col("_id") != "-", F.col("_id")).cast(ids)
    order = F.struct(own.isNull().alias("last_key"), own.alias("key"), "_id")
    texts = table.groupBy("_text").agg(
        F.min(order).alias("low"), F.max(order).alias("high"), F.first(F.octet_length("text")).alias("bytes")
    )
    # numbered in the order of keys: partitions of the sort come one after the other
    reps = staged(
        texts.select("_text", "low._id", (F.col("low") != F.col("high")).alias("copied"), "bytes", "low")
        .orderBy("low", "_text").withColumn("no", F.monotonically_increasing_id()).drop("low"),
        "reps",
    )
    size = (reps.agg(F.sum("bytes")).first()[0] or 0) // TEXT_BYTES_A_RECORD
    ranges = _alone(_equal_runs, table, reps, size).unionByName(
        _alone(_like_paragraphs, table, reps, size)
    )
    head = F.when(F.col("marks").isNull() & (F.col("word") == 0), F.col("low_no")).when(
        (F.col("word") == 0) & (F.array_min("marks")["k"] == 0), F.array_min("marks")["no"]
    )
    ranges = ranges.withColumn("head", head).groupBy("no").agg(
        F.collect_list(F.struct("word", "size", "cluster", "low_no", "low_word", "marks")).alias("ranges"),
        F.min("head").alias("head"),
    )
    work = staged(
        reps.join(ranges.hint("merge"), "no", "left")
        .where("copied or ranges is not null")
        .select("no", "_id", "_text", "copied", "ranges", F.least("head", "no").alias("head")),
        "work",
    )
    copies = (
        table.select("_id", "_text").distinct()
        .join(work.where("copied").select("_text", F.col("_id").alias("rep"), "no", "head").hint("merge"), "_text")
        .where("_id <> rep").drop("rep")
        .withColumns({"copied": F.lit(True), "ranges": F.lit(None).cast(work.schema["ranges"].dataType),
                      "copy": F.lit(True)})
    )
    work = staged(work.withColumn("copy", F.lit(False)).unionByName(copies), "all-work")
    # rows that repeat carry the same text and give the same spans
    spans = table.join(work.hint("merge"), ["_id", "_text"]).mapInArrow(_merge, SPANS).dropDuplicates()
    spans = spans.join(
        reps.select(F.col("no").alias("keep_no"), F.col("_id").alias("keep_id")).hint("merge"), "keep_no"
    )
    return spans.select(
        own.alias(key), F.col("first").alias("start"), F.col("last").alias("end"),
        F.col("words").alias("n_words"), "removed", "cluster_id",
        F.when(F.col("keep_id") != "-", F.col("keep_id")).cast(ids).alias("keep_id"), "_id", "_text",
    )


def cut(text: str, spans: list[dict]) -> str:
    """The text without the spans (bytes), and without the white space that followed them."""
    data, at, parts = text.encode("utf-8", "surrogatepass"), 0, []
    for span in spans:
        parts.append(data[at : span["start"]])
        at = span["end"]
        while at < len(data) and data[at : at + 1].isspace():
            at += 1
    parts.append(data[at:])
    return b"".join(parts).decode("utf-8", "surrogatepass")


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with every passage in one place only: ``text`` without the others, and ``n_chars``,
    where there is such a column, its new length. All rows stay, also those left without text."""
    gone = repeated_passages(docs).where("removed")
    spans = gone.groupBy("_id", "_text").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    spans = staged(spans, "spans")
    rows = docs.select(F.struct("*").alias("_row"), *same_row())

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            new = [cut(t, s) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(new, pa.string())], ["_row", "new"]
            )

    # Python gets the text once: the row without it, and gives back the new one beside that row.
    gap = F.lit(None).cast(docs.schema["text"].dataType)
    changed = rows.join(spans.hint("merge"), ["_id", "_text"]).select(
        F.col("_row").withField("text", gap).alias("_row"), F.col("_row.text").alias("text"), "spans"
    )
    schema = changed.select("_row", F.lit("").alias("new")).schema
    edited = changed.mapInArrow(edit, schema).withColumn(
        "_row", F.col("_row").withField("text", F.col("new"))
    )
    if "n_chars" in docs.columns:
        size = F.length("new").cast(docs.schema["n_chars"].dataType)
        edited = edited.withColumn("_row", F.col("_row").withField("n_chars", size))
    same = rows.join(measured(spans.select("_id", "_text")), ["_id", "_text"], "left_anti")
    return edited.select("_row.*").unionByName(same.select("_row.*"))
