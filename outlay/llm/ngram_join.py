"""Similarity join of word shingle sets by prefixes, with documents of one prefix as one group."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import (
    SMALL_BYTES,
    arrow_rows,
    components,
    measured,
    same_row,
    staged,
    text_of,
    without,
)
from outlay.llm.recurring import recurring
from outlay.llm.shingles import shingle_sets

# A shingle in more sets than this is moved to the end of the common order.
FREQUENT = 16
# Frequent shingles known to every task, at most. They only decide the order, so the bound costs
# time where it is reached, never a link.
MOST_FREQUENT = 1_000_000
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 64
PACKED_TOGETHER = 500_000  # shingles a task counts at a time
BUCKET_BYTES = 8 << 20  # shingles of a bucket


def prefix_length(n: int, percent: int) -> int:
    """Two sets as alike as ``percent`` share one of so many first shingles of either."""
    return n - -(-percent * n // 100) + 1


def set_id(values: np.ndarray) -> int:
    """A 63-bit id of a set or prefix."""
    import xxhash

    return xxhash.xxh3_64_intdigest(values.tobytes()) >> 1


SETS = "_id string, _text bigint, n bigint, cls bigint, prefix array<bigint>"


PACKED = "bucket int, once binary, more binary, counts binary"
Frequent = tuple[np.ndarray, np.ndarray]  # shingles, ascending, and the magnitude of their counts


def _in_order(values: np.ndarray, frequent: Frequent) -> np.ndarray:
    """A set (by hash) in the common order: the frequent ones last, the more frequent the later."""
    tokens, levels = frequent
    at = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
    late = tokens[at] == values
    last, level = values[late], levels[at[late]]
    return np.concatenate((values[~late], last[np.argsort(level, kind="stable")]))


def _prefixes(rows: DataFrame, k: int, percent: int, frequent: Frequent | None) -> DataFrame:
    """Size, id and first shingles of every row's set, in the common order."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent) if frequent is not None else None

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value if shared else None
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            sizes, ids, firsts = [], [], []
            for values in shingle_sets(batch.column("text").to_pylist(), k):
                n = len(values)
                sizes.append(n)
                ids.append(set_id(values) if n else None)
                if late is not None and n:
                    values = _in_order(values, late)
                firsts.append(values[: prefix_length(n, percent) if n else 0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_text"), pa.array(sizes, pa.int64()),
                 pa.array(ids, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                ["_id", "_text", "n", "cls", "prefix"],
            )

    return rows.select("_id", "_text", "text").mapInArrow(extract, SETS)


def _packed(rows: DataFrame, shingles: Callable[[pa.RecordBatch], np.ndarray], buckets: int) -> DataFrame:
    """The distinct ``shingles`` of batches of ``rows`` and how often each occurs, as sorted arrays by
    bucket: a row for every bucket and half a million of them or so, not one for each."""

    def cut(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        # values are hashes: by their upper bits, buckets are even and stay in order
        edges = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
        cuts = np.concatenate(([0], np.searchsorted(values, edges), [len(values)]))
        full = np.flatnonzero(np.diff(cuts))
        counts = counts.astype(np.uint32)
        once = [counts[cuts[i] : cuts[i + 1]] == 1 for i in full]
        parts = [values[cuts[i] : cuts[i + 1]] for i in full]
        sizes = [counts[cuts[i] : cuts[i + 1]] for i in full]
        return pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)),
             pa.array([x[o].tobytes() for x, o in zip(parts, once, strict=True)], pa.binary()),
             pa.array([x[~o].tobytes() for x, o in zip(parts, once, strict=True)], pa.binary()),
             pa.array([x[~o].tobytes() for x, o in zip(sizes, once, strict=True)], pa.binary())],
            ["bucket", "once", "more", "counts"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            held.append(shingles(batch))
            if sum(map(len, held)) >= PACKED_TOGETHER:
                yield cut(held)
                held = []
        if sum(map(len, held)):
            yield cut(held)

    return rows.mapInArrow(pack, PACKED)


def _levels(rows: Iterator[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The values of a bucket that occur more than ``FREQUENT`` times, and the powers of two below."""
    once, more, counts = zip(*((r["once"], r["more"], r["counts"]) for r in rows), strict=True)
    values = np.frombuffer(b"".join((*once, *more)), np.uint64)
    order = np.argsort(values)
    values = values[order]
    heads = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    single = sum(map(len, once)) // 8
    sizes = np.concatenate((np.ones(single, np.int64), np.frombuffer(b"".join(counts), np.uint32)))
    totals = np.add.reduceat(sizes[order], heads)
    keep = totals > FREQUENT
    return values[heads[keep]], np.frexp(totals[keep].astype(np.float64))[1] - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in arrow_rows(batches, 16) for row in batch.to_pylist())
    for _, bucket in groupby(rows, key=itemgetter("bucket")):
        tokens, levels = _levels(bucket)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens.view(np.int64)), pa.array(levels.astype(np.int32))], ["token", "level"]
        )


def _frequent(packed: DataFrame) -> Frequent:
    """The shingles (:func:`_packed`) that occur most, as many as every task can be told."""
    counts = staged(
        packed.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_counted, "token bigint, level int"),
        "frequent",
    )
    # by powers of two, so that what is looked at stays small whatever the counts are
    sizes = counts.groupBy("level").count().orderBy(F.desc("level")).collect()
    least, total = 64, 0
    for row in sizes:
        total += row["count"]
        if total > MOST_FREQUENT:
            break
        least = row["level"]
    found = counts.where(F.col("level") >= least).toArrow()
    names = np.asarray(found.column("token"), np.int64).view(np.uint64)
    order = np.argsort(names)
    return names[order], np.asarray(found.column("level"), np.int8)[order]


def _holding(classes: DataFrame, frequent: Frequent) -> DataFrame:
    """Keys of the sets with a frequent shingle in their prefix."""
    shared = classes.sparkSession.sparkContext.broadcast(np.sort(frequent[0].view(np.int64)))

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lists = batch.column("prefix")
            flat = np.asarray(lists.flatten())
            at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
            owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            keep = np.zeros(len(lists), bool)
            keep[owner[known[at] == flat]] = True
            yield batch.select(["_id", "_text"]).filter(pa.array(keep))

    return staged(
        classes.select("_id", "_text", "prefix").mapInArrow(holding, "_id string, _text bigint"),
        "holding",
    )


def _prefix_shingles(classes: DataFrame, buckets: int) -> DataFrame:
    """The shingles of all prefixes, counted in parts."""
    return _packed(
        classes.select("prefix"),
        lambda batch: np.asarray(batch.column("prefix").flatten(), np.int64).view(np.uint64),
        buckets,
    )


def _all_shingles(rows: DataFrame, k: int, buckets: int) -> DataFrame:
    """The shingles of all sets, counted in parts."""
    return _packed(
        rows.select("text"),
        lambda batch: np.concatenate(shingle_sets(batch.column("text").to_pylist(), k)),
        buckets,
    )


# A shingle of the prefix of a group, and where it stands there.
PLACE = [("key", "u8"), ("g", "u8"), ("n", "u8"), ("pos", "i4")]


def _places(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("prefix")
    sizes = np.asarray(lists.value_lengths(), np.int64)
    ends = np.cumsum(sizes)
    found = np.zeros(int(sizes.sum()), PLACE)
    found["key"] = np.asarray(lists.flatten(), np.int64).view(np.uint64)
    for name in ("g", "n"):
        found[name] = np.repeat(np.asarray(batch.column(name), np.int64).view(np.uint64), sizes)
    found["pos"] = np.arange(len(found)) - np.repeat(ends - sizes, sizes)
    return found


def _needed(n: Column, m: Column, percent: int) -> Column:
    """Shingles that sets of sizes ``n`` and ``m`` must share to be linked."""
    return F.ceil(percent * (n + m) / (100 + percent) - 1e-9)


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether a shared shingle may be the first one two linked sets share, by sizes and places."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    rest = F.least(na - F.col(f"{a}pos"), nb - F.col(f"{b}pos"))
    return (rest >= _needed(na, nb, percent)) & (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)


def _linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those ``pairs`` (``a``, ``b``: ids of sets) whose sets, made from their texts, are linked."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in arrow_rows(batches, PAIRS_AT_ONCE):
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb")]
            texts_of = dict(zip(columns[0] + columns[1], columns[2] + columns[3], strict=True))
            known = {x: known[x] for x in texts_of if x in known}
            new = [x for x in texts_of if x not in known]
            known |= zip(new, shingle_sets([texts_of[x] for x in new], k), strict=True)
            keep = []
            for a, b in zip(columns[0], columns[1], strict=True):
                x, y = known[a], known[b]
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    return (
        pairs.join(two.hint("merge"), "b")
        .join(one.hint("merge"), "a")
        .select("a", "b", "ta", "tb")
        .mapInArrow(verify, "a bigint, b bigint")
    )


def linked_sets(table: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The join of :func:`similar_groups` over the texts of ``table`` (``_id``, ``_text``, ``text``):
    a row of each text with its size ``n`` and the id of its set ``cls``, and the sets that are
    linked (``node``) with their component (``root``)."""
    rows = staged(_prefixes(table, k, percent, None).withColumn("row", F.monotonically_increasing_id()), "sets")
    some = F.struct("_id", "_text", "n", "prefix")
    classes = staged(
        rows.where("n > 0").groupBy("cls").agg(F.first(some).alias("rep")).select("cls", "rep.*"),
        "classes",
    )
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, -(-shingles * 8 // BUCKET_BYTES))
    first = _frequent(_prefix_shingles(classes, buckets))
    if len(first[0]):
        # What is frequent in prefixes tells which sets hold shared passages; there, count all.
        def of(keys: DataFrame) -> DataFrame:
            return table.join(measured(keys, SMALL_BYTES), ["_id", "_text"], "left_semi")

        frequent = _frequent(_all_shingles(of(_holding(classes, first)), k, buckets))
        # More than every task can be told are as good as none: any order loses no link.
        if len(frequent[0]):
            redone = _prefixes(of(_holding(classes, frequent)), k, percent, frequent)
            redone = staged(redone.dropDuplicates(["cls"]), "redone")
            classes = classes.join(
                redone.select("cls").hint("merge"), "cls", "left_anti"
            ).unionByName(redone.select(*classes.columns))
    grouped = staged(
        classes.select("cls", "_id", "_text", "n", F.xxhash64("n", "prefix").alias("g"), "prefix"),
        "grouped",
    )
    members = grouped.select("g", "cls", "n")
    index = grouped.groupBy("g", "n").agg(F.first("prefix").alias("prefix"))
    expected = shingles * (100 - percent) // 100
    shared = recurring(index, ["g", "n", "prefix"], _places, PLACE, ["key", "g", "n"], expected)
    buckets = staged(shared.withColumnRenamed("key", "token"), "buckets")
    leaders = staged(
        buckets.groupBy("token")
        .agg(F.min(F.struct("pos", "g", "n")).alias("lead"))
        .select("token", F.col("lead.g").alias("bg"), F.col("lead.pos").alias("bpos"),
                F.col("lead.n").alias("bn")),
        "leaders",
    )
    stars = (
        buckets.select("token", F.col("g").alias("ag"), F.col("n").alias("an"),
                       F.col("pos").alias("apos"))
        .join(leaders.hint("merge"), "token")
        .where((F.col("ag") != F.col("bg")) & _possible("a", "b", percent))
        .select("ag", "bg")
        .distinct()
    )
    # Groups meet by one member each: all of one with the first of the other, and in a group all with
    # its first. What that leaves apart meets in the third step.
    firsts = members.groupBy("g").agg(F.min("cls").alias("b"), F.count("cls").alias("size"), F.first("n").alias("n"))
    firsts = staged(firsts, "firsts")
    crowded = firsts.where("size > 1")
    outer = stars.join(members.select(F.col("g").alias("ag"), F.col("cls").alias("a")).hint("merge"), "ag").join(
        firsts.select(F.col("g").alias("bg"), "b").hint("merge"), "bg"
    )
    inner = members.select("g", F.col("cls").alias("a")).join(crowded.select("g", "b").hint("merge"), "g")
    pairs = staged(
        outer.select("a", "b").unionByName(inner.where("a <> b").select("a", "b")).distinct(), "pairs"
    )

    def texts_for(some_pairs: DataFrame) -> DataFrame:
        wanted = some_pairs.select(F.col("a").alias("cls")).unionByName(
            some_pairs.select(F.col("b").alias("cls"))
        )
        keys = staged(
            grouped.select("cls", "_id", "_text")
            .join(wanted.distinct().hint("merge"), "cls", "left_semi"),
            "wanted",
        )
        found = table.select("_id", "_text", "text").join(
            measured(keys, SMALL_BYTES), ["_id", "_text"]
        )
        # repeated rows carry the same text
        return staged(found.select("cls", "text").dropDuplicates(["cls"]), "texts")

    links = staged(_linked(pairs, texts_for(pairs), k, percent), "links")
    roots = staged(components(links), "roots")

    placed = members.join(roots.withColumnRenamed("node", "cls").hint("merge"), "cls", "left").select(
        "g", "cls", F.coalesce("root", "cls").alias("root")
    )
    # members of a group have their whole prefix in common: a bucket of its own
    own = crowded.select("g", "n", F.lit(0).alias("pos"), F.col("g").alias("token"))
    spread = buckets.unionByName(own).join(placed.hint("merge"), "g")
    open_tokens = staged(
        spread.groupBy("token")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("token"),
        "open",
    )
    left = staged(
        spread.join(open_tokens.hint("merge"), "token", "left_semi").select(
            "token", "cls", "root", "n", "pos"
        ),
        "unsettled",
    )
    sides = [
        left.select("token", *[F.col(c).alias(s + c) for c in ("cls", "root", "n", "pos")])
        for s in "ab"
    ]
    more = (
        sides[0]
        .join(sides[1].hint("merge"), "token")
        .where("acls < bcls and aroot <> broot")
        .where(_possible("a", "b", percent))
        .select(F.col("acls").alias("a"), F.col("bcls").alias("b"))
        .distinct()
        .join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
              .hint("merge"), ["a", "b"], "left_anti")
    )
    more = staged(more, "more-pairs")
    if more.limit(1).count():
        more_links = staged(_linked(more, texts_for(more), k, percent), "more-links")
        hung = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = staged(components(hung.unionByName(more_links)), "roots")
    return rows, roots


def similar_groups(
    docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id"
) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id``, ``_component``, ``_id``,
    ``_text`` (see :func:`common.same_row`).

    Documents are linked when the sets of their distinct ``k``-word shingles have a Jaccard
    similarity of at least ``percent`` / 100. ``component_id`` is the smallest key that links lead
    to (null only where all those keys are), ``_component`` the same component as a number. A null
    or blank text has no shingles and is alone, with a null ``_component``; shorter texts have their
    whole sequence of words as one shingle. Repeated rows and equal sets are one component. Other
    columns are ignored; an empty table gives no rows.

    The join, on sets without their copies:

    1. All sets are put in one order, by hash but with frequent shingles last, and reduced to
       prefixes of which linked sets must share a shingle. What many documents share (passages,
       boilerplate) thus rarely is in a prefix. Which shingles are frequent is found in two steps:
       those frequent among prefixes by hash tell the sets to count all shingles of.
    2. Sets of equal size and prefix are one group; groups meet in the buckets of their prefix
       shingles. In each bucket, every group is first paired with one leader only: that in which
       the shingle comes first, the one with the fewest shingles of its own, such as the original
       of many copies. Pairs that sizes and places rule out are left out; of the others, all members
       of the group are verified, on their texts, against one member of the leader. Members of one
       group are verified against its first.
    3. Members of one component need no further comparison. Only buckets (a group counts as one)
       that still hold several components are joined with themselves, again without pairs that
       sizes and places rule out or of one component, and verified. No link between components is
       lost; what is written as pairs are sets that share a prefix shingle and are still apart.
    """
    rows, roots = linked_sets(
        docs.select(*same_row(key), text_of("text").alias("text")), k, percent
    )
    ids = docs.schema[key].dataType
    keyed = staged(
        rows.select("_id", "_text", "n", "cls", F.when(F.col("_id") != "-", F.col("_id"))
                    .cast(ids).alias("_key")), "keyed",
    )
    known = keyed.where("n > 0")
    smallest = known.groupBy("cls").agg(F.min("_key").alias("least"))
    rooted = staged(
        smallest.join(roots.withColumnRenamed("node", "cls").hint("merge"), "cls", "left").select(
            "cls", "least", F.coalesce("root", "cls").alias("root")
        ),
        "rooted",
    )
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = staged(rooted.join(lowest.hint("merge"), "root").select("cls", "root", "component_id"), "found")
    columns = ["_key", "n", "component_id", "root", "_id", "_text"]
    linked = known.join(found.hint("merge"), "cls").select(*columns)
    alone = keyed.where("n = 0").select(
        "_key", "n", F.col("_key").alias("component_id"), F.lit(None).cast("bigint").alias("root"),
        "_id", "_text",
    )
    return linked.unionByName(alone).select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), "component_id",
        F.col("root").alias("_component"), "_id", "_text",
    )


def drop_similar(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id, all columns as they
    are. Documents without words stay."""
    found = staged(similar_groups(docs, k, percent).where("_component is not null"), "similar")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_text", "_id")
    kept = staged(
        found.groupBy("_component").agg(F.min(order).alias("keep"))
        .select("_component", "keep._id", "keep._text"),
        "kept",
    )
    crowd = found.select("_id", "_text").join(
        kept.select("_id", "_text").hint("merge"), ["_id", "_text"], "left_semi"
    )
    repeats = staged(crowd.groupBy("_id", "_text").count().where("count > 1")
                     .select("_id", "_text"), "repeats")
    dropped = found.select("_id", "_text").join(
        kept.select("_id", "_text").hint("merge"), ["_id", "_text"], "left_anti"
    )
    return without(docs, staged(dropped.distinct(), "dropped"), repeats)
