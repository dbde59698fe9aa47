"""Spelling variants of the words of a corpus: words one edit apart, by grams of variable length."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import arrow_rows, measured, staged, text_of

MIN_CHARS = 7  # code points of a word, at least
MIN_COUNT = 2  # occurrences of a word, at least
RATIO = 10  # a word's form occurs so many times as often, at least
# The letters of words, once A-Z are in lower case.
LETTERS = "a-zÀ-ÿ"
QMIN, QMAX = 2, 5  # lengths of grams
FREQUENT = 64  # words a gram is in, beyond which it is made longer
# Frequent grams known to every task, at most. The bound decides how long grams get, never a pair.
MOST_GRAMS = 200_000
ROWS_AT_ONCE = 128
CROWDED = 32  # entries of a list, beyond which its words must share more than the gram
SAME, BEHIND, BEFORE = 0, 1, 2  # where a longer word of a pair has its added letter
WORDS_AT_ONCE = 200_000  # words or grams counted in a task before they are handed on

Grams = list[tuple[int, str]]  # place and gram, by place


def decompose(word: str, frequent: dict[str, int], qmax: int) -> Grams:
    """The grams of a word: from every place, as many letters as it takes for them not to be
    frequent, ``QMIN`` to ``qmax``; those that lie within one that starts before them are left out.
    """
    out, reach, n = [], 0, len(word)
    for at in range(n - QMIN + 1):
        end = at + QMIN
        while end < n and end - at < qmax and word[at:end] in frequent:
            end += 1
        if end > reach:
            out.append((at, word[at:end]))
            reach = end
    return out


def most_affected(grams: Grams, qmax: int) -> int:
    """How many of its grams a word can lose by one edit: as many as end within ``qmax`` places.

    A gram that ends at e can be changed by an edit in it, or, if it lies behind the edit, by a gram
    that reaches from before the edit to e and so contains it. Either way the place of the edit is
    one of the ``qmax`` before e. Letters added at the end change the one gram that the end cut.
    """
    ends = [at + len(gram) for at, gram in grams]
    first, most = 0, 0
    for i, end in enumerate(ends):
        while ends[first] <= end - qmax:
            first += 1
        most = max(most, i - first + 1)
    return most


def index_entries(word: str, frequent: dict[str, int]) -> Iterator[tuple[int, str, int, bool]]:
    """The grams a word is found by: tier, gram, place, and whether the word's bound is void there.

    Two words one edit apart share all but the affected grams of either. If that leaves a word at
    least one gram, its rarest ones, one more than can be affected, hold a shared one: these are its
    entries. If it leaves none, the bound is void: all its grams are entries, for words whose bound
    is not, and the word goes on to the next tier, of shorter grams. With grams of ``QMIN`` letters
    alone no bound is void.
    """
    for tier, qmax in enumerate(range(QMAX, QMIN - 1, -1)):
        grams = decompose(word, frequent, qmax)
        bound = most_affected(grams, qmax)
        void = bound >= len(grams)
        if not void:
            grams = sorted(grams, key=lambda g: (frequent.get(g[1], 0), g[1], g[0]))[: bound + 1]
        for at, gram in grams:
            yield tier, gram, at, void
        if not void:
            return


Change = Callable[[object, dict[str, int]], dict[str, int]]


def word_counts(docs: DataFrame, key: str, text: str, change: Change | None) -> DataFrame:
    """Words of ``MIN_CHARS`` and more and how often they occur: (``word``, ``n``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(f"[{LETTERS}]{{{MIN_CHARS},}}").findall
        total: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(total, pa.string()), pa.array(total.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("_key", "_text")), strict=True):
                words = Counter(find(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if change:
                    words = change(doc, words)
                for word, n in words.items():
                    if len(word) >= MIN_CHARS:
                        total[word] = total.get(word, 0) + n
            if len(total) > WORDS_AT_ONCE:
                yield flushed()
                total = {}
        yield flushed()

    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    counted = rows.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams of ``QMIN`` to ``QMAX`` letters with the number of places in words they are found at,
    if more than ``FREQUENT``, or than that power of two which leaves ``MOST_GRAMS`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(total, pa.string()), pa.array(total.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["gram", "n"])

        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.column("word").slice(start, 1000).to_pylist()
                total.update(chain.from_iterable(
                    [w[i : i + q] for i in range(len(w) - q + 1)]
                    for w in some for q in range(QMIN, QMAX + 1)
                ))
                if len(total) > WORDS_AT_ONCE:
                    yield flushed()
                    total = Counter()
        yield flushed()

    counts = staged(
        words.select("word").mapInArrow(count, "gram string, n bigint")
        .groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > FREQUENT),
        "grams",
    )
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).count().orderBy(F.desc("level")).collect()
    least, total = 64, 0
    for row in levels:
        total += row["count"]
        if total > MOST_GRAMS:
            break
        least = row["level"]
    found = counts.where(F.col("n") >= F.lit(2.0) ** least).toArrow()
    return dict(zip(found.column("gram").to_pylist(), found.column("n").to_pylist(), strict=True))


def _sides() -> Column:
    """What a word of a crowded list must share with another besides the gram, one of up to four.

    The edit is behind the gram or before it. The other side is the same, and, of the side with the
    edit, cut in halves by the shorter word's length, so is the first half or the last one. ``case``
    tells the longer word of a pair (an added letter before or behind the gram) from the shorter,
    whose place and length ``at`` and ``length`` are.
    """
    text, at, length, case = F.col("word"), F.col("at"), F.col("length"), F.col("case")
    own = at + (case == BEFORE).cast("int")  # where the gram is in this word
    end = own + F.char_length("gram")
    whole = F.char_length(text)
    behind = length - at - F.char_length("gram")
    part = lambda start, size: F.substring(text, start + 1, size)
    half, front = F.floor(behind / 2).cast("int"), F.floor(at / 2).cast("int")
    tag = lambda kind, value: F.concat(F.lit(kind), value)
    return F.array_compact(F.array(
        F.when((case != BEFORE) & (behind >= 0), tag("a", part(F.lit(0), end + half))),
        F.when((case != BEFORE) & (behind > 0),
               tag("b", F.concat(part(F.lit(0), end), part(whole - (behind - half), behind - half)))),
        F.when(case != BEHIND, tag("c", F.concat(part(F.lit(0), front), part(own, whole - own)))),
        F.when((case != BEHIND) & (at > 0), tag("d", part(own - (at - front), whole - own + at - front))),
    ))


def near_words(words: DataFrame) -> DataFrame:
    """Pairs of ``words`` (``word``, ``n``) one inserted, deleted or replaced code point apart, each
    pair in both directions: ``word``, ``n``, ``near``, ``near_n``."""
    frequent = frequent_grams(words)
    shared = words.sparkSession.sparkContext.broadcast(frequent)
    schema = "word string, length int, tier int, gram string, at int, void boolean"

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.bool_()]
        for batch in arrow_rows(batches, 2000):
            out = [
                (word, len(word), *entry)
                for word in batch.column("word").to_pylist()
                for entry in index_entries(word, known)
            ]
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    index = staged(words.select("word").mapInArrow(entries, schema), "entries")
    shared.destroy()
    # A list has the words with a gram at a place, by length. A replaced letter leaves places as they
    # are, an added one moves those behind it by one. So the word of a pair that is shorter, or first
    # if both are as long, is met in one list each.
    number = F.xxhash64("tier", "gram", "at", "length").alias("list")
    crowded = staged(
        index.groupBy(number).count().where(F.col("count") > CROWDED).select("list", F.lit(True).alias("crowded")),
        "crowded",
    )
    places = F.array(
        F.struct(F.lit(SAME).alias("case"), "at", "length"),
        F.struct(F.lit(BEHIND).alias("case"), "at", (F.col("length") - 1).alias("length")),
        F.struct(F.lit(BEFORE).alias("case"), (F.col("at") - 1).alias("at"), (F.col("length") - 1).alias("length")),
    )
    shifted = index.select("word", "void", "tier", "gram", F.explode(places).alias("place")).select(
        "word", "void", "tier", "gram", "place.case", "place.at", "place.length"
    )
    lists = measured(crowded)
    half = F.floor(F.col("length") / 2).cast("int")

    def met(rows: DataFrame, word: str, marks: str) -> DataFrame:
        """Entries by what they meet under: the word and, in one number, 24 bits of a hash of each of
        its halves, whether it is the longer one, and whether its bound is void."""
        sides = F.transform(_sides(), lambda side: F.xxhash64("list", side))
        bits = lambda part: F.xxhash64(part).bitwiseAND(F.lit(0xFFFFFF))
        first, last = bits(F.left("word", half)), bits(F.right("word", F.col("length") - half))
        longer, void = (F.col("case") != SAME).cast("bigint"), F.col("void").cast("bigint")
        return rows.select("*", number).join(lists, "list", "left").select(
            F.explode(F.when(F.col("crowded"), sides).otherwise(F.array("list"))).alias("under"),
            F.col("word").alias(word),
            (first + F.shiftleft(last, 24) + F.shiftleft(longer, 48) + F.shiftleft(void, 49)).alias(marks),
        )

    one = met(index.withColumn("case", F.lit(SAME)), "word", "marks")
    two = met(shifted, "near", "near_marks")
    other = F.col("marks").bitwiseXOR(F.col("near_marks"))
    # One edit leaves the first or the last half of the shorter word as it is.
    halves = (other.bitwiseAND(F.lit(0xFFFFFF)) == 0) | (other.bitwiseAND(F.lit(0xFFFFFF << 24)) == 0)
    both_void = F.col("marks").bitwiseAND(F.col("near_marks")).bitwiseAND(F.lit(1 << 49)) != 0
    once = (F.col("near_marks").bitwiseAND(F.lit(1 << 48)) != 0) | (F.col("word") < F.col("near"))
    pairs = staged(
        one.join(two.hint("merge"), "under")
        .where(halves & once & ~both_void)
        .where(F.levenshtein("word", "near", 1) == 1)
        .select("word", "near")
        .distinct(),
        "pairs",
    )
    counts = words.select("word", "n")
    found = pairs.join(counts.hint("merge"), "word").join(
        counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge"), "near"
    )
    found = staged(found.select("word", "n", "near", "near_n"), "near")
    back = found.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                        F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.unionByName(back)


def _roots(forms: DataFrame) -> DataFrame:
    """Where the forms (``word``, ``form``) lead to: (``word``, ``root``). Each form occurs ``RATIO``
    times as often as its word, so the chains are short; every round doubles the steps taken."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = staged(
            now.join(measured(on), "root", "left")
            .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        if not new.where("moved").limit(1).count():
            return now
        now = new.select("word", "root")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", change: Change | None = None
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are maximal runs of letters (A-Z, a-z and U+00C0 to U+00FF; A-Z in lower case) of at least
    ``MIN_CHARS`` code points that occur at least ``MIN_COUNT`` times in all texts, ``n`` times.
    ``change`` may replace a document's words and their counts, given its key. Words are near if one
    inserted, deleted or replaced code point tells them apart; ``n_near`` counts a word's near words.
    ``form`` is the near word that occurs most, the first in code-point order of several, if it
    occurs at least ``RATIO`` times as often; ``root`` is where forms lead to. Null, empty and blank
    texts have no words; rows that repeat count as often as they occur; other columns are ignored,
    whatever their names; a table without words gives no rows.

    The texts are counted in their tasks, and only distinct words are shuffled. Near words are found
    by an index of grams of variable length (:func:`near_words`): grams in many words are made
    longer, each word is entered under so few of its rarest grams that a near word must share one at
    the same place or one beside it, and what meets there is verified. No list is cut off; words of
    a crowded one meet under longer keys (:func:`_sides`).
    """
    counted = word_counts(docs, key, text, change)
    words = staged(counted.where(F.col("n") >= MIN_COUNT), "words")
    near = near_words(words)
    best = staged(
        near.groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.first("n").alias("n"),
             F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
        .select("word", "n_near", F.when(-F.col("best.less") >= RATIO * F.col("n"), F.col("best.near")).alias("form"),
                (-F.col("best.less")).alias("form_n")),
        "best",
    )
    roots = _roots(best.where("form is not null"))
    return (
        words.join(best.hint("merge"), "word", "left")
        .join(roots.hint("merge"), "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"),
        )
    )


def misspell_some(doc_id: object, words: dict[str, int]) -> dict[str, int]:
    """A document's words, one in 31 of them, by the CRC-32 of id and word, without one letter. A null
    id leaves them as they are."""
    if doc_id is None:
        return words
    begun, out = zlib.crc32(f"{doc_id}:".encode()), {}
    crc, get = zlib.crc32, out.get
    for word, n in words.items():
        h = crc(word.encode(), begun)
        if h % 31 == 0:
            i = h % len(word)
            word = word[:i] + word[i + 1 :]
        out[word] = get(word, 0) + n
    return out
