"""Roles and turns of raw transcripts, recovered by a hidden Markov model over their lines."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.common import staged, text_of

ROLES = ["system", "user", "assistant"]
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
FOLDS = 5  # conversations whose crc32(id as text) mod FOLDS is 0 teach the model nothing
SMOOTHING = 0.5

# How speakers are marked, by role; the last form is no mark.
MARKS = {
    "system": ["System: ", "[system] ", "### System ", "Context - ", ""],
    "user": ["User: ", "Human: ", "Q: ", "### Instruction ", ""],
    "assistant": ["Assistant: ", "AI: ", "A: ", "### Response ", ""],
}
MARK = re.compile(
    r"\s*(?:\[?(system|context|user|human|q|assistant|ai|a)\]?\s*[:\]]"
    r"|###\s*(system|instruction|response)\b:?|(context)\s+-)\s*",
    re.IGNORECASE,
)
MEANT = {
    "system": "system", "context": "system", "user": "user", "human": "user", "q": "user",
    "instruction": "user", "assistant": "assistant", "ai": "assistant", "a": "assistant",
    "response": "assistant",
}


def marker(line: str) -> tuple[str, str]:
    """The role a line's mark speaks of (or ``none``), and the line without the mark."""
    found = MARK.match(line)
    if not found:
        return "none", line
    return MEANT[next(g for g in found.groups() if g).lower()], line[found.end() :]


def features(line: str) -> list[str]:
    """What the model sees of a line: mark, length, first and last character, list or code."""
    mark, rest = marker(line)
    rest = rest.strip()
    size = min(len(rest).bit_length(), 12)
    first = "blank" if not rest else "upper" if rest[0].isupper() else "lower" if rest[0].islower() \
        else "digit" if rest[0].isdigit() else "sign"
    last = rest[-1] if rest and rest[-1] in "?!.:,;" else "other"
    kind = "code" if rest.startswith(("```", "    ")) else "list" if rest[:2] in ("- ", "* ") else "text"
    return [f"mark={mark}", f"size={size}", f"first={first}", f"last={last}", f"kind={kind}"]


class Markov:
    """Log probabilities of starts, of transitions and of features by state."""

    def __init__(self, start: np.ndarray, step: np.ndarray, seen: dict[str, np.ndarray]):
        """All three as counts; impossible transitions (into another role's inside) stay so."""
        n = len(STATES)
        allowed = np.array(
            [[begins or role == a for role, begins in STATES] for a, _ in STATES], bool
        )
        opens = np.array([begins for _, begins in STATES])
        with np.errstate(divide="ignore"):
            self.start = np.log(np.where(opens, start + SMOOTHING, 0))
            self.start -= np.logaddexp.reduce(self.start)
            step = np.where(allowed, step + SMOOTHING, 0)
            self.step = np.log(step / step.sum(1, keepdims=True))
        names: dict[str, dict[str, np.ndarray]] = {}
        for feature, counts in seen.items():
            names.setdefault(feature.split("=")[0], {})[feature] = counts
        self.emit: dict[str, np.ndarray] = {}
        self.rare: dict[str, np.ndarray] = {}
        for name, values in names.items():
            total = sum(values.values()) + SMOOTHING * (len(values) + 1)
            self.rare[name] = np.log(SMOOTHING / total)
            self.emit |= {f: np.log((c + SMOOTHING) / total) for f, c in values.items()}
        self.flat = np.zeros(n)

    def emissions(self, line: str) -> np.ndarray:
        total = self.flat.copy()
        for f in features(line):
            value = self.emit.get(f)
            total += self.rare.get(f.split("=")[0], self.flat) if value is None else value
        return total

    def transfer(self, rows: list[np.ndarray], opening: bool) -> np.ndarray:
        """Best score from every state before the lines (any, at the opening) to every state of the
        last line: the max-plus product that lets parts of a transcript be scored apart."""
        matrix = (
            np.tile(self.start + rows[0], (len(STATES), 1)) if opening else self.step + rows[0]
        )
        for row in rows[1:]:
            matrix = (matrix[:, :, None] + self.step[None]).max(1) + row
        return matrix

    def path(self, rows: list[np.ndarray], entry: int | None, last: int | None) -> list[int]:
        """The best states of the lines (Viterbi), after state ``entry`` and up to state ``last``;
        of equal ones the first."""
        score = (self.start if entry is None else self.step[entry]) + rows[0]
        back = []
        for row in rows[1:]:
            options = score[:, None] + self.step
            back.append(options.argmax(0))
            score = options.max(0) + row
        states = [int(score.argmax()) if last is None else last]
        for pointers in reversed(back):
            states.append(int(pointers[states[-1]]))
        return states[::-1]


def raw_lines(turns: DataFrame) -> DataFrame:
    """Raw transcripts (``conv_id``, ``place``, ``line``, ``role``, ``begins``) of ``conversations``.

    Each conversation marks its speakers in one of the forms of ``MARKS``, chosen by its id, and
    about every fourth turn, chosen by a hash, has no mark at all. ``place`` (turn, number of the
    line in it, hash of the text) orders the lines. Role and beginning are the truth to compare
    with; the parser does not look at them.
    """
    text = text_of("text")
    style = F.pmod(F.xxhash64(F.col("conv_id").cast("string"), F.lit("style")), F.lit(4))
    bare = F.pmod(F.xxhash64(F.col("conv_id").cast("string"), F.col("turn").cast("string")),
                  F.lit(4)) == 0
    mark = F.lit("")
    for role, forms in MARKS.items():
        form = F.element_at(F.array(*map(F.lit, forms[:4])), (style + 1).cast("int"))
        mark = F.when((F.col("role") == role) & ~bare, form).otherwise(mark)
    return (
        turns.select("conv_id", "turn", "role", F.xxhash64(text).alias("tie"), mark.alias("mark"),
                     F.posexplode(F.split(text, "\n")).alias("at", "line"))
        .select(
            "conv_id", F.struct("turn", "tie", "at").alias("place"),
            F.when(F.col("at") == 0, F.concat("mark", "line")).otherwise(F.col("line"))
            .alias("line"),
            "role", (F.col("at") == 0).alias("begins"),
        )
    )


def _counts(lines: DataFrame) -> Markov:
    """A model counted from labelled lines of the conversations that are not held out. What comes
    to the driver is one row per state pair or per state and feature value."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).cast("binary")
    known = lines.where((F.crc32(key) % FOLDS != 0) & F.col("role").isin(ROLES))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted: dict[tuple, int] = {}
            for line, role, begins in zip(
                *(batch.column(c).to_pylist() for c in ("line", "role", "begins")), strict=True
            ):
                for f in features(line):
                    counted[role, begins, f] = counted.get((role, begins, f), 0) + 1
            rows = [(*k, v) for k, v in counted.items()]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = [pa.string(), pa.bool_(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["role", "begins", "feature", "n"],
            )

    seen: dict[str, np.ndarray] = {}
    emitted = known.select("line", "role", "begins").mapInArrow(
        emit, "role string, begins boolean, feature string, n bigint"
    )
    for r in emitted.groupBy("role", "begins", "feature").agg(F.sum("n").alias("n")).collect():
        row = seen.setdefault(r["feature"], np.zeros(len(STATES)))
        row[STATES.index((r["role"], r["begins"]))] += r["n"]
    # turns with their number of lines; the turn before is found by its number
    turns = known.groupBy("conv_id", F.col("place.turn").alias("turn"), "role").agg(
        F.count(F.lit(1)).alias("lines")
    )
    start, step = np.zeros(len(STATES)), np.zeros((len(STATES), len(STATES)))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("was"),
                          (F.col("lines") > 1).alias("long"))
    moves = turns.join(before.hint("merge"), ["conv_id", "turn"], "left")
    for r in moves.groupBy("was", "long", "role").agg(F.count(F.lit(1)).alias("n")).collect():
        to = STATES.index((r["role"], True))
        if r["was"] is None:
            start[to] += r["n"]
        else:
            step[STATES.index((r["was"], not r["long"])), to] += r["n"]
    inner = turns.where("lines > 1").groupBy("role").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lines").alias("lines")
    )
    for r in inner.collect():
        begin, inside = STATES.index((r["role"], True)), STATES.index((r["role"], False))
        step[begin, inside] += r["n"]
        step[inside, inside] += r["lines"] - 2 * r["n"]
    return Markov(start, step, seen)


def _runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows with equal keys."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != now and rows:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def _tables(rows: Iterator[tuple], names: list[str], kinds: list, size: int = 2000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _table(held, names, kinds)
            held = []
    yield _table(held, names, kinds)


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


PIECES = ["conv", "part", "turn", "tie", "at", "role", "begins", "n_lines", "content"]


def parse(lines: DataFrame, model: Markov) -> DataFrame:
    """Recovered turns of raw transcripts (``conv_id``, ``place``, ``line``): ``conv_id``, ``place``
    of the first line, ``role``, ``n_lines``, ``content`` (lines without the speaker's mark).

    The states are the best ones over a whole conversation, however long: lines are sorted into
    ranges of (``conv_id``, ``place``), so that a conversation may be spread over many tasks. Where
    it is, each part is reduced to the scores between its ends, the parts are chained (a few numbers
    each), and each is then decoded between the states so fixed; a turn that reaches over parts is
    put together at the end. Equal places are ordered by their lines. Rows without conversation id
    are one conversation; null lines are empty.
    """
    shared = lines.sparkSession.sparkContext.broadcast(model)
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    ranged = lines.select(
        conv.alias("conv"), "place", F.coalesce("line", F.lit("")).alias("line")
    ).repartitionByRange("conv", "place")
    cut = staged(ranged.withColumn("part", F.spark_partition_id()), "lines")

    def ordered(rows: DataFrame) -> DataFrame:
        return rows.repartition("conv", "part").sortWithinPartitions("conv", "part", "place", "line")

    # A border between ranges lies in one conversation, so there are fewer of these than partitions.
    spread = staged(
        cut.groupBy("conv").agg(F.countDistinct("part").alias("parts")).where("parts > 1")
        .select("conv"), "spread",
    )
    numbers = pa.list_(pa.float64())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            markov = shared.value
            for (name, part), run in _runs(batches, ["conv", "part"]):
                emitted = [markov.emissions(r["line"]) for r in run]
                both = [markov.transfer(emitted, opening) for opening in (True, False)]
                yield name, part, *[m.reshape(-1).tolist() for m in both]

        yield from _tables(rows(), ["conv", "part", "opening", "further"],
                           [pa.string(), pa.int32(), numbers, numbers])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield from _fixed(row["conv"], row["parts"])

        yield from _tables(rows(), ["conv", "part", "entry", "exit"],
                           [pa.string(), pa.int32(), pa.int32(), pa.int32()])

    scored = ordered(cut.join(F.broadcast(spread), "conv", "left_semi")).select(
        "conv", "part", "line"
    ).mapInArrow(score, "conv string, part int, opening array<double>, further array<double>")
    fixed = staged(
        scored.groupBy("conv")
        .agg(F.array_sort(F.collect_list(F.struct("part", "opening", "further"))).alias("parts"))
        .mapInArrow(chain, "conv string, part int, entry int, exit int"),
        "fixed",
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            markov = shared.value
            for (name, part), run in _runs(batches, ["conv", "part"]):
                emitted = [markov.emissions(r["line"]) for r in run]
                states = markov.path(emitted, run[0]["entry"], run[0]["exit"])
                piece: list = []
                for row, state in zip(run, states, strict=True):
                    role, begins = STATES[state]
                    if begins or not piece:
                        if piece:
                            yield tuple(piece[:-1]) + ("\n".join(piece[-1]),)
                        piece = [name, part, row["turn"], row["tie"], row["at"], role, begins, 0, []]
                    piece[-2] += 1
                    piece[-1].append(marker(row["line"])[1] if begins else row["line"])
                yield tuple(piece[:-1]) + ("\n".join(piece[-1]),)

        s, i, n = pa.string(), pa.int32(), pa.int64()
        yield from _tables(rows(), PIECES, [s, i, n, n, i, s, pa.bool_(), i, s], 500)

    between = cut.join(F.broadcast(fixed), ["conv", "part"], "left")
    pieces = staged(
        ordered(between)
        .select("conv", "part", "place.turn", "place.tie", "place.at", "line", "entry", "exit")
        .mapInArrow(
            decode,
            "conv string, part int, turn bigint, tie bigint, at int, role string, begins boolean, "
            "n_lines int, content string",
        ),
        "pieces",
    ).withColumn("place", F.struct("turn", "tie", "at"))

    # Only parts of a spread conversation can start inside a turn.
    some = pieces.join(F.broadcast(spread), "conv", "left_semi")
    heads = (
        some.where("begins").groupBy("conv", "part").agg(F.max("place").alias("head"))
        .groupBy("conv").agg(F.collect_list(F.struct("part", "head")).alias("heads"))
    )
    earlier = F.filter("heads", lambda h: h["part"] < F.col("part"))
    tails = some.where("not begins").join(heads, "conv").select(
        "conv", F.array_max(F.transform(earlier, lambda h: h["head"])).alias("start"), "place",
        F.lit(None).cast("string").alias("role"), "n_lines", "content",
    )
    tails = staged(tails, "tails")
    opened = pieces.where("begins").select(
        "conv", F.col("place").alias("start"), "place", "role", "n_lines", "content"
    )
    cut_turns = F.broadcast(tails.select("conv", "start").distinct())  # fewer than partitions too
    torn = opened.join(cut_turns, ["conv", "start"], "left_semi").unionByName(tails)
    mended = torn.groupBy("conv", "start").agg(
        F.max("role").alias("role"), F.sum("n_lines").cast("int").alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "content"))),
                                 lambda x: x["content"]), "\n").alias("content"),
    )
    whole = opened.join(cut_turns, ["conv", "start"], "left_anti")
    columns = ["conv", "start", "role", "n_lines", "content"]
    kind = lines.schema["conv_id"].dataType
    return whole.select(*columns).unionByName(mended.select(*columns)).select(
        F.when(F.col("conv") != "-", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id"),
        F.col("start").alias("place"), "role", "n_lines", "content",
    )


def _fixed(name: str, parts: list[dict]) -> Iterator[tuple]:
    """For every part of a conversation, the state before it and its last state on the best path."""
    n = len(STATES)
    matrices = [
        np.array(p["further" if i else "opening"]).reshape(n, n) for i, p in enumerate(parts)
    ]
    score, back = matrices[0][0], []
    for matrix in matrices[1:]:
        options = score[:, None] + matrix
        back.append(options.argmax(0))
        score = options.max(0)
    exits = [int(score.argmax())]
    for pointers in reversed(back):
        exits.append(int(pointers[exits[-1]]))
    exits.reverse()
    for i, part in enumerate(parts):
        yield name, part["part"], exits[i - 1] if i else None, exits[i]


def rendered(role: Column, content: Column) -> Column:
    """A turn in canonical form. Control marks in the content get one more backslash after their
    ``<`` than they have, so that no content reads as another turn."""
    safe = F.regexp_replace(content, r"<(\\*)\|im_(start|end)\|>", r"<\\$1|im_$2|>")
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), safe, F.lit("<|im_end|>\n"))


def turns_of(text: Column) -> Column:
    """The turns (``role``, ``content``) of text in canonical form, one turn or many; null for null."""

    def turn(part: Column) -> Column:
        role = F.regexp_extract(part, r"^<\|im_start\|>([^\n]*)\n", 1)
        content = F.regexp_replace(part, r"^<\|im_start\|>[^\n]*\n", "")
        return F.struct(
            role.alias("role"),
            F.regexp_replace(content, r"<\\(\\*)\|im_(start|end)\|>", r"<$1|im_$2|>").alias("content"),
        )

    parts = F.split(text, r"<\|im_end\|>\n")
    return F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def canonical(conversations: DataFrame) -> DataFrame:
    """The turns recovered from the raw transcripts of ``conversations`` (``conv_id``, ``turn``,
    ``role``, ``text``), in canonical form: ``conv_id``, ``turn`` and ``line`` where each was found
    to begin, ``role``, ``n_lines``, ``rendered``.

    The model is counted from the conversations that are not held out (:func:`_counts`); without
    any it still reads clear marks by the smoothing alone. Null texts are empty lines, roles other
    than ``ROLES`` (null too) are transcribed without a mark and teach nothing; a null turn comes
    first; repeated rows are repeated lines. Control marks in the texts are escaped;
    :func:`turns_of` reads them back.
    """
    lines = raw_lines(conversations)
    found = parse(lines.select("conv_id", "place", "line"), _counts(lines))
    return found.select(
        "conv_id", F.col("place.turn").alias("turn"), F.col("place.at").alias("line"), "role",
        "n_lines", rendered(F.col("role"), F.col("content")).alias("rendered"),
    )
