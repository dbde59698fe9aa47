"""Ranges of words against marking words one by one."""

import random

import numpy as np
import pyarrow as pa
import pytest

from outlay.llm import substrings
from outlay.llm.substrings import MIN_RUN

MARK = pa.struct([("k", pa.int32()), ("value", pa.int64()), ("no", pa.int64()), ("word", pa.int32())])
RANGE = pa.struct(
    [("word", pa.int32()), ("size", pa.int32()), ("cluster", pa.int64()), ("low_no", pa.int64()),
     ("low_word", pa.int32()), ("marks", pa.list_(MARK))]
)
KINDS = [("_id", pa.string()), ("_text", pa.int64()), ("no", pa.int64()), ("head", pa.int64()),
         ("copy", pa.bool_()), ("copied", pa.bool_()), ("ranges", pa.list_(RANGE)), ("text", pa.string())]


def _row(rng, i):
    n = rng.choice([0, 5, 60, 200])
    ranges = []
    for _ in range(rng.randrange(5) if n > 5 else 0):
        word = rng.randrange(n - 5)
        size = rng.randint(1, n - word)
        if rng.random() < 0.6:
            own = rng.random() < 0.5
            low = (i, word) if own else (rng.randrange(3), rng.randrange(9))
            ranges.append(dict(word=word, size=size, cluster=rng.randrange(99), low_no=low[0],
                               low_word=low[1], marks=None))
        elif word + MIN_RUN <= n:
            marks = [
                dict(k=k, value=rng.randrange(99), no=rng.choice([i, 0]), word=word + k)
                for k in range(n - word - MIN_RUN + 1) if rng.random() < 0.4
            ]
            ranges.append(dict(word=word, size=size, cluster=7, low_no=None, low_word=None, marks=marks))
    copy = rng.random() < 0.2
    return dict(_id=str(i), _text=1000 + i, no=i, head=rng.randrange(5) if copy else None, copy=copy,
                copied=copy or rng.random() < 0.4, ranges=None if copy or not ranges else ranges,
                text=" ".join(f"w{j}" for j in range(n)))


def _touching(n, runs):
    """Runs that overlap or touch, found by marking words and the borders between them."""
    inside, border = np.zeros(n + 1, bool), np.zeros(n + 2, bool)
    for a, b in runs:
        inside[a:b] = True
        border[a + 1 : b] = True
    for a, _ in runs:  # a run that begins where another ends goes on
        border[a] |= any(x < a <= y for x, y in runs)
    out, at = [], 0
    while at < n:
        if inside[at]:
            end = at + 1
            while end < n and inside[end] and border[end]:
                end += 1
            out.append((at, end))
            at = end
        else:
            at += 1
    return out


def _expected(row):
    n = len(row["text"].split())
    if row["copy"]:
        return [(True, 0, n)] if n >= MIN_RUN else []
    gone, stay = [], []
    for x in row["ranges"] or ():
        if x["marks"] is None:
            moved = (x["low_no"], x["low_word"]) != (row["no"], x["word"])
            (gone if moved else stay).append((x["word"], x["word"] + x["size"]))
        else:
            for m in x["marks"]:
                a = x["word"] + m["k"]
                (gone if (m["no"], m["word"]) != (row["no"], a) else stay).append((a, a + MIN_RUN))
    gone = _touching(n, gone)
    if row["copied"]:
        kept = [w for w in range(n - MIN_RUN + 1) if not any(a <= w and w + MIN_RUN <= b for a, b in gone)]
        stay += [(w, w + MIN_RUN) for w in kept]
    return [(kind, a, b) for kind, runs in ((True, gone), (False, _touching(n, stay)))
            for a, b in runs if b - a >= MIN_RUN]


@pytest.mark.parametrize("seed", range(20))
def test_spans_are_those_of_words_marked_one_by_one(seed):
    rng = random.Random(seed)
    rows = [_row(rng, i) for i in range(rng.choice([1, 3, 40]))]
    batch = pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in KINDS],
                                       [c for c, _ in KINDS])
    got = sorted((int(x["_id"]), x["removed"], x["first"], x["last"], x["words"])
                 for part in substrings._merge([batch]) for x in part.to_pylist())
    want = []
    for i, row in enumerate(rows):
        words = row["text"].split()
        for kind, a, b in _expected(row):
            first, last = len(" ".join(words[:a])) + (a > 0), len(" ".join(words[:b]))
            want.append((i, kind, first, last, b - a))
    assert got == sorted(want)
