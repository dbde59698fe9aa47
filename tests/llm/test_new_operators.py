"""Periodic runs, spelling variants and repeated bytes against brute force on small inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from outlay.llm import periodic_runs, queries, spelling, suffix_family

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, word string, n bigint, key string, runs int, start string"


def frame(spark, rows):
    """Documents with other columns whose names clash with those the operators use."""
    return spark.createDataFrame([(*r, "w", 1, "k", 2, "s") for r in rows], DOCS)


def slow_runs(words):
    """Every period, every place."""
    n, out = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((a, b - a, p) for (a, b), p in out.items()), key=lambda r: (r[0], r[2]))


def test_catchers_find_all_runs_however_words_are_appended():
    r = random.Random(1)
    for _ in range(400):
        n = r.randrange(0, 90)
        words = [r.randrange(r.choice([1, 2, 3])) for _ in range(n)]
        if n and r.random() < 0.7:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randrange(3, 11)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        whole, parts, at = periodic_runs.Catchers(longest=n), periodic_runs.Catchers(), 0
        whole.append(np.array(words, np.int64))
        while at < n:
            size = r.randrange(1, 6)
            parts.append(np.array(words[at : at + size], np.int64))
            at += size
        assert whole.runs() == parts.runs() == slow_runs(words)


def test_catchers_on_a_long_repetition():
    catchers = periodic_runs.Catchers()
    catchers.append(np.arange(100_000) % 3000)
    assert catchers.runs() == [(0, 100_000, 3000)]


def runs_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *first, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_runs_of_documents(spark):
    r = random.Random(7)
    rows = [(i, " ".join(r.choice("ab cä A a b".split(" ")) for _ in range(r.randrange(60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (None, "x " * 50), (103, "y\x0b" * 9), (103, "y\x0b" * 9),
             (104, "p q r " * 3000), (105, "a a a a a"), (106, "a b " * 4)]
    docs = frame(spark, rows)
    found = periodic_runs.word_runs(docs, edit=periodic_runs.repeat_some)
    assert by_text(periodic_runs.run_digests(found).collect()) == by_text(runs_row(*x) for x in rows)
    plain = {x.doc_id: x for x in periodic_runs.word_runs(docs).collect()}
    assert [tuple(x) for x in plain[104].runs] == [(0, 9000, 3)] and plain[104].collapsed == "p q r"
    assert plain[105].runs == [] and plain[100].collapsed == "" and plain[106].collapsed == "a b"
    assert periodic_runs.word_runs(frame(spark, [])).count() == 0


def test_runs_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_periodic_runs(spark, SMALL).collect()
    assert by_text(got) == by_text(runs_row(*x) for x in rows)
    assert any(x.n_runs for x in got)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(rows, misspell=True):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if misspell and doc_id is not None and h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            count[word] += 1
    count = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    # words one edit apart are equal without one code point each, or one without one is the other
    lists = {}
    for w in count:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            lists.setdefault(x, set()).add(w)
    close = {w: set() for w in count}
    for group in lists.values():
        for a in group:
            close[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in count.items():
        best = min(close[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best and count[best] >= 10 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return [(w, form[w], root(w), n, len(close[w]), count.get(form[w])) for w, n in count.items()]


@pytest.mark.parametrize(("frequent", "crowded", "bound"), [(64, 32, 10**6), (3, 2, 10**6), (1, 0, 10**6), (1, 3, 40)])
def test_variants_of_documents(spark, monkeypatch, frequent, crowded, bound):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    monkeypatch.setattr(spelling, "CROWDED", crowded)
    monkeypatch.setattr(spelling, "MOST_GRAMS", bound)
    r = random.Random(frequent)
    words = ["".join(r.choice("abä") for _ in range(r.randrange(6, 12))) for _ in range(150)]
    rows = [(i, " ".join(r.choice(words[: r.randrange(1, 150)]) for _ in range(60))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "12 --"), (None, "Großbuchstabe großbuchstabe ÄABBABAB"),
             (103, "aaaaaaa" * 50), (103, "aaaaaaa" * 50), (104, "naïvetés-naïvetés x×xxxxx÷ X×XXXXX÷")]
    got = spelling.spelling_variants(frame(spark, rows), change=spelling.misspell_some).collect()
    assert by_text(got) == by_text(slow_variants(rows))
    got = spelling.spelling_variants(frame(spark, rows)).collect()
    assert by_text(got) == by_text(slow_variants(rows, misspell=False))


def test_variants_without_words(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
    assert spelling.spelling_variants(frame(spark, [(1, None), (2, "short words")])).count() == 0


def test_variants_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_spelling_variants(spark, SMALL).collect()
    assert by_text(got) == by_text(slow_variants(rows)) and any(x.form for x in got)


def cut_rows(rows, length=suffix_family.LENGTH):
    first = {}
    rank = lambda k: (k is None, k)
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            first[s] = min(first.get(s, rank(doc_id)), rank(doc_id))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < rank(doc_id):
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repetitive(seed):
    """Texts made of common passages, with edits; ids out of order, repeated and missing."""
    r = random.Random(seed)
    passages = ["".join(r.choice("abcdefgh äé\n\0") for _ in range(r.randrange(20, 300))) for _ in range(12)]
    rows = []
    for i in range(80):
        text = "".join(r.choice(passages) if r.random() < 0.6 else "".join(r.choice("xyz ") for _ in range(30))
                       for _ in range(r.randrange(6)))
        if text and r.random() < 0.5:
            at = r.randrange(len(text))
            text = text[:at] + "#" + text[at + r.randrange(2) :]
        rows.append((r.choice([i, i, i, i // 2, None]), text))
    rows += [(200, None), (201, ""), (202, "ab" * 4000), (203, "ab" * 3000), (203, "ab" * 3000), (204, "x" * 49)]
    return rows


@pytest.mark.parametrize("crowded", [suffix_family.CROWDED, 1])
@pytest.mark.parametrize(("batches", "block"), [(4, 300), (1, 4 << 20), (7, 2000)])
def test_bytes_of_earlier_documents(spark, monkeypatch, crowded, batches, block):
    monkeypatch.setattr(suffix_family, "CROWDED", crowded)
    monkeypatch.setattr(suffix_family, "BATCHES", batches)
    monkeypatch.setattr(suffix_family, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_family, "LEAST_BUCKETS", 5)
    rows = repetitive(batches)
    found = suffix_family.without_repeated_bytes(frame(spark, rows))
    assert by_text(suffix_family.removal_digests(found).collect()) == by_text(cut_rows(rows))


def test_levels_are_not_written(spark, monkeypatch):
    written = []
    path = suffix_family.new_table_path
    monkeypatch.setattr(suffix_family, "new_table_path", lambda s, name: written.append(name) or path(s, name))
    monkeypatch.setattr(suffix_family, "LEAST_BUCKETS", 3)
    rows = repetitive(5)
    found = suffix_family.without_repeated_bytes(frame(spark, rows))
    assert by_text(suffix_family.removal_digests(found).collect()) == by_text(cut_rows(rows))
    assert written == ["blocks", "texts", "found"]


@pytest.mark.parametrize("clash", [False, True])
def test_suffix_array_of_texts_that_share_suffixes(monkeypatch, clash):
    if clash:  # all hashes are one
        monkeypatch.setattr(suffix_family, "mix", lambda x: np.zeros_like(x))
    rng = np.random.default_rng(3)
    length = suffix_family.LENGTH
    for letters in (1, 2, 3, 20):
        sizes = rng.integers(1, 40, 9).astype(np.int32)
        data = rng.integers(97, 97 + letters, int((sizes + length - 1).sum())).astype(np.uint8).tobytes() * 2
        sizes, places = np.tile(sizes, 2), rng.integers(0, 6, 18)
        texts = suffix_family.Texts(data, sizes, places, np.zeros(18, np.uint8))
        at, number = suffix_family.suffix_array(texts)
        own = [data[i : i + length] for i in texts.suffixes().tolist()]
        want = sorted(set(own))
        assert [data[i : i + length] for i in at.tolist()] == want
        assert [want[i] for i in number.tolist()] == own
        least = {}
        for s, place in zip(own, np.repeat(places, sizes).tolist(), strict=True):
            least[s] = min(place, least.get(s, place))
        assert places[texts.owners(at)].tolist() == [least[s] for s in want]


def test_bytes_of_documents_with_other_keys(spark):
    rows = [(None if k is None else f"k{k:04}", t) for k, t in repetitive(9)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = suffix_family.removal_digests(suffix_family.without_repeated_bytes(docs))
    assert by_text(found.collect()) == by_text(cut_rows(rows))
    assert suffix_family.without_repeated_bytes(frame(spark, [])).count() == 0
    one = suffix_family.without_repeated_bytes(frame(spark, [(None, None)])).collect()
    assert [(x.doc_id, x.n_bytes, x.spans, bytes(x.kept)) for x in one] == [(None, 0, [], b"")]


def test_bytes_query(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    got = queries.op11_suffix_family(spark, SMALL).collect()
    assert by_text(got) == by_text(con.execute(queries.oracle_sql()["op11_suffix_family"]).fetchall())
    assert any(x.n_removed for x in got)
