"""Operators on texts against brute force and the libraries."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outlay.llm import exact_dedup, fingerprints, ngram_join, packing, pieces, simple8b, substrings
from outlay.llm.shingles import shingle_sets
from outlay.llm.tokens import Encoder

DOCS = "doc_id bigint, text string, lang string, _id string, kept int, cls string"

ODD = [
    "", " ", "  ", "a", "\n", "a \n b", " a  b   c ", "it's DON'T ''s", "İstanbul é", "<|endoftext|> x",
    "𝒳y 漢字 12 3a_b", "a\tb\r\nc", "tail ", "of " * 400, "x" * 3000,
]


def table(spark, rows):
    """Documents with columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(i, t, "en", "own", 7, "c") for i, t in rows], DOCS)


def noise(n, seed, words=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


CORPUS = (
    [(i, noise(60, i, 5000)) for i in range(40)]
    + [(100 + i, noise(60, 1, 5000)) for i in range(5)]
    + [(200, None), (201, ""), (202, "Ab c"), (203, "aB C"), (204, "ab"), (None, "lost"), (None, "LOST")]
    + [(300, noise(3000, 77, 50000)), (301, noise(3000, 77, 50000) + " more")]
    + [(400, "same row"), (400, "same row")]
)


def test_exact_groups(spark):
    got = exact_dedup.exact_groups(table(spark, CORPUS), hash_all=True).collect()
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    groups = defaultdict(list)
    for i, t in CORPUS:
        groups[(t or "").translate(lower)].append(i)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(got) == len(CORPUS)
    for r in got:
        ids = by_hash[r.text_sha256]
        keep = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (keep, len(ids))
        assert not r.kept or r.doc_id == keep
    assert sum(r.kept for r in got) == len(groups)
    settled = exact_dedup.exact_groups(table(spark, CORPUS))
    alone = {hashlib.sha256(t.encode()).hexdigest() for t, ids in groups.items() if len(ids) == 1}
    hashed = {r.text_sha256 for r in settled.collect()} - {None}
    assert not hashed & alone


def test_dropping_keeps_columns_and_one_row_of_each(spark):
    docs = table(spark, CORPUS)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    texts = [(r.text or "").lower() for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({(t or "").lower() for _, t in CORPUS})


def test_empty_tables(spark):
    docs = table(spark, [])
    assert exact_dedup.drop_exact_duplicates(docs).count() == 0
    assert ngram_join.drop_similar(docs).count() == 0
    assert substrings.drop_repeated_passages(docs).count() == 0
    assert fingerprints.edit_likeness(docs).count() == 0
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(docs, path, 0).count() == 0
    assert simple8b.through_files(docs, path, 0).count() == 0
    assert pieces.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def _shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def _components(rows, k, percent):
    sets = [_shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_similar_groups_against_all_pairs(spark, k, percent):
    r = random.Random(5)
    base = noise(150, 9, 10**6).split()
    rows = [(1000, " ".join(base))]
    for i in range(60):  # near copies with one to ten edits, some of them shared
        words = list(base)
        for _ in range(r.randrange(1, 10)):
            words[r.choice([3, 40, 41, r.randrange(150)])] = f"new{r.randrange(40)}"
        rows.append((1001 + i, " ".join(words)))
    passage = noise(40, 10, 10**6)
    rows += [(2000 + i, passage + " " + noise(r.randrange(5, 60), i, 10**6)) for i in range(40)]
    rows += [x for x in CORPUS if x[0] is not None]
    got = ngram_join.similar_groups(table(spark, rows), k, percent).collect()
    roots, sets = _components(rows, k, percent)
    members = defaultdict(list)
    for (i, _), root in zip(rows, roots, strict=True):
        members[root].append(i)
    want = sorted(
        (i, len(s), min(members[root])) for (i, _), root, s in zip(rows, roots, sets, strict=True)
    )
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == want
    left = ngram_join.drop_similar(table(spark, rows), k, percent).collect()
    blank = sum(not s for s in sets)
    distinct = {root for root, s in zip(roots, sets, strict=True) if s}
    assert len(left) == len(distinct) + blank


def test_passages_are_found_inside_lines_and_cut(spark):
    passage = noise(70, 3, 10**6)
    rows = [
        (i, f"{noise(30, 50 + i, 10**6)} {passage} {noise(40, 90 + i, 10**6)}\n{noise(25, 130 + i, 10**6)}")
        for i in range(8)
    ]
    rows += [(100 + i, noise(80, 200 + i, 10**6)) for i in range(8)] + [(200, None), (201, ""), (None, "a b c")]
    docs = table(spark, rows)
    found = substrings.repeated_passages(docs).collect()
    assert {r.doc_id for r in found} == set(range(8))
    assert {r.doc_id for r in found if not r.removed} == {0}
    texts = dict(rows)
    for r in found:
        span = texts[r.doc_id].encode()[r.start : r.end].decode().split()
        assert len(span) == r.n_words >= substrings.MIN_RUN
        # a paragraph at either end may hold a few words of its own and still be alike
        assert sum(w in passage.split() for w in span) >= 0.8 * len(span)
    left = {r.doc_id: r for r in substrings.drop_repeated_passages(docs).collect()}
    assert len(left) == len(rows)
    assert all((left[i].text or "") == (t or "") for i, t in rows if i is None or i >= 100 or i == 0)
    assert sum(passage[200:240] in left[i].text for i in range(8)) == 1


def test_fingerprints(spark):
    rows = CORPUS[:-2]
    got = fingerprints.edit_likeness(table(spark, rows)).collect()
    assert len(got) == len(rows)
    ordered = sorted(r for r in rows if r[0] is not None)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for (i, t), (_, after) in zip(ordered[:-1], ordered[1:], strict=True):
        t, after, r = t or "", after or "", by[i]
        changed = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert (r.n_chars, r.fingerprint) == (len(t), fingerprints.fingerprint(t))
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.edited_fingerprint == fingerprints.fingerprint(changed)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert by[301].near_next == 0 and by[300].near_next > 0.8 and 0.2 < by[5].near_edited < 0.9
    assert len({r.fingerprint for r in got if r.doc_id in (1, 100, 101)}) == 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(name):
    r = random.Random(2)
    letters = " \n\t'abcsétΣ1.-_<|> ́漢 "
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randrange(1, 50))) for _ in range(1500)]
    encoder = Encoder(public_tokenizers.path(name))
    for _ in range(2):  # the second time from what is known
        got = [x.tolist() for x in encoder.ids(texts)]
    assert got == [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300), max_size=1500))
def test_simple8b_round_trip(ids):
    array = np.array(ids, np.uint64)
    words, offsets = simple8b.encode(array)
    assert simple8b.decode(words, offsets, len(ids)).tolist() == ids


def test_ids_through_files(spark):
    rows = [(i, t) for i, t in CORPUS if i is not None][:-2] + list(enumerate(ODD, 1000)) + [(None, "x y")]
    path = public_tokenizers.path("word_bpe_49k.json")
    got = sorted(simple8b.through_files(table(spark, rows), path, 2).collect(), key=lambda r: r.start)
    library, start = Encoder(path).library, 0
    for (i, t), r in zip(sorted(rows, key=lambda x: (x[0] is not None, x)), got, strict=True):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(r) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    alone = simple8b.through_files(table(spark, [(None, "x"), (None, None)]), path, 2).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in alone) == [(None, 0, 1), (None, 1, 2)]


def test_windows_are_as_full_as_can_be():
    assert sorted(map(sorted, packing.windows(np.array([600, 424, 1000, 24, 1024, 3])))) == [
        [0, 1], [2, 3], [4], [5]
    ]
    r = np.random.default_rng(1)
    sizes = r.integers(1, 1024, 3000)
    found = packing.windows(sizes)
    assert sorted(i for w in found for i in w) == list(range(3000))
    filled = [sizes[w].sum() for w in found]
    assert max(filled) <= 1024 and sum(filled) / (1024 * len(filled)) > 0.99


def test_pieces_of_packed_documents(spark):
    rows = CORPUS + list(enumerate(ODD, 1000))
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(table(spark, rows), path, 0).toPandas()
    library = Encoder(path).library
    want = defaultdict(int)
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for s in range(0, len(ids), 1024):
            piece = ids[s : s + 1024]
            want[(i, s, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    have = defaultdict(int)
    for r in got.itertuples():
        key = None if r.doc_id != r.doc_id else int(r.doc_id)
        have[(key, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
    assert have == want
    for _, rows_of in got.groupby("sequence_id"):
        ordered = rows_of.sort_values("offset")
        assert ordered.offset.tolist() == [0, *ordered.length.cumsum().tolist()[:-1]]
        assert ordered.length.sum() <= 1024


def test_pieces_are_those_of_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(3)
    texts = ODD + ["".join(r.choice(" \n\tabcsétΣ1.-<|>漢𝒳thein") for _ in range(r.randrange(1, 60))) for _ in range(800)]
    model = pieces.Model(path)
    got = model.encode(texts)
    assert [x.tolist() for x in got] == library.encode(texts)
    assert [model.decode(x) for x in got] == texts


def test_unigram_paths_have_the_best_score():
    model = pieces.Model(public_tokenizers.path("piece_bpe_32k.model"), "unigram")
    known = {model.texts[i]: model.scores[i] for i in model.ids.tolist()}
    for text in ("the inthe reand the", "hello world thing", "ation of nations"):
        marked = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-np.inf] * len(marked)
        for i in range(len(marked)):
            for j in range(i + 1, min(len(marked), i + model.longest) + 1):
                best[j] = max(best[j], best[i] + known.get(marked[i:j], -np.inf))
        assert sum(model.scores[model.encode([text])[0].astype(int)]) == best[-1]


def test_pieces_of_odd_rows(spark):
    rows = CORPUS + list(enumerate(ODD, 1000))
    got = pieces.encode_and_decode(table(spark, rows), public_tokenizers.path("piece_bpe_32k.model"))
    assert got.where(F.col("same")).count() == got.count() == len(rows)


def _removed_words(spans, texts):
    return {i: sum(len(texts[i].encode()[r.start : r.end].split()) for r in spans
                   if r.doc_id == i and r.removed) for i in texts}


def test_passages_in_short_lines_are_found(spark):
    words = noise(60, 3, 10**6).split()
    laid = "\n".join(" ".join(words[i : i + 4]) for i in range(0, 60, 4))
    texts = {i: f"{noise(30, 50 + i, 10**6)}\n{laid}\n{noise(30, 90 + i, 10**6)}" for i in range(3)}
    found = substrings.repeated_passages(table(spark, list(texts.items()))).collect()
    assert _removed_words(found, texts) == {0: 0, 1: 60, 2: 60}


def test_lines_alike_are_found_whole(spark):
    texts = {}
    for i in range(20):  # one changed word in 50: similarity 0.84
        words = noise(50, i, 10**6).split()
        texts[i] = " ".join(words)
        texts[100 + i] = " ".join([*words[:25], "changed", *words[26:]])
    found = substrings.repeated_passages(table(spark, list(texts.items()))).collect()
    got = _removed_words(found, texts)
    assert all(got[i] == 0 and got[100 + i] == 50 for i in range(20))


def test_lines_alike_meet_beside_a_frequent_phrase(spark):
    phrase, texts = noise(5, 1, 10**6), {}
    for i in range(50):
        texts[i] = f"{phrase} {noise(17, 100 + i, 10**6)}"
    for i in range(20):
        rest = noise(30, 1000 + i, 10**6).split()
        texts[500 + i] = " ".join([phrase, *rest])
        texts[600 + i] = " ".join([phrase, *rest[:-1], "changed"])
    got = _removed_words(
        substrings.repeated_passages(table(spark, list(texts.items()))).collect(), texts
    )
    assert all(got[600 + i] == 35 for i in range(20)) and not any(got[i] for i in texts if i < 600)


def test_equal_runs_are_those_of_brute_force(spark):
    r = random.Random(8)
    pool = [noise(45, i, 10**6).split() for i in range(6)]
    texts = {}
    for i in range(40):
        words = noise(5, 1000 + i, 10**6).split()
        for _ in range(3):
            part, a = r.choice(pool), r.randrange(20)
            words += part[a : a + r.randrange(10, 40)] + noise(r.randrange(1, 4), r.random(), 10**6).split()
        texts[i] = " ".join(words)
    texts |= {100: "a b c d " * 30, 101: "la " * 24, 102: None}
    found = substrings.repeated_passages(table(spark, list(texts.items()))).collect()
    places = defaultdict(list)
    for i, t in texts.items():
        words = (t or "").split()
        for a in range(len(words) - 19):
            places[tuple(words[a : a + 20])].append((i, a))
    want = defaultdict(set)
    for at in places.values():
        for i, a in at[1:]:
            want[i] |= set(range(a, a + 20))
    got = defaultdict(set)
    for s in found:
        if s.removed:
            before = len(texts[s.doc_id].encode()[: s.start].split())
            got[s.doc_id] |= set(range(before, before + s.n_words))
    assert got == want


def test_every_part_of_a_text_has_its_letter():
    r = random.Random(4)
    for i in range(30):  # repeated lines first, whose cuts recur
        line = noise(12, i, 10**6) + "\n"
        text = line * 150 + noise(600, 100 + i, 10**6)
        other = text[: -len(text) // 4] + noise(500, 200 + i, 10**6)
        size, one, two = fingerprints.parts(text)
        assert max(len(one), len(two)) <= fingerprints.SIGNATURE
        h = fingerprints.rolling(np.frombuffer(text.encode(), np.uint8))
        cuts = np.flatnonzero(h % np.uint32(size) == 0)
        assert len(one) == len(cuts) + (not len(cuts) or cuts[-1] < len(h) - 1)
        assert size == 1 or (h % np.uint32(size // 2) == 0).sum() >= fingerprints.SIGNATURE
        assert fingerprints.fingerprint(other) != fingerprints.fingerprint(text)


def test_shingles_are_counted_in_packed_rows(spark):
    """Not a row for every shingle: those are some hundred times the documents."""
    passage = noise(40, 10, 10**6)
    texts = [f"{noise(30, 100 + i, 10**6)} {passage if i < 70 else ''} {passage[:120] if i % 2 else ''}" for i in range(90)]
    rows = table(spark, list(enumerate(texts))).select("text").repartition(3)
    packed = ngram_join._all_shingles(rows, 5, 4)
    assert packed.count() <= 3 * 4
    counts = Counter(x for s in shingle_sets(texts, 5) for x in s.tolist())
    want = {x: n.bit_length() - 1 for x, n in counts.items() if n > ngram_join.FREQUENT}
    tokens, levels = ngram_join._frequent(packed)
    assert want and dict(zip(tokens.tolist(), levels.tolist(), strict=True)) == want


def test_more_frequent_shingles_than_fit_cost_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "MOST_FREQUENT", 20)
    passage = noise(40, 10, 10**6)
    rows = [(i, f"{passage} {noise(30, 100 + i, 10**6)}") for i in range(40)]
    rows += [(100 + i, f"{t} more") for i, t in rows[:5]]
    first = []
    real = ngram_join._frequent
    monkeypatch.setattr(ngram_join, "_frequent", lambda x: first.append(real(x)) or first[-1])
    got = ngram_join.similar_groups(table(spark, rows)).collect()
    assert len(first[0][0]) and not len(first[1][0])
    assert {r.doc_id: r.component_id for r in got} == {i: i % 100 for i, _ in rows}


def test_members_of_one_group_are_not_written_as_all_pairs(spark, monkeypatch):
    """Texts alike in their first shingles by hash, linked only through each other or not at all."""
    words = noise(400, 5, 10**6).split()
    rows = [(i, " ".join([*words[:300], *noise(1 + i % 7, 900 + i, 10**6).split(), *words[300:]])) for i in range(60)]
    rows += [(100 + i, " ".join(words[40 * (i % 4) : 40 * (i % 4) + 240])) for i in range(20)]
    written = []
    verify = ngram_join._linked

    def counted(pairs, *more):
        written.append(pairs.count())
        return verify(pairs, *more)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    got = ngram_join.similar_groups(table(spark, rows), 5, 80).collect()
    roots, sets = _components(rows, 5, 80)
    least = {}
    for (i, _), root in zip(rows, roots, strict=True):
        least[root] = min(i, least.get(root, i))
    want = {i: (len(s), least[root]) for (i, _), root, s in zip(rows, roots, sets, strict=True)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert written[0] < 60 * 59 // 2
