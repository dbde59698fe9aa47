"""SentencePiece encoding by suffix-array matching, and decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.llm.common import arrow_rows, text_of
from outlay.llm.tokens import crc

SPACE = "▁"  # what a space is in a piece
NONE = np.iinfo(np.int32).max
KNOWN = 600_000  # words a process keeps the ids of; beyond, it starts anew
ROWS_AT_ONCE = 256
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Model:
    """Vocabulary of a SentencePiece model with identity normalisation, and its use.

    ``kind`` is how edges are relaxed: ``bpe`` (merges in the order of their scores) or ``unigram``
    (best sum of scores). Characters no piece covers become their UTF-8 bytes where the model has
    byte pieces, else the unknown id. The text must not contain U+2581 itself.
    """

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.vocab_size()
        self.kind, self.unknown = kind, library.unk_id()
        self.texts = [library.id_to_piece(i) for i in range(size)]
        self.bytes = np.full(256, -1, np.int64)
        plain = np.zeros(size, bool)
        for i, piece in enumerate(self.texts):
            if library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            else:
                plain[i] = not (
                    library.is_control(i) or library.is_unknown(i) or library.is_unused(i)
                )
        self.ids = np.flatnonzero(plain)
        self.scores = np.array([library.get_score(i) for i in range(size)])
        self.lengths = np.array([len(p) for p in self.texts])
        self.longest = int(self.lengths[self.ids].max())
        chars = "".join(self.texts[i] for i in self.ids)
        self.flat = np.frombuffer(chars.encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(self.flat)  # other characters match nothing
        # rank of a piece among merges: higher scores first
        order = np.argsort(-self.scores[self.ids], kind="stable")
        self.rank = np.full(size, NONE, np.int32)
        self.rank[self.ids[order]] = np.arange(len(order))
        # words can be told apart before matching unless a piece reaches over a space
        self.separable = not any(SPACE in self.texts[i].lstrip(SPACE) for i in self.ids)
        self.wide = 2 if len(self.alphabet) + 1 > 255 else 1
        if len(self.alphabet) >= 65535:
            raise ValueError("too many characters in the vocabulary")
        self.known: dict[str, bytes] = {}
        keys = self._coded(self.flat)
        starts = np.cumsum(self.lengths[self.ids]) - self.lengths[self.ids]
        low = np.zeros((len(self.ids), self.longest), keys.dtype)
        high = np.full((len(self.ids), self.longest), np.iinfo(keys.dtype).max, keys.dtype)
        for i in range(self.longest):
            has = self.lengths[self.ids] > i
            low[has, i] = high[has, i] = keys[starts[has] + i]
        self.low, self.high = self._strings(low), self._strings(high)

    def _coded(self, chars: np.ndarray) -> np.ndarray:
        """Characters by their place in the alphabet, from 2; 1 is any other, 0 is none."""
        at = np.minimum(np.searchsorted(self.alphabet, chars), len(self.alphabet) - 1)
        coded = np.where(self.alphabet[at] == chars, at + 2, 1)
        return coded.astype(">u2" if self.wide == 2 else "u1")

    def _strings(self, table: np.ndarray) -> np.ndarray:
        table = np.ascontiguousarray(table)
        return table.view(f"S{table.shape[1] * self.wide}").reshape(-1)

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and ids of all occurrences of all pieces in ``text`` (coded characters), in
        order of their positions.

        The suffixes are sorted by as many characters as the longest piece has; a binary search
        for the smallest and the largest string a piece can start gives its range among them.
        """
        padded = np.zeros(len(text) + self.longest, ">u2" if self.wide == 2 else "u1")
        padded[: len(text)] = text
        view = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[: len(text)]
        suffixes = self._strings(view)
        array = np.argsort(suffixes)
        ordered = suffixes[array]
        first = np.searchsorted(ordered, self.low, "left")
        count = np.searchsorted(ordered, self.high, "right") - first
        some = np.flatnonzero(count > 0)
        first, count = first[some], count[some]
        total = np.cumsum(count)
        inside = np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count)
        position = array[np.repeat(first, count) + inside]
        piece = np.repeat(self.ids[some], count)
        order = np.lexsort((self.lengths[piece], position))
        return position[order], piece[order]

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of every word, as bytes of unsigned 32-bit integers."""
        chars = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        text = self._coded(chars)
        ends = starts + sizes
        text[ends] = 0  # between words
        position, piece = self.edges(text)
        table = np.full((len(text), self.longest + 1), -1, np.int32)
        table[position, self.lengths[piece]] = piece
        inside = np.ones(len(text), bool)
        inside[ends] = False
        relax = self._merge if self.kind == "bpe" else self._best
        heads = relax(table, starts, ends, inside)
        size = np.diff(np.append(heads, len(text)))
        word = np.searchsorted(starts, heads, side="right") - 1
        size = np.minimum(size, ends[word] - heads)
        ids = table[heads, np.minimum(size, self.longest)].astype(np.int64)
        ids[size > self.longest] = -1
        return self._joined(ids, heads, word, chars, len(words))

    def _merge(
        self, table: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray
    ) -> np.ndarray:
        """Heads of the symbols left when, in every word, the best edge over two neighbouring
        symbols (of equal ones the first) has been taken again and again."""
        done = []
        heads = np.flatnonzero(inside)
        word = np.searchsorted(starts, heads, side="right") - 1
        rank = np.append(self.rank, NONE)  # id -1: no piece
        while len(heads):
            last = np.ones(len(heads), bool)
            last[:-1] = word[1:] != word[:-1]
            tails = np.append(heads[1:], 0)
            tails[last] = ends[word[last]]
            size = np.append(tails[1:], 0) - heads  # of a symbol and its successor
            can = ~last & (size <= self.longest)
            best = np.full(len(heads), NONE, np.int64)
            best[can] = rank[table[heads[can], size[can]]]
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(best, first)
            owner = np.cumsum(np.append(True, word[1:] != word[:-1])) - 1
            taken = np.flatnonzero((best == least[owner]) & (best < NONE))
            # the first of a word only
            taken = taken[np.append(True, owner[taken[1:]] != owner[taken[:-1]])[: len(taken)]]
            settled = (least == NONE)[owner]
            done.append(heads[settled])
            keep = ~settled
            keep[taken + 1] = False
            heads, word = heads[keep], word[keep]
        return np.sort(np.concatenate(done)) if done else heads

    def _best(
        self, table: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray
    ) -> np.ndarray:
        """Heads of the pieces on every word's path of the best sum of scores.

        Edges are relaxed by position: all words step together, and edges of one length from one
        place in the word lead to different targets.
        """
        n = len(inside)
        unknown = self.scores[self.ids].min() - 10
        best = np.full(n + 1, -np.inf)
        came = np.full(n + 1, -1, np.int64)
        best[starts] = 0
        live, at = np.flatnonzero(ends > starts), 0
        while len(live):
            here = starts[live] + at
            for size in range(1, self.longest + 1):
                target = here + size
                fits = target <= ends[live]
                source, target = here[fits], target[fits]
                ids = table[source, size]
                score = np.where(ids >= 0, self.scores[ids], unknown if size == 1 else -np.inf)
                new = best[source] + score
                better = new > best[target]
                best[target[better]] = new[better]
                came[target[better]] = source[better]
            at += 1
            live = live[ends[live] > starts[live] + at]
        heads = []
        now = ends[ends > starts]
        first = starts[ends > starts]
        while len(now):
            now = came[now]
            heads.append(now)
            keep = now > first
            now, first = now[keep], first[keep]
        return np.sort(np.concatenate(heads)) if heads else np.zeros(0, np.int64)

    def _joined(
        self, ids: np.ndarray, heads: np.ndarray, word: np.ndarray, chars: np.ndarray, n: int
    ) -> list[bytes]:
        """Ids by word, with bytes in place of symbols that are no piece."""
        missing = np.flatnonzero(ids < 0)
        size = np.ones(len(ids), np.int64)
        spelled = {}
        for i in missing:
            data = chr(int(chars[heads[i]])).encode("utf-8", "surrogatepass")
            coded = self.bytes[list(data)]
            spelled[i] = coded if (coded >= 0).all() else np.array([self.unknown])
            size[i] = len(spelled[i])
        out = np.repeat(ids, size)
        begin = np.cumsum(size) - size
        for i, coded in spelled.items():
            out[begin[i] : begin[i] + size[i]] = coded
        cuts = np.bincount(word, size, minlength=n).astype(np.int64).cumsum() * 4
        data, at, result = out.astype(np.uint32).tobytes(), 0, []
        for cut in cuts.tolist():
            result.append(data[at:cut])
            at = cut
        return result

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text. Words unknown so far, of all texts together, are indexed as one."""
        marked = [(SPACE + t.replace(" ", SPACE)) if t else "" for t in texts]
        split = [WORD.findall(t) if self.separable else [t] * bool(t) for t in marked]
        if len(self.known) > KNOWN:
            self.known = {}
        ids = dict.fromkeys(w for words in split for w in words)
        ids = {w: self.known.get(w) for w in ids}
        new = [w for w, found in ids.items() if found is None]
        if new:
            found = dict(zip(new, self.segment(new), strict=True))
            ids |= found
            if self.separable:
                self.known |= found
        return [np.frombuffer(b"".join(map(ids.__getitem__, ws)), np.uint32) for ws in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        parts, pending = [], bytearray()
        value = dict(zip(self.bytes[self.bytes >= 0].tolist(), np.flatnonzero(self.bytes >= 0), strict=True))
        if not np.isin(ids, list(value)).any():
            text = "".join(map(self.texts.__getitem__, ids.tolist()))
        else:
            for i in ids.tolist():
                if i in value:
                    pending.append(int(value[i]))
                    continue
                if pending:
                    parts.append(pending.decode("utf-8", "replace"))
                    pending = bytearray()
                parts.append(self.texts[i])
            parts.append(pending.decode("utf-8", "replace"))
            text = "".join(parts)
        return text.replace(SPACE, " ").removeprefix(" ")


_MODELS: dict[tuple[str, str], Model] = {}


def model(path: str, kind: str = "bpe") -> Model:
    """The model of a process, made once."""
    if (path, kind) not in _MODELS:
        _MODELS[path, kind] = Model(path, kind)
    return _MODELS[path, kind]


ROW = "n_chars bigint, n_pieces bigint, ids_crc32 bigint, decoded_sha256 string, same boolean"


def encode_and_decode(
    docs: DataFrame, path: str, kind: str = "bpe", key: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """One row per document: ``key``, ``n_chars``, ``n_pieces``, ``ids_crc32`` (ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` of the text the ids give back, ``same`` (whether it
    is the text), and ``ids`` on request.

    A null text is empty and has no ids. Rows are encoded where they are, nothing is shuffled; keys
    may be null or repeat, other columns are ignored, an empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("_key"), text_of("text").alias("_text"))
    more = T.StructType.fromDDL(ROW + ", ids array<bigint>" * with_ids)
    schema = T.StructType(rows.select("_key").schema.fields + more.fields)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path, kind)
        for batch in arrow_rows(batches, ROWS_AT_ONCE):
            texts = batch.column("_text").to_pylist()
            ids = pieces.encode(texts)
            back = [pieces.decode(x) for x in ids]
            columns = [
                batch.column("_key"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([crc(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back]),
                pa.array([t == b for t, b in zip(texts, back, strict=True)], pa.bool_()),
            ]
            if with_ids:
                columns.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(apply, schema).withColumnRenamed("_key", key)
