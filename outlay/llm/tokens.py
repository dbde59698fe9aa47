"""Ids of texts by the tokenizers library, with what is already known kept per word.

The library takes some microseconds a word, and words repeat. A text is cut where the tokenizer
itself is bound to cut, and ids of the pieces are looked up; only unknown pieces go to the library.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable
from itertools import chain

import numpy as np
import regex

from outlay.llm.common import kept

# The words byte-level BPE is applied to.
BYTE_WORDS = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
# The words of the tokenizer that drops white space.
SPACED_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"""
KNOWN = 1_000_000  # pieces kept by a process, of each of two generations


def byte_letters() -> dict[int, str]:
    """The letters that byte-level BPE writes bytes as: printable ones of Latin-1 as they are, the
    others in their order from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """``ids(texts)``: an ``int`` array of ids a text, as ``Tokenizer.encode`` gives them.

    ``most``: pieces kept, of each of two generations; fewer cost time, and the ids are the same.
    """

    def __init__(self, path: str, most: int = KNOWN):
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = (spec.get("pre_tokenizer") or {}).get("type")
        self.byte_level = kind == "ByteLevel" and not spec.get("normalizer")
        ends = spec["model"].get("end_of_word_suffix") or ""
        drops_space = any(
            x.get("type") == "Replace" for x in (spec.get("normalizer") or {}).get("normalizers", ())
        )
        self.word_ends = None
        if not self.byte_level and ends and drops_space and not spec["model"].get("ignore_merges"):
            size = max(spec["model"]["vocab"].values()) + 1
            self.word_ends = np.zeros(size, bool)
            for piece, number in spec["model"]["vocab"].items():
                self.word_ends[number] = piece.endswith(ends)
        self.words: dict[str, bytes] = {}  # what BPE is applied to
        self.pieces: dict[str, bytes | bool] = {}  # what stands between two spaces
        self.older: dict[str, bytes | bool] = {}  # pieces of the generation before
        self.letters = byte_letters() if "ByteLevel" in json.dumps(spec.get("pre_tokenizer")) else None
        self.pattern = regex.compile(BYTE_WORDS if self.byte_level else SPACED_WORDS)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.byte_level:
            return self._byte_level(texts)
        if self.word_ends is not None:
            return self._by_space(texts)
        return [np.array(x.ids, np.int64) for x in self.library.encode_batch_fast(
            texts, add_special_tokens=False)]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)

    def _byte_level(self, texts: list[str]) -> list[np.ndarray]:
        """Words start at a space between two non-spaces. Where other white space is next to a
        space (a piece that is empty, starts or ends with one), the text is encoded as a whole."""
        self._forget()
        known, words, find = self.pieces, self.words, self.pattern.findall
        split = [t.split(" ") for t in texts]
        # All pieces but a text's first carry the space before them.
        # A batch's own table is small enough to stay close to the processor.
        ids = self._known(chain.from_iterable(pieces[1:] for pieces in split))
        new = {}
        for piece in [p for p, found in ids.items() if found is None]:
            if not piece or piece[0].isspace() or piece[-1].isspace():
                ids[piece] = known[piece] = False
            else:
                new[piece] = find(" " + piece)
        firsts = {pieces[0]: find(pieces[0]) for pieces in split}
        self._learn_words(chain.from_iterable(chain(new.values(), firsts.values())))
        for piece, found in new.items():
            ids[piece] = known[piece] = b"".join([words[w] for w in found])
        out, get = [], ids.__getitem__
        for text, pieces in zip(texts, split, strict=True):
            first, *rest = pieces
            parts = list(map(get, rest))
            if False in parts or first[-1:].isspace():
                out.append(self._whole(text))
            else:
                head = [words[w] for w in firsts[first]]
                out.append(np.frombuffer(b"".join(head + parts), np.uint32))
        return out

    def _known(self, pieces: Iterable[str]) -> dict[str, bytes | bool | None]:
        """What is known of a batch's pieces. What is asked for lives on in the new generation."""
        new, old, out = self.pieces.get, self.older, {}
        for piece in dict.fromkeys(pieces):
            found = new(piece)
            if found is None and old:
                found = old.get(piece)
                if found is not None:
                    self.pieces[piece] = found
            out[piece] = found
        return out

    def _forget(self) -> None:
        if len(self.pieces) > self.most:
            self.pieces, self.older = {}, self.pieces
        if len(self.words) > self.most:
            self.words = {}

    def _learn_words(self, found: Iterable[str]) -> None:
        """Ids of unknown words by the library's BPE model alone: cutting a text to words, finding
        offsets and the like take it longer than the merges."""
        words, apply = self.words, self.library.model.tokenize
        for word in dict.fromkeys(found):
            if word not in words:
                plain = word
                if self.letters:
                    plain = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
                words[word] = np.array([t.id for t in apply(plain)], np.uint32).tobytes()

    def _by_space(self, texts: list[str]) -> list[np.ndarray]:
        """White space separates and is dropped."""
        self._forget()
        known, words, find = self.pieces, self.words, self.pattern.findall
        split = [t.split() for t in texts]
        # A batch's own table is small enough to stay close to the processor.
        ids = self._known(chain.from_iterable(split))
        new: dict[str, list[str]] = {}
        odd = []
        for piece in [p for p, found in ids.items() if found is None]:
            low = piece.lower()
            if max(low) < "\u0250":  # below, letters are composed and lower-case one by one
                new[piece] = find(low)
            else:
                odd.append(piece)
        self._learn_words(chain.from_iterable(new.values()))
        for piece, found in new.items():
            ids[piece] = known[piece] = b"".join([words[w] for w in found])
        if odd:
            found = self.library.encode_batch_fast(odd, add_special_tokens=False)
            for piece, encoding in zip(odd, found, strict=True):
                ids[piece] = known[piece] = np.array(encoding.ids, np.uint32).tobytes()
        get = ids.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), np.uint32) for pieces in split]


def encoder(path: str, most: int = KNOWN) -> Encoder:
    """The encoder of a process, made once for tasks that follow each other."""
    return kept((path, most), lambda: Encoder(path, most))


def crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
