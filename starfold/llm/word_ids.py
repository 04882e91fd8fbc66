"""Token ids of whole texts by a tokenizer of the tokenizers library, for use inside tasks.

The library merges slowly but treats every stretch between white space on its own. Texts
are cut at blanks; a plain word (printable ASCII and the letters of Latin-1, which
normalisation leaves alone but for case) is cut further by the tokenizer's own pattern.
Each distinct piece is merged once by the library's model; words and pieces are remembered
by the worker process from task to task. Other words go to the library as they are. The
words of many texts are made distinct by Arrow before they are looked up.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the pattern that cuts words in the vocabulary file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[!-~{_LETTERS}]*")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


def slices(text: str, chars: int = 1 << 18) -> Iterator[str]:
    """``text`` cut before blanks, so that no more than a slice is split at once."""
    at = 0
    while len(text) - at > chars:
        cut = text.rfind(" ", at + 1, at + chars)
        if cut < 0:
            cut = text.find(" ", at + chars)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class Memory(dict):
    """The younger of two generations of ``limit`` values; one in use moves to it."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def put(self, key: str, value: bytes) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


class WordIds:
    """Ids as little-endian 32-bit integers."""

    def __init__(self, path: str, words: int = 400_000, pieces: int = 400_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.words, self.pieces = Tokenizer.from_file(path), Memory(words), Memory(pieces)
        shape = json.loads(self.tokenizer.to_str())
        steps = (shape["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        forms = [n.get("type") for n in (shape["normalizer"] or {}).get("normalizers", [])]
        self.added = [a["content"] for a in shape["added_tokens"]]
        known_form = steps[0].get("pattern", {}).get("Regex") == PATTERN and steps[1].get("type") == "ByteLevel" and forms == ["NFC", "Replace", "Lowercase"]
        self.by_word = known_form and not any(" " in a or "\n" in a for a in self.added)
        self.merge = self.tokenizer.model.tokenize
        # How the library shows the bytes of a letter to its model.
        shown = ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: shown.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pieces.old.get(piece)
            if ids is None:
                merged = self.merge(piece if piece.isascii() else piece.translate(self.shown))
                ids = b"".join([t.id.to_bytes(4, "little") for t in merged])
            self.pieces.put(piece, ids)
        return ids

    def word(self, word: str) -> bytes:
        ids = self.words.old.get(word)
        if ids is None:
            if word.isascii() and word.isalpha():
                low = word.lower()
                ids = self.piece(word if low == word else low)  # one key for both memories
            elif _PLAIN.fullmatch(word) and not any(a in word for a in self.added):
                ids = b"".join(map(self.piece, _PIECES.findall(word.lower())))
            else:
                ids = self.library(word)
        self.words.put(word, ids)
        return ids

    def encoded(self, text: str) -> Iterator[np.ndarray]:
        """Ids of one text of any length, slice by slice."""
        if not self.by_word:
            yield np.frombuffer(self.library(text), "<u4")
            return
        for part in slices(text):
            yield self.of_texts(pa.array([part]))[0]

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts``, one after another, and how many each has. Each distinct
        word is looked up once; the rest is done on arrays."""
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.words.get, distinct))
        for i in [i for i, ids in enumerate(known) if ids is None]:
            known[i] = self.word(distinct[i])
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = np.frombuffer(b"".join(known), "<u4")
        each = size[index]
        ends = np.cumsum(each)
        # From the place of every word's ids to the places of all ids.
        first = np.cumsum(size) - size
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[index] - (ends - each), each)
        total = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return ids[places], np.diff(total)


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    """The worker process's own, whatever task it is at."""
    return WordIds(path)
