"""Token ids of texts with a public tokenizer, encoded once per distinct word.

The tokenizer drops white space and never lets a token cross a space, so the ids of a text are those of its parts between
spaces. Each worker keeps the ids of the words it met first; others are encoded together, once per slice.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from public_tokenizers import path
from tokenizers import Tokenizer

from papertrove.llm.words import Words

WORD_BPE = "word_bpe_49k.json"
#: Bytes of words and ids that a worker keeps, with what Python needs for an entry besides.
KEPT_BYTES = 96 << 20
ENTRY_BYTES = 180
#: Words in one call of the tokenizer, which takes more than twice as long per word for very long inputs.
ASKED_WORDS = 256
#: Bytes of text that are encoded at once.
SLICE_TEXT = 3 << 20
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
_kept: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of texts in the narrowest unsigned type that holds the vocabulary."""

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.kept_bytes = 0

    def encode(self, texts: pa.ChunkedArray | pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, every text closed by ``end_id``, and the ``len + 1`` bounds of the texts; null is empty."""
        words = Words(texts, b" \n")
        data = words.data
        # Upper and lower case of A-Z give the same ids, but a special token's name must stay as it is.
        if b"<|" not in data.tobytes():
            data = _LOWER[data]
        which, distinct = pd.factorize(words.codes(data))
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        held = data.tobytes()
        spelled = [held[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
        ids = {word: self.words[word] for word in spelled if word in self.words}
        found = self._fresh({word for word in spelled if word not in ids})
        self._keep(found)
        of = (ids | found).__getitem__
        pieces = [*map(of, spelled), np.array([end_id], self.dtype).tobytes()]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.dtype.itemsize
        # The end follows the last word of every text, as one more word.
        order = np.insert(which, words.bounds[1:], len(distinct))
        flat = np.frombuffer(b"".join(map(pieces.__getitem__, order.tolist())), self.dtype)
        bounds = words.bounds + np.arange(len(words.bounds))
        return flat, np.append(0, np.cumsum(sizes[order]))[bounds]

    def _keep(self, found: dict[bytes, bytes]) -> None:
        for word, ids in found.items():
            if self.kept_bytes >= KEPT_BYTES:
                return
            self.words[word] = ids
            self.kept_bytes += len(word) + len(ids) + ENTRY_BYTES

    def _fresh(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not kept yet; ASCII marks that end a word after a letter are pieces of their own."""
        tails: dict[bytes, bytes] = {}
        for word in words:
            core = word.rstrip(_MARKS)
            if len(core) < len(word) and core and core[-1] in _LETTERS and b"<|" not in word:
                tails[word] = core
        parts = (words - tails.keys()) | set(tails.values()) | {word[len(core) :] for word, core in tails.items()}
        known = {part: self.words[part] for part in parts & self.words.keys()}
        found = self._encoded(list(parts - known.keys()))
        known |= found
        for word, core in tails.items():
            found[word] = known[core] + known[word[len(core) :]]
        return found

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        # A word of letters alone is one piece to the tokenizer, so its last id, and no other, ends a word. Should that
        # fail for some letter, the words asked with it go the other way.
        letters = [word for word in words if word.isalpha() or (not word.isascii() and _only_letters(word.decode()))]
        for at in range(0, len(letters), ASKED_WORDS):
            part = letters[at : at + ASKED_WORDS]
            encoding = self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False)
            ids = np.array(encoding.ids, self.dtype)
            cuts = np.append(0, np.flatnonzero(self.ends_word[ids]) + 1)
            if len(cuts) == len(part) + 1:
                out.update(_cut(part, ids, cuts))
        others = [word for word in words if word not in out]
        for at in range(0, len(others), ASKED_WORDS):
            part = others[at : at + ASKED_WORDS]
            encoding = self.tokenizer.encode(
                [word.decode() for word in part], is_pretokenized=True, add_special_tokens=False
            )
            owner = np.array(encoding.word_ids, np.int64)
            cuts = np.searchsorted(owner, np.arange(len(part) + 1))
            out.update(_cut(part, np.array(encoding.ids, self.dtype), cuts))
        return out


def _only_letters(word: str) -> bool:
    """True if the word is letters, and still is after the tokenizer's own changes to it."""
    return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


def _cut(words: list[bytes], ids: np.ndarray, cuts: np.ndarray) -> dict[bytes, bytes]:
    data, size = ids.tobytes(), ids.itemsize
    marks = (cuts * size).tolist()
    return {word: data[start:end] for word, start, end in zip(words, marks[:-1], marks[1:], strict=True)}


def word_encoder(file: str = WORD_BPE) -> WordEncoder:
    """The worker's encoder for a vocabulary file: a name of the installed public vocabularies or a path."""
    if file not in _kept:
        _kept[file] = WordEncoder(file if "/" in file else path(file))
    return _kept[file]
