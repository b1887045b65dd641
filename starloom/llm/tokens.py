"""Encoding with a tokenizer of the tokenizers library, each distinct word once.

Where blanks always part two tokens, a text's ids are those of its words in turn, and few of
the words of a corpus are new. Whether they do is read from the tokenizer's own settings. A new
word of ASCII and Latin-1 characters, of which the settings' effect is known, goes straight to
the library's merges; any other word passes the whole library; so does a whole text if the
settings are unknown or a special token stands in it.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

#: Words, and pieces of words, that one Python worker keeps in each of two generations.
KEPT_WORDS, KEPT_PIECES = 150_000, 250_000

# The settings under which blanks part tokens and the shortcut below holds.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words to which the normalizers do nothing but lower their case, character by character.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: ``SPLIT`` for these characters in lower case.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}


class _Kept(dict):
    """Remembers what it made, in two generations, so that it stays bounded and keeps what recurs."""

    def __init__(self, make, most: int):
        self._make, self._most, self._older = make, most, {}

    def forget(self) -> None:
        self.clear()
        self._older = {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Ids of whole texts, from ids of words."""

    def __init__(self, name: str):
        path = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        normalizer, splitter = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
        steps = splitter.get("pretokenizers", [])
        self.by_word = (
            normalizer.get("normalizers") == NORMALIZERS
            and len(steps) == 2
            and (steps[0]["type"], steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"])
            == ("Split", {"Regex": SPLIT}, "Removed", True)
            and (steps[1]["type"], steps[1]["add_prefix_space"], steps[1]["use_regex"]) == ("ByteLevel", False, False)
        )
        self._special = [token["content"] for token in settings.get("added_tokens", [])]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self._model, self._letters = self.tokenizer.model, _byte_letters()
        self._pieces, self._words = _Kept(self._piece, KEPT_PIECES), _Kept(self._word, KEPT_WORDS)

    def whole(self, texts: list[str]) -> list[bytes]:
        """As the library gives them."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self._letters)
        return np.array([token.id for token in self._model.tokenize(letters)], self.dtype).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text):
            return b"".join(map(self._pieces.__getitem__, PIECE.findall(text.lower())))
        return self.whole([text])[0]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian integers of ``width`` bytes; none for None."""
        if not text:
            return b""
        if not self.by_word or any(special in text for special in self._special):
            return self.whole([text])[0]
        return b"".join(map(self._words.__getitem__, text.encode().split()))

    def forget(self) -> None:
        """Drops what is kept. Workers are used again by stages that encode nothing."""
        self._pieces.forget()
        self._words.forget()

    def count_words(self, text: str) -> list[int]:
        """The number of tokens of each word."""
        return [len(self._words[word]) // self.width for word in text.encode().split()]


@lru_cache(maxsize=2)
def encoder(name: str) -> WordEncoder:
    """One for each Python worker."""
    return WordEncoder(name)
