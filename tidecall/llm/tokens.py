"""Token ids of whole texts by a public word-BPE file, with a cache of words.

The word BPE never joins characters across white space, so the ids of a text are the ids of
its words in order. Words are looked up; only words that are new to the task go through the
model. Texts with characters for which Unicode tables could differ between libraries, or with
special tokens in them, go through the tokenizer whole, and so does everything if the file is
of another kind.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# The pattern by which the tokenizer file cuts words.
WORD_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Characters that any Unicode version normalises, lowers and classifies alike; of Latin-1 only letters.
PLAIN = re.compile(r"[\x09\x0A\x0D\x20-\x7EÀ-ÖØ-öø-įı-ž]*")
#: Words per generation of the cache; there are two.
CACHE_WORDS = 300_000


@lru_cache(maxsize=4)
def encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class TextEncoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.letters = byte_letters()
        self.cached = self._is_word_model()

    def _is_word_model(self) -> bool:
        """Whether ids of words make up the ids of a text, whatever the white space."""
        probe = "It's A Test-case, 12 %%\nÉté NAÏVE don't 'scum ''re_x"
        return self._by_words(probe) == self._whole(probe)

    def encode(self, text: str) -> bytes:
        plain = self.cached and PLAIN.fullmatch(text) and not any(s in text for s in self.specials)
        return self._by_words(text) if plain else self._whole(text)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_words(self, text: str) -> bytes:
        words = text.lower().split()
        found = list(map(self.young.get, words))
        if None in found:
            found = [self._word(w) if x is None else x for w, x in zip(words, found)]
            if len(self.young) > CACHE_WORDS:
                self.old, self.young = self.young, {}
        return b"".join(found)

    def _word(self, word: str) -> bytes:
        ids = self.young.get(word) or self.old.get(word)
        if ids is None:
            ids = b"".join(
                token.id.to_bytes(4, "little")
                for part in ([word] if word.isalpha() else WORD_PATTERN.findall(word))
                for token in self.model.tokenize(
                    part if part.isascii() else "".join(self.letters[b] for b in part.encode())
                )
            )
        self.young[word] = ids
        return ids
