"""Exact token ids from the tokenizers library, each distinct word encoded once.

The library spends its time on merges.  Words repeat, so a worker keeps the
ids of words it has seen and asks the library's model only for new ones.
This holds for texts of ASCII and Latin-1 letters with common punctuation,
where the pre-tokenizer's word boundaries are known; any other text, and any
text with one of the tokenizer's special strings, goes to ``encode`` whole.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array

if sys.byteorder != "little":
    raise ImportError("token ids are handled as little-endian arrays")

#: Characters on which the fast path agrees with the library: white space,
#: ASCII, Latin-1 letters and a few marks that are neither letter nor number.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SPACES = " \\t\\n\\r"
OTHER = re.compile(f"[^{SPACES}!-~{LETTERS}¡§«»¿–—‘’“”…]")
#: Word patterns of the two public vocabularies on those characters.
#: The frequent alternatives come first; they start differently from the others.
BYTE_WORDS = re.compile(f" ?[{LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^{SPACES}{LETTERS}0-9]+"
                        f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
LOWER_WORDS = re.compile(f"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^{SPACES}{LETTERS}0-9]+")
#: Words kept in each of a worker's two generations; a word and its ids take
#: about 170 bytes, so both together stay below 64 MB.
CACHE_WORDS = 180_000
#: Words longer than this are not kept.
CACHED_LENGTH = 64


def byte_alphabet() -> dict[int, str]:
    """Code point of each byte in byte-level vocabularies: printable bytes
    stand for themselves, the rest follow from 256 upwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Generations(dict):
    """A bounded dictionary: when full, it becomes the old generation, from
    which words that are met again are taken over; ``learn`` gives the rest."""

    def __init__(self, learn=None, limit: int = CACHE_WORDS):
        super().__init__()
        self.learn, self.limit, self.old = learn, limit, {}

    def turn(self) -> None:
        """Start a new generation if this one is full."""
        if len(self) >= self.limit:
            self.old = {}
            self.old = dict(self)
            self.clear()

    def __missing__(self, word):
        value = self.old.get(word)
        if self.learn is None:    # all words of a batch are here already
            self[word] = value
            return value
        if value is None:
            value = self.learn(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= self.limit:
                self.turn()
            self[word] = value
        return value

    def release(self) -> None:
        self.old = {}
        self.clear()

    def unknown(self, words: set) -> list:
        """Which of ``words`` neither generation has."""
        return list(words.difference(self).difference(self.old))


class WordTokenizer:
    """``encode(texts)``: the ids of each text as little-endian uint32 bytes."""

    def __init__(self, path: str, words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        config = json.loads(open(path, encoding="utf-8").read())
        special = [t["content"] for t in config["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else re.compile("(?!)")
        self.lower = any(n["type"] == "Lowercase" for n in (config["normalizer"] or {}).get("normalizers", []))
        self.words = LOWER_WORDS if self.lower else BYTE_WORDS
        self.alphabet = byte_alphabet()
        self.tokenize = self.library.model.tokenize
        self.cache = Generations(self.ids_of, words)

    def ids_of(self, word: str) -> bytes:
        if word.isascii() and word.isalnum():
            mapped = word
        elif word[0] == " " and word.isascii() and word[1:].isalnum():    # most words
            mapped = self.alphabet[32] + word[1:]
        else:
            mapped = word.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenize(mapped)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.encode_one(text) for text in texts]

    def encode_one(self, text: str) -> bytes:
        if OTHER.search(text) or self.special.search(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        words = self.words.findall(text.lower() if self.lower else text)
        return b"".join(map(self.cache.__getitem__, words))


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str, words: int = CACHE_WORDS) -> WordTokenizer:
    """One per Python worker, vocabulary file and size of a generation."""
    return WordTokenizer(path, words)


def release_tokenizer() -> None:
    """Give the memory back: workers outlive a job, and the next one may have
    other things to hold."""
    word_tokenizer.cache_clear()
