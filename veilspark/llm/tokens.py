"""Token ids of whole texts, as little-endian unsigned 32-bit integers."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import regex

#: Fixed value: how byte-level tokenizers cut a text before merging.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A space before other white space, or at the end, belongs to what stands before it.
_ODD = re.compile(r" (?=\s|\Z)")
_BREAK = re.compile(r" (?=\S)")
#: Words that a worker keeps of late, and as many of before: about a quarter of a GB in all.
KEPT_WORDS = 700_000
KEPT_LENGTH = 48


def _letters() -> dict[int, int]:
    """The letter that stands for each byte: its own if visible, else the next from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b for b in seen} | {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*seen}))}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Known(dict):
    """The ids of words, each made when it is first asked for; long ones aren't kept.

    When it is full it becomes `old`, from which words come back as they are asked for.
    """

    def __init__(self, make, kept: int):
        self.make, self.kept = make, kept
        self.old: dict[str, bytes] = {}

    def renew(self) -> None:
        if len(self) > self.kept:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.pop(word, None) or self.make(word)
        if len(word) <= KEPT_LENGTH:
            self[word] = ids
        return ids


class Encoder:
    """Encodes texts with a byte-level BPE tokenizer of the tokenizers library.

    Its pre-tokenizer always begins a new token at a space that another character
    follows, so a text's ids are those of its words, each with its space before. Each
    word is merged once and kept as long as it is asked for. Tokenizers of
    another build encode each text as a whole.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        cut = self.tokenizer.pre_tokenizer
        self.by_word = (
            isinstance(self.tokenizer.model, models.BPE)
            and isinstance(cut, pre_tokenizers.ByteLevel)
            and cut.use_regex
            and not cut.add_prefix_space
            and self.tokenizer.normalizer is None
        )
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _letters()
        self.blank = chr(self.letters[32])
        self.tokenize = self.tokenizer.model.tokenize
        #: Parts of a text as they are, and words with a space before each.
        self.parts, self.words = _Known(self.part, kept_words), _Known(self.word, kept_words)

    def merge(self, part: str) -> bytes:
        part = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.tokenize(part)]).tobytes()

    def word(self, word: str) -> bytes:
        if word.isalpha():
            if word.isascii():
                return array("I", [token.id for token in self.tokenize(self.blank + word)]).tobytes()
            return self.merge(" " + word)
        if word[-1] in ",.!?;:" and word[:-1].isalpha():
            return self.words[word[:-1]] + self.parts[word[-1]]
        return self.part(" " + word)

    def part(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return self.whole(text)
        cut = _WORDS.findall(text)
        if len(cut) == 1:
            return self.merge(text)
        words, parts = self.words, self.parts
        return b"".join([words[part[1:]] if part[0] == " " and part[1:].isalpha() else parts[part] for part in cut])

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text, without special tokens."""
        if not self.by_word:
            return self.whole(text)
        self.parts.renew()
        self.words.renew()
        first, *words = _BREAK.split(text) if _ODD.search(text) else text.split(" ")
        return self.parts[first] + b"".join(map(self.words.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(path: str, kept_words: int = KEPT_WORDS) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path, kept_words)
