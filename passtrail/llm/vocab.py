"""Ids of a public tokenizer, by the tokenizers library, word by word with memory of words seen.

A text is cut where the tokenizer cuts in any case, so ids of the parts are the ids of the whole. Words of ASCII and Latin-1
letters are cut by an equivalent pattern and go straight to the library's merge model; every other word takes the library's
whole path.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

from tokenizers import Tokenizer

from passtrail.llm.common import Memo

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Texts of these characters alone are cut by the patterns below, in which Python and the library agree on classes.
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*")
_CASED_WORDS = re.compile(
    rf"{_CONTRACTIONS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
)
_GAP = re.compile(r"(?<=\S) (?=\S)")
_LOWER_WORDS = re.compile(rf"{_CONTRACTIONS}|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: visible Latin-1 for itself, others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


_LETTER = byte_letters()
#: Marks that often end a word. A run of them at the end is a cut of its own.
_TAIL = b".,;:!?\")"


def _spelled(word: bytes) -> str:
    """A word as the merge model of a byte-level vocabulary takes it."""
    return word.decode() if word.isalnum() else "".join(map(_LETTER.__getitem__, word))


@functools.lru_cache(maxsize=4)
def loaded(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Set in a packed id that begins one of the pieces into which the tokenizer cuts text before it merges.
CUT = 1 << 24


class Words:
    """Ids as packed unsigned 32-bit integers. ``lower``: the vocabulary that drops white space and case; else the byte-level one.

    With ``marked``, ids that begin a cut have the bit CUT.
    """

    def __init__(self, path: str, lower: bool, marked: bool = False):
        self.tokenizer, self.lower, self.marked = loaded(path), lower, marked
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        model = self.tokenizer.model
        self.unit = Memo(lambda w: self._packed([t.id for t in model.tokenize(_spelled(w))]), 250_000)
        self.memo = Memo(self._lowered if lower else self._fresh, 700_000 if lower else 100_000)
        self.spaced = Memo(lambda w: self._fresh(" " + w), 400_000)

    def _packed(self, ids: list[int], cuts: list[int] = (0,)) -> bytes:
        if self.marked and ids:
            for i in cuts:
                ids[i] |= CUT
        return array("I", ids).tobytes()

    def _lowered(self, word: bytes) -> bytes:
        core = word.rstrip(_TAIL)
        if not core.isalpha():
            return self._fresh(word.decode())
        ids = self.unit[core.lower()]
        return ids + self.unit[word[len(core) :]] if len(core) < len(word) else ids

    def _fresh(self, text: str) -> bytes:
        """``text`` begins and ends where the tokenizer cuts in any case."""
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            cut = _LOWER_WORDS.findall(text.lower()) if self.lower else _CASED_WORDS.findall(text)
            return b"".join([self.unit[c.encode()] for c in cut])
        whole = self.tokenizer.encode(text, add_special_tokens=False)
        at = whole.word_ids if self.marked else []
        return self._packed(whole.ids, [i for i in range(len(at)) if not i or at[i] != at[i - 1]])

    def of_bytes(self, text: bytes) -> bytes:
        """Of a whole text for the lower-casing vocabulary: white space in ASCII always separates its words."""
        return b"".join(map(self.memo.__getitem__, text.split()))


    def of_text(self, text: str) -> bytes:
        """Of a whole text for the byte-level vocabulary: it always cuts before a single space between visible characters."""
        first, *others = _GAP.split(text)
        return self.memo[first] + b"".join(map(self.spaced.__getitem__, others))


@functools.lru_cache(maxsize=4)
def words(path: str, lower: bool, marked: bool = False) -> Words:
    """One per worker process."""
    return Words(path, lower, marked)


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level vocabulary stands for."""
    tokenizer = loaded(path)
    value = {c: b for b, c in enumerate(byte_letters())}
    tokens = (tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True)))
    return [bytes(value[c] for c in t) if all(c in value for c in t) else t.encode() for t in tokens]
