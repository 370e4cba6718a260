"""Units of text between which no token reaches, and tokenizers whose results
are kept by unit.

A cut is made before a space that follows a letter, a digit, an underscore or an
ASCII sign. No piece of the byte-level pattern holds white space after anything
else, and it scans from any piece's start alike, so a text's pieces are those of
its units; tokens stay inside pieces. A sentencepiece model gives the same if no
entry of its vocabulary has a space mark after another character.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # a task is one thread

_CUT = re.compile(r"(?<=[!-~\w])(?= )")
_ODD = re.compile(r"[^!-~\w] ")      # a space before which no cut may be made
ENTRY_BYTES = 200            # of a dictionary entry with its key, about
LONG_UNIT = 64               # longer units are not kept
BATCH = 2048                 # units that go to a tokenizer together


#: Fixed value: the pattern of the byte-level tokenizer.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters of which classes differ between versions of Unicode, or might.
OTHER = re.compile("[^\t\n\r -~\xa1-\xac\xae-\u017f]")


def split_units(text: str) -> list[str]:
    """The units of ``text``; joined they are the text."""
    if not text:
        return []
    if _ODD.search(text):
        return _CUT.split(text)
    first, *others = text.split(" ")
    units = [" " + x for x in others]
    return [first, *units] if first else units


class Kept(dict):
    """Unit -> result. ``fill`` computes the results of new units, given as a
    list. What has been asked for since half of ``limit`` bytes (by
    ``size(result)``) came in is kept, and what was asked for in the half before is
    at hand; long units are not kept from one call to the next."""

    def __init__(self, compute: Callable[[list[str]], Iterable], size: Callable, limit: int = 96 << 20):
        super().__init__()
        self.compute, self.size, self.limit, self.used = compute, size, limit, 0
        self.passing: list[str] = []
        self.before: dict = {}

    def fill(self, units: Iterable[str]) -> None:
        for u in self.passing:
            del self[u]
        self.passing = []
        if self.used > self.limit // 2:
            self.before = dict(self)
            self.clear()
            self.used = 0
        new = []
        for u in set(units).difference(self):
            if u in self.before:
                self._keep(u, self.before[u])
            else:
                new.append(u)
        for at in range(0, len(new), BATCH):
            part = new[at:at + BATCH]
            for u, got in zip(part, self.compute(part), strict=True):
                self._keep(u, got)

    def _keep(self, u: str, got) -> None:
        self[u] = got
        if len(u) > LONG_UNIT:
            self.passing.append(u)
        else:
            self.used += ENTRY_BYTES + len(u) + self.size(got)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes, in order, for the
    characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(path: str, plain_specials: bool):
    """A tokenizers file without truncation and padding, and the bytes of each
    of its ids. ``plain_specials``: the strings of special tokens are text."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = plain_specials
    of = byte_alphabet()
    table = [b""] * t.get_vocab_size(with_added_tokens=True)
    for token, i in t.get_vocab(with_added_tokens=True).items():
        table[i] = bytes(of[c] for c in token)
    return t, table
