"""Pieces of text that a byte-level tokenizer encodes one by one, and a memory of their tokens.

The tokenizers' pattern gives a blank to the word behind it and parts white space from all else, so a match ends before
a lone blank and around a lone line end wherever they stand. ``cut`` parts texts there, which is far cheaper than to match
the pattern everywhere; most pieces of a corpus have been met before and need no tokenizer. ``cut_all`` parts many texts by
their bytes at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

#: The pattern that ``cut`` is made for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A word of Latin letters, which the pattern takes as one, and marks behind it, which it takes as another (an apostrophe might begin a suffix).
WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: A word of Latin letters alone.
LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: White space other than blanks and line ends, and what some libraries take for it.
OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where white space runs on, the pattern leaves its last character to what follows.
_RUNS = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+?(?= [^ \n])|[ \n]+")


def cut(text: str) -> list[str] | None:
    """The pieces of a text, some of them empty; None if it has white space that has to be left to the tokenizer."""
    if any(c in text for c in OTHER_SPACE):
        return None
    if "\0" in text or "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or text.endswith("\n\n"):
        return _RUNS.findall(text)
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


_SPACE, _LINE_END, _LETTER, _MARK = 1, 2, 4, 8
#: What each byte is, of these.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[32, 10]], _KINDS[33:127] = (_SPACE, _SPACE | _LINE_END), _MARK
_KINDS[65:91] = _KINDS[97:123] = _LETTER
_KINDS[48:58] = 0


def cut_all(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pieces of all texts in turn, none of them empty, and for each text how many come before it (and how many there are).

    Pieces end where those of ``cut`` do, and between a Latin letter and a mark of ASCII, as no match has both. Texts must
    not be null or hold ``OTHER_SPACE``.
    """
    _, places, held = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if places else np.zeros(1, np.int64)
    data = np.frombuffer(held, np.uint8)[places[0] : places[-1]] if held else np.zeros(0, np.uint8)
    places = places - places[0]
    starts, ends = places[:-1][np.diff(places) > 0], places[1:][np.diff(places) > 0]
    kinds = _KINDS.take(data)
    # Latin letters beyond ASCII are two bytes, of which the second ends the letter.
    second = np.flatnonzero(data == 0xC3) + 1
    kinds[second[(data[second] != 0x97) & (data[second] != 0xB7)]] = _LETTER
    space = (kinds & _SPACE).view(bool)
    begins = np.zeros(len(data), bool)
    # Of white space that runs on, the last character is left to what follows, if anything does.
    begins[:-1] = space[:-1] & ~space[1:]
    begins[ends - 1] = False
    begins[1:] |= space[1:] & ~space[:-1]
    begins[1:] |= ~space[1:] & ((kinds[:-1] & _LINE_END) != 0)
    begins[1:] |= (kinds[1:] == _MARK) & (kinds[:-1] == _LETTER)
    begins[starts] = True
    at = np.flatnonzero(begins)
    pieces = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data))
    return pieces, np.searchsorted(at, places)


class _Now(dict):
    """Tokens of pieces; a piece that is asked for the first time is taken over from ``before`` or noted as missing."""

    __slots__ = ("before", "missing")

    def __missing__(self, piece: str) -> bytes | None:
        found = self.before.get(piece)
        if found is None:
            self.missing.append(piece)
        self[piece] = found
        return found


class Memory:
    """Tokens, as bytes, of the pieces met lately: at least the last ``most`` and at most about twice as many, with those of one call."""

    def __init__(self, most: int) -> None:
        self.most, self.now = most, _Now()
        self._begin({})

    def _begin(self, before: dict) -> None:
        self.now = _Now({"": b""})
        self.now.before, self.now.missing = before, []

    def get(self, piece: str) -> bytes | None:
        found = self.now.get(piece)
        return self.now.before.get(piece) if found is None else found

    def each(self, cuts: list[list[str]], learn: Callable[[list[str]], Iterable[tuple[str, bytes]]]) -> list[list[bytes]]:
        """The tokens of every piece in each list; ``learn`` is asked once for those of unknown ones."""
        if len(self.now) > self.most:
            self.now.before = {}
            self._begin(dict(self.now))
        of, now = self.now.__getitem__, self.now
        now.missing = []
        found = [list(map(of, c)) for c in cuts]
        if not now.missing:
            return found
        try:
            now.update(learn(now.missing))
        except BaseException:
            self._begin({})  # no piece stays without its tokens
            raise
        return [[of(p) if t is None else t for p, t in zip(c, f)] for c, f in zip(cuts, found)]

    def encode(self, cuts: list[list[str]], learn: Callable[[list[str]], Iterable[tuple[str, bytes]]]) -> list[bytes]:
        """The tokens of each list of pieces."""
        return [b"".join(f) for f in self.each(cuts, learn)]
