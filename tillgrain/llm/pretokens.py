"""Texts as byte-level BPE ids, remembering what was already encoded.

A split before a single space that stands between two characters other than white
space is always a split of the pre-tokenizing pattern as well. Such pieces are looked
up in a bounded memory; those not met lately are split by the pattern and their
pre-tokens looked up in a second one; only what is left is encoded. The ids are those
of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
import regex

_ODD_SPACE = re.compile(r" \s|\s ")
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Characters of a piece that is worth remembering, and how many pieces are held.
_LONGEST = 48
_HELD = 500_000

_pretokens = regex.compile(public_tokenizers.PATTERN).findall
# The same for text of ASCII characters alone, where the standard library is faster.
_ascii_pretokens = re.compile(
    public_tokenizers.PATTERN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
    .replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+"),
    re.ASCII,
).findall


def pretokens(text: str) -> list[str]:
    return (_ascii_pretokens if text.isascii() else _pretokens)(text)


def _remember(memory: dict[str, bytes], fresh: dict[str, bytes]) -> None:
    if len(memory) + len(fresh) > _HELD:
        memory.clear()
    memory.update((p, ids) for p, ids in fresh.items() if len(p) <= _LONGEST)


class RememberingEncoder:
    """``encode`` turns pre-tokens into their ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]) -> None:
        self._encode = encode
        self._pieces: dict[str, bytes] = {}
        self._tokens: dict[str, bytes] = {}

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, by way of its pre-tokens."""
        split = [pretokens(p) for p in pieces]
        every = dict.fromkeys(t for tokens in split for t in tokens)
        known = {t: ids for t in every if (ids := self._tokens.get(t)) is not None}
        missing = [t for t in every if t not in known]
        if missing:
            fresh = dict(zip(missing, self._encode(missing), strict=True))
            known |= fresh
            _remember(self._tokens, fresh)
        return [b"".join([known[t] for t in tokens]) for tokens in split]

    def _fill(self, pieces: list[str], found: list[bytes | None]) -> None:
        missing = [i for i, ids in enumerate(found) if ids is None]
        distinct = list(dict.fromkeys(pieces[i] for i in missing))
        known = dict(zip(distinct, self._encoded([f" {p}" for p in distinct]), strict=True))
        for i in missing:
            found[i] = known[pieces[i]]
        _remember(self._pieces, known)

    def __call__(self, text: str) -> bytes:
        """The ids of the text."""
        if not text:
            return b""
        pieces = _INNER_SPACE.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        head = pieces.pop(0)
        found = list(map(self._pieces.get, pieces))
        if None in found:
            self._fill(pieces, found)
        return b"".join([*(self._encoded([head]) if head else []), *found])
