"""Pieces of text that byte-level BPE encodes independently, and a memo of their ids.

The usual pre-tokenization pattern never joins a space to what precedes it, so a text can be cut before each
single space and around each single line end. Pieces repeat far more than texts do; each worker encodes a
piece once and keeps the ids in a memo of two generations with a fixed number of entries.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Every white space but the plain space and the line end; texts with these go the long way round.
ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　\x00]")
MEMO_ENTRIES = 1_300_000
#: Longer pieces are encoded but not kept.
MEMO_PIECE = 64


def cut_pieces(text: str) -> list[str] | None:
    """Pieces, empty ones among them, whose encodings concatenate to that of the text, or None where the cut isn't sure to be right."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or ODD_SPACE.search(text):
        return None
    return text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00")


def is_word(piece: str) -> bool:
    """Whether a piece is letters alone, but for a space before them: the pattern keeps these whole."""
    return piece.isalpha() or (piece[:1] == " " and piece[1:].isalpha())


class Memo(dict):
    """piece -> value; computes what it lacks and forgets what wasn't used for a generation."""

    def __init__(self, compute: Callable[[str], bytes], entries: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.old = compute, entries // 2, {}

    def __missing__(self, piece: str) -> bytes:
        value = self.old.get(piece)
        if value is None:
            value = self.compute(piece)
        if len(piece) <= MEMO_PIECE:
            self.keep(piece, value)
        return value

    def keep(self, piece: str, value: bytes) -> None:
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[piece] = value
