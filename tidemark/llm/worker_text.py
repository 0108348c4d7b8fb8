"""Words of whole batches of texts as arrays, inside Python workers.

Spark interprets functions on arrays element by element; looking up each word of
a corpus that way costs several times what vector operations over the bytes of
an Arrow batch do. A batch becomes one run of folded bytes; words are found,
hashed and counted without a loop over words.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

if TYPE_CHECKING:  # loaded in the workers only
    import numpy as np

#: Characters of text that are taken apart at once, whatever the batch holds; one longer text is a slice of its own.
SLICE_CHARS = 2_000_000
#: Kinds of bytes of a folded text.
SYMBOL, LETTER, DIGIT, BLANK, BREAK = range(5)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Quotation marks and line ends that have a plain counterpart.
_PLAIN = {0x201C: '"', 0x201D: '"', 0x201E: '"', 0xAB: '"', 0xBB: '"', 0x2018: "'", 0x2019: "'", 0x2028: "\n", 0x2029: "\n", 0x85: "\n"}
_BEYOND = re.compile(r"[^\x00-\x7f]+")


_MEMO: dict[str, str] = {}


def _plain(run: str) -> str:
    """A run of characters beyond ASCII without marks and invisible ones; its blanks are spaces, its symbols one byte each."""
    if run in _MEMO:
        return _MEMO[run]
    out = []
    for char in run:
        kind = unicodedata.category(char)
        if ord(char) in _PLAIN:
            out.append(_PLAIN[ord(char)])
        elif kind[0] == "M" or kind == "Cf":
            continue
        elif kind[0] in "LN":
            out.append(char)
        else:
            out.append(" " if char.isspace() else "\x02")
    if len(_MEMO) > 100_000:
        _MEMO.clear()
    _MEMO[run] = "".join(out)
    return _MEMO[run]


def folded(text: str | None) -> bytes:
    """Lower case without accents, width forms, combining marks and invisible characters; symbols beyond ASCII are one byte."""
    if not text:
        return b""
    if text.isascii():
        return text.encode().translate(_LOWER)
    return _BEYOND.sub(lambda m: _plain(m[0]), unicodedata.normalize("NFKD", text.casefold())).encode()


def kinds() -> np.ndarray:
    """The kind of each byte: letters beyond ASCII are bytes of 128 and more."""
    import numpy as np

    out = np.full(256, SYMBOL, np.uint8)
    out[128:] = LETTER
    out[[*range(ord("a"), ord("z") + 1)]] = LETTER
    out[[*range(ord("0"), ord("9") + 1)]] = DIGIT
    out[[*b" \t\x0b\x0c\x1c\x1d\x1e\x1f\x00"]] = BLANK
    out[[*b"\r\n"]] = BREAK
    return out


@dataclass
class Words:
    """The words of some texts: ``data`` is their folded bytes, each text followed by a line break."""

    data: np.ndarray
    kind: np.ndarray
    text_at: np.ndarray  # first byte of each text, and the end of all
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    owner: np.ndarray  # the text of each word


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly."""
    import numpy as np

    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0x94D049BB133111EB) ^ (h >> np.uint64(32))


def take_words(texts: list[str | None]) -> Words:
    """The words of ``texts``: runs of letters and digits, with a hash each."""
    import numpy as np

    parts = [folded(t) for t in texts]
    text_at = np.r_[0, np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    kind = kinds()[data]
    solid = (kind == LETTER) | (kind == DIGIT)
    turn = np.diff(np.r_[False, solid, False].astype(np.int8))
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    if len(start) == 0:
        return Words(data, kind, text_at, start, end, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    length = end - start
    first = np.r_[0, np.cumsum(length)[:-1]]
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(int(length.max()) - 1, 0x9E3779B97F4A7C15, np.uint64)])
    summed = np.add.reduceat((data[solid].astype(np.uint64) + np.uint64(1)) * powers[place], first)
    per_text = np.diff(np.searchsorted(start, text_at))
    return Words(data, kind, text_at, start, end, mix(summed), np.repeat(np.arange(len(texts)), per_text))


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that hold about ``SLICE_CHARS`` characters each."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > start and held + size > SLICE_CHARS:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)
