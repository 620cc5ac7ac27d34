"""Terms of a text: its runs of letters, digits and characters beyond ASCII, with A-Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20


def _table() -> bytes:
    kept = bytearray(b" " * 128) + bytearray(range(128, 256))
    for letter in range(26):
        kept[65 + letter] = kept[97 + letter] = 97 + letter
    for digit in range(48, 58):
        kept[digit] = digit
    return bytes(kept)


#: Each byte of a text in UTF-8 as it stands in a term, a space where it parts terms.
IN_TERMS = _table()


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The text's terms in order, in lists of about ``PIECE`` bytes, so that a text of any length takes little memory; null has none."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(IN_TERMS)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + PIECE) if begin + PIECE < len(data) else -1
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


def mixed(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` codes."""
    n = max(0, len(codes) - size + 1)
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = (out ^ codes[i : i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, … (counts[0] numbers), then those of the next begin, and so on."""
    return np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
