"""Texts of an Arrow batch as arrays of code points, a bounded part at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def bounded(batch: pa.RecordBatch, text: int, most: int = 1 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
        to = min(max(to, at + 1), at + rows)
        yield batch.slice(at, to - at)
        at = to


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes, owner): lower-case letters of all texts, each run of other characters as one 0.

    The first and last code is 0; ``owner`` is the row of a code, a 0 belonging to the text before it.
    """
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    lengths = pc.utf8_length(low).to_numpy(zero_copy_only=False) + 1
    codes = np.frombuffer(("\n" + "\n".join(low.to_pylist()) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.concatenate([[0], np.repeat(np.arange(len(low)), lengths)])
    known = np.fromiter((chr(c).isalpha() for c in range(int(codes.max()) + 1)), bool, int(codes.max()) + 1)
    codes = np.where(known[codes], codes, 0).astype(np.int64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep], owner[keep]


def pieces(text: str, most: int = 1 << 20) -> Iterator[tuple[str, bool]]:
    """Parts of a text of at most ``most`` characters, and whether a part goes on inside a word.

    A part ends before a character that is no letter wherever one is near; only a run of letters longer
    than a part is cut, and its first and last letters are the caller's to mend.
    """
    at = 0
    while at < len(text):
        end = min(at + most, len(text))
        if end < len(text):
            cut = end
            while cut > at and text[cut].lower()[:1].isalpha():
                cut -= 1
            end = cut if cut > at else end
        yield text[at:end], end < len(text) and text[end].lower()[:1].isalpha() and text[end - 1].lower()[-1:].isalpha()
        at = end
