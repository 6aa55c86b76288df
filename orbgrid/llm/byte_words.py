"""Words of whole Arrow batches at once: runs of the bytes of a class, A-Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are split at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 23

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(ascii_chars: str) -> np.ndarray:
    """A class of bytes: the given ASCII characters, and all bytes of other characters."""
    inside = np.zeros(256, bool)
    inside[128:] = True
    inside[[ord(c) for c in ascii_chars]] = True
    return inside


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE_BYTES of text each, one row at least."""
    ends = np.cumsum(np.diff(_offsets(texts)))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield at, to
        at = to


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)


def split_words(texts: pa.Array, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of a string array, lower-cased, in order; and the row that each stands in.

    A word is a longest run of bytes of the class ``inside``, which has either
    case of each letter.  Null texts have none.
    """
    ends = _offsets(texts)
    data = texts.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    bounds = (ends - ends[0]).astype(np.int64)
    held = inside[raw]
    opens = held.copy()
    opens[1:] &= ~held[:-1]
    firsts = bounds[:-1][np.diff(bounds) > 0]
    opens[firsts] = held[firsts]
    starts = np.flatnonzero(opens)
    letters = _LOWER[raw[held]]
    # Places of the starts among the bytes that are left.
    at = np.append((np.cumsum(held, dtype=np.int32)[starts] - 1), len(letters)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters))
    return words, np.searchsorted(bounds, starts, side="right") - 1
