"""Words of many texts at once, as byte ranges and 64-bit hashes in NumPy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text that is scanned at a time; some twenty bytes of working memory for each byte of it.
SLICE_BYTES = 1 << 20

# Odd, so that powers have inverses modulo 2^64.
BASE = 0x9E3779B97F4A7C15
STEPS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

_mixed = np.random.default_rng(20).integers(1, 1 << 63, size=256, dtype=np.uint64)


def lower_word_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Byte tables: A-Z lowered, and whether a (lowered) byte is part of a word.

    Words are digits, letters and all of UTF-8 beyond ASCII.
    """
    lowered = np.arange(256, dtype=np.uint8)
    lowered[65:91] += 32
    part = np.zeros(256, dtype=bool)
    part[48:58] = part[97:123] = part[128:] = True
    return lowered, part


LOWERED, WORD_PART = lower_word_bytes()


_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base^0 to base^(count - 1) modulo 2^64, by doubling; kept for the next slice of a task."""
    made = _powers.get(base, np.ones(1, dtype=np.uint64))
    while len(made) < count:
        made = np.concatenate([made, made * np.uint64(pow(base, len(made), 1 << 64))])
    _powers[base] = made
    return made[:count]


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: none) one after another, and their bounds."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_binary()), b"")])
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """The words of the texts: `buffer` (lowered bytes), starts, ends, and the bounds per text.

    The words of text i are those from bounds[i] to bounds[i + 1].
    """

    def __init__(self, texts: pa.Array) -> None:
        raw, self.offsets = byte_view(texts)
        self.buffer = LOWERED[raw]
        inside = WORD_PART[self.buffer]
        before = np.concatenate([[False], inside[:-1]])[: len(inside)]
        edge = np.zeros(len(inside) + 1, dtype=bool)
        edge[self.offsets] = True
        edge = edge[:-1]
        opens = inside & (~before | edge)
        closes = before & (~inside | edge)
        self.starts = np.flatnonzero(opens)
        ends = np.flatnonzero(closes)
        self.ends = np.append(ends, len(inside)) if len(inside) and inside[-1] else ends
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes in any text."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        size = len(self.buffer)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_mixed[self.buffer] * powers(BASE, size), out=sums[1:])
        back = powers(pow(BASE, -1, 1 << 64), size)
        made = (sums[self.ends] - sums[self.starts]) * back[self.starts]
        return (made ^ (made >> np.uint64(29))) * np.uint64(STEPS[0])

    def text_of(self) -> np.ndarray:
        """The text's number for each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def join(self, first: int, count: int) -> bytes:
        """`count` words from `first`, with single spaces."""
        data, chosen = self.buffer, range(first, first + count)
        return b" ".join(data[self.starts[i] : self.ends[i]].tobytes() for i in chosen)


def run_hashes(hashes: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """A hash of the `count` words from each position in `first`."""
    made = np.zeros(len(first), dtype=np.uint64)
    for i in range(count):
        made = (made ^ hashes[first + i]) * np.uint64(STEPS[1 + i % 3])
        made ^= made >> np.uint64(31)
    return made
