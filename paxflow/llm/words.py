"""Words of Arrow string batches as 64-bit hashes, vectorised.

A batch is treated as one byte buffer: white space ends words, and a word's
polynomial hash is a difference of running sums, so no Python code runs per
word or per text. Two different words share a hash with a chance of about
2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are handled in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of texts, in order."""

    hash: np.ndarray  # uint64 per word
    first: np.ndarray  # index of each text's first word, plus the number of words
    start: np.ndarray  # byte offsets into ``raw``
    end: np.ndarray
    raw: np.ndarray  # the texts' bytes (lower-cased if asked for)

    @property
    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): the texts' UTF-8 bytes and where each begins, and the end; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Splitter:
    def __init__(self, lower: bool, letters_only: bool = False):
        """``letters_only``: every ASCII byte but letters and digits parts words."""
        self.lower = lower
        self.parts = _PUNCTUATION if letters_only else _SPACE
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.power):
            n = max(n, SLICE_BYTES + SLICE_BYTES // 4)
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE, np.uint64)])
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _INVERSE, np.uint64)])
        return self.power, self.inverse

    def split(self, texts: pa.Array) -> Words:
        raw, bounds = buffer_of(texts)
        if self.lower:
            raw = _LOWER[raw]
        space = self.parts[raw]
        before = np.empty(len(raw) + 1, bool)
        before[1:] = space
        before[bounds] = True
        starts = np.flatnonzero(~space & before[:-1])
        after = np.ones(len(raw) + 1, bool)
        after[: max(0, len(raw) - 1)] = space[1:]
        after[bounds - 1] = True
        ends = np.flatnonzero(~space & after[:-1]) + 1
        return Words(self.hashes(raw, starts, ends), np.searchsorted(starts, bounds), starts, ends, raw)

    def hashes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each byte range."""
        power, inverse = self._powers(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
        return mix(((sums[ends] - sums[starts]) * inverse[starts]) ^ (ends - starts).astype(np.uint64))


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch of about SLICE_BYTES of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, start = np.cumsum(sizes), 0
    while start < len(sizes):
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + SLICE_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start = end


def runs(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, texts) of all runs of ``n`` words inside one text."""
    counts = np.maximum(np.diff(words.first) - n + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return words.first[text] + inside, text


def combine(hashes: np.ndarray, starts: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """One hash for each run of ``n`` words."""
    total = np.full(len(starts), (salt * 2 + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1, np.uint64)
    for k in range(n):
        total = mix(total ^ hashes[starts + k])
    return total
