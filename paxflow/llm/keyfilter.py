"""A Bloom filter over a table of 64-bit keys, for tasks that read text.

It only thins what a task emits: false hits are removed later by an exact
join, so results never depend on it. Its size follows the key count up to
``MAX_BYTES``, the bound of what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxflow.llm.memory import frees_memory

BITS_PER_KEY = 12
MAX_BYTES = 64 << 20
BLOCK_BYTES = 1 << 16


def hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the table."""
    return _bit(bits, keys * np.uint64(0xBF58476D1CE4E5B9)) & _bit(bits, keys * np.uint64(0x94D049BB133111EB))


def _bit(bits: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    at = _position(mixed, len(bits))
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _position(mixed: np.ndarray, n_bytes: int) -> np.ndarray:
    return mixed >> np.uint64(64 - (n_bytes * 8).bit_length() + 1)


def key_filter(keys: DataFrame, column: str = "key") -> np.ndarray:
    """The filter's bytes, built block by block in tasks; each block arrives at the driver once."""
    n_bytes = BLOCK_BYTES
    wanted = keys.count() * BITS_PER_KEY // 8
    while n_bytes < min(wanted, MAX_BYTES):
        n_bytes *= 2

    @frees_memory
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            at = np.concatenate(
                [_position(own * np.uint64(m), n_bytes) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
            ).astype(np.int64)
            at.sort()
            yield pa.RecordBatch.from_arrays([pa.array(at // (BLOCK_BYTES * 8)), pa.array(at % (BLOCK_BYTES * 8))], ["block", "bit"])

    @frees_memory
    def fill(part):
        import pandas as pd

        block = np.zeros(BLOCK_BYTES, np.uint8)
        bit = part["bit"].to_numpy()
        np.bitwise_or.at(block, bit >> 3, (1 << (bit & 7)).astype(np.uint8))
        return pd.DataFrame({"block": [part["block"].iloc[0]], "bits": [block.tobytes()]})

    spreaded = keys.select(F.col(column).cast("long")).mapInArrow(spread, "block bigint, bit bigint").distinct()
    bits = np.zeros(n_bytes, np.uint8)
    for row in spreaded.groupBy("block").applyInPandas(fill, "block bigint, bits binary").toLocalIterator():
        bits[row.block * BLOCK_BYTES : (row.block + 1) * BLOCK_BYTES] = np.frombuffer(row.bits, np.uint8)
    return bits
