"""Which rows may be in a table of row keys, told without shuffling the rows: a blocked Bloom filter.

The filter takes 12 bits a key up to 32 MB, whatever the number of keys; beyond, more rows pass it in vain.  It
never misses a key, and an exact join has to follow.  Keys are dealt by block, so each task sets the bits of the
blocks it has, one block at a time; the driver receives the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 19      # bits: 64 KB
BITS_PER_KEY = 12
MAX_BLOCKS = 512
PROBES = 3


def _probes(key: np.ndarray) -> list[np.ndarray]:
    k = key.view(np.uint64)
    return [((k >> np.uint64(20 * i)) & np.uint64(BLOCK - 1)).astype(np.int64) for i in range(PROBES)]


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by block."""
    current, bits = None, np.zeros(BLOCK, bool)

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                          names=["block", "bits"])

    for batch in batches:
        of, key = batch.column("block").to_numpy(), batch.column("key").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if current is not None and of[a] != current:
                yield block()
                bits = np.zeros(BLOCK, bool)
            current = int(of[a])
            for at in _probes(key[a:b]):
                bits[at] = True
    if current is not None:
        yield block()


def may_hold(keys: DataFrame, key_1: str, key_2: str):
    """A function from two key columns to a boolean column: false only for rows whose key is not in ``keys``.

    ``keys`` is a written table with two 64-bit hashes; the first one names the block, the second one the bits."""
    n, blocks = keys.count(), 1
    while blocks < MAX_BLOCKS and n * BITS_PER_KEY > blocks * BLOCK:
        blocks *= 2
    made = (keys.select(F.pmod(key_1, F.lit(blocks)).cast("long").alias("block"), F.col(key_2).alias("key"))
            .repartition(min(blocks, 64), "block").sortWithinPartitions("block").mapInArrow(_set_bits, "block long, bits binary"))
    bits = np.zeros((blocks, BLOCK // 8), np.uint8)
    for row in made.toLocalIterator():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def held(a: pd.Series, b: pd.Series) -> pd.Series:
        bits = shared.value
        block = np.mod(a.to_numpy(), len(bits))
        out = np.ones(len(a), bool)
        for at in _probes(b.to_numpy()):
            out &= (bits[block, at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
        return pd.Series(out)

    def column(a: Column, b: Column) -> Column:
        return held(a, b)
    return column
