"""A bitmap of fixed size over 64-bit hashes: says for sure what a table does not hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.words import mix

#: 2**24 bits are 2 MB, whatever the table's size; a table with many more keys only makes it save less.
LOG_BITS, LOG_PART = 24, 18


class Bits:
    """Bits of the hashes that were added."""

    def __init__(self, packed: np.ndarray):
        self._packed = packed

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """False only for hashes that were not added."""
        at = mix(hashes, 7) >> np.uint64(64 - LOG_BITS)
        return (self._packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    bits = np.zeros(1 << LOG_BITS, bool)
    for batch in batches:
        bits[mix(batch["h"].to_numpy().view(np.uint64), 7) >> np.uint64(64 - LOG_BITS)] = True
    packed = np.packbits(bits, bitorder="little").reshape(-1, 1 << (LOG_PART - 3))
    some = np.flatnonzero(packed.any(axis=1))
    yield pd.DataFrame({"part": some, "bits": [packed[i].tobytes() for i in some]})


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    rows = np.stack([np.frombuffer(x, np.uint8) for x in frame["bits"]])
    return pd.DataFrame({"part": frame["part"][:1], "bits": [np.bitwise_or.reduce(rows).tobytes()]})


def bitmap(df: DataFrame, column: str) -> Bits:
    """The bitmap of a long column, put together by the executors in parts of 32 KB; nulls count as 0."""
    parts = df.select(F.coalesce(F.col(column), F.lit(0)).alias("h")).coalesce(16).mapInPandas(_parts, "part long, bits binary")
    merged = parts.groupBy("part").applyInPandas(_merge, "part long, bits binary")
    packed = np.zeros((1 << (LOG_BITS - LOG_PART), 1 << (LOG_PART - 3)), np.uint8)
    for part, bits in merged.collect():
        packed[part] = np.frombuffer(bits, np.uint8)
    return Bits(packed.reshape(-1))
