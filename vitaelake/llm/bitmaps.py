"""Bit maps of a fixed number of bits over 64-bit hashes, for tests that may err to yes.

A hash stands for the bit that its highest bits name. Tasks sort the slots of their
rows by parts of the map, a part is packed by the task that its slots are shuffled
to, and only packed parts reach the driver: never more than the map's own size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitaelake.sources.staging import stage

_U64 = np.uint64
#: log2 of the bits of a part.
PART_BITS = 16


def may_hold(bit_map: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the map may hold; every one that it was made of is among them."""
    slots = hashes >> _U64(64 - (len(bit_map).bit_length() + 2))
    return (bit_map[slots >> _U64(3)] >> (7 - (slots & _U64(7))).astype(np.uint8)) & 1 > 0


def joined_parts(parts: DataFrame, bits: int, part_bits: int) -> np.ndarray:
    """The map of its parts, rows of ``bucket`` and ``bits``; missing ones have no bit."""
    whole = np.zeros(1 << (bits - 3), dtype=np.uint8)
    size = 1 << (part_bits - 3)
    for row in parts.toLocalIterator():
        part = np.frombuffer(row["bits"], np.uint8)
        whole[row["bucket"] * size : (row["bucket"] + 1) * size] = part
    return whole


def _slots(hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            slots = np.unique(hashes_of(batch) >> _U64(64 - bits))
            parts = (slots >> _U64(PART_BITS)).astype(np.int32)
            own = (slots & _U64((1 << PART_BITS) - 1)).astype("<u4")
            cuts = np.flatnonzero(np.diff(parts, prepend=-1))
            packed = [p.tobytes() for p in np.split(own, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[cuts]), pa.array(packed, pa.binary())], names=["bucket", "slots"]
            )

    return run


def _part(table: pa.Table) -> pa.Table:
    bits = np.zeros(1 << PART_BITS, dtype=bool)
    for slots in table.column("slots").to_pylist():
        bits[np.frombuffer(slots, dtype="<u4")] = True
    return pa.table(
        {"bucket": table.column("bucket")[:1], "bits": pa.array([np.packbits(bits).tobytes()])}
    )


def bit_map_of(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """The map of the hashes that ``hashes_of`` finds in batches of the rows."""
    slots = rows.mapInArrow(_slots(hashes_of, bits), "bucket int, slots binary")
    parts = slots.groupBy("bucket").applyInArrow(_part, "bucket int, bits binary")
    return joined_parts(stage(parts, "bit-map"), bits, PART_BITS)
