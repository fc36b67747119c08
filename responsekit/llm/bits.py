"""Bloom filters of a fixed size, filled inside tasks and merged slice by slice.

A filter has ``bits`` bits at every input size, so what a task holds, what reaches
the driver and what is broadcast have that bound. A task leaves its filters as
compressed slices; slices of one number meet in one task, which streams over them
and keeps one slice of each kind. A filter that is too full lets more through,
never less: whoever uses it confirms exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from responsekit.llm.common import cut_batch, mix64

#: Default number of bits of a filter (32 MB): a power of two.
BITS = 1 << 28
#: Bytes of a slice.
SLICE = 1 << 16
_SECOND = np.uint64(0xA24BAED4963EE407)
SLICES = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("once", T.BinaryType()),
                       T.StructField("twice", T.BinaryType())])


class BitFilter:
    """A Bloom filter with two positions for each 64-bit hash."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(max(bits // 8, 1), dtype=np.uint8) if data is None else data

    def places(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for x in (h, mix64(h ^ _SECOND)):
            at = x & self.mask
            yield (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for byte, bit in self.places(h):
            np.bitwise_or.at(self.data, byte, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), dtype=bool)
        for byte, bit in self.places(h):
            found &= (self.data[byte] & bit) != 0
        return found


class SeenTwice:
    """Two filters: hashes seen once or more, and hashes seen twice or more."""

    def __init__(self, bits: int):
        self.once, self.twice = BitFilter(bits), BitFilter(bits)

    def add(self, h: np.ndarray) -> None:
        u, n = np.unique(h, return_counts=True)
        self.twice.add(u[self.once.has(u) | (n > 1)])
        self.once.add(u)


def slices(once: np.ndarray, twice: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """The slices of a filter (or a pair) in which a bit is set, as rows of ``SLICES``."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for k in range(0, len(once), SLICE):
        a = once[k: k + SLICE]
        if a.any():
            b = pack(twice[k: k + SLICE].tobytes()) if twice is not None else None
            yield pa.RecordBatch.from_arrays([pa.array([k // SLICE], pa.int32()), pa.array([pack(a.tobytes())], pa.binary()),
                                              pa.array([b], pa.binary())], names=SLICES.names)


def fill(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int, twice: bool = False) -> DataFrame:
    """Slices of the filters of each task of ``df``; ``hashes`` gives a batch's hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = SeenTwice(bits) if twice else BitFilter(bits)
        for batch in batches:
            for part in cut_batch(batch):
                kept.add(hashes(part))
        yield from slices(kept.once.data, kept.twice.data) if twice else slices(kept.data)

    return df.mapInArrow(run, SLICES)


def merge(parts: DataFrame, bits: int) -> DataFrame:
    """One row for each slice number: ``once`` is the union of the parts; ``twice`` has, besides theirs, the bits
    that are in ``once`` of two parts (so it holds every hash that two parts have seen)."""
    size = min(SLICE, max(bits // 8, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, once, twice in zip(*(batch.column(c).to_pylist() for c in SLICES.names)):
                o, t = held.setdefault(k, (np.zeros(size, np.uint8), np.zeros(size, np.uint8)))
                new = np.frombuffer(unpack(once), dtype=np.uint8)
                t |= o & new
                o |= new
                if twice is not None:
                    t |= np.frombuffer(unpack(twice), dtype=np.uint8)
        pack = zstandard.ZstdCompressor(level=1).compress
        for k, (o, t) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(o.tobytes())], pa.binary()),
                                              pa.array([pack(t.tobytes())], pa.binary())], names=SLICES.names)

    return parts.repartition("slice").mapInArrow(run, SLICES)


def collect(merged: DataFrame, which: str, bits: int):
    """A broadcast variable of the whole filter ``which`` ("once" or "twice"): ``bits`` / 8 bytes at any input size."""
    size = max(bits // 8, 1)
    data, unpack = np.zeros(size, dtype=np.uint8), zstandard.ZstdDecompressor().decompress
    for k, x in merged.select("slice", which).collect():
        data[k * SLICE: k * SLICE + min(SLICE, size)] = np.frombuffer(unpack(x), dtype=np.uint8)
    return merged.sparkSession.sparkContext.broadcast(data)


def task_number() -> int:
    return TaskContext.get().partitionId()
