"""Runs of windows that share a minimizer, and a count-min sketch of such runs.

Equal windows have equal minimizers (the gram of smallest mixed hash, the leftmost of ties), at the same
place. So a window can only occur twice if its minimizer does, and windows that share one travel together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Odd constants that mix hashes: any would do, but every task must use the same.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xCA9B0C7EBA1DA115))
_POSITION_BITS = np.uint64(24)
CHUNK = 1 << 20  # positions handled at once, well under 2^24
_BLOCK = 1 << 16
HOT = 1024
MOST_HOT = 1 << 16


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX[0]
    return values ^ (values >> np.uint64(29))


def rolling(values: np.ndarray, width: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Polynomial hash (mod 2^64) of the ``width`` values from each position on; shorter by width - 1."""
    done, result, power = 0, None, None
    span, grams, factor = 1, values, base
    while True:
        if width & span:
            if result is None:
                result = grams
            else:
                size = len(values) - (done + span) + 1
                result = result[:size] * factor + grams[done : done + size]
            done += span
        if done == width:
            return result
        size = len(grams) - span
        grams = grams[:size] * factor + grams[span : span + size]
        factor = np.uint64(int(factor) ** 2 % (1 << 64))
        span *= 2


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Runs(NamedTuple):
    """Runs of window starts [first, last] with the hash of the minimizer that they share."""

    first: np.ndarray
    last: np.ndarray
    key: np.ndarray


def window_runs(values: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> Runs:
    """Runs over concatenated documents of the given lengths; none crosses from one to the next."""
    none = np.empty(0, np.int64)
    if len(values) < window:
        return Runs(none, none, none.astype(np.uint64))
    grams = mixed(rolling(values, gram))
    ordered = (grams >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding_min(ordered, window - gram + 1)
    place = (least & ((np.uint64(1) << _POSITION_BITS) - np.uint64(1))).astype(np.int64)
    ends = np.cumsum(lengths)
    inside = np.zeros(len(place) + 1, np.int32)
    starts = ends - lengths
    full = lengths >= window
    np.add.at(inside, starts[full], 1)
    np.add.at(inside, ends[full] - window + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    new[starts[full]] = True
    first = np.flatnonzero(new)
    if not len(first):
        return Runs(none, none, none.astype(np.uint64))
    stop = inside.copy()
    stop[:-1] &= new[1:] | ~inside[1:]
    return Runs(first, np.flatnonzero(stop), grams[place[first]])


class Sketch(NamedTuple):
    """What is left of a merged count-min sketch: cells counted often enough, and very full cells."""

    marked: np.ndarray  # depth x bytes, one bit a cell
    hot: list[np.ndarray]
    log2: int

    @staticmethod
    def cells(keys: np.ndarray, depth: int, log2: int) -> np.ndarray:
        return (keys * (_MIX[1] + np.uint64(2 * depth))) >> np.uint64(64 - log2)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether a key may have been counted that often; never false for one that was."""
        found = np.ones(len(keys), bool)
        for depth in range(len(self.marked)):
            cell = self.cells(keys, depth, self.log2)
            bits = self.marked[depth][(cell >> np.uint64(3)).astype(np.int64)]
            found &= (bits >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def very_full(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for depth, hot in enumerate(self.hot):
            found &= np.isin(self.cells(keys, depth, self.log2), hot)
        return found


def sketch_of(
    rows: DataFrame,
    keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    log2: int,
    depth: int = 2,
    least: int = 2,
) -> Sketch:
    """Count keys per partition, merge the counts by block of cells, keep which reach ``least``.

    Its size is ``depth * 2^log2`` bits, whatever the data. A sketch that is small for the data lets more
    windows through to the exact grouping, but hides none. Very full cells hold at least ``HOT`` keys
    and one in ``MOST_HOT`` of all, so there are at most ``MOST_HOT`` per row of the sketch.
    """
    blocks = max(1, (1 << log2) // _BLOCK)

    def count(batches):
        def counted(keys):
            for d in range(depth):
                cells = np.sort(Sketch.cells(keys, d, log2))
                block = (cells // np.uint64(_BLOCK)).astype(np.int64)
                names, at = np.unique(block, return_index=True)
                within = (cells % np.uint64(_BLOCK)).astype("<u2")
                parts = [p.tobytes() for p in np.split(within, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((names + d * blocks).astype(np.int32)), pa.array(parts, pa.binary())], ["block", "cells"]
                )

        waiting, size = [], 0
        for batch in batches:
            for keys in keys_of(batch):
                waiting.append(keys)
                size += len(keys)
                if size >= 1 << 20:
                    yield from counted(np.concatenate(waiting))
                    waiting, size = [], 0
        if size:
            yield from counted(np.concatenate(waiting))

    def merge(batches):
        at, counts = None, None

        def merged():
            full = np.flatnonzero(counts >= HOT)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at], pa.int32()),
                    pa.array([int(counts.sum())], pa.int64()),
                    pa.array([np.packbits(counts >= least, bitorder="little").tobytes()], pa.binary()),
                    pa.array([full.astype("<i4").tobytes()], pa.binary()),
                    pa.array([counts[full].astype("<i8").tobytes()], pa.binary()),
                ],
                ["block", "keys", "marked", "full", "counts"],
            )

        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells")):
                if block != at:
                    if at is not None:
                        yield from merged()
                    at, counts = block, np.zeros(_BLOCK, np.int64)
                counts += np.bincount(np.frombuffer(cells.as_buffer(), "<u2"), minlength=_BLOCK)
        if at is not None:
            yield from merged()

    merged = (
        rows.mapInArrow(count, "block int, cells binary")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(merge, "block int, keys long, marked binary, full binary, counts binary")
        .toArrow()
    )
    size = max(blocks * _BLOCK, 1 << log2) // 8
    marked = np.zeros((depth, size), np.uint8)
    totals = merged.column("keys").to_numpy()
    full_at = max(HOT, int(totals.sum()) // depth // MOST_HOT)
    hot: list[list[np.ndarray]] = [[np.empty(0, np.uint64)] for _ in range(depth)]
    for row in range(merged.num_rows):
        d, block = divmod(merged.column("block")[row].as_py(), blocks)
        bits = np.frombuffer(merged.column("marked")[row].as_buffer(), np.uint8)
        marked[d, block * _BLOCK // 8 : block * _BLOCK // 8 + len(bits)] = bits
        full = np.frombuffer(merged.column("full")[row].as_buffer(), "<i4")
        counts = np.frombuffer(merged.column("counts")[row].as_buffer(), "<i8")
        hot[d].append((full[counts >= full_at] + block * _BLOCK).astype(np.uint64))
    return Sketch(marked, [np.concatenate(h) for h in hot], log2)
