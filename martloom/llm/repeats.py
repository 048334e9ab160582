"""Which windows of documents occur earlier: the distributed part that two operators share.

1. A sketch counts the runs' minimizers per partition and merges the counts; runs whose minimizer it
   has seen once cannot repeat and are never shuffled.
2. The others meet by minimizer as hashes. A run whose whole content occurs earlier is settled there.
   Minimizers with several contents ("contested": mostly the edges of longer matches) are noted.
3. Contested runs meet once more, window by window, in the way the operator chooses.

Before each shuffle a task keeps only the earliest of equal runs that it has read, so content that a
third of all rows share arrives once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.windows import CHUNK, Runs, Sketch, mixed, rolling, sketch_of, window_runs
from martloom.sources.staging import stage

_FLUSH = 1 << 19  # runs that a task holds before it deals them out
_BUCKETS = 4096
_RANGE_BUCKETS = 256
_BASE = 0xC2B2AE3D27D4EB4F
_GATHERED = 1 << 20  # ranges that a task merges at once
REMOVED = "bucket int, ranges binary"


class Spec(NamedTuple):
    """What counts as a unit and when a window counts as earlier."""

    units: Callable[[str | None], np.ndarray]  # a text's units as uint64
    window: int
    gram: int
    same_doc: bool  # whether an earlier start in the same document counts
    log2: int  # cells per row of the sketch


class Part(NamedTuple):
    """Concatenated stretches of documents; a long document gives several, overlapping by window - 1."""

    values: np.ndarray
    lengths: np.ndarray
    docs: np.ndarray
    bases: np.ndarray

    def owners(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.cumsum(self.lengths), at, "right")


def parts(batches: Iterator[pa.RecordBatch], spec: Spec) -> Iterator[Part]:
    """Rows without an id, and texts shorter than a window, have nothing to give."""
    held: list[tuple[np.ndarray, int, int]] = []
    size = 0

    def part() -> Part:
        lengths = np.array([len(v) for v, _, _ in held])
        return Part(
            np.concatenate([v for v, _, _ in held]), lengths, np.array([d for _, d, _ in held]), np.array([b for _, _, b in held])
        )

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            units = spec.units(text.as_py())
            if doc is None or len(units) < spec.window:
                continue
            for base in range(0, len(units) - spec.window + 1, CHUNK):
                stretch = units[base : base + CHUNK + spec.window - 1]
                if size and size + len(stretch) > CHUNK:
                    yield part()
                    held, size = [], 0
                held.append((stretch, doc, base))
                size += len(stretch)
    if held:
        yield part()


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2^64."""
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.ones(1, np.uint64)
        factor = np.uint64(base)
        while len(powers) < count:
            powers = np.concatenate([powers, powers * factor])
            factor = np.uint64(int(factor) ** 2 % (1 << 64))
        both.append(powers[:count])
    return both[0], both[1]


class RangeHash:
    """64-bit hashes of stretches of any length in constant time each."""

    def __init__(self) -> None:
        self.powers = self.inverse = np.ones(0, np.uint64)

    def __call__(self, values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        if len(self.powers) < len(values) + 1:
            self.powers, self.inverse = _powers(max(len(values), CHUNK * 2) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mixed(values + np.uint64(1)) * self.powers[: len(values)], out=sums[1:])
        return mixed((sums[stops] - sums[starts]) * self.inverse[starts] + (stops - starts).astype(np.uint64))


def merged_ranges(docs: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
    """Ranges of one document that touch become one."""
    order = np.lexsort((starts, docs))
    docs, starts, stops = docs[order], starts[order], stops[order]
    reach = stops.copy()
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (starts[1:] > reach[:-1])
    at = np.flatnonzero(new)
    stops = np.maximum.reduceat(stops, at) if len(at) else stops
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[at]), pa.array(starts[at]), pa.array(stops)], ["doc_id", "start", "stop"]
    )


class Gathered:
    """Ranges that a task has found: merged over all that it reads, and sent packed by bucket of their document.

    So what a task sends follows the removed runs that it knows of, not the windows or minimizers behind them.
    """

    def __init__(self, buckets: int) -> None:
        self.buckets, self.held, self.size = buckets, [], 0

    def add(self, docs, starts, stops) -> None:
        self.held.append(np.stack([np.asarray(c, np.int64) for c in (docs, starts, stops)]))
        self.size += self.held[-1].shape[1]

    def _merged(self) -> np.ndarray:
        columns = np.concatenate(self.held, axis=1) if self.held else np.empty((3, 0), np.int64)
        return np.stack([c.to_numpy() for c in merged_ranges(*columns).columns]) if columns.shape[1] else columns

    def full(self) -> bool:
        """Whether there is too much to hold even when merged."""
        if self.size >= _GATHERED:
            self.held = [self._merged()]
            self.size = self.held[0].shape[1]
        return self.size >= _GATHERED // 2

    def blob(self) -> bytes:
        """All ranges as one value, for ``add_blob`` of another task."""
        found = self._merged().tobytes()
        self.held, self.size = [], 0
        return found

    def add_blob(self, blob: bytes) -> None:
        self.add(*np.frombuffer(blob, np.int64).reshape(3, -1))

    def rows(self) -> pa.RecordBatch:
        merged = self._merged()
        self.held, self.size = [], 0
        bucket = (mixed(merged[0].view(np.uint64)) % np.uint64(self.buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        merged, bucket = merged[:, order], bucket[order]
        names, at = np.unique(bucket, return_index=True)
        blobs = [merged[:, a:b].tobytes() for a, b in zip(at.tolist(), [*at[1:].tolist(), len(bucket)])]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "ranges"])


def by_document(packed: DataFrame) -> DataFrame:
    """``doc_id, ranges``: the maximal runs of every document that has any."""

    def work(batches):
        def done(held):
            ranges = merged_ranges(*np.concatenate([np.frombuffer(h, np.int64).reshape(3, -1) for h in held], axis=1))
            docs = ranges.column("doc_id").to_numpy()
            at = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
            cells = pa.StructArray.from_arrays([ranges.column("start"), ranges.column("stop")], ["start", "stop"])
            lists = pa.ListArray.from_arrays(pa.array([*at, len(docs)], pa.int32()), cells)
            return pa.RecordBatch.from_arrays([pa.array(docs[at]), lists], ["doc_id", "ranges"])

        at, held = None, []
        for batch in batches:
            for bucket, ranges in zip(batch.column("bucket").to_pylist(), batch.column("ranges").to_pylist()):
                if bucket != at and held:
                    yield done(held)
                    held = []
                at = bucket
                held.append(ranges)
        if held:
            yield done(held)

    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(work, "doc_id long, ranges array<struct<start:long,stop:long>>")


def bucket_count(rows: DataFrame) -> int:
    return max(_BUCKETS, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_bucket_count(rows: DataFrame) -> int:
    """Buckets of documents in which removed ranges are packed: a task sends at most as many rows, whatever it found."""
    return max(_RANGE_BUCKETS, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def settle(keys: tuple[np.ndarray, ...], docs: np.ndarray, starts: np.ndarray, same_doc: bool) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, document and start; which rows (in that order) stay as the earliest of equal keys.

    A repeated row is the same place again, not a later one.
    """
    order = np.lexsort((starts, docs, *keys))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys]) if len(order) else False
    if not len(order):
        return order, new
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    docs, starts = docs[order], starts[order]
    first = docs == docs[leader]
    return order, first & (starts == starts[leader]) if same_doc else first


def _keys(part: Part, spec: Spec) -> Runs:
    return window_runs(part.values, part.lengths, spec.window, spec.gram)


def run_sketch(rows: DataFrame, spec: Spec) -> Sketch:
    def keys_of(batch):
        for part in parts(iter([batch]), spec):
            yield _keys(part, spec).key

    return sketch_of(rows, keys_of, spec.log2)


def _dealt(rows: DataFrame, spec: Spec, sketch: Broadcast, buckets: int) -> DataFrame:
    """Runs that may repeat, packed by bucket of their minimizer; ranges already known to go ride along."""

    def work(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def flush():
            key, content, doc, start, stop = (np.concatenate(x) for x in zip(*held))
            order, first = settle((content, key), doc, start, spec.same_doc)
            gone = order[~first]
            if len(gone):
                known = merged_ranges(doc[gone], start[gone], stop[gone])
                yield packed([np.random.default_rng(len(gone)).integers(buckets)], [0, known.num_rows], 1, [None, None, *known.columns])
            order = order[first]
            bucket = (key[order] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            order, bucket = order[by], bucket[by]
            names, at = np.unique(bucket, return_index=True)
            yield packed(names, [*at, len(order)], 0, [key[order], content[order], doc[order], start[order], stop[order]])

        def packed(names, at, kind, columns):
            arrays = [pa.array(np.asarray(names, np.int32)), pa.array(np.full(len(names), kind, np.int32))]
            for column in columns:
                raw = None if column is None else np.asarray(column)
                arrays.append(
                    pa.array([None if raw is None else raw[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())
                )
            return pa.RecordBatch.from_arrays(arrays, ["bucket", "kind", "key", "content", "doc", "start", "stop"])

        hashed, size = RangeHash(), 0
        for part in parts(batches, spec):
            runs = _keys(part, spec)
            chosen = sketch.value.holds(runs.key)
            first, last, key = (x[chosen] for x in runs)
            stop = last + spec.window
            owner = part.owners(first)
            shift = part.bases[owner] - (np.cumsum(part.lengths) - part.lengths)[owner]
            held.append((key, hashed(part.values, first, stop), part.docs[owner], first + shift, stop + shift))
            size += len(first)
            if size >= _FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return rows.mapInArrow(
        work, "bucket int, kind int, key binary, content binary, doc binary, start binary, stop binary"
    )


def _met(dealt: DataFrame, spec: Spec, buckets: int) -> DataFrame:
    """``bucket, ranges`` of runs that occur earlier as a whole, or ``keys`` of contested minimizers."""

    def work(batches):
        found = Gathered(buckets)

        def out(packed):
            none = pa.nulls(packed.num_rows, pa.binary())
            return pa.RecordBatch.from_arrays([*packed.columns, none], ["bucket", "ranges", "keys"])

        def bucket_done(held):
            key, content = (np.concatenate([np.frombuffer(h[i], np.uint64) for h in held]) for i in (0, 1))
            doc, start, stop = (np.concatenate([np.frombuffer(h[i], np.int64) for h in held]) for i in (2, 3, 4))
            order, first = settle((content, key), doc, start, spec.same_doc)
            gone = order[~first]
            k, c = key[order], content[order]
            other = np.flatnonzero((k[1:] == k[:-1]) & (c[1:] != c[:-1]))
            found.add(doc[gone], start[gone], stop[gone])
            keys = np.unique(k[other])
            if len(keys):
                cells = [pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.array([keys.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, ["bucket", "ranges", "keys"])
            if found.full():
                yield out(found.rows())

        at, held = None, []
        for batch in batches:
            columns = [batch.column(i) for i in range(2, 7)]
            for i, (bucket, kind) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist())):
                raw = [None if not c[i].is_valid else c[i].as_py() for c in columns]
                if kind == 1:
                    found.add(*(np.frombuffer(x, np.int64) for x in raw[2:]))
                    continue
                if bucket != at and held:
                    yield from bucket_done(held)
                    held = []
                at = bucket
                held.append(raw)
        if held:
            yield from bucket_done(held)
        if found.size:
            yield out(found.rows())

    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(work, f"{REMOVED}, keys binary")


def contested_runs(batches, spec: Spec, sketch: Sketch, contested: Sketch):
    """Parts with those of their runs that met a different run at the same minimizer."""
    for part in parts(batches, spec):
        runs = _keys(part, spec)
        chosen = sketch.holds(runs.key) & contested.holds(runs.key)
        if chosen.any():
            first, last, key = (x[chosen] for x in runs)
            owner = part.owners(first)
            shift = part.bases[owner] - (np.cumsum(part.lengths) - part.lengths)[owner]
            yield part, first, last, key, part.docs[owner], shift


def repeated_ranges(
    docs: DataFrame, id_col: str, text_col: str, spec: Spec, by_window: Callable[[DataFrame, Broadcast, Broadcast], DataFrame]
) -> DataFrame:
    """``(doc_id, ranges)``: the maximal runs of units covered by windows that occur earlier.

    ``by_window(rows, sketch, contested)`` gives packed ranges for windows of contested runs.
    """
    session = docs.sparkSession
    send = session.sparkContext.broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketch = send(run_sketch(rows, spec))
    buckets = bucket_count(rows)
    met = stage(_met(_dealt(rows, spec, sketch, buckets), spec, range_bucket_count(rows)), "repeats-met")

    def keys_of(batch):
        for keys in batch.column("keys"):
            yield np.frombuffer(keys.as_buffer(), np.uint64)

    contested = send(sketch_of(met.where("keys IS NOT NULL").select("keys"), keys_of, spec.log2, depth=1, least=1))
    found = met.where("ranges IS NOT NULL").select("bucket", "ranges")
    return by_document(found.unionByName(by_window(rows, sketch, contested)))


def uncovered(count: int, ranges) -> tuple[np.ndarray, int]:
    """A mask of the units that stay, and how many runs the others form."""
    edges = np.zeros(count + 1, np.int32)
    if ranges:
        starts, stops = np.array([(r["start"], r["stop"]) for r in ranges], np.int64).T
        np.add.at(edges, np.minimum(starts, count), 1)
        np.add.at(edges, np.minimum(stops, count), -1)
    covered = np.cumsum(edges[:-1]) > 0
    runs = int(np.count_nonzero(covered[1:] & ~covered[:-1]) + (count > 0 and covered[0]))
    return ~covered, runs


def window_hashes(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every window."""
    return mixed(rolling(values, width)), mixed(rolling(mixed(values), width, np.uint64(_BASE)))
