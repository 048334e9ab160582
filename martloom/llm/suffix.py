"""Suffix-array deduplication: repeated byte windows found by deep-shallow suffix sorting.

Suffixes that start windows of contested runs are sorted by multikey comparison to a shallow depth, two
symbols of eight bytes; what still ties has a long common prefix and is ordered by a blind trie.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import repeats
from martloom.llm.repeats import REMOVED, Gathered, Spec, merged_ranges

WINDOW = 50
GRAM = 20
LOG2 = 28
SHALLOW = 16
_CHUNK = 1 << 21


class BlindTrie:
    """Orders equally long suffixes of a buffer; inner nodes store a depth and one branching symbol per child.

    A search compares only the branching symbols. It ends at some leaf, whose true common prefix with the
    new suffix then tells where the new branch belongs.
    """

    def __init__(self, buffer: bytes, skip: int, width: int) -> None:
        self.buffer, self.skip, self.width = buffer, skip, width
        self.root: list | None = None  # leaf: [None, [positions]]; node: [depth, {symbol: child}]

    def add(self, position: int) -> None:
        buffer, width = self.buffer, self.width
        if self.root is None:
            self.root = [None, [position]]
            return
        node = self.root
        while node[0] is not None:
            node = node[1].get(buffer[position + node[0]]) or next(iter(node[1].values()))
        other, depth = node[1][0], self.skip
        new, old = buffer[position + depth : position + width], buffer[other + depth : other + width]
        if new == old:
            node[1].append(position)
            return
        low, high = 0, len(new) - 1  # the first difference, by halving
        while low < high:
            middle = (low + high) // 2
            if new[low : middle + 1] == old[low : middle + 1]:
                low = middle + 1
            else:
                high = middle
        depth += low
        above, node = None, self.root
        while node[0] is not None and node[0] < depth:
            above, node = node, node[1][buffer[position + node[0]]]
        leaf = [None, [position]]
        if node[0] == depth:
            node[1][buffer[position + depth]] = leaf
            return
        split = [depth, {buffer[other + depth]: node, buffer[position + depth]: leaf}]
        if above is None:
            self.root = split
        else:
            above[1][buffer[position + above[0]]] = split

    def groups(self):
        """Positions of equal suffixes, in suffix order."""
        stack = [self.root] if self.root else []
        while stack:
            depth, content = stack.pop()
            if depth is None:
                yield content
            else:
                stack += [content[symbol] for symbol in sorted(content, reverse=True)]


def _symbols(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one big-endian number, zero beyond the end."""
    wide = np.concatenate([buffer, np.zeros(8, np.uint8)]).astype(np.uint64)
    for span in (1, 2, 4):
        wide = (wide[:-span] << np.uint64(8 * span)) | wide[span:]
    return wide[: len(buffer)]


def equal_windows(buffer: bytes, starts: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Order the windows at ``starts`` by content; ``(order, group)``, equal windows in one group."""
    symbols = _symbols(np.frombuffer(buffer, np.uint8))
    depth = min(SHALLOW, width) - 8
    one, two = symbols[starts], symbols[starts + depth]
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    at = np.append(np.flatnonzero(new), len(order))
    sizes = np.diff(at)
    # A pair needs one comparison of what is left, no trie.
    pairs = at[:-1][sizes == 2]
    left, right = starts[order[pairs]], starts[order[pairs + 1]]
    same, swap = np.ones(len(pairs), bool), np.zeros(len(pairs), bool)
    for step in [*range(depth + 8, width - 8, 8), width - 8]:
        a, b = symbols[left + step], symbols[right + step]
        swap |= same & (a > b)
        same &= a == b
    order[pairs[swap]], order[pairs[swap] + 1] = order[pairs[swap] + 1], order[pairs[swap]]
    new[pairs[~same] + 1] = True
    for group in np.flatnonzero(sizes > 2):
        low, high = at[group], at[group + 1]
        members = order[low:high]
        trie, where = BlindTrie(buffer, depth + 8, width), {}
        for member, position in zip(members.tolist(), starts[members].tolist()):
            trie.add(position)
            where[position] = member
        for equal in trie.groups():
            new[low] = True
            order[low : low + len(equal)] = [where[p] for p in equal]
            low += len(equal)
    return order, np.cumsum(new) - 1


def settle_chunk(docs: np.ndarray, starts: np.ndarray, contents: list[bytes], window: int) -> pa.RecordBatch:
    """Ranges whose windows also start in a smaller document of this chunk; equal contents count as one.

    Runs of several windows that equal an earlier one as a whole are left out: they are settled before.
    """
    names: dict[bytes, int] = {}
    variant = np.array([names.setdefault(c, len(names)) for c in contents])
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, variant, docs)
    buffer = b"".join(names)
    sizes = np.array([len(c) for c in names]) - window + 1
    ends = np.cumsum(sizes + window - 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = (ends - sizes - window + 1)[owner] + offset
    order, group = equal_windows(buffer, at, window)
    smallest = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(smallest, group, least[owner[order]])
    gone = np.zeros(len(owner), bool)
    gone[order] = smallest[group] < least[owner[order]]
    # Rows of larger documents than their content's smallest went before if they are whole runs, but windows
    # that parted company go here; rows of the smallest lose the windows that another content has earlier.
    alone = np.flatnonzero((docs > least[variant]) & (sizes[variant] == 1))
    first = np.cumsum(sizes) - sizes
    mine = np.flatnonzero((docs == least[variant]) & (np.add.reduceat(gone, first)[variant] > 0))
    count = sizes[variant[mine]]
    row = np.repeat(mine, count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    lost = gone[first[variant[row]] + step]
    row = np.concatenate([row[lost], alone])
    begin = np.concatenate([(starts[np.repeat(mine, count)] + step)[lost], starts[alone]])
    return merged_ranges(docs[row], begin, begin + window)


def _by_suffix(spec: Spec):
    def by_window(rows: DataFrame, sketch, contested) -> DataFrame:
        buckets = repeats.range_bucket_count(rows)

        def emit(held, lost):
            batch = [(k, d, s, c) for (k, c), (d, at) in held.items() for s in at]
            keys, docs, starts, contents = zip(*batch) if batch else ((), (), (), ())
            known = Gathered(buckets)
            known.add(*np.array(lost, np.int64).reshape(-1, 3).T)
            # Ranges that a task finds by itself travel as one value beside the contents that others may have earlier.
            blobs = [known.blob()] if lost else []
            keys = [*keys, *map(xxhash.xxh64_intdigest, blobs)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(keys, np.uint64).view(np.int64)),
                    pa.array([*docs, *(None for _ in blobs)], pa.int64()),
                    pa.array([*starts, *(None for _ in blobs)], pa.int64()),
                    pa.array([*contents, *(None for _ in blobs)], pa.binary()),
                    pa.array([*(None for _ in docs), *blobs], pa.binary()),
                ],
                ["key", "doc_id", "start", "content", "ranges"],
            )

        def work(batches):
            held: dict[tuple[int, bytes], tuple[int, list[int]]] = {}
            lost: list[tuple[int, int, int]] = []
            for part, first, last, key, doc, shift in repeats.contested_runs(batches, spec, sketch.value, contested.value):
                raw = part.values.astype(np.uint8).tobytes()
                hot = sketch.value.very_full(key)
                for k, d, a, b, s, single in zip(key.tolist(), doc.tolist(), first.tolist(), last.tolist(), shift.tolist(), hot.tolist()):
                    # Windows at a very frequent minimizer part company: each goes where its own bytes say.
                    for at, to in ((x, x) for x in range(a, b + 1)) if single else ((a, b),):
                        content = raw[at : to + spec.window]
                        name = (xxhash.xxh64_intdigest(content) if single else k, content)
                        known = held.get(name)
                        if known is None or d < known[0]:
                            held[name] = (d, [at + s])
                            if single and known:
                                lost += [(known[0], x, x + spec.window) for x in known[1]]
                        elif d == known[0]:
                            known[1].append(at + s)
                        elif single:
                            lost.append((d, at + s, at + s + spec.window))
                if len(held) >= 1 << 16:
                    yield from emit(held, lost)
                    held, lost = {}, []
                elif len(lost) >= 1 << 16:
                    yield from emit({}, lost)
                    lost = []
            if held or lost:
                yield from emit(held, lost)

        def sort(batches):
            held, size, found = [], 0, Gathered(buckets)

            def done(tables):
                docs, starts = (np.concatenate([t.column(n).to_numpy() for t in tables]) for n in ("doc_id", "start"))
                contents = [c for t in tables for c in t.column("content").to_pylist()]
                found.add(*settle_chunk(docs, starts, contents, spec.window).columns)

            for batch in batches:
                for blob in batch.column("ranges").drop_null().to_pylist():
                    found.add_blob(blob)
                if found.full():
                    yield found.rows()
                batch = batch.filter(batch.column("content").is_valid())
                if not batch.num_rows:
                    continue
                keys = batch.column("key").to_numpy()
                cut = 0
                if held and size >= _CHUNK:  # between two minimizers only
                    before = held[-1].column("key")[-1].as_py()
                    cut = int(np.searchsorted(keys != before, True)) if keys[0] == before else 0
                    if cut < len(keys):
                        done([*held, batch.slice(0, cut)])
                        held, size = [], 0
                    else:
                        cut = 0
                rest = batch.slice(cut)
                held.append(rest)
                size += rest.column("content").nbytes
            if held:
                done(held)
            if found.size:
                yield found.rows()

        met = rows.mapInArrow(work, "key long, doc_id long, start long, content binary, ranges binary")
        return met.repartition("key").sortWithinPartitions("key").mapInArrow(sort, REMOVED)

    return by_window


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)


def remove_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, log2: int = LOG2
) -> DataFrame:
    """``doc_id, n_bytes, n_spans, kept``: one row per input row; ``kept`` is binary, what is left of the UTF-8 bytes.

    A byte goes if a ``window``-byte string that covers it also starts in a document with a smaller id.
    Strings are judged on the input. ``n_spans`` counts the maximal removed runs.

    Null and empty texts, and texts shorter than a window, stay as they are. A row without an id stays
    whole and removes nothing. The id names a document: rows that repeat an id are the same document,
    never smaller than each other, and should repeat its text too. An empty table gives no rows. ``log2``
    sets the sketch's memory, 2^log2 bits for each of two rows, in every Python worker.
    """
    spec = Spec(_bytes, window, gram, False, log2)
    found = repeats.repeated_ranges(docs, id_col, text_col, spec, _by_suffix(spec))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = rows.join(found.withColumnRenamed("doc_id", "of"), F.col("doc_id").cast("long") == F.col("of"), "left")

    def work(batches):
        for batch in batches:
            kept, sizes, spans = [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges")):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                ranges = ranges.as_py()
                n = 0
                if ranges:
                    stays, n = repeats.uncovered(len(raw), ranges)
                    sizes.append(len(raw))
                    raw = np.frombuffer(raw, np.uint8)[stays].tobytes()
                else:
                    sizes.append(len(raw))
                kept.append(raw)
                spans.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_spans", "kept"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "ranges").mapInArrow(
        work, f"doc_id {kind}, n_bytes long, n_spans long, kept binary"
    )
