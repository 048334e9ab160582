"""Substring deduplication on words: a count-min sketch first, then exact grouping of what may repeat."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import repeats
from martloom.llm.repeats import REMOVED, Gathered, Spec, settle, window_hashes

WINDOW = 20
GRAM = 8
LOG2 = 27


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _units(text: str | None) -> np.ndarray:
    words = _words(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _grouped(spec: Spec):
    def by_window(rows: DataFrame, sketch, contested) -> DataFrame:
        buckets = repeats.range_bucket_count(rows)

        def emit(held):
            key, one, two, doc, start = (np.concatenate(x) for x in zip(*held))
            order, first = settle((two, one), doc, start, spec.same_doc)
            gone = order[~first]
            keep = order[first]
            known = Gathered(buckets)
            known.add(doc[gone], start[gone], start[gone] + spec.window)
            # Ranges that a task finds by itself travel as one value beside the windows that others may have earlier.
            blobs = [known.blob()] if len(gone) else []
            names = np.array([xxhash.xxh64_intdigest(b) for b in blobs], np.uint64).view(np.int64)
            none = pa.nulls(len(blobs), pa.int64())
            columns = (one[keep].view(np.int64), two[keep].view(np.int64), doc[keep], start[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([key[keep].view(np.int64), names])),
                    *(pa.concat_arrays([pa.array(c, pa.int64()), none]) for c in columns),
                    pa.concat_arrays([pa.nulls(len(keep), pa.binary()), pa.array(blobs, pa.binary())]),
                ],
                ["key", "one", "two", "doc_id", "start", "ranges"],
            )

        def work(batches):
            held, size = [], 0
            for part, first, last, key, doc, shift in repeats.contested_runs(batches, spec, sketch.value, contested.value):
                one, two = window_hashes(part.values, spec.window)
                count = last - first + 1
                row = np.repeat(np.arange(len(first)), count)
                at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                # Windows of a run stay together, so that their ranges merge; those at a very frequent
                # minimizer part company: each goes where its own words say.
                to = np.where(sketch.value.very_full(key)[row], one[at], key[row])
                held.append((to, one[at], two[at], doc[row], at + shift[row]))
                size += len(at)
                if size >= 1 << 19:
                    yield from emit(held)
                    held, size = [], 0
            if size:
                yield from emit(held)

        def group(batches):
            def done(tables):
                one, two, doc, start = (
                    np.concatenate([t.column(n).to_numpy() for t in tables]) for n in ("one", "two", "doc_id", "start")
                )
                order, first = settle((two, one), doc, start, spec.same_doc)
                gone = order[~first]
                found.add(doc[gone], start[gone], start[gone] + spec.window)

            held, size, found = [], 0, Gathered(buckets)
            for batch in batches:
                for blob in batch.column("ranges").drop_null().to_pylist():
                    found.add_blob(blob)
                if found.full():
                    yield found.rows()
                batch = batch.filter(batch.column("two").is_valid())
                if not batch.num_rows:
                    continue
                if held and size >= 1 << 20:  # between two keys only
                    keys = batch.column("key").to_numpy()
                    before = held[-1].column("key")[-1].as_py()
                    cut = int(np.argmax(keys != before)) if (keys != before).any() else len(keys)
                    if cut < len(keys):
                        done([*held, batch.slice(0, cut)])
                        held, size, batch = [], 0, batch.slice(cut)
                held.append(batch)
                size += batch.num_rows
            if held:
                done(held)
            if found.size:
                yield found.rows()

        met = rows.mapInArrow(work, "key long, one long, two long, doc_id long, start long, ranges binary")
        return met.repartition("key").sortWithinPartitions("key").mapInArrow(group, REMOVED)

    return by_window


def remove_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, log2: int = LOG2
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: one row per input row; ``kept`` holds the words left, space-joined.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window`` words that
    covers it also starts earlier: in a document with a smaller id, or before it in the same one. Windows
    are judged on the input, and are equal if two independent 64-bit hashes of their word hashes are.

    Null, empty and short texts only have their white space evened out. A row without an id stays whole and
    removes nothing. Rows that repeat an id are the same document and should repeat its text; none is
    earlier than the other. An empty table gives no rows. ``log2`` sets the sketch's memory, 2^log2
    bits for each of two rows, in every Python worker.
    """
    spec = Spec(_units, window, gram, True, log2)
    found = repeats.repeated_ranges(docs, id_col, text_col, spec, _grouped(spec))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = rows.join(found.withColumnRenamed("doc_id", "of"), F.col("doc_id").cast("long") == F.col("of"), "left")

    def work(batches):
        for batch in batches:
            kept, sizes, lost = [], [], []
            for text, ranges in zip(batch.column("text"), batch.column("ranges")):
                words = _words(text.as_py())
                ranges = ranges.as_py()
                sizes.append(len(words))
                if ranges:
                    stays, _ = repeats.uncovered(len(words), ranges)
                    words = [words[i] for i in np.flatnonzero(stays)]
                lost.append(sizes[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "ranges").mapInArrow(
        work, f"doc_id {kind}, n_words long, n_removed long, kept string"
    )
