"""Hashes of texts that are joined from many rows, without ever holding such a text."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def joined_numbers(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``keys, first, joined``: the numbers of a key in ascending order as comma-joined text, in one or more parts.

    Rows are ordered by ranges of key and number, so a key with very many rows is spread over many tasks.
    Keys and numbers are 64-bit integers without nulls, no number twice under a key.
    """

    def work(batches):
        for batch in batches:
            owners = [batch.column(k).to_numpy() for k in keys]
            numbers = batch.column(number).to_numpy()
            changed = np.zeros(len(numbers), bool)
            changed[:1] = True
            for c in owners:
                changed[1:] |= c[1:] != c[:-1]
            low = np.flatnonzero(changed)
            high = np.append(low[1:], len(numbers))
            texts = [",".join(map(str, numbers[a:b].tolist())) for a, b in zip(low.tolist(), high.tolist())]
            columns = [pa.array(c[low]) for c in [*owners, numbers]] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "first", "joined"])

    schema = ", ".join(f"{k} long" for k in [*keys, "first"]) + ", joined string"
    return rows.select(*keys, number).repartitionByRange(*keys, number).sortWithinPartitions(*keys, number).mapInArrow(work, schema)


def joined_sha256(parts: DataFrame, keys: list[str], order: list[str], text: str, separator: str) -> DataFrame:
    """``keys, sha256``: hash of the texts of a key in the given order, with ``separator`` between them.

    The hash of a text can only be taken from its start to its end, so the parts of a key pass one task, one
    at a time; callers join rows to larger parts beforehand. Nothing but the state of a hash is held.
    """
    fields = [parts.schema[k] for k in keys]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sha256 string"
    between = separator.encode()

    def work(batches):
        now, state, done, types = None, None, [], None

        def flush():
            columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, [*keys, "sha256"])

        for batch in batches:
            types = [*(batch.column(k).type for k in keys), pa.string()]
            owners = zip(*(batch.column(k).to_pylist() for k in keys))
            for owner, part in zip(owners, batch.column(text).to_pylist()):
                if state is None or owner != now:
                    if state is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = owner, hashlib.sha256()
                else:
                    state.update(between)
                state.update(part.encode())
            if done:
                yield flush()
        if state is not None:
            done.append((*now, state.hexdigest()))
            yield flush()

    ordered = parts.select(*keys, *order, text).repartition(*keys).sortWithinPartitions(*keys, *order)
    return ordered.mapInArrow(work, schema)
