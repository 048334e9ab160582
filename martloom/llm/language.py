"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
DIMENSIONS = 1024
TRAIN_PER_LANGUAGE = 2000
SEED = 7
_SYMBOLS = 64  # boundary, a to z, and 37 classes that other letters fall into by code point
_TABLE = 0x3000
_BATCH = 64
_LONGEST = 1 << 20  # characters turned into trigrams at once


def _symbol_table() -> np.ndarray:
    table = np.zeros(_TABLE, np.uint32)
    for code in range(_TABLE):
        if chr(code).isalpha():
            table[code] = code - 96 if 97 <= code <= 122 else 27 + code % 37
    return table


class Profiles:
    """Document vectors: trigrams bind permuted letter vectors, a document bundles its trigrams."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.table = _symbol_table()
        letters = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (_SYMBOLS, dimensions))
        self.by_place = [np.roll(letters, shift, axis=1) for shift in (2, 1, 0)]

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.table[np.minimum(codes, _TABLE - 1)]
        high = codes >= _TABLE
        if high.any():
            letters = np.array([chr(c).isalpha() for c in codes[high].tolist()])
            found[high] = np.where(letters, 27 + codes[high] % 37, 0)
        return found

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams over letters and single boundaries, with their counts; none if there is no letter."""
        parts, size = [], _LONGEST
        for low in range(0, len(text), size):
            parts.append(self.symbols(text[low : low + size]))
        found = np.concatenate([np.zeros(1, np.uint32), *parts, np.zeros(1, np.uint32)])
        if not found.any():
            return found[:0], found[:0]
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
        s = found[keep]
        s = s if len(s) > 2 else np.append(s, np.uint32(0))
        return np.unique((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], return_counts=True)

    def vectors(self, texts: list[str | None]) -> np.ndarray:
        """One row per text, scaled to length one; zero where there is no letter."""
        counted = [self.counts(t) if t else (np.empty(0, np.uint32),) * 2 for t in texts]
        grams = np.unique(np.concatenate([g for g, _ in counted]))
        first, second, third = self.by_place
        bound = first[grams // _SYMBOLS**2] * second[grams // _SYMBOLS % _SYMBOLS] * third[grams % _SYMBOLS]
        weights = np.zeros((len(texts), len(grams)), np.float32)
        for i, (g, c) in enumerate(counted):
            weights[i, np.searchsorted(grams, g)] = c
        found = weights @ bound.astype(np.float32)
        lengths = np.linalg.norm(found, axis=1, keepdims=True)
        return np.divide(found, lengths, out=np.zeros_like(found), where=lengths > 0)


def held_out(doc_id: Column) -> Column:
    """One row in five, by id: never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = TRAIN_PER_LANGUAGE
) -> dict[str, np.ndarray]:
    """Prototypes: per language the bundle of about ``per_language`` documents, chosen by a hash of the id.

    Rows without text or language are not learned from. Languages are few; each costs one vector here.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    share = {r["lang"]: min(1.0, per_language / r["count"]) for r in rows.groupBy("lang").count().collect()}
    if not share:
        return {}
    wanted = F.lit(0)
    for lang, part in share.items():
        wanted = F.when(F.col("lang") == lang, int(part * 1_000_000)).otherwise(wanted)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1_000_000)) < wanted)

    def bundle(batches):
        profiles, sums = Profiles(), {}
        for batch in batches:
            for low in range(0, batch.num_rows, _BATCH):
                part = batch.slice(low, _BATCH)
                vectors = profiles.vectors(part.column("text").to_pylist())
                for lang, vector in zip(part.column("lang").to_pylist(), vectors.astype(np.float64)):
                    sums[lang] = sums.get(lang, 0) + vector
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["lang", "sums"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.float64) for v in table.column("sums").to_pylist())
        return pa.table({"lang": table.column("lang").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "lang string, sums binary"
    sums = chosen.mapInArrow(bundle, schema).groupBy("lang").applyInArrow(add, schema).collect()
    found = {r["lang"]: np.frombuffer(r["sums"], np.float64) for r in sums}
    return {k: (v / max(np.linalg.norm(v), 1e-12)).astype(np.float32) for k, v in sorted(found.items())}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` per input row: the nearest prototype and its cosine, cut at 0.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. A tie goes to the first
    language by name. A null id is carried along, repeated rows give repeated results, an empty
    table gives no rows. Only the text is looked at. A very long text counts whole, stretch by stretch.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = [*prototypes, UNKNOWN]
    matrix = np.stack([*prototypes.values()]) if prototypes else None

    def work(batches):
        profiles = Profiles()
        for batch in batches:
            for low in range(0, batch.num_rows, _BATCH):
                part = batch.slice(low, _BATCH)
                vectors = profiles.vectors(part.column("text").to_pylist())
                best, score = np.full(len(vectors), len(names) - 1), np.zeros(len(vectors))
                if matrix is not None:
                    cosines = vectors @ matrix.T
                    some = vectors.any(axis=1)
                    best[some] = cosines[some].argmax(axis=1)
                    score[some] = np.clip(cosines[some].max(axis=1), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names).take(pa.array(best)), pa.array(score)], ["doc_id", "lang_pred", "score"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, lang_pred string, score double")
