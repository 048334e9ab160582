"""Benchmark decontamination by greedy string tiling over tokens."""

from __future__ import annotations

import string
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.windows import rolling

SEED_TOKENS = 5
MIN_MATCH = 4
COVERAGE = 0.5
ITEMS_AT_ONCE = 50_000
_BATCH = 256
_FIRST_LENGTH = 32
_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def tokens_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates like white space."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def tile(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> np.ndarray:
    """Mask of the item's tokens that greedy string tiling matches in the document, each side used once.

    Running Karp-Rabin: windows of the search length are found by rolling hash, checked and extended over
    unmarked equal tokens; the longest are marked first. The search length falls by halves to ``min_match``,
    and rises to any match over twice as long as looked for.
    """
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)

    def windows(values: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        blocked = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(blocked[length:] == blocked[:-length])
        return at, rolling(values, length)[at]

    length = min(_FIRST_LENGTH, len(item), len(doc))
    while length >= min_match:
        found: list[tuple[int, int, int]] = []
        at_item, hash_item = windows(item, free_item, length)
        at_doc, hash_doc = windows(doc, free_doc, length)
        hits = np.flatnonzero(np.isin(hash_doc, hash_item))
        starts: dict[int, list[int]] = {}
        for p, h in zip(at_item.tolist(), hash_item.tolist()):
            starts.setdefault(h, []).append(p)
        for t, h in zip(at_doc[hits].tolist(), hash_doc[hits].tolist()):
            for p in starts[h]:
                if p and t and free_item[p - 1] and free_doc[t - 1] and item[p - 1] == doc[t - 1]:
                    continue  # the middle of a match that starts earlier
                size = 0
                while p + size < len(item) and t + size < len(doc) and free_item[p + size] and free_doc[t + size] and item[p + size] == doc[t + size]:
                    size += 1
                if size >= length:
                    found.append((-size, p, t))
        found.sort()
        if found and -found[0][0] > 2 * length:
            length = -found[0][0]
            continue
        again = False
        for size, p, t in found:
            size = -size
            if free_item[p : p + size].all() and free_doc[t : t + size].all():
                free_item[p : p + size] = False
                free_doc[t : t + size] = False
            else:
                again = True  # what is left of it may still be long enough
        if again and found:
            continue
        length = length // 2 if length > 2 * min_match else min_match if length > min_match else 0
    return ~free_item


class Items:
    """Benchmark items as token numbers, and where each run of seed tokens occurs in them."""

    def __init__(self, rows: list[tuple[object, str | None]], seed_tokens: int) -> None:
        self.ids, self.numbers, self.seed = [], {}, seed_tokens
        self.tokens: list[np.ndarray] = []
        for item_id, text in rows:
            words = tokens_of(text)
            if len(words) >= seed_tokens:
                self.ids.append(item_id)
                self.tokens.append(
                    np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.uint64)
                )
        hashes = [rolling(t, seed_tokens) for t in self.tokens]
        of = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        seeds = np.concatenate([*hashes, np.empty(0, np.uint64)])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.of = seeds[order], of[order]

    def best(self, texts: list[str | None], min_match: int) -> list[tuple[int, float]]:
        """Per text the item covered most and its coverage; (-1, 0) where no seed is shared."""
        words = [tokens_of(t) for t in texts]
        lengths = [len(w) for w in words]
        values = np.fromiter(
            (n for w in words for n in map(self.numbers.get, w, repeat(0))), np.uint64, sum(lengths)
        )
        found = [(-1, 0.0)] * len(texts)
        if len(values) < self.seed or not len(self.seeds):
            return found
        hashes = rolling(values, self.seed)
        at = np.flatnonzero(np.isin(hashes, self.seeds))
        ends = np.cumsum(lengths)
        owner = np.searchsorted(ends, at, "right")
        at, owner = at[at + self.seed <= ends[owner]], owner[at + self.seed <= ends[owner]]
        for i in np.unique(owner).tolist():
            mine = hashes[at[owner == i]]
            low, high = np.searchsorted(self.seeds, mine), np.searchsorted(self.seeds, mine, "right")
            items = {int(x) for a, b in zip(low, high) for x in self.of[a:b]}
            doc = values[ends[i] - lengths[i] : ends[i]].copy()
            doc[doc == 0] = np.uint64(len(self.numbers) + 1)  # equal to no token of an item
            for item in sorted(items):
                cover = float(tile(self.tokens[item], doc, min_match).mean())
                if cover > found[i][1]:
                    found[i] = (item, cover)
        return found


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed_tokens: int = SEED_TOKENS,
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
) -> DataFrame:
    """``doc_id, item_id, coverage, contaminated`` per input row: the benchmark item that the text covers most.

    Items that share a run of ``seed_tokens`` tokens with a text are tiled against it in tiles of ``min_match``
    tokens or more; a text is contaminated if the tiles cover ``coverage`` of an item's tokens, in whatever
    order. Items with fewer than ``seed_tokens`` tokens are never found. The benchmark is the query set: it goes
    to the tasks in blocks of a fixed number of items, each passing over all documents without a shuffle.

    Null and empty texts cover nothing; ``item_id`` is null where no seed is shared, and a tie goes to the item
    that sorts first. Null item texts are skipped, a null document id is carried along, repeated rows give repeated
    results. An empty benchmark leaves all clean; an empty table gives no rows.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).cast(kind).alias("item_id"), F.lit(0.0).alias("coverage")
    )
    context = docs.sparkSession.sparkContext

    def searched(rows: DataFrame, block: list) -> DataFrame:
        sent = context.broadcast(block)

        def work(batches):
            items = Items(sent.value, seed_tokens)
            for batch in batches:
                for low in range(0, batch.num_rows, _BATCH):
                    part = batch.slice(low, _BATCH)
                    best = items.best(part.column("text").to_pylist(), min_match)
                    old = zip(part.column("item_id").to_pylist(), part.column("coverage").to_pylist())
                    new = [(items.ids[i], c) if c > oc else (oi, oc) for (i, c), (oi, oc) in zip(best, old)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(part.column(c) for c in ("doc_id", "text")),
                            pa.array([i for i, _ in new], part.schema.field("item_id").type),
                            pa.array([c for _, c in new], pa.float64()),
                        ],
                        ["doc_id", "text", "item_id", "coverage"],
                    )

        return rows.mapInArrow(work, rows.schema)

    block: list = []
    for item in benchmark.select("item_id", F.col("text")).where("text IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        block.append((item["item_id"], item["text"]))
        if len(block) == ITEMS_AT_ONCE:
            rows, block = searched(rows, block), []
    if block:
        rows = searched(rows, block)
    return rows.select("doc_id", "item_id", "coverage", (F.col("coverage") >= coverage).alias("contaminated"))
