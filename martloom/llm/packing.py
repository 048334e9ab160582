"""Packing of tokenized documents into fixed-length sequences by the sum-of-squares rule."""

from __future__ import annotations

import json
import os
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.sources.staging import stage

CAPACITY = 2048
POOL = 1 << 17
END_ID = 0
_WORDS = 1 << 19
_BATCH = 1024
# White space other than these four: a text that has any goes to the tokenizer as a whole.
_ODD_SPACE = {c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r"}
# Up to U+024F, but for U+0130, lower case is one character for one and nothing is ever composed. An apostrophe
# may begin a contraction and "<|" a special token, which are no plain runs.
_PLAIN = {*map(chr, range(0x250))} - {"\u0130", "'"}
# Kinds of the bytes of such texts in lower case: white space, letters, others. Characters of several bytes are
# letters, but for those that begin with C2 and these two, the signs of multiplication and division.
_KINDS = bytes(0 if c in b" \t\n\r" else 1 if c > 127 or chr(c).isalpha() else 2 for c in range(256))
_SIGNS, _SMALL_LETTERS = (0x97, 0xB7), (0xAA, 0xB5, 0xBA)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Memory:
    """A bounded store of encoded text in two generations: what was used since the last turn outlives the next."""

    def __init__(self, limit: int) -> None:
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, wanted: set) -> set:
        """What has to be encoded anew; the rest of ``wanted`` is in ``young`` afterwards."""
        if len(self.young) >= self.limit:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        unknown = wanted.difference(young)
        if old:
            known = unknown.intersection(old)
            young.update(zip(known, map(old.__getitem__, known)))
            unknown -= known
        return unknown


class Encoder:
    """Ids as little-endian 32-bit bytes; every run of letters or of other characters is encoded once and remembered.

    This holds for a tokenizer that evens out white space, lowers case, and takes runs of letters as words
    that end in a marked token: it never joins characters across white space or across the end of a run of
    letters. Texts that are not plain go piece by piece between white space, those with unusual white space
    as a whole, and so do all texts of any other tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), Memory(_WORDS)
        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        steps = [n["type"] for n in (shape.get("normalizer") or {}).get("normalizers", [])]
        cuts = (shape.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex", "")
        mark = shape["model"].get("end_of_word_suffix")
        self.by_word = bool(mark) and steps == ["NFC", "Replace", "Lowercase"] and r"|[\p{L}]+|[\p{N}]|" in cuts
        if self.by_word:
            self.ends = np.zeros(len(shape["model"]["vocab"]), bool)
            self.ends[[i for token, i in shape["model"]["vocab"].items() if token.endswith(mark)]] = True
            # The same model over words that are lower-case letters already: nothing to even out or to find.
            bytewise = shape["pre_tokenizer"]["pretokenizers"][1:]
            plain = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *bytewise]}
            self.plain = Tokenizer.from_str(json.dumps(shape | {"normalizer": None, "added_tokens": [], "pre_tokenizer": plain}))

    def _learn(self, missing: set[str | bytes]) -> None:
        """Runs of plain texts are known by their bytes, all other pieces by their text."""
        young = self.known.young
        texts = {piece: piece if isinstance(piece, str) else piece.decode() for piece in missing}
        simple = [run for run, text in texts.items() if isinstance(run, bytes) and text.isalpha()]
        parts = [simple[low : low + 1000] for low in range(0, len(simple), 1000)]
        joined = self.plain.encode_batch_fast([b" ".join(part).decode() for part in parts], add_special_tokens=False) if parts else []
        for part, found in zip(parts, joined):
            ids = np.array(found.ids, "<u4")
            raw, start = ids.tobytes(), 0
            for run, end in zip(part, ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()):
                young[run] = raw[start:end]
                start = end
        rest = list(missing.difference(simple))
        for piece, found in zip(rest, self.tokenizer.encode_batch_fast([texts[p] for p in rest], add_special_tokens=False)):
            young[piece] = array("I", found.ids).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain, split, other = {}, {}, set()
        for i, text in enumerate(texts):
            used = set(text)
            if not self.by_word or not used.isdisjoint(_ODD_SPACE):
                split[i] = [text]
            elif not used <= _PLAIN or "<|" in text:
                split[i] = text.split()
            else:
                plain[i] = text
                continue
            other.update(split[i])
        coded, first = plain_runs(list(plain.values()))
        runs = coded.dictionary.to_pylist()
        self._learn(self.known.missing(other.union(runs)))
        known = self.known.young
        found = dict(zip(plain, _spelled(list(map(known.__getitem__, runs)), coded.indices.to_numpy(), first)))
        return [found[i] if i in found else b"".join(map(known.__getitem__, split[i])) for i in range(len(texts))]


def plain_runs(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Runs of letters or of other characters of all plain texts in lower case, and where each text's runs begin."""
    lowered = [f"{text}\n".lower().encode() for text in texts] or [b"\n"]
    begins = np.cumsum([0, *map(len, lowered)])[: len(texts) + 1]
    raw = b"".join(lowered)
    data, kinds = np.frombuffer(raw, np.uint8), np.frombuffer(bytearray(raw.translate(_KINDS)), np.uint8)
    for lead, odd in ((0xC2, ~np.isin(np.arange(256), _SMALL_LETTERS)), (0xC3, np.isin(np.arange(256), _SIGNS))):
        at = np.flatnonzero(data == lead)
        at = at[odd[data[at + 1]]]
        kinds[at] = kinds[at + 1] = 2
    bounds = np.concatenate(([0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1, [len(data)]))
    real = kinds[bounds[:-1]] > 0
    starts, sizes = bounds[:-1][real], np.diff(bounds)[real]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(raw.translate(None, b" \t\n\r"))]
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), buffers)
    return runs.dictionary_encode(), np.searchsorted(starts, begins)


def _spelled(spellings: list[bytes], index: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Ids of each text: those of its runs, which are numbers of ``spellings``, one after the other."""
    ids = np.frombuffer(b"".join(spellings), "<u4")
    counts = np.fromiter(map(len, spellings), np.int64, len(spellings)) // 4
    each = counts[index]
    ends = np.concatenate(([0], np.cumsum(each)))
    places = np.repeat((np.cumsum(counts) - counts)[index] - ends[:-1], each) + np.arange(ends[-1])
    raw, cuts = ids[places].tobytes(), (4 * ends[first]).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker: what it learned serves the tasks that come later."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the pieces of every document's ids and its end id."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches):
        encode = encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for low in range(0, batch.num_rows, _BATCH):
                part = batch.slice(low, _BATCH)
                texts = [t or "" for t in part.column("text").to_pylist()]
                owner, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encode(texts)):
                    ids += end
                    total = len(ids) // 4
                    for k, at in enumerate(range(0, total, capacity)):
                        cut = ids[4 * at : 4 * (at + capacity)]
                        owner.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                columns = [part.column("doc_id").take(pa.array(owner, pa.int64()))]
                columns += [pa.array(c, t) for c, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the given order.

    Each item goes where the squared counts of open bins per gap add up to the least afterwards: into a bin
    of some gap that fits it, or a new one. Moving a bin from gap g to g - s adds 2 (n[g - s] - n[g] + 1),
    closing one 1 - 2 n[g]; opening one adds 2 n[capacity - s] + 1. Of equal choices the smallest gap wins,
    and a new bin loses.
    """
    counts = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, opened = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        rest = counts[: capacity + 1 - size]
        change = 2 * (rest - counts[size:] + 1)
        change[0] = 1 - 2 * counts[size]
        change[counts[size:] == 0] = np.iinfo(np.int64).max
        new_at = capacity - size
        at = int(change.argmin())
        if change[at] <= (2 * counts[new_at] + 1 if new_at else 0):
            gap = at + size
            bin_ = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, bin_ = capacity, opened
            opened += 1
        bins[i], offsets[i] = bin_, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            open_bins[gap - size].append(bin_)
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    pool: int = POOL,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece of a document.

    A document is its ids and an end id; only longer ones than a sequence are cut, into full pieces and a
    rest. Full pieces fill sequences of their own (negative numbers). The rest are dealt into pools of about
    ``pool`` pieces by a hash, and each pool is packed, longest piece first, by ``sum_of_squares``; a pool
    leaves a few sequences part empty, so pools should be large.

    Null and empty texts are an end id alone. A null id is carried along; repeated rows are packed each on
    their own. An empty table gives no rows. A very long text is encoded whole and only its ids are cut.
    """
    pieces = stage(token_pieces(docs, tokenizer or default_tokenizer(), id_col, text_col, capacity), "packing-pieces")
    columns = pieces.columns
    own = (-1 - F.monotonically_increasing_id()).alias("sequence_id")
    whole = pieces.where(F.col("length") == capacity).select(*columns, own, F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity)
    pools = max(1, -(-rest.count() // pool))
    dealt = rest.withColumn("pool", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(pools)))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def work(table: pa.Table) -> pa.Table:
        # The order must not depend on how rows arrived, or a recomputed task would number otherwise.
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        table = table.sort_by(order)
        bins, offsets = sum_of_squares(table.column("length").to_numpy(), capacity)
        ids = bins + (table.column("pool")[0].as_py() << 32)
        return table.select(columns).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    return whole.unionByName(dealt.groupBy("pool").applyInArrow(work, schema))
