"""Byte-level BPE ids by content-defined chunks: what documents share is encoded once, joins are repaired.

A rolling hash cuts texts where their content says so, so that equal passages give equal chunks wherever they
are. Chunks that occur again are encoded once each and met by key; what lies between them is encoded in
place. Ids on both sides of a join may differ from those of the whole text, so the text around it is encoded
anew, wider and wider, until its words agree with those of the next chunk.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.sources.staging import stage

CUT_BITS = 10  # a cut about every 2^10 bytes beyond the least length
LEAST, MOST = 512, 8192
RUN = 1 << 20  # bytes encoded in one call at most, but for a single chunk
LOG2_MARKS = 26
_WINDOW = (1, 2, 4, 8, 16)  # the rolling hash sees 32 bytes
_GEAR = np.random.default_rng(13).integers(0, 1 << 64, 256, np.uint64)
_FIRST = np.uint32(1 << 31)  # marks the first id of a word
_IDS = np.uint32((1 << 31) - 1)
_BATCH = 1 << 20
_LONG = 400  # characters; longer words and runs of white space go to the tokenizer itself
# Where kinds of characters are the same in every version of Unicode, and no special token can begin.
_NOT_PLAIN = re.compile(rf"[^\x00-\u024f]|<\||\s{{{_LONG}}}")
# Fixed value: the words of the byte-level pattern.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BUCKET = 1 << 15  # bits in a row of Spark's bitmap aggregate


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text, each at the start of a character; an empty text has none."""
    size = len(raw)
    if size <= LEAST:
        return [size] if size else []
    data = np.frombuffer(raw, np.uint8)
    rolled = _GEAR[data]
    for step in _WINDOW:
        wider = rolled.copy()
        wider[step:] += rolled[:-step] << np.uint64(step)
        rolled = wider
    found, last = [], 0

    def cut(at: int) -> int:
        while at < size and raw[at] & 0xC0 == 0x80:
            at += 1
        if at < size:
            found.append(at)
        return at

    for at in (np.flatnonzero(rolled >> np.uint64(64 - CUT_BITS) == 0) + 1).tolist() + [size]:
        while at - last > MOST:
            last = cut(last + MOST)
        if at - last >= LEAST and at < size:
            last = cut(at)
    return [*found, size]


def chunks(raw: bytes) -> Iterator[bytes]:
    start = 0
    for end in chunk_ends(raw):
        yield raw[start:end]
        start = end


class Codec:
    """A byte-level tokenizer; records are its ids with a mark on the first id of each of its words.

    Words are what its pattern and its special tokens make of a text; pairs merge within words only. Where a
    word begins depends on the text from there on and on at most ``reach`` bytes behind it.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        if shape.get("normalizer") or (shape.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("A byte-level tokenizer that leaves the text as it is was expected")
        if shape["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("A tokenizer that puts a blank before a text cannot be applied in chunks")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = {t["id"]: t["content"].encode() for t in shape["added_tokens"]}
        self.reach = 16 + max(map(len, special.values()), default=0)
        # Bytes that stand for themselves in the vocabulary; the others follow from U+0100 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
        self.text_of = [b""] * (1 + max([*shape["model"]["vocab"].values(), *special]))
        for token, i in shape["model"]["vocab"].items():
            self.text_of[i] = bytes(byte_of[c] for c in token)
        for i, content in special.items():
            self.text_of[i] = content
        self.size_of = np.array([len(t) for t in self.text_of])
        self.quick = self._quick_engine(shape)

    def _quick_engine(self, shape: dict):
        """A quicker engine over the same vocabulary, or None where it might merge otherwise.

        It merges neighbours whose joined text has the least id, whatever pair made that token. That is the same
        if ids follow the order of merges and every token's own text is merged to it: between two boundaries
        that hold, merges are those of the text between them, and they end in the pair that made the token.
        """
        import tiktoken

        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in shape["model"]["merges"]]
        vocabulary, alone = shape["model"]["vocab"], len(shape["model"]["vocab"]) - len(merges)
        in_order = all(vocabulary.get(a + b) == alone + i for i, (a, b) in enumerate(merges))
        special = all(t["content"].startswith("<|") for t in shape["added_tokens"])
        if not (in_order and special and shape["pre_tokenizer"].get("use_regex", True)) or shape["model"].get("dropout"):
            return None
        place = {pair: i for i, pair in enumerate(merges)}
        texts = []
        for token, i in vocabulary.items():
            try:
                texts.append((i, self.text_of[i].decode()))
            except UnicodeDecodeError:  # a part of a character: no text that the tokenizer could be given
                parts = list(token)
                while len(parts) > 1:
                    at = min(range(len(parts) - 1), key=lambda k: place.get((parts[k], parts[k + 1]), len(merges)))
                    if (parts[at], parts[at + 1]) not in place:
                        return None
                    parts[at : at + 2] = [parts[at] + parts[at + 1]]
        found = self.tokenizer.encode_batch_fast([t for _, t in texts], add_special_tokens=False)
        if any(one.ids != [i] for (i, _), one in zip(texts, found)):
            return None
        ranks = {self.text_of[i]: i for i in vocabulary.values()}
        return tiktoken.Encoding("quick", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts, without marks."""
        spoken = [t.decode() for t in texts]
        plain = [
            self.quick is not None and not _NOT_PLAIN.search(t) and max(map(len, t.split()), default=0) < _LONG
            for t in spoken
        ]
        others = iter(
            self.tokenizer.encode_batch_fast([t for t, p in zip(spoken, plain) if not p], add_special_tokens=False)
        )
        return [np.array(self.quick.encode_ordinary(t) if p else next(others).ids, np.uint32) for t, p in zip(spoken, plain)]

    def records(self, texts: list[bytes]) -> list[np.ndarray]:
        found = []
        for one in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False):
            ids = np.array(one.ids, np.uint32)
            ids[np.diff(np.array(one.word_ids, np.int64), prepend=-1) != 0] |= _FIRST
            found.append(ids)
        return found

    def decode(self, record: np.ndarray) -> bytes:
        return b"".join(map(self.text_of.__getitem__, (record & _IDS).tolist()))

    def starts(self, record: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Places of words in the record, their places in the text, the length of the text."""
        ends = np.cumsum(self.size_of[record & _IDS])
        at = np.flatnonzero(record & _FIRST)
        return at, np.where(at > 0, ends[at - 1], 0), int(ends[-1]) if len(ends) else 0


class Joiner:
    """Ids of a text from the records of its parts in order, handed to ``out`` as soon as they are certain."""

    def __init__(self, codec: Codec, out: Callable[[np.ndarray], None]) -> None:
        self.codec, self.out, self.held = codec, out, None

    def feed(self, record: np.ndarray) -> None:
        if not len(record):
            return
        if self.held is not None and len(self.held):
            record = self._repaired(self.held, record)
        # Words that begin too near to the end may turn out otherwise once the text goes on.
        at, place, size = self.codec.starts(record)
        certain = at[place <= size - self.codec.reach]
        cut = int(certain[-1]) if len(certain) else 0
        if cut:
            self.out(record[:cut])
        self.held = record[cut:]

    def _repaired(self, held: np.ndarray, record: np.ndarray) -> np.ndarray:
        """What goes on from a word that both the text around the join and the next part have."""
        left, n = self.codec.decode(held), 32
        at, place, _ = self.codec.starts(record)
        while True:
            # A character cut at the end of the window is left out.
            window = (left + self.codec.decode(record[:n])).decode("utf-8", "ignore").encode()
            around = self.codec.records([window])[0]
            w_at, w_place, w_size = self.codec.starts(around)
            sure = (w_place >= len(left)) & (w_place <= w_size - self.codec.reach)
            _, mine, theirs = np.intersect1d(w_place[sure], place + len(left), assume_unique=True, return_indices=True)
            if len(mine):
                self.out(around[: int(w_at[sure][mine[0]])])
                return record[int(at[theirs[0]]) :]
            if n >= len(record):
                return around
            n *= 4

    def finish(self) -> None:
        if self.held is not None and len(self.held):
            self.out(self.held)
        self.held = None


@cache
def codec(path: str) -> Codec:
    """One per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Codec(path)


class Digest:
    """Count of ids, hash of the ids, hash of the decoded text."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.n, self.ids, self.decoded = codec, 0, hashlib.sha256(), hashlib.sha256()

    def add(self, record: np.ndarray) -> None:
        self.n += len(record)
        self.ids.update((record & _IDS).astype("<u4").tobytes())
        self.decoded.update(self.codec.decode(record))

    def row(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def _key(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _mark(key: bytes, log2: int) -> int:
    return int.from_bytes(key[:8], "little") >> (64 - log2)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about a MB of text, or of a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // _BATCH
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if high > low:
                yield batch.slice(low, high - low)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def recurring(rows: DataFrame, log2: int) -> bytes:
    """A bit for each of 2^``log2`` hash values: set where a chunk with that value occurs again.

    Only hashes are shuffled, counted beforehand by each task; the bits that reach the driver are as many
    at any size of the data. A bit set for want of space costs a detour, never a wrong id.
    """

    def work(batches):
        for batch in _slices(batches):
            keys = [_mark(_key(c), 63) for raw in _texts(batch) for c in chunks(raw)]
            values, counts = np.unique(np.array(keys, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["h", "n"])

    counted = rows.select("text").mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    bit = (F.shiftright("h", 63 - log2) + 1).alias("bit")
    again = counted.where("n > 1").select(bit)
    maps = again.groupBy(F.bitmap_bucket_number("bit").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    found = bytearray(1 << max(log2 - 3, 12))
    for b, bits in maps.collect():
        low = (b - 1) * (_BUCKET >> 3)
        found[low : low + len(bits)] = bits
    return bytes(found)


PARTS = (
    "doc_id {kind}, row long, k int, key binary, text binary, ids binary, "
    "n_tokens long, ids_sha256 string, decoded_sha256 string"
)


def _parts(tokenizer: str, marked, log2: int, kind: str):
    """Documents without recurring chunks are settled at once (``k`` null); of others each part is a row."""
    names = [c.split()[0] for c in PARTS.split(", ")]

    def work(batches):
        codes, marks, sent = codec(tokenizer), marked.value, set()

        def again(key: bytes) -> bool:
            bit = _mark(key, log2)
            return bool(marks[bit >> 3] >> (bit & 7) & 1)

        for batch in _slices(batches):
            columns = {n: [] for n in names}
            wholes, whole_at, runs, run_at = [], [], [], []

            def put(i, k=None, key=None, text=None):
                for n, v in zip(names, (i, at[i], k, key, text, None, None, None, None)):
                    columns[n].append(v)
                return len(columns["k"]) - 1

            at = batch.column("row").to_pylist()
            for i, raw in enumerate(_texts(batch)):
                pieces, run = [], []
                for piece in chunks(raw):
                    key = _key(piece)
                    if again(key):
                        if run:
                            pieces.append((None, b"".join(run)))
                        pieces.append((key, piece))
                        run = []
                    else:
                        if run and sum(map(len, run)) + len(piece) > RUN:
                            pieces.append((None, b"".join(run)))
                            run = []
                        run.append(piece)
                if run:
                    pieces.append((None, b"".join(run)))
                if len(pieces) < 2 and (not pieces or pieces[0][0] is None):
                    wholes.append(raw)
                    whole_at.append(put(i))
                    continue
                for k, (key, text) in enumerate(pieces):
                    if key is None:
                        runs.append(text)
                        run_at.append(put(i, k))
                    else:
                        put(i, k, key, None if key in sent else text)
                        sent.add(key)
            for place, ids in zip(whole_at, codes.ids(wholes)):
                digest = Digest(codes)
                digest.add(ids)
                for n, v in zip(names[-3:], digest.row()):
                    columns[n][place] = v
            for place, record in zip(run_at, codes.records(runs)):
                columns["ids"][place] = record.tobytes()
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string()]
            ids = batch.column("doc_id").take(pa.array(columns["doc_id"], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(columns[n], t) for n, t in zip(names[1:], kinds))], names)

    return work, PARTS.format(kind=kind)


def _encode_chunks(tokenizer: str):
    def work(batches):
        for batch in _slices(batches):
            found = [r.tobytes() for r in codec(tokenizer).records(_texts(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.binary())], ["key", "ids"])

    return work


def _assemble(tokenizer: str):
    """Sorted parts to one row per document; ids are hashed as they become certain, so none are kept."""

    def work(batches):
        codes, now, digest, joiner, done = codec(tokenizer), None, None, None, []

        def close():
            joiner.finish()
            done.append((*now, *digest.row()))

        def flush():
            owners = pa.array([d[0] for d in done], kind)
            rest = [pa.array(c, t) for c, t in zip([*zip(*[d[2:] for d in done])], (pa.int64(), pa.string(), pa.string()))]
            done.clear()
            return pa.RecordBatch.from_arrays([owners, *rest], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            for owner, row, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "ids"))):
                if now is None or now[1] != row:
                    if now is not None:
                        close()
                    now, digest = (owner, row), Digest(codes)
                    joiner = Joiner(codes, digest.add)
                joiner.feed(np.frombuffer(ids, np.uint32))
            if done:
                yield flush()
        if now is not None:
            close()
            yield flush()

    return work


def encode(
    docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", log2: int = LOG2_MARKS
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: one row per document.

    ``ids_sha256`` is the hash of the ids as little-endian unsigned 32-bit integers, exactly those that the
    tokenizer gives for the whole text without added special tokens; ``decoded_sha256`` that of the text that
    these ids stand for. Strings of special tokens in a text become these tokens.

    Three steps: hashes of all chunks are counted; documents without a recurring chunk are settled in place;
    of the others, each distinct recurring chunk is encoded once, comes back by a join on its key, and the
    parts of a document pass a task in order, one at a time. The join may be split where a chunk is in very
    many documents. A chunk is known by a hash of 128 bits.

    Null and empty texts have no ids. Very long texts are cut into parts of at most ``RUN`` bytes, so no text
    is encoded in one call beyond that but a single word. Rows that repeat, ids that repeat and null ids are
    told apart by their place in the input. An empty table gives no rows. Other columns are never looked at.
    """
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = spark.sparkContext.broadcast(recurring(rows, log2))
    work, schema = _parts(path, marked, log2, rows.schema["doc_id"].dataType.simpleString())
    parts = stage(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(work, schema), "bpe-parts")
    settled = parts.where("k is null").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    once = parts.where("text is not null").select("key", "text").dropDuplicates(["key"])
    known = stage(once.mapInArrow(_encode_chunks(path), "key binary, ids binary"), "bpe-chunks")
    met = parts.where("key is not null").select("doc_id", "row", "k", "key").join(known, "key").drop("key")
    records = met.unionByName(parts.where("ids is not null").select("doc_id", "row", "k", "ids"))
    ordered = records.repartition("row").sortWithinPartitions("row", "k")
    return settled.unionByName(ordered.mapInArrow(_assemble(path), settled.schema))
