"""SimHash near-duplicates: tiled exact comparison of fingerprints with exclusive-or and bit counts."""

from __future__ import annotations

from itertools import product, repeat
from math import acos, log, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.llm.windows import mixed
from martloom.sources.staging import stage

SHINGLE_WORDS = 3
RADIUS = 2
TILE = 1024
SEED = 42
_QUARTERS = 4
_AT_ONCE = 1 << 18  # shingles whose bits are counted together


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """Hashes of a text's shingles in order, repeats included; none for null and wordless texts.

    A-Z is lower-cased and words end at ASCII white space, which is what ``bytes`` methods do.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    count = max(1, len(words) - shingle_words + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(min(shingle_words, len(words))))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)


def text_fingerprints(
    texts, shingle_words: int = SHINGLE_WORDS, lanes: int = 1, distinct: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (texts x lanes, uint64) and numbers of shingles; null and wordless texts get zeros.

    A bit is set if it is set in over half the hashes of the shingles. Repeats count, unless only
    ``distinct`` shingles are asked for. The first lane takes the hashes as they are, further lanes mix
    them anew.
    """
    found, sizes_of = np.zeros((len(texts), lanes), np.uint64), np.zeros(len(texts), np.int64)
    waiting: list[tuple[int, np.ndarray]] = []
    size = 0

    def settle() -> None:
        hashes = np.concatenate([h for _, h in waiting])
        starts = np.cumsum([0] + [len(h) for _, h in waiting[:-1]])
        sizes, rows = np.array([len(h) for _, h in waiting]), [i for i, _ in waiting]
        for lane in range(lanes):
            ones = np.zeros((len(waiting), 64), np.int64)
            for low in range(0, len(hashes), _AT_ONCE):  # a long text is counted piece by piece
                part = hashes[low : low + _AT_ONCE]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                first = np.searchsorted(starts, low, "right") - 1
                cuts = np.concatenate([[0], starts[(starts > low) & (starts < low + len(part))] - low])
                ones[first : first + len(cuts)] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
            packed = np.packbits(ones * 2 > sizes[:, None], axis=1, bitorder="little")
            found[rows, lane] = packed.view(np.uint64).ravel()
            hashes = mixed(hashes)
        sizes_of[rows] = sizes
        waiting.clear()

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, shingle_words)
        if not len(hashes):
            continue
        if distinct:
            hashes = np.unique(hashes)
        waiting.append((i, hashes))
        size += len(hashes)
        if size >= _AT_ONCE:
            settle()
            size = 0
    if waiting:
        settle()
    return found, sizes_of


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``: one row per input row, the fingerprint's 64 bits as a long."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                fps = text_fingerprints(part.column("text").to_pylist(), shingle_words)[0][:, 0].copy()
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, fp long")


def _half_space(radius: int) -> list[tuple[int, ...]]:
    """Differences of population counts within ``radius``, one of each opposite pair, zero included."""
    near = (d for d in product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, d)) <= radius)
    return [d for d in near if d >= (0,) * _QUARTERS]


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep each component of a bipartite comparison whole, at most one per row and column."""
    rows, cols = near.shape
    free_rows, free_cols = near.any(1), near.any(0)
    left, right = [], []
    for start in range(rows):
        if not free_rows[start]:
            continue
        free_rows[start] = False
        stack = [(0, start)]
        while stack:
            side, at = stack.pop()
            if side == 0:
                new = np.flatnonzero(near[at] & free_cols)
                free_cols[new] = False
                left += [at] * len(new)
                right += new.tolist()
            else:
                new = np.flatnonzero(near[:, at] & free_rows)
                free_rows[new] = False
                left += new.tolist()
                right += [at] * len(new)
            stack += [(1 - side, x) for x in new.tolist()]
    return np.array(left, np.int64), np.array(right, np.int64)


def compare_tiles(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles within ``radius`` bits, thinned to a spanning forest where they abound."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    left, right = np.nonzero(near)
    if len(left) > len(a) + len(b):
        left, right = _forest(near)
    return a[left], b[right]


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(u, v)``: links between distinct fingerprints ``nodes(fp)`` that differ in at most ``radius`` bits.

    Fingerprints lie in cells by the population counts of their four 16-bit quarters, and cells are cut
    into tiles of about ``tile``. Two fingerprints within the radius have counts whose differences add
    up to at most the radius, so all other pairs of tiles are skipped. The rest are compared in full.
    Where links abound within a pair of tiles, only a spanning forest of them is returned.
    """
    counts = [
        F.bit_count(F.shiftright("fp", 16 * q).bitwiseAND(F.lit(0xFFFF))).cast("int") for q in range(_QUARTERS)
    ]
    placed = nodes.select("fp", F.array(*counts).alias("cell"))
    # At most 17^4 = 83,521 cells exist, whatever the data: a proven bound for the broadcasts.
    cells = stage(
        placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("n_tiles")), "simhash-cells"
    )
    tiles = stage(
        placed.join(F.broadcast(cells), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), "n_tiles").cast("int").alias("tile"))
        .agg(F.collect_list("fp").alias("fps")),
        "simhash-tiles",
    )
    steps = F.array(*(F.array(*map(F.lit, d)) for d in _half_space(radius)))
    other = F.zip_with("cell", "step", lambda c, s: c + s)
    same = F.col("cell") == F.col("other")
    asked = (
        tiles.select("cell", "tile", F.col("fps").alias("a"), F.explode(steps).alias("step"))
        .withColumn("other", other)
        .join(F.broadcast(cells.select(F.col("cell").alias("other"), "n_tiles")), "other")
        .withColumn("first", F.when(same, F.col("tile")).otherwise(F.lit(0)))
        .select(
            "a",
            F.col("other").alias("cell"),
            F.explode(F.sequence("first", F.col("n_tiles") - 1)).alias("to"),
            (same & (F.col("to") == F.col("tile"))).alias("itself"),
        )
        .withColumnRenamed("to", "tile")
    )
    pairs = asked.join(tiles.select("cell", "tile", F.col("fps").alias("b")), ["cell", "tile"]).select("a", "b", "itself")

    def work(batches):
        for batch in batches:
            sides = []
            for name in ("a", "b"):
                column = batch.column(name)
                values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
                sides.append((values, ends))
            (av, ae), (bv, be) = sides
            us, vs = [], []
            for i in range(batch.num_rows):
                u, v = compare_tiles(av[ae[i] : ae[i + 1]], bv[be[i] : be[i + 1]], radius)
                if len(u):
                    us.append(u)
                    vs.append(v)
            if us:
                u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
                other = u != v
                yield pa.RecordBatch.from_arrays([pa.array(u[other]), pa.array(v[other])], ["u", "v"])

    return pairs.mapInArrow(work, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    shingle_words: int = SHINGLE_WORDS,
    tile: int = TILE,
) -> DataFrame:
    """``(doc_id, fp, component_id)``: one row per input row.

    Components link fingerprints that differ in at most ``radius`` bits; ``component_id`` is the
    smallest id reachable, the row itself included. Null and wordless texts share fingerprint zero.
    A row with a null id takes part like any other; a component of null ids alone has a null
    ``component_id``. Repeated rows share a fingerprint. An empty table gives no rows. All shingles of a very
    long text count, stretch by stretch.
    """
    marked = stage(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "simhash-nodes")
    roots = components(links(nodes, radius, tile)).select(F.col("vertex").alias("fp"), "root")
    rooted = stage(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-roots")
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = stage(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


LANES = 4
SIMILAR_WORDS = 5
SIMILARITY = 0.8
_SMALL = 8  # sets with fewer shingles differ in more bits than the angle between them says
_WIDER = 1.25  # 4 of 5 shingles: 3 bits in 16, the most of all small sets at 0.8
SLACK = 4.0
GROUP_TILE = 256
_TILE_SHINGLES = 1 << 20
_COLUMNS = 4096


def radius_for(similarity: float, bits: int, slack: float, small: bool = False) -> int:
    """Differing bits to expect of two shingle sets of that Jaccard similarity, and ``slack`` deviations."""
    share = acos(2 * similarity / (1 + similarity)) / pi * (_WIDER if small else 1)
    return round(bits * share + slack * sqrt(bits * share * (1 - share)))


def _wide_links(a: np.ndarray, b: np.ndarray, radius: int, first_radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of links; most pairs are settled by the first lane alone."""
    left, right = np.nonzero(np.bitwise_count(a[:, :1] ^ b[None, :, 0]) <= first_radius)
    close = np.bitwise_count(a[left] ^ b[right]).sum(axis=1, dtype=np.int64) <= radius
    left, right = left[close], right[close]
    if len(left) > len(a) + len(b):
        near = np.zeros((len(a), len(b)), bool)
        near[left, right] = True
        left, right = _forest(near)
    return left, right


def incidence(sets: list[np.ndarray], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the members of ``sets`` among the sorted ``names``, by column."""
    values, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.minimum(np.searchsorted(names, values), len(names) - 1)
    there = names[at] == values
    rows, at = rows[there], at[there]
    order = np.argsort(at, kind="stable")
    return rows[order], at[order]


def exact_jaccard(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of every pair of non-empty sets, each an array of distinct numbers."""
    common = np.intersect1d(np.concatenate(a), np.concatenate(b))
    shared = np.zeros((len(a), len(b)), np.int64)
    if len(common):
        sides = [incidence(x, common) for x in (a, b)]
        for low in range(0, len(common), _COLUMNS):
            blocks = []
            for (rows, at), sets in zip(sides, (a, b)):
                first, last = np.searchsorted(at, (low, low + _COLUMNS))
                block = np.zeros((len(sets), min(_COLUMNS, len(common) - low)), np.float32)
                block[rows[first:last], at[first:last] - low] = 1
                blocks.append(block)
            shared += (blocks[0] @ blocks[1].T).astype(np.int64)
    sizes = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])
    return shared / (sizes - shared)


def _confirmed(rows: DataFrame, groups: DataFrame, similarity: float, shingle_words: int, tile: int) -> DataFrame:
    """``(u, v)``: links between members of one of ``groups(doc_id, root)`` whose shingle sets are that similar.

    Large groups are cut into tiles, and each pair of tiles returns at most a spanning forest of its links.
    """

    def sets_of(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                sets = [np.unique(shingle_hashes(t, shingle_words)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("root"),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([x.tobytes() for x in sets], pa.binary()),
                    ],
                    ["doc_id", "root", "n", "shingles"],
                )

    chosen = rows.join(groups, "doc_id").select("doc_id", "root", "text")
    members = stage(
        chosen.mapInArrow(sets_of, "doc_id long, root long, n long, shingles binary").where("n > 0"), "similar-sets"
    )
    needed = F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n") / _TILE_SHINGLES)).cast("int")
    sizes = stage(members.groupBy("root").agg(needed.alias("n_tiles")), "similar-groups")
    tiles = stage(
        members.join(sizes, "root")
        .groupBy("root", "n_tiles", F.pmod(F.xxhash64("doc_id"), "n_tiles").cast("int").alias("tile"))
        .agg(F.collect_list(F.struct("doc_id", "shingles")).alias("members")),
        "similar-group-tiles",
    )
    asked = tiles.select(
        "root", F.col("members").alias("a"), F.explode(F.sequence("tile", F.col("n_tiles") - 1)).alias("tile")
    )
    pairs = asked.join(tiles.select("root", "tile", F.col("members").alias("b")), ["root", "tile"]).select("a", "b")

    def compare(batches):
        for batch in batches:
            us, vs = [], []
            for i in range(batch.num_rows):
                ids, sets = [], []
                for name in ("a", "b"):
                    members = batch.column(name)[i].values
                    ids.append(members.field("doc_id").to_numpy())
                    sets.append([np.frombuffer(x, np.uint64) for x in members.field("shingles").to_pylist()])
                near = exact_jaccard(*sets) >= similarity
                left, right = np.nonzero(near)
                if len(left) > sum(near.shape):
                    left, right = _forest(near)
                us.append(ids[0][left])
                vs.append(ids[1][right])
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    return pairs.mapInArrow(compare, "u long, v long")


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    shingle_words: int = SIMILAR_WORDS,
    lanes: int = LANES,
    tile: int = TILE,
    group_tile: int = GROUP_TILE,
) -> DataFrame:
    """``(doc_id, component_id)`` of documents linked to another; the smallest id of the group names it.

    Documents are linked if the sets of their shingles, as 64-bit hashes, have a Jaccard similarity of
    ``similarity`` or more; a shingle counts once, however often a text repeats it. Candidates come from
    fingerprints of ``lanes`` x 64 bits that differ in no more bits than that similarity makes one expect,
    plus ``SLACK`` deviations, which a link misses with a chance of about one in 30,000. Sets that similar
    differ in size by that factor at most, so documents lie in cells by the logarithm of their number of
    shingles, only neighbouring cells meet, tile by tile, and each pair of tiles returns at most a spanning
    forest of its candidates. The groups that these form hold every true link between candidates, so the
    sets are compared in full within each group.

    Null, empty and wordless texts and rows without an id are never linked. Repeated rows count as one. All
    shingles of a very long text count, in its fingerprint and in its set.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    radii = {small: tuple(radius_for(similarity, bits, SLACK, small) for bits in (64 * lanes, 64)) for small in (False, True)}
    small_cell = int(log(_SMALL) / log(1 / similarity))

    def work(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                fps, sizes = text_fingerprints(part.column("text").to_pylist(), shingle_words, lanes, distinct=True)
                raw = [row.tobytes() for row in fps]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(raw, pa.binary()), pa.array(sizes)], ["doc_id", "fps", "n"]
                )

    marked = rows.mapInArrow(work, "doc_id long, fps binary, n long").where("n > 0 AND doc_id IS NOT NULL")
    band = F.floor(F.log("n") / log(1 / similarity)).cast("int")
    placed = stage(marked.select("doc_id", "fps", band.alias("cell")), "similar-fingerprints")
    # Fewer than 200 cells hold any text that a string column can: a proven bound for the broadcast.
    cells = stage(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("n_tiles")), "similar-cells")
    tiles = stage(
        placed.join(F.broadcast(cells), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("doc_id"), "n_tiles").cast("int").alias("tile"))
        .agg(F.collect_list(F.struct("doc_id", "fps")).alias("members")),
        "similar-tiles",
    )
    asked = (
        tiles.select("cell", "tile", F.col("members").alias("a"), F.explode(F.array(F.lit(0), F.lit(1))).alias("step"))
        .withColumn("other", F.col("cell") + F.col("step"))
        .join(F.broadcast(cells.select(F.col("cell").alias("other"), "n_tiles")), "other")
        .withColumn("first", F.when(F.col("step") == 0, F.col("tile")).otherwise(F.lit(0)))
        .select("a", (F.col("cell") < small_cell).alias("small"), F.col("other").alias("cell"), F.explode(F.sequence("first", F.col("n_tiles") - 1)).alias("tile"))
    )
    pairs = asked.join(tiles.select("cell", "tile", F.col("members").alias("b")), ["cell", "tile"]).select("a", "b", "small")

    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, fps = [], []
                for name in ("a", "b"):
                    members = batch.column(name)[i].values
                    ids.append(members.field("doc_id").to_numpy())
                    fps.append(np.frombuffer(b"".join(members.field("fps").to_pylist()), np.uint64).reshape(-1, lanes))
                left, right = _wide_links(*fps, *radii[batch.column("small")[i].as_py()])
                u, v = ids[0][left], ids[1][right]
                yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    groups = components(pairs.mapInArrow(compare, "u long, v long")).select(F.col("vertex").alias("doc_id"), "root")
    return components(_confirmed(rows, groups, similarity, shingle_words, group_tile)).select(
        F.col("vertex").alias("doc_id"), F.col("root").alias("component_id")
    )
