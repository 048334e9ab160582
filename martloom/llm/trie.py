"""Prefix trie of conversations: ROLLUP over turn-id columns, long conversations in further blocks of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.digests import joined_numbers, joined_sha256
from martloom.operators.keys import with_dense_key
from martloom.sources.staging import new_folder, stage

HEAD, WIDE = 8, 32  # turns in the first block of columns and in each later one
ID_BYTES = 16
WORD = r"[^\x20\x09-\x0D]+"
LENT, EVERY = 4, 20
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, id, words`` of every turn, and ``conv_id, n`` of every conversation, both stored.

    Turns of a conversation are numbered from 1 by ``turn`` (null first), ties by role and then by the
    turn's id, which is a hash of 128 bits over role and text. Null roles and texts are empty; rows without a
    ``conv_id`` belong to no conversation and are left out. Numbers come from ranges over all rows, so no
    conversation is numbered by a single task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.unhex(F.left(F.sha2(said, 256), F.lit(2 * ID_BYTES))).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    ).where("conv_id is not null")
    # The last key tells rows apart that are equal in all else, so that no number of them shares a range.
    placed = with_dense_key(rows, "at", ["conv_id", "turn", "role", "id", "row"], "long")
    sizes = stage(placed.groupBy("conv_id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "trie-sizes")
    pos = (F.col("at") - F.col("first") + 1).alias("pos")
    turns = placed.join(sizes.select("conv_id", "first"), "conv_id").select("conv_id", pos, "id", "words")
    return stage(turns, "trie-turns"), sizes.select("conv_id", "n")


def with_lent_starts(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of conversation c - c % 20.

    h is the unsigned crc32 of c's decimal text modulo 4. Of a shorter lender all turns are taken, of an
    absent one none; c's own turns follow from the one after its first h.
    """
    wanted = F.crc32(F.col("conv_id").cast("string")) % LENT
    lender = F.col("conv_id") - F.col("conv_id") % EVERY
    of_lender = sizes.select(F.col("conv_id").alias("lender"), F.col("n").alias("has"))
    plan = stage(
        sizes.select("conv_id", lender.alias("lender"), wanted.alias("h"))
        .join(of_lender, "lender", "left")
        .select("conv_id", "lender", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("lent")),
        "trie-lent",
    )
    starts = turns.where(F.col("pos") < LENT).withColumnRenamed("conv_id", "lender")
    taken = starts.join(plan.where("lent > 0"), "lender").where("pos <= lent").select(*turns.columns)
    short = plan.where("lent < h").select("conv_id", (F.col("h") - F.col("lent")).alias("short"))
    own = turns.where(F.col("pos") > wanted).join(short, "conv_id", "left")
    return taken.unionByName(own.withColumn("pos", F.col("pos") - F.coalesce("short", F.lit(0))).select(*turns.columns))


def _path(ids: list[Column]) -> Column:
    return F.concat(*[F.coalesce(i, F.lit(bytearray())) for i in ids])


def _level(width: int) -> str:
    """Turn columns that a row of the roll-up is grouped by; the others count as bits of ``grouping_id``."""
    return f"{width} - bit_count(grouping_id())"


def _nodes(live: DataFrame, start: int, width: int) -> DataFrame:
    """Nodes that ``live`` conversations pass within one block of columns, with parents and children there.

    ``live(conv_id, node, n, t)``: the smallest member of the node that the block starts from, the length, the
    block's turns. A node has a path, the ids from there on. Rolled-up rows that end in a missing turn are of
    conversations that ended before, and no nodes.
    """
    names = [f"t{k}" for k in range(width)]
    wide = live.select("conv_id", "node", "n", *[F.get("t", F.lit(k)).alias(name) for k, name in enumerate(names)])
    turns = ", ".join(names)
    rolled = live.sparkSession.sql(
        f"""SELECT node, {_level(width)} AS level, {turns}, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS longest
            FROM {{wide}} GROUP BY node, ROLLUP ({turns})""",
        wide=wide,
    )
    found = rolled.select(
        "node",
        "level",
        _path([F.col(name)["id"] for name in names]).alias("path"),
        "conv_id",
        "n_convs",
        F.coalesce(*[F.col(name)["words"] for name in reversed(names)], F.lit(0).cast("long")).alias("words"),
        (F.col("longest") == start + F.col("level")).cast("long").alias("leaf"),
    ).where(F.octet_length("path") == ID_BYTES * F.col("level"))
    nodes = stage(found if start == 0 else found.where("level > 0"), "trie-nodes")
    # The parent of a block's first turn is the node that the block starts from.
    above = F.expr(f"substring(path, 1, {ID_BYTES} * (level - 1))")
    child = nodes.where("level > 0").select("node", above.alias("path"))
    children = child.groupBy("node", "path").agg(F.count(F.lit(1)).alias("children"))
    parents = nodes.select("node", F.col("path").alias("above"), F.col("conv_id").alias("parent"))
    # A node with very many children makes a hot key on the left; the join may split it.
    met = nodes.withColumn("above", F.when(F.col("level") > 1, above)).join(parents, ["node", "above"], "left")
    parent = F.when(F.col("level") == 1, F.col("node")).otherwise(F.col("parent")).alias("parent")
    kept = stage(met.select(*nodes.columns, parent), "trie-parents")
    return stage(kept.join(children, ["node", "path"], "left"), "trie-block")


def _with_subtrees(nodes: DataFrame, below: DataFrame | None, start: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the result for one block, and what its subtrees hold for the nodes that the block starts from.

    Each node is rolled up once more, into all that it descends from. ``below`` has what later blocks hold
    under the last turn of this one.
    """
    rows = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
    if below is not None:
        later = below.withColumn("level", F.lit(width))
        rows = rows.join(later, ["conv_id", "level"], "left").withColumns(
            {
                "saved": F.col("saved") + F.coalesce("saved_below", F.lit(0)),
                "leaf": F.col("leaf") + F.coalesce("leaves_below", F.lit(0)),
                "children": F.coalesce("children", "children_below"),
            }
        )
        rows = stage(rows.select(*nodes.columns, "saved"), "trie-carried")
    names = [f"p{k}" for k in range(width)]
    ids = [
        F.when(F.col("level") > k, F.expr(f"substring(path, {ID_BYTES * k + 1}, {ID_BYTES})")).alias(name)
        for k, name in enumerate(names)
    ]
    turns = ", ".join(names)
    rolled = nodes.sparkSession.sql(
        f"""SELECT node, {_level(width)} AS level, {turns}, min(conv_id) AS conv_id, sum(leaf) AS n_leaves,
                   sum(saved) AS saved_tokens, count_if(of_level = 1) AS firsts
            FROM {{wide}} GROUP BY node, ROLLUP ({turns})""",
        wide=rows.select("node", "conv_id", "leaf", "saved", F.col("level").alias("of_level"), *ids),
    )
    real = F.octet_length(_path([F.col(name) for name in names])) == ID_BYTES * F.col("level")
    totals = stage(rolled.where(real).drop(*names), "trie-subtrees")
    held = totals.where("level = 0").select(
        F.col("node").alias("conv_id"),
        F.col("n_leaves").alias("leaves_below"),
        F.col("saved_tokens").alias("saved_below"),
        F.col("firsts").alias("children_below"),
    )
    result = rows.join(totals.select("conv_id", "level", "n_leaves", "saved_tokens"), ["conv_id", "level"]).select(
        "conv_id",
        (F.lit(start) + F.col("level")).cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
    )
    return result, held


def prefix_trie(turns: DataFrame, members: DataFrame, head: int = HEAD, wide: int = WIDE) -> DataFrame:
    """One row per node of the trie over all conversations: columns as in ``NODE``.

    ``turns(conv_id, pos, id, words)``: turns numbered from 1 without gaps, equal ids for equal turns.
    ``members(conv_id)``: all conversations, each once, those without turns included. A node at depth d is a
    distinct sequence of d turns, known by its depth and its smallest member. ``n_children`` counts the nodes
    right below; ``n_leaves`` the childless nodes in its subtree, itself included; ``saved_tokens`` sums
    (n_convs - 1) * words over its subtree; ``ends_sha256`` is the hash of the ids of the conversations that
    end there, ascending and comma-joined.

    The first ``head`` turns of all conversations are rolled up at once: every conversation becomes a row per
    prefix, and equal prefixes merge in the task before they are shuffled. Conversations that go on are rolled
    up by the next ``wide`` turns, grouped by the node reached, and so on; subtree sums then flow back block by
    block. Rounds grow with the longest conversation, their size with the conversations that are left.
    A node that very many conversations share is a hot key in joins only, which may be split.

    Very long texts are ids and counts here. Without conversations there are no rows.
    """
    sized = stage(
        members.select("conv_id").join(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conv_id", "left").fillna(0, "n"),
        "trie-members",
    )
    smallest, longest = sized.agg(F.min("conv_id"), F.max("n")).first()
    if smallest is None:
        return turns.sparkSession.createDataFrame([], NODE)
    block = F.when(F.col("pos") <= head, 0).otherwise(F.floor((F.col("pos") - head - 1) / wide) + 1).alias("block")
    listed = F.array_sort(F.collect_list(F.struct("pos", "id", "words")))
    cells = F.transform(listed, lambda t: F.struct(t["id"], t["words"])).alias("t")
    blocks = turns.select("*", block).groupBy("conv_id", "block").agg(cells)
    blocks = stage(blocks.repartitionByRange("block", "conv_id").sortWithinPartitions("block"), "trie-blocks")
    # The root is known by the smallest of all conversations, as any node.
    live = sized.select("conv_id", F.lit(smallest).cast("long").alias("node"), "n")
    # Blocks add to one stored table of ends and one of nodes: plans do not grow with the number of blocks.
    spark = turns.sparkSession
    ends, done = new_folder(spark, "trie-ended"), new_folder(spark, "trie-result")
    found, start = [], 0
    while start == 0 or start < longest:
        width = head if start == 0 else wide
        here = blocks.where(F.col("block") == len(found)).drop("block")
        live = stage(live.join(here, "conv_id", "left"), "trie-live")
        nodes = _nodes(live, start, width)
        path = _path([F.get("t", F.lit(k))["id"] for k in range(width)]).alias("path")
        reached = nodes.select("node", "path", F.col("conv_id").alias("at"))
        met = stage(live.select("conv_id", "node", "n", path).join(reached, ["node", "path"]), "trie-reached")
        found.append((nodes, start, width))
        start += width
        ended = met.where(F.col("n") <= start).select(F.col("at").alias("conv_id"), F.col("n").alias("depth"), F.col("conv_id").alias("member"))
        ended.write.mode("append").parquet(ends)
        live = met.where(F.col("n") > start).select("conv_id", F.col("at").alias("node"), "n")
    below = None
    for nodes, start, width in reversed(found):
        rows, below = _with_subtrees(nodes, below, start, width)
        rows.write.mode("append").parquet(done)
    result = spark.read.schema(rows.schema).parquet(done)
    parts = joined_numbers(spark.read.schema(ended.schema).parquet(ends), ["conv_id", "depth"], "member")
    hashes = stage(joined_sha256(parts, ["conv_id", "depth"], ["first"], "joined", ","), "trie-ends")
    none = F.sha2(F.lit(""), 256)
    return result.join(hashes, ["conv_id", "depth"], "left").select(
        *result.columns, F.coalesce("sha256", none).alias("ends_sha256")
    )
