"""Repair of conversations: a generalised LR parser over the role grammar whose actions may edit, at a cost."""

from __future__ import annotations

from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.digests import joined_sha256
from martloom.operators.keys import with_dense_key
from martloom.sources.staging import stage

# Roles by their initials: a conversation is empty, or turns of user and assistant, after a system turn or not.
GRAMMAR = (
    ("Talk", ()),
    ("Talk", ("Turns",)),
    ("Talk", ("s", "Turns")),
    ("Turns", ("Turns", "Turn")),
    ("Turns", ("Turn",)),
    ("Turn", ("u", "a")),
)
TOP = "Talk"
ROLES = {"u": "user", "a": "assistant"}  # what may be inserted or given to a row
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 256  # rows
SPACE = " \t\n\x0b\x0c\r"
BROKEN = 20
Best = tuple[int, str]


class Node:
    """Top of a stack: an LR state over the rest, which other stacks may share."""

    __slots__ = ("state", "below", "number", "after")

    def __init__(self, state: frozenset, below: Node | None, number: int) -> None:
        self.state, self.below, self.number, self.after = state, below, number, {}


class Stacks:
    """The graph of stacks: each node exists once, so stacks that reach the same one are merged there.

    As repetition is recursive on the left, no stack is much deeper than the longest rule, so the graph is
    finite. It is built whole and in a fixed order: numbers of nodes mean the same in every process.
    """

    def __init__(self) -> None:
        self.nodes: dict[tuple, Node] = {}
        self.states: dict[tuple, frozenset] = {}
        self.symbols = {rule for rule, _ in GRAMMAR}
        self.by_number: list[Node] = []
        self.start = self._node(self._closed({(i, 0) for i, (left, _) in enumerate(GRAMMAR) if left == TOP}), None)
        terminals = sorted({symbol for _, right in GRAMMAR for symbol in right} - self.symbols)
        reached = [self.start]
        for node in reached:
            for symbol in terminals:
                reached += [after for after in self.shift(node, symbol) if after not in reached]

    def _closed(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            right = GRAMMAR[rule][1]
            if dot < len(right) and right[dot] in self.symbols:
                more = {(i, 0) for i, (left, _) in enumerate(GRAMMAR) if left == right[dot]} - items
                items |= more
                todo += more
        return frozenset(items)

    def _node(self, state: frozenset, below: Node | None) -> Node:
        key = (state, below.number if below else -1)
        if key not in self.nodes:
            self.nodes[key] = Node(state, below, len(self.nodes))
            self.by_number.append(self.nodes[key])
        return self.nodes[key]

    def _push(self, node: Node, symbol: str) -> Node | None:
        key = (node.state, symbol)
        if key not in self.states:
            moved = {(rule, dot + 1) for rule, dot in node.state if GRAMMAR[rule][1][dot : dot + 1] == (symbol,)}
            self.states[key] = self._closed(moved)
        return self._node(self.states[key], node) if self.states[key] else None

    def _reduced(self, node: Node) -> list[Node]:
        """The stack itself where it can go on by a shift, and what its reductions lead to."""
        found, goes_on = [], False
        for rule, dot in sorted(node.state):
            left, right = GRAMMAR[rule]
            if dot < len(right):
                goes_on |= right[dot] not in self.symbols
            elif left != TOP:
                base = node
                for _ in right:
                    base = base.below
                if (pushed := self._push(base, left)) is not None:
                    found += self._reduced(pushed)
        return [node, *found] if goes_on else found

    def shift(self, node: Node, symbol: str) -> list[Node]:
        """All stacks after this terminal and every reduction that follows."""
        if symbol not in node.after:
            pushed = self._push(node, symbol)
            node.after[symbol] = [] if pushed is None else self._reduced(pushed)
        return node.after[symbol]

    def accepts(self, node: Node) -> bool:
        for rule, dot in node.state:
            left, right = GRAMMAR[rule]
            if left == TOP and dot == len(right):
                base = node
                for _ in right:
                    base = base.below
                if base is self.start:
                    return True
        return False


@cache
def stacks() -> Stacks:
    return Stacks()


def _offer(front: dict[Node, Best], node: Node, best: Best) -> bool:
    """Equal stacks merge; the lesser (cost, audit) stays."""
    if node not in front or best < front[node]:
        front[node] = best
        return True
    return False


def _with_inserts(front: dict[Node, Best]) -> dict[Node, Best]:
    graph, front = stacks(), dict(front)
    todo = list(front)
    while todo:
        node = todo.pop()
        cost, audit = front[node]
        for symbol in ROLES:
            for after in graph.shift(node, symbol):
                if _offer(front, after, (cost + INSERT, audit + "I")):
                    todo.append(after)
    return front


@lru_cache(1 << 16)
def passages(entry: int, initials: str, marks: str) -> tuple[tuple[int, int, str], ...]:
    """From one stack, all stacks after these rows, with the least (cost, audit) of edits that lead there.

    Of stacks that are equal after equally many rows the lesser stays: audits of equal cost are never one
    the start of the other, as each further edit between two rows is an insert and costs.
    """
    graph = stacks()
    front: dict[Node, Best] = {graph.by_number[entry]: (0, "")}
    for initial, mark in zip(initials, marks):
        after: dict[Node, Best] = {}
        more = TRUNCATED if mark == "t" else 0
        for node, (cost, audit) in _with_inserts(front).items():
            _offer(after, node, (cost + DELETE, audit + "D"))
            if mark in "bd":
                continue
            for kept in graph.shift(node, initial) if initial != "x" else ():
                _offer(after, kept, (cost + more, audit + "K"))
            for symbol in ROLES:
                for given in graph.shift(node, symbol):
                    _offer(after, given, (cost + REROLE + more, audit + "R"))
        front = after
    return tuple((node.number, *best) for node, best in front.items())


@cache
def ending(exit_: int) -> Best | None:
    """The least inserts from this stack to a whole conversation."""
    done = [best for node, best in _with_inserts({stacks().by_number[exit_]: (0, "")}).items() if stacks().accepts(node)]
    return min(done, default=None)


def repaired(entry: int, edits: str, roles: list[str], texts: list[str]) -> list[str]:
    """``role:text`` of the rows that the edits leave, from the stack that the block begins with."""
    graph, row, found = stacks(), 0, []
    node = graph.by_number[entry]
    for edit in edits:
        if edit == "D":
            row += 1
            continue
        if edit == "K":
            role, symbol = roles[row], roles[row][0]
        else:
            symbol = next(s for s in ROLES if graph.shift(node, s))
            role = ROLES[symbol]
        found.append(f"{role}:{'' if edit == 'I' else texts[row]}")
        row += edit != "I"
        node = graph.shift(node, symbol)[0]
    return found


def best_edits(blocks: list[tuple[str, str]], known: list[tuple | None] | None = None) -> tuple[Best, list[tuple[int, str]]]:
    """Least (cost, audit) over all blocks of a conversation, and of each block the first stack and the edits.

    ``known`` may hold the passages of a block from every stack, found beforehand.
    """
    front: dict[int, Best] = {stacks().start.number: (0, "")}
    trail = []
    for i, (initials, marks) in enumerate(blocks):
        after: dict[int, Best] = {}
        origin: dict[int, tuple[int, str]] = {}
        beforehand = known[i] if known else None
        for entry, (cost, audit) in front.items():
            found = passages(entry, initials, marks) if beforehand is None else beforehand.get(entry)
            for exit_, c, edits in passages(entry, initials, marks) if found is None else found:
                best = (cost + c, audit + edits)
                if exit_ not in after or best < after[exit_]:
                    after[exit_], origin[exit_] = best, (entry, edits)
        front = after
        trail.append(origin)
    done = [(cost + e[0], audit + e[1], x) for x, (cost, audit) in front.items() if (e := ending(x)) is not None]
    cost, audit, at = min(done)
    steps, last = [], ending(at)[1]
    for origin in reversed(trail):
        entry, edits = origin[at]
        steps.append((entry, edits + last))
        at, last = entry, ""
    return (cost, audit), steps[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """``key, conv_id, turn, role, text``: rows broken by a rule on crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it a user's. A null of
    any column is one space there; ``key`` is the id as text, so that rows without one are a conversation too.
    """
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = space("conv_id")
    fate = F.crc32(F.concat(key, F.lit(":"), space("turn"))) % BROKEN
    rows = conversations.select(
        key.alias("key"),
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"),
        space("text").alias("text"),
        fate.alias("fate"),
        F.monotonically_increasing_id().alias("row"),
    ).where("fate <> 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("key", "conv_id", "turn", role.alias("role"), text.alias("text"), "row", copies)


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("x"))


def _all_passages(blocks: DataFrame) -> DataFrame:
    """Passages of every full block from every stack, found in parallel; other blocks wait for theirs."""

    def work(batches):
        graph = stacks()
        for batch in batches:
            found = []
            for initials, marks in zip(batch.column("initials").to_pylist(), batch.column("marks").to_pylist()):
                if len(initials) < BLOCK:
                    found.append(None)
                    continue
                ways, todo = {}, [graph.start.number]
                while todo:
                    entry = todo.pop()
                    ways[entry] = passages(entry, initials, marks)
                    todo += [x for x, _, _ in ways[entry] if x not in ways and x not in todo]
                found.append([{"entry": e, "exit": x, "cost": c, "edits": a} for e, way in ways.items() for x, c, a in way])
            kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "ways"])

    ways = "array<struct<entry:int,exit:int,cost:long,edits:string>>"
    return blocks.mapInArrow(work, f"key string, chunk long, initials string, marks string, ways {ways}")


def _decide(blocks: DataFrame) -> DataFrame:
    """Edits of every block; the last block of a conversation carries what holds for all of it."""
    schema = (
        "key string, chunk long, entry int, edits string, alone boolean, cost long, audit string, "
        "blank long, duplicate long, truncated long, illegal long"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.string(), *[pa.int64()] * 4]

    def work(batches):
        key, held, rows = None, [], []

        def close():
            (cost, audit), steps = best_edits([h[1:3] for h in held], [h[3] for h in held])
            initials, marks = ("".join(h[i] for h in held) for i in (1, 2))
            pairs = zip(initials, initials[1:])
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
            of_all = (cost, audit, marks.count("b"), marks.count("d"), marks.count("t"), illegal)
            for (chunk, *_), (entry, edits) in zip(held, steps):
                rows.append((key, chunk, entry, edits, len(held) == 1, *([None] * 6)))
            rows[-1] = (*rows[-1][:5], *of_all)

        def flush():
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for owner, *cells, ways in zip(*(batch.column(c).to_pylist() for c in ("key", "chunk", "initials", "marks", "ways"))):
                if owner != key:
                    if held:
                        close()
                    key, held = owner, []
                if ways is not None:
                    by_entry = {}
                    for w in ways:
                        by_entry.setdefault(w["entry"], []).append((w["exit"], w["cost"], w["edits"]))
                    ways = by_entry
                held.append((*cells, ways))
            if rows:
                yield flush()
        if held:
            close()
        if rows:
            yield flush()

    return blocks.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(work, schema)


def _rewrite(blocks: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            found = []
            for entry, edits, rows in zip(*(batch.column(c).to_pylist() for c in ("entry", "edits", "rows"))):
                lines = repaired(entry, edits, [r["role"] for r in rows], [r["text"] for r in rows])
                found.append("\n".join(lines) if lines else None)
            kept = [batch.column(c) for c in ("key", "chunk", "alone")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], ["key", "chunk", "alone", "lines"])

    return blocks.mapInArrow(work, "key string, chunk long, alone boolean, lines string")


def repair(rows: DataFrame, known: DataFrame) -> DataFrame:
    """One row per conversation of ``known(key, conv_id)``: faults, cheapest edits, hash of the repaired rows.

    ``rows(key, conv_id, turn, role, text, row, copy)`` are taken by ``turn`` (null first), ties by role and a
    hash of role and text; rows equal in all of these are alike. The first fault of a row counts: *blank* (no
    character but white space), *duplicate* (role and text came before), *truncated* (last such character is
    not ``.!?``). Blank and duplicate rows go. Result: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256``; conversations without rows have zeros and the hash of nothing.

    Rows are put in order over ranges of all conversations and cut into blocks of at most ``BLOCK`` rows. Full
    blocks are parsed in parallel from every stack that they can begin with; then the few characters a row that
    stand for a conversation's roles and faults pass one task, and texts only meet their block's edits. So a
    conversation with very many rows is spread out but for these characters and the final hash. A text of
    any length is a single value and is never split.
    """
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    ended = F.rtrim(F.col("text"), F.lit(SPACE))
    mark = F.when(ended == "", "b").when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), "t").otherwise(".")
    shaped = rows.withColumns({"id": F.unhex(F.left(F.sha2(said, 256), F.lit(32))), "mark": mark, "initial": _initial(F.col("role"))})
    placed = stage(with_dense_key(shaped, "at", ["key", "turn", "role", "id", "row", "copy"], "long"), "repair-rows")
    chunk = F.floor(F.col("at") / BLOCK).cast("long").alias("chunk")
    firsts = stage(
        placed.groupBy("key", "id").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "repair-firsts",
    )
    seen = (F.col("mark") != "b") & (F.col("at") > F.coalesce("first", "at"))
    judged = placed.select("key", "id", "at", "mark", "initial").join(firsts, ["key", "id"], "left")
    letters = F.struct("at", "initial", F.when(seen, "d").otherwise(F.col("mark")).alias("mark"))
    listed = judged.groupBy("key", chunk).agg(F.array_sort(F.collect_list(letters)).alias("cells"))
    blocks = listed.select(
        "key", "chunk", F.array_join("cells.initial", "").alias("initials"), F.array_join("cells.mark", "").alias("marks")
    )
    decided = stage(_decide(stage(_all_passages(blocks), "repair-passages")), "repair-edits")
    spoken = placed.groupBy("key", chunk).agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("rows"))
    steps = decided.select("key", "chunk", "entry", "edits", "alone")
    lines = stage(_rewrite(spoken.join(steps, ["key", "chunk"])), "repair-lines")
    short = lines.where("alone").select("key", F.sha2(F.coalesce("lines", F.lit("")), 256).alias("sha256"))
    long = joined_sha256(lines.where("NOT alone AND lines IS NOT NULL"), ["key"], ["chunk"], "lines", "\n")
    hashes = short.unionByName(long)
    turns = placed.groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    )
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    summary = decided.where("cost is not null").select("key", *counts, "audit")
    whole = known.join(turns, "key", "left").join(summary, "key", "left").join(hashes, "key", "left")
    return whole.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ["gaps", *counts]],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged conversations, one row for each that there was before."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("key")
    return repair(damaged(conversations), conversations.select(key, "conv_id").distinct())
