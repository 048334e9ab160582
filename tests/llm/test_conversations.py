"""Prefix trie and repair of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from martloom.llm import digests, repair, trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string"


def identity(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def in_order(rows):
    return sorted(rows, key=lambda r: r[:3])


def plain_trie(rows):
    of = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            of[c].append(((turn is not None, turn or 0), role, identity(role, text), text))
    said = {c: [(r[1], r[3]) for r in in_order(rs)] for c, rs in of.items()}
    built = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = said.get(c - c % 20, [])[:h] + own[h:]
    members, below = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        mine = members[node]
        saved = (len(mine) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        ends = ",".join(str(c) for c in sorted(mine) if len(built[c]) == len(node))
        found[node] = (
            min(mine),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(mine),
            len(below[node]),
            sum(found[n][5] for n in below[node]) or 1,
            saved + sum(found[n][6] for n in below[node]),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(found.values(), key=str)


def grammatical(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def plain_edits(symbols):
    """Every way to edit, with at most two inserts in a place; more never pay."""
    ways = []
    for initial, mark in symbols:
        more = 3 if mark == "t" else 0
        kept = [] if mark in "bd" else [("K", more, initial), ("R", 3 + more, "u"), ("R", 3 + more, "a")]
        ways.append([("D", 4, ""), *kept])
    found = []
    for inserts in product(["", "u", "a", "ua", "au"], repeat=len(ways) + 1):
        for edits in product(*ways):
            initials = inserts[0] + "".join(e[2] + i for e, i in zip(edits, inserts[1:]))
            if grammatical(initials):
                audit = "I" * len(inserts[0]) + "".join(e[0] + "I" * len(i) for e, i in zip(edits, inserts[1:]))
                found.append((sum(e[1] for e in edits) + 3 * audit.count("I"), audit))
    return min(found)


def step_edits(symbols):
    """The same by the four places in the grammar, for longer conversations."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def with_inserts(best):
        best = dict(best)
        for _ in range(3):
            for (place, role), to in moves.items():
                if role != "s" and place in best:
                    way = (best[place][0] + 3, best[place][1] + "I")
                    best[to] = min(best.get(to, way), way)
        return best

    best = {"": (0, "")}
    for initial, mark in symbols:
        more, after = 3 if mark == "t" else 0, defaultdict(list)
        for place, (cost, audit) in with_inserts(best).items():
            after[place].append((cost + 4, audit + "D"))
            for (start, role), to in moves.items():
                if start == place and mark not in "bd":
                    after[to] += [(cost + more, audit + "K")] if role == initial else []
                    after[to] += [(cost + 3 + more, audit + "R")] if role != "s" else []
        best = {place: min(ways) for place, ways in after.items() if ways}
    return min(way for place, way in with_inserts(best).items() if place in ("", "a"))


def plain_repair(rows):
    of, known = defaultdict(list), set()
    for c, turn, role, text in rows:
        known.add(c)
        name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        row = ((turn is not None, turn or 0), role, identity(role, text), text, turn)
        of[c] += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
    found = []
    for c in known:
        mine, seen, symbols = in_order(of[c]), set(), []
        for _, role, _, text, _ in mine:
            end = text.rstrip(SPACE)
            mark = "b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "."
            seen.add((role, text))
            symbols.append((role[:1], mark))
        cost, audit = step_edits(symbols)
        lines, at, last = [], 0, ""
        for edit in audit:
            role = mine[at][1] if edit == "K" else "assistant" if last == "u" else "user"
            if edit != "D":
                lines.append(f"{role}:{'' if edit == 'I' else mine[at][3]}")
                last = role[0]
            at += edit != "I"
        turns = [r[4] for r in mine if r[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        marks = [m for _, m in symbols]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found.append((c, gaps, *map(marks.count, "bdt"), illegal, cost, audit, digest))
    return sorted(found, key=str)


def results(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def trie_of(frame):
    turns, sizes = trie.numbered_turns(frame)
    return trie.prefix_trie(trie.with_lent_starts(turns, sizes), sizes.select("conv_id"))


@pytest.fixture(scope="module")
def talks():
    """Shared starts, whole copies, one long conversation, nulls, ties, repeated rows, a long text."""
    rng, rows = random.Random(7), []
    say = ["Yes.", "No", "why?", "", None, "ok ok.", " \t", "Ärger ü. "]
    roles = ["user", "assistant", "system", None, "tool", "", "Assistant"]
    for c in range(70):
        for t in range(rng.randint(1, 7)):
            role = ("user", "assistant")[t % 2] if rng.random() < 0.8 else rng.choice(roles)
            rows.append((c, rng.choice([t, t, t, None]), role, rng.choice(say)))
    for c in range(100, 180):  # copies
        rows += [(c, t, ("user", "assistant")[t % 2], f"turn {t} of all.") for t in range(12)]
    for c in (201, 202):  # longer than the blocks of columns and of rows
        rows += [(c, t, ("user", "assistant")[t % 2], f"long {t if t < 90 else c}.") for t in range(130)]
    rows += [(301, 1, "user", "a word " * 30_000 + "."), (301, 2, "assistant", "end.")]
    rows += [(302, 5, "user", "again.")] * 7 + [(None, 1, "user", "no id"), (None, None, None, None)]
    rows += [(303, None, None, None), (1 << 40, 0, "user", "far away."), (320, 1, "s", "short lender"), (325, 0, "user", "x.")]
    return rows


@pytest.fixture(scope="module")
def table(spark, talks):
    """With extra columns whose names clash with those that the operators use inside."""
    rows = [(*r, "x", 1, 2) for r in random.Random(1).sample(talks, len(talks))]
    return spark.createDataFrame(rows, COLUMNS + ", id string, node int, key int").repartition(5)


def test_trie_equals_brute_force(table, talks):
    assert results(trie_of(table)) == plain_trie(talks)


def test_trie_is_the_same_for_any_width_of_blocks(table, talks):
    turns, sizes = trie.numbered_turns(table)
    frame = trie.prefix_trie(trie.with_lent_starts(turns, sizes), sizes.select("conv_id"), head=3, wide=50)
    assert results(frame) == plain_trie(talks)


def test_trie_of_conversations_without_turns_and_of_none(spark):
    turns = spark.createDataFrame([], "conv_id long, pos long, id binary, words long")
    members = spark.createDataFrame([(4,), (11,)], "conv_id long")
    both = hashlib.sha256(b"4,11").hexdigest()
    assert results(trie.prefix_trie(turns, members)) == [(4, 0, None, 2, 0, 1, 0, both)]
    empty = spark.createDataFrame([], COLUMNS)
    assert results(trie_of(empty)) == []
    assert results(repair.repair_damaged(empty)) == []


def test_edits_equal_every_way_to_edit():
    rng = random.Random(3)
    for _ in range(250):
        symbols = [(rng.choice("suax"), rng.choice("...tbd")) for _ in range(rng.randint(1, 3))]
        initials, marks = ("".join(s[i] for s in symbols) for i in (0, 1))
        best, steps = repair.best_edits([(initials, marks)])
        assert best == plain_edits(symbols) == step_edits(symbols)
        assert "".join(edits for _, edits in steps) == best[1]


def test_edits_do_not_depend_on_blocks():
    rng = random.Random(4)
    for _ in range(200):
        symbols = [(rng.choice("suuaaax"), rng.choice(".....tbd")) for _ in range(rng.randint(2, 40))]
        cut = rng.randint(1, len(symbols) - 1)
        blocks = [tuple("".join(s[i] for s in part) for i in (0, 1)) for part in (symbols[:cut], symbols[cut:])]
        best, steps = repair.best_edits(blocks)
        assert best == step_edits(symbols)
        assert "".join(edits for _, edits in steps) == best[1]


def test_stacks_are_numbered_alike_everywhere():
    first, second = repair.Stacks(), repair.Stacks()
    assert [sorted(n.state) for n in first.by_number] == [sorted(n.state) for n in second.by_number]
    assert len(first.by_number) < 40


def test_repair_equals_brute_force(table, talks):
    assert results(repair.repair_damaged(table)) == plain_repair(talks)


def test_repair_in_short_blocks(table, talks, monkeypatch):
    """Blocks are cut on the driver and by the workers: only the driver's constant changes here, so none is full."""
    monkeypatch.setattr(repair, "BLOCK", 16)
    assert results(repair.repair_damaged(table)) == plain_repair(talks)


def test_full_blocks_from_every_stack(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"{t} {'.' if t % 7 else ''}") for t in range(1500)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(4)
    assert results(repair.repair_damaged(frame)) == plain_repair(rows)


def test_joined_hashes_of_many_parts(spark):
    numbers = spark.range(0, 5000, 1, 7).select(F.lit(3).cast("long").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = digests.joined_numbers(numbers, ["k"], "v")
        assert parts.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = digests.joined_sha256(parts, ["k"], ["first"], "joined", ",").collect()
    assert [tuple(r) for r in found] == [(3, hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest())]
