"""Exact, near and partial copies against brute force."""

import hashlib
import random
import re
import string
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from martloom.llm import exact, repeats, simhash, substring, suffix
from martloom.llm.components import components
from martloom.llm.windows import HOT

ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").translate(ASCII_LOWER)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def expected_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    result = []
    for i, t in rows:
        ids = groups[lowered(t)]
        keep = max((x for x in ids if x is not None), default=None)
        result.append((i, keep, len(ids), i == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(result, key=repr)


def test_exact_copies_match_brute_force(frame, copied_rows, odd_rows):
    for rows in (copied_rows, odd_rows, []):
        found = exact.refine(frame(rows), hash_all=True)
        assert sorted(map(tuple, found.collect()), key=repr) == expected_exact(rows)


def test_no_text_is_shuffled_where_all_are_hashed(spark, copied_rows, monkeypatch):
    shuffled, keep = [], exact.stage

    def watched(df, label):
        todo = [df._jdf.queryExecution().sparkPlan(), df._jdf.queryExecution().executedPlan().initialPlan()]
        while todo:
            node = todo.pop()
            if "Exchange" in node.nodeName():
                shuffled.extend(node.output().apply(i).name() for i in range(node.output().size()))
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return keep(df, label)

    monkeypatch.setattr(exact, "stage", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exact.refine(spark.createDataFrame(copied_rows, "doc_id long, text string"), hash_all=True).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {"size", "prefix", "content"} <= set(shuffled) and "text" not in shuffled


def test_exact_reads_in_full_only_what_survives(frame):
    rows = [(1, "alpha"), (2, "ALPHA"), (3, "beta one"), (4, "gamma")]
    hashed = {r["doc_id"]: r["text_sha256"] for r in exact.refine(frame(rows)).collect()}
    assert hashed[1] == hashed[2] is not None and hashed[3] is None and hashed[4] is None


def test_exact_plan_is_native(frame):
    plan = exact.refine(frame([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def fingerprint(text):
    words = WORD.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(keys, near):
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if near(keys[i], keys[j]) and find(i) != find(j):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(keys))]


def test_simhash_matches_brute_force(frame, copied_rows, odd_rows):
    for rows in (copied_rows, odd_rows, []):
        for tile in (4, 1024):
            found = simhash.near_duplicates(frame(rows), radius=2, tile=tile).collect()
            prints = [fingerprint(t) for _, t in rows]
            of = linked(prints, lambda a, b: (a ^ b).bit_count() <= 2)
            smallest = {
                r: min((i for (i, _), x in zip(rows, of) if x == r and i is not None), default=None) for r in set(of)
            }
            wanted = sorted(((i, p, smallest[r]) for (i, _), p, r in zip(rows, prints, of)), key=repr)
            assert sorted(((r[0], r[1] % (1 << 64), r[2]) for r in found), key=repr) == wanted


def test_tiles_lose_no_link(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    flips = np.int64(1) << rng.integers(0, 63, (40, 12, 2), dtype=np.int64)
    values = np.unique(np.concatenate([centres, (centres[:, None] ^ flips[:, :, 0] ^ flips[:, :, 1]).ravel()]))
    nodes = spark.createDataFrame([(int(v),) for v in values], "fp long")
    pairs = {frozenset(r) for r in components(simhash.links(nodes, 3, 16)).collect()}
    of = linked(values.tolist(), lambda a, b: (a ^ b).bit_count() <= 3)
    wanted = {}
    for v, r in zip(values.tolist(), of):
        wanted.setdefault(r, []).append(v)
    assert pairs == {frozenset((v, min(g))) for g in wanted.values() if len(g) > 1 for v in g}


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*chain, *hub, (3, 3), (None, 5)], "u long, v long")
    found = {r["vertex"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 260)}}
    assert components(edges.where("u = 3")).count() == 0


def test_near_copies_are_grouped_and_others_left(frame):
    base = " ".join(f"word{i}" for i in range(300))
    near = base.replace("word150", "other")
    rows = [(5, base), (9, near), (2, near.upper()), (4, " ".join(f"x{i}" for i in range(300))), (6, None), (None, base)]
    found = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(frame(rows)).collect()}
    assert found == {2: 2, 5: 2, 9: 2}
    assert simhash.similar_documents(frame([])).count() == 0


def test_near_copies_are_found_even_if_one_repeats_itself(frame):
    words = [f"word{i}" for i in range(300)]
    once, twice = " ".join(words), " ".join(words + words)
    thrice = " ".join(words[:50] * 8 + words[50:])
    rows = [(5, once), (9, twice), (2, thrice), (4, " ".join(f"x{i}" for i in range(300)))]
    found = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(frame(rows)).collect()}
    assert found == {2: 2, 5: 2, 9: 2}


def test_near_copies_are_those_of_exact_jaccard(frame):
    rng = random.Random(7)
    rows = []
    for g in range(120):  # chains of texts, each a little further from the one before, and small sets
        words = [f"g{g}w{k}" for k in range(rng.choice([8, 9, 12, 60, 200]))]
        for step in range(6):
            rows.append((len(rows), " ".join(words)))
            words = words.copy()
            for _ in range(max(1, len(words) // rng.choice([30, 45, 80]))):
                words[rng.choice([-1, rng.randrange(len(words))])] = f"n{rng.random()}"
    rows += [(5000 + i, " ".join(f"h{k}" if k != i else f"x{i}" for k in range(200))) for i in range(60)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    of = linked(sets, lambda a, b: len(a & b) / len(a | b) >= 0.8)
    groups = defaultdict(list)
    for (i, _), r in zip(rows, of):
        groups[r].append(i)
    wanted = {i: min(g) for g in groups.values() if len(g) > 1 for i in g}
    for tiles in ({}, {"tile": 64, "group_tile": 7}):
        found = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(frame(rows), **tiles).collect()}
        assert found == wanted


def removed_bytes(rows, width):
    raw = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in raw:
        if i is not None:
            for p in range(len(b) - width + 1):
                w = b[p : p + width]
                first[w] = min(i, first.get(w, i))
    result = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1):
            if i is not None and first[b[p : p + width]] < i:
                gone[p : p + width] = True
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        result.append((i, len(b), int(spans), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(result, key=repr)


def test_suffix_dedup_matches_brute_force(frame, copied_rows, odd_rows):
    short = [(i, t and t[:3000]) for i, t in odd_rows]
    for rows, width, gram in ((copied_rows, 50, 20), (copied_rows, 24, 9), (short, 50, 20), ([], 50, 20)):
        found = suffix.remove_repeated_bytes(frame(rows), window=width, gram=gram, log2=20)
        assert sorted(((r[0], r[1], r[2], bytes(r[3])) for r in found.collect()), key=repr) == removed_bytes(rows, width)


def test_suffix_dedup_removes_a_passage_that_very_many_documents_share(frame):
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choices(string.ascii_letters, k=n))
    passages = [noise(56), noise(150)]
    rows = [(i, f"{noise(30)}{passages[i % 2]}{noise(30)}") for i in rng.sample(range(9000), 2 * HOT + 500)]
    found = suffix.remove_repeated_bytes(frame(rows), log2=20)
    assert sorted(((r[0], r[1], r[2], bytes(r[3])) for r in found.collect()), key=repr) == removed_bytes(rows, 50)


def test_equal_windows_are_sorted_and_grouped():
    rng = np.random.default_rng(1)
    buffer = bytes(rng.choice([97, 98], 4000)) + b"abababab" * 60
    starts = np.arange(len(buffer) - 50)
    order, group = suffix.equal_windows(buffer, starts, 50)
    windows = [buffer[p : p + 50] for p in starts[order]]
    assert sorted(order) == list(range(len(starts)))
    assert [a == b for a, b in zip(windows, windows[1:])] == (np.diff(group) == 0).tolist()
    assert windows == sorted(windows)


def kept_words(rows, width):
    seen, result = set(), {}
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        words = WORD.findall(t or "")
        gone = set()
        for p in range(len(words) - width + 1):
            w = tuple(words[p : p + width])
            if w in seen:
                gone |= set(range(p, p + width))
            seen.add(w)
        result[i] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return result


def test_substring_dedup_matches_brute_force(frame, copied_rows, odd_rows):
    distinct = [r for n, r in enumerate(odd_rows) if r not in odd_rows[:n]]
    for rows, width, gram in ((copied_rows, 20, 8), (copied_rows, 5, 3), (distinct, 20, 8), ([], 20, 8)):
        found = by_id(substring.remove_repeated_words(frame(rows), window=width, gram=gram, log2=20).where("doc_id IS NOT NULL"))
        assert {i: tuple(r)[1:] for i, r in found.items()} == kept_words(rows, width)


def test_substring_repeated_rows_and_missing_ids_stay(frame):
    text = " ".join(map(str, range(50)))
    found = substring.remove_repeated_words(frame([(1, text), (1, text), (None, text)]), log2=20).collect()
    assert [r["n_removed"] for r in found] == [0, 0, 0]


def test_removed_ranges_travel_in_few_rows_however_many_documents_share_them(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{i} {passage} {i}") for i in range(3000)], "doc_id long, text string")
    spec = repeats.Spec(suffix._bytes, suffix.WINDOW, suffix.GRAM, False, 16)
    rows = docs.repartition(8)
    sketch = spark.sparkContext.broadcast(repeats.run_sketch(rows, spec))
    dealt = repeats._dealt(rows, spec, sketch, repeats.bucket_count(rows))
    counts = [repeats.range_bucket_count(rows), repeats.bucket_count(rows)]
    few, many = (repeats._met(dealt, spec, n).where("ranges IS NOT NULL").select("ranges", F.spark_partition_id().alias("task")) for n in counts)
    tasks = few.select("task").distinct().count()
    assert few.count() <= tasks * counts[0] < many.count()

    def whole(packed):
        raw = np.concatenate([np.frombuffer(r[0], np.int64).reshape(3, -1) for r in packed.collect()], axis=1)
        return [c.to_pylist() for c in repeats.merged_ranges(*raw).columns]

    assert whole(few) == whole(many) and len(set(whole(few)[0])) == 2999
