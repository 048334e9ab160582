"""Operators that judge rows one by one, shards and packing."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import decontam, language, packing, pii, quality, shards

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = [int(c) for c in re.sub("[^0-9]", "", text)]
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    ]


def test_base_spans_match_the_grammar_on_random_strings():
    rng, anchors = random.Random(2), pii.automaton()
    for alphabet in ("a@.b-", "0123456789. -", "+12(3). -", "1.2@a+ 4-é"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            found = [(pii.KINDS[k], a, b) for k, a, b in pii.spans_of(text, anchors) if k < 4]
            assert found == base_spans(text), text


def test_pii_kinds_and_odd_rows(frame, odd_rows):
    text = "write a.b@c-d.org or 4111 1111 1111 1111, +44 20 7946 0958, 10.0.0.300, 10.0.0.3; " + (
        "see https://x.org/a?b=1. IBAN GB82 WEST 1234 5698 7654 32 password = 'hunter2hunter2'"
    )
    rows = [*odd_rows, (99, text)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(frame(rows)).collect()}
    kinds = {text[s["start"] : s["end"]]: s["kind"] for s in found[99]}
    assert kinds["a.b@c-d.org"] == "email" and kinds["4111 1111 1111 1111"] == "card" and kinds["10.0.0.3"] == "ip"
    assert kinds["https://x.org/a?b=1"] == "url" and kinds["GB82 WEST 1234 5698 7654 32"] == "iban"
    assert kinds["hunter2hunter2"] == "secret" and kinds["+44 20 7946 0958"] == "phone"
    assert found[1] == found[2] == found[3] == []
    assert pii.find(frame(rows)).count() == len(rows) and pii.find(frame([])).count() == 0


def test_language_profiles(spark, frame, odd_rows):
    rng = random.Random(0)
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "ber"], "cc": ["ção", "nho", "que", "ão"]}
    text = lambda lang: " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(40))
    rows = [(i, text(lang), lang) for i in range(120) for lang in [sorted(syllables)[i % 3]]]
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "x", None)], "doc_id long, text string, lang string")
    profiles = language.learn(docs.where(~language.held_out(F.col("doc_id"))), per_language=20)
    assert sorted(profiles) == sorted(syllables)
    found = {r["doc_id"]: r for r in language.identify(docs, profiles).collect()}
    assert all(found[i]["lang_pred"] == lang and 0 <= found[i]["score"] <= 1 for i, _, lang in rows)
    odd = language.identify(frame(odd_rows), profiles).collect()
    assert len(odd) == len(odd_rows)
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} == {1, 2, 3, 8, None}
    assert language.identify(frame([]), profiles).count() == 0
    assert language.learn(docs.where("lang IS NULL")) == {}
    assert {r["lang_pred"] for r in language.identify(docs, {}).collect()} == {"und"}


def test_binding_and_bundling_are_exact():
    profiles = language.Profiles(64)
    text = "abc ab"
    first, second, third = profiles.by_place
    s = [0, 1, 2, 3, 0, 1, 2, 0]
    bundle = sum(first[a].astype(int) * second[b] * third[c] for a, b, c in zip(s, s[1:], s[2:]))
    assert np.allclose(profiles.vectors([text])[0], bundle / np.linalg.norm(bundle), atol=1e-6)


def test_held_out_is_the_checksum_of_the_id(spark):
    found = spark.range(200).select("id", language.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in found)


def test_quality_rules_learn_and_compile(spark, frame, odd_rows):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.random())[2:5] for _ in range(60))
    rows = [(i, good() if i % 4 else " ".join(w + "$$$" for w in good().split()), i % 4 > 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, int(q)) for i, _, q in rows), (5000, 1), (1, None)], "doc_id long, quality int")
    ensemble = quality.learn(docs, labels, ~language.held_out(F.col("doc_id")))
    assert 0 < len(ensemble.rules) < 40
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, ensemble).collect()}
    assert all((found[i] >= 0.5) == q for i, _, q in rows)
    x = np.array([quality.measures(t) for _, t, _ in rows])
    direct = ensemble.bias + sum(w * quality.holds(r, x) for r, w in ensemble.rules)
    assert np.allclose([found[i] for i, _, _ in rows], 1 / (1 + np.exp(-direct)))
    odd = quality.score(frame(odd_rows), ensemble).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    nothing = quality.learn(docs, labels.where("quality > 5"), F.lit(True))
    assert nothing.rules == [] and quality.score(frame([]), nothing).count() == 0


def tiled_by_hand(item, doc, least):
    """Greedy string tiling in its plain cubic form: the coverage."""
    mi, md = [False] * len(item), [False] * len(doc)
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                k = 0
                while p + k < len(item) and t + k < len(doc) and not mi[p + k] and not md[t + k] and item[p + k] == doc[t + k]:
                    k += 1
                best = max(best, (k, -p, -t))
        if best[0] < least:
            return sum(mi)
        for k in range(best[0]):
            mi[k - best[1]] = md[k - best[2]] = True


def test_tiling_matches_the_plain_form():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item = rng.integers(1, 4, rng.integers(4, 25)).astype(np.uint64)
        doc = np.concatenate([rng.integers(1, 4, 10), rng.permutation(item[:8]), item[4:], rng.integers(1, 4, 5)]).astype(np.uint64)
        mask = decontam.tile(item, doc, 3)
        plain = tiled_by_hand(item.tolist(), doc.tolist(), 3)
        assert abs(int(mask.sum()) - plain) <= 3  # equally long matches may be taken in another order


def test_leaks_are_found_even_if_reordered(spark, frame, odd_rows):
    item = " ".join(f"q{i}" for i in range(40))
    half = item.split()
    rows = [
        *odd_rows,
        (50, f"before {item.upper()}, after"),
        (51, "x ".join([" ".join(half[20:]) + " ", " ".join(half[:20])])),
        (52, " ".join(half[:10]) + " but no more"),
        (53, "nothing of it"),
    ]
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    for size in (1, 50_000):
        decontam.ITEMS_AT_ONCE, kept = size, decontam.ITEMS_AT_ONCE
        try:
            found = {r["doc_id"]: r for r in decontam.find_leaks(frame(rows), bench).collect()}
        finally:
            decontam.ITEMS_AT_ONCE = kept
        assert {i for i, r in found.items() if r["contaminated"]} == {50, 51}
        assert found[50]["coverage"] == 1.0 and found[52]["coverage"] == 0.25 and found[53]["item_id"] is None
    assert decontam.find_leaks(frame(rows), bench.where("false")).where("contaminated").count() == 0
    assert decontam.find_leaks(frame([]), bench).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def test_cached_encoding_is_the_tokenizers(tokenizer):
    encode = packing.Encoder(packing.default_tokenizer())
    texts = ["", "It's we'll 'S x", "a<|endoftext|>b", "été ́x", "a b\x1cc d", "İ ǅ ß Ⅷ ² 9٣", "###... a_b-c"]
    rng = random.Random(3)
    texts += ["".join(rng.choice("aB'é. 1\ń_<|>²") for _ in range(60)) for _ in range(300)]
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_lower_case_outside_the_plain_characters_ends_no_word(tokenizer):
    # Two capitals below U+0250 have small letters above U+2C00; signs between letters end a word.
    texts = ["ȺB Ⱦx aȺ", "", "a×b÷c ªº µm ¿q?", "\n \t", "ß·İx", "don't <|x|>", "a\x0bb", "the the. The\r\nthe"]
    encode = packing.Encoder(packing.default_tokenizer())
    for _ in range(2):  # as learned, and as remembered
        assert encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encode([]) == []


def test_packing_holds_every_piece_once(frame, odd_rows, copied_rows, tokenizer):
    rows = [*odd_rows, *copied_rows]
    found = packing.pack(frame(rows), capacity=256, pool=30).collect()
    wanted = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        wanted += [(i, k // 256, k, len(ids[k : k + 256]), zlib.crc32(ids[k : k + 256].tobytes())) for k in range(0, len(ids), 256)]
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(wanted, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(frame([])).count() == 0


def test_sum_of_squares_is_the_rule():
    rng = np.random.default_rng(6)
    sizes, capacity = rng.integers(1, 31, 200), 31
    bins, offsets = packing.sum_of_squares(sizes, capacity)
    gaps = {}
    for size, b, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def after(choice):
            state = dict(gaps)
            state[choice] = state.get(choice, capacity) - size
            count = np.bincount([g for g in state.values() if g], minlength=capacity + 1)
            return int((count**2).sum())

        options = [after(k) for k, g in gaps.items() if g >= size] + [after("new")]
        chosen = after(b if b in gaps else "new")
        assert chosen == min(options) and capacity - gaps.get(b, capacity) == offset
        gaps[b] = gaps.get(b, capacity) - size


def test_shards_are_even_and_whole(spark, odd_rows, copied_rows):
    rows = [(i, t, None if i and i % 3 == 0 else "l", "hot" if i and i % 2 else f"s{i}", None if i == 4 else len(t or "")) for i, t in [*copied_rows * 5, *odd_rows[:3], *odd_rows[5:]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = shards.kd_shards(docs, shards=7).collect()
    size = lambda t: len((t or "").encode()) + 8
    crc = lambda t: zlib.crc32((t or "").encode())
    assert sorted((tuple(r)[:3] for r in found), key=repr) == sorted(((r[0], size(r[1]), crc(r[1])) for r in rows), key=repr)
    largest, weights = max(size(r[1]) for r in rows), {}
    for r in found:
        weights.setdefault(r["shard"], []).append(r)
    assert sorted(weights) == list(range(7))
    mean = sum(r["size"] for r in found) / 7
    for members in weights.values():
        assert abs(sum(r["size"] for r in members) - mean) <= 3 * largest
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    assert shards.kd_shards(docs.where("false")).count() == 0
    assert {r["shard"] for r in shards.kd_shards(docs.limit(1)).collect()} <= set(range(24))
