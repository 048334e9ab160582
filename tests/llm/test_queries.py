"""The registered queries and the pipeline over the given tables."""

import hashlib
import zlib
from collections import Counter

import pytest
from test_copies import fingerprint
from test_rows import PATTERNS, base_spans

import corpus_pipeline
from harness import check
from martloom.llm import decontam, oracle, queries

GIVEN = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op2_language_id": "doc_id held_out lang_pred score",
    "op3_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op4_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op6_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_kd_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_quality_rules": "doc_id held_out score predicted",
    "op9_string_tiling": "doc_id item_id coverage contaminated",
    "op10_simhash": "doc_id fingerprint component_id",
    "op13_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
}
OF_CONVERSATIONS = {
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_structure_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in queries.table(spark, GIVEN, "documents").collect()}


@pytest.fixture(scope="module")
def result(spark):
    made = {}

    def run(name):
        if name not in made:
            made[name] = queries.queries()[name](spark, GIVEN).collect()
        return made[name]

    return run


@pytest.mark.parametrize("name", COLUMNS)
def test_one_row_per_document_and_the_agreed_columns(name, result, docs):
    rows = result(name)
    assert list(rows[0].asDict()) == COLUMNS[name].split()
    ids = Counter(r["doc_id"] for r in rows)
    assert set(ids) == set(docs) and (name.startswith("op6") or set(ids.values()) == {1})
    assert set(queries.queries()) == {*COLUMNS, *OF_CONVERSATIONS}


@pytest.mark.parametrize("name", OF_CONVERSATIONS)
def test_columns_of_conversation_queries(spark, name):
    assert queries.queries()[name](spark, GIVEN).columns == OF_CONVERSATIONS[name].split()


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_matches_its_sql(spark, name):
    con = check.connect(GIVEN)
    frame = queries.queries()[name](spark, GIVEN)
    mine = check.table(frame.columns, frame.collect())
    cursor = con.execute(oracle.statements()[name])
    assert mine == check.table([d[0] for d in cursor.description], cursor.fetchall())


def test_pii_digests(result, docs):
    for r in result("op1_pii"):
        spans = base_spans(docs[r["doc_id"]]["text"])
        counts = Counter(kind for kind, _, _ in spans)
        assert [r[f"n_{kind}"] for kind in PATTERNS] == [counts[kind] for kind in PATTERNS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_fingerprints_and_components(result, docs):
    found = {r["doc_id"]: r for r in result("op10_simhash")}
    prints = {i: fingerprint(d["text"]) for i, d in docs.items()}
    assert all(found[i]["fingerprint"] == f"{p:016x}" for i, p in prints.items())
    for i, p in prints.items():
        near = [j for j, q in prints.items() if (p ^ q).bit_count() <= 2]
        assert len({found[j]["component_id"] for j in near}) == 1


def test_language_on_held_out_documents(result, docs):
    held = [r for r in result("op2_language_id") if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.95 * len(held) > 20


def test_quality_on_held_out_labels(spark, result):
    labels = {r["doc_id"]: r["quality"] for r in queries.table(spark, GIVEN, "labels").collect()}
    held = [r for r in result("op8_quality_rules") if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.9 * len(held) > 5


def test_leaks_contain_a_benchmark_item(spark, result, docs):
    items = [r["text"] for r in queries.table(spark, GIVEN, "benchmark").collect()]
    tokens = [b" ".join(decontam.tokens_of(t)) for t in items]
    for r in result("op9_string_tiling"):
        own = b" ".join(decontam.tokens_of(docs[r["doc_id"]]["text"]))
        if any(len(t.split()) >= decontam.SEED_TOKENS and b" " + t + b" " in b" " + own + b" " for t in tokens):
            assert r["contaminated"] and r["coverage"] == 1.0


def test_shards_hold_nearly_equal_bytes(result, docs):
    rows = result("op7_kd_sharding")
    assert all(r["size"] == len((docs[r["doc_id"]]["text"] or "").encode()) + 8 for r in rows)
    weights = Counter()
    for r in rows:
        weights[r["shard"]] += r["size"]
    largest = max(r["size"] for r in rows)
    assert set(weights) == set(range(24)) and max(weights.values()) - min(weights.values()) <= 3 * largest


def test_pipeline_stages_drop_what_they_should(spark, docs):
    frame, lost = queries.table(spark, GIVEN, "documents"), {}
    for name, work in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in frame.select("doc_id").collect()}
        kept = corpus_pipeline.stage(work(spark, frame, GIVEN), "test")
        assert kept.columns == frame.columns
        frame = kept
        lost[name] = before - {r["doc_id"] for r in frame.select("doc_id").collect()}
    lowered = {i: (d["text"] or "").lower() for i, d in docs.items()}
    last = {t: i for i, t in sorted(lowered.items())}
    assert lost["exact dedup"] == {i for i, t in lowered.items() if last[t] != i} - lost["language identification"]
    left = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert not lost["language identification"] and len(left) > 0.8 * len(docs)
    packed = corpus_pipeline.run(spark, GIVEN).collect()
    assert {r["doc_id"] for r in packed} == set(left)


def test_near_copies_among_all_rows_are_dropped(spark):
    base = " ".join(f"word{i}" for i in range(300))
    near, alone = base.replace("word150", "other"), " ".join(f"x{i}" for i in range(300))
    # The sets of shingles differ, the fingerprints do not.
    spam = ["spam " * 4000 + " ".join(f"{end}{i}" for i in range(40)) for end in "ab"]
    rows = [(5, base), (None, near), (None, base.upper()), (7, near), (7, alone), (20, spam[0]), (21, spam[1])]
    rows += [(None, alone.replace("x", "y"))] * 2 + [(9, alone.replace("x", "z"))] * 2
    docs = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id long").repartition(3)
    kept = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, docs, GIVEN)
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert kept.columns == docs.columns
    assert found == sorted([rows[0], rows[4], rows[5], rows[7], *rows[-2:]], key=repr)


def test_stages_take_tables_with_nulls_and_none(spark, odd_rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in (odd_rows, []):
        docs = spark.createDataFrame([(i, t, "de", None, None) for i, t in rows], schema)
        for name, work in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(work(spark, docs, GIVEN), "test")
        assert docs.columns == COLUMNS["op6_best_fit_packing"].split()


def test_text_checksums(result, docs):
    for r in result("op7_kd_sharding"):
        assert r["text_crc32"] == zlib.crc32((docs[r["doc_id"]]["text"] or "").encode())
