import random

import numpy as np
from llm_brute import MASK, bits, components, simhash

from conftest import SF_SMALL
from fundflow.llm import graph, simhash_dedup as S
from fundflow.llm.common import table

DOCS = "doc_id long, text string"


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_matches_brute_force_on_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: simhash(t) for i, t in texts.items()}
    got = _rows(S.near_components(docs))
    assert {i: r.fp & MASK for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == components(prints)


def test_keys_meet_within_two_bits():
    rng = random.Random(3)
    words = [rng.getrandbits(64) for _ in range(300)]
    near = [w ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2]))) for w in words]
    row, key = S.fuzzy_keys(np.array(words + near, dtype=np.uint64))
    keys = [set() for _ in range(600)]
    for r, k in zip(row, key):
        keys[r].add(int(k))
    assert all(keys[i] & keys[i + 300] for i in range(300))
    assert max(map(len, keys)) <= 3 * 22


def test_golay_code_is_perfect():
    leaders = S._leaders()
    assert len(set(leaders.tolist())) == 2048
    code = np.arange(1 << 12, dtype=np.int64) << 11
    code = code ^ S._syndrome(code)
    assert (S._syndrome(code) == 0).all() and len(set(S.golay_index(code, leaders).tolist())) == 4096


def test_hot_buckets_link_like_pairs(spark):
    rng = random.Random(5)
    start = rng.getrandbits(64)
    fps = {start}
    for _ in range(400):
        fps.add(rng.choice(sorted(fps)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.5) * (1 << rng.randrange(64)))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    expected = components({x[0]: x[0] for x in signed})
    for bucket in (2, 64, 10_000):
        rooted = {r.node: r.root for r in graph.components(S.near_edges(df, bucket=bucket)).collect()}
        assert {x[0]: rooted.get(x[0], x[0]) for x in signed} == expected
    for most in (0, 1):
        rooted = {r.node: r.root for r in graph.components(S.near_edges(df, most, bucket=2)).collect()}
        assert {x[0]: rooted.get(x[0], x[0]) for x in signed} == components({x[0]: x[0] for x in signed}, most)


def test_edge_cases_and_keep_one(spark):
    long = "word " * 60_000
    docs = spark.createDataFrame(
        [(5, None, 1), (3, "", 2), (7, " \t\n", 3), (8, "one Two", 4), (9, "ONE two", 5), (2, long, 6),
         (2, long, 6), (4, "other text of five words", 7), (None, "other text of five words", 8),
         (None, "nameless alone here", 9), (4, "two rows of one id differ", 10)],
        DOCS + ", kept_id int")
    got = S.near_components(docs.drop("kept_id")).collect()
    assert len(got) == 11
    by = {(r.doc_id, r.text_key): r.component_id for r in got}
    empty = {c for (i, _), c in by.items() if i in (3, 5, 7)}
    assert empty == {3}
    assert {c for (i, _), c in by.items() if i in (8, 9)} == {8}
    kept = S.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "kept_id"]
    rows = sorted((r.doc_id if r.doc_id is not None else 99, r.kept_id) for r in kept.collect())
    assert [r for r in rows if r[0] == 2] == [(2, 6)]          # a repeated row is kept once
    assert [r for r in rows if r[0] in (3, 5, 7)] == [(3, 2)]
    assert (8, 4) in rows and (9, 5) not in rows
    assert (99, 8) not in rows and (99, 9) in rows
    assert len([r for r in rows if r[0] == 4]) == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert S.near_components(docs).count() == 0 and S.keep_one(docs).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[1000 + i] == 1000 for i in range(1, 300))
    assert 5000 not in got


def test_fingerprint_distance_is_what_links(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    rows = S.near_components(docs).select("doc_id", "fp", "component_id").collect()
    for r in rows:
        if r.component_id != r.doc_id:
            assert any(bits(r.fp, o.fp) <= 2 for o in rows if o.doc_id != r.doc_id)
