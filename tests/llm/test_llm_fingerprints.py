import hashlib
import random

from llm_brute import MASK, bits, weighted_simhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundflow.llm import fingerprints as S
from fundflow.llm.common import table


def _expected(rows):
    """{doc_id: (n_chars, sha256, fp, edited fp, next fp)} from (doc_id, text) rows."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (-x[0], x[1]))
    out = {}
    for at, (i, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        k = len(text) // 3
        edited = text[:len(text) - k] + following[:k]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), weighted_simhash(text),
                  weighted_simhash(edited), weighted_simhash(following))
    return out


def test_whole_table_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    expected = _expected([tuple(r) for r in docs.collect()])
    got = S.with_neighbours(S.compare(docs), F.col("doc_id") % 10 == 0).collect()
    assert len(got) == len(expected)
    for r in got:
        n, digest, fp, edited, following = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fp & MASK, r.edited_fp & MASK) == (n, digest, fp, edited)
        assert r.near_edited == 1 - bits(fp, edited) / 64 and r.near_next == 1 - bits(fp, following) / 64
        if r.doc_id % 10 == 0:
            assert r.near_docs == sum(bits(fp, e[2]) <= S.RADIUS for e in expected.values()) - 1
        else:
            assert r.near_docs is None
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)


def test_permuted_tables_find_all_within_radius(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for flips in range(1, 6):
            fps.add(b ^ sum(1 << x for x in rng.sample(range(64), flips)))
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    all_fps = spark.createDataFrame([(sign(x),) for x in fps], "fp long")
    asked = spark.createDataFrame([(sign(x),) for x in base], "fp long")
    for radius, blocks in ((3, 5), (1, 4), (0, 1)):
        got = [(r.query_fp, r.fp, r.bits) for r in S.near(all_fps, asked, radius, blocks).collect()]
        want = {(sign(a), sign(b), bits(a, b)) for a in base for b in fps if bits(a, b) <= radius}
        assert len(got) == len(set(got)) and set(got) == want


def test_edge_cases(spark):
    long = "é😀 long " * 30_000
    rows = [(10, None), (7, ""), (3, "😀é abc"), (1, long), (-4, "same text here"), (20, "same text here")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, rn int")
    expected = _expected(rows)
    got = {r.doc_id: r for r in S.compare(docs).collect()}
    for i, (n, digest, fp, edited, _) in expected.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fp & MASK, r.edited_fp & MASK) == (n, digest, fp, edited)
    assert got[20].fp == got[-4].fp and got[10].fp == 0


def test_repeated_null_and_single_rows(spark):
    schema = "doc_id long, text string"
    rows = S.compare(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c d"), (None, None)], schema)).collect()
    assert len(rows) == 4
    one = S.compare(spark.createDataFrame([(1, "abc def")], schema)).first()
    assert one.near_next == 1.0 and one.n_chars == 7
    assert S.compare(spark.createDataFrame([], schema)).count() == 0


def test_buckets_are_even_in_bytes(spark, monkeypatch):
    """Ids whose texts are long share no bucket with many others, also where tasks are sized by bytes."""
    monkeypatch.setattr(S, "LEAST_BUCKETS", 2)
    monkeypatch.setattr(S, "BYTES_PER_BUCKET", 20_000)
    monkeypatch.setattr(S, "BYTES_PER_TASK", 20_000)
    texts = [(i, f"short {i}" if i < 300 else "long text " * 1000) for i in range(320)]
    rows = S.with_next(spark.createDataFrame(texts, "doc_id long, text string")).filter("not lent").collect()
    held = {}
    for r in rows:
        held[r.bucket] = held.get(r.bucket, 0) + len(r.text)
    assert len(rows) == len(texts) and max(held.values()) <= 40_000
    following = {i: dict(texts)[(i - 1) % len(texts)] for i, _ in texts}
    assert {r.doc_id: r.next_text for r in rows} == following
