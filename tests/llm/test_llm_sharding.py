import zlib

import numpy as np
from llm_brute import jump
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundflow.llm import sharding as S
from fundflow.llm.common import table

DOCS = "doc_id long, text string"


def test_jump_like_the_definition():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for shards in (1, 2, 40, 41, 5000):
        assert S.jump(keys, shards).tolist() == [jump(int(k), shards) for k in keys]


def test_whole_table(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    keys = {r.doc_id: r.h & ((1 << 64) - 1) for r in docs.select(
        "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = S.assign(docs, shards=40).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (jump(keys[r.doc_id], 40), jump(keys[r.doc_id], 41))
        assert r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edge_cases(spark):
    long = "é" * 300_000
    rows = [(1, None), (1, None), (1, ""), (None, "x"), (None, "x"), (-5, long)] + [(9, "same")] * 50
    docs = spark.createDataFrame([(*r, "q", 3) for r in rows], DOCS + ", law string, bucket int")
    out = S.assign(docs, shards=3)
    assert out.columns == ["doc_id", "bucket", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    assert len(got) == len(rows)
    for shard in {r.shard for r in got}:
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
    for key in (1, None, 9):
        assert len({r.shard for r in got if r.doc_id == key}) == 1
    assert {(r.size, r.text_crc32) for r in got if r.doc_id == 1} == {(16, 0)}
    assert [r.size for r in got if r.doc_id == -5] == [600_016]
    assert S.assign(spark.createDataFrame([], DOCS)).count() == 0
