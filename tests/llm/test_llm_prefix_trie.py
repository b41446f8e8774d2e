import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from fundflow.llm import prefix_trie as S
from fundflow.llm import registry
from fundflow.llm.common import table

CONV = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def _sequences(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, _digest(role or "", text or ""),
                                            role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return out


def _brute(sequences):
    """Top-down over every prefix: the definition, for small inputs."""
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p] for p in members}

    def below(p):
        return [p] + [x for q in children[p] for x in below(q)]

    out = set()
    for p, cs in members.items():
        sub = below(p)
        words = lambda q: len(re.findall("[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(sequences[c]) == len(p)))
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]),
                 sum(not children[q] for q in sub), sum((len(members[q]) - 1) * words(q) for q in sub),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _trie(spark, rows):
    df = spark.createDataFrame(rows, CONV)
    got = [tuple(r[c] for c in COLUMNS) for r in S.trie(S.rebuilt(S.turns_of(df))).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_whole_table_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_ORACLE, "conversations").collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in registry.queries()["op11_prefix_trie"](spark, SF_ORACLE).collect()]
    assert set(got) == _brute(_sequences(rows)) and len(got) == len(set(got))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations_with_shared_beginnings(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(60), rng.choice([None, 0, 1, 2, 3, 4]), rng.choice(["user", "assistant", None, ""]),
             rng.choice([None, "", "a b c", "hello\tthere", "x"])) for _ in range(220)]
    assert _trie(spark, rows) == _brute(_sequences(rows))


def test_copies_prefixes_and_hot_first_turn(spark):
    rows = []
    for c in range(0, 4000, 20):                      # group heads: their own turns stay as they are
        for turn in range(1 + (c // 20) % 3):
            rows.append((c, turn, "user", f"same words {turn}"))
        if c % 100 == 0:
            rows.append((c, 9, "assistant", f"own {c}"))
    want = _brute(_sequences(rows))
    assert _trie(spark, rows) == want
    root = next(r for r in want if r[1] == 0)
    assert root[3] == 200 and root[4] == 1


def test_turnless_conversations_belong_to_the_root(spark):
    ids = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:5]
    rows = [(c, 0, "user", "gone") for c in ids]       # the group's first conversation is absent
    got = _trie(spark, rows)
    assert got == {(ids[0], 0, None, 5, 0, 1, 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())}


def test_end_lists_beyond_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_IDS", 7)
    rows = [(c, 0, "user", "hot") for c in range(0, 12_000, 20)] + [(-40, 0, "user", "hot")]
    assert _trie(spark, rows) == _brute(_sequences(rows))


def test_edge_cases(spark):
    rows = [(None, 0, "user", "nobody"), (0, None, None, None), (0, 1, "user", "long é " * 60_000),
            (0, 1, "user", "tie"), (0, 1, "user", "tie"), (20, None, "", "")]
    rows += [(40, i, "user", f"turn {i}") for i in range(300)]
    assert _trie(spark, rows) == _brute(_sequences(rows))
    assert S.trie(S.rebuilt(S.turns_of(spark.createDataFrame([], CONV)))).count() == 0
    wide = spark.createDataFrame([(0, 0, "user", "x", b"k", 3)], CONV + ", digest binary, depth int")
    assert [tuple(r)[:2] for r in S.trie(S.rebuilt(S.turns_of(wide))).orderBy("depth").collect()] == [(0, 0), (0, 1)]


def test_extra_columns_of_other_types(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], CONV).withColumn("key", F.array(F.lit(1)))
    assert S.trie(S.rebuilt(S.turns_of(df))).count() >= 1
