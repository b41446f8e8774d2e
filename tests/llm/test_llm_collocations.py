import random
import re
from collections import Counter

import pytest

from fundflow.llm import collocations as S

DOCS = "doc_id long, text string, lang string"


def _phrases(docs):
    f, n = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f, n


def _brute(docs, threshold=10, most=2000):
    f, n = _phrases(docs)
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= threshold}
    out = set()
    for lang in {p[0] for p in cand}:
        rows = []
        for p, a in cand.items():
            if p[0] != lang:
                continue
            cuts = [(10 ** 6 * a * a // (f[p[:k + 1]] * f[(lang, *p[k + 1:])]), k, f[p[:k + 1]], f[(lang, *p[k + 1:])])
                    for k in range(1, len(p) - 1)]
            longer = [b for q, b in cand.items() if len(q) > len(p) and q[0] == lang
                      and (q[1:3] == p[1:] or q[2:4] == p[1:]) and 100 * b >= 50 * a]
            if not longer:
                score, k, left, right = min(cuts)
                rows.append((-score, -a, " ".join(p[1:]).encode(), left, right, k))
        for rank, (s, a, phrase, left, right, k) in enumerate(sorted(rows)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -s, k))
    return out


def _docs(seed, count=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["New", "york", "City", "é", "ß"]
    out = []
    for i in range(count):
        text = ""
        for _ in range(rng.randrange(12)):
            text += rng.choice(words) if rng.random() < .6 else rng.choice(["new york city", "a b", "x  y\tz"])
            text += rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "\x0b"])
        out.append((i, text, rng.choice(["en", "en", "de", None, "en x"])))
    return out


def _run(spark, docs, **more):
    return {tuple(r) for r in S.collocations(spark.createDataFrame(docs, DOCS), **more).collect()}


@pytest.mark.parametrize("shards", [1, 2, 3])
def test_any_number_of_shards_gives_the_brute_force_rows(spark, shards):
    docs = _docs(shards)
    assert _run(spark, docs, shards=shards) == _brute(docs)


def test_shared_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_BITS", 2)
    docs = _docs(9)
    assert _run(spark, docs) == _brute(docs)


def test_runs_and_slices_cut_no_phrase(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 5)
    monkeypatch.setattr(S, "SLICE", 7)
    docs = _docs(6)
    assert _run(spark, docs) == _brute(docs)


def test_phrases_that_reach_the_threshold_late(spark):
    """Words that become frequent only in the last shard are counted back through the first."""
    docs = [(i, "late one two", "en") for i in range(11)] + [(100 + i, "two late. one", "en") for i in range(9)]
    assert _run(spark, docs, shards=3) == _brute(docs)
    assert any(r[2] == "late one two" for r in _run(spark, docs, shards=3))


def test_ties_ranks_and_limit(spark):
    docs = [(i, "b c. a d, É f; z z z z", "en") for i in range(12)]
    want = _brute(docs, most=2)
    assert _run(spark, docs, most=2) == want and len(want) == 2
    assert _run(spark, docs) == _brute(docs)


def test_exact_arithmetic_past_64_bits(spark):
    a, b, c = 3_000_000_000_019, 4_000_000_000_007, 5_000_000_000_011
    row = spark.sql(f"select (1000000bd * ({a}bd * {a}bd)) div ({b}bd * {c}bd) as score").first()
    assert row.score == 10 ** 6 * a * a // (b * c)


def test_hot_words_and_copies(spark):
    docs = [(i, "the the the of the. hot pair here", "en") for i in range(3000)] + _docs(4, 60)
    assert _run(spark, docs) == _brute(docs)


def test_edge_cases(spark):
    docs = [(None, "x y " * 20, None), (None, "x y " * 20, None), (1, None, "en"), (1, "", "en"), (2, " \t\n.,", "de"),
            (3, "long word " * 50_000, "fr"), (4, "one", "es")]
    assert _run(spark, docs) == _brute(docs)
    wide = spark.createDataFrame([(1, "p q. " * 12, "en", "k", 3, 4)], DOCS + ", key string, size int, start int")
    assert S.collocations(wide).count() == 1
    assert S.collocations(spark.createDataFrame([], DOCS)).count() == 0
