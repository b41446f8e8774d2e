import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundflow.llm import bpe
from fundflow.llm.common import table
from fundflow.llm.registry import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_vocabulary(PATH))


def _same(library, encoder, texts):
    for text, (n, ids, decoded) in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert (n, ids) == (len(want), " ".join(map(str, want))), text
        assert decoded == library.decode(want, skip_special_tokens=False), text


def test_random_texts_like_the_library(library, encoder):
    rng = random.Random(4)
    parts = [*"abAB 'éÉßΣσςİıKḰẞ123٣½²Ⅷ\n\t \u0085​\u001c\u0000!?<>|_-…😀字日﻿ﬁ",
             "<|endoftext|>", "<|startoftext|>", "<|endoftext", "'ll", "'S", "don't", "the ", "ing", "aaaa", "ªµº"]
    _same(library, encoder, ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(5000)])


def test_long_words_and_texts(library, encoder):
    _same(library, encoder, ["a" * 5000, "ab" * 3000 + " x", "é" * 2000, "!" * 999, "word " * 20000, ""])


def test_cache_overflow_changes_nothing(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    texts = ["one two three four five six seven", "one two eight nine ten", "eleven twelve one"]
    for t in texts:
        _same(library, encoder, [t])


def test_whole_table_digests(spark, library):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    got = {r.doc_id: r for r in bpe.digests(docs, PATH).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in docs.collect():
        ids = library.encode(d.text, add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_edge_rows_and_round_trip(spark, library):
    docs = spark.createDataFrame([(1, None, "k"), (None, "", "k"), (3, "Hello, World!", "k"), (3, "Hello, World!", "k")],
                                 "doc_id long, text string, token_text string").drop("token_text") \
                .withColumn("extra", F.lit("e"))
    rows = bpe.digests(docs, PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_tokens) for r in rows if r.doc_id is not None) == [
        (False, 1, 0), (False, 3, 4), (False, 3, 4)]
    assert [r.n_tokens for r in rows if r.doc_id is None] == [0]
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "text", "extra", "token_ids"]
    for r in bpe.decode(encoded, PATH).collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_wrong_ids_show_up_in_the_decoded_text():
    encoder = bpe.Encoder(bpe.load_vocabulary(PATH))
    (_, right, name), = encoder.encode(["hello"])
    other = next(str(i) for i in encoder.names if str(i) != right)
    encoder.numbered["hello"] = other
    (_, ids, decoded), = encoder.encode(["hello"])
    assert ids == other and decoded == encoder.names[int(other)] != name
