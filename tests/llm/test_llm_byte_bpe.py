import random
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_ORACLE
from fundflow.llm import byte_bpe as S
from fundflow.llm import registry
from fundflow.llm.common import table

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=S.load_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return S.Encoder(S.vocabulary(PATH, PATTERN))


def _ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_whole_table_against_the_library(spark, library):
    import hashlib
    docs = {r.doc_id: r.text or "" for r in table(spark, SF_ORACLE, "documents").collect()}
    rows = registry.queries()["op12_byte_bpe"](spark, SF_ORACLE).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="etaoin shrdlu'sé ñß漢字😀\n\t 12", max_size=200),
                 st.text(alphabet=[chr(i) for i in range(256)], max_size=60)))
def test_random_texts(library, encoder, text):
    packed = encoder.encode(text)
    assert _ids(packed) == library.encode_ordinary(text)
    assert encoder.decode(packed) == text.encode()


def test_pieces_without_white_space(library, encoder):
    rng = random.Random(3)
    for alphabet in ("ab", "thein", "aé", "漢字한", "=-_"):
        for size in (1, 2, 50, 500):
            text = "".join(rng.choices(alphabet, k=size))
            assert _ids(encoder.encode(text)) == library.encode_ordinary(text)


def test_very_long_pieces_take_linear_time(library, encoder):
    for text in ("ab" * 100_000, "a" * 200_001, "é" * 100_000):
        assert _ids(encoder.encode(text)) == library.encode_ordinary(text)


def test_pattern_without_a_latin_form_and_emptied_caches(library, monkeypatch):
    assert S.latin_pattern(r"\p{Lu}+|\s+") is None
    monkeypatch.setattr(S, "CACHE_PIECES", 2)
    monkeypatch.setattr(S, "CACHE_PAIRS", 2)
    encoder = S.Encoder(S.vocabulary(PATH, PATTERN))
    for text in ["unbelievably strange wordings", "über allen Gipfeln", ""] * 3:
        assert _ids(encoder.encode(text)) == library.encode_ordinary(text)


def test_unreachable_tokens_are_whole_pieces_only(tmp_path):
    import base64
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"cd": 259, b"bcd": 260}
    path = tmp_path / "r"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in ranks.items()))
    pattern = r"[a-z]+|[^a-z]+"
    known = tiktoken.Encoding("o", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    encoder = S.Encoder(S.vocabulary(str(path), pattern))
    rng = random.Random(1)
    for text in ["bcd", "abcd", "xbcd", "bcdx"] + ["".join(rng.choices("abcdx", k=9)) for _ in range(300)]:
        assert _ids(encoder.encode(text)) == known.encode_ordinary(text)


def test_edge_cases(spark, library):
    docs = spark.createDataFrame(
        [(1, None, 5, b"x"), (None, "a b", 6, b"x"), (2, "", 7, None), (2, "dup", 8, b""), (2, "dup", 8, b"")],
        "doc_id long, text string, n_tokens int, ids binary")
    rows = S.encode(docs, PATH, PATTERN, decoded=True).collect()
    assert [(r.doc_id, r.text, r.n_tokens) for r in rows] == [(r.doc_id, r.text, r.n_tokens) for r in docs.collect()]
    for r in rows:
        assert _ids(r.ids) == library.encode_ordinary(r.text or "") and r.decoded.decode() == (r.text or "")
    encoded = S.encode(docs, PATH, PATTERN, keep=["doc_id", "text"])
    assert [r.decoded.decode() for r in S.decode(encoded, PATH).collect()] == ["", "a b", "", "dup", "dup"]
    assert S.encode(docs.filter("false"), PATH, PATTERN).count() == 0
