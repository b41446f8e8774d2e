"""BPE encoding by trie traversal over distinct words, and decoding.

Words are encoded once per task and cache: the distinct new words of a batch
are sorted, which is the depth-first order of their prefix trie, and a stack
holds the state of the current path.  The state of a prefix is its last
token.  A prefix ends in token t iff t is a suffix of it and t may follow the
last token of what is left; that is decided from the node above, so a shared
prefix is encoded once.  Walking the last tokens back from a word's end gives
its token ids.

Two tokens may be neighbours iff no merge joins them before both are done:
for the symbols on the left token's right edge and on the right token's left
edge, a pair's merge must not rank before the merges that consume them (at a
tie the leftmost merge goes first).

Text handling follows the vocabulary's own settings: NFC, white space to one
space, lower case by character, contractions / letters / single numerals /
other marks, bytes as printable characters, ``</w>`` after a word's last.
Special tokens in a text become their ids.  Decoding joins the token strings
by one space, as the vocabulary names no decoder.

Cases: null or empty text has no tokens and decodes to the empty string;
repeated rows each give a row; a null doc_id is kept; extra columns are kept by
``encode``.  The word cache is emptied when it exceeds ``CACHE_WORDS`` (words over
``CACHE_LENGTH`` characters are never cached), which only costs time.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from typing import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 250_000
CACHE_PAIRS = 500_000
CACHE_LENGTH = 64
NEVER = 1 << 30

# The vocabulary's own pre-tokenisation pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same over lower-cased Latin-1, its letters and numerals spelled out (about three times faster).
LATIN_WORDS = ("[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]"
               "|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾\\t-\\r \\x85\\xa0]+")


def byte_letters() -> dict[int, str]:
    """Printable stand-in for each byte: printable Latin-1 is itself, the rest follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> dict:
    """What tasks need of a vocabulary file: token ids, merges by rank, special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "suffix": model["end_of_word_suffix"] or "",
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class Encoder:
    """Token ids of words, by prefix states; one per Python worker."""

    def __init__(self, vocabulary: dict):
        self.ids = vocabulary["vocab"]
        self.suffix = vocabulary["suffix"]
        self.names = {i: t for t, i in self.ids.items()}
        self.special = vocabulary["special"]
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.rank: dict[tuple[int, int], int] = {}
        self.right: dict[int, list] = {}      # token -> [(symbol on its right edge, consumed at)]
        self.left: dict[int, list] = {}
        self.pairs: dict[int, bool] = {}
        self.numbered: dict[str, str] = {}     # word -> its ids, joined by a space
        self.known: dict[str, str] | None = None   # id as text -> token string
        whole = set(self.ids.values())
        parts = {}
        for at, (a, b) in enumerate(vocabulary["merges"]):
            a, b, ab = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[a, b] = at
            parts[ab] = (a, b, at)
        for token in whole - parts.keys():
            self.right[token] = self.left[token] = [(token, NEVER)]
        for token, (a, b, at) in parts.items():   # parts come before what they make
            self.right[token] = [(token, NEVER)] + [(s, at if e == NEVER else e)
                                                    for s, e in self.right[b]]
            self.left[token] = [(token, NEVER)] + [(s, at if e == NEVER else e)
                                                   for s, e in self.left[a]]
        # a token that merges never reach is no encoding of its own string
        dead = {t for t, (a, b, at) in parts.items() if not self._free(a, b, at)}
        for token, (a, b, _) in parts.items():
            if a in dead or b in dead:
                dead.add(token)
        end = len(self.suffix)
        ends = {i for t, i in self.ids.items() if end and t.endswith(self.suffix)}
        self.inner = self._suffixes({t: i for t, i in self.ids.items()
                                     if i not in dead and i not in ends})
        self.last = self._suffixes({t[:-end]: i for t, i in self.ids.items()
                                    if i not in dead and i in ends}) if end else self.inner
        split = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({split})") if split else None
        self.words = regex.compile(WORDS)
        self.latin = re.compile(LATIN_WORDS)
        self.numbers = {i: str(i) for i in self.names}

    @staticmethod
    def _suffixes(tokens: dict[str, int]) -> dict[str, int]:
        """Every suffix of a token -> its id, or -1 where the suffix is no token itself."""
        out = {t[i:]: -1 for t in tokens for i in range(len(t))}
        return out | tokens

    def _free(self, a: int, b: int, done: int = NEVER) -> bool:
        """Whether a and b can stand side by side until the merge ranked ``done``."""
        rank = self.rank
        for x, gone_x in self.right[a]:
            for y, gone_y in self.left[b]:
                at = rank.get((x, y))
                if at is not None and at < min(gone_x, done) and at <= gone_y and at < done:
                    return False
        return True

    def _state(self, table: dict, path: str, size: int, states: list) -> tuple[int, int]:
        """(last token, its length) of the prefix of ``size`` letters; states holds the shorter ones.

        Exactly one suffix token may follow what is left; longer ones are likelier.
        """
        found = []
        for at in range(size - 1, -1, -1):
            token = table.get(path[at:size])
            if token is None:
                break
            if token >= 0:
                found.append((token, at))
        pairs = self.pairs
        for token, at in reversed(found):
            if not at:
                return token, size
            key = states[at][0] << 20 | token
            free = pairs.get(key)
            if free is None:
                free = pairs[key] = self._free(states[at][0], token)
            if free:
                return token, size - at
        raise ValueError(f"no token ends {path[:size]!r}")

    def learn(self, words) -> None:
        """Cache the encodings of new words, walking their trie depth-first."""
        spelled = sorted((w if w.isascii() and w.isprintable()
                          else w.encode().decode("latin-1").translate(self.letters), w)
                         for w in words)
        states: list[tuple[int, int]] = [(-1, 0)]
        before = ""
        for path, word in spelled:
            shared = 0
            for x, y in zip(before, path):
                if x != y:
                    break
                shared += 1
            inner_end = len(path) - 1 if self.suffix else len(path)
            del states[min(shared, inner_end) + 1:]
            for size in range(len(states), inner_end + 1):
                states.append(self._state(self.inner, path, size, states))
            token, length = (self._state(self.last, path, len(path), states) if self.suffix
                             else states[len(path)])
            out, at = [], len(path)
            while True:
                out.append(token)
                at -= length
                if not at:
                    break
                token, length = states[at]
            out.reverse()
            self.numbered[word] = " ".join([self.numbers[i] for i in out])
            before = path

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text in order (specials as they are written)."""
        if self.specials is None or "<" not in text:
            return self._words(text)
        out = []
        for part in self.specials.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self._words(part)
        return out

    def _words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")   # lower case by character
            return self.words.findall(text.lower())
        return self.latin.findall(text.lower())

    def encode(self, texts: list[str], decoded: bool = True) -> list[tuple[int, str, str]]:
        """Per text: token count, ids joined by a space, decoded text (empty unless asked for)."""
        if len(self.numbered) > CACHE_WORDS:
            self.numbered.clear()
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        split = [self.split(t) for t in texts]
        new = set().union(*split).difference(self.numbered)
        specials = new.intersection(self.special)
        self.learn(new - specials)
        for w in specials:
            self.numbered[w] = str(self.special[w])
        out = []
        number = self.numbered.__getitem__
        for words in split:
            ids = " ".join(map(number, words))
            out.append((ids.count(" ") + 1 if ids else 0, ids,
                        self.decode(ids.split()) if decoded else ""))
        for w in new:
            if len(w) > CACHE_LENGTH:
                del self.numbered[w]
        return out

    def decode(self, ids) -> str:
        """Token strings of the ids (as decimal text) joined by a space; unknown ids are skipped."""
        if self.known is None:
            self.known = {str(i): s for i, s in self.names.items()} \
                | {str(i): s for s, i in self.special.items()}
        known = self.known
        return " ".join([known[i] for i in ids if i in known])


def _batches(texts: list[str], most: int = 1 << 20):
    """Lists of texts with about ``most`` characters together (a longer text alone)."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


_ENCODERS: dict = {}


def _encoder(shared) -> Encoder:
    """One encoder a worker process and vocabulary, kept between tasks."""
    vocabulary = shared.value
    key = vocabulary["key"]
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def _shared(spark, path: str):
    """The vocabulary file as a broadcast: its size is fixed, whatever the corpus."""
    vocabulary = load_vocabulary(path)
    vocabulary["key"] = hashlib.sha256(json.dumps(vocabulary).encode()).hexdigest()
    return spark.sparkContext.broadcast(vocabulary)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``."""
    shared = _shared(docs.sparkSession, path)

    def run(batches):
        encoder = _encoder(shared)
        for pdf in batches:
            rows = []
            for part in _batches(pdf["text"].tolist()):
                rows += [(n, hashlib.sha256(ids.encode()).hexdigest(),
                          hashlib.sha256(decoded.encode()).hexdigest())
                         for n, ids, decoded in encoder.encode(part)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [r[0] for r in rows],
                                "ids_sha256": [r[1] for r in rows],
                                "decoded_sha256": [r[2] for r in rows]})

    # doc_id passes as text: pandas would turn a nullable long into a double
    out = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text")) \
              .mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, "
                                "decoded_sha256 string")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` plus ``token_ids`` array<int>: the token ids of each text, in order."""
    shared = _shared(docs.sparkSession, path)

    @F.pandas_udf("string")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                yield pd.Series([x[1] for part in _batches(texts.tolist())
                                 for x in _encoder(shared).encode(part, decoded=False)], dtype=object)
        finally:
            # workers live on into other operators, which then have to fit beside these tables
            _ENCODERS.clear()

    joined = ids(F.coalesce(F.col("text"), F.lit("")))
    return docs.withColumn("_token_text", joined).withColumn(
        "token_ids", F.when(F.col("_token_text") == "", F.array().cast("array<int>"))
        .otherwise(F.split("_token_text", " ").cast("array<int>"))).drop("_token_text")


def decode(tokens: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """``tokens`` plus ``decoded`` string: token strings joined by a space; unknown ids are skipped."""
    shared = _shared(tokens.sparkSession, path)

    @F.pandas_udf("string")
    def names(ids: pd.Series) -> pd.Series:
        encoder = _encoder(shared)
        return pd.Series(["" if x is None else encoder.decode(map(str, x)) for x in ids], dtype=object)

    return tokens.withColumn("decoded", names(F.col(column)))
