"""Byte-level BPE over a table of ranks: linear-time encoding by backtracking, and decoding.

A text is cut by the vocabulary's pattern; each piece is encoded on its own.  A piece
that is a token is that token.  Any other piece has its UTF-8 bytes mapped to the
Latin-1 characters of the same numbers, and one pass of an Aho-Corasick automaton finds
the longest token that starts at each byte.  From the left the longest token is taken that may
follow the one before it; where none may, the position is closed for good and the last
choice gives way to the next shorter token (the longest token that is its prefix).
Merging leaves exactly one sequence in which all neighbours are compatible, and one last
token for each prefix of a piece, so every position is closed at most once and the work
is linear in the piece's length.

Two tokens may be neighbours iff no merge across their border comes before the merges
that consume the symbols beside it (at equal rank the leftmost merge is first).
The answer is memoised by the pair.  Tokens that merging their own bytes does not give
take no part but for whole pieces.

Cases: a null or empty text has no tokens and decodes to no bytes; repeated rows each give
a row; a null doc_id is kept; the column ``keep`` names are returned, columns named
``ids`` or ``decoded`` are replaced; an empty table gives an empty result.  The caches are
emptied at ``CACHE_PIECES`` pieces and ``CACHE_PAIRS`` pairs (pieces over
``CACHE_LENGTH`` characters are never cached), which only costs time.
"""

from __future__ import annotations

import base64
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

CACHE_PIECES = 400_000
CACHE_PAIRS = 500_000
CACHE_LENGTH = 64
NEVER = 1 << 30
LATIN = "".join(map(chr, range(256)))


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in file if line.strip())}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that merging the token's bytes joins last; None if it ends otherwise."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, at = min(found)
        if rank >= ranks[token]:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def vocabulary(path: str, pattern: str) -> dict:
    """What tasks need: ranks, each token's last merge, the pattern."""
    ranks = load_ranks(path)
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} lacks tokens of single bytes")
    splits = {}
    for token, rank in ranks.items():
        if len(token) > 1:
            parts = last_merge(token, ranks)
            if parts:
                splits[rank] = (ranks[parts[0]], ranks[parts[1]])
    return {"ranks": ranks, "splits": splits, "pattern": pattern}


def latin_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts of Latin-1 characters, its classes spelled out; None if it has others."""
    def spelled(kind):
        members = [ord(c) for c in LATIN if regex.match(kind, c)]
        runs = [(a, max(b for b in members if b - a == members.index(b) - members.index(a)))
                for i, a in enumerate(members) if not i or members[i - 1] != a - 1]
        return "".join(rf"\x{a:02x}" if a == b else rf"\x{a:02x}-\x{b:02x}" for a, b in runs)

    kinds = {k: spelled(k) for k in (r"\p{L}", r"\p{N}", r"\s")}

    def bare(text):
        for kind, members in kinds.items():
            text = text.replace(kind, members)
        return text

    out = re.sub(r"\[[^\]]*\]", lambda m: bare(m[0]), pattern)
    for kind, members in kinds.items():
        out = out.replace(kind, f"[{members}]")
    out = out.replace(r"\S", f"[^{kinds[chr(92) + 's']}]")
    return None if re.search(r"\\[pPwWdDbB]", out) else re.compile(out)


class Pieces(dict):
    """Piece -> its ids as packed little-endian 32-bit integers; encodes what it lacks."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.encoder.piece(piece), "<u4").tobytes()
        if len(piece) <= CACHE_LENGTH:
            self[piece] = packed
        return packed


class Encoder:
    """Encodes and decodes texts; one per Python worker."""

    def __init__(self, known: dict):
        ranks, splits = known["ranks"], known["splits"]
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        live = {r for r, t in self.tokens.items() if len(t) == 1} | splits.keys()
        for rank, (a, b) in sorted(splits.items(), key=lambda s: len(self.tokens[s[0]])):
            if a not in live or b not in live:
                live.discard(rank)
        self.merged = {parts: rank for rank, parts in splits.items() if rank in live}
        self.parts = {rank: parts for parts, rank in self.merged.items()}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        names = {self.tokens[r].decode("latin-1"): r for r in live}
        for name, rank in names.items():
            self.automaton.add_word(name, rank)
        self.automaton.make_automaton()
        self.shorter = {}                     # token -> the longest token that is its proper prefix
        for name, rank in names.items():
            self.shorter[rank] = next((names[name[:n]] for n in range(len(name) - 1, 0, -1)
                                       if name[:n] in names), -1)
        self.lengths = {rank: len(self.tokens[rank]) for rank in live}
        self.edges: dict[tuple[int, bool], list] = {}
        self.pairs: dict[int, bool] = {}
        self.known = Pieces(self)
        self.cut = regex.compile(known["pattern"])
        self.cut_latin = latin_pattern(known["pattern"])

    def edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """Symbols that stand on one edge of a token while it is made, each with the rank that ends it."""
        out = self.edges.get((token, right))
        if out is None:
            out, at, gone = [], token, NEVER
            while at is not None:
                out.append((at, gone))
                gone, parts = at, self.parts.get(at)
                at = parts and parts[right]
            self.edges[token, right] = out
        return out

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between the two tokens alone."""
        merged, starts = self.merged, self.edge(right, False)
        for x, gone_x in self.edge(left, True):
            for y, gone_y in starts:
                rank = merged.get((x, y))
                if rank is not None and rank < gone_x and rank <= gone_y:
                    return False
        return True

    def piece(self, text: str) -> list[int]:
        """Ids of one piece."""
        raw = text.encode()
        if raw in self.ranks:
            return [self.ranks[raw]]
        lengths, pairs, size = self.lengths, self.pairs, len(raw)
        longest = array("i", [-1]) * (size + 1)
        for end, token in self.automaton.iter(raw.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token      # ends ascend: the longest comes last
        is_open = bytearray(b"\1") * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token >= 0:
                if is_open[at + lengths[token]]:
                    if not out:
                        break
                    pair = out[-1] << 32 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.compatible(out[-1], token)
                    if fits:
                        break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += lengths[token]
                token = longest[at]
            else:
                is_open[at] = 0
                token = out.pop()              # its end is closed now, so it gives way
                at -= lengths[token]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        cut = self.cut
        if self.cut_latin is not None:
            try:
                text.encode("latin-1")
                cut = self.cut_latin
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.known.__getitem__, cut.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids; unknown ids raise KeyError."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _encoder(shared) -> Encoder:
    """The worker's encoder, kept beside the broadcast vocabulary between its tasks."""
    known = shared.value
    if "encoder" not in known:
        known["encoder"] = Encoder(known)
    return known["encoder"]


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) plus ``ids`` binary, and ``decoded`` binary if asked for.

    ``ids`` holds the token ids of ``text`` as little-endian unsigned 32-bit integers;
    ``decoded`` is what ``decode`` makes of them.  The vocabulary's size is fixed, so it is a
    broadcast; only the driver reads its file.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(path, pattern))
    new = ["ids", "decoded"] if decoded else ["ids"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_text"))
    schema = StructType([source.schema[c] for c in kept])
    for name in new:
        schema = schema.add(name, BinaryType())

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            columns = [batch.column(i) for i in range(len(kept))]
            ids = [encoder.encode(t.as_py()) for t in batch.column(len(kept))]
            columns.append(pa.array(ids, pa.binary()))
            if decoded:
                columns.append(pa.array(map(encoder.decode, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=kept + new)

    return source.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str = r"\s+|\S+") -> DataFrame:
    """``tokens`` plus ``decoded`` binary: the bytes of its packed ``ids`` (null: none)."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary(path, pattern))
    kept = [c for c in tokens.columns if c != "decoded"]
    source = tokens.select(*kept, F.coalesce("ids", F.lit(b"")).alias("_ids"))
    schema = StructType([source.schema[c] for c in kept]).add("decoded", BinaryType())

    def run(batches):
        known = {rank: token for token, rank in shared.value["ranks"].items()}
        for batch in batches:
            columns = [batch.column(i) for i in range(len(kept))]
            columns.append(pa.array((b"".join(map(known.__getitem__, np.frombuffer(x.as_py(), "<u4").tolist()))
                                     for x in batch.column(len(kept))), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "decoded"])

    return source.mapInArrow(run, schema)
