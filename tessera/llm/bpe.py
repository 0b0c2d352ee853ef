"""Byte-level BPE: linear-time encoding by backtracking, and decoding.

Tokens are mapped byte by byte to Latin-1 strings, so that one Aho-Corasick
automaton (pyahocorasick) finds the longest token at every position.  A piece
is encoded left to right with the longest match; a token is accepted only if
it is compatible with the token before it (their concatenation merges back to
exactly these two), otherwise the next shorter token is tried, and dead
positions are remembered.  Compatibility of adjacent tokens is memoised.  The
result equals applying the merges in rank order.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textops as tx

CACHE_PIECES = 100_000    # encoded pieces remembered per worker, twice
CACHED_CHARS = 64         # longer pieces are not remembered
CACHE_PAIRS = 500_000     # compatibility answers remembered per worker


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.split = regex.compile(pattern).findall
        self.tokens = dict(sorted((r, t) for t, r in ranks.items()))
        self.size = [0] * (max(self.tokens, default=0) + 1)
        for rank, token in self.tokens.items():
            self.size[rank] = len(token)
        self.ranks = ranks
        self.match = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.match.add_word(token.decode("latin-1"), rank)
        self.match.make_automaton()
        self.halves: dict[int, tuple[int, int]] = {}
        self.shorter: list[int | None] = [None] * len(self.size)
        self.pairs: dict[int, bool] = {}              # left << 32 | right
        self.cache: dict[str, bytes] = {}             # pieces used lately,
        self.older: dict[str, bytes] = {}             # and before that

    # -- the merge that made a token, found once per token -----------------
    def halves_of(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge gives ``token`` (itself twice: a byte)."""
        got = self.halves.get(token)
        if got is None:
            parts = self.merged(self.tokens[token], self.ranks[self.tokens[token]])
            got = tuple(parts) if len(parts) == 2 else (token, token)
            self.halves[token] = got
        return got

    def merged(self, text: bytes, below: int) -> list[int]:
        """Merge ``text`` in rank order, only with ranks under ``below``."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` next to ``right`` untouched.

        Undo merges from the later one down: if at any point the two inner
        neighbours would have merged earlier than the merges that hide them,
        the pair cannot stand in a result.
        """
        got = self._compatible(left, right)
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[left << 32 | right] = got
        return got

    def _compatible(self, left: int, right: int) -> bool:
        ranks, tokens = self.ranks, self.tokens
        limit = 1 << 62
        while True:
            joined = ranks.get(tokens[left] + tokens[right])
            if joined is not None and joined < limit:
                return False
            if left > right:
                limit = left
                first, inner = self.halves_of(left)
                if first == left:                     # a single byte
                    limit = right + 1
                    right, other = self.halves_of(right)
                    if right + 1 == limit:
                        return True
                else:
                    left = inner
            else:
                limit = right + 1
                inner, other = self.halves_of(right)
                if inner == right:
                    limit = left
                    first, inner = self.halves_of(left)
                    if first == left:
                        return True
                    left = inner
                else:
                    right = inner

    def prefix_token(self, token: int) -> int:
        """The longest shorter token that starts ``token`` (-1: none)."""
        got = self.shorter[token]
        if got is None:
            text, got = self.tokens[token], -1
            for n in range(len(text) - 1, 0, -1):
                rank = self.ranks.get(text[:n])
                if rank is not None:
                    got = rank
                    break
            self.shorter[token] = got
        return got

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one pre-split piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        # The longest token starting at each position; matches come by their end.
        longest = [-1] * n
        size, known, shorter = self.size, self.pairs.get, self.shorter
        for last, rank in self.match.iter(piece.decode("latin-1")):
            longest[last + 1 - size[rank]] = rank     # later ends are longer
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token, before = 0, longest[0], -1
        while True:
            while token >= 0:
                end = at + size[token]
                if not dead[end]:
                    if before < 0:
                        break
                    fits = known(before << 32 | token)
                    if fits is None:
                        fits = self.compatible(before, token)
                    if fits:
                        break
                less = shorter[token]
                token = self.prefix_token(token) if less is None else less
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, before, token = end, token, longest[end]
            else:
                dead[at] = 1
                if not out:
                    raise ValueError("the rank file lacks single bytes of this text")
                token = out.pop()
                at -= size[token]
                before = out[-1] if out else -1
                token = self.prefix_token(token)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        pieces = self.split(text)
        out = list(map(self.cache.get, pieces))
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    out[i] = self._packed(pieces[i])
        return b"".join(out)

    def _packed(self, piece: str) -> bytes:
        ids = self.cache.get(piece) or self.older.get(piece)
        if ids is None:
            ids = array("I", self.encode_piece(piece.encode()))
            if sys.byteorder == "big":
                ids.byteswap()
            ids = ids.tobytes()
        if len(self.cache) >= CACHE_PIECES:
            self.older, self.cache = self.cache, {}
        if len(piece) <= CACHED_CHARS:
            self.cache[piece] = ids
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, built once per worker process."""
    if (path, pattern) not in _CODECS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        _CODECS[path, pattern] = Codec(ranks, pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """Encode every whole ``text`` and decode it again.

    One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and,
    with ``with_ids``, ``token_ids``.  Null and empty texts have no tokens.
    The rank file is an installed file of every worker, named by ``path``.
    One narrow pass: no shuffle, rows stream through Arrow batches.
    """
    def run(batches):
        c = codec(path, pattern)
        for part, _, _ in tx.pieces(batches, "text"):
            counts, ids_hash, text_hash, ids = [], [], [], []
            for text in part.column(1).to_pylist():
                packed = c.encode(text) if text else b""
                counts.append(len(packed) // 4)
                ids_hash.append(hashlib.sha256(packed).hexdigest())
                text_hash.append(hashlib.sha256(c.decode(packed)).hexdigest())
                ids.append(packed)
            cols = [part.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash),
                    pa.array(text_hash)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(tx.lists(np.frombuffer(b"".join(ids), "<u4").astype(np.int32),
                                     np.array(counts, np.int64), pa.int32()))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", token_ids array<int>"
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, token_ids)``; null ids give null.
    Ids that do not form valid UTF-8 decode with replacement characters."""
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            texts = [None if ids is None else
                     c.decode(np.array(ids, "<u4").tobytes()).decode("utf-8", "replace")
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "token_ids").mapInArrow(
        run, "doc_id long, text string")
