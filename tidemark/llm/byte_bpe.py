"""Byte-level BPE encoding and decoding by dynamic programming over byte prefixes.

Every byte prefix of a piece has exactly one valid encoding, so it is enough to store each prefix's *last
token*.  The last token of a prefix ending at ``e`` is the token ``t = data[e-l:e]`` that encodes to itself
and may follow the last token of the prefix ending at ``e-l``; "may follow" means that merging the bytes of
both by rank gives back exactly these two.  Appending bytes extends the table; after an edit the table is
recomputed from the edit on, until it agrees with the old one over the longest token's length.

Texts are split by the tokenizer's pattern, each match encoded separately, without special tokens.  Null and
empty texts encode to no ids and decode to empty bytes.  One output row per input row, repeated rows included.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, list_array, per_document, table

VOCABULARY = "byte_bpe_50k.tiktoken"
# Pieces up to this length are remembered per worker, at most twice this many.
CACHE_PIECE, CACHE_SIZE = 48, 380_000
KEPT_PREFIX = 16


NONE = 1 << 60   # rank of a pair that does not merge
TAIL = 4


class PrefixBpe:
    """The vocabulary (token bytes -> rank) and the "may follow" relation, learnt pair by pair."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.length = {i: len(b) for b, i in ranks.items()}
        self._follows: dict[int, bool] = {}
        self._prefixes: dict[bytes, list[int]] = {}
        # only tokens that encode to themselves can occur
        self.whole = {b: i for b, i in ranks.items() if self.merge(b) == [i]}
        # the longest token that ends with these TAIL bytes; no token longer than the tail ends with others
        self.longest_with: dict[bytes, int] = {}
        for b in self.whole:
            if len(b) >= TAIL:
                self.longest_with[b[-TAIL:]] = max(len(b), self.longest_with.get(b[-TAIL:], 0))

    def merge(self, data: bytes) -> list[int]:
        """Plain merging of the lowest-ranked pair; used on single tokens and pairs only."""
        ranks, parts = self.ranks, [data[i:i + 1] for i in range(len(data))]
        scores = [ranks.get(data[i:i + 2], NONE) for i in range(len(data) - 1)]
        while scores:
            low = min(scores)
            if low == NONE:
                break
            i = scores.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], NONE)
        return [ranks[p] for p in parts]

    def follows(self, left: int, right: int) -> bool:
        got = self._follows.get(left << 32 | right)
        if got is None:
            if len(self._follows) > 1_000_000:
                self._follows.clear()
            merged = self.merge(self.tokens[left] + self.tokens[right])
            got = self._follows[left << 32 | right] = merged == [left, right]
        return got

    def extend(self, data: bytes, last: list[int], stop: int) -> None:
        """Append to ``last``, which holds the last token of each prefix so far, those of the prefixes up to
        ``data[:stop]``."""
        whole, longest_with, known = self.whole, self.longest_with, self._follows
        for end in range(len(last), stop + 1):
            first = end - longest_with.get(data[end - TAIL:end], TAIL - 1) if end >= TAIL else 0
            for start in range(first if first > 0 else 0, end):
                token = whole.get(data[start:end])
                if token is None:
                    continue
                if start:
                    left = last[start]
                    ok = known.get(left << 32 | token)
                    if not (self.follows(left, token) if ok is None else ok):
                        continue
                last.append(token)
                break
            else:
                raise ValueError("a byte is missing from the vocabulary")

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the split pattern; a match that is itself a token is that token.

        Words share prefixes, so the last tokens of short prefixes are kept across pieces."""
        if data in self.ranks:
            return [self.ranks[data]]
        known, stop = self._prefixes, len(data)
        begin = min(stop - 1, KEPT_PREFIX)
        while begin > 1 and data[:begin] not in known:
            begin -= 1
        last = list(known.get(data[:begin], (-1,)))
        begin = len(last)
        self.extend(data, last, stop)
        if len(known) > CACHE_SIZE:
            known.clear()
        if begin < stop <= KEPT_PREFIX + 1:
            known[data[:-1]] = last[:-1]
            if stop > 5:
                known[data[:5]] = last[:6]
        return self.ids_of(last)

    def ids_of(self, last: list[int]) -> list[int]:
        """Walk the last tokens back from the end."""
        out, end, length = [], len(last) - 1, self.length
        while end:
            token = last[end]
            out.append(token)
            end -= length[token]
        out.reverse()
        return out


class Prefixes:
    """The last token of every byte prefix of ``data``: exact appends and re-encoding near edits."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replace ``data[start:stop]``; returns how many prefixes were computed anew."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start + 1]
        same = 0
        for end in range(start + 1, len(self.data) + 1):
            self.bpe.extend(self.data, self.last, end)
            # beyond the edit an entry depends on the `longest` entries and bytes before it only
            same = same + 1 if end > start + len(new) and old[end - shift] == self.last[end] else 0
            if same > self.bpe.longest:
                self.last += old[end - shift + 1:]
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.bpe.ids_of(self.last)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# A space with white space before it and white space or the end behind it is part of a longer white-space
# match; before every other space a match of the pattern ends.
_INNER_SPACE = re.compile(r"\s (?:\s|\Z)")


def space_pieces(text: str, split: regex.Pattern) -> list[str]:
    """Cut ``text`` at places where every match of the split pattern ends."""
    if _INNER_SPACE.search(text):
        return split.findall(text)
    first, *rest = text.split(" ")
    pieces = [" " + p for p in rest]
    return [first, *pieces] if first else pieces


class PieceCache(dict):
    """piece -> what ``encode`` gives for it, for short pieces.  When full it becomes the older half, from which pieces
    that are met again move over."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = self.encode(piece)
        if len(piece) <= CACHE_PIECE:
            if len(self) >= CACHE_SIZE:
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out


def _encoder(path: str, pattern: str) -> tuple[PrefixBpe, regex.Pattern, PieceCache]:
    """One per Python worker."""
    return kept(("byte_bpe", path, pattern), lambda: _new_encoder(path, pattern))


def _new_encoder(path: str, pattern: str) -> tuple[PrefixBpe, regex.Pattern, PieceCache]:
    bpe, split = PrefixBpe(load_ranks(path)), regex.compile(pattern)

    def encode(piece: str) -> bytes:
        if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):   # letters: one match of any such pattern
            return array("i", bpe.encode_piece(piece.encode())).tobytes()
        return array("i", [i for m in split.findall(piece) for i in bpe.encode_piece(m.encode())]).tobytes()

    return bpe, split, PieceCache(encode)


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``ids`` array<int> and ``decoded`` (the bytes the ids stand for)."""

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        bpe, split, cache = _encoder(path, pattern)
        tokens = bpe.tokens
        found = [np.frombuffer(b"".join(map(cache.__getitem__, space_pieces((t or b"").decode(), split))), np.int32)
                 for t in texts]
        decoded = [b"".join(map(tokens.__getitem__, ids.tolist())) for ids in found]
        return {"ids": list_array(np.concatenate(found) if found else np.zeros(0, np.int32),
                                  np.asarray([len(x) for x in found], np.int64), pa.int32()),
                "decoded": pa.array(decoded, pa.binary())}

    return per_document(docs, run, "ids array<int>, decoded binary", text)


def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256."""
    done = encode(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return done.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
