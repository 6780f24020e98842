"""Greedy longest-match word-piece counts in linear time, without building pieces.

Words are runs of bytes between ASCII white space.  The vocabulary's pieces stand in a trie: pieces that start a word
below its root, pieces that go on below the suffix root.  Every trie node has a failure link to the node that
matching goes on from after the longest pieces of what is read so far are popped, and the number of those pieces.  A
word is read once, byte by byte; where the trie has no edge, the popped count is added and the link followed.
A word that cannot be cut into pieces counts as one unknown token.

The pieces are those of a byte-level rank file: tokens with a leading space start words, the others go on.
Null and empty texts, and texts of white space only, have no words.  One output row per input row.
"""

from __future__ import annotations

import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import load_ranks
from .common import per_document, table

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_WORD, CACHE_SIZE = 64, 400_000
UNKNOWN = 1 << 32   # added to the count 1 of an unknown word
ROOT, SUFFIX, NONE = 0, 1, -1


class PieceCounter(dict):
    """word -> number of pieces (UNKNOWN + 1 if it has none); remembers short words."""

    def __init__(self, starts: set[bytes], goes_on: set[bytes]):
        super().__init__()
        self.edges: dict[int, int] = {}     # node << 8 | byte -> node
        parent, byte = [NONE, NONE], [0, 0]
        is_piece = [False, False]
        for root, pieces in ((ROOT, starts), (SUFFIX, goes_on)):
            for piece in pieces:
                node = root
                for b in piece:
                    nxt = self.edges.get(node << 8 | b)
                    if nxt is None:
                        nxt = self.edges[node << 8 | b] = len(parent)
                        parent.append(node)
                        byte.append(b)
                        is_piece.append(False)
                    node = nxt
                if piece:
                    is_piece[node] = True
        self.link, self.popped = [NONE] * len(parent), [0] * len(parent)
        children: dict[int, list[int]] = {}
        for v in range(2, len(parent)):
            children.setdefault(parent[v], []).append(v)
        layer = children.get(ROOT, []) + children.get(SUFFIX, [])
        while layer:     # by depth: a node's link depends on shorter ones
            for v in layer:
                if is_piece[v]:
                    self.link[v], self.popped[v] = SUFFIX, 1
                    continue
                z, n = self.link[parent[v]], self.popped[parent[v]]
                while z != NONE and (z << 8 | byte[v]) not in self.edges:
                    n += self.popped[z]
                    z = self.link[z]
                if z != NONE:
                    self.link[v], self.popped[v] = self.edges[z << 8 | byte[v]], n
            layer = [c for v in layer for c in children.get(v, ())]

    def count(self, word: bytes) -> int:
        edges, link, popped = self.edges, self.link, self.popped
        node, n = ROOT, 0
        for b in word:
            nxt = edges.get(node << 8 | b)
            while nxt is None:
                n += popped[node]
                node = link[node]
                if node == NONE:
                    return UNKNOWN + 1
                nxt = edges.get(node << 8 | b)
            node = nxt
        while node != SUFFIX:
            n += popped[node]
            node = link[node]
            if node == NONE:
                return UNKNOWN + 1
        return n

    def __missing__(self, word: bytes) -> int:
        n = self.count(word)
        if len(word) <= CACHE_WORD:
            if len(self) >= CACHE_SIZE:
                self.clear()
            self[word] = n
        return n


def word_pieces(path: str) -> tuple[set[bytes], set[bytes]]:
    """(pieces that start words, pieces that go on) of a rank file."""
    tokens = load_ranks(path)
    starts = {t[1:] for t in tokens if t[:1] == b" " and t[1:].split() == [t[1:]]}
    return starts, {t for t in tokens if t.split() == [t]}


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    """One per Python worker."""
    return PieceCounter(*word_pieces(path))


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), n_words, n_tokens, n_unknown (words without pieces, one token each)."""

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        counter = _counter(path)
        words = [t.split() if t else [] for t in texts]
        sums = np.asarray([sum(map(counter.__getitem__, w)) for w in words], np.int64)
        return {"n_words": pa.array([len(w) for w in words], pa.int64()), "n_tokens": pa.array(sums % UNKNOWN),
                "n_unknown": pa.array(sums // UNKNOWN)}

    return per_document(docs, run, "n_words long, n_tokens long, n_unknown long", text)


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown."""
    done = token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_tokens", "n_unknown")
