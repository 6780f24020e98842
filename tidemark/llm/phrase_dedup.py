"""Remove passages of at least ``window`` words that occur more than once anywhere.

A window is ``window`` consecutive words of one document; every word covered by a window whose word sequence
also starts anywhere else (same document included, windows may overlap) goes.  Windows are judged on the input.

1. *Candidates.*  A window's anchor is the smallest hash of its ``anchor``-word runs.  Equal windows have equal
   anchors, and few places are anchors, so counting anchors over all documents is cheap.
2. *Recurring passages are confirmed* by counting the hashes (64 bit) of the windows with a recurring anchor.
3. *Sharded automata.*  Documents are dealt into blocks of bounded text by the hash of their row.  A look-up of its
   windows' hashes tells a block which confirmed phrases it holds; of those it compiles an Aho-Corasick automaton
   (pyahocorasick, over word ids): every run of consecutive confirmed windows is laid out with windows side by
   side.  All documents of the block are streamed through it, which marks the words of every occurrence.

Texts are shuffled once, into blocks.  Hashes travel as packed arrays, each once per block, so a passage that a
third of all documents share costs one entry per block.  Groups are bounded by the block size; the number of
blocks and of hash ranges grows with the text.

Null and empty texts have no words.  Rows that repeat doc_id and text are further places of their windows; they are
combined before the shuffle and judged once, with the number of their copies.  Long texts are whole in one block, an empty
table gives no rows, and only doc_id and text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, WordIds, one_of_each, rolling, rows_in_blocks, table, word_arrays

WINDOW, ANCHOR = 35, 8
BLOCKS_PER_RANGE = 8
PACKED = "r int, block int, hashes binary, multi binary"


def sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` consecutive entries, by doubling."""
    n, size = len(x) - width + 1, 1
    if n <= 0:
        return x[:0]
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[:n], x[width - size:width - size + n]) if size < width else x


class Block:
    """Word ids, word hashes and window starts of a block's documents, one after another."""

    def __init__(self, texts: list[bytes | None], window: int, copies: np.ndarray | None = None):
        self.copies = np.ones(len(texts), np.int64) if copies is None else copies
        self.ids = WordIds()
        self.flat, self.ends = word_arrays(texts, self.ids)
        hashes = self.ids.hashes()
        self.hashed = hashes[self.flat] if len(self.flat) else np.zeros(0, np.uint64)
        self.window = window
        n = max(0, len(self.flat) - window + 1)
        last = np.repeat(self.ends[1:], np.diff(self.ends))[:n]   # end of the document of each start
        self.inside = np.arange(n) + window <= last

    def anchors(self, anchor: int) -> np.ndarray:
        """The anchor hash of every window start; 0 where the window leaves the document."""
        runs = rolling(self.hashed, anchor) | np.uint64(1)
        return np.where(self.inside, sliding(np.minimum, runs, self.window - anchor + 1), np.uint64(0))

    def times(self, places: np.ndarray) -> np.ndarray:
        """How many rows have the document of each place."""
        return self.copies[np.searchsorted(self.ends, places, side="right") - 1]

    def anchor_places(self, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes at all places that are some window's anchor, and how many rows have each."""
        span = self.window - anchor + 1
        least = self.anchors(anchor)
        if not len(least):
            return least, np.zeros(0, np.int64)
        runs = rolling(self.hashed, anchor) | np.uint64(1)
        pad = np.zeros(span - 1, np.uint64)
        best = sliding(np.maximum, np.concatenate([pad, least, pad]), span)
        places = np.flatnonzero(best == runs)
        return runs[places], self.times(places)

    def windows(self) -> np.ndarray:
        return rolling(self.hashed, self.window)


def packed(block: int, keys: np.ndarray, times: np.ndarray, ranges: int) -> pa.Table:
    """Distinct hashes by range, with a byte that says whether one occurs more than once here."""
    u, inverse = np.unique(keys, return_inverse=True)
    n = np.bincount(inverse, weights=times, minlength=len(u))
    r = (u % np.uint64(ranges)).astype(np.int32)
    order = np.argsort(r, kind="stable")
    u, n, r = u[order], n[order], r[order]
    which, begin = np.unique(r, return_index=True)
    end = [*begin[1:].tolist(), len(u)]
    multi = (n > 1).astype(np.uint8)
    return pa.table({"r": pa.array(which, pa.int32()), "block": pa.array([block] * len(which), pa.int32()),
                     "hashes": pa.array([u[a:b].tobytes() for a, b in zip(begin, end)], pa.binary()),
                     "multi": pa.array([multi[a:b].tobytes() for a, b in zip(begin, end)], pa.binary())})


def unpacked(column: pa.ChunkedArray, kind: type = np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def recurring(places: DataFrame) -> DataFrame:
    """(block, hashes): each block's hashes that occur at least twice in all."""

    def run(t: pa.Table) -> pa.Table:
        rows = t.column("hashes").to_pylist()
        h = np.frombuffer(b"".join(rows), np.uint64)
        multi = unpacked(t.column("multi"), np.uint8).astype(bool)
        u, inverse, n = np.unique(h, return_inverse=True, return_counts=True)
        again = n > 1
        again[inverse[multi]] = True
        keep, cut = again[inverse], np.cumsum([len(x) // 8 for x in rows])[:-1]
        out = [x[k].tobytes() for x, k in zip(np.split(h, cut), np.split(keep, cut))]
        return pa.table({"block": t.column("block").cast(pa.int32()), "hashes": pa.array(out, pa.binary())})

    return places.groupBy("r").applyInArrow(run, "block int, hashes binary").where(F.length("hashes") > 0)


def is_in(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted) or not len(values):
        return np.zeros(len(values), bool)
    wanted = np.sort(wanted)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def covered_words(block: Block, confirmed: np.ndarray) -> np.ndarray:
    """Which words of the block lie in an occurrence of a confirmed window, located by an automaton."""
    window, n = block.window, len(block.flat)
    starts = np.flatnonzero(is_in(block.windows(), confirmed) & block.inside) if n >= window else np.zeros(0, np.int64)
    hit = np.zeros(n + 1, np.int32)
    if not len(starts):
        return hit[:n] > 0
    first = np.flatnonzero(np.concatenate([[True], np.diff(starts) != 1]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for a, b in zip(starts[first].tolist(), starts[last].tolist()):
        for s in [*range(a, b, window), b]:
            automaton.add_word(tuple(block.flat[s:s + window].tolist()))
    automaton.make_automaton()
    for a, b in zip(block.ends[:-1].tolist(), block.ends[1:].tolist()):
        if b - a >= window:
            ends = np.fromiter((e for e, _ in automaton.iter(tuple(block.flat[a:b].tolist()))), np.int64) + a + 1
            np.add.at(hit, ends - window, 1)
            np.add.at(hit, ends, -1)
    return np.cumsum(hit[:n]) > 0


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (array of start and end word of what goes), kept (words joined by a space)."""
    blocks, n_blocks = rows_in_blocks(docs.select("doc_id", "text"), block_bytes)
    ranges = -(-n_blocks // BLOCKS_PER_RANGE)
    id_field = blocks.schema["doc_id"]

    def distinct(t: pa.Table) -> tuple[pa.Table, list[bytes | None], Block]:
        """One row per doc_id and row_key, their texts, and the block of them."""
        t, copies = one_of_each(t)
        texts = t.column("text").cast(pa.binary()).to_pylist()
        return t, texts, Block(texts, window, copies)

    def places(t: pa.Table) -> pa.Table:
        return packed(t.column("block")[0].as_py(), *distinct(t)[2].anchor_places(anchor), ranges)

    def windows(t: pa.Table, candidates: pa.Table) -> pa.Table:
        if not t.num_rows or not candidates.num_rows:
            return packed(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), ranges)
        b = distinct(t)[2]
        chosen = np.flatnonzero(is_in(b.anchors(anchor), unpacked(candidates.column("hashes"))) & b.inside)
        return packed(t.column("block")[0].as_py(), b.windows()[chosen], b.times(chosen), ranges)

    def remove(t: pa.Table, confirmed: pa.Table) -> pa.Table:
        t, texts, b = distinct(t)
        gone = covered_words(b, unpacked(confirmed.column("hashes")) if confirmed.num_rows else np.zeros(0, np.uint64))
        n_words, n_removed, spans, kept = [], [], [], []
        for i, text in enumerate(texts):
            g = gone[b.ends[i]:b.ends[i + 1]]
            words = text.split() if text else []
            edges = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]])))
            n_words.append(len(words))
            n_removed.append(int(g.sum()))
            spans.append([{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
            kept.append(b" ".join([w for w, x in zip(words, g.tolist()) if not x] if len(edges) else words).decode())
        return pa.table({"doc_id": t.column("doc_id"), "copies": pa.array(b.copies, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         "kept": pa.array(kept, pa.string())})

    candidates = recurring(blocks.groupBy("block").applyInArrow(places, PACKED))
    confirmed = recurring(blocks.groupBy("block").cogroup(candidates.groupBy("block")).applyInArrow(windows, PACKED))
    done = blocks.groupBy("block").cogroup(confirmed.groupBy("block")).applyInArrow(
        remove, f"doc_id {id_field.dataType.simpleString()}, copies long, n_words long, n_removed long, "
                "spans array<struct<start:int,end:int>>, kept string")
    return done.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "col")


def q_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    done = remove_repeats(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


PHRASE_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
        FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT rid, list(DISTINCT p) AS ps FROM (SELECT rid, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN rep USING (h)) GROUP BY rid),
wd AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
gp AS (SELECT rid, unnest(ps) AS p FROM gone),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS t FROM wd ANTI JOIN gp USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)
"""
