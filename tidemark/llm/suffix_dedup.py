"""Remove every byte covered by a string of ``length`` bytes that also starts earlier, by longest-previous-factor arrays.

Texts are UTF-8 bytes.  Earlier: a smaller doc_id (nulls first, then by the row's hash where ids repeat) or an earlier start
in the same document.  A string removes all of its later occurrences; its first one stays.  Strings are judged on the input.

A *longest-previous-factor array* gives, for every suffix, the longest prefix that it shares with a suffix that starts
earlier.  In suffix order the earlier suffixes that share most are those at the previous and the next smaller position, so
it follows from the order and the common prefixes of neighbours in it.  The order of all suffixes of a corpus need not be
known as a whole: strings of ``length`` bytes that are equal only have to meet.

1. *Anchors.*  A string's anchor is the smallest hash of its ``run``-byte substrings.  Equal strings have equal anchors,
   and neighbouring strings mostly share theirs: consecutive starts with one anchor are a *piece* (its text spans about
   a dozen words).  Documents are dealt into blocks of bounded text; anchors of pieces are counted over all blocks.
2. *Pieces with a recurring anchor* are dealt by anchor.  Equal pieces of a block travel once, its first one.
3. *Longest previous factors.*  The suffixes at the heads of the pieces with one anchor are sorted; their factors decide
   whole pieces, or the first strings of a piece, at once.  The remaining starts are sorted as suffixes of their own, of
   which the first ``length`` bytes count: among equal ones in order of position, the previous smaller position is
   the neighbour, and only the first has none.
4. *Removal.*  The starts come back to their blocks, where the bytes they cover go.

An anchor with over ``HOT`` different pieces (a passage that many documents continue in their own ways) would be one
large group: its starts are dealt one by one, under the hash of their string, each once per block, and sorted by it.
Texts are shuffled once, into blocks.  Groups are bounded by the block size; the numbers of blocks and of hash ranges grow
with the text, and no group holds more than one entry per block of a passage that a third of all documents share.

Null and empty texts have no bytes.  Rows that repeat doc_id and text: the first is judged as above, every byte of the others
goes if the text has ``length`` bytes.  Texts shorter than ``length`` stay.  Long texts are handled whole; an empty table
gives no rows.  Only doc_id (an integer) and text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, rows_in_blocks, table
from .phrase_dedup import is_in, sliding

LENGTH, RUN = 100, 32
BLOCKS_PER_RANGE, HOT = 4, 4096
STARTS, AT_ONCE = 1 << 16, 1 << 16   # string starts hashed, and suffixes sorted, at a time

#: A piece (or, of a hot anchor, one string: ``key`` is its hash) with the place of its first start.
HEAD = np.dtype([("key", "<u8"), ("has_id", "u1"), ("doc_id", "<i8"), ("row_key", "<i8"), ("at", "<u8"),
                 ("block", "<u4"), ("start", "<u8"), ("n", "<u2")])
SPAN = np.dtype([("start", "<u8"), ("n", "<u4")])   # consecutive starts in a block
ANCHORS = "r int, block int, anchors binary, many binary"
PIECES = "r int, block int, heads binary, text binary, single binary, done binary"


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def factors(n: int) -> np.ndarray:
    """Odd multipliers."""
    return np.random.default_rng(n).integers(1 << 32, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Block:
    """The documents of a block in order, one after another."""

    def __init__(self, t: pa.Table, length: int, run: int):
        ids, keys, more, copies = (t.column(c) for c in ("doc_id", "row_key", "more", "copies"))
        self.length, self.run = length, run
        has = np.asarray(ids.is_valid())
        number = ids.fill_null(0).to_numpy().astype(np.int64)
        keys, more, copies = keys.to_numpy(), more.to_numpy(zero_copy_only=False), copies.to_numpy()
        order = np.lexsort((more, keys, number, has))
        same = np.zeros(len(order), bool)
        k, i, h = keys[order], number[order], has[order]
        same[1:] = (k[1:] == k[:-1]) & (i[1:] == i[:-1]) & (h[1:] == h[:-1])
        first = np.flatnonzero(~same)
        self.copies = np.add.reduceat(copies[order], first) if len(first) else np.zeros(0, np.int64)
        chosen = order[first]
        self.ids = ids.take(pa.array(chosen))
        self.has_id, self.doc_id, self.row_key = has[chosen], number[chosen], keys[chosen]
        texts = [x or b"" for x in t.column("text").take(pa.array(chosen)).cast(pa.binary()).to_pylist()]
        raw = b"".join(texts)
        self.data = np.frombuffer(raw, np.uint8)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        # the 8 bytes from every place on, as one number
        self.words = np.ndarray(max(0, len(raw) - 7), "<u8", raw, strides=(1,)) if len(raw) > 7 else np.zeros(0, np.uint64)

    def hashes(self, starts: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the string at each start."""
        h = np.zeros(len(starts), np.uint64)
        offsets = [*range(0, self.length - 7, 8)]
        if offsets[-1] != self.length - 8:
            offsets.append(self.length - 8)
        with np.errstate(over="ignore"):
            for o, f in zip(offsets, factors(len(offsets))):
                w = self.words[starts + o] * f
                h += w ^ (w >> np.uint64(31))
        return mixed(h)

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First start, number of starts and anchor of every piece, and whether its anchor is at several places of it
        (else no two strings of the piece are equal)."""
        span, found = self.length - self.run + 1, []
        total = len(self.data) - self.length + 1
        offsets = range(0, self.run, 8)
        inner = self.ends[:-1]
        for a in range(0, max(0, total), STARTS):
            b = min(a + STARTS, total)
            words = self.words[a:b + self.length - 8].astype(np.uint64)
            size = b - a + self.length - self.run
            with np.errstate(over="ignore"):
                h = np.zeros(size, np.uint64)
                for o, f in zip(offsets, factors(len(offsets))):
                    h += words[o:o + size] * f
            h = mixed(h) | np.uint64(1)
            least = sliding(np.minimum, h, span)
            passed = h[:b - a] == least   # the anchor is where the string starts, ...
            for e in inner[(inner > a) & (inner < b + self.length)].tolist():   # strings that leave their document
                least[max(0, e - self.length + 1 - a):max(0, e - a)] = 0
            at = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            n = np.diff(np.concatenate([at, [b - a]]))
            passed[:-1] &= least[1:] == least[:-1]   # ... and the next string has it further on
            found.append((a + at, n, least[at], np.logical_or.reduceat(passed, at)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        start, n, anchor, several = (np.concatenate(x) for x in zip(*found))
        start, n, anchor, several = (x[anchor > 0] for x in (start, n, anchor, several))
        parts = -(-n // span)   # runs of one anchor are longer in periodic texts only
        before = np.cumsum(parts) - parts
        k = np.arange(int(parts.sum())) - np.repeat(before, parts)
        return (np.repeat(start, parts) + k * span, np.minimum(np.repeat(n, parts) - k * span, span), np.repeat(anchor, parts),
                np.repeat(several, parts))

    def piece_keys(self, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the text of each piece: its first and last string overlap."""
        with np.errstate(over="ignore"):
            return mixed(self.hashes(start) * np.uint64(3) + self.hashes(start + n - 1) + n.astype(np.uint64))

    def heads(self, key: np.ndarray, start: np.ndarray, n: np.ndarray, block: int) -> np.ndarray:
        out = np.zeros(len(start), HEAD)
        doc = np.searchsorted(self.ends, start, side="right")
        out["key"], out["has_id"], out["doc_id"], out["row_key"] = key, self.has_id[doc], self.doc_id[doc], self.row_key[doc]
        out["at"] = start - np.concatenate([[0], self.ends])[doc]
        out["block"], out["start"], out["n"] = block, start, n
        return out


def cut_text(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes from every start on, one after another."""
    to = np.cumsum(size)
    return data[np.arange(int(to[-1]) if len(to) else 0) - np.repeat(to - size, size) + np.repeat(start, size)]


def starts_of(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All starts of runs of ``n`` consecutive ones."""
    to = np.cumsum(n)
    return np.arange(int(to[-1]) if len(to) else 0) - np.repeat(to - n, n) + np.repeat(start, n)


def firsts(keys: np.ndarray) -> np.ndarray:
    """Which entries have no equal one before them."""
    out = np.zeros(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


def by_range(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by hash range, the ranges there are, and where each begins and the last one ends."""
    r = (keys % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(r, kind="stable")
    which, begin = np.unique(r[order], return_index=True)
    return order, which, np.concatenate([begin, [len(r)]])


def anchor_rows(b: Block, block: int, ranges: int) -> pa.Table:
    """The anchors of the block by range; ``many``: 0 for those with one place, else how many different pieces (up to 255)."""
    start, n, anchor, several = b.pieces()
    u, inverse, pieces = np.unique(anchor, return_inverse=True, return_counts=True)
    different = np.bincount(inverse[firsts(b.piece_keys(start, n))], minlength=len(u)) if len(u) else pieces
    again = (pieces > 1) | (np.bincount(inverse, weights=several, minlength=len(u)) > 0)
    many = np.where(again, np.minimum(different, 255), 0).astype(np.uint8)
    order, which, begin = by_range(u, ranges)
    u, many = u[order], many[order]
    cut = list(zip(begin[:-1].tolist(), begin[1:].tolist()))
    return pa.table({"r": pa.array(which, pa.int32()), "block": pa.array([block] * len(which), pa.int32()),
                     "anchors": pa.array([u[x:y].tobytes() for x, y in cut], pa.binary()),
                     "many": pa.array([many[x:y].tobytes() for x, y in cut], pa.binary())})


def recurring_anchors(t: pa.Table, hot: int) -> pa.Table:
    """Each block's anchors that have several places in all; ``many``: 1 for those with over ``hot`` different pieces."""
    rows = t.column("anchors").to_pylist()
    u, inverse, blocks = np.unique(np.frombuffer(b"".join(rows), np.uint64), return_inverse=True, return_counts=True)
    many = np.frombuffer(b"".join(t.column("many").to_pylist()), np.uint8)
    again = (blocks > 1) | (np.bincount(inverse, weights=many, minlength=len(u)) > 0)
    is_hot = (np.bincount(inverse, weights=np.maximum(many, 1), minlength=len(u)) > hot).astype(np.uint8)
    out, at = [], 0
    for x in rows:
        own = inverse[at:at + len(x) // 8]
        own = own[again[own]]
        out.append((u[own].tobytes(), is_hot[own].tobytes()))
        at += len(x) // 8
    return pa.table({"r": t.column("r"), "block": t.column("block"), "anchors": pa.array([x for x, _ in out], pa.binary()),
                     "many": pa.array([x for _, x in out], pa.binary())})


def piece_rows(b: Block, block: int, anchors: np.ndarray, hot: np.ndarray, ranges: int) -> pa.Table:
    """Pieces with recurring anchors by range.  ``done``: starts of pieces that repeat an earlier one of the block."""
    start, n, anchor, _ = b.pieces()
    chosen = is_in(anchor, anchors)
    start, n, anchor = start[chosen], n[chosen], anchor[chosen]
    new = firsts(b.piece_keys(start, n)) if len(start) else np.zeros(0, bool)
    done = spans(start[~new], n[~new])
    start, n, anchor = start[new], n[new], anchor[new]
    is_hot = is_in(anchor, anchors[hot > 0])
    single_at = starts_of(start[is_hot], n[is_hot])
    name = b.hashes(single_at) if len(single_at) else np.zeros(0, np.uint64)
    new = firsts(name)
    repeated = single_at[~new]
    done = np.concatenate([done, spans(repeated, np.ones(len(repeated), np.int64))])
    single = b.heads(name[new], single_at[new], np.ones(int(new.sum()), np.int64), block)
    start, n, anchor = start[~is_hot], n[~is_hot], anchor[~is_hot]
    heads = b.heads(anchor, start, n, block)
    rows: dict[int, list[bytes]] = {}
    order, which, begin = by_range(anchor, ranges)
    for r, x, y in zip(which.tolist(), begin[:-1].tolist(), begin[1:].tolist()):
        own = order[x:y]
        rows[r] = [heads[own].tobytes(), cut_text(b.data, start[own], n[own] + b.length - 1).tobytes(), b"", b""]
    order, which, begin = by_range(single["key"], ranges)
    for r, x, y in zip(which.tolist(), begin[:-1].tolist(), begin[1:].tolist()):
        rows.setdefault(r, [b"", b"", b"", b""])[2] = single[order[x:y]].tobytes()
    if len(done):
        rows.setdefault(block % ranges, [b"", b"", b"", b""])[3] = done.tobytes()
    cols = list(zip(*rows.values())) if rows else [[], [], [], []]
    return pa.table({"r": pa.array(list(rows), pa.int32()), "block": pa.array([block] * len(rows), pa.int32()),
                     **{c: pa.array(x, pa.binary()) for c, x in zip(("heads", "text", "single", "done"), cols)}})


def spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), SPAN)
    out["start"], out["n"] = start, n
    return out


def longest_previous_factors(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Of every suffix (numbered by position) the longest prefix it shares with one at a smaller position.  ``order``: the
    suffixes in suffix order, ``shared[i]``: the common prefix of ``order[i]`` and ``order[i - 1]`` (``shared[0]`` is 0)."""
    factor = [0] * len(order)
    waiting: list[tuple[int, int]] = []   # positions that grow upwards, each with its common prefix with the one below
    for here, common in zip(order.tolist(), shared.tolist()):
        while waiting and waiting[-1][0] > here:   # ``here`` is the next smaller position of what leaves
            last, below = waiting.pop()
            factor[last] = max(factor[last], common)
            common = min(common, below)
        factor[here] = common if waiting else 0   # with the previous smaller position
        waiting.append((here, common))
    return np.asarray(factor, np.int64)


def earlier_strings(text: np.ndarray, at: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """For pieces in order of position (their text at ``at``, ``n`` starts): which starts, piece by piece, have the same
    ``length`` bytes at an earlier start."""
    size = n + length - 1
    width = int(size.max())
    padded = np.concatenate([text, np.zeros(width, np.uint8)])
    heads = np.lib.stride_tricks.sliding_window_view(padded, width)[at]
    heads[np.arange(width)[None, :] >= size[:, None]] = 0
    order = np.argsort(heads.view(f"S{width}").ravel(), kind="stable")
    apart = heads[order[1:]] != heads[order[:-1]]
    shared = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    # clipped to the shorter neighbour: a factor is never too long, and what it leaves open is sorted below
    shared = np.minimum(shared, np.minimum(size[order[1:]], size[order[:-1]]))
    factor = longest_previous_factors(order, np.concatenate([[0], shared]))
    decided = np.clip(factor - length + 1, 0, n)
    to = np.cumsum(n)
    out = np.zeros(int(to[-1]), bool)
    out[starts_of(to - n, decided)] = True
    rest = np.flatnonzero(~out)
    if len(rest):
        starts = starts_of(at, n)[rest]
        strings = np.lib.stride_tricks.sliding_window_view(padded, length)[starts]
        order = np.argsort(strings.view(f"S{length}").ravel(), kind="stable")
        strings = strings[order]
        out[rest[order[1:][(strings[1:] == strings[:-1]).all(axis=1)]]] = True
    return out


def later_starts(t: pa.Table, length: int) -> pa.Table:
    """(block, spans) of the starts of a range that have an earlier occurrence."""
    def joined(name: str, kind: np.dtype) -> np.ndarray:
        return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)

    found = []
    heads, text = joined("heads", HEAD), joined("text", np.dtype(np.uint8))
    size = heads["n"].astype(np.int64) + length - 1
    at = np.cumsum(size) - size
    order = np.lexsort((heads["at"], heads["row_key"], heads["doc_id"], heads["has_id"], heads["key"]))
    heads, at = heads[order], at[order]
    n = heads["n"].astype(np.int64)
    # anchors one after another, about AT_ONCE starts at a time
    edges = np.flatnonzero(np.concatenate([[True], heads["key"][1:] != heads["key"][:-1]])) if len(heads) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(n)])
    a = 0
    while a < len(heads):
        enough = edges[np.searchsorted(edges, np.searchsorted(starts, starts[a] + AT_ONCE)):]
        b = int(enough[0]) if len(enough) and enough[0] > a else len(heads)
        gone = earlier_strings(text, at[a:b], n[a:b], length)
        found.append((np.repeat(heads["block"][a:b], n[a:b])[gone], starts_of(heads["start"][a:b].astype(np.int64), n[a:b])[gone]))
        a = b
    single = joined("single", HEAD)
    single = single[np.lexsort((single["at"], single["row_key"], single["doc_id"], single["has_id"], single["key"]))]
    gone = np.concatenate([[False], single["key"][1:] == single["key"][:-1]]) if len(single) else np.zeros(0, bool)
    found.append((single["block"][gone], single["start"][gone].astype(np.int64)))
    block, start = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((start, block))
    block, start = block[order], start[order]
    new = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (start[1:] != start[:-1] + 1)])) if len(block) else np.zeros(0, np.int64)
    runs = spans(start[new], np.diff(np.concatenate([new, [len(block)]])))
    which, begin = np.unique(block[new], return_index=True)
    begin = np.concatenate([begin, [len(new)]])
    rows = [(int(k), runs[x:y].tobytes()) for k, x, y in zip(which, begin[:-1], begin[1:])]
    rows += [(k, d) for k, d in zip(t.column("block").to_pylist(), t.column("done").to_pylist()) if d]
    return pa.table({"block": pa.array([k for k, _ in rows], pa.int32()), "spans": pa.array([x for _, x in rows], pa.binary())})


def remove_later(t: pa.Table, found: pa.Table, length: int, run: int) -> pa.Table:
    """doc_id, copies, n_bytes, n_removed, spans, kept of the block's distinct rows."""
    b = Block(t, length, run)
    gone = np.zeros(len(b.data) + 1, np.int32)
    s = np.frombuffer(b"".join(found.column("spans").to_pylist()) if found.num_rows else b"", SPAN)
    start = s["start"].astype(np.int64)
    np.add.at(gone, start, 1)
    np.add.at(gone, start + s["n"] + length - 1, -1)
    gone = np.cumsum(gone)[:-1] > 0
    raw, begin = b.data, np.concatenate([[0], b.ends])
    removed = np.concatenate([[0], np.cumsum(gone)])
    n_removed = removed[begin[1:]] - removed[begin[:-1]]
    all_spans, kept = [], []
    for i, (x, y) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
        if not n_removed[i]:
            all_spans.append([])
            kept.append(raw[x:y].tobytes())
            continue
        g = gone[x:y]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]]))).tolist()
        all_spans.append([{"start": p, "end": q} for p, q in zip(edges[::2], edges[1::2])])
        kept.append(raw[x:y][~g].tobytes())
    return pa.table({"doc_id": b.ids, "copies": pa.array(b.copies, pa.int64()), "n_bytes": pa.array(np.diff(begin), pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()),
                     "spans": pa.array(all_spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     "kept": pa.array(kept, pa.binary())})


def remove_later_copies(docs: DataFrame, length: int = LENGTH, run: int = RUN, block_bytes: int = BLOCK_BYTES,
                        hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (array of start and end byte of what goes), kept (the other bytes); one row per row
    of ``docs``."""
    if not 8 <= run <= length or run % 8:
        raise ValueError("run must be a multiple of 8, at most length")
    rows, n_blocks = rows_in_blocks(docs.select("doc_id", "text"), block_bytes)
    kind = rows.schema["doc_id"].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("doc_id must be an integer")
    ranges = -(-n_blocks // BLOCKS_PER_RANGE)

    def number(t: pa.Table) -> int:
        return t.column("block")[0].as_py()

    def count(t: pa.Table) -> pa.Table:
        return anchor_rows(Block(t, length, run), number(t), ranges)

    def cut(t: pa.Table, found: pa.Table) -> pa.Table:
        anchors, hots = (b"".join(found.column(c).to_pylist()) if found.num_rows else b"" for c in ("anchors", "many"))
        if not t.num_rows or not anchors:
            return piece_rows(Block(t.slice(0, 0), length, run), 0, np.zeros(0, np.uint64), np.zeros(0, np.uint8), ranges)
        return piece_rows(Block(t, length, run), number(t), np.frombuffer(anchors, np.uint64), np.frombuffer(hots, np.uint8), ranges)

    def remove(t: pa.Table, found: pa.Table) -> pa.Table:
        return remove_later(t, found, length, run)

    anchors = rows.groupBy("block").applyInArrow(count, ANCHORS)
    recurring = anchors.groupBy("r").applyInArrow(lambda t: recurring_anchors(t, hot), ANCHORS).where(F.length("anchors") > 0)
    pieces = rows.groupBy("block").cogroup(recurring.groupBy("block")).applyInArrow(cut, PIECES)
    later = pieces.groupBy("r").applyInArrow(lambda t: later_starts(t, length), "block int, spans binary")
    span = "array<struct<start:long,end:long>>"
    done = rows.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(
        remove, f"doc_id {kind}, copies long, n_bytes long, n_removed long, spans {span}, kept binary")
    each = done.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    whole = (F.col("copy") > 1) & (F.col("n_bytes") >= length)   # a later copy goes as a whole
    return each.select("doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
                       F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))))
                       .otherwise(F.col("spans")).alias("spans"),
                       F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def q_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    done = remove_later_copies(table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SUFFIX_DEDUP_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rid, hex(encode(coalesce(text, ''))) AS x FROM documents),
starts AS (SELECT rid, i, md5(substr(x, 2 * i + 1, {2 * LENGTH})) AS h
           FROM (SELECT rid, x, unnest(range(0, len(x) // 2 - {LENGTH - 1})) AS i FROM d WHERE len(x) >= {2 * LENGTH})),
later AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY h ORDER BY rid, i) AS k FROM starts) WHERE k > 1),
marked AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS new FROM later),
spans AS (SELECT rid, min(i) AS a, max(i) + {LENGTH} AS b
          FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS g FROM marked) GROUP BY rid, g),
gaps AS (SELECT rid, a, b, lag(b, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS before FROM spans),
cut AS (SELECT rid, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
               string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
        FROM gaps JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN kept IS NULL THEN x ELSE kept || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)
"""
