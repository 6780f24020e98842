"""Language-model scores: prediction by partial matching over bytes, and a unigram word model as base.

*Symbols* are the bytes of the text with A-Z lower-cased, then one end symbol; begin symbols stand before the text (both are
0xFF, which UTF-8 does not use).  The trie holds, for every context of up to ``ORDER`` symbols, the symbols that followed it
in the training documents.  Contexts of ``ORDER`` count occurrences, shorter ones are updated with exclusion: a
symbol counts there once for each longer context it was seen in.

*Escapes.*  A context ``c`` gives up ``discount(n)`` of each count ``n``; that share of its total is its escape
``e(c) = sum of discount(n) / total``, so contexts that many rare symbols followed escape more often.  What ``c`` says of a
symbol ``x`` is

    p(x | c) = max(n(x) - discount(n(x)), 0) / total + e(c) * p(x | c without its first symbol),

down to a uniform choice.  For symbols that ``c`` has not seen this is symbol exclusion: with ``S`` for what the shorter
context gives to the symbols seen in ``c``, they get ``e(c) (1 - S)`` in all, dealt by the shorter context without the
excluded symbols, ``p / (1 - S)``.  The part ``e(c) S`` goes back to the seen symbols, in the shorter context's shares.

*Adaptive level.*  Above that stands the document's own history: a context of ``LOCAL`` symbols that occurred before in the
document predicts what followed it there, by the same rule.  The score is the sum of log10 probabilities of all
symbols, the end included.

A *gram* is a context of ``ORDER`` symbols and the symbol after it, as one exact number.  All orders follow from the
training counts of the distinct grams, and a gram's static price depends on it alone.  Grams are counted and priced in parts
of about ``part_grams``, dealt by the last ``HEAD`` symbols of the context: a part holds all longer contexts whole, and
the orders below ``HEAD`` (at most 256^HEAD grams) are broadcast.  Each block of documents asks the parts for the prices
of its distinct grams, by ranges of the gram's hash, so the trie, which grows with the corpus, is never in one place.

*Base.*  Words (and one end per document) are counted per block of documents, added up by ranges of their 64-bit hash,
and each block gets the counts of its own words back; no vocabulary is ever in one place.

Documents with crc32(doc_id as text) mod 10 = 0 are held out, the others are learnt from; a null id counts as
empty text.  Null and empty texts have the end only.  Without training documents every symbol costs 1/257 before the
adaptive level.  Rows that repeat doc_id and text are combined before the shuffle and learnt with their copies; each gets
its own result row.  Long texts are whole in one block, an empty table gives no rows, and only doc_id and text are read, so
names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import MULT, WordIds, combined, one_of_each, rows_in_blocks, table, text_bytes, word_arrays, written
from .toxicity import fold

ORDER, LOCAL = 6, 8
SYMBOLS, EDGE = 257, b"\xff"   # bytes and the end; the begin and end symbol
DISCOUNTS = np.asarray([0.0, 0.7, 1.2, 1.75])   # of counts 0, 1, 2 and more
LOCAL_DISCOUNT = 0.7
HEAD = 3
PART_GRAMS = 200_000
GRAMS_PER_BYTE = 0.02   # distinct grams expected, which sets the number of parts
BLOCK_BYTES = 10 << 20   # larger blocks than elsewhere: distinct grams grow more slowly than the text
BLOCKS_PER_RANGE = 4
SCORE_BYTES = 1 << 18   # text of which symbols are scored at a time: what fits a processor cache
GRAM_BYTES = 4 << 20   # text of which grams are counted at a time: more of it has fewer distinct ones
HELD_GRAMS = 4_000_000   # distinct grams a counting task holds before it hands them on
MERGED = 1 << 18   # counts merged at a time: what fits a processor cache
END_WORD = xxhash.xxh3_64_intdigest(b" ")   # no word holds a space


# --- grams ------------------------------------------------------------------------------------------

def low_bits(symbols: int) -> np.int64:
    return np.int64((1 << 8 * symbols) - 1)


class Symbols:
    """Every symbol of some texts, in order: its gram, the ``LOCAL`` symbols before it, and its text."""

    def __init__(self, texts: list[bytes | None]):
        parts = [t.lower() if t else b"" for t in texts]   # bytes.lower() changes A-Z only
        pad = EDGE * LOCAL
        raw = b"".join(x for p in parts for x in (pad, p, EDGE)) + bytes(8)
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(self.sizes + LOCAL)
        self.real = np.ones(int(ends[-1]) if len(ends) else 0, bool)
        for j in range(LOCAL):
            self.real[ends - self.sizes - LOCAL + j] = False
        self.words = np.ndarray(max(0, len(raw) - 7), ">u8", raw, strides=(1,))   # the 8 symbols from every place on

    def from_back(self, symbols: int) -> np.ndarray:
        """The 8 symbols from ``symbols`` before each symbol on (a mask and no positions: 8 bytes a symbol in all)."""
        real = self.real[symbols:]
        return self.words[:len(real)][real].byteswap(inplace=True).view("<u8")

    def grams(self) -> np.ndarray:
        codes = self.from_back(7).view(np.int64)
        codes &= low_bits(ORDER + 1)
        return codes

    def contexts(self) -> np.ndarray:
        return self.from_back(LOCAL)

    def texts(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def portions(texts: list[bytes | None], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` bytes."""
    a, held = 0, 0
    for i, t in enumerate(texts):
        if i > a and held + len(t or b"") > most:
            yield a, i
            a, held = i, 0
        held += len(t or b"")
    if a < len(texts):
        yield a, len(texts)


def firsts(codes: np.ndarray) -> np.ndarray:
    """Where among ascending codes each distinct one begins."""
    new = np.ones(len(codes), bool)
    np.not_equal(codes[1:], codes[:-1], out=new[1:])
    return np.flatnonzero(new)


def ascending(codes: np.ndarray) -> np.ndarray:
    """The distinct codes in order (sorting is much faster than hashing here); ``codes`` are sorted in place."""
    codes.sort()
    return codes[firsts(codes)]


def ascending_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order and how often each occurs; ``codes`` are sorted in place."""
    codes.sort()
    first = firsts(codes)
    return codes[first], np.diff(first, append=len(codes))


def distinct_grams(texts: list[bytes | None]) -> np.ndarray:
    """Ascending distinct grams."""
    found = [ascending(Symbols(texts[a:b]).grams()) for a, b in portions(texts, GRAM_BYTES)]
    return ascending(np.concatenate(found or [np.zeros(0, np.int64)]))


def by_range(codes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes by range and, within one, as they were; the ranges that occur and where each begins."""
    r = dealt(codes, ranges)
    order = np.argsort(r, kind="stable")
    which, begin = np.unique(r[order], return_index=True)
    return codes[order], which, begin


def dealt(codes: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = codes.astype(np.uint64) * MULT
    return ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def packed(codes: np.ndarray) -> bytes:
    """Ascending numbers as differences, which compress well."""
    return np.diff(codes, prepend=0).astype(np.int64).tobytes()


def unpacked(data: bytes | pa.Buffer) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.int64))


def add_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and their summed counts, of arrays of ascending keys.  A range of keys is merged at a time,
    so there is little in memory but the arrays and the result."""
    size = sum(map(len, keys))
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    steps = -(-size // MERGED)
    some = np.sort(np.concatenate([k[::1024] for k in keys]))
    bounds = some[np.arange(1, steps) * len(some) // steps]
    cuts = [np.concatenate([[0], np.searchsorted(k, bounds), [len(k)]]).tolist() for k in keys]
    out_k, out_n, held = np.empty(size, np.int64), np.empty(size, np.int64), 0
    for i in range(steps):
        k = np.concatenate([x[c[i]:c[i + 1]] for x, c in zip(keys, cuts)])
        n = np.concatenate([x[c[i]:c[i + 1]] for x, c in zip(counts, cuts)])
        if not len(k):
            continue
        order = np.argsort(k)
        k = k[order]
        first = firsts(k)
        out_k[held:held + len(first)] = k[first]
        out_n[held:held + len(first)] = np.add.reduceat(n[order], first)
        held += len(first)
    return out_k[:held], out_n[:held]


GRAMS = "part int, codes binary, n binary"


def part_of(codes: np.ndarray, parts: int) -> np.ndarray:
    """Parts by the last HEAD symbols of the context."""
    return dealt(codes >> 8 & low_bits(HEAD), parts)


def gram_counts(docs: DataFrame, parts: int) -> DataFrame:
    """Distinct grams of all texts with their counts in training documents (0: in held-out texts only), one row per
    part; summed per task before they are shuffled."""

    def rows(k: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        where = part_of(k, parts)
        order = np.argsort(where, kind="stable")
        k, n = k[order], n[order]
        which, begin = np.unique(where[order], return_index=True)
        for r, a, b in zip(which.tolist(), begin.tolist(), [*begin[1:].tolist(), len(k)]):
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([packed(k[a:b])], pa.binary()),
                                              pa.array([n[a:b].tobytes()], pa.binary())], ["part", "codes", "n"])

    def run(batches):  # noqa: ANN001, ANN202
        keys, counts, held, most = [], [], 0, 1_000_000
        for window, copies in combined(batches, 2, 0):
            texts = window.column(0).cast(pa.binary()).to_pylist()
            weight = copies * window.column(1).to_numpy(zero_copy_only=False)
            for w in np.unique(weight).tolist():   # 0 for held-out texts, mostly 1 for the others
                alike = [t for t, x in zip(texts, weight.tolist()) if x == w]
                for a, b in portions(alike, GRAM_BYTES):
                    k, n = ascending_counts(Symbols(alike[a:b]).grams())
                    keys.append(k)
                    counts.append(n * w)
                    held += len(k)
                    if held > most:
                        one = add_counts(keys, counts)
                        if len(one[0]) > HELD_GRAMS:
                            yield from rows(*one)
                            one = add_counts([], [])
                        keys, counts, held, most = [one[0]], [one[1]], len(one[0]), 1_000_000 + 3 * len(one[0]) // 2
        yield from rows(*add_counts(keys, counts))

    def total(t: pa.Table) -> pa.Table:
        k, n = add_counts([unpacked(x) for x in t.column("codes").to_pylist()],
                          [np.frombuffer(x, np.int64) for x in t.column("n").to_pylist()])
        return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()), "codes": pa.array([packed(k)], pa.binary()),
                         "n": pa.array([n.tobytes()], pa.binary())})

    keyed = docs.select("text", "train", F.xxhash64("doc_id", "text").alias("row_key"))
    return keyed.mapInArrow(run, GRAMS).groupBy("part").applyInArrow(total, GRAMS)


# --- prices of grams --------------------------------------------------------------------------------

class Level:
    """Contexts of one order: grams seen in training (ascending) with counts, and per context its total and what it gives up."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.codes, self.n = codes, n
        context = codes >> 8
        first = np.flatnonzero(np.diff(context, prepend=-1))
        self.contexts = context[first]
        self.total = np.add.reduceat(n, first) if len(codes) else n
        self.given = np.add.reduceat(discount(n), first) if len(codes) else np.zeros(0)


def discount(n: np.ndarray) -> np.ndarray:
    return DISCOUNTS[np.minimum(n, len(DISCOUNTS) - 1)]


def shorter(codes: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The last ``symbols`` of distinct grams one symbol longer, each with the number of them that end so."""
    return np.unique(codes & low_bits(symbols), return_counts=True)


def levels_of(codes: np.ndarray, n: np.ndarray, order: int, lowest: int = 0) -> list[Level]:
    """The levels from ``lowest`` to ``order``, whose grams are given with their counts."""
    levels = [Level(codes, n)]
    for k in range(order - 1, lowest - 1, -1):
        codes, n = shorter(codes, k + 1)
        levels.insert(0, Level(codes, n))
    return levels


def found_in(values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each asked number among ascending values, and whether it is there."""
    if not len(values):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(values, asked), len(values) - 1)
    return at, values[at] == asked


def prices(levels: list[Level], grams: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's last symbol after its context."""
    p, todo = np.full(len(grams), 1 / SYMBOLS), np.arange(len(grams))
    for k, level in enumerate(levels):
        q = grams[todo]
        at, known = found_in(level.contexts, q >> 8 & low_bits(k))
        todo, q, at = todo[known], q[known], at[known]   # a context that is not known has no longer one that is
        g, seen = found_in(level.codes, q & low_bits(k + 1))
        n = np.where(seen, level.n[g], 0) if len(level.n) else np.zeros(len(q), np.int64)
        p[todo] = (n - discount(n) + level.given[at] * p[todo]) / level.total[at]
    return np.log10(p)


def train(spark: SparkSession, docs: DataFrame, ranges: int, parts: int) -> DataFrame:
    """(r, codes, logs): the price of every distinct gram of ``docs`` (doc_id, text, train), by ranges of the gram's hash."""
    grams = written(spark, gram_counts(docs, parts), "ppm-grams")

    def head(batches):  # noqa: ANN001, ANN202
        for b in batches:
            for codes, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                k = unpacked(codes)[np.frombuffer(n, np.int64) > 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(k & low_bits(HEAD + 1)))], ["gram"])

    # a gram of HEAD + 1 symbols is in one part: those that end in the same HEAD symbols are counted; at most 256^HEAD rows
    ends = grams.mapInArrow(head, "gram long").groupBy((F.col("gram") % F.lit(1 << 8 * HEAD)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    low = ends.toArrow()
    k, n = low.column(0).to_numpy(), low.column(1).to_numpy()
    order = np.argsort(k)
    k, n = k[order], n[order]
    below = spark.sparkContext.broadcast(levels_of(k, n, HEAD - 1))

    def price(batches):  # noqa: ANN001, ANN202
        for b in batches:
            for codes, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                codes, n = unpacked(codes), np.frombuffer(n, np.int64)
                logs = prices([*below.value, *levels_of(codes[n > 0], n[n > 0], ORDER, HEAD)], codes).astype(np.float32)
                where = dealt(codes, ranges)
                order = np.argsort(where, kind="stable")
                which, begin = np.unique(where[order], return_index=True)
                cut = list(zip(begin.tolist(), [*begin[1:].tolist(), len(codes)]))
                codes, logs = codes[order], logs[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which, pa.int32()), pa.array([packed(codes[x:y]) for x, y in cut], pa.binary()),
                     pa.array([logs[x:y].tobytes() for x, y in cut], pa.binary())], ["r", "codes", "logs"])

    return grams.mapInArrow(price, "r int, codes binary, logs binary")


def adapt(symbols: Symbols, grams: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """``logs`` (static log10 prices of the symbols) after the adaptive level."""
    n, bits = len(logs), int(len(logs)).bit_length()
    mask = np.int64((1 << bits) - 1)
    context = symbols.contexts()
    order = np.argsort(context)
    context = context[order]
    number = np.cumsum(np.concatenate([[0], context[1:] != context[:-1]])[:n])
    key = np.sort(number << bits | order)   # by context, then place
    order, context = key & mask, key >> bits
    text = symbols.texts()[order]
    first = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (text[1:] != text[:-1])])[:n])
    size = np.diff(np.concatenate([first, [n]]))
    often = np.flatnonzero(size > 1)   # contexts that come back in their document
    if not len(often):
        return logs
    size, first = size[often], first[often]
    run = np.repeat(np.arange(len(size)), size)
    start = np.cumsum(size) - size
    seen = np.arange(len(run)) - start[run]   # earlier places of the context
    order = order[first[run] + seen]
    key = np.sort((run << 8 | grams[order] & 255) << bits | np.arange(len(run)))
    back, pair = key & mask, key >> bits
    new = np.concatenate([[True], pair[1:] != pair[:-1]])
    begin = np.flatnonzero(new)
    same = np.empty(len(run), np.int64)       # earlier places of the context with the same symbol
    same[back] = np.arange(len(run)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(run)]])))
    fresh = (same == 0).astype(np.int64)
    kinds = np.cumsum(fresh) - fresh
    kinds -= kinds[start][run]                # different symbols that followed it
    ask = np.flatnonzero(seen)
    at, seen, same, kinds = order[ask], seen[ask], same[ask], kinds[ask]
    out = logs.copy()
    out[at] = np.log10((np.maximum(same - LOCAL_DISCOUNT, 0) + LOCAL_DISCOUNT * kinds * 10.0 ** logs[at]) / seen)
    return out


# --- scores -----------------------------------------------------------------------------------------

COUNTS = "r int, block int, hashes binary, n binary, grams binary"
ANSWERS = "block int, r int, n binary, logs binary"


def _counted_words(texts: list[bytes | None]) -> tuple[WordIds, np.ndarray, np.ndarray]:
    ids = WordIds()
    flat, ends = word_arrays([t.lower() if t else t for t in texts], ids)   # bytes.lower() changes A-Z only
    return ids, flat, ends


def _dealt_words(ids: WordIds, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the words and of the end, their order by range and hash (whatever the order of the texts, which differs
    from one fetch of a block to the next), the ranges that occur and where each begins."""
    h = np.concatenate([ids.hashes(), np.asarray([END_WORD], np.uint64)])
    r = (h % np.uint64(ranges)).astype(np.int64)
    order = np.lexsort((h, r))
    which, begin = np.unique(r[order], return_index=True)
    return h, order, which, begin


def score_documents(spark: SparkSession, docs: DataFrame, part_grams: int = PART_GRAMS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select("doc_id", "text")
    in_training = fold(F.col("doc_id"), 10) != 0
    blocks, n_blocks = rows_in_blocks(docs, block_bytes)
    blocks = blocks.withColumn("train", in_training)
    ranges = -(-n_blocks // BLOCKS_PER_RANGE)
    parts = max(1, round(text_bytes(docs) * GRAMS_PER_BYTE / part_grams))
    model = train(spark, docs.withColumn("train", in_training), ranges, parts)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(t: pa.Table) -> pa.Table:
        """Each word of a block once, with its count in training documents, and each gram of it once, packed by
        hash range."""
        block = t.column("block")[0].as_py()
        t, copies = one_of_each(t)
        texts = t.column("text").cast(pa.binary()).to_pylist()
        ids, flat, ends = _counted_words(texts)
        weight = copies * t.column("train").to_numpy(zero_copy_only=False)
        n = np.bincount(flat, weights=np.repeat(weight, np.diff(ends)), minlength=len(ids.words)).astype(np.int64)   # exact below 2^53
        n = np.concatenate([n, [int(weight.sum())]])
        h, order, which, begin = _dealt_words(ids, ranges)
        del t, ids, flat, ends   # before the grams take the room
        words = {r: (x, y) for r, x, y in zip(which.tolist(), np.split(h[order], begin[1:]), np.split(n[order], begin[1:]))}
        codes, gram_ranges, gram_begin = by_range(distinct_grams(texts), ranges)
        grams = dict(zip(gram_ranges.tolist(), np.split(codes, gram_begin[1:])))
        every = sorted({*words, *grams})
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        pa.default_memory_pool().release_unused()   # the worker goes on to other tasks
        return pa.table({"r": pa.array(every, pa.int32()), "block": pa.array([block] * len(every), pa.int32()),
                         "hashes": pa.array([words.get(r, none)[0].tobytes() for r in every], pa.binary()),
                         "n": pa.array([words.get(r, none)[1].tobytes() for r in every], pa.binary()),
                         "grams": pa.array([packed(grams.get(r, none[1])) for r in every], pa.binary())})

    def total(t: pa.Table, priced: pa.Table) -> pa.Table:
        """The counts over all blocks of every block's words of a range, and the prices of its grams, in the order they
        were asked; one row more with the range's sum and number of training words, under a block number below zero."""
        if not t.num_rows:
            return pa.table({"block": pa.array([], pa.int32()), "r": pa.array([], pa.int32()), "n": pa.array([], pa.binary()),
                             "logs": pa.array([], pa.binary())})
        rows, r = t.column("hashes").to_pylist(), t.column("r")[0].as_py()
        h = np.frombuffer(b"".join(rows), np.uint64)
        n = np.frombuffer(b"".join(t.column("n").to_pylist()), np.int64)
        u, inverse = np.unique(h, return_inverse=True)
        c = np.bincount(inverse, weights=n, minlength=len(u)).astype(np.int64)
        cut = np.cumsum([len(x) // 8 for x in rows])[:-1]
        sums = np.asarray([c.sum(), (c > 0).sum()], np.int64).tobytes()
        n = pa.array([*[x.tobytes() for x in np.split(c[inverse], cut)], sums], pa.binary())
        del rows, h, u, inverse, c   # before the grams take the room
        codes = np.concatenate([unpacked(x) for x in priced.column("codes").to_pylist()] or [np.zeros(0, np.int64)])
        logs = np.frombuffer(b"".join(priced.column("logs").to_pylist()), np.float32)
        order = np.argsort(codes)
        codes, logs = codes[order], logs[order]
        del order
        answers = [logs[np.searchsorted(codes, unpacked(x.as_buffer()))].tobytes() for x in t.column("grams")]
        pa.default_memory_pool().release_unused()   # the worker goes on to other tasks
        return pa.table({"block": pa.array([*t.column("block").to_pylist(), -1 - r], pa.int32()),
                         "r": pa.array([r] * (t.num_rows + 1), pa.int32()),
                         "n": n, "logs": pa.array([*answers, b""], pa.binary())})

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def score(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            sums = np.frombuffer(answers.column("n")[0].as_py(), np.int64)
            return pa.table({"doc_id": pa.nulls(1, id_type), "copies": pa.array([1]), "total": pa.array([True]),
                             "train": pa.array([False]), "n_tokens": pa.array([int(sums[0])]), "n_known": pa.array([int(sums[1])]),
                             "logs": pa.array([0.0]), "score": pa.array([0.0])})
        t, copies = one_of_each(t)
        texts = t.column("text").cast(pa.binary()).to_pylist()
        t = t.select(["doc_id", "train"])
        ids, flat, ends = _counted_words(texts)
        of_range = {r: (n, x) for r, n, x in zip(*(answers.column(c).to_pylist() for c in ("r", "n", "logs")))}
        given = [of_range[r] for r in sorted(of_range)]
        c = np.zeros(len(ids.words) + 1, np.int64)
        c[_dealt_words(ids, ranges)[1]] = np.frombuffer(b"".join(n for n, _ in given), np.int64)
        at_end = np.arange(len(texts)) + ends[1:]     # every document's words, then its end
        tokens = np.full(len(flat) + len(texts), len(c) - 1, np.int64)
        is_word = np.ones(len(tokens), bool)
        is_word[at_end] = False
        tokens[is_word] = flat
        starts = ends[:-1] + np.arange(len(texts))
        here = c[tokens]
        words = {"n_tokens": pa.array(np.diff(ends) + 1), "n_known": pa.array(np.add.reduceat((here > 0).astype(np.int64), starts)),
                 "logs": pa.array(np.add.reduceat(np.log10(here + 0.1), starts))}
        del ids, flat, tokens, here, is_word   # before the grams take the room
        # the prices of the block's grams come in the order they were asked, by range and value
        codes = distinct_grams(texts)
        price = np.empty(len(codes), np.float32)
        price[np.argsort(dealt(codes, ranges), kind="stable")] = np.frombuffer(b"".join(x for _, x in given), np.float32)
        scores = np.zeros(len(texts))
        for a, b in portions(texts, SCORE_BYTES):
            symbols = Symbols(texts[a:b])
            grams = symbols.grams()
            order = np.argsort(grams)
            ordered = grams[order]
            first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
            of_each = price[np.searchsorted(codes, ordered[first])].astype(np.float64)   # ascending on both sides
            p = np.empty(len(grams))
            p[order] = of_each[np.cumsum(first) - 1]
            p = adapt(symbols, grams, p)
            scores[a:b] = np.add.reduceat(p, np.cumsum(symbols.sizes) - symbols.sizes)
        pa.default_memory_pool().release_unused()   # the worker goes on to other tasks
        return pa.table({"doc_id": t.column("doc_id"), "copies": pa.array(copies), "total": pa.array([False] * len(texts)), "train": t.column("train"),
                         **words, "score": pa.array(scores)})

    counts = blocks.groupBy("block").applyInArrow(count, COUNTS)
    totals = counts.groupBy("r").cogroup(model.groupBy("r")).applyInArrow(total, ANSWERS)
    out = f"doc_id {kind}, copies long, total boolean, train boolean, n_tokens long, n_known long, logs double, score double"
    done = written(spark, blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(score, out), "ppm-scores")
    n, v = done.where("total").agg(F.sum("n_tokens"), F.sum("n_known")).first()
    n, v = n or 0, v or 0
    base = F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.1 * (v + 1))))
    each = done.where("NOT total").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                       F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def q_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    return score_documents(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
