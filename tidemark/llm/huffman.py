"""Token ids as canonical, length-limited Huffman codes in independently decodable blocks.

Texts are encoded with the tokenizers library, one end id is appended to each.  Ids are counted over all
documents; package-merge turns the counts into code lengths of at most ``MAX_BITS`` bits, and the lengths alone
define the canonical code.  The files hold the documents in ascending doc_id order (nulls first; rows that share
an id in the order of their ids' hash): range-partitioned rows are cut into blocks of whole documents with
about ``BLOCK_IDS`` ids each.  A block is one Parquet row: its documents and their id counts, the first id's place
within the range, the packed code bits, and a bit-offset checkpoint for every ``STEP`` ids, so that decoding can
start at any of them.  ``code`` holds the code lengths, ``ranges`` the number of ids of each range.

Decoding is table-driven: a table of 2^MAX_BITS entries gives the id and length for the next bits, and all
checkpoints of a batch of blocks advance side by side.

Null and empty texts have the end id only.  An empty table gives empty files.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from tidemark.session import scratch_path

from .byte_bpe import CACHE_PIECE
from .common import kept, slices, table, written

VOCABULARY, END_ID = "byte_bpe_50k.json", 0
MAX_BITS, BLOCK_IDS, STEP = 18, 1 << 15, 256
TOKEN = "<u4"
KNOWN_PIECES = 700_000   # pieces a worker remembers, twice
JOINED = 4000            # pieces that go to the library as one text
SLICE_ROWS = 1 << 14     # texts whose pieces are numbered together, as far as ``slices`` takes their bytes


# --- encoding texts with the library ----------------------------------------------------------------

def _members(of: list[int], size: int = 256) -> np.ndarray:
    out = np.zeros(size, bool)
    out[of] = True
    return out


WHITE = _members([0x20, *range(0x09, 0x0E)])
ALPHA = _members([*range(0x41, 0x5B), *range(0x61, 0x7B)])
SIGN = _members([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])
# U+00C0 to U+017F but the signs of multiplication and division: letters of two bytes
ACCENTED = _members([b for b in (*range(0xC380, 0xC3C0), *range(0xC480, 0xC4C0), *range(0xC580, 0xC5C0)) if b not in (0xC397, 0xC3B7)], 1 << 16)
OTHER_WHITE = [int.from_bytes(chr(c).encode(), "big") for c in
               (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Places in the UTF-8 bytes of texts, not empty, that begin at ``texts`` where a match of the split pattern begins and the bytes up
    to the next such place are split as if they stood alone.

    Of a run of white space before a word, all but the last character is a match; that is one too, or begins the word's
    match if it is a space.  A run at the end of a text is one match.  Letters end where a sign follows."""
    white, sign = WHITE[data], SIGN[data]
    cut, last = np.zeros(len(data), bool), np.zeros(len(data), bool)
    last[:-1] = white[:-1] & ~white[1:]
    last[texts[1:] - 1] = False
    cut[1:] = white[1:] & ~white[:-1] | last[:-1] & (data[:-1] != 0x20) | sign[1:] & ALPHA[data[:-1]]
    accent = np.flatnonzero(sign[2:] & (data[1:-1] >= 0x80))
    cut[accent[ACCENTED[data[accent].astype(np.int64) << 8 | data[accent + 1]]] + 2] = True
    cut |= last
    cut[texts] = True
    return np.flatnonzero(cut)


def beside_other_white(data: np.ndarray) -> np.ndarray:
    """Places where white space of ASCII and other white space meet: ``piece_starts`` does not hold there."""
    wide = np.concatenate([np.zeros(2, np.uint8), data, np.zeros(3, np.uint8)])
    white, high = WHITE[wide], wide >= 0x80
    ends = np.flatnonzero(high[:-1] & white[1:])
    begins = np.flatnonzero(white[:-1] & high[1:]) + 1
    found = []
    for first, size in ((ends - 1, 2), (ends - 2, 3), (begins, 2), (begins, 3)):
        code = np.zeros(len(first), np.int64)
        for i in range(size):
            code = code << 8 | wide[first + i]
        found.append(first[np.isin(code, OTHER_WHITE)] - 2)
    return np.concatenate(found)


class TextEncoder:
    """The library's ids of whole texts.  Texts are cut where every match of the split pattern ends (``piece_starts``), so
    the pieces' ids joined are the text's; the pieces of many texts are numbered together, and each is encoded once per worker
    and remembered.  A text that holds the string of an added token, or white space of ASCII beside other white
    space, goes to the library whole.  Ids are little-endian integers, of 16 bits where the vocabulary allows, else of 32."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else TOKEN)
        self.bytes_of = np.fromiter((len(self.tokenizer.id_to_token(i)) for i in range(size)), np.int64, size)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[bytes]) -> None:
        """Pieces that end without white space and start without, or with one space, go as one text, after a line end each where
        they start without."""
        joined, rest = [], []
        for p in pieces:
            s = p.decode()
            (rest if s[-1].isspace() or s[0].isspace() and s[0] != " " else joined).append(p)
        width = self.kind.itemsize
        for at in range(0, len(joined), JOINED):
            part = joined[at:at + JOINED]
            alone = [p[0] != 0x20 for p in part]
            ids = self.ids([b"".join([b"\n" + p if a else p for p, a in zip(part, alone)]).decode()])[0]
            lens = np.fromiter(map(len, part), np.int64, len(part)) + alone
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(lens)) + 1
            begins = np.concatenate([[0], ends[:-1]]) + alone
            raw = ids.tobytes()
            self.known.update(zip(part, [raw[a:b] for a, b in zip((begins * width).tolist(), (ends * width).tolist())]))
        self.known.update(zip(rest, [x.tobytes() for x in self.ids([p.decode() for p in rest])]))

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces."""
        if len(self.known) > KNOWN_PIECES:   # a piece that is met again moves over from the older half
            self.known, self.older = {}, self.known
        unknown = [p for p in pieces if p not in self.known]
        again = [p for p in unknown if p in self.older]
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        missing = [p for p in unknown if p not in self.older]
        self.learn(missing)
        out = list(map(self.known.__getitem__, pieces))
        for p in missing:
            if len(p) > CACHE_PIECE:
                del self.known[p]
        return out

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text."""
        out = [b""] * len(texts)
        there = [i for i, t in enumerate(texts) if t]
        if not there:
            return out
        raw = b"".join([texts[i] for i in there])
        data = np.frombuffer(raw, np.uint8)
        starts = np.cumsum([0, *[len(texts[i]) for i in there]])
        whole = set((np.searchsorted(starts, beside_other_white(data), side="right") - 1).tolist())
        for a in self.added:
            if a in raw:
                whole.update(i for i, k in enumerate(there) if a in texts[k])
        cuts = piece_starts(data, starts[:-1])
        offsets = np.append(cuts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        ids = pa.array(self.ids_of(pieces.dictionary.to_pylist()), pa.binary()).take(pieces.indices)
        places = np.frombuffer(ids.buffers()[1], np.int32)[np.append(np.searchsorted(cuts, starts[:-1]), len(cuts))].tolist()
        found = ids.buffers()[2].to_pybytes()
        for i, a, b in zip(there, places, places[1:]):
            out[i] = found[a:b]
        for i in whole:
            out[there[i]] = self.ids([texts[there[i]].decode()])[0].tobytes()
        return out


def _text_encoder(path: str) -> TextEncoder:
    """One per Python worker."""
    return kept(("huffman", path), lambda: TextEncoder(path))


def encode_texts(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, narrow): ids with the end id, as little-endian integers, of 16 bits where ``narrow``, else 32."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _text_encoder(path)
        end, narrow = np.asarray([end_id], encoder.kind).tobytes(), encoder.kind.itemsize == 2
        for part, texts in slices(batches, lambda b: b.column(1), rows=SLICE_ROWS):
            ids = [x + end for x in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([narrow] * len(ids))],
                                             ["doc_id", "ids", "narrow"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary, narrow boolean")


# --- the code ---------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (0: does not occur), by package-merge."""
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << limit:
        raise ValueError("more symbols than codes")
    lengths = np.zeros(len(counts), np.uint8)
    if len(symbols) == 1:
        lengths[symbols] = 1
    if len(symbols) < 2:
        return lengths
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights = counts[symbols].astype(np.int64)
    levels, row = [], weights   # a row: leaves and packages by weight; of each, whether it is a leaf
    leaf = np.ones(len(row), bool)
    for _ in range(limit - 1):
        levels.append(leaf)
        packages = row[:len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        row, leaf = both[order], order < len(weights)
    levels.append(leaf)
    take = 2 * (len(symbols) - 1)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        lengths[symbols[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


class Code:
    """The canonical code of given lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.limit = int(self.lengths.max(initial=1))
        order = np.lexsort((np.arange(len(lengths)), self.lengths))
        order = order[self.lengths[order] > 0]
        spans = np.int64(1) << (self.limit - self.lengths[order])
        first = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = first >> (self.limit - self.lengths[order])
        self.order, self.spans = order, spans

    @functools.cached_property
    def decoding(self) -> tuple[np.ndarray, np.ndarray]:
        """For the next ``limit`` bits: the id and its code length."""
        ids = np.zeros(1 << self.limit, np.uint32)
        lens = np.ones(1 << self.limit, np.uint8)
        n = int(self.spans.sum())
        ids[:n] = np.repeat(self.order, self.spans)
        lens[:n] = np.repeat(self.lengths[self.order], self.spans)
        return ids, lens

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The packed bits, and the bit offset of every STEP-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        lens, codes = self.lengths[ids], self.codes[ids].astype(np.uint64)
        ends = np.cumsum(lens)
        starts = ends - lens
        # into big-endian 64-bit words: what fits the word where a code starts, and the rest into the next one
        word, room = starts >> 6, 64 - (starts & 63) - lens
        over = np.flatnonzero(room < 0)
        part = codes << np.maximum(room, 0).astype(np.uint64)
        part[over] = codes[over] >> (-room[over]).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        out[word[first]] = np.bitwise_or.reduceat(part, first)
        out[word[over] + 1] |= codes[over] << (64 + room[over]).astype(np.uint64)   # one code at most crosses an edge
        return out.astype(">u8").tobytes()[:(int(ends[-1]) + 7) // 8], starts[::STEP]

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """The ids of blocks of (bits, checkpoints, number of ids)."""
        if not blocks:
            return []
        table_ids, table_lens = self.decoding
        sizes = np.asarray([len(b) + 8 for b, _, _ in blocks])
        raw = np.frombuffer(b"".join(b + bytes(8) for b, _, _ in blocks), np.uint8).astype(np.uint32)
        word = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        base = (np.cumsum(sizes) - sizes) * 8
        at = np.concatenate([c + x for (_, c, _), x in zip(blocks, base)])
        lanes = [len(c) for _, c, _ in blocks]
        out = np.empty((STEP, len(at)), np.uint32)
        top = len(word) * 8 - 1
        for t in range(STEP):   # lanes that have ended read on into padding; what they give is cut off below
            peek = word[at >> 3] << (at & 7).astype(np.uint32) >> np.uint32(32 - self.limit)
            out[t] = table_ids[peek]
            at = np.minimum(at + table_lens[peek], top)
        found, lane = [], 0
        for (_, _, n), k in zip(blocks, lanes):
            found.append(out[:, lane:lane + k].T.reshape(-1)[:n])
            lane += k
        return found


# --- files ------------------------------------------------------------------------------------------

def id_counts(encoded: DataFrame) -> dict[int, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                for kind, rows in (("<u2", b.filter(b.column(1))), (TOKEN, b.filter(pc.invert(b.column(1))))):
                    ids = np.frombuffer(b"".join(rows.column(0).to_pylist()), kind)
                    n = np.bincount(ids, minlength=len(total))
                    n[:len(total)] += total
                    total = n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["id", "n"])

    counted = encoded.select("ids", "narrow").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in counted.collect()}   # at most one row per id of the vocabulary


def write_files(spark: SparkSession, encoded: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Write ``code``, ``blocks`` and ``ranges`` under ``path``."""
    counts = id_counts(encoded)
    totals = np.zeros(max(counts, default=0) + 1, np.int64)
    totals[list(counts)] = list(counts.values())
    lengths = code_lengths(totals, MAX_BITS)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/code")
    kind = encoded.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, base, number = Code(lengths), 0, 0
        docs, ids = [], []

        def block() -> pa.RecordBatch:
            nonlocal base, number
            n = [len(x) for x in ids]
            bits, checkpoints = code.encode(np.concatenate(ids))
            row = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([base], pa.int64()), pa.array([docs], pa.list_(id_type)),
                 pa.array([n], pa.list_(pa.int64())), pa.array([checkpoints], pa.list_(pa.int64())), pa.array([bits], pa.binary())],
                ["number", "base", "doc_ids", "n_ids", "checkpoints", "bits"])
            base, number = base + sum(n), number + 1
            docs.clear()
            ids.clear()
            return row

        held = 0
        for b in batches:
            for doc, raw, narrow in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                docs.append(doc)
                ids.append(np.frombuffer(raw.as_buffer(), "<u2" if narrow.as_py() else TOKEN))
                held += len(ids[-1])
                if held >= block_ids:
                    yield block()
                    held = 0
        if docs:
            yield block()

    ordered = encoded.withColumn("tie", F.xxhash64("ids"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids", "narrow")
    cols = f"number long, base long, doc_ids array<{kind.simpleString()}>, n_ids array<long>, checkpoints array<long>, bits binary"
    blocks = ordered.mapInArrow(run, cols).select(F.spark_partition_id().alias("part"), "*")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    ends = spark.read.parquet(f"{path}/blocks").select("part", F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    ends.groupBy("part").agg(F.sum("n").alias("n")).coalesce(1).write.parquet(f"{path}/ranges")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): decoded ids (little-endian 32-bit) and the number of ids of all documents before."""
    code = spark.read.parquet(f"{path}/code").first()[0]   # one byte per id of the vocabulary
    lengths = np.frombuffer(bytes(code), np.uint8)
    # one row per range
    ranges = sorted((r["part"], r["n"]) for r in spark.read.parquet(f"{path}/ranges").collect())
    before, seen = {}, 0
    for part, n in ranges:
        before[part], seen = seen, seen + n
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Code(lengths)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):   # so many blocks decode side by side
                b = whole.slice(at, 64)
                n_ids = [np.asarray(x.values) for x in b.column("n_ids")]
                found = decoder.decode([(bits.as_py(), np.asarray(c.values), int(n.sum()))
                                        for bits, c, n in zip(b.column("bits"), b.column("checkpoints"), n_ids)])
                for i, (ids, n) in enumerate(zip(found, n_ids)):
                    ends = np.cumsum(n)
                    start = before[b.column("part")[i].as_py()] + b.column("base")[i].as_py() + ends - n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(b.column("doc_ids")[i].as_py(), id_type), pa.array(start, pa.int64()),
                         pa.array([x.astype(TOKEN).tobytes() for x in np.split(ids, ends[:-1])], pa.binary())],
                        ["doc_id", "start", "ids"])

    return blocks.mapInArrow(run, f"doc_id {kind.simpleString()}, start long, ids binary")


def q_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, all from the files read back."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = written(spark, encode_texts(docs, public_tokenizers.path(VOCABULARY)), "token-ids", compression="zstd")
    path = scratch_path(spark, "huffman")
    write_files(spark, encoded, path)
    done = read_files(spark, path)
    return done.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
