"""Alignment of two tokenizers' tokens, computed once per distinct text.

*Distinct texts.*  Documents are shuffled by full text (counted before the shuffle as well, so a text that fills a third of
all rows is one row per task); each distinct text is tokenised and aligned once and carries its number of documents.
*Alignment.*  Both tokenizers split a space and the text into byte ranges.  Offsets where tokens of both end cut them into
groups, and the two tokens that end there are linked.  Before a single space between two other characters both always
end a token (checked on the vocabulary), so texts are cut there and each distinct piece is aligned once per worker.
*Counts.*  The texts of a task are packed into blocks of about ``BLOCK_BYTES``.  A block gives its distinct linked id pairs
with their counts, weighted by the number of documents of each text; pairs are added up over all blocks, and blocks get
the totals of the pairs they asked for.  Nothing is broadcast, and a pair that occurs everywhere is one row per block.
*Join.*  The measures of a text are joined to its documents by two 64-bit hashes of the text.

A token's bytes: the byte-level entry decoded for the first tokenizer; for the second the piece in UTF-8 with U+2581 as a space
and ``<0xHH>`` as that byte.  Null and empty texts, and texts whose joined token bytes differ from space+text, have no
tokens: zeros and an empty digest.  Rows that repeat a text, or all columns, are documents of their own.  An empty table
gives no rows.  Long texts are never cut into parts that the tokenizers would split differently.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import list_array, table, written

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 4 << 20
CACHE_PIECE, CACHE_SIZE = 64, 250_000   # characters of a piece, and pieces, that a worker remembers
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

_LONE = re.compile(r"(?<=\S) (?=\S)")
_OTHER = re.compile(r"\s | (?:\s|\Z)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_chars() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the others in
    order from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Token ids, groups and links of whole texts; remembers short pieces by number."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        byte_of = byte_chars()
        size_a, self.size_b = self.first.get_vocab_size(), self.second.get_piece_size()
        self.bytes_a = [bytes(byte_of.get(c, 63) for c in self.first.id_to_token(i) or "") for i in range(size_a)]
        pieces = [self.second.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.lens_a, self.lens_b = (np.asarray([len(x) for x in b], np.int64) for b in (self.bytes_a, self.bytes_b))
        self.can_cut = not any("▁" in p.lstrip("▁") for p in pieces)
        # an id with the mark behind it: within a group, at the end of the first side, at the end of the second
        self.cells = [b"%d%c" % (i, mark) for mark, size in ((44, size_a), (124, size_a), (44, self.size_b), (59, self.size_b))
                      for i in range(size)]
        self.cell_lens = np.asarray([len(c) for c in self.cells], np.int64)
        self.from_cell = np.cumsum([0, size_a, size_a, self.size_b])
        self.reset()

    def reset(self) -> None:
        """Forget all pieces.  Of each: whether it has tokens, their numbers, groups, the group text, the linked pairs."""
        self.number: dict[str, int] = {}
        self.ok: list[bool] = []
        self.n_a: list[int] = []
        self.n_b: list[int] = []
        self.n_links: list[int] = []
        self.groups: list[bytes] = []
        self.pairs: list[bytes] = []

    def pieces(self, text: str) -> list[str]:
        """``text``, which starts with a space, cut before lone spaces."""
        if not self.can_cut:
            return [text]
        first, *rest = text[1:].split(" ") if not _OTHER.search(text, 1) and text[1:2] != " " else _LONE.split(text[1:])
        return [" " + first, *[" " + p for p in rest]]

    def learn(self, texts: list[str]) -> None:
        """Number and align ``texts`` (each starts with a space)."""
        ids_a = [e.ids for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.second.encode([t[1:] for t in texts], num_threads=1)
        raw = [t.encode() for t in texts]
        fine = [True] * len(texts)
        if not self._same(raw, ids_a, ids_b):
            fine = [self._same([r], [a], [b]) for r, a, b in zip(raw, ids_a, ids_b)]
        self.number.update(zip(texts, range(len(self.ok), len(self.ok) + len(texts))))
        ids_a, ids_b = ([x if f else [] for x, f in zip(ids, fine)] for ids in (ids_a, ids_b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(itertools.chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        # all texts as one: both sides end where a text ends
        end_a, end_b = np.cumsum(self.lens_a[a]), np.cumsum(self.lens_b[b])
        ends = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, bool)
        ends[end_b] = True
        last_a = ends[end_a]
        cuts = end_a[last_a]
        ends[:] = False
        ends[cuts] = True
        last_b = ends[end_b]
        codes = (a[last_a] * self.size_b + b[last_b]).tobytes()
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        # the cells group by group, those of the first side before those of the second
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        cell = np.empty(len(a) + len(b), np.int64)
        cell[place_a] = self.from_cell[last_a.astype(np.int64)] + a
        cell[place_b] = self.from_cell[2 + last_b.astype(np.int64)] + b
        text = b"".join(map(self.cells.__getitem__, cell.tolist()))
        to = np.concatenate([[0], np.cumsum(self.cell_lens[cell])])[np.cumsum(n_a + n_b)].tolist()
        links = np.diff(np.concatenate([[0], np.cumsum(last_a)])[np.cumsum(n_a)], prepend=0)
        links_to = (np.cumsum(links) * 8).tolist()
        self.ok += fine
        self.n_a += n_a.tolist()
        self.n_b += n_b.tolist()
        self.n_links += links.tolist()
        self.groups += [text[x:max(x, y - 1)] for x, y in zip([0, *to], to)]
        self.pairs += [codes[x:y] for x, y in zip([0, *links_to], links_to)]

    def _same(self, raw: list[bytes], ids_a: list[list[int]], ids_b: list[list[int]]) -> bool:
        """Whether the tokens of each text join to it."""
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        whole = b"".join(raw)
        for ids, tokens, lens in ((ids_a, self.bytes_a, self.lens_a), (ids_b, self.bytes_b, self.lens_b)):
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
            to = np.concatenate([[0], np.cumsum(lens[flat])])[np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]
            if not np.array_equal(to, ends) or b"".join(map(tokens.__getitem__, flat.tolist())) != whole:
                return False
        return True

    def align(self, texts: list[str]) -> list[list[int]]:
        """The piece numbers of each text (none: no tokens)."""
        cut = [self.pieces(" " + t) if t else [] for t in texts]
        missing = set().union(*cut).difference(self.number)
        if missing:
            self.learn(list(missing))
        out = [list(map(self.number.__getitem__, p)) for p in cut]
        # a piece without tokens: the text decides as a whole
        odd = {i for i, p in enumerate(out) if not all(map(self.ok.__getitem__, p))}
        whole = {" " + texts[i] for i in odd}
        if whole:
            self.learn(list(whole.difference(self.number)))
            for i in odd:
                k = self.number[" " + texts[i]]
                out[i] = [k] if self.ok[k] else []
        for p in missing | whole:
            if len(p) > CACHE_PIECE:
                self.number.pop(p, None)
        return out


@functools.lru_cache(maxsize=1)
def _aligner(first: str, second: str) -> Aligner:
    """One per Python worker."""
    return Aligner(first, second)


def text_hashes(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(i), text).alias(f"h{i}") for i in (1, 2)]


BLOCK = ("block long, h1 array<long>, h2 array<long>, n_a array<long>, n_b array<long>, n_links array<long>, "
         "groups_sha256 array<string>, n_pieces array<int>, pieces binary, piece_width int, piece_pairs array<int>, "
         "pairs binary, codes array<long>, counts array<long>")


def pack(aligner: Aligner, texts: list[str], weights: np.ndarray) -> dict[str, pa.Array]:
    """A block's columns from ``n_a`` to ``counts``."""
    found = aligner.align(texts)
    n_pieces = np.asarray([len(p) for p in found], np.int64)
    flat = np.fromiter((k for p in found for k in p), np.int64, int(n_pieces.sum()))
    used = np.bincount(flat, weights=np.repeat(weights, n_pieces), minlength=len(aligner.ok)).astype(np.int64)   # exact below 2^53
    distinct = np.flatnonzero(used)
    local = np.zeros(len(used), np.uint32)
    local[distinct] = np.arange(len(distinct))
    kept = distinct.tolist()
    piece_pairs = np.asarray([aligner.n_links[k] for k in kept], np.int64)
    codes = np.frombuffer(b"".join([aligner.pairs[k] for k in kept]), np.int64)
    u, pairs = np.unique(codes, return_inverse=True)
    counts = np.bincount(pairs, weights=np.repeat(used[distinct], piece_pairs), minlength=len(u)).astype(np.int64)
    kind = np.dtype("<u2" if len(distinct) <= 1 << 16 else "<u4")
    digests = [hashlib.sha256(b";".join(map(aligner.groups.__getitem__, p))).hexdigest() if p else "" for p in found]
    sums = [np.asarray([sum(map(per.__getitem__, p)) for p in found], np.int64) for per in (aligner.n_a, aligner.n_b, aligner.n_links)]

    def one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return list_array(values, np.asarray([len(values)]), kind)

    return {**{c: one(s, pa.int64()) for c, s in zip(("n_a", "n_b", "n_links"), sums)},
            "groups_sha256": pa.array([digests], pa.list_(pa.string())),
            "n_pieces": one(n_pieces.astype(np.int32), pa.int32()),
            "pieces": pa.array([local[flat].astype(kind).tobytes()], pa.binary()),
            "piece_width": pa.array([kind.itemsize], pa.int32()),
            "piece_pairs": one(piece_pairs.astype(np.int32), pa.int32()),
            "pairs": pa.array([pairs.astype("<u4").tobytes()], pa.binary()),
            "codes": one(u, pa.int64()), "counts": one(counts, pa.int64())}


def aligned_blocks(texts: DataFrame, first: str, second: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of ``texts`` (h1, h2, text, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(first, second), TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(2)), np.int64))
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + block_bytes, side="right")))
                part = batch.slice(start, stop - start)
                if len(aligner.number) > CACHE_SIZE or len(aligner.ok) > 2 * CACHE_SIZE:
                    aligner.reset()
                cols = pack(aligner, part.column(2).to_pylist(), part.column(3).to_numpy())
                h = [list_array(part.column(i).to_numpy(), np.asarray([part.num_rows]), pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *h, *cols.values()],
                                                 ["block", "h1", "h2", *cols])
                start, number = stop, number + 1

    return texts.select("h1", "h2", "text", "n").mapInArrow(run, BLOCK)


def pair_totals(blocks: DataFrame, size_b: int) -> tuple[DataFrame, DataFrame]:
    """What the blocks ask for (block, i, code), and (code, total, best): the corpus-wide count of every pair and whether it is
    its second id's highest.  An id has at most as many pairs as the first vocabulary has entries."""
    asked = blocks.select("block", F.posexplode(F.arrays_zip("codes", "counts")).alias("i", "pair"))
    asked = asked.select("block", "i", "pair.codes", "pair.counts").toDF("block", "i", "code", "n")
    totals = asked.groupBy("code").agg(F.sum("n").alias("total")).withColumn("b", F.pmod("code", F.lit(size_b)))
    best = F.col("total") == F.max("total").over(Window.partitionBy("b"))
    return asked.drop("n"), totals.select("code", "total", best.alias("best"))


def measure(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Measures by text: h1, h2, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(i)[r] for i, name in enumerate(batch.schema.names)}
                flat = {c: np.asarray(row[c].values) for c in ("n_a", "n_b", "n_links", "n_pieces", "piece_pairs")}
                pieces = np.frombuffer(row["pieces"].as_py(), f"<u{row['piece_width'].as_py()}")
                pairs = np.frombuffer(row["pairs"].as_py(), "<u4")
                found = row["answers"].values
                total, best = np.zeros(len(found) if found is not None else 0, np.int64), np.zeros(len(found) if found is not None else 0, np.int64)
                if found is not None:
                    at = found.field("i").to_numpy()
                    total[at] = found.field("total").to_numpy()
                    best[at] = found.field("best").to_numpy(zero_copy_only=False)
                sums = []
                for per_pair in (best, total):
                    edge = np.concatenate([[0], np.cumsum(per_pair[pairs])])
                    ends = np.cumsum(flat["piece_pairs"])
                    per_piece = edge[ends] - edge[ends - flat["piece_pairs"]]
                    edge = np.concatenate([[0], np.cumsum(per_piece[pieces])]) if len(pieces) else np.zeros(1, np.int64)
                    ends = np.cumsum(flat["n_pieces"])
                    sums.append(pa.array(edge[ends] - edge[ends - flat["n_pieces"]]))
                links = pa.array(flat["n_links"])
                yield pa.RecordBatch.from_arrays(
                    [row["h1"].values, row["h2"].values, pa.array(flat["n_a"]), pa.array(flat["n_b"]), links, links, *sums,
                     row["groups_sha256"].values], ["h1", "h2", *MEASURES, "groups_sha256"])

    with_answers = blocks.drop("codes", "counts").join(answers, "block", "left")
    return with_answers.mapInArrow(run, "h1 long, h2 long, " + ", ".join(f"{c} long" for c in MEASURES) + ", groups_sha256 string")


def align(spark: SparkSession, docs: DataFrame, first: str, second: str) -> tuple[DataFrame, DataFrame]:
    """``row`` (all columns of ``docs``) with the measures and groups_sha256, and (a, b, total, best) of all linked pairs."""
    texts = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    texts = texts.select(*text_hashes(F.col("text")), "text", "n")
    blocks = written(spark, aligned_blocks(texts, first, second), "alignment", compression="zstd")
    size_b = sentencepiece.SentencePieceProcessor(model_file=second).get_piece_size()
    asked, totals = pair_totals(blocks, size_b)
    totals = written(spark, totals, "pair-totals")
    answers = asked.join(totals, "code").groupBy("block").agg(F.collect_list(F.struct("i", "total", "best")).alias("answers"))
    by_text = measure(blocks, answers)
    keyed = docs.select(*text_hashes(F.col("text")), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    done = keyed.join(by_text, ["h1", "h2"], "left").select(
        "row", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    pairs = totals.select((F.col("code") / size_b).cast("int").alias("a"), F.pmod("code", F.lit(size_b)).cast("int").alias("b"), "total", "best")
    return done, pairs


def q_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    keys = docs.select("doc_id", "text")
    done, _ = align(spark, keys, public_tokenizers.path(FIRST), public_tokenizers.path(SECOND))
    return done.select("row.doc_id", *MEASURES, "groups_sha256")
