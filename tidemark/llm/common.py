"""Shared helpers: row keys, document blocks, Arrow batches in bounded slices, word hashing.

A *row key* is ``(doc_id, text_key)``: the id and a 64-bit hash of the text.  Rows that repeat both are
the same document; rows that repeat only the id stay apart.  All joins on it are null-safe.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

# Rows of one Arrow batch that a Python function handles at a time, and their text bytes.
SLICE_ROWS = 256
SLICE_BYTES = 8 << 20
# Text bytes of one block of documents (the unit of grouped work).
BLOCK_BYTES = 4 << 20

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table of ``sf_dir`` (other columns, whatever their names, are not read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def written(spark: SparkSession, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with null equal to null; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = one if cond is None else cond & one
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


# --- what a Python worker keeps ----------------------------------------------------------------------

_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """What a Python worker keeps for the operator ``key`` from task to task.  A worker goes on to other operators: it keeps
    the tables of one at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """For operators that keep nothing: drop what others have kept."""
    _kept.clear()


# --- Python functions over documents ---------------------------------------------------------------

def slices(batches: Iterator[pa.RecordBatch], text_of: Callable[[pa.RecordBatch], pa.Array],
           most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut Arrow batches into slices of at most ``rows`` rows and ``most`` bytes of text (one text may be longer)."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(text_of(batch)), 0), dtype=np.int64)
        start, n = 0, batch.num_rows
        while start < n:
            ends = np.cumsum(sizes[start:start + rows])
            take = max(1, int(np.searchsorted(ends, most, side="right")))
            part = batch.slice(start, take)
            yield part, text_of(part).cast(pa.binary()).to_pylist()
            start += take


def per_document(docs: DataFrame, fn: Callable[[list[bytes | None]], dict[str, pa.Array]],
                 outputs: T.StructType | str, text: str = "text") -> DataFrame:
    """Columns ``row`` (struct of all columns of ``docs``, so no name can clash) and the outputs of ``fn``,
    which maps the texts of a slice of documents (bytes, null as None) to one Arrow array per output."""
    if isinstance(outputs, str):
        outputs = T.StructType.fromDDL(outputs)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    at = docs.columns.index(text)
    schema = T.StructType([packed.schema["row"], *outputs.fields])
    names = [f.name for f in outputs.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, lambda b: pc.struct_field(b.column(0), [at])):
            out = fn(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), *[out[n] for n in names]], ["row", *names])
        pa.default_memory_pool().release_unused()   # the worker goes on to other tasks

    return packed.mapInArrow(run, schema)


# --- document blocks -------------------------------------------------------------------------------

def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, text: str = "text",
              total: int | None = None) -> tuple[DataFrame, int]:
    """``docs`` with a ``block`` column: about ``block_bytes`` of text each, dealt by the row key's hash, so
    copies and hot sources spread evenly.  The number of blocks grows with the text."""
    n = max(1, -(-(text_bytes(docs, text) if total is None else total) // block_bytes))
    key = F.xxhash64(F.lit(11), *[F.col(c) for c in ("doc_id", text)])
    return docs.withColumn("block", F.pmod(key, F.lit(n)).cast("int")), n


class WordIds(dict):
    """word -> id in order of first use; ``hashes()`` gives the 64-bit hash of each."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.words)
        self.words.append(word)
        return i

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words), np.uint64, len(self.words))


def word_arrays(texts: Sequence[bytes | None], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of all texts one after another, and the offsets of the documents (len(texts) + 1)."""
    parts, lens = [], [0]
    for t in texts:
        words = t.split() if t else []
        parts.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        lens.append(len(words))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return flat, np.cumsum(np.asarray(lens, np.int64))


MULT = np.uint64(0x9E3779B97F4A7C15)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes (mod 2^64, then mixed) of every ``k`` consecutive 64-bit hashes, by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc, acc_len = None, 0
        cur, cur_len, power = h, 1, MULT
        left = k
        while left:
            if left & 1:
                if acc is None:
                    acc, acc_len, acc_pow = cur, cur_len, power
                else:   # acc covers [i, i + acc_len), cur the cur_len entries after it
                    m = len(h) - acc_len - cur_len + 1
                    acc = acc[:m] * power + cur[acc_len:acc_len + m]
                    acc_len, acc_pow = acc_len + cur_len, acc_pow * power
            left >>= 1
            if left:
                m = len(h) - 2 * cur_len + 1
                cur = cur[:m] * power + cur[cur_len:cur_len + m]
                cur_len, power = 2 * cur_len, power * power
        out = acc[:n].copy()
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


# --- repeated rows ------------------------------------------------------------------------------------

# Text bytes among which a task combines repeated rows before it hands them on.
WINDOW_BYTES = 8 << 20


def combined(batches: Iterator[pa.RecordBatch], key: int, text: int, most: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of Arrow batches in windows of about ``most`` (WINDOW_BYTES) bytes of text, one of each that repeats the number in column
    ``key``, and how often it occurs in the window."""
    most = WINDOW_BYTES if most is None else most
    held: list[pa.RecordBatch] = []
    size = 0

    def window() -> tuple[pa.RecordBatch, np.ndarray]:
        whole = pa.Table.from_batches(held).combine_chunks()
        _, first, n = np.unique(whole.column(key).to_numpy(), return_index=True, return_counts=True)
        order = np.argsort(first)
        if len(first) < whole.num_rows:
            whole = whole.take(pa.array(first[order])).combine_chunks()
        return whole.to_batches()[0], n[order]

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(sizes[start - 1]) if start else 0
            take = max(1, int(np.searchsorted(sizes, before + most - size, side="right")) - start)
            part = batch.slice(start, take)
            held.append(part)
            size += int(sizes[start + part.num_rows - 1]) - before
            start += part.num_rows
            if size >= most or start < batch.num_rows:
                yield window()
                held.clear()
                size = 0
    if held:
        yield window()
    held.clear()
    pa.default_memory_pool().release_unused()   # the worker goes on to other tasks


def distinct_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, row_key, text, copies, more): rows that repeat doc_id and text are combined before any shuffle, so a row
    that fills a third of the table travels once per task.  Rows with ``more`` only add ``copies`` to the row of the same
    doc_id and row_key (a 64-bit hash of both) and have no text."""
    keyed = docs.select("doc_id", F.xxhash64(F.lit(11), F.col("doc_id"), F.col(text)).alias("row_key"), F.col(text).alias("text"))
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        extra: dict[int, list] = {}
        for b in batches:
            keys = b.column(1).to_pylist()
            first = []
            for i, k in enumerate(keys):
                if k in seen:
                    extra.setdefault(k, [b.column(0)[i], 0])[1] += 1
                else:
                    seen.add(k)
                    first.append(i)
            b = b if len(first) == len(keys) else b.take(pa.array(first, pa.int64()))
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([1] * n, pa.int64()), pa.array([False] * n)],
                                             ["doc_id", "row_key", "text", "copies", "more"])
            id_type, text_type = b.column(0).type, b.column(2).type
        if extra:
            n = len(extra)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0].as_py() for x in extra.values()], id_type), pa.array(list(extra), pa.int64()), pa.nulls(n, text_type),
                 pa.array([x[1] for x in extra.values()], pa.int64()), pa.array([True] * n)],
                ["doc_id", "row_key", "text", "copies", "more"])

    return keyed.mapInArrow(run, f"doc_id {kind}, row_key long, text string, copies long, more boolean")


def rows_in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``distinct_rows`` dealt into blocks of about ``block_bytes`` of text by the hash of the row, and their number, which
    grows with the text.  All rows of one doc_id and row_key are in one block: at most one with its text and one without
    per task."""
    n = max(1, -(-text_bytes(docs) // block_bytes))
    return distinct_rows(docs).withColumn("block", F.pmod("row_key", F.lit(n)).cast("int")), n


def one_of_each(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows of a block of ``rows_in_blocks``, one per doc_id and row_key, and how many rows of the input each stands for."""
    if not t.num_rows:
        return t, np.zeros(0, np.int64)
    key = t.column("row_key").to_numpy()
    ids = t.column("doc_id").dictionary_encode(null_encoding="encode").combine_chunks()
    ids = (ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids).indices.to_numpy()
    more = t.column("more").to_numpy(zero_copy_only=False)
    order = np.lexsort((more, ids, key))
    k, i = key[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (i[1:] != i[:-1])]))
    copies = np.add.reduceat(t.column("copies").to_numpy()[order], first)
    at = np.argsort(order[first])
    return t.take(pa.array(order[first][at])), copies[at]
