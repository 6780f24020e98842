"""Drop lines whose key occurs in many documents.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased.  Keys of at least
``min_chars`` code points found in at least ``min_docs`` documents lose all their lines in every document.

Only hashes of keys travel.  ``(key, document, position)`` rows are range-partitioned by key and document and
sorted, so a key that fills a third of all rows is cut into several ranges, while the lines of one document
with one key stay together.  A stream over each range counts first occurrences per document.  A key with
enough documents inside one range is decided there; the first and the last key of a range may go on in its
neighbours, so their few undecided rows and their counts are settled by one small join afterwards.  The stream
holds back at most ``min_docs - 1`` documents' rows of the key it is at.  Rows that repeat doc_id and text are
combined in each task before they are shuffled and counted with their copies, so a row that fills a third of the
table is a few entries per task.

The result is one zlib-compressed bitmap of kept lines per document that loses any; texts are only needed
again to apply it.  Null and empty texts have one empty line, and an empty key (0 code points) is never
dropped.  Every row is a document, rows that repeat doc_id and text too; each gets its own result row.  Long texts are
read whole, an empty table gives no rows, and extra columns of any name stay in ``row``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import combined, null_safe, slices, table, text_key, written

MIN_CHARS, MIN_DOCS = 1, 10
WHITE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()   # bytes.lower() changes A-Z only


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, text_key, pos, copies) of every line whose key is long enough; h1, h2 are a 128-bit hash.  Rows that
    repeat doc_id and text are combined before they are shuffled, ``copies`` says how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window, n in combined(batches, 3, 2):
            at = 0
            for part, texts in slices(iter([window]), lambda b: b.column(2)):
                yield lines(part, texts, n[at:at + part.num_rows])
                at += part.num_rows

    def lines(part: pa.RecordBatch, texts: list[bytes | None], copies: np.ndarray) -> pa.RecordBatch:
        rows, pos, digests = [], [], []
        for i, t in enumerate(texts):
            for j, line in enumerate((t or b"").split(b"\n")):
                key = line_key(line)
                if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                    rows.append(i)
                    pos.append(j)
                    digests.append(xxhash.xxh3_128_digest(key))
        h = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
        take = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(h[:, 0]), pa.array(h[:, 1]), part.column(0).take(take), part.column(1).take(take),
             pa.array(pos, pa.int32()), pa.array(copies[np.asarray(rows, np.int64)], pa.int64())],
            ["h1", "h2", "doc_id", "text_key", "pos", "copies"])

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text",
                        F.xxhash64(F.lit(11), F.col("doc_id"), F.col("text")).alias("row_key"))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"h1 long, h2 long, doc_id {kind}, text_key long, pos int, copies long")


def stream_ranges(lines: DataFrame, min_docs: int) -> DataFrame:
    """Stream the sorted ranges.  Rows out: lines to drop (``n_docs`` null); of a range's first and last key its number of
    documents in the range (``pos`` null) and, while undecided, its lines (``n_docs`` 0)."""
    kind = lines.schema["doc_id"].dataType.simpleString()
    names = ["h1", "h2", "doc_id", "text_key", "pos", "n_docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, doc, first_pos, n_docs, held, first = None, None, None, 0, [], True

        def close(edge: bool) -> list[tuple]:
            """What is left to say about the key that ends here."""
            if not edge:
                return []
            return [(*key, None, None, None, n_docs), *([] if n_docs >= min_docs else [(*key, *line, 0) for line in held])]

        for batch in batches:
            out: list[tuple] = []
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ids, tk = batch.column(2), batch.column(3).to_numpy()
            pos, copies = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            starts = np.flatnonzero(new)
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(h1)]):
                here = (int(h1[s]), int(h2[s]))
                if here != key:
                    if key is not None:
                        out += close(first)
                        first = False
                    key, doc, n_docs, held = here, None, 0, []
                if e - s == 1 and s and e < len(h1) and copies[s] < min_docs:   # a key of one line inside the batch
                    held, n_docs, doc = [(ids[s].as_py(), int(tk[s]), int(pos[s]))] if first else [], int(copies[s]), None
                    continue
                for *line, n in zip(ids.slice(s, e - s).to_pylist(), tk[s:e].tolist(), pos[s:e].tolist(), copies[s:e].tolist()):
                    line = tuple(line)
                    if doc != line[:2]:
                        doc, first_pos = line[:2], line[2]
                    if line[2] == first_pos:   # a document counts with its first line of the key, once for each copy
                        undecided = n_docs < min_docs
                        n_docs += n
                        if undecided and n_docs >= min_docs:   # decided: drop what was held back and all that follows
                            out += [(*key, *x, None) for x in held]
                            held = []
                    if n_docs >= min_docs:
                        out.append((*key, *line, None))
                    elif not held or held[-1] != line:
                        held.append(line)
            if out:
                yield _rows(out)
        if key is not None and (last := close(True)):
            yield _rows(last)

    id_type = to_arrow_type(lines.schema["doc_id"].dataType)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        types = [pa.int64(), pa.int64(), id_type, pa.int64(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return lines.mapInArrow(run, f"h1 long, h2 long, doc_id {kind}, text_key long, pos int, n_docs long")


def dropped_lines(spark: SparkSession, docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, text_key, pos) of every line to drop."""
    lines = line_hashes(docs, min_chars)
    by = ["h1", "h2", "doc_id", "text_key"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.repartitionByRange(n, *by).sortWithinPartitions(*by, "pos")
    seen = written(spark, stream_ranges(ranged, min_docs), "line-ranges")
    decided = seen.where("n_docs IS NULL")
    # at most two keys per range: each range's count of documents once, then the total
    edges = seen.where("n_docs IS NOT NULL")
    undecided, counts = edges.where("pos IS NOT NULL"), edges.where("pos IS NULL").select("h1", "h2", F.col("n_docs").alias("n"))
    heavy = counts.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")
    late = undecided.join(heavy, ["h1", "h2"], "left_semi")
    cols = ["doc_id", "text_key", "pos"]
    return decided.select(*cols).unionByName(late.select(*cols))


def keep_bitmaps(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_key, n_dropped, keep): ``keep`` is the zlib-compressed bitmap (bit i of byte i // 8, from
    the lowest, is 1 if line i stays) up to the last dropped line; documents that lose nothing have no row."""
    dropped = dropped_lines(spark, docs.select("doc_id", "text"), min_chars, min_docs)
    per_doc = dropped.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("pos"))
    kind = dropped.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, n = [], []
            for pos in b.column(2):
                p = np.asarray(pos.values)
                bits = np.ones(8 * (int(p.max()) // 8 + 1), np.uint8)   # whole bytes, padded with kept lines
                bits[p] = 0
                keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
                n.append(len(p))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()),
                                              pa.array(keep, pa.binary())], ["doc_id", "text_key", "n_dropped", "keep"])

    return per_doc.mapInArrow(run, f"doc_id {kind}, text_key long, n_dropped long, keep binary")


def kept_text(text: bytes, keep: bytes) -> bytes:
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    lines = text.split(b"\n")
    return b"\n".join(x for i, x in enumerate(lines) if i >= len(bits) or bits[i])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), n_lines, n_dropped, kept (the text that stays; empty for null)."""
    packed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.coalesce("text", F.lit("")).alias("text"),
                         F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = null_safe(packed, bitmaps, ["doc_id", "text_key"], "left")

    @F.pandas_udf("string")
    def cut(text, keep):   # noqa: ANN001, ANN202 - pandas series
        return type(text)([None if k is None else kept_text(t.encode(), bytes(k)).decode() for t, k in zip(text, keep)],
                          dtype=object)

    n_lines = F.size(F.split("text", "\n", -1)).cast("long")
    # texts that lose nothing go to Python as null
    cut_text = cut(F.when(F.col("keep").isNotNull(), F.col("text")), F.col("keep"))
    return joined.select("row", n_lines.alias("n_lines"),
                         F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                         F.coalesce(cut_text, F.col("text")).alias("kept"))


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    done = apply_bitmaps(docs, keep_bitmaps(spark, docs))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, rid, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, rid, unnest(ls) AS l, generate_subscripts(ls, 1) AS i
        FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
heavy AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM heavy)) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (k NOT IN (SELECT k FROM heavy)), '')) AS kept_sha256
FROM lines GROUP BY rid
"""
