"""Benchmark decontamination as a prefix-filtered containment join.

Words are runs of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.  A window is
``window`` consecutive words of an item (an item of fewer words, but not none, is one window).  A document
contains a window exactly when it contains all its ``shingle``-word shingles at the right distances, so one
shingle per window is a sufficient join prefix.  The prefix is the window's rarest shingle: benchmark shingles
are counted over all documents first, and windows that overlap share their rare shingles.

Documents are matched against the prefix shingles as they stream by.  A hit at word ``p`` of a shingle with
offset ``o`` puts the window at ``p - o``; windows that would start before the document or end after it are
skipped by their position and length, the others are compared word by word.  Documents are never shuffled.

The windows are broadcast in parts of at most ``part_words`` item words, which bounds each broadcast whatever
the size of the benchmark; with more than one part the hits of all parts are joined per document.

Null and empty texts have no words.  Items without words have no window; items with a null id mark words but
are not listed.  Rows that repeat an item id are one item.  Each input row gives one result row; rows that
repeat both doc_id and text have equal results.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import list_array, null_safe, per_document, slices, table, text_bytes, text_key, written

WINDOW, SHINGLE, SHARE = 13, 3, 20   # contaminated: at least 1 hit word in SHARE
# Item words of one broadcast part: the windows of a part are at most a few tens of MB.
PART_WORDS = 400_000
WORD_BYTES = 6

_SPLIT = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().translate(_SPLIT).split() if text else []


class Windows:
    """The windows of a bounded part of a benchmark over one vocabulary (id 0: any other word)."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, shingle: int):
        vocab: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = defaultdict(set)
        for item, text in items:
            ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text.encode() if text else None)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found[tuple(ids[i:i + window])].add(item)
        self.vocab, self.shingle = vocab, shingle
        self.windows = list(found)
        self.items = [sorted(x for x in found[w] if x is not None) for w in self.windows]
        self.hashes = self.mix(np.arange(len(vocab) + 1))
        # shingle length -> hash -> the (window, offset) pairs it is the prefix of
        self.prefix: dict[int, dict[int, list[tuple[int, int]]]] = {}

    @staticmethod
    def mix(ids: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            return x ^ x >> np.uint64(29)

    def shingles(self, ids: np.ndarray, k: int) -> np.ndarray:
        """Hashes of every k consecutive word ids; 0 where a word is not of the benchmark."""
        n = len(ids) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            h = np.zeros(n, np.uint64)
            known = np.ones(n, bool)
            for j in range(k):
                part = ids[j:j + n]
                h = h * np.uint64(0x100000001B3) + self.hashes[part]
                known &= part > 0
        return np.where(known, h, np.uint64(0))

    def sizes(self) -> list[int]:
        """The shingle lengths in use: windows shorter than the shingle have their own."""
        return sorted({min(self.shingle, len(w)) for w in self.windows})

    def all_shingles(self) -> dict[int, np.ndarray]:
        return {k: np.unique(np.concatenate([self.shingles(np.asarray(w), k) for w in self.windows
                                             if min(self.shingle, len(w)) == k])) for k in self.sizes()}

    def choose(self, counts: dict[int, int]) -> None:
        """Take each window's rarest shingle (ties: the smaller hash) as its prefix."""
        for i, w in enumerate(self.windows):
            k = min(self.shingle, len(w))
            h = self.shingles(np.asarray(w), k).tolist()
            o = min(range(len(h)), key=lambda j: (counts.get(h[j], 0), h[j]))
            self.prefix.setdefault(k, {}).setdefault(h[o], []).append((i, o))
        self.keys = {k: np.sort(np.fromiter(p, np.uint64, len(p))) for k, p in self.prefix.items()}

    def word_ids(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of all texts, each followed by one 0 so that no shingle spans two documents; word counts."""
        parts, lens = [], []
        get = self.vocab.get
        for t in texts:
            words = words_of(t)
            parts.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
            parts.append(np.zeros(1, np.int64))
            lens.append(len(words))
        return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.asarray(lens, np.int64)

    def hits(self, ids: np.ndarray, lens: np.ndarray) -> list[dict[int, tuple[int, set]]]:
        """Per document: the windows found, as start -> (length, items)."""
        begins = np.cumsum(lens + 1) - lens - 1
        found: list[dict[int, tuple[int, set]]] = [{} for _ in lens]
        for k, keys in self.keys.items():
            h = self.shingles(ids, k)
            at = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h)
            at = at[h[at] != 0]
            docs = np.searchsorted(begins, at, side="right") - 1
            for p, d in zip(at.tolist(), docs.tolist()):
                for i, o in self.prefix[k][int(h[p])]:
                    w, start = self.windows[i], p - o - int(begins[d])
                    if start < 0 or start + len(w) > lens[d]:
                        continue
                    if ids[p - o:p - o + len(w)].tolist() == list(w):
                        length, items = found[d].get(start, (0, set()))
                        found[d][start] = (max(length, len(w)), items | set(self.items[i]))
        return found


def _parts(benchmark: DataFrame, part_words: int) -> list[DataFrame]:
    """The distinct rows of the benchmark in parts of about ``part_words`` words of ``WORD_BYTES`` by a hash of the row."""
    benchmark = benchmark.distinct()
    n = max(1, -(-text_bytes(benchmark) // (part_words * WORD_BYTES)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.where(part == i) for i in range(n)]


def _prefix_counts(docs: DataFrame, windows) -> dict[int, int]:  # noqa: ANN001
    """How often each benchmark shingle occurs in ``docs``."""
    sets = windows.value.all_shingles()

    def run(batches):  # noqa: ANN001, ANN202
        w, totals = windows.value, {k: np.zeros(len(s), np.int64) for k, s in sets.items()}
        for _, texts in slices(batches, lambda b: b.column(0)):
            ids, _lens = w.word_ids(texts)
            for k, s in sets.items():
                h = w.shingles(ids, k)
                at = np.minimum(np.searchsorted(s, h), len(s) - 1)
                totals[k] += np.bincount(at[(s[at] == h) & (h != 0)], minlength=len(s))
        for k, s in sets.items():
            seen = totals[k] > 0
            yield pa.RecordBatch.from_arrays([pa.array(s[seen].view(np.int64)), pa.array(totals[k][seen])], ["h", "n"])

    counted = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    # at most one row per shingle of the part
    return {r["h"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in counted.collect()}


HITS = "n_words long, starts array<int>, lengths array<int>, items array<string>"


def find_hits(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """``row`` (all columns of ``docs``), n_words, and the windows of one part of the benchmark found."""
    items = [(r[0], r[1]) for r in benchmark.select(F.col("item_id").cast("string"), "text").collect()]
    found = Windows(items, window, shingle)
    if found.windows:
        found.choose(_prefix_counts(docs, spark.sparkContext.broadcast(found)))
    else:
        found.keys = {}
    shared = spark.sparkContext.broadcast(found)

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        w = shared.value
        ids, lens = w.word_ids(texts)
        hits = w.hits(ids, lens)
        starts = [sorted(h) for h in hits]
        n = np.asarray([len(s) for s in starts], np.int64)
        items = [sorted(set().union(*(x[1] for x in h.values()))) for h in hits]
        return {"n_words": pa.array(lens), "starts": list_array(np.asarray([x for s in starts for x in s], np.int32), n, pa.int32()),
                "lengths": list_array(np.asarray([h[x][0] for h, s in zip(hits, starts) for x in s], np.int32), n, pa.int32()),
                "items": pa.array(items, pa.list_(pa.string()))}

    return per_document(docs, run, HITS)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  shingle: int = SHINGLE, part_words: int = PART_WORDS) -> DataFrame:
    """``row`` (all columns of ``docs``), n_words, starts and lengths (the windows found, as word positions),
    n_hit, items (ids, sorted as strings), contaminated."""
    benchmark = benchmark.select("item_id", "text")
    parts = _parts(benchmark, part_words)
    found = find_hits(spark, docs, parts[0], window, shingle)
    for part in parts[1:]:
        keyed = docs.select("doc_id", "text").distinct()
        more = find_hits(spark, keyed, part, window, shingle).where(F.size("starts") > 0).select(
            "row.doc_id", text_key(F.col("row.text")).alias("text_key"), F.col("starts").alias("s2"),
            F.col("lengths").alias("l2"), F.col("items").alias("i2"))
        more = written(spark, more, "benchmark-hits")
        here = found.withColumn("doc_id", F.col("row.doc_id")).withColumn("text_key", text_key(F.col("row.text")))
        found = null_safe(here, more, ["doc_id", "text_key"], "left").select(
            "row", "n_words",
            *[F.when(F.col(b).isNull(), F.col(a)).otherwise(F.concat(a, b)).alias(a) for a, b in (("starts", "s2"), ("lengths", "l2"))],
            F.when(F.col("i2").isNull(), F.col("items")).otherwise(F.array_sort(F.array_union("items", "i2"))).alias("items"))
    # the words covered by the windows: merge the spans in order of their starts
    spans = F.array_sort(F.arrays_zip("starts", "lengths"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    n_hit = F.aggregate(spans, zero, lambda acc, x: F.struct(
        F.greatest(acc["end"], x["starts"] + x["lengths"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), x["starts"] + x["lengths"] - F.greatest(acc["end"], x["starts"]))).alias("n")))["n"]
    return (found.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))))


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    done = contamination(spark, table(spark, sf_dir, "documents", "doc_id", "text"),
                         table(spark, sf_dir, "benchmark", "item_id", "text"))
    return done.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


DECONTAMINATE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 13 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' ')) END) AS s FROM b),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT rid, dw.k AS k, i, item_id FROM dw JOIN bw USING (s, k)),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
        FROM hit GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
