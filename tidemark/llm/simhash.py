"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming check, connected components.

Texts with A-Z lower-cased are cut into words at ASCII white space and into shingles of ``shingle`` words
(fewer words: the whole sequence).  A fingerprint bit is 1 if it is set in over half the shingles' XXH64
(seed 42), repeats included.  No words (null and empty texts too): fingerprint zero, linked like any other.

Equal fingerprints are one class.  Two classes are linked when they differ in at most ``max_bits`` bits.  The
64 bits are split into ``max_bits + 2`` blocks, so linked classes agree on at least two blocks: every pair of
blocks is a join key, and candidates are verified by Hamming distance.  A key shared by more than ``hot``
classes is not joined pair by pair: each of its classes names its *hubs*, the values reached by flipping at
most one of the bits outside the shared blocks (two differing bits meet at a common hub), and every hub links
its classes to the smallest.  That gives the same components without all pairs of the group.

Components are found by alternating large-star and small-star steps on the edges, each step written to the
shared scratch folder.  The result is one row per document, with the smallest doc_id of its component (null
ids are passed over; a component of null ids only has null).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import per_document, table, written

SHINGLE, MAX_BITS, SEED = 3, 2, 42
# Classes that share a key are joined pair by pair up to this many.
HOT_KEY = 24


def fingerprint_of(texts: list[bytes | None], shingle: int) -> np.ndarray:
    h, lens = [], []
    digest = xxhash.xxh64_intdigest
    for t in texts:
        words = t.lower().split() if t else []
        if len(words) > shingle:
            grams = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
        else:
            grams = [b" ".join(words)] if words else []
        before = len(h)
        h.extend([digest(g, SEED) for g in grams])
        lens.append(len(h) - before)
    lens = np.asarray(lens, np.int64)
    votes = np.zeros((len(texts), 64), np.int64)
    hashes = np.asarray(h, np.uint64)
    starts = np.cumsum(lens) - lens
    step = 1 << 17   # bounds the unpacked bits held at a time
    for lo in range(0, len(hashes), step):
        part = hashes[lo:lo + step]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.searchsorted(starts + lens, lo, side="right")
        last = np.searchsorted(starts, lo + len(part), side="left")
        owners = np.arange(first, last)
        owners = owners[lens[owners] > 0]
        cuts = np.maximum(starts[owners] - lo, 0)
        votes[owners] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    on = (2 * votes > lens[:, None]).astype(np.uint8)
    return np.packbits(on, axis=1).reshape(-1, 8).copy().view(">u8").reshape(-1).astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``fp`` (the fingerprint's 64 bits as a long)."""
    return per_document(docs, lambda texts: {"fp": pa.array(fingerprint_of(texts, shingle), pa.int64())}, "fp long")


def _masks(n_blocks: int) -> list[int]:
    """For every pair of blocks, the 64-bit mask of the two."""
    edges = [round(64 * i / n_blocks) for i in range(n_blocks + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [x | y for x, y in itertools.combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(spark: SparkSession, classes: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_KEY) -> DataFrame:
    """Edges (u, v), u > v, between fingerprints of ``classes`` (column fp, distinct) that make the same
    components as all pairs within ``max_bits`` bits do."""
    if max_bits not in (1, 2):
        raise ValueError("hubs link classes at one or two differing bits")
    masks = _masks(max_bits + 2)
    keyed = classes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                           .alias("slot", "bits"))
    keyed = written(spark, keyed, "simhash-keys")
    sizes = keyed.groupBy("slot", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keyed.join(sizes, ["slot", "bits"])
    few = shared.where(F.col("n") <= hot)
    a, b = few.select("slot", "bits", F.col("fp").alias("u")), few.select("slot", "bits", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    pairs = a.join(b, ["slot", "bits"]).where((F.col("u") > F.col("v")) & near).select("u", "v")
    # crowded keys: flip at most one bit outside the shared blocks
    flips = F.array(*[F.array(*[F.lit(_signed(x)) for x in [0, *[1 << i for i in range(64) if not m >> i & 1]]])
                      for m in masks])
    crowd = shared.where(F.col("n") > hot).select("fp", F.explode(F.element_at(flips, F.col("slot") + 1)).alias("x"))
    crowd = crowd.select(F.col("fp").alias("u"), F.col("fp").bitwiseXOR(F.col("x")).alias("hub")).distinct()
    crowd = written(spark, crowd, "simhash-hubs")
    if max_bits == 1:   # a hub links only if it is a class itself
        stars = crowd.join(classes.select(F.col("fp").alias("hub")), "hub").where("u <> hub").select(
            F.greatest("u", "hub").alias("u"), F.least("u", "hub").alias("v"))
    else:
        least = crowd.groupBy("hub").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
        stars = crowd.join(least.select("hub", "v"), "hub").where("u > v").select("u", "v")
    return pairs.unionByName(stars).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(fp, root) for every end of an edge; ``root`` is the smallest fingerprint of its component."""
    edges = written(spark, edges, "simhash-edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        large = written(spark, large, "simhash-large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u > v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = written(spark, small, "simhash-small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("fp")).distinct().select("fp", F.col("fp").alias("root"))
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    hot: int = HOT_KEY, row_id: Column | None = None) -> DataFrame:
    """``id`` (``row_id``, by default doc_id), ``fp`` and ``least_id``, the smallest id of the component."""
    ident = F.col("row.doc_id") if row_id is None else row_id
    prints = written(spark, fingerprints(docs, shingle).select(ident.alias("id"), "fp"), "simhash-fingerprints")
    classes = written(spark, prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    comp = components(spark, links(spark, classes.select("fp"), max_bits, hot))
    roots = classes.join(comp, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # a class of null ids only has a null `least`; min() passes over it
    tops = roots.groupBy("root").agg(F.min("least").alias("least_id"))
    named = roots.select("fp", "root").join(tops, "root").select("fp", "least_id")
    return prints.join(named, "fp").select("id", "fp", "least_id")


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    done = near_duplicates(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       F.col("least_id").alias("component_id"))
