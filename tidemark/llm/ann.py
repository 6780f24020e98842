"""Approximate nearest neighbours by largest inner product: inverted lists scanned dimension block by block.

*Space.*  A vector ``x`` gets one more component ``sqrt(M^2 - |x|^2)`` (``M``: the largest norm), a query a zero; then
the nearest by distance is the largest by inner product.  All are rotated by one random orthogonal matrix, so the
first ``d`` of ``D`` components estimate the whole distance.

*Lists.*  About ``sqrt(n)`` centroids are fitted on a bounded sample (``FIT_VECTORS``), from distinct vectors; every
vector joins the list of its nearest centroid.  How many of the nearest lists a query probes is calibrated on the sample:
so many that ``FOUND`` of the exact neighbours (within the sample) of ``CALIBRATE`` of its vectors are in them, and more until
the lists hold ``top`` other ids (all lists of a small table).  Lists that are well apart need few, unstructured vectors most.

*Tiles.*  Lists are packed into groups of about ``GROUP`` vectors (a longer list is cut by hash, so a list that holds a third
of all vectors, or copies of one vector, is spread) and queries are dealt into blocks of ``QUERY_BLOCK``; a task scans the
probed lists of a group for a block, so a query travels once per group and a vector once per block.

*Scan.*  A query starts from the ``k``-th distance among a bounded set of seed vectors (which are candidates too) and
among the best of the first component blocks.  Block after block, a candidate is abandoned as soon as its partial
distance rejects, at ``EPSILON``, the hypothesis that it is within that radius; blocks are computed for all candidates at once
while many are left, then for the survivors.  Survivors of all blocks get the exact inner product of the original vectors
in double precision; a query's results are merged over groups.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do
rows without id.  Rows that repeat id and vector count once; rows that repeat only the id are separate candidates, but
all bounds count distinct ids and a pair of ids appears once with its best score; as queries they are searched together.
Ties go to the smaller vec_id.  A query without candidates has no rows, nor has an empty table.  Only vec_id and embedding
are read, so names of other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import table, written

TOP = 20
FIT_VECTORS, FIT_ROUNDS, PER_LIST = 20_000, 8, 4   # vectors of the sample per centroid, at least
CALIBRATE, FOUND = 256, 0.97
SEEDS, SEED_SHARE = 4096, 1 / 16
COLUMNS, EPSILON = 16, 2.1
DENSE = 0.1    # share of candidates from which on a block is computed for all
GROUP, QUERY_BLOCK, PAIRS = 8192, 16_384, 2_000_000


def rows_of(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Space:
    """The rotated space: largest norm, rotation, centroids; seeds to start the search from."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, norm: float, n: int, seed: int = 7, scale: float = 1.0):
        """``norm``: the largest norm of the vectors divided by ``scale``, so that no square overflows."""
        rng = np.random.default_rng(seed)
        self.norm, self.dim, self.scale = norm, sample.shape[1], scale
        self.rotation = np.linalg.qr(rng.normal(size=(self.dim + 1, self.dim + 1)))[0]
        points = self.place(sample)
        apart = np.sort(np.unique(sample, axis=0, return_index=True)[1])   # one of each vector
        k = int(max(1, min(round(n ** 0.5), len(apart), max(256, len(sample) // PER_LIST))))
        centroids = points[rng.choice(apart, k, replace=False)].copy()
        for _ in range(FIT_ROUNDS):
            near = np.concatenate([self.distances(points[a:a + 2048], centroids).argmin(axis=1) for a in range(0, len(points), 2048)])
            sums, sizes = np.zeros_like(centroids), np.bincount(near, minlength=k)
            np.add.at(sums, near, points)
            centroids[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
        self.centroids = centroids
        self.probe_share = self.calibrated(sample, ids, points)
        m = int(min(SEEDS, max(1, n * SEED_SHARE), len(points)))
        self.seeds, self.seed_ids, self.seed_points = sample[:m], ids[:m], points[:m]

    def nearest_list(self, points: np.ndarray) -> np.ndarray:
        return np.concatenate([self.distances(points[a:a + 2048], self.centroids).argmin(axis=1) for a in range(0, len(points), 2048)]
                              or [np.zeros(0, np.int64)])

    def calibrated(self, sample: np.ndarray, ids: np.ndarray, points: np.ndarray) -> float:
        """The share of the lists, nearest first, that holds FOUND of the neighbours of some of the sample."""
        q = sample[:CALIBRATE]
        score = (q / self.scale) @ (sample / self.scale).T
        score[ids[:len(q), None] == ids[None, :]] = -np.inf
        top = min(TOP, len(sample) - 1)
        if top < 1:
            return 1.0
        best = np.argpartition(-score, top - 1, axis=1)[:, :top]
        rank = np.argsort(np.argsort(self.distances(self.place(q, query=True), self.centroids), axis=1), axis=1)
        needed = rank[np.arange(len(q))[:, None], self.nearest_list(points)[best]]
        return float((np.quantile(needed, FOUND, method="higher") + 1) / len(self.centroids))

    def place(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x / self.scale
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, last[:, None]], axis=1) @ self.rotation

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0)


def best_of(query: np.ndarray, score: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Positions of each query's ``top`` distinct ids by best score, ties to the smaller id."""
    order = np.lexsort((-score, ids, query))
    q, i = query[order], ids[order]
    order = order[np.concatenate([[True], (q[1:] != q[:-1]) | (i[1:] != i[:-1])])[:len(q)]]   # the best row of each id
    order = order[np.lexsort((ids[order], -score[order], query[order]))]
    q = query[order]
    first = np.searchsorted(q, q, side="left")
    return order[np.arange(len(q)) - first < top]


def kth_distinct(away: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Per row, the ``k``-th smallest distance when each id counts once, with its nearest; infinite if there are fewer."""
    ids = np.broadcast_to(ids, away.shape)
    order = np.lexsort((away, ids), axis=1)
    d, i = np.take_along_axis(away, order, axis=1), np.take_along_axis(ids, order, axis=1)
    d[:, 1:][i[:, 1:] == i[:, :-1]] = np.inf
    return np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.full(len(d), np.inf)


def scan(space: Space, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, radius: np.ndarray, top: int,
         epsilon: float = EPSILON, probed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, vector position, score) of what a group of lists holds for a block of queries.  ``probed`` says which
    vectors each query may find (all, if not given)."""
    points, asked = space.place(vectors).astype(np.float32), space.place(queries, query=True).astype(np.float32)
    width = points.shape[1]
    slack = np.float32(1e-5 * (space.norm ** 2 + 1e-30))   # single precision may be off by less
    found_q, found_v, found_s = [], [], []
    step = max(1, PAIRS // max(1, len(points)))
    none = np.float32(np.inf)

    def block(q: np.ndarray, lo: int, hi: int) -> np.ndarray:
        x, y = points[:, lo:hi], q[:, lo:hi]
        return (y * y).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * (y @ x.T)

    for a in range(0, len(asked), step):
        q = asked[a:a + step]
        closed = ids[None, :] == query_ids[a:a + step, None]
        if probed is not None:
            closed |= ~probed[a:a + step]
        d = min(2 * COLUMNS, width)
        first, part = block(q, 0, min(COLUMNS, width)), None
        first[closed] = none
        limit = radius[a:a + step].copy()

        def bound(d: int) -> np.ndarray:
            here = limit * (d / width) * (1 + epsilon / d ** 0.5) ** 2 if d < width else limit * (1 + 1e-9)
            return (here + slack).astype(np.float32)

        alive = first <= bound(min(COLUMNS, width))[:, None]
        if d > COLUMNS and alive.mean() > DENSE:
            part = first + block(q, COLUMNS, d)
        else:
            part, d = first, min(COLUMNS, width)
        if len(points) > 4 * top:   # the radius that the best of the first blocks give
            near = np.argpartition(part, 2 * top, axis=1)[:, :2 * top]
            whole = ((points[near] - q[:, None, :]) ** 2).sum(axis=2).astype(np.float64)
            whole[np.take_along_axis(closed, near, axis=1)] = np.inf
            limit = np.minimum(limit, kth_distinct(whole, ids[near], top))
        alive &= part <= bound(d)[:, None]
        while d < width and alive.mean() > DENSE:
            e = min(d + COLUMNS, width)
            part += block(q, d, e)
            d = e
            alive &= part <= bound(d)[:, None]
        qi, vi = np.nonzero(alive & ~closed)
        so_far = part[qi, vi]
        while d < width and len(qi):
            e = min(d + COLUMNS, width)
            gap = points[vi, d:e] - q[qi, d:e]
            so_far += np.einsum("ij,ij->i", gap, gap)
            d = e
            keep = so_far <= bound(d)[qi]
            qi, vi, so_far = qi[keep], vi[keep], so_far[keep]
        score = np.concatenate([np.einsum("ij,ij->i", vectors[vi[lo:lo + PAIRS]], queries[a + qi[lo:lo + PAIRS]])
                                for lo in range(0, max(1, len(qi)), PAIRS)])
        best = best_of(qi, score, ids[vi], top)   # of distinct ids
        found_q.append(a + qi[best])
        found_v.append(vi[best])
        found_s.append(score[best])
    return np.concatenate(found_q), np.concatenate(found_v), np.concatenate(found_s)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part; components stay single where they are, others become double."""
    kind = "array<float>" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "array<double>"
    fine = vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding")).where(
        "vec_id IS NOT NULL AND size(embedding) > 0 AND exists(embedding, x -> x <> 0) "
        "AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    sizes = fine.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return fine.where(F.size("embedding") == (sizes["d"] if sizes else 0))


def packed_lists(sizes: dict[int, int], group: int) -> list[tuple[int, int, int]]:
    """(list, first group, shards): lists one after another in groups of about ``group`` vectors; a longer one has groups of its own."""
    out, at, held = [], 0, 0
    for c, n in sorted(sizes.items()):
        shards = max(1, -(-n // group))
        if held and (shards > 1 or held + n > group):
            at, held = at + 1, 0
        out.append((c, at, shards))
        if shards > 1:
            at += shards
        else:
            held += n
    return out


def search(spark: SparkSession, vectors: DataFrame, queries: DataFrame, top: int = TOP,
           probe_share: float | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest of ``vectors`` found for each row of ``queries`` (both
    (vec_id, embedding)), other than rows with its own id.  ``probe_share`` fixes the share of lists that is probed."""
    vectors, queries = written(spark, usable(vectors).distinct(), "ann-vectors"), usable(queries)
    vector = vectors.schema["embedding"].dataType.simpleString()
    n, scale = vectors.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))).first()
    scaled = lambda x: x.cast("double") / F.lit(scale or 1.0)
    norm = vectors.agg(F.sqrt(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + scaled(x) * scaled(x))))).first()[0]
    result = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], result)
    sample = vectors.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(FIT_VECTORS).toArrow()   # at most FIT_VECTORS rows
    dim = len(sample.column("embedding")[0])
    space = Space(rows_of(sample.column("embedding"), dim), sample.column("vec_id").to_numpy().astype(np.int64), norm, n, scale=scale)
    share = space.probe_share if probe_share is None else probe_share
    space = spark.sparkContext.broadcast(space)

    def join_list(batches):  # noqa: ANN001, ANN202
        for b in batches:
            near = space.value.nearest_list(space.value.place(rows_of(b.column(1), dim)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near, pa.int32())], ["vec_id", "embedding", "list"])

    listed = written(spark, vectors.mapInArrow(join_list, f"vec_id long, embedding {vector}, list int"), "ann-lists")
    # one row per list (at most one list per PER_LIST sampled vectors); empty lists have none and are not probed
    sizes = {r["list"]: r["n"] for r in listed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    filled = np.asarray(sorted(sizes))
    # ids that are in one list only count towards enough candidates; those in several might be counted twice
    single = listed.groupBy("vec_id").agg(F.min("list").alias("list"), F.max("list").alias("last")).where("list = last")
    single = {r["list"]: r["n"] for r in single.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    single = np.asarray([single.get(c, 0) for c in filled.tolist()])
    plan = packed_lists(sizes, GROUP)
    group_of = {c: (g, m) for c, g, m in plan}

    def probe(batches):  # noqa: ANN001, ANN202
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                s, ids = space.value, part.column(0).to_numpy()
                raw = rows_of(part.column(1), dim)
                q = s.place(raw, query=True)
                ranks = np.argsort(s.distances(q, s.centroids[filled]), axis=1)
                # on to the list with which they hold top other candidates (one id may be the query's own)
                need = (np.cumsum(single[ranks], axis=1) < top + 1).sum(axis=1) + 1
                probed = np.maximum(need, max(1, round(share * len(filled))))
                groups = []
                for x, m in zip(ranks, probed.tolist()):
                    lists: dict[int, list[int]] = {}
                    for c in filled[x[:m]].tolist():
                        g, shards = group_of[c]
                        for k in range(shards):
                            lists.setdefault(g + k, []).append(c)
                    groups.append([{"group": g, "lists": c} for g, c in lists.items()])
                away = s.distances(q, s.seed_points)
                away[s.seed_ids[None, :] == ids[:, None]] = np.inf
                radius = kth_distinct(away, s.seed_ids[None, :], top)
                scores = raw @ s.seeds.T
                scores[s.seed_ids[None, :] == ids[:, None]] = -np.inf
                qi, vi = np.nonzero(away <= radius[:, None] * (1 + 1e-9) + 1e-12)
                ok = np.isfinite(scores[qi, vi])
                qi, vi = qi[ok], vi[ok]
                score = np.einsum("ij,ij->i", s.seeds[vi], raw[qi])
                best = best_of(qi, score, s.seed_ids[vi], top)
                seeds = [[] for _ in range(len(q))]
                for x, v, sc in zip(qi[best].tolist(), s.seed_ids[vi[best]].tolist(), score[best].tolist()):
                    seeds[x].append({"vec_id": v, "score": sc})
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(radius),
                     pa.array(groups, pa.list_(pa.struct([("group", pa.int32()), ("lists", pa.list_(pa.int32()))]))),
                     pa.array(seeds, pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])))],
                    ["query_id", "embedding", "radius", "groups", "seeds"])

    probes = written(spark, queries.mapInArrow(
        probe, f"query_id long, embedding {vector}, radius double, groups array<struct<group:int,lists:array<int>>>, "
               "seeds array<struct<vec_id:long,score:double>>"), "ann-probes")
    blocks = max(1, -(-probes.count() // QUERY_BLOCK))
    places = F.broadcast(spark.createDataFrame(plan, "list int, first int, shards int"))   # one row per list
    key = ["group", "block"]
    v = (listed.join(places, "list").withColumn("group", (F.col("first") + F.pmod(F.xxhash64("vec_id", "embedding"), "shards")).cast("int"))
         .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(*key, "vec_id", "embedding", "list"))
    q = (probes.select("query_id", "embedding", "radius", F.inline("groups"))
         .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).select(*key, "query_id", "embedding", "radius", "lists"))

    def look(vs: pa.Table, qs: pa.Table) -> pa.Table:
        if not vs.num_rows or not qs.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids, query_ids = vs.column("vec_id").to_numpy(), qs.column("query_id").to_numpy()
        here, lists = np.unique(vs.column("list").to_numpy(), return_inverse=True)
        asks = np.zeros((len(query_ids), len(here)), bool)
        asked = qs.column("lists").combine_chunks()
        row = np.repeat(np.arange(len(query_ids)), np.diff(asked.offsets.to_numpy()))
        flat = asked.values.to_numpy()[asked.offsets[0].as_py():asked.offsets[-1].as_py()]
        at = np.minimum(np.searchsorted(here, flat), len(here) - 1)
        there = here[at] == flat
        asks[row[there], at[there]] = True
        out = []
        for lo in range(0, len(query_ids), 1024):   # what each query may find is a bit per vector
            hi = lo + 1024
            part = qs.slice(lo, 1024)
            qi, vi, score = scan(space.value, rows_of(vs.column("embedding"), dim), ids, rows_of(part.column("embedding"), dim),
                                 query_ids[lo:hi], part.column("radius").to_numpy(), top, probed=asks[lo:hi][:, lists])
            out.append(pa.table({"query_id": pa.array(query_ids[lo:hi][qi]), "vec_id": pa.array(ids[vi]), "score": pa.array(score)}))
        return pa.concat_tables(out)

    found = v.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(look, "query_id long, vec_id long, score double")
    seeds = probes.select("query_id", F.explode("seeds").alias("s")).select("query_id", "s.vec_id", "s.score")
    merged = found.unionByName(seeds).repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def q_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every row whose vec_id is divisible by 20, against all rows."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return search(spark, vectors, vectors.where("vec_id % 20 = 0"))
