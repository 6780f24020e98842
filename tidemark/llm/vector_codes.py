"""Vector codes by member-resident Lloyd iterations: every part of a vector lives with the codebook entry it is assigned to.

Vectors become integers ``floor(scale * x)`` and are cut into ``parts`` equal consecutive parts.  Each part position has
its own codebook, which starts as that part of the first vectors by vec_id (nulls last, then by components).

*Members.*  One row per vector and position, partitioned by its owner ``(position, entry, salt)`` and written there once.
The salt cuts an entry into owners of about ``MEMBERS`` rows, so an entry that holds a third of all rows, or copies of
one vector, is spread over many.
*Rounds.*  The owners sum up their resident members; the sums (one row per entry and component) give the new codebooks.
Then every owner looks for its members' nearest entries; only parts that change entry are shuffled, to their new owner, and
written as the members of that round.  Nothing else is written again: a member that was written in round ``g`` is still
resident iff its nearest entry under the codebooks of all rounds after ``g`` is the one it was placed at, which its owner
sees from the part itself.  All arithmetic is on integers, so results do not depend on the order of rows.

Rows are kept as they are, repeated ones too.  Rows whose vector is null or holds null or non-finite components are dropped.
Vectors of another length than the longest, and lengths that are no multiple of ``parts``, are padded with zeros at the
end.  Integers saturate where squared distances would leave 64 bits (at 64 components where abs(x) reaches 32768).  Fewer
rows than entries give as many entries as rows; an empty table gives no rows.  Distance ties go to the lower entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

from .common import list_array, null_safe, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MEMBERS = 4096      # rows of one owner, about
CHUNK = 8192        # parts whose distances are computed at a time
MEMBER = "rid long, position int, entry int, salt int, part array<int>"


def integer_vectors(vectors: DataFrame, parts: int, scale: int) -> tuple[DataFrame, int, int]:
    """(vec_id, label, ints) of the rows that take part, their number, and the width of a part."""
    usable = vectors.where("embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) "
                           "AND abs(x) < double('infinity'))")
    n, longest = usable.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    width = max(1, -(-(longest or 0) // parts))
    size = width * parts
    limit = float(1 << ((62 - (size - 1).bit_length()) // 2 - 1))

    def whole(x):  # noqa: ANN001, ANN202
        return F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-limit)), F.lit(limit))).cast("int")

    padded = F.concat(F.transform("embedding", whole), F.array_repeat(F.lit(0), F.lit(size) - F.size("embedding")))
    return usable.select("vec_id", "label", padded.alias("ints")), n, width


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part (ties: the lower one) and its squared distance."""
    entry, away = np.zeros(len(parts), np.int32), np.zeros(len(parts), np.int64)
    for a in range(0, len(parts), CHUNK):
        gap = parts[a:a + CHUNK, None, :] - book[None, :, :]
        far = np.einsum("ijk,ijk->ij", gap, gap)
        entry[a:a + CHUNK] = far.argmin(axis=1)
        away[a:a + CHUNK] = far.min(axis=1)
    return entry, away


class Residents:
    """The members of a batch that are still resident after the rounds up to ``now``; ``books[r]`` holds the codebooks
    (position, entry, component) by which the members of round ``r`` were placed."""

    def __init__(self, batch: pa.RecordBatch, books: list[np.ndarray], now: int):
        rid, position, entry, salt, parts, born = (batch.column(i) for i in range(6))
        width = books[0].shape[2]
        self.books, position, entry = books, position.to_numpy(), entry.to_numpy()
        parts = parts.flatten().to_numpy().astype(np.int64).reshape(-1, width)
        born = born.to_numpy()
        stays = np.ones(len(entry), bool)
        for r in range(1, now + 1):
            asked = np.flatnonzero(stays & (born < r))
            stays[asked] = self._nearest(r, position[asked], parts[asked])[0] == entry[asked]
        keep = np.flatnonzero(stays)
        self.rid, self.salt = rid.take(pa.array(keep)), salt.take(pa.array(keep))
        self.position, self.entry, self.parts = position[keep], entry[keep], parts[keep]

    def _nearest(self, r: int, position: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entry, away = np.zeros(len(parts), np.int32), np.zeros(len(parts), np.int64)
        for p in np.unique(position).tolist():
            at = np.flatnonzero(position == p)
            entry[at], away[at] = nearest(parts[at], self.books[r][p])
        return entry, away

    def nearest(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        return self._nearest(r, self.position, self.parts)


def train(spark: SparkSession, kept: DataFrame, n: int, width: int, parts: int, entries: int,
          rounds: int) -> tuple[DataFrame, list[np.ndarray]]:
    """The members with their round, and the codebooks of all rounds.  ``kept``: (rid, vec_id, ints)."""
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).select("ints").collect()
    start = np.asarray([r[0] for r in first], np.int64).reshape(len(first), parts, width)
    books = [np.ascontiguousarray(start.transpose(1, 0, 2))]
    root = scratch_path(spark, "lloyd-members")
    salts = -(-n // MEMBERS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                rid, ints = b.column(0).slice(at, CHUNK), b.column(1).slice(at, CHUNK)
                x = ints.flatten().to_numpy().astype(np.int64).reshape(-1, parts, width)
                salt = pa.array((rid.to_numpy() % salts).astype(np.int32))
                for p in range(parts):
                    entry, _ = nearest(x[:, p], books[0][p])
                    yield pa.RecordBatch.from_arrays(
                        [rid, pa.array(np.full(len(x), p, np.int32)), pa.array(entry), salt,
                         list_array(x[:, p].reshape(-1), np.full(len(x), width), pa.int32())],
                        ["rid", "position", "entry", "salt", "part"])

    def move_to_owners(rows: DataFrame, r: int) -> None:
        rows.repartition("position", "entry", "salt").write.mode("overwrite").parquet(f"{root}/round={r}")

    def members() -> DataFrame:
        return spark.read.schema(f"{MEMBER}, round int").parquet(root)

    def sums(batches: Iterator[pa.RecordBatch], now: int) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, len(first), width + 1), np.int64)   # of each entry: its component sums, then its size
        for b in batches:
            m = Residents(b, books, now)
            np.add.at(total, (m.position, m.entry), np.concatenate([m.parts, np.ones((len(m.parts), 1), np.int64)], axis=1))
        p, e, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([*[pa.array(x.astype(np.int32)) for x in (p, e, c)], pa.array(total[p, e, c])],
                                         ["position", "entry", "component", "total"])

    def movers(batches: Iterator[pa.RecordBatch], now: int) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = Residents(b, books, now - 1)
            entry, _ = m.nearest(now)
            go = np.flatnonzero(entry != m.entry)
            at = pa.array(go)
            yield pa.RecordBatch.from_arrays(
                [m.rid.take(at), pa.array(m.position[go]), pa.array(entry[go]), m.salt.take(at),
                 list_array(m.parts[go].reshape(-1), np.full(len(go), width), pa.int32())],
                ["rid", "position", "entry", "salt", "part"])

    move_to_owners(kept.select("rid", "ints").mapInArrow(place, MEMBER), 0)
    for r in range(1, rounds + 1):
        partial = members().mapInArrow(lambda b, now=r - 1: sums(b, now), "position int, entry int, component int, total long")
        book = books[-1].copy()
        total = np.zeros((parts, len(first), width + 1), np.int64)
        # at most one row per entry and component
        for p, e, c, x in partial.groupBy("position", "entry", "component").agg(F.sum("total")).collect():
            total[p, e, c] = x
        used = total[:, :, -1] > 0
        book[used] = total[used][:, :-1] // total[used][:, -1:]   # numpy's integer division goes down
        books.append(book)
        move_to_owners(members().mapInArrow(lambda b, now=r: movers(b, now), MEMBER), r)
    return members(), books


def codebook_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress(spark: SparkSession, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes array<int>, errors array<long>), by part position, and the codebooks (position, entry,
    component).  ``vectors`` has vec_id, embedding and label."""
    ints, n, width = integer_vectors(vectors.select("vec_id", "label", "embedding"), parts, scale)
    names = ints.select("vec_id", "label").schema
    result = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in names)}, codes array<int>, errors array<bigint>"
    if not n:
        return spark.createDataFrame([], result), np.zeros((parts, 0, width), np.int64)
    kept = written(spark, ints.withColumn("rid", F.monotonically_increasing_id()), "lloyd-vectors")
    members, books = train(spark, kept, n, width, parts, entries, rounds)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = Residents(b, books, rounds)
            entry, away = m.nearest(rounds)
            yield pa.RecordBatch.from_arrays([m.rid, pa.array(m.position), pa.array(entry), pa.array(away)],
                                             ["rid", "position", "entry", "error"])

    found = members.mapInArrow(codes, "rid long, position int, entry int, error long")
    by_vector = found.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("position", "entry", "error"))).alias("all"))
    return (kept.select("rid", "vec_id", "label").join(by_vector, "rid")
            .select("vec_id", "label", F.col("all.entry").alias("codes"), F.col("all.error").alias("errors")), books[-1])


def q_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    found, books = compress(spark, table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    digest = hashlib.sha256(codebook_text(books).encode()).hexdigest()
    each = written(spark, found.select(
        "vec_id", "label", F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        F.aggregate("errors", F.lit(0).cast("long"), lambda a, x: a + x).alias("error")), "vector-codes")
    by_label = each.groupBy("label").agg(F.sum("error").alias("label_error"))
    return null_safe(each, by_label, ["label"], "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _rounds_sql() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (SELECT rid, p, arg_min(e, d * {ENTRIES} + e) AS e, min(d) AS d
  FROM (SELECT c.rid, c.p, b.e, sum((c.v - b.v) * (c.v - b.v))::BIGINT AS d FROM comp c JOIN book{r} b USING (p, j) GROUP BY ALL)
  GROUP BY rid, p)""")
        if r < ROUNDS:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, b.j, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
  SELECT p, e, j, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS v
  FROM comp JOIN near{r} USING (rid, p) GROUP BY p, e, j) m USING (p, e, j))""")
    return ",".join(steps)


VECTOR_CODES_SQL = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS MATERIALIZED (SELECT rid, (i - 1) // (n // {PARTS}) AS p, (i - 1) % (n // {PARTS}) AS j, floor({SCALE} * x::DOUBLE)::HUGEINT AS v
  FROM (SELECT rid, len(embedding) AS n, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, j, v FROM comp WHERE rid <= {ENTRIES}),{_rounds_sql()},
each AS (SELECT rid, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY rid),
digest AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, j)) AS h FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN each USING (rid), digest
"""
