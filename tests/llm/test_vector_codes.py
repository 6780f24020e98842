"""Member-resident Lloyd against plain Python integers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import rows_of

from tidemark.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label string, rid int, position int, entry string, codes int"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, e, lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    width = max(1, -(-max((len(e) for _, e, _ in kept), default=0) // parts))
    vectors = [[math.floor(4096 * x) for x in e] + [0] * (parts * width - len(e)) for _, e, _ in kept]
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for v in vectors]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, vectors[k]))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for v in cut:
            for p in range(parts):
                members[p, assign(p, v[p])[1]].append(v[p])
        for (p, e), xs in members.items():
            books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs))
    found = [[assign(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, lab), err in zip(kept, errors):
        by_label[lab] += err
    text = ",".join(str(x) for p in range(parts) for c in books[p] for x in c)
    return sorted([(i, "".join(f"{e:02x}" for _, e in f), err, by_label[lab], hashlib.sha256(text.encode()).hexdigest())
                   for (i, _, lab), f, err in zip(kept, found, errors)], key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, lab, 1, 2, "x", 3) for i, e, lab in rows], SCHEMA)


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(size=d).tolist(), [None, "a", "b"][k % 3]) for k, i in enumerate(rng.permutation(n))]


@pytest.mark.parametrize("n, d", [(1, 16), (9, 8), (150, 24), (60, 13), (40, 3)])
def test_codes_equal_plain_integers(spark, as_tables, n, d):
    rows = vectors(n, d, n)
    assert rows_of(vector_codes.q_vector_codes(spark, as_tables(embeddings=frame(spark, rows)))) == brute(rows)


def test_bad_rows_copies_and_repeated_ids(spark, as_tables):
    rows = vectors(80, 16, 3)
    hot = [(7, rows[5][1], "hot")] * 60 + [(7, rows[6][1], "hot")] * 3 + [(None, rows[8][1], None)] * 2
    bad = [(1, None, "a"), (2, [None] * 16, "a"), (3, [float("nan")] * 16, "a"), (4, [float("inf")] + [0.0] * 15, "a"), (-9, [-float("inf")] * 16, None)]
    short = [(90, [0.5, 0.25], "s"), (91, [], "s")]
    rows = rows + hot + short
    assert rows_of(vector_codes.q_vector_codes(spark, as_tables(embeddings=frame(spark, rows + bad)))) == brute(rows)


def test_empty_tables_give_no_rows(spark, as_tables):
    got = vector_codes.q_vector_codes(spark, as_tables(embeddings=frame(spark, [])))
    assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.q_vector_codes(spark, as_tables(embeddings=frame(spark, [(1, None, "x")]))).collect() == []


def test_huge_components_saturate(spark, as_tables):
    rows = [(1, [1e300] * 8, "a"), (2, [-1e300] * 8, "a"), (3, [0.0] * 8, None)]
    got = rows_of(vector_codes.q_vector_codes(spark, as_tables(embeddings=frame(spark, rows))))
    assert [r[1] for r in got] == ["00" * 8, "01" * 8, "02" * 8] and all(r[2] == 0 for r in got)


def test_an_entry_with_most_rows_has_many_owners(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MEMBERS", 32)
    rows = [(i, [1.0] * 8, "a") for i in range(600)] + [(1000 + i, e, "b") for i, e, _ in vectors(40, 8, 1)]
    ints, n, width = vector_codes.integer_vectors(frame(spark, rows), 8, 4096)
    from pyspark.sql import functions as F
    kept = ints.withColumn("rid", F.monotonically_increasing_id()).cache()
    members, _ = vector_codes.train(spark, kept, n, width, 8, 16, 2)
    owners = members.where("round = 0").groupBy("position", "entry", "salt").count()
    assert owners.agg(F.max("count")).first()[0] <= 3 * 32


def test_only_parts_that_change_entry_are_written_again(spark):
    rows = vectors(300, 16, 5)
    ints, n, width = vector_codes.integer_vectors(frame(spark, rows), 8, 4096)
    from pyspark.sql import functions as F
    kept = ints.withColumn("rid", F.monotonically_increasing_id()).cache()
    members, books = vector_codes.train(spark, kept, n, width, 8, 16, 6)
    written = {r["round"]: r["count"] for r in members.groupBy("round").count().collect()}
    x = np.asarray([r["ints"] for r in kept.collect()]).reshape(n, 8, width)
    placed = [np.stack([vector_codes.nearest(x[:, p], b[p])[0] for p in range(8)]) for b in books]
    assert written == {0: n * 8} | {r: int((a != b).sum()) for r, (a, b) in enumerate(zip(placed, placed[1:]), 1) if (a != b).any()}
