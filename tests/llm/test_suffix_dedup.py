"""Longest-previous-factor dedup against brute force over all strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm_helpers import rows_of
from pyspark.sql import functions as F

from tidemark.llm import common, suffix_dedup


def brute(rows, length, row_key):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the kept bytes) of every row."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, row_key(rows[k])))
    seen, out = set(), []
    for k in order:
        d, t = rows[k]
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            else:
                seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        n_spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def keys_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = df.select("doc_id", "text", F.xxhash64(F.lit(11), "doc_id", "text").alias("k")).collect()
    keys = {(r[0], r[1]): r[2] for r in found}
    return lambda row: keys[row]


def result(df):
    return rows_of(df.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)))


@pytest.mark.parametrize("name", ["sample", "tricky", "empty"])
def test_query_equals_brute_force(spark, as_tables, name, request):
    docs = request.getfixturevalue(name).where("text IS NULL OR length(text) < 30000")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    got = rows_of(suffix_dedup.q_suffix_dedup(spark, as_tables(documents=docs)))
    assert got == (brute(rows, 100, keys_of(spark, rows)) if rows else [])


def texts(seed, n=60):
    """Passages of one small alphabet, zero bytes and periods among them, glued together in many ways."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab\x00é") for _ in range(rng.randint(5, 60))) for _ in range(8)] + ["ab" * 40, "x" * 90]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for i in range(n)]
    return rows + [(3, rows[4][1]), (3, rows[5][1]), (None, rows[6][1]), (None, None), (7, None), (7, "")] + [rows[8]] * 5 + [(None, "x" * 50)] * 2


@pytest.mark.parametrize("hot, block_bytes, run, seed", [(4096, 1 << 20, 16, 0), (4096, 700, 16, 1), (2, 700, 8, 2), (0, 400, 16, 3), (1, 1500, 24, 4)])
def test_glued_passages_in_small_blocks(spark, hot, block_bytes, run, seed):
    rows = texts(seed)
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, row_key int, block string, copies int")
    got = suffix_dedup.remove_later_copies(df, length=40, run=run, block_bytes=block_bytes, hot=hot)
    assert result(got) == brute(rows, 40, keys_of(spark, rows))


def test_spans_and_kept_bytes_make_up_the_text(spark):
    rows = [(i, t) for i, t in texts(9) if t is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string").dropDuplicates(["doc_id"])
    by = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
    for r in suffix_dedup.remove_later_copies(df, length=40, run=16, block_bytes=900).collect():
        gone = np.zeros(r["n_bytes"], bool)
        for s in r["spans"]:
            assert not gone[s["start"]:s["end"]].any() and s["end"] - s["start"] >= 40
            gone[s["start"]:s["end"]] = True
        assert bytes(x for x, g in zip(by[r["doc_id"]], gone) if not g) == bytes(r["kept"])


def test_a_row_repeated_many_times_is_one_row_per_task(spark):
    text = "a passage of over one hundred bytes, " * 5
    df = spark.createDataFrame([(1, text)] * 900 + [(k, f"{k} other") for k in range(2, 300)], "doc_id long, text string").repartition(6)
    rows, _ = common.rows_in_blocks(df)
    assert rows.where("doc_id = 1").count() <= 12 and rows.where("doc_id = 1").agg(F.sum("copies")).first()[0] == 900
    got = suffix_dedup.remove_later_copies(df).where("doc_id = 1").groupBy("n_removed").count().collect()
    assert {r["n_removed"]: r["count"] for r in got} == {len(text) - 37: 1, len(text): 899}   # one period of 37 bytes stays


def test_a_passage_that_many_documents_continue_is_no_large_group(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    tail = lambda: "".join(rng.choice("ijklmnop ") for _ in range(120))
    rows = [(i, tail() + passage + tail()) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_later_copies(df, hot=8, block_bytes=1 << 12)
    assert result(got) == brute(rows, 100, keys_of(spark, rows))


def test_longest_previous_factors_equal_the_definition():
    rng = random.Random(5)
    for _ in range(200):
        s = "".join(rng.choice("ab") for _ in range(rng.randint(1, 40)))
        order = sorted(range(len(s)), key=lambda i: s[i:])

        def common_prefix(i, j):
            k = 0
            while max(i, j) + k < len(s) and s[i + k] == s[j + k]:
                k += 1
            return k
        shared = [0] + [common_prefix(a, b) for a, b in zip(order, order[1:])]
        want = [max((common_prefix(i, j) for j in range(i)), default=0) for i in range(len(s))]
        assert suffix_dedup.longest_previous_factors(np.asarray(order), np.asarray(shared)).tolist() == want


def test_parameters_are_checked(spark, sample):
    with pytest.raises(ValueError):
        suffix_dedup.remove_later_copies(sample, length=100, run=30)
    with pytest.raises(TypeError):
        suffix_dedup.remove_later_copies(sample.withColumn("doc_id", F.col("doc_id").cast("string")))
