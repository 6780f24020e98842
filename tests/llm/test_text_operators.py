"""Operators on texts against plain Python over the same rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from llm_helpers import rows_of
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, decontaminate, huffman, line_dedup, phrase_dedup, ppm, simhash, token_counts

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def collected(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["sample", "tricky", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


# --- byte-level BPE ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tik():
    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library_and_decodes_to_the_text(spark, docs, as_tables, tik):
    want = []
    for i, t in collected(docs):
        ids = tik.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t or "")))
    assert rows_of(byte_bpe.q_byte_bpe(spark, as_tables(documents=docs))) == sorted(want, key=str)


def test_prefix_tables_append_and_replace_exactly(tik):
    bpe = byte_bpe.PrefixBpe({b: i for b, i in byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.VOCABULARY)).items()})
    rng = random.Random(1)
    for _ in range(60):
        data = bytes(rng.choice(b"ab cdthe r\xc3\xa9") for _ in range(rng.randint(0, 300)))
        table = byte_bpe.Prefixes(bpe, data[:50])
        table.append(data[50:])
        assert table.ids() == bpe.merge(data)
        i = rng.randint(0, len(data))
        j = rng.randint(i, len(data))
        table.replace(i, j, b"then")
        assert table.data == data[:i] + b"then" + data[j:]
        assert table.ids() == bpe.merge(table.data)


def test_an_edit_recomputes_a_neighbourhood_only(tik):
    bpe = byte_bpe.PrefixBpe({b: i for b, i in byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.VOCABULARY)).items() if len(b) < 12})
    table = byte_bpe.Prefixes(bpe, b"the quick brown fox jumps over it " * 200)
    assert table.replace(100, 105, b"slow") < 400
    assert table.ids() == bpe.merge(table.data)


# --- word pieces ------------------------------------------------------------------------------------

def greedy(word, starts, goes_on):
    n, i, pieces = 0, 0, starts
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
        if j is None:
            return 1, 1
        n, i, pieces = n + 1, j, goes_on
    return n, 0


def test_token_counts_equal_greedy_longest_match(spark, docs, as_tables):
    pieces = token_counts.word_pieces(public_tokenizers.path(token_counts.VOCABULARY))
    known = {}
    want = []
    for i, t in collected(docs):
        words = (t or "").encode().split()
        got = [known.setdefault(w, greedy(w[:400], *pieces) if len(w) <= 400 else None) for w in words]
        if None in got:
            continue
        want.append((i, len(words), sum(x[0] for x in got), sum(x[1] for x in got)))
    got = rows_of(token_counts.q_token_counts(spark, as_tables(documents=docs)))
    assert [r for r in got if r in want] == sorted(want, key=str)
    assert len(got) == docs.count()


def test_automaton_on_random_vocabularies():
    rng = random.Random(3)
    for _ in range(400):
        make = lambda: bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 4)))
        starts, goes_on = ({make() for _ in range(rng.randint(0, 6))} for _ in range(2))
        counter = token_counts.PieceCounter(starts, goes_on)
        for _ in range(10):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 10)))
            n, unknown = greedy(word, starts, goes_on)
            assert counter.count(word) == n + unknown * token_counts.UNKNOWN


# --- lines ------------------------------------------------------------------------------------------

def lines_kept(rows, min_docs, min_chars=1):
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    seen = defaultdict(set)
    for row, (_, t) in enumerate(rows):   # every row is a document
        for x in (t or "").split("\n"):
            seen[key(x)].add(row)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < min_chars or len(seen[key(x)]) < min_docs]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_line_dedup(spark, docs, as_tables):
    want = [(i, n, d, sha(t)) for i, n, d, t in lines_kept(collected(docs), 10)]
    assert rows_of(line_dedup.q_line_dedup(spark, as_tables(documents=docs))) == sorted(want, key=str)


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_line_dedup_counts_every_copy_of_a_row(spark, as_tables, monkeypatch, partitions):
    monkeypatch.setattr("tidemark.llm.common.WINDOW_BYTES", 300)
    rows = [(1, "hot line\nown line")] * 9 + [(2, "hot line\nhot line\nother")] + [(3, "nine\nnine")] * 9 + [(4, "twice")] * 4 + [(5, "twice")] * 6
    rows = [*rows, *[(9, "alone\nshared")] * 40, *[(None, None)] * 12, *[(6, "")] * 3]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = rows_of(line_dedup.q_line_dedup(spark, as_tables(documents=df)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == sorted([(i, n, d, sha(t)) for i, n, d, t in lines_kept(rows, 10)], key=str)
    lines = line_dedup.line_hashes(df, 1)
    assert lines.where("doc_id = 9").count() < 40 and lines.where("doc_id = 9 AND pos = 0").groupBy().sum("copies").first()[0] == 40


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_line_dedup_of_hot_lines_over_many_ranges(spark, partitions):
    rng = random.Random(5)
    hot = ["Share this!", " share THIS! ", "x", ""]
    rows = [(i, "\n".join(rng.choice([*hot, f"line {rng.randint(0, 60)}", f"own {i}"]) for _ in range(rng.randint(1, 12)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(spark, docs, 2, 4)).select("row.doc_id", "n_lines", "n_dropped", "kept")
        assert rows_of(got) == sorted(lines_kept(rows, 4, 2), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- recurring passages -----------------------------------------------------------------------------

def without_repeats(rows, window):
    words = [WHITE.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] > 1:
                gone |= set(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_phrase_dedup(spark, docs, as_tables):
    want = [(i, n, g, sha(t)) for i, n, g, t in without_repeats(collected(docs), 35)]
    assert rows_of(phrase_dedup.q_phrase_dedup(spark, as_tables(documents=docs))) == sorted(want, key=str)


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_phrase_dedup_with_small_windows_and_many_blocks(spark, block_bytes):
    rng = random.Random(8)
    phrase = [rng.choice("abcdefgh") * 2 for _ in range(40)]
    rows = []
    for i in range(80):
        own = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randint(0, 30))]
        a = rng.randint(0, 30)
        rows.append((i, " ".join(own[:10] + phrase[a:a + rng.randint(0, 25)] + own[10:] + ["q"] * (14 if i == 3 else 0))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = phrase_dedup.remove_repeats(spark, docs, 6, 3, block_bytes).select("doc_id", "n_words", "n_removed", "kept")
    assert rows_of(got) == sorted(without_repeats(rows, 6), key=str)


def test_phrase_dedup_holds_a_repeated_row_once(spark, monkeypatch):
    from tidemark.llm import common
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(n))
    hot, once = text(30), text(30)
    rows = [(1, hot)] * 500 + [(None, None)] * 30 + [(2, once)] + [(3, hot[:40] + " x")] + [(i, text(12)) for i in range(10, 200)] + [(4, "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dealt, _ = common.rows_in_blocks(docs, 2000)
    assert dealt.groupBy("block").count().agg({"count": "max"}).first()[0] < 60 < 500
    got = phrase_dedup.remove_repeats(spark, docs, 6, 3, 2000).select("doc_id", "n_words", "n_removed", "kept")
    assert rows_of(got) == sorted(without_repeats(rows, 6), key=str)


# --- benchmark --------------------------------------------------------------------------------------

BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(rows, items, window):
    windows = defaultdict(set)
    for item, t in items:
        w = BENCH.findall(low(t))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[i:i + window])].add(item)
    out = []
    for i, t in rows:
        w, hit, found = BENCH.findall(low(t)), set(), set()
        for s in range(len(w)):
            for k in {len(x) for x in windows}:
                if s + k <= len(w) and tuple(w[s:s + k]) in windows:
                    hit |= set(range(s, s + k))
                    found |= windows[tuple(w[s:s + k])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), sha(",".join(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_decontaminate(spark, docs, as_tables):
    items = [(1, "a b"), (1, "A b!"), (2, "same text HERE"), (3, ""), (None, "don t"), (4, None), (10, "long " * 30), (None, None)]
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()
    bench = items + [(r[0], r[1]) for r in bench]
    folder = as_tables(documents=docs, benchmark=spark.createDataFrame(bench, "item_id long, text string"))
    assert rows_of(decontaminate.q_decontaminate(spark, folder)) == sorted(contaminated(collected(docs), bench, 13), key=str)


def test_decontaminate_in_several_parts_and_without_items(spark, tricky):
    rows = collected(tricky)
    items = [(i, t) for i, t in [(1, "a b"), (2, "same text here"), (3, "long long long"), (4, "b a c d e f"), (5, "two spaces end")]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    from pyspark.sql import functions as F
    digest = ["row.doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(F.array_join("items", ",").cast("binary"), 256), "contaminated"]
    got = decontaminate.contamination(spark, tricky, bench, 3, 2, part_words=4).select(*digest)
    assert rows_of(got) == sorted(contaminated(rows, items, 3), key=str)
    got = decontaminate.contamination(spark, tricky, bench.limit(0)).select(*digest)
    assert rows_of(got) == sorted(contaminated(rows, [], 13), key=str)


def test_benchmark_parts_are_distinct_and_sized_by_bytes(spark):
    lines = "\n".join(f"word{i}" for i in range(50))
    items = [(i, f"{lines}\n{i}") for i in range(40)]
    bench = spark.createDataFrame(items + [(7, items[7][1])] * 200, "item_id long, text string")
    parts = [collected(p.withColumnRenamed("item_id", "doc_id")) for p in decontaminate._parts(bench, 500)]
    assert len(parts) > 1 and sorted(sum(parts, [])) == sorted(items)


# --- SimHash ----------------------------------------------------------------------------------------

def simhash_rows(rows, shingle=3, bits=2):
    prints = []
    for _, t in rows:
        w = WHITE.findall(low(t))
        grams = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return prints, component_ids(prints, [i for i, _ in rows], bits)


def component_ids(prints, ids, bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for a, i in enumerate(ids):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [least.get(find(a)) for a in range(len(prints))]


def test_simhash(spark, docs, as_tables):
    rows = collected(docs)
    prints, comp = simhash_rows(rows)
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, comp)]
    assert rows_of(simhash.q_simhash(spark, as_tables(documents=docs))) == sorted(want, key=str)


@pytest.mark.parametrize("hot", [2, 1000])
@pytest.mark.parametrize("bits", [1, 2])
def test_simhash_links_of_crowded_blocks(spark, hot, bits):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = list({c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) & (1 << 64) - 1 for c in centres for _ in range(40)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p,) for p in signed], "fp long")
    comp = {r["fp"]: r["root"] for r in simhash.components(spark, simhash.links(spark, classes, bits, hot)).collect()}
    assert [comp.get(p, p) for p in signed] == component_ids(prints, signed, bits)


# --- language model ---------------------------------------------------------------------------------

def ppm_scores(rows):
    order, local = ppm.ORDER, ppm.LOCAL
    discount = lambda n: ppm.DISCOUNTS[min(n, 3)]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    symbols = lambda t: [255] * local + list(low(t).encode()) + [255]
    grams, words = Counter(), Counter()
    for d, t in rows:
        if not held(d):
            q = symbols(t)
            grams.update(tuple(q[i - order:i + 1]) for i in range(local, len(q)))
            words.update(WHITE.findall(low(t)))
            words[None] += 1
    seen = [None] * (order + 1)
    for k in range(order, -1, -1):
        seen[k] = defaultdict(dict)
        for g, c in grams.items():
            seen[k][g[:-1]][g[-1]] = c
        grams = Counter(g[1:] for g in grams)   # a symbol counts once for each longer context
    n, v, out = sum(words.values()), len(words), []
    for d, t in rows:
        q, total, own = symbols(t), 0.0, defaultdict(Counter)
        for i in range(local, len(q)):
            p = 1 / 257
            for k in range(order + 1):
                here = seen[k].get(tuple(q[i - k:i]))
                if here is None:
                    break
                n_x = here.get(q[i], 0)
                p = (n_x - discount(n_x) + sum(map(discount, here.values())) * p) / sum(here.values())
            here = own[tuple(q[i - local:i])]
            if here:
                p = (max(here[q[i]] - ppm.LOCAL_DISCOUNT, 0) + ppm.LOCAL_DISCOUNT * sum(c > 0 for c in here.values()) * p) / sum(here.values())
            here[q[i]] += 1
            total += math.log10(p)
        w = [*WHITE.findall(low(t)), None]
        base = sum(math.log10((words[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((d, held(d), len(w), sum(words[x] > 0 for x in w), n, base, total))
    return out


@pytest.mark.parametrize("cells", [8_000_000, 3_000])
def test_ppm(spark, tricky, sample, cells):
    rows = [(i, t if t is None else t[:3000]) for i, t in collected(tricky)] + [(i, t[:400]) for i, t in collected(sample)[:30]]
    rows += [rows[-1]] * 7 + [(rows[-2][0], "another text of the id")]
    got = rows_of(ppm.score_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), cells, 4000))
    want = sorted(ppm_scores(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-6)


def test_ppm_does_not_depend_on_the_order_in_which_rows_arrive(spark, sample):
    """Every evaluation of the input has its rows in another order, as fetched shuffle blocks have."""
    rows = [(i, t[:600]) for i, t in collected(sample)[:60]] + [(None, "no id"), (None, None), (3, "a b c"), (3, "a b c")]

    def stir(batches):
        for b in batches:
            yield b.take(pa.array(np.random.default_rng().permutation(b.num_rows)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).mapInArrow(stir, "doc_id long, text string")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = rows_of(ppm.score_documents(spark, docs, block_bytes=4000))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    want = sorted(ppm_scores(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)


def peak_bytes(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_ppm_finds_grams_in_few_bytes_a_symbol():
    data = bytes(np.random.default_rng(1).integers(97, 101, 1 << 20, dtype=np.uint8))
    got, peak = peak_bytes(lambda: ppm.distinct_grams([data, None, b"", b"Abc"]))
    symbols = [b"\xff" * ppm.ORDER + low(t).encode() + b"\xff" for t in (data.decode(), None, "", "Abc")]
    assert got.tolist() == sorted({int.from_bytes(t[i:i + ppm.ORDER + 1], "big") for t in symbols for i in range(len(t) - ppm.ORDER)})
    assert peak < 20 * len(data)


def test_ppm_merges_counts_in_little_more_than_they_take():
    rng = np.random.default_rng(2)
    keys = [np.unique(rng.integers(-2**40, 2**40, n)) for n in (400_000, 0, 300_000, 5, 300_000)] + [np.arange(0, 900_000, 3)] * 2
    counts = [rng.integers(0, 9, len(k)) for k in keys]
    (k, n), peak = peak_bytes(lambda: ppm.add_counts(keys, counts))
    want, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    assert np.array_equal(k, want) and np.array_equal(n, np.bincount(inverse, np.concatenate(counts)).astype(np.int64))
    assert peak < 32 * sum(map(len, keys))   # 16 of them the result's
    assert [len(x) for x in ppm.add_counts([], [])] == [len(x) for x in ppm.add_counts([keys[1]], [counts[1]])] == [0, 0]


def test_ppm_without_training_rows(spark, empty):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    one = spark.createDataFrame([(held, "ab c")], "doc_id long, text string")
    (row,) = ppm.score_documents(spark, one).collect()
    assert row["score"] == pytest.approx(-5 * math.log10(257), rel=1e-6) and row["train_tokens"] == 0
    assert ppm.score_documents(spark, empty).count() == 0


def test_ppm_beats_the_base_on_held_out_texts(spark, sample):
    rows = ppm.score_documents(spark, sample).where("held_out").collect()
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_ppm_learns_from_more_text_than_short_contexts_can(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("octet_length(text) < 8000")
    rows = ppm.score_documents(spark, docs).where("held_out").select("base_score", "score").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


# --- Huffman ----------------------------------------------------------------------------------------

def test_huffman(spark, docs, as_tables):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(huffman.VOCABULARY))
    tokenizer.encode_special_tokens = True
    rows = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in collected(docs)]
    got = [tuple(r) for r in huffman.q_huffman(spark, as_tables(documents=docs)).orderBy("start").collect()]
    assert sorted((str(g[0]), g[2], g[3]) for g in got) == sorted((str(i), len(x), zlib.crc32(np.asarray(x, "<u4").tobytes())) for i, x in rows)
    assert [g[0] for g in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    assert [g[1] for g in got] == np.cumsum([0, *[g[2] for g in got]])[:-1].tolist()


def test_huffman_gives_added_tokens_their_ids(spark, as_tables):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(huffman.VOCABULARY))
    texts = ["one <|endoftext|> two", "<|endoftext|>", "x<|endoftext|><|endoftext|> y  z", "one two"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert [x.count(50256) for x in want] == [1, 1, 2, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in huffman.q_huffman(spark, as_tables(documents=docs)).orderBy("doc_id").collect()]
    assert [(g[0], g[2], g[3]) for g in got] == [(i, len(x), zlib.crc32(np.asarray(x, "<u4").tobytes())) for i, x in enumerate(want)]


def test_huffman_encoder_learns_words_not_lines():
    encoder = huffman.TextEncoder(public_tokenizers.path(huffman.VOCABULARY))
    words = [f"{a}{b}" for a in ("stone", "river", "tide", "mark", "leaf") for b in ("ab", "el", "ing", "ou", "u\u00e9")]
    texts = [f"{a}.\n{b}, {a}" for a in words for b in words]   # 625 pairs over a line end
    got = encoder.encode([t.encode() for t in texts])
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, encoder.kind).tolist() for x in got] == want
    assert len(encoder.known) <= 2 * len(words) + 10


def test_huffman_encoder_gives_the_librarys_ids():
    rng = np.random.default_rng(8)
    atoms = [" ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f",
             "\u3000", "\u200b", "a", "Word", "\xe9", "\xc8,", "\xd7", "\xf7.", "\u017f!", "e\u0301", "'", "'s", "'re", "'really", "don't", "12", "\xbd",
             "\u0663", "\u2026", "\u2014", "-", '."', "<|endoftext|>", "<|", "\u6f22\u5b57", "\U0001f600", "\x00", "_", "x" * 60]
    texts = [None, "", *["".join(rng.choice(atoms, rng.integers(1, 14))) for _ in range(4000)]]
    encoder = huffman.TextEncoder(public_tokenizers.path(huffman.VOCABULARY))
    want = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for step in (1000, 7):   # the second time most pieces are known
        raw = [t.encode() if t is not None else None for t in texts]
        got = [x for at in range(0, len(raw), step) for x in encoder.encode(raw[at:at + step])]
        assert [np.frombuffer(x, encoder.kind).tolist() for x in got] == want


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(0)
    for _ in range(20):
        counts = rng.geometric(0.02, rng.integers(2, 200))
        lengths = huffman.code_lengths(counts, 18)
        heap, cost = sorted(counts.tolist()), 0
        while len(heap) > 1:
            cost += heap[0] + heap[1]
            heap = sorted([heap[0] + heap[1], *heap[2:]])
        assert int((counts * lengths).sum()) == cost
    lengths = huffman.code_lengths(2 ** np.arange(1, 41), 10)
    assert lengths.max() == 10 and sum(2.0 ** -x for x in lengths.tolist()) == 1


def test_blocks_decode_independently():
    rng = np.random.default_rng(4)
    counts = np.bincount(rng.geometric(0.01, 20_000), minlength=3000)
    code = huffman.Code(huffman.code_lengths(counts, 18))
    blocks = [rng.choice(len(counts), n, p=counts / counts.sum()) for n in (0, 1, 255, 256, 257, 5000)]
    packed = [(*code.encode(b), len(b)) for b in blocks]
    for part in (packed, packed[::-1], packed[3:4]):
        for got, (_, _, n) in zip(code.decode(part), part):
            assert any(len(b) == n and (got == b).all() for b in blocks)
