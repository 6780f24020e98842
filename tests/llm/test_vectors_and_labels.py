"""Nearest neighbours, toxicity and the pipeline."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import rows_of
from test_text_operators import collected, component_ids, contaminated, lines_kept, simhash_rows

import corpus_pipeline
from tidemark.llm import ann, byte_bpe, common, toxicity

EMB = "vec_id long, embedding array<float>, rank int, list int, label string"


def brute(rows, top=20):
    vectors = [(i, np.asarray(e, np.float64)) for i, e in rows]
    out = {}
    for q, x in vectors:
        if q % 20 == 0:
            best = {}
            for i, y in vectors:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float(x @ y))
            out.setdefault(q, {})
            for i, s in best.items():
                out[q][i] = max(out[q].get(i, -np.inf), s)
    return {q: sorted(((-s, i) for i, s in b.items()))[:top] for q, b in out.items()}


def vectors(n, d=12, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) * scale * (1 + i % 3)).astype(np.float32).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, "x") for i, e in rows], EMB)


def test_ann_with_every_list_probed_is_exact(spark):
    rows = vectors(900)
    df = frame(spark, rows)
    got = ann.search(spark, df, df.where("vec_id % 20 = 0"), probe_share=1.0).collect()
    want = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert by.keys() == want.keys()
    hits = 0
    for q, found in by.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, 21))
        hits += len({x[1] for x in found} & {i for _, i in want[q]})
    assert hits >= 0.97 * 20 * len(want)   # the test of partial distances may give up a neighbour


def test_ann_recall_of_the_registered_query(spark):
    import duckdb
    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    want = brute(rows)
    got = ann.q_ann(spark, "/root/testdata/sf0.1").collect()
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in got}
    assert len(got) == len(found) == sum(map(len, want.values()))
    assert sum((q, i) in found for q, b in want.items() for _, i in b) >= 0.9 * len(found)


def test_ann_copies_bad_vectors_and_small_tables(spark, as_tables):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 3.0])]
    bad = [(40, None), (60, []), (80, [0.0, 0.0]), (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]), (140, [None, 1.0]),
           (160, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    got = rows_of(ann.q_ann(spark, as_tables(embeddings=frame(spark, rows + bad))))
    assert got == sorted([(q, k + 1, i, -s) for q, b in brute(rows).items() for k, (s, i) in enumerate(b)], key=str)
    assert ann.q_ann(spark, as_tables(embeddings=frame(spark, bad))).count() == 0
    assert ann.q_ann(spark, as_tables(embeddings=frame(spark, []))).count() == 0
    assert ann.q_ann(spark, as_tables(embeddings=frame(spark, [(20, [1.0, 2.0])]))).count() == 0


def test_ann_of_doubles_is_exact_at_any_scale(spark, as_tables):
    rng = np.random.default_rng(11)
    rows = [(i, (rng.normal(size=5) * scale).tolist()) for i, scale in enumerate([1e120, 1e-50, 1.0, 1e100] * 12)] + [(100, [1e-300, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in ann.search(spark, df, df.where("vec_id % 20 = 0"), top=60, probe_share=1.0).collect()}
    want = {(q, i): -s for q, b in brute(rows, 60).items() for s, i in b}
    assert got.keys() == want.keys() and got == pytest.approx(want, rel=1e-12)   # summed in another order


def test_ann_probes_few_lists_where_vectors_are_clustered():
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 16)) * 10
    x = centres[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, 16))
    clustered = ann.Space(x, np.arange(4000), float(np.sqrt((x * x).sum(axis=1).max())), 4000)
    plain = rng.normal(size=(4000, 64))
    plain /= np.linalg.norm(plain, axis=1)[:, None]
    spread = ann.Space(plain, np.arange(4000), 1.0, 4000)
    assert clustered.probe_share < 0.35 < 0.5 < spread.probe_share <= 1


def test_ann_lists_are_packed_into_groups():
    plan = ann.packed_lists({0: 5, 1: 3, 2: 40, 3: 4, 4: 9, 5: 1}, 10)
    assert plan == [(0, 0, 1), (1, 0, 1), (2, 1, 4), (3, 5, 1), (4, 6, 1), (5, 6, 1)]


def test_ann_hot_copies_tie_to_the_smaller_id(spark):
    rows = [(i, [1.0, 1.0, 0.5]) for i in range(300)] + vectors(200, 3, 1, 0.1)
    rows = [(k, e) for k, (_, e) in enumerate(rows)]
    df = frame(spark, rows)
    got = ann.search(spark, df, df.where("vec_id = 40")).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(20))


def test_ann_repeated_ids_do_not_crowd_out_others(spark):
    rng = np.random.default_rng(5)
    rows = vectors(400, 8, 2)
    hot = [(7, (np.asarray(rows[40][1]) * 3 + rng.normal(size=8) * 0.01).astype(np.float32).tolist()) for _ in range(200)]
    rows = rows + hot + rows   # one id with a third of the rows, all others twice
    df = frame(spark, rows)
    got = ann.search(spark, df, df.where("vec_id % 20 = 0"), probe_share=1.0).collect()
    want = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert {q: len(set(v)) for q, v in by.items()} == dict.fromkeys(want, 20) and len(got) == 20 * len(want)
    assert sum(len(set(by[q]) & {i for _, i in b}) for q, b in want.items()) >= 0.97 * len(got)


def test_ann_small_tables_return_every_candidate(spark):
    for n in (15, 21):
        df = frame(spark, vectors(n, 6, n))
        got = ann.search(spark, df, df.where("vec_id % 20 = 0")).collect()
        assert sorted((r["query_id"], r["vec_id"]) for r in got) == [(q, i) for q in range(0, n, 20) for i in range(n) if i != q]


def test_ann_centroids_are_distinct_vectors():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    x[:100] = x[0]
    space = ann.Space(x, np.arange(300), float(np.sqrt((x * x).sum(axis=1).max())), 300 * 300)
    near = space.distances(space.place(x), space.centroids).argmin(axis=1)
    assert len(space.centroids) == 201 == len(np.unique(near))


def test_scan_abandons_candidates_but_keeps_the_near():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    space = ann.Space(x[:1000], np.arange(1000), 1.0, 3000)
    q, v, s = ann.scan(space, x, np.arange(3000), x[:40], np.arange(40), np.full(40, np.inf), 20)
    truth = x[:40] @ x.T
    truth[np.arange(40), np.arange(40)] = -9
    top = np.argsort(-truth, axis=1)[:, :20]
    assert sum(len(set(v[q == i]) & set(top[i])) for i in range(40)) >= 0.95 * 800


# --- toxicity ---------------------------------------------------------------------------------------

def tox_tables(spark, n=400):
    rng = np.random.default_rng(0)
    plain = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("aro", "eni", "ilu", "opo", "umi")]
    bad = ["stupid", "moron", "pathetic"]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, 40))
        toxic = i % 5 == 0
        if toxic:
            for w in rng.choice(bad, 3):
                words.insert(int(rng.integers(0, 40)), w + rng.choice(["", ".", ","]))
        elif i % 5 == 1:
            words[10:10] = ["he", "wrote", '"you', rng.choice(bad), 'thing"', "there"]
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
            {i: t for i, _, t in labels})


def test_toxicity_learns_spares_quotations_and_catches_misspellings(spark, as_tables):
    docs, labels, toxic = tox_tables(spark)
    got = toxicity.q_toxicity(spark, as_tables(documents=docs, labels=labels)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in held) >= 0.97 * len(held)
    model = toxicity.fit(spark, docs, labels)
    assert {"stupid", "moron", "pathetic"} <= set(model[0])
    odd = spark.createDataFrame([(1, "baro stuupid deni mor0n gilu"), (2, 'baro he wrote "stupid" deni'), (3, None), (4, "")], "doc_id long, text string")
    scored = {r["doc_id"]: r for r in toxicity.scores(odd, model).select("row.doc_id", "score", "hits").collect()}
    assert scored[1]["score"] >= 0.5 and {h["kind"] for h in scored[1]["hits"]} == {"misspelt"}
    assert scored[2]["score"] < 0.5 and {h["kind"] for h in scored[2]["hits"]} == {"quoted"}
    assert scored[3]["score"] == scored[4]["score"] < 0.5


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def plain_hits(lexicon, text):
    """(position, term, kind) by comparing every word with every entry."""
    owner = dict(e.split(">") if ">" in e else (e, e) for e in lexicon if not (e.endswith("*") and ">" not in e))
    stems = [e[:-1] for e in lexicon if e.endswith("*") and ">" not in e]
    edge, opening, closing = toxicity.EDGE, toxicity.OPEN, toxicity.CLOSE
    words, out = (text or "").lower().split(), []
    for i, raw in enumerate(words):
        w = raw.strip(edge)
        cover = [x for x in stems if len(w) > len(x) and w.startswith(x)]
        near = sorted((d, t) for t in owner if (d := edit_distance(w, t)) <= (0 if len(t) < 5 else 1 if len(t) < 9 else 2))
        if w in owner:
            found = owner[w], "exact"
        elif cover:
            found = max(cover, key=len) + "*", "exact"
        elif len(w) >= 3 and near:
            found = owner[near[0][1]], "misspelt"
        else:
            continue
        before, after = words[max(0, i - 4):i], words[i + 1:i + 5]
        last = lambda x: x.rstrip(".,;:!?")[-1:]
        opened = raw[0] in opening or any(x[0] in opening and x[-1] not in closing for x in before)
        closed = (last(raw) and last(raw) in closing) or any(last(x) and last(x) in closing for x in after)
        told = any(x.strip(edge) in toxicity.REPORTING for x in before)
        out.append((i, found[0], "quoted" if (opened and closed) or told else found[1]))
    return out


def test_toxicity_scores_and_weights_equal_plain_counting(spark):
    import math
    docs, labels, toxic = tox_tables(spark, 300)
    odd = [(1000, "mor0n stupidd baro"), (1001, 'she said "pathetik" x'), (1002, "stupidity pathetically"), (1003, None), (1004, ""), (1005, "stu­pid MORON!")]
    model = toxicity.fit(spark, docs, labels)
    lexicon, weights, per_word, prior = model
    terms = [e for e in lexicon if ">" not in e]
    train = [(t, toxic[i]) for i, t in [(r[0], r[1]) for r in docs.collect()] if zlib.crc32(str(i).encode()) % 5]
    n_words = [sum(len(t.split()) for t, y in train if bool(y) is b) for b in (True, False)]
    n_docs = [sum(bool(y) is b for _, y in train) for b in (True, False)]
    assert prior == pytest.approx(math.log((n_docs[0] + 0.5) / (n_docs[1] + 0.5)))
    hits = {}
    for t, y in train:
        for _, term, kind in plain_hits(lexicon, t):
            hits.setdefault((term, kind), [0, 0])[0 if y else 1] += 1
    total = {k: [sum(hits.get((x, k), (0, 0))[i] for x in terms) for i in (0, 1)] for k in ("exact", "misspelt", "quoted")}
    m, (wt, wc) = len(terms), n_words
    exact_rate = (total["exact"][0] + 0.5) / (m * wt + 1)
    smooth = {"exact": (0.5 / (wt + 1), 0.5 / (wc + 1)),
              "misspelt": ((total["misspelt"][0] + 50_000 * 0.05 * exact_rate) / (m * wt + 50_000), (total["misspelt"][1] + 0.5) / (m * wc + 1)),
              "quoted": ((sum(total["quoted"]) + 0.5) / (m * (wt + wc) + 1),) * 2}
    want, slope = {}, 0.0
    for x in terms:
        for kind, (a, b) in smooth.items():
            p, n = hits.get((x, kind), (0, 0))
            k = 0.5 if kind == "exact" else 1.0
            in_toxic, in_clean = (p + k) / (wt + k / a), (n + k) / (wc + k / b)
            want[f"{x} {kind}"] = math.log(in_toxic / in_clean) if kind == "exact" else max(0.0, math.log(in_toxic / in_clean))
            slope -= (in_toxic - in_clean) if kind == "exact" else 0.0
    assert weights == pytest.approx(want) and per_word == pytest.approx(slope)
    everything = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    for r in toxicity.scores(everything, model).select("row.text", "score", "hits").collect():
        found = plain_hits(lexicon, r["text"])
        assert [(h["position"], h["term"], h["kind"]) for h in r["hits"]] == found
        z = prior + per_word * len((r["text"] or "").split()) + sum(want[f"{t} {k}"] for _, t, k in found)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)))


def test_the_lexicon_has_no_limit_but_chance(spark):
    """Sixty toxic words, each in under three of a hundred toxic documents, and one in the copies of one document only."""
    rng = np.random.default_rng(4)
    plain = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("aro", "eni", "ilu", "opo", "umi")]
    bad = [f"vile{a}{b}" for a in "qwxyz" for b in "abcdefghijkl"]
    rows, labels = [], []
    for i in range(8000):
        words = [*rng.choice(plain, 30)]
        if i % 2 == 0:
            words += rng.choice(bad, 1).tolist()
        rows.append((i, " ".join(words)))
        labels.append((i, 0, int(i % 2 == 0)))
    rows += [(9000 + i, "one copied text with a rareword in it") for i in range(60)]
    labels += [(9000 + i, 0, 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = toxicity.fit(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))[0]
    covered = {e.split(">")[0] for e in lexicon}
    assert set(bad) <= covered and "vile*" in lexicon and not any("rareword"[:4] in e for e in lexicon)
    look = toxicity.Lexicon(lexicon)
    assert look.look_up("vileqa") == ("vile*", "exact") and look.look_up("vilzqa") == ("vile*", "misspelt")


def test_nearest_equals_plain_edit_distance():
    lexicon = toxicity.Lexicon(["stupid", "moron", "pathetic", "worthless", "scum"])

    distance = edit_distance
    rng = np.random.default_rng(1)
    for _ in range(600):
        w = list(rng.choice(sorted(lexicon.words)))
        for _ in range(rng.integers(0, 4)):
            i = rng.integers(0, len(w) + 1)
            w[i:i + rng.integers(0, 2)] = list(rng.choice(["", "a", "m", "t"]))
        w = "".join(w)
        near = [(distance(w, t), t) for t in lexicon.words if distance(w, t) <= lexicon.edits(len(t))]
        assert lexicon.nearest(w) == (min(near)[1] if near else None)
        if near and w not in lexicon.words and len(w) >= 3:
            assert lexicon.look_up(w) == (min(near)[1], "misspelt")


def test_toxicity_of_tricky_and_empty_tables(spark, tricky, empty, as_tables):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, 0, 1), (3, 0, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.q_toxicity(spark, as_tables(documents=tricky, labels=labels)).collect()
    assert len(got) == tricky.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.q_toxicity(spark, as_tables(documents=empty, labels=labels.limit(0))).count() == 0


# --- pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages_equal_plain_python(spark, sample, as_tables):
    folder = "/root/testdata/sf0.001"
    docs = sample
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    model = toxicity.fit(spark, docs, spark.read.parquet(f"{folder}/labels.parquet"))
    bad = {r[0] for r in toxicity.scores(docs, model).where("score >= 0.5").select("row.doc_id").collect()}
    rows = [r for r in rows if r[0] not in bad]
    rows = [(i, t) for i, _, _, t in lines_kept(rows, 10)]
    _, comp = simhash_rows(rows)
    rows = [r for r, c in zip(rows, comp) if r[0] == c]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    keep = [not c[-1] for c in contaminated(rows, items, 13)]
    want = [r for r, k in zip(rows, keep) if k]
    got = corpus_pipeline.run(spark, folder)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(i for i, _ in want)
    import hashlib
    digests = {r["doc_id"]: r["decoded_sha256"] for r in got.collect()}
    assert digests == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want}


@pytest.mark.parametrize("name", ["tricky", "empty"])
def test_every_stage_on_odd_tables(spark, request, as_tables, name):
    docs = request.getfixturevalue(name)
    folder = as_tables(benchmark=spark.createDataFrame([(1, "same text here"), (2, None)], "item_id long, text string"),
                       labels=spark.createDataFrame([(1, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int"))
    rows = collected(docs)
    for stage, fn in corpus_pipeline.STAGES[:-1]:
        out = fn(spark, docs, folder)
        assert out.columns == docs.columns
        if stage == "simhash":
            prints, _ = simhash_rows(rows)
            assert len(rows_of(out)) == len(set(component_ids(prints, range(len(rows)), 2)))
        if stage == "line_dedup":
            assert out.count() == len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(rows)


def test_a_worker_keeps_the_tables_of_one_operator():
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    first = byte_bpe._encoder(path, public_tokenizers.PATTERN)
    assert byte_bpe._encoder(path, public_tokenizers.PATTERN) is first
    common.kept("another", dict)
    assert list(common._kept) == ["another"]
    common.let_go()
    assert not common._kept and byte_bpe._encoder(path, public_tokenizers.PATTERN) is not first
