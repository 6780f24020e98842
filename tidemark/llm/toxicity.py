"""Toxicity scores from a learnt lexicon, with misspellings and a look at the context.

*Lexicon.*  Words, and stems (the first 4 to 8 letters of longer words), that occur at least ``RATE_RATIO`` times as often per
word of toxic as of clean labelled documents, and in so many toxic documents that chance is unlikely among all the words
(copies of a document, which share the least hash of three words in a row, are one witness).  There is no limit on their number or share
beside that test.  Words that a chosen stem covers stay in the trie and count for the stem.  *Misspellings.*  Every distinct
word of a text is run as a Levenshtein automaton (its states are the sets of places within 0, 1 and 2 edits, as bits) against
the trie of lexicon words: distance 1 is allowed from 5 letters on, 2 from 9.  Stems match exactly.  *Context.*  Around each hit
``CONTEXT`` words are looked at: a hit between quotation marks, or after a word of reporting, is quoted.

Hits of each (term, kind), kind being exact, misspelt or quoted, are taken as Poisson with a rate per word in toxic and
one in clean documents, both learnt with smoothing.  A hit adds the log ratio of the two rates, every word of the text
subtracts the difference of the summed rates, so a stray hit in a long clean text weighs little.  A kind of a term is
smoothed towards the kind's rate over all terms; misspelt hits are expected in toxic texts at ``MISSPELT_SHARE`` of the
exact rate unless the labels say otherwise; misspelt and quoted hits never speak for a clean document.  The score is the
logistic function of prior plus weights.

Labels are learnt from rows with crc32(doc_id as text) mod 5 not 0 only, from at most ``fit_rows`` of them (those
with the smallest hash of the id; a documented bound of the fit).  Every text is scored whole; null and empty texts have
no hits and no words, so they score the prior.  A document with several label rows is toxic if any says so; null labels
are no label; labels without a document have no effect; rows that repeat doc_id are all read.  An empty table gives no
rows, and extra columns of any name stay in ``row``.  Without toxic or clean training rows the lexicon is empty
and every score is the smoothed share of toxic rows.
"""

from __future__ import annotations

import functools
import math
from collections import Counter, defaultdict
from collections.abc import Iterable
from operator import itemgetter

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let_go, per_document, slices, table, written

FIT_ROWS = 20_000
STEMS = (4, 5, 6, 7, 8)
CONTEXT = 4
RATE_RATIO = 20   # toxic against clean rate
CHANCE = 0.01     # expected terms of all that chance puts into the lexicon
MISSPELT_SHARE, MISSPELT_WORDS = 0.05, 50_000   # expected misspelt hits, and how many words that belief is worth
EXACT, MISSPELT, QUOTED = "exact", "misspelt", "quoted"
EDGE = " .,;:!?()[]{}<>|/\\*_~`'\"“”«»‘’„-"
OPEN, CLOSE = "\"“«„‘", "\"”»“’"
QUOTES = frozenset(OPEN)
REPORTING = frozenset("said says wrote writes quoted quote called saying dit citait sagte schrieb zitierte "
                      "dijo escribió citó".split())
CACHE_SIZE = 150_000


def bare(word: str) -> str:
    return word.strip(EDGE)


def terms_of(text: bytes | None) -> Counter:
    """How often the words of a text and, with a star, the stems of its longer words occur outside quotations."""
    words = text.decode().lower().split() if text else []
    if any(c in QUOTES for c in set(map(itemgetter(0), words))) or not REPORTING.isdisjoint(map(bare, words)):
        words = [w for i, w in enumerate(words) if not Scanner.quoted(words, i)]
    words = Counter(map(bare, words))
    out = Counter(words)
    for w, n in words.items():
        for k in STEMS:
            if len(w) > k:
                out[w[:k] + "*"] += n
    return out


class Lexicon:
    """Words in a trie and stems; looks words up exactly and within an edit distance.  An entry ``word>stem*`` is a word whose
    hits, misspelt ones too, count for the stem."""

    def __init__(self, entries: Iterable[str]):
        entries = sorted(set(entries))
        self.stems = {e[:-1] for e in entries if e.endswith("*") and ">" not in e}
        self.owner = dict(e.rsplit(">", 1) for e in entries if ">" in e)
        self.words = {e for e in entries if not e.endswith("*")} | self.owner.keys()
        self.trie: dict = {}
        for w in self.words:
            node = self.trie
            for c in w:
                node = node.setdefault(c, {})
                node[0] = max(node.get(0, 0), self.edits(len(w)))   # the most edits that a word below allows
            node[""] = w
        # a word within k edits of a term keeps one of the term's k + 1 pieces, moved by at most k places
        self.pieces: dict[str, set[int]] = defaultdict(set)
        for w in self.words:
            k = self.edits(len(w))
            if k:
                cuts = [round(len(w) * i / (k + 1)) for i in range(k + 2)]
                for a, b in zip(cuts, cuts[1:]):
                    self.pieces[w[a:b]].update(range(max(0, a - k), a + k + 1))
        self.longest = max(map(len, self.words), default=0)

    @staticmethod
    def edits(length: int) -> int:
        return 0 if length < 5 else 1 if length < 9 else 2

    @functools.cached_property
    def piece_finder(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for p, places in self.pieces.items():
            found.add_word(p, (len(p) - 1, frozenset(places)))
        if self.pieces:
            found.make_automaton()
        return found

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "piece_finder"}   # every worker builds its own

    def may_match(self, word: str) -> bool:
        return bool(self.pieces) and any(end - back in places for end, (back, places) in self.piece_finder.iter(word))

    def nearest(self, word: str) -> str | None:
        """The lexicon word at the smallest allowed distance (ties: the first in order), by intersecting the
        word's Levenshtein automaton with the trie."""
        best: tuple[int, str] | None = None
        places: dict[str, int] = {}   # letter -> bit set of its places in the word
        for i, x in enumerate(word):
            places[x] = places.get(x, 0) | 1 << i
        end = 1 << len(word)
        inside = 2 * end - 1
        # bit i of a state's sets: the word's first i letters are within 0, 1 or 2 edits of the path
        todo = [(self.trie, 1, 3 & inside, 7 & inside)]
        while todo:
            node, s0, s1, s2 = todo.pop()
            if s2 & end:
                term = node.get("")
                if term is not None:
                    found = (0 if s0 & end else 1 if s1 & end else 2, term)
                    if found[0] <= self.edits(len(term)) and (best is None or found < best):
                        best = found
            for c, child in node.items():
                if c:
                    here = places.get(c, 0)
                    t0 = (s0 & here) << 1
                    t1 = ((s1 & here | s0 | t0) << 1 | s0) & inside
                    t2 = ((s2 & here | s1 | t1) << 1 | s1) & inside
                    edits = child[0]
                    if (t2 if edits == 2 else t1 if edits else t0):
                        todo.append((child, t0, t1, t2))
        return best[1] if best else None

    def look_up(self, word: str) -> tuple[str, str] | None:
        """(term, exact or misspelt) of one raw word, None for most."""
        word = bare(word)
        if word in self.words:
            return self.owner.get(word, word), EXACT
        for k in reversed(STEMS):
            if len(word) > k and word[:k] in self.stems:
                return word[:k] + "*", EXACT
        if 3 <= len(word) <= self.longest + 2 and self.may_match(word):
            near = self.nearest(word)
            if near:
                return self.owner.get(near, near), MISSPELT
        return None


class Scanner(dict):
    """Finds the lexicon's hits in texts; remembers words (a dict of raw word -> look_up)."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):  # noqa: ANN204
        got = self.lexicon.look_up(word)
        if len(word) < 64:
            if len(self) >= CACHE_SIZE:
                self.clear()
            self[word] = got
        return got

    def hits(self, text: bytes | None) -> list[tuple[int, str, str]]:
        """(word position, term, kind) of every hit."""
        words = text.decode().lower().split() if text else []
        return [(i, m[0], QUOTED if self.quoted(words, i) else m[1])
                for i, m in enumerate(map(self.__getitem__, words)) if m]

    @staticmethod
    def quoted(words: list[str], i: int) -> bool:
        before, after = words[max(0, i - CONTEXT):i], words[i + 1:i + 1 + CONTEXT]
        opened = words[i][0] in OPEN or any(w[0] in OPEN and w[-1] not in CLOSE for w in before)
        closed = words[i].rstrip(".,;:!?")[-1:] in CLOSE or any(w.rstrip(".,;:!?")[-1:] in CLOSE for w in after)
        return opened and closed or any(bare(w) in REPORTING for w in before)

    def features(self, text: bytes | None) -> Counter:
        return Counter(f"{term} {kind}" for _, term, kind in self.hits(text))


def choose_lexicon(found: dict[str, int]) -> list[str]:
    """Entries from term -> toxic documents: of nested stems the longest that keeps nine tenths of the toxic documents, no
    stem that one word explains, and words that a chosen stem covers as words of the (longest) stem."""
    words = {t: p for t, p in found.items() if not t.endswith("*")}
    stems: dict[str, int] = {}
    for t in sorted((t for t in found if t.endswith("*")), key=lambda t: (-len(t), t)):
        s, p = t[:-1], found[t]
        longer = [x for x in stems if x.startswith(s)]
        by_word = max([words[w] for w in words if w.startswith(s)], default=0)
        if by_word >= 0.9 * p or any(stems[x] >= 0.9 * p for x in longer):
            continue
        for x in longer:
            del stems[x]
        stems[s] = p
    out = [s + "*" for s in stems]
    for w in words:
        cover = max((w[:k] for k in STEMS if len(w) > k and w[:k] in stems), key=len, default=None)
        out.append(w if cover is None else f"{w}>{cover}*")
    return sorted(out)


def terms_in(lexicon: list[str]) -> list[str]:
    """The terms that hits count for."""
    return [e for e in lexicon if ">" not in e]


def weigh(counts: dict[str, tuple[int, int]], lexicon: list[str], toxic_words: int, clean_words: int) -> tuple[dict[str, float], float]:
    """(feature -> weight of a hit, weight of every word) from hits in toxic and clean documents."""
    lexicon = terms_in(lexicon)
    t, weights, per_word = max(1, len(lexicon)), {}, 0.0
    sums = {k: [sum(counts.get(f"{x} {k}", (0, 0))[i] for x in lexicon) for i in (0, 1)] for k in (EXACT, MISSPELT, QUOTED)}
    exact_rate = (sums[EXACT][0] + 0.5) / (t * toxic_words + 1)
    rates = {EXACT: (0.5 / (toxic_words + 1), 0.5 / (clean_words + 1)),
             MISSPELT: ((sums[MISSPELT][0] + MISSPELT_WORDS * MISSPELT_SHARE * exact_rate) / (t * toxic_words + MISSPELT_WORDS),
                        (sums[MISSPELT][1] + 0.5) / (t * clean_words + 1)),
             QUOTED: ((sum(sums[QUOTED]) + 0.5) / (t * (toxic_words + clean_words) + 1),) * 2}
    for x in lexicon:
        for kind, (rate_p, rate_n) in rates.items():
            p, n = counts.get(f"{x} {kind}", (0, 0))
            k = 0.5 if kind == EXACT else 1.0    # hits that the smoothing is worth
            in_toxic = (p + k) / (toxic_words + k / rate_p)
            in_clean = (n + k) / (clean_words + k / rate_n)
            weight = math.log(in_toxic / in_clean)
            weights[f"{x} {kind}"] = weight if kind == EXACT else max(0.0, weight)
            if kind == EXACT:
                per_word -= in_toxic - in_clean
    return weights, per_word


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


Model = tuple[list[str], dict[str, float], float, float]   # lexicon, weights, weight of a word, prior


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A few hundred numbers from at most ``fit_rows`` labelled documents."""
    usable = (labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
              .where(fold(F.col("doc_id"), 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")   # the sample has at most fit_rows rows
    rows = written(spark, rows.select("text", "toxic"), "toxicity-fit")
    totals = {r["bad"]: r for r in rows.groupBy((F.col("toxic") > 0).alias("bad")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size(F.split("text", r"\s+"))).alias("words")).collect()}
    n_toxic, n_clean = (totals[k]["n"] if k in totals else 0 for k in (True, False))
    prior = math.log((n_toxic + 0.5) / (n_clean + 0.5))
    if not n_toxic or not n_clean:
        return [], {}, 0.0, prior
    toxic_words, clean_words = (max(1, totals[k]["words"] or 0) for k in (True, False))

    def counted(features_of) -> DataFrame:  # noqa: ANN001
        """Per feature: toxic documents, hits in toxic and in clean documents."""
        def run(batches):  # noqa: ANN001, ANN202
            let_go()
            for part, texts in slices(batches, lambda b: b.column(0)):
                docs_with, pos, neg = Counter(), Counter(), Counter()
                for t, toxic in zip(texts, part.column(1).to_pylist()):
                    found = features_of(t)
                    (pos if toxic else neg).update(found)
                    if toxic:
                        docs_with.update(found.keys())
                keys = list(pos.keys() | neg.keys())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64())
                                                                                 for c in (docs_with, pos, neg)]], ["f", "d", "p", "n"])
        return (rows.mapInArrow(run, "f string, d long, p long, n long").groupBy("f")
                .agg(F.sum("d").alias("d"), F.sum("p").alias("p"), F.sum("n").alias("n")))

    # so many toxic documents that chance is unlikely among this many different terms
    share = n_toxic / (n_toxic + n_clean)
    least = math.ceil(math.log((toxic_words + clean_words) / CHANCE) / -math.log(share))
    rate = (F.col("p") * clean_words) >= RATE_RATIO * toxic_words * (F.col("n") + 0.5)
    # at most the terms that occur ``least`` times in fit_rows documents
    likely = frozenset(r["f"] for r in counted(terms_of).where((F.col("d") >= least) & rate).select("f").collect())

    def witnesses(batches):  # noqa: ANN001, ANN202
        """The likely terms of toxic documents with the least hash of three words in a row, which copies share."""
        let_go()
        for part, texts in slices(batches, lambda b: b.column(0)):
            found = []
            for t in texts:
                here = likely.intersection(terms_of(t))
                if here:
                    words = t.lower().split()
                    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
                    least_hash = min(map(xxhash.xxh3_64_intdigest, runs)) >> 1
                    found += [(f, least_hash) for f in here]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([h for _, h in found], pa.int64())], ["f", "h"])

    seen = (rows.where("toxic > 0").select("text").mapInArrow(witnesses, "f string, h long").groupBy("f").agg(F.count_distinct("h").alias("d"))
            .where(F.col("d") >= least).collect())   # at most the likely terms
    lexicon = choose_lexicon({r["f"]: r["d"] for r in seen})
    scanner = Scanner(Lexicon(lexicon))
    counts = {r["f"]: (r["p"], r["n"]) for r in counted(scanner.features).collect()}   # at most three features a term
    return lexicon, *weigh(counts, lexicon, toxic_words, clean_words), prior


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns of ``docs``), score, and the hits: array of (position, term, kind)."""
    lexicon, weights, per_word, prior = model
    shared = Scanner(Lexicon(lexicon))   # pickled with the function, a few hundred entries

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        let_go()
        out, hits = [], []
        for t in texts:
            found, n_words = shared.hits(t), len(t.split()) if t else 0
            z = prior + per_word * n_words + math.fsum(weights.get(f"{term} {kind}", 0.0) for _, term, kind in found)
            out.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
            hits.append([{"position": i, "term": term, "kind": kind} for i, term, kind in found])
        kind = pa.list_(pa.struct([("position", pa.int32()), ("term", pa.string()), ("kind", pa.string())]))
        return {"score": pa.array(out, pa.float64()), "hits": pa.array(hits, kind)}

    return per_document(docs, run, "score double, hits array<struct<position:int,term:string,kind:string>>")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    done = scores(docs, fit(spark, docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))
    return done.select("row.doc_id", (fold(F.col("row.doc_id"), 5) == 0).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
