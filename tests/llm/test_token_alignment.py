"""Cross-tokenizer alignment against the libraries on whole texts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import rows_of
from tokenizers import Tokenizer

from tidemark.llm import token_alignment

A, B = (public_tokenizers.path(n) for n in (token_alignment.FIRST, token_alignment.SECOND))
ODD = ["<|endoftext|> and <s> </s> <unk> <0x0A>", " starts with a space", "  two", "ends ", "\n\nx\n y", "a▁b mark", "tab\tx  y   z", " nbsp   x",
       "中文 文字 没有", "a\x00b \x1c c", "é é ﬁ", "don't can't 12345 6.7", "🙂 🙂🙂", "x" * 300, "▁", " ", "\n", "word " * 3 + "\x85 y"]


def brute(rows):
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = token_alignment.byte_chars()

    def bytes_b(piece):
        m = re.fullmatch("<0x(..)>", piece)
        return bytes([int(m[1], 16)]) if m else piece.replace("▁", " ").encode()

    def spans(parts):
        out, at = [], 0
        for i, raw in parts:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    texts = {}
    for t in {t for _, t in rows if t}:
        a = [(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in first.encode(" " + t, add_special_tokens=False).ids]
        b = [(i, bytes_b(second.id_to_piece(i))) for i in second.encode(t)]
        if b"".join(x for _, x in a) == (" " + t).encode() == b"".join(x for _, x in b):
            texts[t] = spans(a), spans(b)
    links = {t: [(i, j) for i, _, x in a for j, _, y in b if x == y] for t, (a, b) in texts.items()}
    counts = Counter(p for _, t in rows for p in links.get(t, ()))
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(highest.get(j, 0), n)
    out = []
    for d, t in rows:
        if t not in texts:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = texts[t]
        cuts = sorted({x for *_, x in a} & {x for *_, x in b})
        groups, start = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, x, y in a if start <= x and y <= c) + "|" + ",".join(str(i) for i, x, y in b if start <= x and y <= c))
            start = c
        found = links[t]
        out.append((d, len(a), len(b), len(cuts), len(found), sum(counts[p] == highest[p[1]] for p in found), sum(counts[p] for p in found),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str), counts


def short(df):
    return df.where("text IS NULL OR length(text) < 1500")


@pytest.mark.parametrize("name", ["sample", "tricky", "empty"])
def test_alignment_equals_the_libraries(spark, as_tables, name, request):
    docs = short(request.getfixturevalue(name))
    want, _ = brute([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(token_alignment.q_token_alignment(spark, as_tables(documents=docs))) == want


def test_odd_texts_copies_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 200)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "the same copy of a text") for i in range(50)] + [(7, ODD[0]), (None, ODD[1])]
    df = spark.createDataFrame([(i, t, 9, 1, 2) for i, t in rows], "doc_id long, text string, n_a int, h1 int, block int")
    done, pairs = token_alignment.align(spark, df, A, B)
    want, counts = brute(rows)
    assert rows_of(done.select("row.doc_id", *token_alignment.MEASURES, "groups_sha256")) == want
    assert {(r["a"], r["b"]): r["total"] for r in pairs.collect()} == dict(counts)


def test_pieces_join_to_the_text_and_encode_alike():
    aligner = token_alignment.Aligner(A, B)
    for t in [*ODD, "plain words only here", "a b  c d", " lead", "trail ", "x 　 y z"]:
        cut = aligner.pieces(" " + t)
        assert "".join(cut) == " " + t and all(p[0] == " " for p in cut)
        whole = [aligner.first.encode(" " + t, add_special_tokens=False).ids, aligner.second.encode(t)]
        parts = [[i for p in cut for i in aligner.first.encode(p, add_special_tokens=False).ids], [i for p in cut for i in aligner.second.encode(p[1:])]]
        assert "▁" in t or parts == whole


def test_long_text_without_spaces_is_aligned_whole():
    aligner = token_alignment.Aligner(A, B)
    found = aligner.align(["ab" * 20_000, "plain"])
    assert [len(p) for p in found] == [1, 1] and sum(map(aligner.ok.__getitem__, found[0])) == 1
    assert " " + "ab" * 20_000 not in aligner.number
