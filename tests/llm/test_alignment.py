"""Cross-tokenizer alignment against encodings of whole texts and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from threadlens.llm import token_alignment as ta

A, B, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
ODD = ["", " ", "  ", "a", "\n", "x\n\n y", "<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "▁", "é" * 5, "日本語のテキスト 汉字", "👩‍👩‍👧 flags 🇩🇪", "= " * 9 + "=" * 300, "a\x00b",
       "\t\ttabs\t", " leading", "trailing   ", "nb\xa0sp", "it's we'll 'tis", "mixed١٢٣ digits 42", "é combining", "​﻿ zero", "ab" * 4000, " " * 500 + "x", "퟿"]


def whole(texts):
    """Per text (A ids with bytes, B ids with bytes), both empty if a vocabulary does not give the text back."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: k for k, c in enumerate(ta.byte_characters())}
    out = []
    for t in texts:
        if not t:
            out.append(([], []))
            continue
        left = a.encode(" " + t, add_special_tokens=False)
        mine = [(i, bytes(byte[c] for c in token)) for i, token in zip(left.ids, left.tokens)]
        other = []
        for i in b.encode(t):
            piece = b.id_to_piece(i)
            other.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        same = all(b"".join(x for _, x in side) == (" " + t).encode() for side in (mine, other))
        out.append((mine, other) if same else ([], []))
    return out


def plain(texts):
    """Rows of the operator without the id, by plain loops."""
    found = []
    for mine, other in whole(texts):
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (mine, other)]
        both, groups = ends[0] & ends[1], defaultdict(lambda: ([], []))
        for k, side in enumerate((mine, other)):
            at = 0
            for i, x in side:
                groups[sum(e <= at for e in both)][k].append(i)
                at += len(x)
        groups = [groups[g] for g in sorted(groups)]
        found.append((len(mine), len(other), groups, Counter((i, j) for g in groups for i in g[0] for j in g[1])))
    held = Counter(p for *_, pairs in found for p in pairs)
    highest = defaultdict(int)
    for (i, _), n in held.items():
        highest[i] = max(highest[i], n)
    rows = []
    for n_a, n_b, groups, pairs in found:
        told = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        rows.append((n_a, n_b, len(groups), sum(pairs.values()), sum(n for p, n in pairs.items() if held[p] == highest[p[0]]),
                     sum(n * held[p] for p, n in pairs.items()), hashlib.sha256(told.encode()).hexdigest() if told else ""))
    return rows


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["the", "and", "Wort", "über", "ñandú", "été", "x1", "2024", "...", "\n", " ", "  ", "\t", "-", "'s", "日本", "Ω", "🙂", "foo_bar", "http://a.b/c?d=e", "ZZZ", "▁" * (seed % 2)]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_same_as_plain_loops(spark):
    texts = [None, *ODD, *random_texts(120, 0), *random_texts(20, 1), "the and the", "the and the"]
    rows = [(k if k != 5 else None, t, k, "z", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, block string, pair int").repartition(3)
    got = ta.align_tokenizers(df, A, B, PATTERN, block_bytes=2000)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = sorted(((r[0], *p) for r, p in zip(rows, plain(texts))), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(w[1] == 0 for w in want) == sum(not t or "▁" in t for t in texts)


def test_empty_table(spark):
    assert ta.align_tokenizers(spark.createDataFrame([], "doc_id long, text string"), A, B, PATTERN).collect() == []
    assert [tuple(r)[1:] for r in ta.align_tokenizers(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B, PATTERN).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_pieces_encoded_alone_are_the_whole_text(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()] + random_texts(300, 2)
    a, b = ta.vocabularies(A, B, PATTERN)
    for at in range(0, len(texts), 50):
        part = texts[at:at + 50]
        (ids_a, n_a, _), (ids_b, n_b, _) = ta.encode_texts(part, a), ta.encode_texts(part, b)
        want = whole(part)
        assert [i for mine, _ in want for i, _ in mine] == ids_a.tolist() and [i for _, other in want for i, _ in other] == ids_b.tolist()


@pytest.mark.parametrize("step", [1, 2, 7, 64])
def test_merge_path_pieces(step):
    rng = np.random.default_rng(step)
    for _ in range(200):
        a, b = (np.unique(rng.integers(1, 60, rng.integers(0, 40))) for _ in range(2))
        in_a, in_b = ta.merge_path(a, b, step) if len(a) and len(b) else (np.zeros(1, int), np.zeros(1, int))
        if len(a) and len(b):
            merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
            for d, i, j in zip(range(0, len(merged), step), in_a, in_b):
                assert (i, j) == (sum(k == 0 for _, k in merged[:d]), sum(k == 1 for _, k in merged[:d]))
            assert (in_a[-1], in_b[-1]) == (len(a), len(b))
        cut_a, cut_b = ta.cut_groups(a, b, step)
        both = sorted(set(a.tolist()) & set(b.tolist()))
        assert [(0, 0), *((int((a <= x).sum()), int((b <= x).sum())) for x in both)] == list(zip(cut_a.tolist(), cut_b.tolist()))


def test_small_pieces_and_wide_groups(monkeypatch):
    a, b = ta.vocabularies(A, B, PATTERN)
    texts = [*random_texts(20, 3), "語" * 400, "ab" * 900, *ODD]
    want = ta.align(texts, a, b, keep_groups=True)
    monkeypatch.setattr(ta, "WIDE", 3)
    monkeypatch.setattr(ta, "LINKS", 50)
    got = ta.align(texts, a, b, step=5, keep_groups=True)
    assert got.groups == want.groups
    for f in ("owner", "pair", "times", "n_groups"):
        assert np.array_equal(getattr(got, f), getattr(want, f))
