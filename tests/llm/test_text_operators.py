"""Operators over single documents: fertility, licenses, language ID, BPE and quality."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm import brute
from threadlens.llm import bpe, fertility, language_id, licenses, quality
from threadlens.llm.common import values_at
from threadlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "a b c\n" * 3000), (6, "x" * 200_000), (6, "x" * 200_000), (7, "123 456"),
       (8, "naïve Ünï 漢字 😀 \\ <|end|>"), (None, "no id at all")]
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def odd(spark, rows=ODD):
    """Odd texts with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", 1, 2.0, "x") for i, t in rows], "doc_id long, text string, lang string, ids int, score double, kept string")


def by_id(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: str(r["doc_id"]))


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def reference_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_reference_library(spark, documents):
    model = reference_encoding()
    for r in QUERIES["op9_byte_bpe"](spark, SF).collect():
        text = documents[r.doc_id] or ""
        ids = model.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_bpe_offsets_and_split_characters(spark):
    coded = bpe.encode_column(odd(spark), RANKS, public_tokenizers.PATTERN)
    rows = coded.withColumn("back", bpe.decode_ids(coded["ids"], RANKS)).collect()
    texts = sorted(t or "" for _, t in ODD)
    assert sorted(bytes(r.back).decode() for r in rows) == texts
    for r in rows:
        text = bytes(r.back).decode()
        table = bpe.id_bytes(RANKS)
        for i, s, e in zip(r.ids, r.starts, r.ends):
            assert table[i] in text[s:e].encode()
    assert bpe.encode_column(odd(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_random_texts():
    random.seed(2)
    model, mine = reference_encoding(), bpe.encoder(RANKS, public_tokenizers.PATTERN)
    signs = [chr(c) for c in [*range(0x250), *range(0x900, 0x980), *range(0x4E00, 0x4E40), *range(0x1F600, 0x1F640)]]
    texts = ["".join(random.choices(random.choice([signs, "ab  \n'S", signs[:128]]), k=random.randint(1, 25))) for _ in range(2000)]
    assert [list(x[0]) for x in mine.encode(texts)] == [model.encode_ordinary(t) for t in texts]


def test_fertility_base_counts(spark, documents):
    for r in QUERIES["op1_tokenizer_fertility"](spark, SF).collect():
        want = brute.base_counts(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_fertility_measures_by_plain_loops(spark):
    """Characters per token, byte share and entropy of whole texts, word by word with the libraries themselves."""
    import sentencepiece
    import tiktoken
    paths = {"piece": public_tokenizers.path("piece_bpe_32k.model"), "byte": public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}
    pieces = sentencepiece.SentencePieceProcessor(model_file=paths["piece"])
    ranks = bpe.read_ranks(paths["byte"])
    multi = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["plain words of a text, plain words", "日本語 テキスト ₿ x", "ñandú öß\tword\nline", "a", "word " * 60]
    rows = {r.doc_id: r for r in fertility.fertility_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", F.lit("en")),
                                                           paths, public_tokenizers.PATTERN).collect()}
    for k, text in enumerate(texts):
        words = text.split()
        for name, tokens, only_byte in (("piece", [i for w in words for i in pieces.encode(w)], pieces.is_byte),
                                        ("byte", [i for w in words for i in multi.encode_ordinary(" " + w)], lambda i: not fertility.valid(multi.decode_single_token_bytes(i)))):
            n, counts = len(tokens), Counter(tokens)
            entropy = -sum(c / n * math.log2(c / n) for c in counts.values()) / math.log2(n) if n > 1 else 1.0
            want = (sum(map(len, words)) / n, sum(map(only_byte, tokens)) / n, abs(entropy))
            assert np.allclose([rows[k][f"{name}_{m}"] for m in ("chars_per_token", "byte_share", "entropy")], want, atol=1e-9), (text, name)


def test_fertility_odd_rows_and_bands(spark):
    paths = {"piece": public_tokenizers.path(fertility.PIECES), "byte": RANKS}
    rows = by_id(fertility.fertility_rules(odd(spark), paths, public_tokenizers.PATTERN))
    assert len(rows) == len(ODD) and all(r["base_failed"] for r in rows)
    assert fertility.fertility_rules(odd(spark, []), paths, public_tokenizers.PATTERN).count() == 0
    noise = " ".join("".join(random.Random(k).choices("漢字仮名交文", k=3)) for k in range(80))
    prose = " ".join(f"the word{k} and thing{k} of some" for k in range(60))
    got = {r["doc_id"]: r for r in by_id(fertility.fertility_rules(odd(spark, [(1, noise), (2, prose)]), paths, public_tokenizers.PATTERN))}
    assert "byte_fallback" in got[1]["reasons"] and not got[1]["kept"]  # ideographs under the band of English
    assert got[2]["kept"]
    assert fertility.script_of("привет мир") == "Cyrillic" and fertility.script_of("漢字") == "Han" and fertility.script_of("123") == "Latin"


def test_fertility_keeps_clean_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id")
    rows = QUERIES["op1_tokenizer_fertility"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed")
    assert rows.where("not kept").count() == 0


def test_fertility_rejects_labelled_junk(spark):
    """Past the base rule, most junk that no band has seen is rejected and no good document."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op1_tokenizer_fertility"](spark, sf).join(labels, "doc_id").where("not base_failed").select("doc_id", "quality", "kept", "reasons").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    junk = [r for r in held if r.quality == 0]
    assert len(junk) > 50 and sum(not r.kept for r in junk) > 0.6 * len(junk)
    assert all(r.kept for r in held if r.quality == 1)


def test_fertility_bands_per_vocabulary():
    values = np.array([[2.0 + 0.01 * (k % 5), 0.0, 0.7] for k in range(40)])
    learned = {"en": (fertility.learn_band(values, np.full(40, 1000)), fertility.learn_band(values + [[1.0, 0, 0]], np.full(40, 1000)))}
    assert fertility.judge("en", "", [(2.0, 0, 0.7), (3.0, 0, 0.7)], 1000, learned) == ("en", "")
    assert fertility.judge("en", "", [(2.0, 0, 0.7), (2.0, 0, 0.7)], 1000, learned) == ("en", "short_tokens")
    assert fertility.judge("en", "", [(3.0, 0, 0.7), (3.0, 0, 0.7)], 1000, learned) == ("en", "long_tokens")
    assert fertility.judge("de", "", [(3.0, 0, 0.7), (3.0, 0, 0.7)], 1000, learned) == ("de", "")


def test_license_places(spark, documents):
    for r in QUERIES["op4_license_scan"](spark, SF).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_places(documents[r.doc_id], licenses.BASE_PHRASES)
    rows = licenses.scan_licenses(odd(spark)).collect()
    assert len(rows) == len(ODD) and all(r.score == 0 and r.labels == "" for r in rows)
    assert licenses.scan_licenses(odd(spark, [])).count() == 0


def test_license_random_words():
    rng = random.Random(4)
    parts = ["mit", "license", "LICENSE", "Apache", "general", "public", "é", "İ", "MIT License", "-", "  ", "\n", ","]
    for _ in range(1500):
        text = "".join(rng.choice(parts) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 14)))
        assert licenses.scan(text)[:5] == brute.license_places(text, licenses.BASE_PHRASES)


@pytest.mark.parametrize("expression,accepted", [
    ("MIT", True), ("GPL-3.0-only", False), ("GPL-3.0-only OR MIT", True), ("GPL-3.0-only AND MIT", False),
    ("GPL-2.0 OR MIT AND Apache-2.0", True), ("(GPL-2.0 OR MIT) AND GPL-3.0", False), ("Apache-2.0 WITH LLVM-exception", True),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR BSD-3-Clause", True)])
def test_license_expressions(expression, accepted):
    assert licenses.evaluate(licenses.to_postfix(expression)) is accepted
    row = licenses.scan(f"// SPDX-License-Identifier: {expression}\nint x;")
    assert row[6] == 1.0 and row[7] == [expression] and row[9] is accepted


@pytest.mark.parametrize("bad", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT Apache-2.0", "MIT (GPL)", "()", "MIT WITH MIT WITH MIT", "(MIT OR ISC) WITH MIT", "MIT WITH (MIT)", "MIT WITH"])
def test_bad_license_expressions(bad):
    with pytest.raises(licenses.BadExpression):
        licenses.to_postfix(bad)
    assert licenses.scan(f"SPDX-License-Identifier: {bad}\n")[8] == 1


def test_random_license_expressions_never_end_the_job():
    rng = random.Random(6)
    tokens = ["MIT", "ISC", "GPL-2.0", "Apache-2.0", "LLVM-exception", "AND", "or", "WITH", "with", "(", ")", ",", "banana", "CC BY-NC 4.0", "."]
    for _ in range(20_000):
        written = " ".join(rng.choice(tokens) for _ in range(rng.randint(0, 9)))
        for notice in ("Licensed under ", "SPDX-License-Identifier: "):
            row = licenses.scan(notice + written)
            assert 0 <= row[6] <= 1 and "banana" not in row[5]
            for expression in row[7]:
                licenses.evaluate(licenses.to_postfix(expression))


def test_unknown_identifiers_are_no_labels():
    assert licenses.scan("SPDX-License-Identifier: banana")[5:7] == ("", 0.3)
    assert licenses.scan("SPDX-License-Identifier: MIT OR banana")[5:7] == ("mit", 0.7)
    assert licenses.scan("SPDX-License-Identifier: Apache-2.0 WITH banana")[5:7] == ("", 0.3)
    for text in ("licensed under MIT WITH MIT WITH MIT", "Licensed under (MIT OR ISC) WITH MIT"):
        row = licenses.scan(text)
        assert "mit" in row[5].split(",") and row[7] == []


@pytest.mark.parametrize("text,labels,expressions,acceptable", [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc,cc-by-nc-4.0", ["CC-BY-NC-4.0"], False),
    ("(Licensed under the CC-BY-4.0)", "cc-by,cc-by-4.0", ["CC-BY-4.0"], True),
    ("Text: CC BY-SA 3.0, pictures: CC BY", "cc-by,cc-by-sa", [], None),
    ("Released under CC BY-NC-ND 4.0", "cc-by-nc-nd", [], None),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa", [], None),
    ("please cc by Friday, cc by hand", "", [], None),
    ("Licensed under MIT OR (GPL-2.0-only AND ISC). See LICENSE", "gpl-2.0-only,isc,mit", ["MIT OR (GPL-2.0-only AND ISC)"], True),
    ("Licensed under GPL-2.0 WITH Classpath-exception-2.0.", "gpl-2.0 with classpath-exception-2.0", ["GPL-2.0 WITH Classpath-exception-2.0"], False),
    ("Licensed under Apache-2.0 and other terms", "apache-2.0", [], None),
    ("Licensed under MIT, GPL-3.0", "gpl-3.0,mit", [], None),
    ("Licensed under contract law. Licensed under and with (", "", [], None),
    ("x licensed under ISC; y licensed under GPL-3.0-only", "gpl-3.0-only,isc", ["ISC", "GPL-3.0-only"], False)])
def test_license_short_notices(text, labels, expressions, acceptable):
    row = licenses.scan(text)
    assert (row[5], row[7], row[8], row[9]) == (labels, expressions, 0, acceptable)
    assert row[6] == (1.0 if expressions else 0.7 if labels else 0.0)


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op6_language_id"](spark, sf).collect()
    assert len(rows) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95


def test_language_network_by_plain_loops():
    """Convolution, pooling and softmax of random weights, written out."""
    network = language_id.ByteNetwork.fresh(["aa", "bb", "cc"], seed=5)
    network.bias += np.random.default_rng(1).normal(0, 0.5, network.bias.shape).astype(np.float32)
    network.offset += np.float32([0.1, -0.2, 0.3])
    texts = ["Hello WORLD", "é" * 300, "x", "words and more words " * 60]
    got = network.texts(texts)
    for row, text in zip(got, texts):
        data, total = text.encode().lower(), np.zeros(3)
        for at in range(0, len(data), language_id.LENGTH):
            window = data[at:at + language_id.LENGTH]
            padded = window.ljust(language_id.LENGTH, b"\0")
            pooled = [max(sum(float(network.tables[k][padded[p + k]][f]) for k in range(len(network.tables)) if p + k < len(padded)) for p in range(len(padded)))
                      for f in range(len(network.bias))]
            hidden = [max(0.0, v + float(b)) for v, b in zip(pooled, network.bias)]
            z = [sum(h * float(network.weights[f][c]) for f, h in enumerate(hidden)) + float(network.offset[c]) for c in range(3)]
            e = [math.exp(v - max(z)) for v in z]
            total += np.array(e) / sum(e) * len(window)
        assert np.allclose(row, total / total.sum(), atol=1e-5)


def test_language_network_gradients_by_differences():
    """One step of learning goes down the loss that plain differences show."""
    rng = np.random.default_rng(2)
    x = rng.integers(97, 103, size=(40, 24)).astype(np.uint8)
    y = (x[:, 0] % 2).astype(np.int64)
    network = language_id.ByteNetwork.fresh(["aa", "bb"], seed=3)

    def loss():
        return -np.log(network.predict(x)[np.arange(40), y]).mean()

    before = loss()
    network.learn(x, y, epochs=30)
    assert loss() < 0.5 * before


def test_language_odd_rows(spark):
    train = spark.createDataFrame([(k, w * 30, lang) for k, (w, lang) in enumerate([("the and ", "en"), ("der und ", "de")] * 20)]
                                  + [(99, "zzz", None), (98, None, "de")], "doc_id long, text string, lang string")
    network = language_id.fit(train)
    rows = by_id(language_id.identify(odd(spark), network))
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r["language"]["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert language_id.identify(odd(spark, []), network).count() == 0
    empty = language_id.fit(train.where("doc_id < 0"))
    assert {r["language"]["lang_pred"] for r in by_id(language_id.identify(odd(spark), empty))} == {"und"}


def test_language_windows_cover_whole_texts():
    x, owner, size = language_id.windows(["a" * 1000, "", "b"], 384)
    assert x.shape == (4, 384) and owner.tolist() == [0, 0, 0, 2] and size.tolist() == [384, 384, 232, 1]
    network = language_id.ByteNetwork.fresh(["a", "b"])
    conv = network.convolve(x)
    want = sum(network.tables[k][x[0, 10 + k]] for k in range(3 + 1))
    assert np.allclose(conv[0, 10], want, atol=1e-5)


def test_fertility_bands_are_learned_from_every_good_document(spark):
    """1,300 good documents of one language and 40 of a script: medians and ends as over all of them in one array."""
    rng = random.Random(4)
    words = ["".join(rng.choices("aeioustrnéß漢", k=rng.randint(1, 9))) for _ in range(3000)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(50, 90))), "en") for k in range(1300)]
    rows += [(5000 + k, " ".join("".join(rng.choices("приветмрдом", k=5)) for _ in range(60)), None) for k in range(40)] + [(6000, "the " * 400, "en"), (6001, "### " * 20, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1) for r in rows] + [(7, 0), (None, 1)], "doc_id long, quality int")
    paths = {"piece": public_tokenizers.path(fertility.PIECES), "byte": RANKS}
    measures = fertility.measure_documents(docs, paths, public_tokenizers.PATTERN)
    got, found = fertility.fit_bands(measures, labels, paths), measures.where("not base_failed and id not in (7, 6000)").collect()
    parts = fertility.parts_of(paths)
    for name, low, high in (("en", 0, 5000), ("Cyrillic", 5000, 6000)):
        own = [r for r in found if low <= r.id < high]
        values, n_words = np.array([[r[c] for c in parts] for r in own]), np.array([r.n_words for r in own])
        assert len(own) > 20 and list(got[name]) == [fertility.learn_band(values[:, k:k + 3].copy(), n_words) for k in (0, 3)]
    assert got.keys() == {"en", "Cyrillic"} and len([r for r in found if r.id < 5000]) > 1200


def test_values_at_places_of_the_order(spark):
    rng = random.Random(5)
    groups = {"a": [rng.gauss(0, 1) for _ in range(3000)], "b": [0.0] * 500 + [1e-300, 5.0], "c": [7.0]}
    rows = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "key string, value double")
    want = {g: [0, len(v) // 2, len(v) - 1] for g, v in groups.items()}
    assert values_at(rows, want) == {(g, r): sorted(groups[g])[r] for g, some in want.items() for r in some}


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op10_pairwise_quality"](spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def described(texts):
    return quality.describe_all(texts, quality.Shingler(1))


def test_quality_features_by_plain_loops():
    rng = random.Random(9)
    texts = [None, "", " \n", "a", "abcd", "Abcd abcd!", "é\u2003ü x", "one two one\n\none two # 12 ?!", "x" * 500]
    texts += [" ".join(rng.choice(["the", "Über", "###", "12", "a|b", "lorem", "x" * 40]) + rng.choice(["", "\n", "!"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    got = described(texts)
    width = len(quality.FEATURES)
    shingler = quality.Shingler(1)
    for row, text in zip(got, texts):
        data = (text or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0D]+", data.lower())
        runs = [data.lower()[k:k + 4] for k in range(len(data) - 3)]
        for at, numbers in ((width, [int(shingler.words([w.decode()])[0][0]) for w in words]),
                            (width + quality.BUCKETS, [int.from_bytes(r, "big") * 0x9E3779B1 % 2 ** 32 >> 24 for r in runs])):
            counts = Counter(n % quality.BUCKETS for n in numbers)
            want = [(counts[b] / len(numbers)) ** 0.5 if numbers else 0.0 for b in range(quality.BUCKETS)]
            assert np.allclose(row[at:at + quality.BUCKETS], want, atol=1e-6)
        split = (text or "").split()
        if not split:
            assert row[:width].tolist() == [0.0] * (width - 1) + [1.0]
            continue
        seen = len(data) - sum(data.count(c) for c in b" \t\n\v\f\r")
        lines = [x for x in text.split("\n") if x]
        letters = sum(65 <= c < 91 or 97 <= c < 123 for c in data)
        want = {"symbols": sum(c in b"#*$%&|<>{}[]=+~^\\@_/" for c in data) / seen, "marks": sum(c in b"!?" for c in data) / seen,
                "upper": sum(65 <= c < 91 for c in data) / max(1, letters), "digits": sum(48 <= c < 58 for c in data) / seen,
                "repeated_next": sum(a == b for a, b in zip(split, split[1:])) / len(split), "distinct_share": (len(set(split)) / len(split)) ** 0.5 if len(split) >= 20 else 1.0,
                "long_words": sum(len(w) > 30 for w in split) / len(split), "short_lines": sum(len(x) < 12 for x in lines) / len(lines),
                "repeated_lines": 1 - len(set(lines)) / len(lines), "letters": (letters + sum(c >= 128 for c in data)) / seen,
                "word_length": min(1.0, seen / len(split) / 20), "is_empty": 0.0}
        assert np.allclose(row[:width], [want[f] for f in quality.FEATURES], atol=1e-6), text


def test_quality_fit_is_the_pairwise_optimum():
    """At the weights, the loss of the same pairs written as plain sums is flat, and pairs are ranked by it."""
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.3, 1, (40, 15)), rng.normal(-0.3, 1, (30, 15))
    w = quality.fit_weights(good, bad, 500, 7)
    draw = np.random.default_rng(7)
    a, b = draw.integers(0, 40, 500), draw.integers(0, 30, 500)

    def loss(w):
        ridge = sum((quality.RIDGE if k < len(quality.FEATURES) else quality.HASHED_RIDGE) * x * x / 2 for k, x in enumerate(w))
        return sum(math.log1p(math.exp(-sum(x * (p - q) for x, p, q in zip(w, good[i], bad[j])))) for i, j in zip(a.tolist(), b.tolist())) / 500 + ridge

    base = loss(w.tolist())
    for k in range(15):
        for move in (1e-2, -1e-2):
            moved = w.copy()
            moved[k] += move
            assert loss(moved.tolist()) >= base


def test_quality_is_learned_from_all_pairs_of_all_rows(spark):
    """At the weights, the loss over every pair of a good and a bad row, written out in full, is flat; no pair is drawn."""
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choices(["calm", "rain", "of", "the", "###", "!!", "X1"], weights=[9, 9, 9, 9, w, w, w], k=40)), y)
            for k in range(130) for y, w in (((1, 1) if k % 2 else (0, 5)),)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [rows[0][:2], (None, "no id")], "doc_id long, text string")
    ranker = quality.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows] + [(500, 1), (None, 0)], "doc_id long, quality int"))
    good, bad = (described([r[1] for r in rows if r[2] == y]).astype(float) for y in (1, 0))
    both = np.concatenate([good, bad])
    assert np.allclose(ranker.mean, both.mean(axis=0), atol=1e-6) and np.allclose(ranker.scale, both.std(axis=0) + 1e-2, atol=1e-5)
    good, bad = (np.clip((x - ranker.mean) / ranker.scale, -8, 8) for x in (good, bad))
    gaps = (good[:, None, :] - bad[None, :, :]).reshape(-1, good.shape[1])
    ridge = np.where(np.arange(good.shape[1]) < len(quality.FEATURES), quality.RIDGE, quality.HASHED_RIDGE)
    slope = ridge * ranker.weights - gaps.T @ quality.logistic(-(gaps @ ranker.weights)) / len(gaps)
    assert np.abs(slope).max() < 1e-4 and np.abs(ranker.weights).max() > 0.1


def test_quality_steps_hand_over_less_than_their_rows(spark, monkeypatch):
    """Few rows in many files: the matrices of a step come from one task, not from one a file."""
    add_up, written, tasks = quality.add_up, quality.feature_table, []

    def counted(rows, task, *parts):
        tasks.append(add_up(rows, lambda batches: {"tasks": np.ones(1)}, *parts)["tasks"][0])
        return add_up(rows, task, *parts)

    monkeypatch.setattr(quality, "add_up", counted)
    monkeypatch.setattr(quality, "feature_table", lambda *args, **names: written(*args, **names).repartition(40))
    rows = [(k, f"calm rain {k}" if k % 2 else f"### !! {k}", k % 2) for k in range(60)]
    quality.fit(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([r[::2] for r in rows], "doc_id long, quality int"))
    assert tasks[0] == 40 and len(tasks) > 2 and set(tasks[1:]) == {1}


def test_quality_cut_is_not_moved_by_empty_texts(spark):
    """Texts without words get 0 whatever the cut; labelled good in one half only, they must not let junk pass."""
    halves = {r.id: r.h for r in spark.range(400).select("id", F.pmod(F.xxhash64("id"), F.lit(2)).alias("h")).collect()}
    rows = [(k, f"plain words number {k} in a calm line of text", 1) for k in range(0, 200, 2)] + [(k, f"###$$$ {k} !!! *** %%%", 0) for k in range(1, 200, 2)]
    rows += [(k, "", 1) for k in range(200, 400) if halves[k] == 1][:8]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    ranker = quality.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))
    scores = ranker.score(described([r[1] for r in rows]))
    assert all((s >= 0.5) == (y == 1 and text != "") for s, (_, text, y) in zip(scores, rows))


def test_quality_pairs_and_odd_rows(spark):
    good = described([f"plain words number {k} in a calm line of text" for k in range(30)])
    bad = described([f"###$$$ {k} !!! *** %%%" for k in range(30)])
    ranker = quality.fit_pairs(good, bad)
    assert (ranker.score(good) >= 0.5).all() and (ranker.score(bad) < 0.5).all()
    table = odd(spark)
    scored = table.withColumn("s", quality.score_column(table["text"], ranker)).collect()
    assert all(r.s == 0 for r in scored if not (r.text or "").split()) and len(scored) == len(ODD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    blank = quality.fit(odd(spark), none)
    assert blank.score(good).tolist() == [0.5] * 30
    contradicting = spark.createDataFrame([(4, 0), (4, 1), (5, None), (None, 1)], "doc_id long, quality int")
    assert len(quality.training_rows(odd(spark), contradicting, id_col="doc_id", text_col="text", label_col="quality")[0]) == 0
