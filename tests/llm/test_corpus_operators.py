"""Operators over whole tables: near-duplicates, decontamination, rollups, chat formatting, archives, pipeline."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.check_oracles import compare, duck
from tests.llm import brute
from threadlens.llm import chat, decontaminate, near_dedup, queries, token_counts, warc

SF = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 5, "c") for i, t in rows], "doc_id long, text string, lang string, n_shingles int, component string")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    ok, detail, _ = compare(spark, duck(SF), name, SF)
    assert ok, detail


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES} and "pipeline" in entry.queries()


def variants(rng, words, n):
    """Texts with a few words of a base text replaced."""
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for g in range(6):
        texts += variants(rng, [f"w{g}x{k}" for k in range(rng.choice([12, 60, 150]))], 12)
    shared = [f"common{k}" for k in range(60)]
    texts += [" ".join(shared + [f"own{k}y{j}" for j in range(rng.randint(3, 25))]) for k in range(60)]
    texts += [None, "", " \n", "two words", "TWO words", "two  words", "one two three four", "W0X1 " * 9, "w0x1 " * 30, "long " * 20_000]
    rows = dict(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs(spark, rows.items())).collect()}
    assert got == brute.near_components(rows)


def test_bands_follow_from_the_threshold():
    assert near_dedup.banding(85) == (44, 9)
    for percent in (50, 70, 80, 85, 90, 99):
        bands, width = near_dedup.banding(percent)
        assert (1 - (percent / 100) ** width) ** bands <= 1e-5 and bands * width <= 400


def test_pipeline_joins_pairs_from_080(spark):
    """A whole fixture, and a few hundred pairs planted between 0.80 and 0.85, by brute force."""
    rng = random.Random(12)
    rows = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    middle = 0
    for k in range(300):
        base = [f"p{k}w{j}" for j in range(rng.randint(55, 90))]
        tail = rng.randint(4, 10)
        for n, text in enumerate((base, base[:-tail] + [f"q{k}w{j}" for j in range(tail)])):
            rows[1_000_000 + 2 * k + n] = " ".join(text)
        a, b = (brute.shingle_set(rows[1_000_000 + 2 * k + n]) for n in (0, 1))
        middle += 0.80 <= len(a & b) / len(a | b) < 0.85
    assert middle > 50
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs(spark, rows.items()), SF).collect()}
    assert kept == {i for i, (_, root) in brute.near_components(rows, percent=80).items() if i == root}


def test_near_duplicates_small_cells(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)  # many cells per bucket
    rng = random.Random(5)
    rows = dict(enumerate(variants(rng, [f"w{k}" for k in range(45)], 40)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs(spark, rows.items())).collect()}
    assert got == brute.near_components(rows)


def test_near_duplicates_repeated_and_empty(spark):
    same = near_dedup.near_duplicates(docs(spark, [(3, "a b c"), (3, "a b c"), (1, "A b  c"), (None, "a b c")])).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in same) == [("1", 1), ("3", 1), ("3", 1), ("None", 1)]
    assert near_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_star_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 200), (200, 300), (5, 5), (41, 42)]
    got = {r.id: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 200: 100, 300: 100, 41: 41, 42: 41}


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 12))] for _ in "ab")
        assert decontaminate.common_length(a, b) == brute.common_length(a, b)


def test_randomised_svd_finds_the_space(spark):
    rng = np.random.default_rng(0)
    dense = rng.normal(size=(30, 4)) @ rng.normal(size=(4, 50))
    rows = spark.createDataFrame([(list(range(50)), r.tolist()) for r in dense], "terms array<int>, weights array<double>").repartition(3)
    v = decontaminate.randomised_svd(rows, 50, 30, rank=6)
    assert v.shape[1] == 4 and np.allclose(dense @ v @ v.T, dense, atol=1e-6)


def item(rng, n):
    return [f"t{rng.randrange(4000)}" if rng.random() < 0.6 else rng.choice(["the", "of", "and", "in"]) for _ in range(n)]


def test_decontamination_finds_planted_and_paraphrased(spark):
    rng = random.Random(8)
    items = {k: item(rng, rng.choice([16, 30, 59, 130])) for k in range(25)}
    rows, want = [], set()
    for d in range(120):
        w = [f"n{rng.randrange(5000)}" if rng.random() < 0.6 else rng.choice(["the", "of", "and", "in"]) for _ in range(rng.randint(30, 300))]
        if d % 3 == 0:
            k = rng.randrange(25)
            planted = list(items[k])
            if d % 2:  # a paraphrase: every tenth word differs
                planted[4::10] = ["changed"] * len(planted[4::10])
            at = rng.randrange(len(w))
            w[at:at] = planted
            want.add((d, k))
        rows.append((d, " ".join(w).upper() if d % 4 == 0 else " ".join(w)))
    rows += [(900, None), (901, ""), (902, "the of and in " * 5000)]
    bench = spark.createDataFrame([(k, " ".join(w), 1) for k, w in items.items()] + [(98, None, 1), (99, "...", 1), (None, "the of", 1)], "item_id long, text string, doc_id int")
    for block, blocks in ((512, 8), (8, 3)):  # one latent space, and several in several rounds
        found = decontaminate.find_contamination(docs(spark, rows), bench, block_passages=block, round_blocks=blocks)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    assert decontaminate.find_contamination(docs(spark, []), bench).count() == 0
    assert decontaminate.find_contamination(docs(spark, rows), bench.where("item_id < 0")).count() == 0


def test_decontamination_of_a_common_passage(spark):
    """A short item in a third of all documents is found in each of them."""
    rng = random.Random(21)
    bench = {k: [f"i{k}w{j}" for j in range(15)] for k in range(12)}
    rows, want = [], set()
    for d in range(900):
        w = [f"n{rng.randrange(9000)}" for _ in range(rng.randint(30, 200))]
        if d % 3 == 0:
            at = rng.randrange(len(w))
            w[at:at] = bench[4]
            want.add((d, 4))
        rows.append((d, " ".join(w)))
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in bench.items()], "item_id long, text string")
    found = decontaminate.find_contamination(docs(spark, rows), table)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_decontamination_finds_quotes_at_every_offset(spark):
    rng = random.Random(22)
    whole = [f"t{rng.randrange(4000)}" if rng.random() < 0.6 else rng.choice(["the", "of", "and", "in"]) for _ in range(190)]
    rows = []
    for size in (50, 64, 73, 80):
        for at in range(0, len(whole) - size + 1):
            around = [[f"n{rng.randrange(5000)}" for _ in range(25)] for _ in "ab"]
            rows.append((1000 * size + at, " ".join(around[0] + whole[at:at + size] + around[1])))
    rows += [(k, " ".join(f"n{rng.randrange(5000)}" for _ in range(80)) + " " + " ".join(whole[at:at + 25])) for k, at in enumerate((0, 40, 77, 120))]
    table = spark.createDataFrame([(1, " ".join(whole)), (2, "other words than these of any text here")], "item_id long, text string")
    found = decontaminate.find_contamination(docs(spark, rows), table).collect()
    assert {r.doc_id for r in found} == {i for i, _ in rows if i >= 1000} and {r.item_id for r in found} == {1}


def test_decontamination_of_a_very_long_item_and_of_repeated_items(spark):
    """300,000 distinct words in one item, and one short text under many ids, some of them repeated."""
    whole = [f"v{k}" for k in range(300_000)]
    short = [f"s{k}" for k in range(20)]
    bench = [(1, " ".join(whole))] + [(100 + k % 40, " ".join(short)) for k in range(60)]
    quotes = {10: whole[150_000:150_080], 11: whole[-60:], 12: whole[7:90], 13: short, 14: [f"n{k}" for k in range(90)]}
    rows = [(d, " ".join(["before"] * 30 + w + ["after"] * 30)) for d, w in quotes.items()] + [(13, " ".join(short)), (None, " ".join(short))]
    table = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.find_contamination(docs(spark, rows), table, round_blocks=16).collect()
    pairs = sorted(((r.doc_id, r.item_id) for r in found), key=repr)
    assert pairs == sorted([(d, 1) for d in (10, 11, 12)] + [(d, 100 + k) for d in (13, None) for k in range(40)], key=repr)


def test_words_cut_fast_are_those_of_the_expression():
    rng = random.Random(12)
    parts = ["Ab", "é", "ß", "_", "-", "'", "9", "²", "½", "日本", "İ", "\xa0", "…", "“", " ", "\n", "\x1c", "ﬁ", "\u0301", "🙂", "\x7f", "٣"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert [w.decode() for w in decontaminate.coded_words(text)] == decontaminate.words_of(text)


def test_running_sums():
    table = np.random.default_rng(1).integers(-9, 9, size=(50, 7)).astype(np.float32)
    for n in (0, 1, 31, 32, 33, 200):
        rows = np.random.default_rng(n).integers(0, 50, size=n)
        want = np.concatenate([np.zeros((1, 7)), np.cumsum(table[rows], axis=0)])
        assert np.array_equal(decontaminate.running_sums(table, rows)[:n + 1], want)


def test_decontamination_answer_check(spark):
    base = [f"q{k}" for k in range(40)]
    bench = spark.createDataFrame([(1, " ".join(base), "q5 q6 q7")], "item_id long, text string, answer string")
    partly = [w if k % 3 else f"z{k}" for k, w in enumerate(base)]
    with_answer = [w if k in (5, 6, 7) or k % 3 else f"z{k}" for k, w in enumerate(base)]
    filler = [(10 + k, " ".join(f"f{k}x{j}" for j in range(40))) for k in range(100)]
    rows = docs(spark, [(1, " ".join(partly)), (2, " ".join(with_answer)), (3, " ".join(base[:12])), *filler])
    found = decontaminate.find_contamination(rows, bench, answer_col="answer").collect()
    assert [(r.doc_id, r.answer_found) for r in found] == [(2, True)]


def test_rollup_is_additive_and_idempotent(spark, tmp_path):
    rollup = token_counts.Rollup(spark, str(tmp_path / "r"))
    rows = spark.createDataFrame([(1, "a", "en", 5), (2, "a", "en", 7), (3, None, None, None), (4, "b", "de", 2), (4, "b", "de", 2)],
                                 "doc_id long, source string, lang string, n long")
    assert rollup.totals().count() == 0
    assert rollup.apply("one", token_counts.signed(rows, 1, "n", "v1"))
    assert not rollup.apply("one", token_counts.signed(rows, 1, "n", "v1"))
    second = rows.where("doc_id = 2")
    rollup.apply("revise", token_counts.signed(second, -1, "n", "v1").unionByName(token_counts.signed(second.withColumn("n", F.lit(9)), 1, "n", "v2")))
    rollup.apply("delete", token_counts.signed(rows.where("doc_id = 4"), -1, "n", "v1"))
    rollup.apply("nothing", token_counts.signed(rows.limit(0), 1, "n", "v1"))
    # an attempt that died before its commit
    spark.createDataFrame([("a", "en", "v1", 100, 100, "lost", "x")], token_counts.DELTA).write.mode("append").parquet(rollup.deltas)
    want = {("a", "en", "v1", 1, 5), ("a", "en", "v2", 1, 9), (None, None, "v1", 1, 0)}
    assert {tuple(r) for r in rollup.totals().select(*token_counts.KEYS, "n_docs", "n_tokens").collect()} == want
    small = rollup.compact(str(tmp_path / "s"))
    assert {tuple(r) for r in small.totals().select(*token_counts.KEYS, "n_docs", "n_tokens").collect()} == want
    assert not small.apply("delete", token_counts.signed(rows, -1, "n", "v1"))


def test_rollup_compacted_again_and_again(spark, tmp_path):
    rollup, want = token_counts.Rollup(spark, str(tmp_path / "r0")), {}
    for k in range(4):
        rows = spark.createDataFrame([(i, f"s{i % 2}", "en", i + k) for i in range(5)], "doc_id long, source string, lang string, n long")
        assert rollup.apply(f"load-{k}", token_counts.signed(rows, 1, "n", "v"))
        for i in range(5):
            docs, tokens = want.get(f"s{i % 2}", (0, 0))
            want[f"s{i % 2}"] = docs + 1, tokens + i + k
        rollup = rollup.compact(str(tmp_path / f"r{k + 1}"))
        for old in range(k + 1):  # replays after a compaction are skipped
            assert not rollup.apply(f"load-{old}", token_counts.signed(rows, 1, "n", "v"))
        assert {r.source: (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == want
    with pytest.raises(ValueError):
        rollup.apply("compacted-x", token_counts.signed(rows, 1, "n", "v"))


def test_counts_of_odd_texts_and_clashing_columns(spark, tmp_path):
    """Null, empty and very long texts, repeated rows, and columns named like those of the deltas."""
    import tiktoken
    from threadlens.llm.bpe import read_ranks
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    texts = [None, "", "two words", "two words", "long text " * 100_000, "é" * 50_000]
    rows = spark.createDataFrame([(k, "s", None, t, 7, 8, "b", "a") for k, t in enumerate(texts)],
                                 "doc_id long, source string, lang string, text string, n_docs long, n_tokens long, batch_id string, attempt string")
    counted = rows.withColumn("n", token_counts.count_tokens(F.col("text"), path, public_tokenizers.PATTERN))
    want = [len(own.encode_ordinary(t)) if t else 0 for t in texts]
    assert [r.n for r in counted.orderBy("doc_id").collect()] == want
    rollup = token_counts.Rollup(spark, str(tmp_path / "r"))
    rollup.apply("x", token_counts.signed(counted, 1, "n", "v"))
    assert [tuple(r) for r in rollup.totals().select("source", "lang", "n_docs", "n_tokens").collect()] == [("s", None, 6, sum(want))]


def test_rollup_query_equals_recount(spark):
    import zlib
    models = {p: token_counts.counter(public_tokenizers.path(p), public_tokenizers.PATTERN) for p in (queries.BYTE_ONE, queries.BYTE_MULTI)}
    want: dict = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        if zlib.crc32(str(r.doc_id)[::-1].encode()) % 10 == 0:
            continue
        p = queries.BYTE_MULTI if zlib.crc32(str(r.doc_id).encode()) % 3 == 0 else queries.BYTE_ONE
        n, tokens = want.get((r.source, r.lang, p), (0, 0))
        want[(r.source, r.lang, p)] = (n + 1, tokens + len(models[p].encode_ordinary(r.text or "")))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in queries.op3_token_counts(spark, SF).collect()}
    assert got == want


def test_chat_round_trip(spark):
    rng = random.Random(6)
    parts = ["\\", "<|", "<|end|>", "|>", "\n", " ", "é😀", "ab", "<", "### Assistant: ", "</turn>"]
    talks = {c: [(rng.choice(["user", "assistant", "system<|"]), "".join(rng.choices(parts, k=rng.randint(0, 8)))) for _ in range(rng.randint(1, 6))] for c in range(60)}
    rows = [(c, n, role, text, 0) for c, turns in talks.items() for n, (role, text) in enumerate(turns)]
    rows += [(70, 0, None, None, 0), (71, 1, "assistant", "b", 0), (71, 1, "assistant", "a", 0), (71, 1, "assistant", "a", 0), (71, None, "user", "x" * 50_000, 0), (None, 0, "assistant", "y", 0)]
    rng.shuffle(rows)
    talks |= {70: [("", "")], 71: [("user", "x" * 50_000), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")], None: [("assistant", "y")]}
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    done = chat.format_conversations(table, public_tokenizers.path("byte_bpe_50k.json"))
    for r in done.withColumn("r", chat.read_back("formatted", "starts", "ends", "loss")).collect():
        turns = talks[r.conv_id]
        said = "".join(t for role, t in turns if role == "assistant")
        assert chat.parse(r.formatted) == turns and r.r.n_turns == len(turns)
        assert r.r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.r.loss_chars, r.r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert done.count() == len(talks)
    assert chat.format_conversations(table.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_salvage_recovers_later_records():
    for gzip in (True, False):
        plain = [warc.record(str(k), f"http://x/{k}", f"<p>page {k}</p>".encode() * 20) for k in range(6)]
        members = [warc.compress(p) if gzip else p for p in plain]
        ends = np.cumsum([0, *map(len, members)])
        whole = b"".join(members)
        assert [r["record_id"] for r in warc.salvage(whole)] == list("012345")
        for at in (ends[2] + 3, ends[2] + len(members[2]) // 2, ends[3] - 6):
            damaged = bytearray(whole)
            damaged[at] ^= 0x5A
            rows = list(warc.salvage(bytes(damaged)))
            checksum_only = gzip and at == ends[3] - 6  # the record itself unpacks and proves its digest
            assert [r["record_id"] for r in rows if r["kind"] == "record"] == ["0", "1", *(["2"] if checksum_only else []), "3", "4", "5"]
            gap, = [r for r in rows if r["kind"] == "gap"]
            assert (gap["offset"], gap["length"]) == (ends[2], len(members[2])) and gap["reason"]
        cut = list(warc.salvage(whole[:ends[5] + 30]))
        assert cut[-1]["kind"] == "gap" and cut[-1]["offset"] == ends[5] and cut[-1]["length"] == 30
        noise = list(warc.salvage(b"noise\n" + whole))
        assert noise[0]["kind"] == "gap" and noise[0]["length"] == 6 and len(noise) == 7
    assert list(warc.salvage(b"")) == []


def test_salvage_inside_a_member():
    """An archive packed as one member loses only the record that is damaged, or cut off."""
    plain = [warc.record(str(k), "u", random.Random(k).randbytes(3000)) for k in range(8)]
    broken = bytearray(b"".join(plain))
    place = sum(map(len, plain[:3]))
    broken[place + 1000] ^= 1
    rows = list(warc.salvage(warc.compress(bytes(broken))))
    assert [r["record_id"] for r in rows if r["kind"] == "record"] == list("0124567")
    assert [(r["inner_offset"], r["length"], r["reason"]) for r in rows if r["kind"] == "gap"] == [(place, len(plain[3]), "block digest differs")]
    packed = warc.compress(b"".join(plain))
    for keep in (len(packed) - 4, len(packed) // 2):
        rows = list(warc.salvage(packed[:keep] + warc.compress(plain[0])))
        found = [r["record_id"] for r in rows if r["kind"] == "record"]
        assert found[-1] == "0" and found[:-1] == list("01234567")[:len(found) - 1] and len(found) >= 4
        gap, = [r for r in rows if r["kind"] == "gap"]
        assert (gap["offset"], gap["length"], gap["reason"]) == (0, keep, gap["reason"])
    assert [r["kind"] for r in warc.salvage(warc.compress(b"no record at all"))] == ["gap"]
    assert [r["kind"] for r in warc.salvage(warc.VERSION + b"\r\nContent-Length: " + b"9" * 5000 + b"\r\n\r\n")] == ["gap"]


def test_salvage_takes_linear_time():
    rng = random.Random(1)
    units = {"members": warc.compress(warc.record("1", "u", rng.randbytes(2000))), "plain": warc.record("1", "u", rng.randbytes(2000)),
             "version lines": b"WARC/1.1\r\nbroken\r\n\r\n", "member heads": warc.MEMBER + b"xxxxxxx"}
    for name, unit in units.items():
        times = []
        for size in (1 << 20, 1 << 22):
            data = unit * (size // len(unit))
            start = time.perf_counter()
            sum(1 for _ in warc.salvage(data))
            times.append(time.perf_counter() - start)
        assert times[1] < 10 * times[0] + 0.5, (name, times)


def test_torn_records_are_salvaged(spark):
    pages = [(k, f"http://x/{k}", random.Random(k % 30).randbytes(400).hex()) for k in range(200)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    for gzip in (True, False):
        rows = warc.read_archives(warc.write_archives(table, archive_bytes=20_000, gzip=gzip, torn_every=3)).collect()
        assert sorted(int(r.record_id) for r in rows if r.kind == "record" and r.length) == list(range(200))
        assert sum(r.kind == "gap" for r in rows) >= 200 // 3


def test_words_of_regular_build_differ():
    """Complementary Thue-Morse words have equal polynomial hashes modulo 2**64, for every odd base."""
    shingler = near_dedup.Shingler()
    for size in (1024, 2048, 4096):
        word = "".join("ab"[k.bit_count() % 2] for k in range(size))
        other = word.translate(str.maketrans("ab", "ba"))
        a, b = shingler.sets([f"one two {word} three four", f"one two {other} three four"])
        assert a.tolist() != b.tolist()
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(20_000)}
    hashes, _ = shingler.words([" ".join(words)])
    assert len(set(hashes.tolist())) == len(words)


def test_archives_round_trip(spark, tmp_path):
    pages = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (5, "u", "same"), (5, "u", "same"), (3, "u", None), (4, "u", ""), (6, "u", "é" * 100_000), (None, "u", "same")]
    table = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, key int")
    archives = warc.write_archives(table, archive_bytes=400)
    rows = warc.read_archives(archives).where("kind = 'record'").collect()
    got = sorted((str(r.record_id), r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    assert got == sorted([("1", "revisit", "5", 4), ("2", "revisit", "5", 4), ("5", "response", None, 4), ("5", "response", None, 4), ("3", "revisit", "4", 0),
                          ("4", "response", None, 0), ("6", "response", None, 200_000), ("None", "response", None, 4)])
    assert warc.read_archives(warc.write_archives(table.limit(0))).count() == 0
    (tmp_path / "a.warc").write_bytes(warc.record("9", "u", b"x") + b"junk")
    kinds = warc.read_archives(warc.read_files(spark, str(tmp_path))).orderBy("offset").select("kind", "record_id").collect()
    assert [tuple(k) for k in kinds] == [("record", "9"), ("gap", None)]


def test_pipeline_stages(spark):
    """Every stage keeps clean documents and takes out what it is for."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    sf, kept = "/root/testdata/sf0.01", table
    odd = spark.createDataFrame([(90_001, None), (90_002, ""), (90_003, "12 34")], "doc_id long, text string")
    kept = kept.unionByName(odd, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = spark.createDataFrame(stage(spark, kept, sf).collect(), kept.schema)
        gone = before - {r.doc_id for r in kept.select("doc_id").collect()}
        assert kept.columns == table.columns
        if name == "language ID":
            assert gone == {90_001, 90_002, 90_003}
        if name == "quality classifier":
            assert sum(labels.get(g) == 1 for g in gone) <= 1 and sum(labels.get(g) == 0 for g in gone) >= 50
        if name == "near-duplicates":
            rest = {r.doc_id: r.text for r in kept.collect()}
            assert all(i == root for i, (_, root) in brute.near_components({i: rest[i] for i in sorted(rest)[:150]}).items())
    final = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert final.count() == kept.count()


def test_pipeline_on_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
