"""Registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import bpe, chat, decontaminate, fertility, language_id, licenses, near_dedup, pca_clusters, personal_data, quality, token_alignment, warc
from threadlens.llm import token_counts as counts
from threadlens.llm.common import fold, table
from threadlens.sources.scratch import materialize, shared_folder

BYTE_MULTI, BYTE_ONE, PIECES = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
BYTE_JSON = "byte_bpe_50k.json"


def op1_tokenizer_fertility(spark: SparkSession, sf: str) -> DataFrame:
    paths = {"piece": public_tokenizers.path(PIECES), "byte": public_tokenizers.path(BYTE_MULTI)}
    measures = materialize(fertility.measure_documents(table(spark, sf, "documents"), paths, public_tokenizers.PATTERN), "measures")
    learned = fertility.fit_bands(measures, table(spark, sf, "labels").where(fold() != 1), paths)
    return fertility.judge_documents(measures, paths, learned)


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Contaminated (document, benchmark item) pairs with their proof."""
    return decontaminate.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Totals after loading all documents in three batches, one of them replayed, re-counting a third of them with a
    second vocabulary and deleting the documents of another rule; all through signed deltas."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    day = fold("doc_id")
    # a null instead of a text that needs no second count: Spark runs Python functions on every row, whatever the condition around them
    first, second = (counts.count_tokens(text, public_tokenizers.path(p), public_tokenizers.PATTERN)
                     for p, text in ((BYTE_ONE, F.col("text")), (BYTE_MULTI, F.when(day == 0, F.col("text")))))
    counted = materialize(docs.select("doc_id", "source", "lang", day.alias("day"), (F.crc32(F.reverse(F.col("doc_id").cast("string")).cast("binary")) % 10).alias("leaves"),
                                      first.alias("one"), second.alias("multi")), "token-counts")
    rollup = counts.Rollup(spark, shared_folder(spark, "token-rollup"))
    for k in (0, 1, 2, 1):  # the second load comes twice
        rollup.apply(f"load-{k}", counts.signed(counted.where(F.col("day") == k), 1, "one", BYTE_ONE))
    revised = counted.where("day = 0")
    rollup.apply("recount-0", counts.signed(revised, -1, "one", BYTE_ONE).unionByName(counts.signed(revised, 1, "multi", BYTE_MULTI)))
    gone = counted.where("leaves = 0")
    rollup.apply("delete", counts.signed(gone.where("day = 0"), -1, "multi", BYTE_MULTI).unionByName(counts.signed(gone.where("day <> 0"), -1, "one", BYTE_ONE)))
    return rollup.totals()


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
    done = chat.format_conversations(rows, public_tokenizers.path("byte_bpe_50k.json"))
    return done.withColumn("r", chat.read_back("formatted", "starts", "ends", "loss")).select(
        "conv_id", "r.n_turns", "r.turns_sha256", "r.loss_chars", "r.loss_sha256", F.length("formatted").cast("long").alias("formatted_chars"))


def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    network = language_id.fit(docs.where(fold() != 1))
    return language_id.identify(docs.select("doc_id", "text"), network).select("doc_id", (fold() == 1).alias("held_out"), "language.lang_pred", "language.score")


def op7_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents"), percent=85)


def op8_warc_salvage(spark: SparkSession, sf: str) -> DataFrame:
    """Every 20th record was torn and written again, so the archives are read by salvage; gaps and what was left of torn
    members (length 0) are dropped here."""
    archives = materialize(warc.write_archives(table(spark, sf, "pages"), torn_every=20), "archives")
    records = warc.read_archives(archives, payloads=False).where("kind = 'record' and length > 0")
    return records.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast("long").alias("refers_to"))


def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf, "documents"), public_tokenizers.path(BYTE_MULTI), public_tokenizers.PATTERN)


def op10_pairwise_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ranker = quality.fit(docs.where(fold() != 1), table(spark, sf, "labels").where(fold() != 1))
    return docs.select("doc_id", (fold() == 1).alias("held_out"), quality.score_column(F.col("text"), ranker).alias("score")) \
        .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op11_pca_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return pca_clusters.cluster_vectors(table(spark, sf, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.align_tokenizers(table(spark, sf, "documents"), public_tokenizers.path(BYTE_JSON), public_tokenizers.path(PIECES), public_tokenizers.PATTERN)


def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, personal_data.KINDS), F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


QUERIES = {f.__name__: f for f in (op1_tokenizer_fertility, op2_decontaminate, op3_token_counts, op4_license_scan, op5_chat_format,
                                   op6_language_id, op7_minhash_dedup, op8_warc_salvage, op9_byte_bpe, op10_pairwise_quality, op11_pca_clusters,
                                   op12_token_alignment, op13_personal_data)}


def cluster_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Rounds of exact assignment and exact floor means, one pair of subqueries a round."""
    parts = [f"""
        kept as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
          where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x::double))) = 64),
        c0 as (select (row_number() over (order by h, v) - 1)::int as c, v from (select sha256('2:' || vec_id::varchar) as h, v from kept) order by h, v limit {clusters})"""]
    for r in range(rounds + 1):
        parts.append(f"""
        a{r} as (select vec_id, any_value(k.v) as v, arg_min(c, (d, c)) as c, min(d) as d from (
          select k.vec_id, k.v, m.c, list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
          from kept k, c{r} m) k group by vec_id)""")
        if r < rounds:
            parts.append(f"""
        s{r} as (select c, place, sum(x)::bigint as s, count(*) as n from (select c, unnest(v) as x, unnest(range(64)) as place from a{r}) group by c, place),
        c{r + 1} as (select m.c, coalesce(f.v, m.v) as v from c{r} m left join (
          select c, list((s - ((s % n) + n) % n) // n order by place) as v from s{r} group by c) f on f.c = m.c)""")
    return "with" + ",".join(parts) + f"""
        select vec_id, a.c as cluster, d as distance, (sum(d) over (partition by a.c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
          sha256(array_to_string(m.v, ',')) as centroid_sha256 from a{rounds} a join c{rounds} m on m.c = a.c"""


# SQL can state these four; the others need a vocabulary, a fitted model or an automaton and are tested by brute force.
ORACLES = {
    "op5_chat_format": r"""
        with said as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        turns as (
          select *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 8 + 8 + 7 as chars from said),
        whole as (
          select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as told,
                 coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '') as learned, sum(chars)::bigint as formatted_chars
          from turns group by conv_id)
        select conv_id, n_turns, sha256(told) as turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256, formatted_chars from whole""",
    "op7_minhash_dedup": r"""
        with recursive words as (
          select doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D]', ' ', 'g'), '[^ ]+') as w from documents),
        shingles as (
          select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        pairs as (
          select a.doc_id as a, b.doc_id as b, count(*) as both from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
        links as (
          select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * "both" >= 85 * (x.n + y.n - "both")),
        steps as (select a as u, b as v from links union all select b, a from links),
        reach(id, root) as (
          select doc_id, doc_id from documents union select u, root from reach join steps on v = id and root < u)
        select d.doc_id, coalesce(n, 0) as n_shingles, min(root) as component_id, d.doc_id = min(root) as kept
        from documents d left join sizes using (doc_id) join reach on id = d.doc_id group by d.doc_id, n""",
    "op8_warc_salvage": r"""
        with digests as (
          select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
        coded as (
          select *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
            ((('0x' || substr(h, (1 + 5 * (i // 4))::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31), 1)), '') as payload_digest,
            max(page_id) over (partition by h) as latest from digests)
        select page_id, payload_bytes, payload_digest, case when page_id < latest then 'revisit' else 'response' end as record_type,
          case when page_id < latest then latest end as refers_to from coded""",
    "op11_pca_clusters": cluster_sql(),
}
