"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.functions.judge import parse_judge_outputs
from threadlens.functions.numeric import half_even
from threadlens.functions.prompts import JUDGE_CHARS, JUDGE_DIMENSIONS, generation_prompt, judge_prompt, template_reply
from threadlens.functions.text import INTENTS, clean_text, label_intent
from threadlens.operators import annotation, brands, decision, features, golden, judging, metrics, models, profile
from threadlens.operators import retrieval, splits, threads, vector_index
from threadlens.operators.scoring import score_messages as score
from threadlens.schema import TOP_K
from threadlens.sources import annotations as annotation_source
from threadlens.sources import messages as message_source
from threadlens.sources import sinks
from threadlens.sources.scratch import materialize, shared_folder
from threadlens.streaming import score as streaming
from workload import fixtures as fx

PARENT = "in_response_to_tweet_id"
Q: dict = {}


def stamp(col: str = "created_at"):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def query(fn):
    Q[fn.__name__.rstrip("_")] = fn
    return fn


# ---------------------------------------------------------------- sources and sinks

@query
def load_messages(spark, sf):
    """Messages written as CSV files by ranges of their order, then ingested; ``place`` is the order within an author."""
    path = shared_folder(spark, "csv")
    raw = fx.tweets(spark, sf).repartitionByRange(16, "ingest_seq").sortWithinPartitions("ingest_seq").select(
        F.concat(F.col("tweet_id"), F.lit(" ")).alias("tweet_id"), "author_id", F.initcap(F.col("inbound").cast("string")).alias("inbound"),
        stamp(), "text", "response_tweet_id", F.coalesce(PARENT, F.lit("nan")).alias(PARENT))
    raw.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    loaded = message_source.load_messages(spark, path)
    order = F.row_number().over(Window.partitionBy("author_id").orderBy("ingest_seq"))
    return loaded.withColumn("place", order).select(
        "tweet_id", "author_id", "inbound", stamp(), "text", "response_tweet_id", PARENT, "place")


@query
def normalize_messages(spark, sf):
    t = fx.tweets(spark, sf)
    raw = t.withColumn("tweet_id", F.concat(F.lit(" "), "tweet_id", F.lit("\t"))) \
        .withColumn("inbound", F.when(F.col("inbound"), " TRUE ").when(F.col("tweet_id").endswith("3"), "false")) \
        .withColumn(PARENT, F.coalesce(PARENT, F.lit("nan"))) \
        .withColumn("response_tweet_id", F.coalesce("response_tweet_id", F.lit("nan ")))
    return message_source.normalize_messages(raw).select(
        "tweet_id", "author_id", "inbound", stamp(), "text", "response_tweet_id", PARENT, "ingest_seq")


@query
def read_annotations(spark, sf):
    """Annotation rows written as CSV and read back as strings."""
    path = shared_folder(spark, "annotations") + ".csv"
    cols = ["id", "tweet_id", "conversation_id", "text", "gold_intent", "should_escalate", "notes"]
    fx.annotations(spark, sf).select(*cols).write.option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return annotation_source.read_annotations(spark, path, cols).drop("row_no")


@query
def intent_dimension(spark, sf):
    schemas = fx.table(spark, sf, "documents").select(F.concat(
        F.lit('{"'), "lang", F.lit('": "language", "'), "source", F.lit('": "origin", "_n_chars": '), "n_chars",
        F.lit("}")).alias("schema_json"))
    return annotation.intent_dimension(schemas)


def root_table(spark, sf) -> DataFrame:
    unique = threads.dedup_keep_first(fx.tweets(spark, sf))
    return materialize(threads.thread_roots(unique.select("tweet_id", PARENT)), "roots")


def split_rows(spark, sf, roots: DataFrame | None = None) -> DataFrame:
    """Brand inbound messages, cleaned, labelled, keyed by thread root and split.

    Stages that feed several later ones are written tables, as in a production run.
    """
    t = fx.tweets(spark, sf)
    roots = root_table(spark, sf) if roots is None else roots
    labelled = materialize(splits.label_messages(threads.brand_inbound(t)).join(roots, "tweet_id"), "labelled")
    return materialize(splits.conversation_split(labelled).select(
        "tweet_id", "clean_text", "intent", "conversation_id", "split"), "splits")


def golden_from(rows: DataFrame) -> DataFrame:
    return materialize(golden.golden_sample(rows.where("split = 'test'")), "golden")


def message_pairs(spark, sf, roots: DataFrame) -> DataFrame:
    return materialize(threads.clean_pairs(threads.conversation_pairs(fx.tweets(spark, sf), roots=roots)), "pairs")


def evidence(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(split rows, golden rows, all pairs, pairs allowed in the store)."""
    roots = root_table(spark, sf)
    rows, pairs = split_rows(spark, sf, roots), message_pairs(spark, sf, roots)
    gold = golden_from(rows)
    return rows, gold, pairs, materialize(splits.evidence_candidates(pairs, rows, gold), "candidates")


@query
def write_splits(spark, sf):
    return sinks.write_splits(split_rows(spark, sf), shared_folder(spark, "splits"))


@query
def write_evidence_store(spark, sf):
    pairs = evidence(spark, sf)[3]
    vectors = fx.message_vectors(spark, sf).withColumnRenamed("tweet_id", "customer_tweet_id")
    store = sinks.write_evidence_store(sinks.evidence_rows(pairs, vectors), shared_folder(spark, "evidence"))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return store.select("store_id", "conversation_id", "customer_clean", "brand_text", stamp(),
                        F.size("embedding").alias("dim"), half_even(norm, 3).alias("norm"))


@query
def write_metrics(spark, sf):
    """Writes metrics, comparison and matrix files; returns the matrix read back."""
    labels = ["de", "en", "es", "fr", "other"]
    cells = metrics.confusion_cells(fx.predictions(spark, sf))
    base = shared_folder(spark, "reports")
    sinks.write_metrics(metrics.classifier_metrics(cells), f"{base}/metrics")
    sinks.write_table_csv(model_comparison(spark, sf), f"{base}/comparison")
    sinks.write_confusion_matrix(metrics.confusion_matrix(cells), labels, f"{base}/matrix")
    schema = "y_true string, " + ", ".join(f"{x} long" for x in labels)
    return spark.read.schema(schema).option("header", True).csv(f"{base}/matrix")


# ---------------------------------------------------------------- text

@query
def clean_messages(spark, sf):
    return fx.tweets(spark, sf).select("tweet_id", "ingest_seq", clean_text(F.col("text")).alias("clean_text"))


@query
def drop_empty(spark, sf):
    return splits.drop_empty(clean_messages(spark, sf), 5)


@query
def valid_reply_ids(spark, sf):
    return threads.valid_reply_ids(fx.tweets(spark, sf)).select("tweet_id", "ingest_seq", "valid_parent")


@query
def label_intents(spark, sf):
    return fx.tweets(spark, sf).select("tweet_id", "ingest_seq", label_intent(clean_text(F.col("text"))).alias("intent"))


@query
def conversation_proxy(spark, sf):
    return threads.conversation_proxy(fx.tweets(spark, sf)).select("tweet_id", "ingest_seq", "conversation_id")


@query
def length_histogram(spark, sf):
    return profile.length_histogram(fx.tweets(spark, sf))


def prompt_rows(spark, sf, shown: int | None = None) -> DataFrame:
    """Every case of the store as a message, with its top matches other than itself as evidence.

    The search reads ids and vectors only.  Cases of one vector have much the same matches, so the examples' texts travel once
    a share of such cases, and a message's text once.  ``shown`` is the number of characters of an example that a prompt shows;
    only those travel.
    """
    texts = fx.case_texts(spark, sf)
    store = materialize(fx.case_vectors(spark, sf).repartition(spark.sparkContext.defaultParallelism, "e"), "cases")  # copies side by side
    copies = materialize(fx.table(spark, sf, "embeddings").groupBy(F.col("vec_id").alias("e")).agg(F.count(F.lit(1)).alias("copies")), "copies")
    top = retrieval.topk_similar(store, store, TOP_K + 1, query_id="vec_id", store_id="vec_id").where("query_id <> store_id")
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).where(F.col("rank") <= TOP_K)
    shares = store.select(F.col("vec_id").alias("query_id"), "share").distinct()
    places = store.select(F.col("vec_id").alias("store_id"), "e").distinct().join(copies, "e").drop("e")
    top = materialize(top.join(shares, "query_id").join(places, "store_id"), "matches")
    examples = texts if shown is None else texts.withColumn("customer_text", F.substring("customer_text", 1, shown))
    found = retrieval.shared_evidence(top, examples, store_id="vec_id").withColumn("e", F.col("share.e")).join(copies, "e").drop("e")
    messages = texts.select("vec_id", F.col("customer_text").alias("message"), "conversation_id", "share").join(found, "share")
    once = retrieval.own_evidence(messages, "vec_id")
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies", "share")


@query
def generation_prompts(spark, sf):
    p = generation_prompt(F.lit("Acme"), F.col("message"), F.col("conversation_id"), F.col("evidence_score"), F.col("evidence"))
    return prompt_rows(spark, sf).select("vec_id", F.length(p).alias("n_chars"), F.md5(p).alias("prompt_md5"))


@query
def judge_prompts(spark, sf):
    p = judge_prompt(F.col("message"), F.col("evidence")[0]["brand_text"], F.col("evidence"), F.col("conversation_id"),
                     F.lit("ESCALATE"), "AppleSupport")
    return prompt_rows(spark, sf, shown=JUDGE_CHARS).select("vec_id", p.alias("prompt"))


@query
def template_replies(spark, sf):
    ev = F.when(F.col("n_evidence") > 1, F.array(F.struct(F.concat(F.lit("reply "), "event_id").alias("brand_text"))))
    intent = F.when(F.col("n_evidence") == 1, "unheard_of").otherwise(F.col("intent"))
    return fx.decisions(spark, sf).select(
        "event_id", template_reply(intent, ev).alias("reply"), (F.coalesce(F.size(ev), F.lit(0)) > 0).alias("grounded"))


@query
def parse_judge_outputs_(spark, sf):
    return parse_judge_outputs(fx.judge_raw(spark, sf).select("doc_id", "raw_output")).drop("raw_output")


@query
def evidence_from_json(spark, sf):
    e = judging.evidence_from_json(F.col("evidence"))
    return fx.judge_raw(spark, sf).select("doc_id", F.size(e).alias("n_evidence"),
                                          F.try_element_at(e, F.lit(1))["customer_text"].alias("first_case"))


@query
def canonical_escalation(spark, sf):
    return fx.annotations(spark, sf).select(
        "row_no", annotation.canonical_escalation(F.col("should_escalate")).alias("gold_escalation"))


@query
def normalize_truth_decision(spark, sf):
    return fx.decisions(spark, sf).select("event_id", decision.normalize_truth(F.col("answer")).alias("truth"))


# ---------------------------------------------------------------- joins

@query
def conversation_pairs(spark, sf):
    return threads.conversation_pairs(fx.tweets(spark, sf)).select(
        "brand", "conversation_id", "customer_tweet_id", "customer_text", "brand_tweet_id", "brand_text", stamp(), "turn")


@query
def thread_roots(spark, sf):
    return threads.thread_roots(threads.dedup_keep_first(fx.tweets(spark, sf)))


@query
def brand_inbound(spark, sf):
    return threads.brand_inbound(fx.tweets(spark, sf)).select("tweet_id", PARENT, "text", stamp())


@query
def attribute_brand(spark, sf):
    return threads.attribute_brand(fx.tweets(spark, sf)).select("tweet_id", "ingest_seq", "brand")


@query
def brand_table(spark, sf):
    return brands.brand_table(fx.tweets(spark, sf))


@query
def usable_pairs(spark, sf):
    t = fx.tweets(spark, sf)
    return brands.usable_pairs(t, brands.brand_table(t))


@query
def evidence_candidates(spark, sf):
    return evidence(spark, sf)[3].select("conversation_id", "customer_tweet_id", "brand_tweet_id", "customer_clean", "brand_clean")


@query
def golden_backfill(spark, sf):
    g = fx.annotations(spark, sf).select(
        "row_no", "tweet_id", "gold_intent", F.col("should_escalate").alias("gold_escalation_label"),
        F.lit("").alias("gold_reply_quality_label"), "notes")
    return golden.golden_backfill(g, fx.legacy(spark, sf), "row_no")


@query
def rater_join(spark, sf):
    human, judge = fx.ratings(spark, sf)
    return judging.rater_join(human, judge)


@query
def topk_similar(spark, sf):
    e = fx.table(spark, sf, "embeddings")
    return retrieval.topk_similar(e, e, query_id="vec_id", store_id="vec_id")


@query
def topk_similar_tiled(spark, sf):
    e = fx.table(spark, sf, "embeddings")
    return retrieval.topk_similar(e, e, query_id="vec_id", store_id="vec_id", plan="tiled", tile_rows=200)


@query
def ann_topk(spark, sf):
    """The embeddings against themselves by signed random projections."""
    e = fx.table(spark, sf, "embeddings")
    return vector_index.ann_topk(e, e, query_id="vec_id", store_id="vec_id")


# ---------------------------------------------------------------- aggregates

@query
def dataset_summary(spark, sf):
    out = profile.dataset_summary(fx.tweets(spark, sf))
    return out.select(*[c for c in out.columns if not c.startswith("date_")],
                      stamp("date_min"), stamp("date_max"))


def profiled_brands(spark, sf):
    return brands.brand_scores(materialize(usable_pairs(spark, sf), "brands"), min_inbound=1)


@query
def brand_scores(spark, sf):
    out = profiled_brands(spark, sf)
    return out.select(*[half_even(F.col(c), 9).alias(c) if c.endswith(("_norm", "_score")) else c for c in out.columns])


@query
def select_brand(spark, sf):
    return brands.select_brand(profiled_brands(spark, sf)).select("brand", half_even(F.col("composite_score"), 9).alias("composite_score"))


@query
def top_brands(spark, sf):
    return brands.top_brands(brands.brand_table(fx.tweets(spark, sf)))


@query
def intent_distribution(spark, sf):
    return splits.intent_distribution(splits.label_messages(fx.tweets(spark, sf), 0))


def cells(spark, sf):
    return metrics.confusion_cells(fx.predictions(spark, sf))


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(cells(spark, sf))


@query
def classification_report(spark, sf):
    return metrics.classification_report(cells(spark, sf))


@query
def classifier_metrics(spark, sf):
    return metrics.classifier_metrics(cells(spark, sf))


@query
def bootstrap_ci(spark, sf):
    return metrics.bootstrap_ci(cells(spark, sf))


@query
def escalation_metrics(spark, sf):
    return metrics.escalation_metrics(decision.escalation_gates(fx.decisions(spark, sf)))


@query
def model_comparison(spark, sf):
    p = fx.predictions(spark, sf).withColumn("model", F.lit("keyword"))
    base = models.majority_baseline(p, p, "y_true").withColumn("y_pred", F.col("prediction")) \
        .withColumn("model", F.lit("majority_baseline"))
    return metrics.model_comparison(p.select("model", "y_true", "y_pred").union(base.select("model", "y_true", "y_pred")))


def top_matches(spark, sf, queries=None):
    e = fx.table(spark, sf, "embeddings")
    return retrieval.topk_similar(e if queries is None else queries, e, query_id="vec_id", store_id="vec_id")


@query
def evidence_score(spark, sf):
    return retrieval.evidence_score(fx.table(spark, sf, "embeddings"), top_matches(spark, sf), query_id="vec_id")


@query
def similarity_distribution(spark, sf):
    sample = splits.reproducible_sample(fx.table(spark, sf, "embeddings"), 200, "vec_id")
    return retrieval.similarity_distribution(top_matches(spark, sf, sample))


@query
def auto_vs_gold(spark, sf):
    return metrics.auto_vs_gold(fx.annotations(spark, sf))


@query
def rater_agreement(spark, sf):
    human, judge = fx.ratings(spark, sf)
    return judging.rater_agreement(judging.rater_join(human, judge))


@query
def judge_summary(spark, sf):
    return judging.judge_summary(parse_judge_outputs_(spark, sf))


@query
def error_pairs(spark, sf):
    return metrics.error_pairs(cells(spark, sf))


def grid(spark, sf):
    return decision.threshold_grid(fx.decisions(spark, sf), true="true_intent", pred="intent")


@query
def threshold_grid(spark, sf):
    return grid(spark, sf).select("classifier_threshold", "retrieval_threshold", "n_auto",
                                  half_even(F.col("macro_f1"), 6).alias("macro_f1"),
                                  half_even(F.col("auto_handle_rate"), 6).alias("auto_handle_rate"))


@query
def best_thresholds(spark, sf):
    return decision.best_thresholds(grid(spark, sf))


def checked(spark, sf):
    known = spark.createDataFrame([(i,) for i in INTENTS], "intent string")
    return annotation.validate_annotations(fx.annotations(spark, sf), known)


@query
def annotation_summary(spark, sf):
    return annotation.annotation_summary(checked(spark, sf))


@query
def leakage_audit(spark, sf):
    rows, gold, pairs, indexed = evidence(spark, sf)
    return splits.leakage_audit(pairs, indexed, rows, gold)


def leaky_inputs(spark, sf):
    """(splits with some test rows planted in train, golden rows, all pairs as an unfiltered index)."""
    rows, gold, pairs, _ = evidence(spark, sf)
    planted = rows.where((F.col("split") == "test") & F.col("tweet_id").endswith("01")).withColumn("split", F.lit("train"))
    return rows.unionByName(planted), gold, pairs


@query
def leaked_conversations(spark, sf):
    """Every overlap that planted rows and an unfiltered index cause, by conversation."""
    rows, gold, pairs = leaky_inputs(spark, sf)
    return splits.leaked_conversations(pairs, rows, gold)


@query
def shared_texts(spark, sf):
    """Document texts that stand in more than one split when every document is a conversation."""
    rows = fx.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("conversation_id"), F.col("text").alias("clean_text"))
    return splits.shared_texts(splits.conversation_split(rows))


@query
def exclusion_set(spark, sf):
    rows = split_rows(spark, sf)
    return splits.exclusion_set(rows, golden_from(rows))


# ---------------------------------------------------------------- window-shaped

@query
def dedup_keep_first(spark, sf):
    return threads.dedup_keep_first(fx.tweets(spark, sf)).select("tweet_id", "author_id", "text", "ingest_seq")


@query
def first_reply(spark, sf):
    return threads.first_reply(threads.dedup_keep_first(fx.tweets(spark, sf)))


@query
def length_quartiles(spark, sf):
    rows = splits.label_messages(fx.tweets(spark, sf), 0)
    return golden.length_quartiles(rows).select("tweet_id", "ingest_seq", "intent", "text_len", "len_quartile")


@query
def golden_sample(spark, sf):
    return golden_from(split_rows(spark, sf))


@query
def golden_set(spark, sf):
    return golden.golden_set(split_rows(spark, sf).where("split = 'test'"))


@query
def double_label_subset(spark, sf):
    return golden.double_label_subset(golden_from(split_rows(spark, sf)))


@query
def calibration_template(spark, sf):
    rows = fx.annotations(spark, sf).withColumn("id", F.col("row_no")).select("id", "text", "auto_intent")
    return golden.calibration_template(rows)


@query
def error_examples(spark, sf):
    return metrics.error_examples(fx.predictions(spark, sf), "doc_id")


@query
def error_list(spark, sf):
    return metrics.error_list(fx.predictions(spark, sf), "doc_id")


@query
def conversation_split(spark, sf):
    return split_rows(spark, sf).select("tweet_id", "conversation_id", "split")


@query
def prepare_splits(spark, sf):
    """Link, sample, clean, label and split in one job."""
    inbound = materialize(threads.brand_inbound(fx.tweets(spark, sf)).join(root_table(spark, sf), "tweet_id"), "inbound")
    return splits.prepare_splits(inbound)


@query
def reproducible_sample(spark, sf):
    rows = materialize(threads.dedup_keep_first(fx.tweets(spark, sf)).select("tweet_id", "ingest_seq"), "ids")
    return splits.reproducible_sample(rows, 100, clamp=(500, 1000))


# ---------------------------------------------------------------- decisions and checks

@query
def escalation_gates(spark, sf):
    out = decision.escalation_gates(fx.decisions(spark, sf))
    return out.select("event_id", "intent", "decision", "gate_triggered", "reason", "composite_risk",
                      "classifier_confidence", F.col("evidence_rounded").alias("evidence_score"))


@query
def golden_escalation_eval(spark, sf):
    rows = fx.decisions(spark, sf).where(F.trim("answer") != "").withColumn("truth", decision.normalize_truth(F.col("answer")))
    return metrics.escalation_metrics(decision.escalation_gates(rows))


@query
def validate_annotations(spark, sf):
    return checked(spark, sf).select("row_no", "id", "tweet_id", "gold_intent", "gold_escalation", "message")


@query
def duplicate_annotations(spark, sf):
    return checked(spark, sf).where(F.col("error").startswith("duplicate")).select("row_no", "error")


@query
def batch_judge(spark, sf):
    return judging.batch_judge(fx.judge_raw(spark, sf), "doc_id")


# ---------------------------------------------------------------- features and models

def docs(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", "text", "lang")


def graded_docs(spark, sf):
    """Documents with their quality class as the label."""
    y = F.when(F.col("quality") == 1, "good").otherwise("poor").alias("intent")
    return docs(spark, sf).join(fx.table(spark, sf, "labels").select("doc_id", y), "doc_id")


DISCOVERY = features.TfidfSpec(min_df=5, max_df=0.85, max_features=5000, sublinear=False,
                               stop_words=tuple(fx.STOP_WORDS))
EXACT = 1e-13  # fits that SQL repeats stop where doubles do


@query
def majority_baseline(spark, sf):
    p = fx.predictions(spark, sf)
    out = models.majority_baseline(p, p, "y_true")
    return out.select("doc_id", "prediction", "confidence", F.map_entries("proba")[0]["value"].alias("first_proba"))


@query
def tfidf_vocabulary(spark, sf):
    v = features.tfidf_vocabulary(docs(spark, sf))
    return v.select("term", "idx", "df", "cf", half_even(F.col("idf"), 6).alias("idf"))


@query
def tfidf_features(spark, sf):
    d = docs(spark, sf)
    w = features.tfidf_weights(d, features.tfidf_vocabulary(d))
    return w.select("doc_id", "term", half_even(F.col("weight"), 6).alias("weight"))


@query
def cluster_terms(spark, sf):
    d, spec = docs(spark, sf), DISCOVERY
    w = features.tfidf_weights(d, features.tfidf_vocabulary(d, spec), spec)
    return features.cluster_terms(w, d, cluster="lang")


@query
def tfidf_lr(spark, sf):
    """Trained on the labelled documents, applied to all of them."""
    model = models.fit_tfidf_lr(graded_docs(spark, sf), key="doc_id", text="text", spec=features.CLASSIFIER, tol=EXACT)
    return model.predict(docs(spark, sf)).select("doc_id", "prediction", half_even(F.col("confidence"), 2).alias("confidence"))


def vector_rows(spark, sf):
    """Vectors with their class as label, split by vector."""
    rows = fx.table(spark, sf, "embeddings").select("vec_id", "embedding", F.concat(F.lit("class_"), "label").alias("intent"))
    return splits.conversation_split(rows, key="vec_id")


@query
def embedding_lr(spark, sf):
    """Trained on the train split, reported per split."""
    rows = vector_rows(spark, sf)
    preds = models.fit_embedding_lr(rows.where("split = 'train'"), key="vec_id").predict(rows)
    return metrics.classification_report(metrics.confusion_cells(preds, "intent", "prediction", ["split"]), ["split"])


@query
def predict_with_confidence(spark, sf):
    rows = vector_rows(spark, sf)
    preds = models.fit_embedding_lr(rows.where("split = 'train'"), key="vec_id").predict(rows)
    return preds.select("vec_id", "split", "intent", "prediction", half_even(F.col("confidence"), 3).alias("confidence"),
                        F.size("proba").alias("n_classes"))


@query
def tune_regularization(spark, sf):
    """Chosen on the validation split, scored once on the test split."""
    rows = splits.conversation_split(graded_docs(spark, sf), key="doc_id")
    table, _ = models.tune_regularization(*[rows.where(F.col("split") == s) for s in ("train", "validation")], test=rows.where("split = 'test'"),
                                          key="doc_id", text="text", spec=features.CLASSIFIER)
    return table


@query
def top_features(spark, sf):
    model = models.fit_tfidf_lr(graded_docs(spark, sf), key="doc_id", text="text", spec=features.CLASSIFIER, tol=EXACT)
    return model.top_features(10, digits=5).select("intent", "rank", "term", half_even(F.col("coefficient"), 3).alias("coefficient"))


@query
def discover_intents(spark, sf):
    clusters, _ = models.discover_intents(docs(spark, sf), spec=DISCOVERY)
    return clusters


@query
def save_model(spark, sf):
    """Both kinds written and read again; the embedding model is the one that a reader of the folder gets."""
    path = shared_folder(spark, "models")
    models.fit_tfidf_lr(graded_docs(spark, sf), key="doc_id", text="text", spec=features.CLASSIFIER, tol=EXACT).save(path)
    by_text = models.load_best_model(spark, path)
    rows = vector_rows(spark, sf)
    models.fit_embedding_lr(rows.where("split = 'train'"), key="vec_id").save(path)
    by_vector = models.load_best_model(spark, path)
    found = [m.predict(r).select(F.lit(m.kind).alias("kind"), F.col(m.key).alias("id"), "prediction", half_even(F.col("confidence"), 2).alias("confidence"))
             for m, r in ((by_text, docs(spark, sf)), (by_vector, rows))]
    return found[0].unionByName(found[1])


def scoring_inputs(spark, sf):
    """Messages with vectors, a model trained on the train split, and the evidence store."""
    vectors = materialize(fx.message_vectors(spark, sf), "vectors")
    rows, _, _, allowed = evidence(spark, sf)
    model = models.fit_tfidf_lr(rows.where("split = 'train'"), spec=features.CLASSIFIER, tol=EXACT)
    store = sinks.evidence_rows(allowed, vectors.withColumnRenamed("tweet_id", "customer_tweet_id"))
    return vectors, model, sinks.write_evidence_store(store, shared_folder(spark, "store"))


def inbox(spark, sf, vectors: DataFrame) -> DataFrame:
    return threads.dedup_keep_first(fx.tweets(spark, sf)).where("inbound").join(vectors, "tweet_id")


def scored_columns(scored: DataFrame) -> DataFrame:
    """Scores with two decimals: as far as fits of different engines agree."""
    rough = ["confidence", "composite_risk"]
    return scored.select(*[half_even(F.col(c), 2).alias(c) if c in rough else c for c in scored.columns if c not in ("intent_proba", "evidence")])


@query
def score_messages(spark, sf):
    vectors, model, store = scoring_inputs(spark, sf)
    return scored_columns(score(materialize(inbox(spark, sf, vectors), "inbox"), model, store))


@query
def score_stream(spark, sf):
    """The same scoring as a file stream in three batches, the store read by tiles."""
    vectors, model, store = scoring_inputs(spark, sf)
    index = retrieval.build_evidence_index(store, tile_rows=64)
    source, out = shared_folder(spark, "inbox"), shared_folder(spark, "scored")
    inbox(spark, sf, vectors).select("tweet_id", "text", "embedding").repartition(6).write.parquet(source)
    messages = streaming.message_stream(spark, source, "tweet_id string, text string, embedding array<float>", files_per_batch=2)
    streaming.score_stream(messages, model, index, out=out, checkpoint=shared_folder(spark, "progress")).awaitTermination()
    return scored_columns(streaming.read_scored(spark, out).drop("batch_id", "attempt"))


def judge_columns() -> list[str]:
    return [c for d in JUDGE_DIMENSIONS for c in (f"judge_{d}", f"judge_{d}_reason")]


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Brand ranking with pair and thread counts: links, joins, aggregates and scores messages."""
    t = fx.tweets(spark, sf)
    counts = threads.conversation_pairs(t).groupBy("brand").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("conversation_id").alias("threads"))
    ranked = profiled_brands(spark, sf)
    return ranked.join(counts, "brand", "left").select(
        "brand", "outbound_tweets", "inbound_msgs", "conversations", "usable_pairs", "reply_rate",
        half_even(F.col("composite_score"), 9).alias("composite_score"), F.coalesce("pairs", F.lit(0)).alias("pairs"),
        F.coalesce("threads", F.lit(0)).alias("threads"))


Q["brand_ranking"] = flagship
