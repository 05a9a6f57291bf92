import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.operators import features, models, retrieval, vector_index
from threadlens.operators.scoring import score_messages
from threadlens.sources.scratch import materialize, shared_folder
from threadlens.sources.sinks import write_evidence_store
from threadlens.streaming import score as streaming


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 8))
    m[100:200] = m[5]          # a third of the store are copies of one vector
    return m


def frame(spark, m, prefix="s"):
    return spark.createDataFrame([(f"{prefix}{i:03d}", [float(x) for x in v]) for i, v in enumerate(m)], "id string, embedding array<float>")


@pytest.mark.parametrize("plan,tile", [("broadcast", 1), ("tiled", 37), ("auto", 1)])
def test_topk_matches_brute_force(spark, vectors, plan, tile):
    queries = vectors[::10]
    got = retrieval.topk_similar(frame(spark, queries, "q"), frame(spark, vectors).repartition(7), 5, query_id="id", store_id="id",
                                 plan=plan, tile_rows=tile).collect()
    f = vectors.astype(np.float32).astype(float)
    f /= np.linalg.norm(f, axis=1, keepdims=True)
    want = set()
    for i in range(len(queries)):
        sims = np.round(f @ f[i * 10], 12)
        for r, j in enumerate(sorted(range(300), key=lambda j: (-sims[j], j))[:5], 1):
            want.add((f"q{i:03d}", r, f"s{j:03d}"))
    assert {(r[0], r[1], r[2]) for r in got} == want
    assert all(-1 <= r.similarity <= 1 for r in got)


def clustered(n, clusters, dim=16, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    m = centres[rng.integers(clusters, size=n)] + rng.normal(scale=0.05, size=(n, dim))
    m[n // 2:n // 2 + n // 3] = m[0]  # a third of the store are copies of one vector
    return m


def exact(m, q, k):
    f = m / np.linalg.norm(m, axis=1, keepdims=True)
    x = q / np.linalg.norm(q, axis=1, keepdims=True)
    out = set()
    for i, row in enumerate(np.round((x @ f.T), 12)):
        out |= {(f"q{i:03d}", r, f"s{j:03d}") for r, j in enumerate(sorted(range(len(m)), key=lambda j: (-row[j], f"s{j:03d}"))[:k], 1)}
    return out


@pytest.mark.parametrize("in_place", [True, False, None])
def test_tiles_are_exact_and_few_are_visited(spark, in_place):
    m = clustered(900, 12)
    q = np.concatenate([m[::60], clustered(20, 12, seed=6)])
    index = vector_index.build_tile_index(frame(spark, m).repartition(5), shared_folder(spark, "index"), store_id="id", tile_rows=40)
    got = vector_index.search_tiles(frame(spark, q, "q"), index, 5, query_id="id", in_place=in_place)
    assert {tuple(r)[:3] for r in got.collect()} == exact(m, q, 5)
    assert index.tiles.sizes.sum() == 900 - 900 // 3  # copies and their original are one row
    visits = vector_index.count_visits(frame(spark, m[::60], "q"), index, 5)
    assert visits.agg(F.avg("tiles")).first()[0] < len(index.tiles.centres) / 3


def test_tile_parts_and_cells_of_many_queries(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "QUERY_ROWS", 7)
    m = clustered(300, 3)
    index = vector_index.build_tile_index(frame(spark, m), store_id="id", tile_rows=25, max_tiles=2, keep=6, columns=["embedding"])
    assert index.tiles.parts.max() > 1
    got = vector_index.search_tiles(frame(spark, m, "q"), index, 6, query_id="id", in_place=False, extra=["embedding"])
    assert {tuple(r)[:3] for r in got.collect()} == exact(m, m, 6)
    with pytest.raises(ValueError):
        vector_index.search_tiles(frame(spark, m, "q"), index, 7, query_id="id")


def spread(n, dim=12, seed=9):
    return np.random.default_rng(seed).normal(size=(n, dim))


def test_small_tiles_give_no_more_candidates(spark, monkeypatch):
    """Vectors without clusters visit nearly all tiles; a cell still gives k rows a query, and a query travels once a zone."""
    seen, cells = [], vector_index.cell_candidates

    def watched(visits, rows, *rest):
        found = cells(visits, rows, *rest)
        seen.append((visits.count(), rows.count(), found.count()))
        return found

    monkeypatch.setattr(vector_index, "cell_candidates", watched)
    m = spread(300)
    got = retrieval.topk_similar(frame(spark, m, "q"), frame(spark, m), 5, query_id="id", store_id="id", plan="tiled", tile_rows=4)
    assert {tuple(r)[:3] for r in got.collect()} == exact(m, m, 5)
    assert len(seen) == 2 and all(v <= 300 and r <= 300 and c <= 5 * 300 for v, r, c in seen)


def test_zones_hold_every_tile():
    limit = vector_index.ZONE_ROWS
    sizes = np.array([limit // 2, limit // 2, 1, 0, 3 * limit + 1, limit, 5])
    assert vector_index.zones_of(sizes) == [(0, 2), (2, 4), *[(4, 5)] * 4, (5, 6), (6, 7)]
    assert vector_index.zones_of(np.zeros(3, dtype=int)) == [(0, 3)]


def test_scans_in_place_trim_over_tiles(spark, monkeypatch):
    seen, scan = [], vector_index.scan_in_place
    monkeypatch.setattr(vector_index, "scan_in_place", lambda *a: (seen.append(scan(*a).count()), scan(*a))[1])
    m = spread(300)
    index = vector_index.build_tile_index(frame(spark, m), store_id="id", tile_rows=4)
    got = vector_index.search_tiles(frame(spark, m[:20], "q"), index, 5, query_id="id", in_place=True)
    assert {tuple(r)[:3] for r in got.collect()} == exact(m, m[:20], 5)
    assert sum(seen) <= 5 * 20 * 20 < 5 * 20 * len(index.tiles.centres)


def test_probes_of_one_group_travel_together(spark, monkeypatch):
    """Floats stay floats, a query travels once a table and group, and each group gives k rows a query."""
    seen, cells = [], vector_index.cell_candidates

    def watched(visits, rows, *rest):
        found = cells(visits, rows, *rest)
        seen.append((visits.count(), found.count(), visits.schema["q"].dataType.simpleString(), rows.schema["v"].dataType.simpleString()))
        return found

    monkeypatch.setattr(vector_index, "cell_candidates", watched)
    m = spread(400)
    vector_index.ann_topk(frame(spark, m[:40], "q"), frame(spark, m), 5, query_id="id", store_id="id").collect()
    visits, found, *kinds = seen[0]
    assert kinds == ["array<float>"] * 2 and visits <= 40 * 12 * 4 and found <= 5 * visits


def test_index_of_nothing_and_of_zero_vectors(spark):
    none = frame(spark, np.ones((1, 4))).where("false")
    some = frame(spark, np.array([[0.0] * 4, [1.0, 0, 0, 0], [0.0] * 4]), "q")
    index = vector_index.build_tile_index(none, store_id="id")
    for in_place in (True, False):
        assert vector_index.search_tiles(some, index, 5, query_id="id", in_place=in_place).count() == 0
    index = vector_index.build_tile_index(some.withColumn("id", F.concat(F.lit("s"), F.substring("id", 2, 3))), store_id="id")
    got = vector_index.search_tiles(some.unionByName(some.select(F.lit("q9").alias("id"), F.lit(None).cast("array<double>").alias("embedding"))), index, 2, query_id="id").collect()
    assert {(r[0], r[1], r[2]) for r in got} == {("q000", 1, "s000"), ("q000", 2, "s001"), ("q001", 1, "s001"), ("q001", 2, "s000"), ("q002", 1, "s000"), ("q002", 2, "s001")}
    assert vector_index.ann_topk(some, none, query_id="id", store_id="id").count() == 0
    assert vector_index.ann_topk(none, some, query_id="id", store_id="id").count() == 0


def test_hashing_finds_nine_of_ten(spark):
    """Recall of the approximate search on the whole table, against the exact one; the figure stands in the README."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    near = {(r.query_id, r.store_id) for r in vector_index.ann_topk(e, e, query_id="vec_id", store_id="vec_id").collect()}
    want = {(r.query_id, r.store_id) for r in retrieval.topk_similar(e, e, query_id="vec_id", store_id="vec_id").collect()}
    assert len(near & want) / len(want) >= 0.95


def test_queries_with_few_candidates_get_the_exact_answer(spark):
    m = clustered(60, 4)
    q = np.concatenate([m[:10], -m[:10]])
    got = vector_index.ann_topk(frame(spark, q, "q"), frame(spark, m), 5, query_id="id", store_id="id", tables=1, bits=12, probes=0)
    far = {t for t in exact(m, q, 5) if int(t[0][1:]) >= 10}  # nothing lies in the buckets of opposite vectors
    assert far <= {tuple(r)[:3] for r in got.collect()}
    full = vector_index.ann_topk(frame(spark, q, "q"), frame(spark, m), 5, query_id="id", store_id="id", tables=2, bits=1, probes=1, cell_rows=10)
    assert {tuple(r)[:3] for r in full.collect()} == exact(m, q, 5)


def test_k_bound_blank_and_empty(spark, vectors):
    q = frame(spark, vectors[:3], "q").withColumn("text", F.when(F.col("id") == "q001", "  ").otherwise("hi"))
    top = retrieval.topk_similar(q, frame(spark, vectors[:4]), 10, query_id="id", store_id="id", query_text="text")
    assert {(r[0], r[1]) for r in top.groupBy("query_id").count().collect()} == {("q000", 4), ("q002", 4)}
    scores = {r[0]: r.evidence_score for r in retrieval.evidence_score(q, top, query_id="id").collect()}
    assert scores["q001"] == 0.0 and scores["q000"] != 0.0
    none = retrieval.topk_similar(q.where("false"), frame(spark, vectors), 5, query_id="id", store_id="id")
    assert none.count() == 0


def test_store_round_trip(spark, vectors):
    store = write_evidence_store(frame(spark, vectors * 3), shared_folder(spark, "t"))
    assert store.count() == 300
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-6 for r in store.collect())


TEXTS = [("phone broken screen", "hardware"), ("broken phone battery", "hardware"), ("phone screen battery broken", "hardware"),
         ("refund my money", "billing"), ("money refund charge", "billing"), ("charge refund money please", "billing"),
         ("wifi not working", "network"), ("wifi signal not working", "network"), ("signal wifi lost working", "network")]


@pytest.fixture(scope="module")
def train(spark):
    return materialize(spark.createDataFrame([(str(i), t, y) for i, (t, y) in enumerate(TEXTS)],
                                             "tweet_id string, clean_text string, intent string"), "train")


def test_tfidf_formula(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "aa cc"), (3, "bb")], "doc_id int, text string")
    spec = features.TfidfSpec(min_df=1, max_df=1.0, max_n=1)
    vocab = features.tfidf_vocabulary(docs, spec)
    got = {(r.doc_id, r.term): r.weight for r in features.tfidf_weights(docs, vocab, spec).collect()}
    idf = {t: np.log(4 / (1 + df)) + 1 for t, df in (("aa", 2), ("bb", 2), ("cc", 1))}
    a, b = (1 + np.log(2)) * idf["aa"], idf["bb"]
    assert abs(got[(1, "aa")] - a / np.hypot(a, b)) < 1e-12 and abs(got[(3, "bb")] - 1) < 1e-12
    assert len(got) == 5
    capped = features.tfidf_vocabulary(docs, features.TfidfSpec(min_df=2, max_df=0.7, max_n=1, max_features=1))
    assert [r.term for r in capped.collect()] == ["aa"]


def test_classifier_invariants(spark, train):
    model = models.fit_tfidf_lr(train)
    rows = spark.createDataFrame([("a", "broken phone"), ("b", ""), ("c", "!!!"), ("d", "refund")], "tweet_id string, clean_text string")
    out = {r.tweet_id: r for r in model.predict(rows).collect()}
    assert len(out) == 4 and out["a"].prediction == "hardware" and out["d"].prediction == "billing"
    for r in out.values():
        assert set(r.proba) == {"hardware", "billing", "network"} and abs(sum(r.proba.values()) - 1) < 1e-9
        assert r.confidence == max(r.proba.values())
    assert model.predict(rows.where("false")).count() == 0
    assert model.top_features(3, "network").count() == 3 and model.top_features(3, "unknown").count() == 0
    path = shared_folder(spark, "model")
    model.save(path)
    again = models.load_best_model(spark, path)
    assert again.kind == "tfidf_lr"
    assert {r.tweet_id: r.prediction for r in again.predict(rows).collect()} == {k: v.prediction for k, v in out.items()}
    with pytest.raises(FileNotFoundError):
        models.load_best_model(spark, shared_folder(spark, "nothing"))


def test_majority(spark, train):
    rows = train.unionByName(train.where("intent = 'network'").withColumn("tweet_id", F.concat("tweet_id", F.lit("x"))))
    out = models.majority_baseline(rows, train).collect()
    assert {r.prediction for r in out} == {"network"} and out[0].proba == {"network": 1.0, "hardware": 0.0, "billing": 0.0}
    assert models.majority_baseline(train.where("false"), train).count() == 0


def test_scoring_batch_and_stream_agree(spark, train, vectors):
    model = models.fit_tfidf_lr(train)
    store = frame(spark, vectors[:20]).select(F.col("id").alias("store_id"), "embedding", F.lit("q").alias("customer_text"),
                                              F.concat(F.lit("reply "), "id").alias("brand_text"), F.lit("c").alias("conversation_id"),
                                              F.lit(None).cast("string").alias("created_at"))
    msgs = frame(spark, vectors[:6], "m").select(F.col("id").alias("tweet_id"), F.when(F.col("id") == "m003", "@x ").otherwise(
        "my phone is broken").alias("text"), "embedding")
    batch = {r.tweet_id: r for r in score_messages(msgs, model, store).collect()}
    assert len(batch) == 6
    blank = batch["m003"]
    assert (blank.decision, blank.decision_reason, blank.intent) == ("ESCALATE", "Empty or unreadable message.", None)
    one = batch["m000"]
    assert one.reply == "reply s000" and one.grounded and len(one.evidence) == 5 and one.evidence[0].similarity == 1.0
    index = retrieval.build_evidence_index(store, tile_rows=4)
    by_index = {r.tweet_id: r for r in score_messages(msgs, model, index).collect()}
    assert {k: (v.decision, v.reply, v.evidence) for k, v in by_index.items()} == {k: (v.decision, v.reply, v.evidence) for k, v in batch.items()}
    inbox, out, progress = (shared_folder(spark, n) for n in ("inbox", "out", "progress"))
    msgs.write.parquet(inbox)
    for _ in range(2):   # the second start finds nothing new
        stream = streaming.message_stream(spark, inbox, "tweet_id string, text string, embedding array<double>")
        streaming.score_stream(stream, model, store, out=out, checkpoint=progress).awaitTermination()
    got = {r.tweet_id: (r.decision, r.reply) for r in streaming.read_scored(spark, out).collect()}
    assert got == {k: (v.decision, v.reply) for k, v in batch.items()}


def test_stream_batches_replay_and_tiles(spark, train, monkeypatch):
    """Three bounded batches; a batch that comes again, or dies before its commit, changes nothing; few tiles are read."""
    m = clustered(240, 6)
    model = models.fit_tfidf_lr(train)
    store = frame(spark, m).select(F.col("id").alias("store_id"), "embedding", F.concat(F.lit("reply "), "id").alias("brand_text"))
    index = retrieval.build_evidence_index(store, tile_rows=20)
    inbox, out = shared_folder(spark, "inbox"), shared_folder(spark, "out")
    parts = [frame(spark, m[k * 40:k * 40 + 3] if k % 2 else m[:3], f"m{k}").select(F.col("id").alias("tweet_id"), F.lit("broken phone").alias("text"), "embedding") for k in range(6)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
    visited = []
    scan = vector_index.scan_in_place
    monkeypatch.setattr(vector_index, "scan_in_place", lambda visits, *rest: (visited.append({r.tile for r in visits.select("tile").distinct().collect()}), scan(visits, *rest))[1])
    stream = streaming.message_stream(spark, inbox, "tweet_id string, text string, embedding array<double>", files_per_batch=2)
    streaming.score_stream(stream, model, index, out=out, checkpoint=shared_folder(spark, "progress")).awaitTermination()
    commits = streaming.committed(spark, out).orderBy("batch_id").collect()
    assert [(c.batch_id, c.rows) for c in commits] == [(0, 6), (1, 6), (2, 6)]
    assert len(visited) == 6 and all(len(tiles) < len(index.tiles.centres) for tiles in visited)
    rows = streaming.read_scored(spark, out)
    assert rows.count() == 18 and rows.groupBy("tweet_id").count().where("count > 1").count() == 0
    assert not streaming.score_batch(parts[0], 1, model, index, out)                      # replayed
    parts[0].write.parquet(f"{out}/data/batch_id=3/attempt=died")                         # no commit
    assert streaming.read_scored(spark, out).count() == 18


def test_texts_of_examples_stay_out_of_the_search(spark, train, monkeypatch):
    """Cells and candidates hold one id a vector and no text; examples are put together once a distinct vector."""
    m = spread(240)
    m[100:140] = m[0]  # copies, of which an index keeps five
    model = models.fit_tfidf_lr(train)
    store = frame(spark, m).select(F.col("id").alias("store_id"), "embedding", F.concat(F.lit("case "), "id").alias("customer_text"), F.concat(F.lit("reply "), "id").alias("brand_text"))
    index = retrieval.build_evidence_index(store, tile_rows=20)
    assert {f.name for f in index.rows.schema["ids"].dataType.elementType} == {"id", "place"} and index.rows.schema["v"].dataType.simpleString() == "array<float>"
    assert index.examples.count() == 240 - 36 and {"customer_text", "brand_text"} <= set(index.examples.columns)
    seen, cells = [], vector_index.cell_candidates

    def watched(visits, rows, *rest):
        found = cells(visits, rows, *rest)
        seen.append((rows.select(F.max(F.size("ids"))).first()[0], visits.schema["q"].dataType.simpleString(), [r.score for r in found.collect()]))
        return found

    packed, pack = [], retrieval.pack_evidence
    monkeypatch.setattr(vector_index, "SCAN_BYTES", 1)
    monkeypatch.setattr(vector_index, "cell_candidates", watched)
    monkeypatch.setattr(retrieval, "pack_evidence", lambda found: (packed.append(pack(found).count()), pack(found))[1])
    vectors = np.concatenate([m[:12], m[:12]])
    msgs = frame(spark, vectors, "m").select(F.col("id").alias("tweet_id"), F.lit("my phone is broken").alias("text"), "embedding")
    got = {r.tweet_id: r for r in score_messages(msgs, model, index).collect()}
    assert packed == [12] and [s[:2] for s in seen] == [(1, "array<float>")] * 2
    answers = exact(m, vectors, 5)
    want = {f"m{k:03d}": [j for _, j in sorted((r, j) for q, r, j in answers if q == f"q{k:03d}")] for k in range(24)}
    assert {k: [e.customer_text.removeprefix("case ") for e in r.evidence] for k, r in got.items()} == want
    assert all(r.reply == f"reply {want[k][0]}" for k, r in got.items())


def test_fit_stands_at_its_optimum(spark, train):
    vocab, size = models.frozen_vocabulary(train, features.CLASSIFIER, key="tweet_id", text="clean_text")
    vectors = features.vector_table(train, vocab, size, key="tweet_id", text="clean_text", keep=["intent"])
    for c in (0.5, 5.0):
        weights, labels = models.fit_logistic(vectors, "intent", c)
        flat = models.gradient(models.IntentModel("tfidf_lr", weights, labels, vocab), vectors, "intent", c).collect()
        assert {r.label for r in flat} == {"hardware", "billing", "network"} and all(r.largest < 1e-5 for r in flat)
        off = weights.withColumn("weight", F.col("weight") + F.when(F.col("label") == "billing", 0.1).otherwise(0.0))
        assert max(r.largest for r in models.gradient(models.IntentModel("tfidf_lr", off, labels, vocab), vectors, "intent", c).collect()) > 1e-3


def test_training_rows_are_computed_once_and_two_classes_share_a_vector(spark, train):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        seen.add(1)
        return text

    two = train.where("intent <> 'network'")
    model = models.fit_tfidf_lr(two.withColumn("clean_text", told("clean_text")))
    assert seen.value == two.count()
    weights = {(r.label, r.idx): r.weight for r in model.weights.collect()}
    assert all(weights["billing", k] == -x for (label, k), x in weights.items() if label == "hardware") and max(weights.values()) > 0.1
    vocab, size = models.frozen_vocabulary(two, features.CLASSIFIER, key="tweet_id", text="clean_text")
    for c in (0.1, 10.0):
        vectors = features.vector_table(two, vocab, size, key="tweet_id", text="clean_text", keep=["intent"])
        weights, labels = models.fit_logistic(vectors, "intent", c)
        flat = models.gradient(models.IntentModel("tfidf_lr", weights, labels, vocab), vectors, "intent", c).collect()
        assert len(flat) == 2 and all(r.largest < 1e-5 for r in flat)


def test_embedding_model_as_a_table(spark):
    m = np.concatenate([np.random.default_rng(k).normal(loc=3 * k, scale=0.3, size=(30, 3)) for k in range(3)])
    rows = spark.createDataFrame([(k, v.tolist(), f"c{k // 30}") for k, v in enumerate(m)], "vec_id int, embedding array<double>, intent string")
    model = models.fit_embedding_lr(rows, key="vec_id")
    assert model.weights.count() == 3 * 4
    w = {(r.label, r.idx): r.weight for r in model.weights.collect()}
    for r in model.predict(rows).collect():
        z = np.array([w[(c, -1)] + sum(w[(c, j)] * x for j, x in enumerate(r.embedding)) for c in ("c0", "c1", "c2")])
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.prediction == r.intent and np.allclose([r.proba[c] for c in ("c0", "c1", "c2")], p, atol=1e-12)


def test_tuning_scores_only_the_chosen_model_on_the_test_split(spark, train):
    val = train.where("clean_text like '%phone%' or clean_text like '%refund%'")
    table, best = models.tune_regularization(train, val, (0.1, 1.0, 10.0), test=train)
    rows = table.orderBy("c").collect()
    assert [r.best for r in rows].count(True) == 1
    top = next(r for r in rows if r.best)
    assert top.val_macro_f1 == max(r.val_macro_f1 for r in rows) and top.c == min(r.c for r in rows if r.val_macro_f1 == top.val_macro_f1)
    assert all((r.test_accuracy is None) == (not r.best) for r in rows)
    want = models.CellEvaluator("intent").scores(best.predict(train))
    assert (top.test_accuracy, top.test_macro_f1) == want


def test_kmeans_restarts_side_by_side(spark):
    texts = ["red green blue", "green red", "blue red green", "one two three", "two one", "three two one", "cat dog", "dog cat bird"] * 3 + ["", None]
    docs = materialize(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), "docs")
    spec = features.TfidfSpec(min_df=1, max_df=1.0, sublinear=False)
    clusters, assigned = models.discover_intents(docs, n_clusters=3, restarts=8, spec=spec)
    of = {r.doc_id: r.cluster_id for r in assigned.collect()}
    groups = {frozenset(texts[k] for k in of if of[k] == c and texts[k]) for c in set(of.values())}
    assert frozenset(["red green blue", "green red", "blue red green"]) in groups and frozenset(["cat dog", "dog cat bird"]) in groups
    assert sum(r.size for r in clusters.collect()) == len(texts)
    # each restart moves as it would alone
    vocab, size = models.frozen_vocabulary(docs, spec, key="doc_id", text="text")
    packed = features.vector_table(docs, vocab, size, spec, key="doc_id", text="text", keep=["doc_id"], packed=True)
    centres = models.first_centres(packed, "doc_id", 4, size, 3, 42)
    together, cost = models.lloyd_round(packed, centres, 4)
    for r in range(3):
        alone, own = models.lloyd_round(packed, centres[4 * r:4 * r + 4], 4)
        assert np.allclose(alone, together[4 * r:4 * r + 4]) and np.allclose(own, cost[r])


def test_discovery_runs_all_restarts_until_their_centres_stand_still(spark, monkeypatch, tmp_path):
    """Texts along a chain, over which centres creep for many rounds."""
    from workload import queries
    texts = [" ".join(f"w{j}" for j in range(k, k + 12)) for k in range(240)]
    spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, lloyd = [], models.lloyd_round
    monkeypatch.setattr(models, "lloyd_round", lambda v, c, k: (seen.append((c.copy(), lloyd(v, c, k))), seen[-1][1])[1])
    assert sum(r.size for r in queries.Q["discover_intents"](spark, str(tmp_path)).collect()) == len(texts)
    rounds, (end, (further, cost)) = seen[:-1], seen[-1]
    assert len(rounds) > 15 and len(rounds[0][0]) == len(end) == 10 * 8 and len(cost) == 10
    assert np.abs(further - end).max() <= models.STILL
    assert len(rounds[-1][0]) < len(rounds[0][0])  # a restart that stands still sits out


def test_tfidf_shuffles_no_text(spark):
    docs = materialize(spark.createDataFrame([(1, "aa bb aa"), (2, "aa cc"), (3, ""), (4, None)], "doc_id int, text string"), "docs")
    vocab = features.tfidf_vocabulary(docs, features.TfidfSpec(min_df=1, max_df=1.0))
    assert {(r.term, r.df, r.cf) for r in vocab.collect()} == {
        ("aa", 2, 3), ("bb", 1, 1), ("cc", 1, 1), ("aa bb", 1, 1), ("bb aa", 1, 1), ("aa cc", 1, 1)}
    for df in (vocab, features.tfidf_weights(docs, vocab)):
        plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        shuffles = [part for part in plan.split("\n\n") if ") Exchange" in part.split("\n")[0]]
        assert shuffles and not any("text#" in part for part in shuffles)
        assert "Python" not in plan


def test_vocabulary_of_frequent_phrases_is_the_counted_one(spark):
    """Phrases are counted among frequent words only once a floor is known; repeated and null keys merge as ever."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, size=30) if x < 60) for _ in range(80)] + ["", None, "alone", "aa aa aa aa"]
    docs = materialize(spark.createDataFrame([(k if k % 9 else None, t) for k, t in enumerate(texts)], "doc_id int, text string"), "docs")
    for spec in (features.TfidfSpec(max_features=8), features.TfidfSpec(min_df=5, max_df=0.6, max_features=20, max_n=3, stop_words=("w1",)), features.TfidfSpec()):
        n, kept = len(texts), []
        for r in features.term_totals(docs, spec).collect():
            if spec.min_df <= r.df <= n * spec.max_df:
                kept.append((-r.cf, r.term, r.df))
        want = {(t, df, -cf) for cf, t, df in sorted(kept)[:spec.max_features]}
        assert {(r.term, r.df, r.cf) for r in features.tfidf_vocabulary(docs, spec).collect()} == want
    counted = {}
    for t in texts:
        words = [w for w in (t or "").split() if len(w) > 1]
        for g in set(words) | set(map(" ".join, zip(words, words[1:]))):
            counted.setdefault(g, [0, 0])[0] += 1
        for g in words + list(map(" ".join, zip(words, words[1:]))):
            counted[g][1] += 1
    assert {r.term: [r.df, r.cf] for r in features.term_totals(docs).collect()} == counted
    floors = features._floor(features.term_totals(docs, features.TfidfSpec(max_n=1)), features.TfidfSpec(max_features=8))
    assert floors > 1 and all("Expand" not in p and p.count("regexp_extract_all") <= 1 for p in
                              [features.gram_lists(docs, features.CLASSIFIER, "text")._jdf.queryExecution().optimizedPlan().toString()])


def test_weights_shuffle_one_row_a_document(spark, train):
    """Terms are counted in the row: what is shuffled is an array per document, and clusters meet it without a sort of long rows."""
    docs = train.select(F.col("tweet_id").alias("doc_id"), F.col("clean_text").alias("text"))
    vocab = features.tfidf_vocabulary(docs)
    weights = features.tfidf_weights(docs, vocab)
    plan = features.cluster_terms(weights, docs.withColumn("cluster_id", F.lit(1)))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "ShuffledHashJoin" in plan and "SortMergeJoin [doc_id" not in plan
    twice = features.tfidf_weights(docs.unionByName(docs), vocab).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    once = weights.groupBy("doc_id", "term").agg(F.sum("weight").alias("v"))
    rows = twice.join(once, ["doc_id", "term"]).collect()
    assert rows and all(r.n == 2 and abs(r.w - r.v * 2 ** 0.5) < 1e-12 for r in rows)


def test_shared_evidence_equals_evidence_per_query_and_moves_texts_once_a_share(spark):
    """Copies in the store, a query with no match left, and groups of queries that share most of their examples."""
    found = [(q, q // 4, r, (q // 4 * 4 + r) % 20, 1.0 - r / 10) for q in range(16) for r in range(1, 6)] + [(99, 99, 1, 500, 0.5)]
    top = spark.createDataFrame([(s, q, r, i, x) for q, s, r, i, x in found], "share long, query_id long, rank int, store_id long, similarity double")
    store = spark.createDataFrame([(i, f"case {i}", f"reply {i}", None) for i in range(20)] + [(3, "case 3", "reply 3", None)],
                                  "sid long, customer_text string, brand_text string, conversation_id string")
    want = retrieval.attach_evidence(top.drop("share"), store, store_id="sid", hot_rows=None)
    packed = retrieval.shared_evidence(top, store, store_id="sid", hot_rows=None)
    got = retrieval.own_evidence(top.select("share", "query_id").distinct().join(packed, "share"), "query_id").select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 16
    assert max(r[0] for r in packed.select(F.size(F.array_distinct(F.transform("examples", lambda e: e["store_id"])))).collect()) == 5
    assert packed.count() == 4


def test_prompts_read_no_text_for_the_search(spark):
    from workload import fixtures
    assert fixtures.case_vectors(spark, "/root/testdata/sf0.001").columns == ["e", "vec_id", "share", "embedding"]
