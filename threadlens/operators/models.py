"""Classifiers, regularisation search, clustering and their persistence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.operators.features import (CLASSIFIER, TfidfSpec, cluster_terms, discovery_spec, term_scores, tfidf_vocabulary,
                                           tfidf_weights, vector_table)
from threadlens.operators.metrics import classifier_metrics, confusion_cells
from threadlens.schema import SEED
from threadlens.sources.scratch import materialize

C_GRID = (0.1, 1.0, 10.0)
MAX_CLASSES = 1_000
RESTARTS, ROUNDS = 10, 300  # of k-means: starts, and rounds of one that never stands still
TOL = 1e-8                # relative improvement of the loss that ends a fit
DIGITS, STILL = 9, 1e-10  # of squared distances; movement of a centre that counts as none


def majority_baseline(train: DataFrame, rows: DataFrame, label: str = "intent") -> DataFrame:
    """``rows`` with the most frequent training label, confidence 1.0 and the 0/1 map.

    The class list is small by nature and reaches the rows as one scalar.  No training
    rows, no prediction.
    """
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    summary = counts.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("top"),
                         F.array_sort(F.collect_set(label)).alias("labels"))
    packed = summary.select(F.struct("top", "labels"))
    return rows.withColumn("__m", packed.scalar()).where(F.col("__m.top").isNotNull()) \
        .withColumn("prediction", F.col("__m.top")).withColumn("confidence", F.lit(1.0)) \
        .withColumn("proba", F.map_from_arrays(F.col("__m.labels"), F.transform(
            F.col("__m.labels"), lambda x: F.when(x == F.col("__m.top"), 1.0).otherwise(0.0)))) \
        .drop("__m")


def _class_table(train: DataFrame, label: str) -> tuple[list[str], int, DataFrame]:
    """Sorted labels, row count and (label, idx, class weight n/(K*n_c)); one row per class."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).count()
    stats = sorted((r[0], r[1]) for r in counts.limit(MAX_CLASSES + 1).collect())
    if len(stats) > MAX_CLASSES:
        raise ValueError(f"column {label} has more than {MAX_CLASSES} classes")
    labels, n = [s[0] for s in stats], sum(s[1] for s in stats)
    rows = [(name, float(i), n / (len(stats) * count)) for i, (name, count) in enumerate(stats)]
    return labels, n, train.sparkSession.createDataFrame(rows, f"`{label}` string, __y double, __w double")


def fit_logistic(vectors: DataFrame, label: str, c: float = 1.0, max_iter: int = 1000, features: str = "features",
                 tol: float = TOL) -> tuple[DataFrame, list[str]]:
    """(label, idx, weight) coefficients of a multinomial, class-balanced, L2 logistic regression, and its labels.

    ``idx`` -1 is the intercept.  Weights sum to n, so the penalty 1/C of a summed loss is 1/(C*n) of Spark's mean loss.
    ``vectors`` should be a written table: every iteration is a job over its lineage.
    """
    labels, n, classes = _class_table(vectors, label)
    data = vectors.join(F.broadcast(classes), label).select(features, "__y", "__w")
    two = len(labels) == 2  # their weights are opposite at the optimum: v/2 and -v/2 of one vector of log-odds v, whose penalty is half as strong
    lr = LogisticRegression(featuresCol=features, labelCol="__y", weightCol="__w", family="binomial" if two else "multinomial",
                            regParam=(0.5 if two else 1.0) / (c * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol).fit(data)
    odds, bias = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    if two:
        odds, bias = np.concatenate([-odds, odds]) / 2, np.concatenate([-bias, bias]) / 2
    rows = [(name, [float(b), *map(float, row)]) for name, b, row in zip(labels, bias, odds)]
    table = vectors.sparkSession.createDataFrame(rows, "label string, w array<double>") \
        .select("label", F.posexplode("w").alias("p", "weight")).select("label", (F.col("p") - 1).alias("idx"), "weight")
    return materialize(table, "coefficients"), labels


def add_predictions(scored: DataFrame, labels: Sequence[str], logits: str = "__z") -> DataFrame:
    """prediction (first maximum), confidence and {label: p}: the softmax of an array of one number a label."""
    names = F.array(*[F.lit(x) for x in labels])
    powers = F.transform(logits, lambda z: F.exp(z - F.array_max(logits)))
    return (scored.withColumn("__e", powers).withColumn("__sum", F.aggregate("__e", F.lit(0.0), lambda a, x: a + x))
            .withColumn("__p", F.transform("__e", lambda e: e / F.col("__sum")))
            .withColumn("confidence", F.array_max("__p"))
            .withColumn("prediction", F.element_at(names, F.array_position("__p", F.col("confidence")).cast("int")))
            .withColumn("proba", F.map_from_arrays(names, F.col("__p"))).drop("__e", "__sum", "__p", logits))


@dataclass
class IntentModel:
    """A fitted classifier as tables: kind ``tfidf_lr`` reads text, ``embedding_lr`` an embedding column.

    ``weights`` holds (label, idx, weight), classes x (features + 1) rows; ``idx`` -1 is the intercept.  Scoring is a dot product and a
    softmax in SQL expressions.
    """

    kind: str
    weights: DataFrame
    labels: list[str]
    vocab: DataFrame | None = None
    spec: TfidfSpec = CLASSIFIER
    key: str = "tweet_id"
    source: str = "clean_text"

    def coefficients(self) -> DataFrame:
        """(idx, coefs): one row a feature, the weights in the order of the labels; at most the model's size."""
        return self.weights.groupBy("idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("label", "weight"))), lambda x: x["weight"]).alias("coefs"))

    def logits(self, rows: DataFrame) -> DataFrame:
        """``rows`` plus ``__z``, one number a label."""
        own = self.coefficients()
        if self.kind == "tfidf_lr":
            terms = self.vocab.select("term", "idx", "idf").join(own, "idx").select("term", "idf", "coefs")
            z = term_scores(rows, terms, self.labels, self.spec, key=self.key, text=self.source).withColumnRenamed("z", "__dot")
            found = rows.join(z, self.key, "left").withColumn("__b", own.where("idx = -1").select("coefs").scalar())
            return found.withColumn("__z", F.when(F.col("__dot").isNull(), F.col("__b")).otherwise(F.zip_with("__dot", "__b", lambda d, b: d + b))).drop("__dot", "__b")
        packed = own.groupBy().agg(F.array_sort(F.collect_list(F.struct("idx", "coefs"))).alias("m"))  # the whole model, one row
        lists = packed.select(F.array(*[_column_of(F.col("m"), j) for j in range(len(self.labels))]).alias("m"))
        v = F.col(self.source).cast("array<double>")
        return rows.withColumn("__m", lists.scalar()).withColumn("__z", F.transform("__m", lambda c: F.aggregate(
            F.zip_with(F.slice(c, 2, F.size(c) - 1), v, lambda w, x: w * x), F.get(c, F.lit(0)), lambda a, x: a + x))).drop("__m")

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` plus prediction, confidence and proba."""
        return add_predictions(self.logits(rows), self.labels).select(*rows.columns, "prediction", "confidence", "proba")

    def top_features(self, n: int = 10, intent: str | None = None, digits: int = 6) -> DataFrame:
        """(intent, rank, term, coefficient); an unknown intent gives no rows.  Equal rounded coefficients go by term."""
        long = self.weights.select(F.col("label").alias("intent"), "idx", F.round("weight", digits).alias("coefficient"))
        if intent is not None:
            long = long.where(F.col("intent") == intent)
        w = Window.partitionBy("intent").orderBy(F.desc("coefficient"), "term")
        return long.join(self.vocab, "idx").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n) \
            .select("intent", "rank", "term", "coefficient")

    def save(self, path: str) -> None:
        """Write the coefficients, labels, parameters and vocabulary below ``path/<kind>``; the parameters last, as their presence
        says that the model is whole."""
        base = f"{path}/{self.kind}"
        self.weights.write.mode("overwrite").parquet(f"{base}/weights")
        if self.vocab is not None:
            self.vocab.write.mode("overwrite").parquet(f"{base}/vocab")
        spec = (self.spec.min_df, self.spec.max_df, self.spec.max_features, self.spec.max_n, self.spec.sublinear,
                list(self.spec.stop_words))
        self.weights.sparkSession.createDataFrame([(self.labels, self.key, self.source, *spec)], (
            "labels array<string>, key string, source string, min_df int, max_df double, max_features int, "
            "max_n int, sublinear boolean, stop_words array<string>")).write.mode("overwrite").parquet(f"{base}/meta")


def _column_of(m: Column, j: int) -> Column:
    return F.transform(m, lambda x: x["coefs"][j])


def load_model(spark: SparkSession, path: str, kind: str) -> IntentModel:
    base = f"{path}/{kind}"
    m = spark.read.parquet(f"{base}/meta").first()
    spec = TfidfSpec(m.min_df, m.max_df, m.max_features, m.max_n, m.sublinear, tuple(m.stop_words))
    vocab = spark.read.parquet(f"{base}/vocab") if kind == "tfidf_lr" else None
    return IntentModel(kind, spark.read.parquet(f"{base}/weights"), m.labels, vocab, spec, m.key, m.source)


def load_best_model(spark: SparkSession, path: str) -> IntentModel:
    """The embedding model if one was saved, else the TF-IDF one."""
    for kind in ("embedding_lr", "tfidf_lr"):
        try:
            return load_model(spark, path, kind)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"No trained classifier found under {path}")


def gradient(model: IntentModel, vectors: DataFrame, label: str, c: float, features: str = "features") -> DataFrame:
    """(label, largest): the largest derivative of the penalised mean loss of a model on its training table, per label.

    Near zero for every label means that the fit stands at its optimum.  Every row is scored and unfolded to its features;
    sums per (label, feature) combine within tasks.
    """
    labels, n, classes = _class_table(vectors, label)
    wide = vectors.join(F.broadcast(classes), label).withColumn("__v", vector_to_array(features)).withColumn("__id", F.monotonically_increasing_id())
    scored = materialize(IntentModel("embedding_lr", model.weights, labels, key="__id", source="__v").predict(wide.select("__id", "__v", label, "__w")), "scored")
    at = scored.select("__w", F.col(label).alias("__l"), "proba", F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("__v"))).alias("p", "x")).where("x <> 0")
    each = at.select((F.col("p") - 1).alias("idx"), F.explode("proba").alias("label", "pr"), "__w", "__l", "x")
    sums = each.groupBy("label", "idx").agg((F.sum(F.col("__w") * F.col("x") * (F.col("pr") - (F.col("__l") == F.col("label")).cast("double"))) / n).alias("g"))
    pull = F.when(F.col("idx") >= 0, F.col("weight") / (c * n)).otherwise(0.0)
    return model.weights.join(sums, ["label", "idx"], "left").groupBy("label").agg(F.max(F.abs(F.coalesce("g", F.lit(0.0)) + pull)).alias("largest"))


def fit_tfidf_lr(train: DataFrame, *, label: str = "intent", key: str = "tweet_id", text: str = "clean_text",
                 c: float = 1.0, spec: TfidfSpec = CLASSIFIER, max_iter: int = 1000, tol: float = TOL) -> IntentModel:
    """Vocabulary and logistic regression on ``train``."""
    train = materialize(train.select(*dict.fromkeys([key, text, label])), "train")  # read by every pass over the texts
    vocab, size = frozen_vocabulary(train, spec, key=key, text=text)
    vectors = vector_table(train, vocab, size, spec, key=key, text=text, keep=[label])
    weights, labels = fit_logistic(vectors, label, c, max_iter, tol=tol)
    return IntentModel("tfidf_lr", weights, labels, vocab, spec, key, text)


def frozen_vocabulary(docs: DataFrame, spec: TfidfSpec, *, key: str, text: str) -> tuple[DataFrame, int]:
    """Vocabulary computed once (at most ``max_features`` rows, as the model holds them) and its size."""
    vocab = materialize(tfidf_vocabulary(docs, spec, key=key, text=text), "vocabulary")
    return vocab, max(1, vocab.count())


def fit_embedding_lr(train: DataFrame, *, label: str = "intent", key: str = "tweet_id", vector: str = "embedding",
                     c: float = 1.0, max_iter: int = 1000, tol: float = TOL) -> IntentModel:
    vectors = materialize(train.select(
        array_to_vector(F.col(vector).cast("array<double>")).alias("features"), label), "features")
    weights, labels = fit_logistic(vectors, label, c, max_iter, tol=tol)
    return IntentModel("embedding_lr", weights, labels, key=key, source=vector)


class CellEvaluator(Evaluator):
    """Macro F1 of (label, prediction) rows, from their confusion cells; larger is better."""

    def __init__(self, label: str):
        super().__init__()
        self.label = label

    def scores(self, dataset: DataFrame) -> tuple[float, float]:
        """(accuracy, macro F1); zeros without rows."""
        found = classifier_metrics(confusion_cells(dataset, self.label, "prediction")).select("accuracy", "macro_f1").first()
        return (found.accuracy or 0.0, found.macro_f1 or 0.0) if found else (0.0, 0.0)

    def _evaluate(self, dataset: DataFrame) -> float:
        return self.scores(dataset)[1]

    def isLargerBetter(self) -> bool:
        return True


def tune_regularization(train: DataFrame, val: DataFrame, grid: Sequence[float] = C_GRID, *, test: DataFrame | None = None, label: str = "intent",
                        key: str = "tweet_id", text: str = "clean_text", spec: TfidfSpec = CLASSIFIER,
                        max_iter: int = 1000) -> tuple[DataFrame, IntentModel]:
    """(c, val_macro_f1, best, test_accuracy, test_macro_f1) per C, and the model of the first best C.

    Only the chosen model sees ``test``; its row carries what it scores there, the others null.  Training features
    are built once for all fits; the driver sees one number per C.
    """
    train = materialize(train.select(*dict.fromkeys([key, text, label])), "train")  # read by every pass over the texts
    vocab, size = frozen_vocabulary(train, spec, key=key, text=text)
    vectors = vector_table(train, vocab, size, spec, key=key, text=text, keep=[label])
    evaluator, fits = CellEvaluator(label), []
    for c in grid:
        weights, labels = fit_logistic(vectors, label, c, max_iter)
        model = IntentModel("tfidf_lr", weights, labels, vocab, spec, key, text)
        fits.append((float(c), evaluator.evaluate(model.predict(val.select(key, text, label))), model))
    best = max(range(len(fits)), key=lambda k: (fits[k][1], -k))  # strictly better, so the first of equals
    scores = evaluator.scores(fits[best][2].predict(test.select(key, text, label))) if test is not None else (None, None)
    table = train.sparkSession.createDataFrame([(c, f1, k == best, *(scores if k == best else (None, None))) for k, (c, f1, _) in enumerate(fits)],
                                               "c double, val_macro_f1 double, best boolean, test_accuracy double, test_macro_f1 double")
    return table, fits[best][2]


def sparse_rows(indices: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each entry, feature, value) of a batch of sparse vectors."""
    sizes = indices.value_lengths().to_numpy(zero_copy_only=False)
    return (np.repeat(np.arange(len(sizes)), sizes), indices.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False))


def nearest_centres(indices: pa.Array, values: pa.Array, centres: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of sparse rows in every restart: arrays of rows x restarts.

    ``centres`` is (restarts * k) x features.  Distances are compared rounded to DIGITS, ties go to the smaller cluster.
    """
    rows, features, x = sparse_rows(indices, values)
    dots = np.zeros((len(indices), len(centres)))
    turned = np.ascontiguousarray(centres.T)
    for at in range(0, len(rows), 1 << 12):  # what is gathered at once stays in the processor's cache
        part = slice(at, at + (1 << 12))
        first = np.flatnonzero(np.diff(rows[part], prepend=-1))
        dots[rows[part][first]] += np.add.reduceat(turned[features[part]] * x[part, None], first, axis=0)
    own = np.bincount(rows, weights=x * x, minlength=len(indices))
    distance = np.round(own[:, None] - 2.0 * dots + (centres ** 2).sum(axis=1), DIGITS).reshape(len(indices), -1, k)
    return distance.argmin(axis=2), np.maximum(0.0, distance.min(axis=2))


def lloyd_round(vectors: DataFrame, centres: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(new centres, cost per restart): one pass over the data for all restarts together.

    A task adds up what falls to each centre and gives one row a centre; those are added up per centre, in the order of
    tasks, so (restarts * k) x (features + 2) sums reach the driver.
    """
    n, size = centres.shape
    shipped = vectors.sparkSession.sparkContext.broadcast(centres)  # dropped after the round, there may be hundreds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shipped.value
        sums, counts, cost = np.zeros((n, size)), np.zeros(n), np.zeros(n)  # a restart's cost stands beside its first centre
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                cluster, distance = nearest_centres(part.column("indices"), part.column("values"), held, k)
                cost[::k] += distance.sum(axis=0)
                rows, features, x = sparse_rows(part.column("indices"), part.column("values"))
                for r in range(n // k):
                    mine = slice(r * k, r * k + k)
                    counts[mine] += np.bincount(cluster[:, r], minlength=k)
                    sums[mine] += np.bincount(cluster[rows, r] * size + features, weights=x, minlength=k * size).reshape(k, size)
        packed = np.column_stack([counts, cost, sums])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n), pa.int32()), pa.array(np.full(n, TaskContext.get().partitionId()), pa.int32()),
                                          pa.array([row.tobytes() for row in packed], pa.binary())], names=["c", "task", "s"])

    def added(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["task"].to_pylist(), table["s"].to_pylist()))
        total = np.zeros(size + 2)
        for _, row in parts:
            total += np.frombuffer(row)
        return pa.table({"c": table["c"].slice(0, 1), "s": pa.array([total.tobytes()], pa.binary())})

    total = vectors.select("indices", "values").mapInArrow(run, "c int, task int, s binary").groupBy("c").applyInArrow(added, "c int, s binary").toArrow()
    shipped.destroy()
    sums = np.zeros((n, size + 2))
    for c, row in zip(total["c"].to_pylist(), total["s"].to_pylist()):  # one row a centre
        sums[c] = np.frombuffer(row)
    counts, cost, new = sums[:, 0], sums[::k, 1], sums[:, 2:]
    held = counts > 0
    return np.where(held[:, None], new / np.where(held, counts, 1.0)[:, None], centres), cost


def first_centres(vectors: DataFrame, key: str, k: int, size: int, restarts: int, seed: int) -> np.ndarray:
    """Per restart the vectors of the ``k`` keys with the smallest md5('seed:restart:key'), in that order."""
    centres = np.zeros((restarts * k, size))
    for r in range(restarts):
        order = F.md5(F.concat(F.lit(f"{seed}:{r}:"), F.col(key).cast("string")).cast("binary"))
        for j, row in enumerate(vectors.orderBy(order, key).limit(k).select("indices", "values").collect()):  # k rows
            centres[r * k + j, row.indices] = row["values"]
    return centres


def discover_intents(docs: DataFrame, *, n_clusters: int = 8, top: int = 15, restarts: int = RESTARTS, seed: int = SEED,
                     key: str = "doc_id", text: str = "text", spec: TfidfSpec | None = None,
                     max_iter: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """K-means over TF-IDF vectors; the restart of lowest cost wins (the first of equals).

    All restarts run side by side, each round being one pass over the written vectors; a restart whose centres stand
    still sits out the rounds that others need.  Returns (cluster table, assignments key -> cluster_id).  Clusters that
    end empty do not appear.
    """
    spec = spec or discovery_spec()
    vocab, size = frozen_vocabulary(docs, spec, key=key, text=text)
    packed = vector_table(docs.select(key, text), vocab, size, spec, key=key, text=text, keep=[key], packed=True)
    centres = first_centres(packed, key, n_clusters, size, restarts, seed)
    moving = np.arange(restarts)
    for _ in range(max_iter):
        at = (moving[:, None] * n_clusters + np.arange(n_clusters)).ravel()
        moved, _ = lloyd_round(packed, centres[at], n_clusters)
        step = np.abs(moved - centres[at]).reshape(len(moving), -1).max(axis=1)
        centres[at] = moved
        moving = moving[step > STILL]
        if not len(moving):
            break
    _, cost = lloyd_round(packed, centres, n_clusters)
    best = int(np.round(cost, DIGITS).argmin())
    chosen = centres[best * n_clusters:(best + 1) * n_clusters]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cluster, _ = nearest_centres(part.column("indices"), part.column("values"), chosen, n_clusters)
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(cluster[:, 0], pa.int32())], names=[key, "cluster_id"])

    assigned = materialize(packed.mapInArrow(assign, f"{key} {packed.schema[key].dataType.simpleString()}, cluster_id int"), "clusters")
    weights = tfidf_weights(docs, vocab, spec, key=key, text=text)
    return cluster_terms(weights, assigned, key=key, top=top), assigned
