"""TF-IDF features as a long (document, term, weight) table, as ML vectors and as scores of linear models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from threadlens.functions.text import ngrams, tokens
from threadlens.sources.scratch import materialize, shared_folder


@dataclass(frozen=True)
class TfidfSpec:
    """Vectoriser parameters.  ``min_df`` is a row count, ``max_df`` a fraction."""

    min_df: int = 2
    max_df: float = 0.95
    max_features: int = 10_000
    max_n: int = 2
    sublinear: bool = True
    stop_words: Sequence[str] = ()


CLASSIFIER = TfidfSpec()


def discovery_spec() -> TfidfSpec:
    """Discovery settings with Spark's English stop words."""
    from pyspark.ml.feature import StopWordsRemover
    return TfidfSpec(min_df=5, max_df=0.85, max_features=5_000, sublinear=False,
                     stop_words=tuple(StopWordsRemover.loadDefaultStopWords("english")))


def token_lists(docs: DataFrame, spec: TfidfSpec, text: str, *keep: str) -> DataFrame:
    """``keep`` and ``t``, the tokens of a text column without stop words (null without a text).

    A step of its own: n-grams name the tokens several times, and inside one expression each would split the text again.
    """
    toks = F.col("t")
    if spec.stop_words:
        stops = F.array(*[F.lit(w) for w in spec.stop_words])
        toks = F.filter(toks, lambda t: ~F.array_contains(stops, t))
    return docs.select(*keep, tokens(F.col(text)).alias("t")).select(*keep, toks.alias("t"))


def gram_lists(docs: DataFrame, spec: TfidfSpec, text: str, *keep: str) -> DataFrame:
    """``keep`` and ``g``, the n-grams of a text column."""
    return token_lists(docs, spec, text, *keep).select(*keep, ngrams(F.col("t"), spec.max_n).alias("g"))


def sorted_places(lists: DataFrame, values: str) -> DataFrame:
    """(x, p): the values of every list in order, each with the one before it; null lists give nothing.

    A value that differs from the one before is the first of its kind in the list, so one pass counts places and lists.
    """
    s = F.col("s")
    lists = lists.select(F.sort_array(values).alias("s"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))))
    return lists.select(F.inline(F.arrays_zip(s, before)).alias("x", "p")).where(F.col("x").isNotNull())


def term_totals(docs: DataFrame, spec: TfidfSpec = CLASSIFIER, *, text: str = "text") -> DataFrame:
    """(term, df, cf): documents that hold a term, and its places, over all documents.

    Places are exploded once and summed up within tasks, so only one row per term and task is shuffled and nothing
    is counted per document.
    """
    places = sorted_places(gram_lists(docs, spec, text), "g").withColumnRenamed("x", "term")
    new = F.sum(F.when(F.col("p").isNull() | (F.col("term") != F.col("p")), 1).otherwise(0))
    return places.groupBy("term").agg(new.alias("df"), F.count(F.lit(1)).alias("cf"))


def tfidf_vocabulary(docs: DataFrame, spec: TfidfSpec = CLASSIFIER, *, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(term, idx, df, cf, idf): at most ``max_features`` terms by corpus frequency.

    Document-frequency bounds apply before the cap; ties at the cap go to the smaller
    term.  idx numbers the kept terms alphabetically (a window over the capped list).
    """
    n_docs = docs.agg(F.count(F.lit(1)))
    if spec.max_n == 1:
        stats = term_totals(docs, spec, text=text)
    else:
        words = materialize(term_totals(docs, replace(spec, max_n=1), text=text), "words")
        floor = _floor(words.withColumn("n", n_docs.scalar()).where(_within(spec)), spec)
        stats = term_totals(docs, spec, text=text) if floor <= 1 else \
            words.unionByName(_frequent_phrases(docs, spec, text, words.where(F.col("cf") >= floor).select("term"), floor))
    kept = stats.withColumn("n", n_docs.scalar()).where(_within(spec)).orderBy(F.desc("cf"), "term").limit(spec.max_features)
    return kept.select(
        "term", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1).alias("idx"), "df", "cf",
        (F.log((F.col("n") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))


def _within(spec: TfidfSpec) -> Column:
    return (F.col("df") >= spec.min_df) & (F.col("df") <= F.col("n") * spec.max_df)


def _floor(words: DataFrame, spec: TfidfSpec) -> int:
    """Places of the ``max_features``-th of the words that qualify, 0 if there are fewer: no term with less is kept."""
    top = words.orderBy(F.desc("cf")).limit(spec.max_features).agg(F.count(F.lit(1)).alias("n"), F.min("cf").alias("least")).first()
    return top.least if top.n and top.n >= spec.max_features else 0


def _frequent_phrases(docs: DataFrame, spec: TfidfSpec, text: str, words: DataFrame, floor: int) -> DataFrame:
    """(term, df, cf) of the n-grams of two and more tokens with at least ``floor`` places.

    An n-gram stands nowhere without each of its words, so one with a rarer word than ``words`` cannot have that many
    places; the others are counted in full.
    """
    words = materialize(words, "frequent-words")
    lists, found = token_lists(docs, spec, text), None
    for n in range(2, spec.max_n + 1):
        size, names = F.greatest(F.size("t") - (n - 1), F.lit(0)), [f"w{k}" for k in range(n)]
        rows = lists.select(F.inline(F.arrays_zip(*[F.slice("t", k + 1, size) for k in range(n)])).alias(*names))
        for name in names:
            rows = rows.join(words.select(F.col("term").alias(name)), name, "left_semi")
        some = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("cf")).where(F.col("cf") >= floor).select(F.concat_ws(" ", *names).alias("term"), "cf")
        found = some if found is None else found.unionByName(some)
    found = materialize(found, "frequent-phrases")
    phrases = lists.select(F.slice(ngrams(F.col("t"), spec.max_n), F.size("t") + 1, F.size("t") * spec.max_n + 1).alias("g"))  # n-grams start with the words
    held = phrases.select(F.explode(F.array_distinct("g")).alias("term")).join(found.select("term"), "term", "left_semi")
    return held.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(found, "term").select("term", "df", "cf")


def term_vectors(docs: DataFrame, vocab: DataFrame, spec: TfidfSpec, key: str, text: str) -> DataFrame:
    """(key, hits array<struct<idx, tf>>) of the documents that hold known terms, in idx order; a written table.

    Every document is counted in its own row against the capped vocabulary, which the driver hands to the tasks, and
    nothing is shuffled.  Vectors are read back in the form in which they are stored.
    """
    terms = [r.term for r in vocab.orderBy("idx").select("term").collect()]  # at most ``max_features``
    kind = docs.schema[key].dataType
    if not terms:
        return docs.sparkSession.createDataFrame([], T.StructType([T.StructField(key, kind), *TERM_HITS]))
    model = CountVectorizerModel.from_vocabulary(terms, inputCol="g", outputCol="v", minTF=1.0)
    path = shared_folder(docs.sparkSession, "terms")
    lists = gram_lists(docs, spec, text, key).select(key, F.coalesce("g", F.array().cast("array<string>")).alias("g"))
    model.transform(lists).select(key, "v").write.parquet(path)
    schema = T.StructType([T.StructField(key, kind), T.StructField("v", T.StructType([
        T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))]))])
    rows = docs.sparkSession.read.schema(schema).parquet(path).where(F.size("v.indices") > 0)
    return rows.select(key, F.arrays_zip(F.col("v.indices").alias("idx"), F.col("v.values").alias("tf")).cast(TERM_HITS[0].dataType).alias("hits"))


TERM_HITS = T.StructType([T.StructField("hits", T.ArrayType(T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("tf", T.DoubleType())])))])


def _term_weights(docs: DataFrame, vocab: DataFrame, spec: TfidfSpec, key: str, text: str) -> DataFrame:
    """Per document the L2-normalised weights as array<struct<idx, w>> in idx order.

    The vocabulary is capped by ``max_features``, which bounds both the list handed to the rows and
    the array of a document.  One row a document is shuffled, which puts rows of one key together.
    """
    idfs = vocab.agg(F.array_sort(F.collect_list(F.struct("idx", "idf"))).alias("m")).select(F.transform("m", lambda x: x["idf"])).scalar()
    raw = term_vectors(docs, vocab, spec, key, text).withColumn("__idf", idfs).select(key, F.transform("hits", lambda x: F.struct(
        x["idx"].alias("idx"), (((1.0 + F.log(x["tf"])) if spec.sublinear else x["tf"]) * F.get("__idf", x["idx"])).alias("w"))).alias("r"))
    # the norm is an aggregate: inside the lambda it would be recomputed per term
    rows = raw.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("r"))).alias("r"),
                                F.sqrt(F.sum(F.aggregate("r", F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))).alias("norm"))
    return rows.select(key, F.transform("r", lambda x: F.struct(x["idx"].alias("idx"), (x["w"] / F.col("norm")).alias("w"))).alias("ws"))


def tfidf_weights(docs: DataFrame, vocab: DataFrame, spec: TfidfSpec = CLASSIFIER, *, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(key, term, weight) long table; ``vocab`` numbers its terms from 0."""
    vocab = materialize(vocab, "vocabulary")  # read by several steps
    return _term_weights(docs, vocab, spec, key, text).select(key, F.inline("ws")) \
        .join(F.broadcast(vocab.select("idx", "term")), "idx").select(key, "term", F.col("w").alias("weight"))


def vector_table(docs: DataFrame, vocab: DataFrame, size: int, spec: TfidfSpec = CLASSIFIER, *, key: str = "doc_id",
                 text: str = "text", keep: Sequence[str] = (), packed: bool = False) -> DataFrame:
    """A written table of ``keep`` and sparse ``features``, to be read by many iterations of a fit.

    The features are written in the form in which vectors are stored and read back as vectors, so nothing
    leaves the JVM; with ``packed`` as the arrays ``indices`` and ``values``.  Documents without known terms get zeros.
    """
    ws = _term_weights(docs, vocab, spec, key, text)
    features = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
                        F.coalesce(F.transform("ws", lambda x: x["idx"]), F.array().cast("array<int>")).alias("indices"),
                        F.coalesce(F.transform("ws", lambda x: x["w"]), F.array().cast("array<double>")).alias("values"))
    rows = docs.select(*{key: 0, **dict.fromkeys(keep)}).join(ws, key, "left").select(*keep, features.alias("features"))
    if packed:
        return materialize(rows.select(*keep, "features.indices", "features.values"), "features")
    path = shared_folder(docs.sparkSession, "features")
    rows.write.parquet(path)
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("features", VectorUDT())])
    return docs.sparkSession.read.schema(schema).parquet(path)


def term_scores(docs: DataFrame, terms: DataFrame, labels: Sequence[str], spec: TfidfSpec = CLASSIFIER, *, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(key, z): per label the dot product of a document's unit TF-IDF vector with the label's coefficients.

    ``terms`` holds (term, idf, coefs array) of a capped vocabulary, at most ``max_features`` rows.  Documents without
    known terms have no row.
    """
    numbered = materialize(terms.select("term", "idf", "coefs", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1).alias("idx")), "terms")
    tf = F.col("tf")
    raw = ((1.0 + F.log(tf)) if spec.sublinear else tf) * F.col("idf")
    hits = term_vectors(docs, numbered, spec, key, text).select(key, F.inline("hits")).join(F.broadcast(numbered.drop("term")), "idx").withColumn("w", raw)
    sums = hits.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
                                 *[F.sum(F.col("w") * F.col("coefs")[k]).alias(f"s{k}") for k in range(len(labels))])
    return sums.select(key, F.array(*[F.col(f"s{k}") / F.col("norm") for k in range(len(labels))]).alias("z"))


def cluster_terms(weights: DataFrame, clusters: DataFrame, *, key: str = "doc_id", cluster: str = "cluster_id",
                  top: int = 15) -> DataFrame:
    """Per cluster: size, pct and the terms of highest mean weight.

    The mean is over all members, so it is a sum over present terms divided by size.
    Sums per (cluster, term) combine map-side and leave at most one row per
    vocabulary term in a cluster.
    """
    sizes = clusters.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    total = clusters.agg(F.count(F.lit(1)))
    # rows of a weight table already lie by key; the other side is hashed, so that no long row is sorted
    sums = weights.join(clusters.select(key, cluster).hint("shuffle_hash"), key).groupBy(cluster, "term").agg(F.sum("weight").alias("w"))
    # compare rounded sums so that the order does not depend on summation order
    w = Window.partitionBy(cluster).orderBy(F.desc(F.round("w", 9)), "term")
    ranked = sums.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top)
    lists = ranked.groupBy(F.col(cluster).alias("__c")).agg(
        F.array_sort(F.collect_list(F.struct("rn", "term"))).alias("ts"))
    return sizes.join(lists, F.col(cluster) == F.col("__c"), "left").select(
        F.col(cluster).alias("cluster_id"), "size",
        F.bround(F.col("size") / total.scalar() * 100.0, 1).alias("pct"),
        F.coalesce(F.array_join(F.transform("ts", lambda x: x["term"]), ", "), F.lit("")).alias("top_terms"))
