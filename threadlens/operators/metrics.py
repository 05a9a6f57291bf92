"""Classification metrics.  Everything derives from one (true, predicted) count table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.functions.numeric import half_even, ratio
from threadlens.functions.text import is_blank
from threadlens.schema import AUTO, BOOTSTRAP_ITERATIONS, ESCALATE, SEED


def confusion_cells(preds: DataFrame, true: str = "y_true", pred: str = "y_pred",
                    by: Sequence[str] = ()) -> DataFrame:
    """(by.., y_true, y_pred, n): the only pass over the predictions."""
    return preds.groupBy(*by, F.col(true).alias("y_true"), F.col(pred).alias("y_pred")) \
        .agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(cells: DataFrame) -> DataFrame:
    """All label x label cells over the union of labels, zeros included.

    The label list is as long as one side of the result; it is unfolded twice from a
    single row, so no join of labels with labels is needed.
    """
    labels = cells.select(F.explode(F.array("y_true", "y_pred")).alias("l")) \
        .agg(F.array_sort(F.collect_set("l")).alias("ls"))
    grid = labels.select(F.explode("ls").alias("y_true"), "ls").select("y_true", F.explode("ls").alias("y_pred"))
    return grid.join(cells, ["y_true", "y_pred"], "left") \
        .select("y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))


def label_scores(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unrounded precision/recall/f1 with support and predicted counts per label."""
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    )
    return (cells.select(*by, F.explode(sides).alias("s")).select(*by, "s.*").groupBy(*by, "label")
            .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
            .withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
            .withColumn("recall", ratio(F.col("tp"), F.col("support")))
            .withColumn("f1", ratio(2 * F.col("tp"), F.col("support") + F.col("predicted"))))


def classification_report(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return label_scores(cells, by).select(
        *by, "label", *[half_even(F.col(c), 4).alias(c) for c in ("precision", "recall", "f1")], "support")


def classifier_metrics(cells: DataFrame, by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """n, accuracy and averaged scores, per ``by`` group."""
    n = F.sum("support")
    measures = {
        "accuracy": F.sum("tp") / n,
        "macro_f1": F.avg("f1"),
        "weighted_f1": F.sum(F.col("f1") * F.col("support")) / n,
        "macro_precision": F.avg("precision"),
        "macro_recall": F.avg("recall"),
    }
    return label_scores(cells, by).groupBy(*by).agg(
        n.alias("n_samples"), *[half_even(m, digits).alias(k) for k, m in measures.items()])


def model_comparison(preds: DataFrame, model: str = "model") -> DataFrame:
    """One row per model: accuracy, macro/weighted F1, macro precision and recall."""
    return classifier_metrics(confusion_cells(preds, by=[model]), [model]) \
        .select(model, "accuracy", "macro_f1", "weighted_f1", "macro_precision", "macro_recall")


def poisson_draw(n: Column, digest: Column) -> Column:
    """A Poisson(n) number that follows from a hexadecimal md5 digest.

    Two uniform numbers of 32 bits give a normal one (Box-Muller), and the Cornish-Fisher expansion turns that into the Poisson
    quantile.  Its mean and variance are within 1 % of n from n = 5 on, and within 4 % for smaller n.
    """
    u, v = ((F.conv(F.substring(digest, k, 8), 16, 10).cast("double") + 0.5) / float(1 << 32) for k in (1, 9))
    z = F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * math.pi * v)
    x = n + F.sqrt(n) * z + (z * z - 1.0) / 6.0 + (z - z * z * z) / (72.0 * F.sqrt(n))
    return F.greatest(F.lit(0).cast("long"), F.floor(x + 0.5).cast("long"))


def bootstrap_scores(cells: DataFrame, n_iter: int = BOOTSTRAP_ITERATIONS, seed: int = SEED) -> DataFrame:
    """(it, accuracy, macro_f1) of ``n_iter`` resamples of the rows behind the cells.

    Poisson bootstrap: a row is drawn Poisson(1) times, so a cell of n rows Poisson(n) times, independently of other
    cells.  The draw follows from md5(seed, iteration, cell), so every engine and every re-run repeats it, and an
    iteration costs one row a cell, not one a message.  The label set is that of all cells.
    """
    name = F.concat_ws("|", F.coalesce("y_true", F.lit("")), F.coalesce("y_pred", F.lit("")))
    runs = cells.withColumn("it", F.explode(F.sequence(F.lit(0), F.lit(n_iter - 1))))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("it").cast("string"), name).cast("binary"))
    drawn = runs.withColumn("n", poisson_draw(F.col("n").cast("double"), digest))
    total = drawn.groupBy("it").agg((F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)) / F.nullif(F.sum("n"), F.lit(0))).alias("accuracy"))
    f1 = label_scores(drawn, ["it"]).groupBy("it").agg(F.avg("f1").alias("macro_f1"))
    return total.join(f1, "it")


def bootstrap_ci(cells: DataFrame, n_iter: int = BOOTSTRAP_ITERATIONS, seed: int = SEED) -> DataFrame:
    """2.5/97.5 percentiles of accuracy and macro F1 over row resamples; the driver sees one row."""
    ends = F.array(F.lit(0.025), F.lit(0.975))
    return bootstrap_scores(cells, n_iter, seed).agg(
        F.percentile("accuracy", ends).alias("a"), F.percentile("macro_f1", ends).alias("f")).select(
        *[half_even(F.col(c)[i], 4).alias(f"{name}_{end}")
          for c, name in (("a", "accuracy"), ("f", "macro_f1")) for i, end in ((0, "low"), (1, "high"))])


def escalation_metrics(df: DataFrame, true: str = "truth", pred: str = "decision") -> DataFrame:
    """Precision, recall and F1 with ESCALATE as the positive class."""
    t, p = F.col(true), F.col(pred)
    counts = df.agg(
        F.count_if((t == ESCALATE) & (p == ESCALATE)).alias("tp"),
        F.count_if((t == AUTO) & (p == ESCALATE)).alias("fp"),
        F.count_if((t == ESCALATE) & (p == AUTO)).alias("fn"),
        F.count_if(t == ESCALATE).alias("n_true_escalate"),
        F.count_if(p == ESCALATE).alias("n_pred_escalate"),
    ).withColumn("pr", ratio(F.col("tp"), F.col("tp") + F.col("fp"))) \
        .withColumn("rc", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return counts.select(
        half_even(F.col("pr"), 4).alias("escalation_precision"),
        half_even(F.col("rc"), 4).alias("escalation_recall"),
        half_even(ratio(2 * F.col("pr") * F.col("rc"), F.col("pr") + F.col("rc")), 4).alias("escalation_f1"),
        "n_true_escalate", "n_pred_escalate")


def auto_vs_gold(golden: DataFrame, gold: str = "gold_intent", auto: str = "auto_intent") -> DataFrame:
    """Agreement of rule labels with the non-blank gold labels."""
    labelled = golden.where(~is_blank(F.col(gold)))
    return classifier_metrics(confusion_cells(labelled, gold, auto), digits=3) \
        .select(F.coalesce("n_samples", F.lit(0)).alias("n_labelled"), "accuracy", "macro_f1")


def error_pairs(cells: DataFrame, top: int = 5) -> DataFrame:
    """The most frequent (true, predicted) mistakes with the overall error total and rate."""
    wrong = F.col("y_true") != F.col("y_pred")
    totals = cells.agg(F.struct(F.sum(F.when(wrong, F.col("n")).otherwise(0)).alias("errors"),
                                F.sum("n").alias("rows")).alias("s"))
    return (cells.where(wrong).orderBy(F.desc("n"), "y_true", "y_pred").limit(top)
            .withColumn("t", totals.scalar())
            .select("y_true", "y_pred", F.col("n").alias("errors"), F.col("t.errors").alias("total_errors"),
                    half_even(F.col("t.errors") / F.col("t.rows"), 4).alias("error_rate")))


def error_examples(preds: DataFrame, order: str, text: str = "text", per_pair: int = 2, top: int = 5,
                   chars: int = 80) -> DataFrame:
    """Up to ``per_pair`` example texts for each of the top error pairs."""
    wrong = preds.where("y_true <> y_pred")
    pairs = error_pairs(confusion_cells(preds), top).select("y_true", "y_pred", "errors")
    w = Window.partitionBy("y_true", "y_pred").orderBy(order)
    # `top` rows are broadcast; the rank filter then trims every pair before the shuffle
    return (wrong.join(F.broadcast(pairs), ["y_true", "y_pred"])
            .withColumn("example", F.row_number().over(w)).where(F.col("example") <= per_pair)
            .select("y_true", "y_pred", "errors", "example", F.substring(text, 1, chars).alias("text")))


def error_list(preds: DataFrame, order: str, text: str = "text", n: int = 100) -> DataFrame:
    """The first ``n`` mistakes in order."""
    return preds.where("y_true <> y_pred").orderBy(order).limit(n).select(order, text, "y_true", "y_pred")
