"""Judge batches, their summary and agreement with human raters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.judge import parse_judge_outputs
from threadlens.functions.numeric import half_even
from threadlens.functions.prompts import JUDGE_DIMENSIONS, judge_prompt
from threadlens.schema import DEFAULT_BRAND, EVIDENCE_TYPE, JUDGE_SAMPLE


def evidence_from_json(col: Column) -> Column:
    """Evidence JSON text -> array of structs; text that does not parse gives []."""
    return F.coalesce(F.from_json(col, EVIDENCE_TYPE), F.array().cast(EVIDENCE_TYPE))


def judge_batch(rows: DataFrame, order: str, *, max_samples: int = JUDGE_SAMPLE,
                brand: str = DEFAULT_BRAND) -> DataFrame:
    """Prompts for the first ``max_samples`` rows (id, judge_prompt, and raw_output if present)."""
    have = rows.columns
    evidence = F.col("evidence")
    if dict(rows.dtypes)["evidence"] == "string":
        evidence = evidence_from_json(evidence)

    def opt(c, default):
        return F.col(c) if c in have else F.lit(default)

    prompt = judge_prompt(F.col("text"), opt("generated_reply", ""), evidence, opt("intent", "unknown"),
                          opt("decision", ""), brand)
    rid = F.col("id") if "id" in have else F.col(order)
    keep = ["raw_output"] if "raw_output" in have else []
    return rows.orderBy(order).limit(max_samples).select(rid.alias("id"), prompt.alias("judge_prompt"), *keep)


def batch_judge(rows: DataFrame, order: str, *, max_samples: int = JUDGE_SAMPLE,
                brand: str = DEFAULT_BRAND) -> DataFrame:
    """Scores of the first rows from their ``raw_output``; no output means neutral scores."""
    batch = judge_batch(rows, order, max_samples=max_samples, brand=brand)
    if "raw_output" not in batch.columns:
        batch = batch.withColumn("raw_output", F.lit(None).cast("string"))
    return parse_judge_outputs(batch).drop("judge_prompt", "raw_output")


def judge_summary(scores: DataFrame, dimensions: Sequence[str] = JUDGE_DIMENSIONS) -> DataFrame:
    """Mean per dimension and overall, one row."""
    dims = [d for d in dimensions if f"judge_{d}" in scores.columns]
    return scores.agg(F.count(F.lit(1)).alias("n"),
                      *[half_even(F.avg(f"judge_{d}"), 3).alias(d) for d in dims],
                      half_even(F.avg("judge_mean"), 3).alias("overall_mean"))


def rater_join(human: DataFrame, judge: DataFrame, id_col: str = "id",
               dimensions: Sequence[str] = JUDGE_DIMENSIONS) -> DataFrame:
    """Long (id, dimension, human, judge) rows for ids both sides scored."""
    dims = [d for d in dimensions if d in human.columns and f"judge_{d}" in judge.columns]
    both = human.select(id_col, *dims).join(judge.select(id_col, *[f"judge_{d}" for d in dims]), id_col)
    pair = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("int").alias("human"),
                              F.col(f"judge_{d}").cast("int").alias("judge")) for d in dims])
    return both.select(id_col, F.inline(pair))


def rater_agreement(long: DataFrame) -> DataFrame:
    """n, quadratic kappa, Pearson r, MAE, exact rate per dimension and 'overall'.

    Ratings collapse to (dimension, human, judge) counts first, so all later steps run
    on a table of at most labels**2 rows per dimension.  Kappa distances are positions
    in the sorted list of ratings seen, not the ratings themselves.
    """
    merged = long.groupBy("dimension").agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows"))
    seen = long.where(F.col("human").isNotNull() & F.col("judge").isNotNull())
    cells = seen.groupBy("dimension", "human", "judge").agg(F.count(F.lit(1)).alias("n"))
    sizes = cells.groupBy(F.col("dimension").alias("d")).agg(F.sum("n").alias("size")).where("size >= 2")
    cells = cells.join(sizes, F.col("dimension") == F.col("d"), "left_semi")
    both = cells.unionByName(cells.withColumn("dimension", F.lit("overall"))) \
        .groupBy("dimension", "human", "judge").agg(F.sum("n").alias("n"))
    ranks = both.select("dimension", F.explode(F.array("human", "judge")).alias("v")) \
        .groupBy(F.col("dimension").alias("rd")).agg(F.array_sort(F.collect_set("v")).alias("vals"))
    coded = both.join(ranks, F.col("dimension") == F.col("rd")) \
        .withColumn("i", F.array_position("vals", F.col("human")).cast("double")) \
        .withColumn("j", F.array_position("vals", F.col("judge")).cast("double"))
    n = F.col("n")
    h, g, i, j = (F.col(c).cast("double") for c in ("human", "judge", "i", "j"))
    s = coded.groupBy("dimension").agg(
        F.sum(n).alias("n"),
        *[F.sum(expr * n).alias(name) for name, expr in {
            "sh": h, "sg": g, "shh": h * h, "sgg": g * g, "shg": h * g,
            "si": i, "sj": j, "sii": i * i, "sjj": j * j, "sdd": (i - j) * (i - j),
            "ae": F.abs(h - g), "eq": F.when(h == g, 1.0).otherwise(0.0)}.items()])

    def mean(c):
        return F.col(c) / F.col("n")

    def var(sq, m):
        return mean(sq) - mean(m) * mean(m)

    expected = (mean("si") - mean("sj")) * (mean("si") - mean("sj")) + var("sii", "si") + var("sjj", "sj")
    vh = F.col("n") * F.col("shh") - F.col("sh") * F.col("sh")
    vg = F.col("n") * F.col("sgg") - F.col("sg") * F.col("sg")
    cov = F.col("n") * F.col("shg") - F.col("sh") * F.col("sg")
    return s.select(
        "dimension", "n",
        half_even(F.when(expected > 0, 1 - mean("sdd") / expected), 3).alias("kappa"),
        half_even(F.when((vh > 0) & (vg > 0), cov / F.sqrt(vh * vg)), 3).alias("pearson_r"),
        half_even(mean("ae"), 3).alias("mae"), half_even(mean("eq"), 3).alias("exact_agreement"),
        F.when(merged.scalar() < 30, F.lit("Results not statistically reliable (n<30)")).alias("warning"))
