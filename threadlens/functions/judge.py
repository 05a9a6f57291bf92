"""Judge output text -> scores, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.numeric import half_even
from threadlens.functions.prompts import JUDGE_DIMENSIONS

NEUTRAL = 3
UNAVAILABLE = "judge unavailable"
NOT_SCORED = "not scored"


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _score(v: Column) -> Column:
    """Integer score of a dimension object; null marks a value that cannot be read."""
    raw = F.try_variant_get(v, "$.score", "variant")
    kind = _kind(raw)
    text = F.try_variant_get(v, "$.score", "string")
    return (
        F.when(raw.isNull(), F.lit(NEUTRAL))
        .when(kind == "VOID", F.lit(None))
        .when(kind == "STRING", F.when(
            text.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"),
            F.regexp_replace(F.trim(text), "[_\\s]", "").try_cast("int")))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$.score", "boolean").cast("int"))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None))
        .otherwise(F.try_variant_get(v, "$.score", "double").try_cast("int"))
    )


def _reason(v: Column) -> Column:
    raw = F.try_variant_get(v, "$.reason", "variant")
    text = F.try_variant_get(v, "$.reason", "string")
    return (
        F.when(raw.isNull(), F.lit(""))
        .when(_kind(raw) == "VOID", F.lit("None"))
        .when(_kind(raw) == "BOOLEAN", F.initcap(text))
        .otherwise(F.coalesce(text, F.to_json(raw)))
    )


def parse_judge_outputs(df: DataFrame, raw_col: str = "raw_output",
                        dimensions: list[str] | None = None) -> DataFrame:
    """Add ``judge_<dim>``, ``judge_<dim>_reason`` and ``judge_mean``.

    A fence is stripped, the widest ``{...}`` span is parsed.  A missing dimension
    scores 3 ("not scored"); a missing score counts as 3; any value that cannot be
    read as an integer makes the whole row neutral ("judge unavailable").
    """
    dims = dimensions or JUDGE_DIMENSIONS
    text = F.regexp_replace(F.col(raw_col), r"```json\s*", "")
    text = F.regexp_replace(text, r"```\s*", "")
    out = df.withColumn("__v", F.try_parse_json(F.regexp_extract(text, r"(?s)\{.*\}", 0)))
    bad = F.col("__v").isNull()
    for d in dims:
        out = out.withColumn(f"__d_{d}", F.try_variant_get("__v", f"$.{d}", "variant"))
        sub = F.col(f"__d_{d}")
        out = out.withColumn(f"__s_{d}", F.when(sub.isNull(), F.lit(NEUTRAL))
                             .when(_kind(sub).startswith("OBJECT"), _score(sub)))
        bad = bad | F.col(f"__s_{d}").isNull()
    out = out.withColumn("__bad", bad)
    keep = [F.col(c) for c in df.columns]
    total = None
    for d in dims:
        sub = F.col(f"__d_{d}")
        score = F.when(F.col("__bad"), F.lit(NEUTRAL)).otherwise(F.col(f"__s_{d}"))
        reason = F.when(F.col("__bad"), F.lit(UNAVAILABLE)) \
            .when(sub.isNull(), F.lit(NOT_SCORED)).otherwise(_reason(sub))
        keep += [score.alias(f"judge_{d}"), reason.alias(f"judge_{d}_reason")]
        total = score if total is None else total + score
    return out.select(*keep, half_even(total / F.lit(float(len(dims))), 2).alias("judge_mean"))
