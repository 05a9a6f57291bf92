"""Checks on human annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import strip
from threadlens.plans.skew import HOT_ROWS, skew_lookup

# Accepted spellings of the escalation answer.
ESCALATION_ALIASES = {"YES": "YES", "NO": "NO", "Y": "YES", "N": "NO", "AUTO_HANDLE": "AUTO_HANDLE",
                      "ESCALATE": "ESCALATE", "HANDLE": "AUTO_HANDLE", "REVIEW": "ESCALATE"}
ESCALATION_VALUES = ["YES", "NO", "AUTO_HANDLE", "ESCALATE"]
REQUIRED = ["id", "text", "conversation_id"]


def canonical_escalation(col: Column) -> Column:
    """Upper-case and resolve aliases; unknown answers pass through, null becomes ''."""
    value = F.upper(strip(F.coalesce(col.cast("string"), F.lit(""))))
    aliases = F.create_map(*[F.lit(x) for kv in ESCALATION_ALIASES.items() for x in kv])
    return F.coalesce(F.try_element_at(aliases, value), value)


def intent_dimension(schemas: DataFrame, json_col: str = "schema_json") -> DataFrame:
    """Distinct intents named by schema objects; keys starting with '_' are metadata."""
    parsed = F.from_json(json_col, "map<string,string>")
    return schemas.select(F.explode(F.map_keys(parsed)).alias("intent")) \
        .where(~F.col("intent").startswith("_")).distinct()


def validate_annotations(rows: DataFrame, intents: DataFrame, *, row_no: str = "row_no",
                         require_complete: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Normalise every row and add ``error`` (null when valid) plus ``message``.

    Duplicates are judged among otherwise valid rows: only later occurrences err, and
    a row that repeats an id does not claim its tweet_id.
    """
    have = rows.columns
    esc = next((c for c in ("gold_escalation", "should_escalate", "gold_escalation_label") if c in have), None)
    intent = next((c for c in ("gold_intent", "intent") if c in have), None)
    out = rows
    for c in REQUIRED:
        if c not in have:
            out = out.withColumn(c, F.lit(None).cast("string"))
    if "tweet_id" not in have:
        out = out.withColumn("tweet_id", F.lit(""))
    out = out.withColumn("gold_intent", strip(F.coalesce(F.col(intent).cast("string"), F.lit(""))) if intent else F.lit("")) \
        .withColumn("gold_escalation", canonical_escalation(F.col(esc)) if esc else F.lit("")) \
        .withColumn("tweet_id", strip(F.coalesce(F.col("tweet_id").cast("string"), F.lit("")))) \
        .withColumn("id", F.col("id").cast("string"))
    missing = F.filter(F.array(*[F.when(F.coalesce(strip(F.col(c).cast("string")), F.lit("")) == "", c)
                                 for c in REQUIRED]), lambda x: x.isNotNull())
    # the intent dimension is a list of class labels: one scalar array
    known = intents.agg(F.collect_set("intent"))
    out = out.withColumn("__known", known.scalar())
    first_error = (
        F.when(F.size(missing) > 0, F.concat(
            F.lit("Annotation record is missing required fields: "), F.array_join(missing, ", "), F.lit(".")))
        .when((F.col("gold_intent") != "") & ~F.array_contains("__known", F.col("gold_intent")), F.concat(
            F.lit("gold_intent '"), F.col("gold_intent"), F.lit("' is not valid for this schema.")))
        .when((F.col("gold_escalation") != "") & ~F.col("gold_escalation").isin(*ESCALATION_VALUES), F.concat(
            F.lit("Escalation '"), F.col("gold_escalation"), F.lit("' must be YES, NO, AUTO_HANDLE, or ESCALATE."))))
    out = out.withColumn("error", first_error).drop("__known")

    # Per id: its first valid row, which owns the id, and that row's tweet_id.  Both
    # aggregates combine map-side, so a much repeated id costs one row per task.
    owners = out.where(F.col("error").isNull()).groupBy(F.col("id").alias("__id")).agg(
        F.min(row_no).alias("__first"), F.count(F.lit(1)).alias("__n"),
        F.min_by(F.when(F.col("tweet_id") != "", F.col("tweet_id")), row_no).alias("__tid"))
    claims = owners.where(F.col("__tid").isNotNull()).groupBy(F.col("__tid").alias("__k")).agg(F.min("__first").alias("__claimed"))
    # one row an id on the left; Spark splits the partition of a much claimed tweet_id by itself
    judged = owners.join(claims, F.col("__tid") == F.col("__k"), "left").drop("__k")
    # only ids with something wrong are looked up from the rows
    late = F.coalesce(F.col("__first") > F.col("__claimed"), F.lit(False))
    suspects = judged.where((F.col("__n") > 1) | late).select(F.col("__id").alias("__k"), "__first", late.alias("__late"))
    out = skew_lookup(out, suspects, "id", "__k", spread=row_no, hot_rows=hot_rows)
    duplicate = (
        F.when(F.col(row_no) > F.col("__first"), F.concat(F.lit("duplicate id '"), F.col("id"), F.lit("'")))
        .when((F.col(row_no) == F.col("__first")) & F.col("__late"),
              F.concat(F.lit("duplicate tweet_id '"), F.col("tweet_id"), F.lit("'"))))
    out = out.withColumn("error", F.coalesce("error", duplicate)).drop("__first", "__late")
    if require_complete:
        out = out.withColumn("error", F.coalesce("error", F.when(
            (F.col("gold_intent") == "") | (F.col("gold_escalation") == ""),
            F.lit("gold_intent and escalation label are required."))))
    return out.withColumn("message", F.when(
        F.col("error").isNotNull(), F.concat(F.lit("row "), F.col(row_no).cast("string"), F.lit(": "), F.col("error"))))


def annotation_summary(checked: DataFrame) -> DataFrame:
    """rows / labelled / unlabelled / errors of a checked table."""
    done = F.col("error").isNull() & (F.col("gold_intent") != "") & (F.col("gold_escalation") != "")
    return checked.agg(F.count(F.lit(1)).alias("rows"), F.count_if(done).alias("labelled"),
                       F.count_if(F.col("error").isNotNull()).alias("errors")) \
        .select("rows", "labelled", (F.col("rows") - F.col("labelled")).alias("unlabelled"), "errors")
