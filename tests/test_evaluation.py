import json
import random

import pytest
from pyspark.sql import functions as F

from threadlens.functions.judge import parse_judge_outputs
from threadlens.functions.prompts import JUDGE_DIMENSIONS
from threadlens.operators import annotation, decision, golden, judging, metrics

LABELS = ["account_access", "app_issue", "billing_payment", "connectivity", "device_hardware", "icloud_sync", "other",
          "software_update", "warranty_repair"]
# A published 9 x 9 confusion matrix (rows true, columns predicted) and its scores.
PUBLISHED = [
    [22, 0, 0, 0, 0, 0, 5, 0, 0], [0, 15, 0, 0, 0, 0, 21, 0, 0], [0, 0, 0, 0, 0, 0, 4, 0, 0],
    [0, 0, 0, 0, 0, 0, 3, 0, 0], [0, 0, 0, 0, 17, 0, 6, 1, 0], [0, 0, 0, 0, 0, 24, 2, 0, 0],
    [3, 24, 0, 0, 0, 0, 2541, 38, 1], [0, 2, 0, 0, 0, 2, 16, 56, 0], [0, 0, 0, 0, 0, 0, 0, 0, 4]]


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame([(t, p, n) for t, row in zip(LABELS, PUBLISHED) for p, n in zip(LABELS, row) if n],
                                 "y_true string, y_pred string, n long")


def test_published_scores(spark, published):
    m = metrics.classifier_metrics(published).first()
    assert (m.n_samples, m.accuracy, m.macro_f1, m.weighted_f1) == (2807, 0.9544, 0.612, 0.9546)
    full = metrics.confusion_matrix(published).collect()
    assert len(full) == 81 and sum(r.n for r in full) == 2807


def test_bootstrap_brackets_the_point(spark, published):
    ci = metrics.bootstrap_ci(published).first()
    assert ci == metrics.bootstrap_ci(published).first()
    assert abs(ci.accuracy_low - 0.9466) < .004 and abs(ci.accuracy_high - 0.9622) < .004
    assert ci.macro_f1_low < 0.612 < ci.macro_f1_high and abs(ci.macro_f1_low - 0.541) < .03


def gates(spark, rows, **kw):
    df = spark.createDataFrame(rows, "intent string, confidence double, evidence_score double, n_evidence int")
    return [(r.decision, r.gate_triggered) for r in decision.escalation_gates(df, **kw).collect()]


def test_gates(spark):
    assert gates(spark, [
        ("app_issue", .85, .70, 3), ("connectivity", .75, .60, 2), ("app_issue", .40, .80, 3), ("app_issue", .90, .0, 0),
        ("app_issue", .90, .10, 3), ("software_update", .62, .32, 2), ("billing_payment", .99, .99, 5),
        ("account_access", .99, .99, 5), ("app_issue", .65, .35, 2)]) == [
        ("AUTO_HANDLE", "none"), ("AUTO_HANDLE", "none"), ("ESCALATE", "low_confidence"), ("ESCALATE", "no_evidence"),
        ("ESCALATE", "weak_evidence"), ("ESCALATE", "composite_risk"), ("ESCALATE", "high_risk_intent"),
        ("ESCALATE", "high_risk_intent"), ("AUTO_HANDLE", "none")]


def test_threshold_grid_matches_brute_force(spark):
    rng = random.Random(3)
    names = ["app_issue", "other", "billing_payment", "connectivity"]
    rows = [(rng.choice(names), rng.choice(names), rng.randrange(101) / 100, rng.randrange(101) / 100) for _ in range(400)]
    df = spark.createDataFrame(rows, "y_true string, y_pred string, confidence double, evidence_score double")
    got = {(r[0], r[1]): (r.n_auto, round(r.macro_f1, 9)) for r in decision.threshold_grid(df).collect()}
    for c in decision.CONFIDENCE_GRID:
        for s in decision.SIMILARITY_GRID:
            auto = [(t, p) for t, p, cf, ev in rows if p != "billing_payment" and cf >= c and ev >= s
                    and round(.5 * (1 - cf) + .5 * (1 - ev), 4) <= .5]
            if len(auto) < 10:
                assert (c, s) not in got
                continue
            f1 = []
            for lab in {x for a in auto for x in a}:
                tp = sum(a == (lab, lab) for a in auto)
                f1.append(2 * tp / sum((a[0] == lab) + (a[1] == lab) for a in auto))
            assert got[(c, s)] == (len(auto), round(sum(f1) / len(f1), 9))


def test_no_threshold_qualifies(spark):
    df = spark.createDataFrame([("a", "a", .9, .9)], "y_true string, y_pred string, confidence double, evidence_score double")
    best = decision.best_thresholds(decision.threshold_grid(df)).first()
    assert (best.classifier_threshold, best.retrieval_threshold, best.val_f1, best.auto_handle_rate) == (.6, .3, 0.0, None)


def judged(spark, *raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw_output string")
    return parse_judge_outputs(df).orderBy("i").collect()


def test_judge_parsing(spark):
    full = {d: {"score": 4, "reason": "ok"} for d in JUDGE_DIMENSIONS}
    rows = judged(spark, "```json\n" + json.dumps(full) + "\n```", "so: " + json.dumps({"tone": {"score": "5"}}) + " bye",
                  None, "{broken", json.dumps({"tone": 5}), json.dumps({"tone": {"score": None}}), json.dumps({"tone": {"score": "4.7"}}),
                  json.dumps({"tone": {"score": 4.7, "reason": None}}), json.dumps({"tone": {}}), json.dumps({"tone": {"score": [1]}}))
    assert rows[0].judge_mean == 4.0 and rows[0].judge_tone_reason == "ok"
    assert (rows[1].judge_tone, rows[1].judge_relevance, rows[1].judge_relevance_reason) == (5, 3, "not scored")
    assert rows[1].judge_mean == 3.29
    for i in (2, 3, 4, 5, 6, 9):
        assert (rows[i].judge_mean, rows[i].judge_tone_reason) == (3.0, "judge unavailable")
    assert (rows[7].judge_tone, rows[7].judge_tone_reason) == (4, "None")
    assert (rows[8].judge_tone, rows[8].judge_tone_reason) == (3, "")


def test_agreement(spark):
    rows = [(i, "tone", 1 + i % 5, 1 + i % 5) for i in range(20)] + [(i, "relevance", 5, 5) for i in range(20)] + [(0, "grounding", 1, None)]
    df = spark.createDataFrame(rows, "id int, dimension string, human int, judge int")
    got = {r.dimension: r for r in judging.rater_agreement(df).collect()}
    assert got["tone"].kappa == 1.0 and got["tone"].pearson_r == 1.0 and got["tone"].exact_agreement == 1.0
    assert got["relevance"].kappa is None and got["relevance"].pearson_r is None and got["relevance"].mae == 0.0
    assert "grounding" not in got and got["overall"].n == 40 and got["tone"].warning


def notes(spark, rows):
    intents = spark.createDataFrame([(i,) for i in LABELS], "intent string")
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows, 1)],
                               "row_no long, id string, tweet_id string, text string, conversation_id string, gold_intent string, should_escalate string")
    return annotation.validate_annotations(df, intents, hot_rows=2)


def test_annotation_counts_and_errors(spark):
    ok = notes(spark, [("1", "t1", "hello", "c1", "other", "NO"), ("2", "t2", "world", "c2", "", "")])
    s = annotation.annotation_summary(ok).first()
    assert (s.rows, s.labelled, s.unlabelled, s.errors) == (2, 1, 1, 0)
    bad = notes(spark, [("1", "t", "a", "c", "not_real", "NO"), ("1", "t", "a", "c", "", "MAYBE"), ("1", "t", "a", "c", "", "y"),
                        ("1", "u", "a", "c", "", ""), ("2", "t", "a", "c", "", ""), ("3", "u", "a", "c", "", ""), (None, "v", "", "c", "", "")])
    got = [r.message for r in bad.orderBy("row_no").collect()]
    assert got == [
        "row 1: gold_intent 'not_real' is not valid for this schema.",
        "row 2: Escalation 'MAYBE' must be YES, NO, AUTO_HANDLE, or ESCALATE.",
        None, "row 4: duplicate id '1'", "row 5: duplicate tweet_id 't'", None,
        "row 7: Annotation record is missing required fields: id, text."]


def test_quartiles_and_golden(spark):
    rows = [(str(i), "x" * (10 + i % 40), "other", str(i)) for i in range(300)] + [(f"r{i}", "abc", "rare", "c") for i in range(3)]
    df = spark.createDataFrame(rows, "tweet_id string, clean_text string, intent string, conversation_id string")
    q = {r[0]: r[1] for r in golden.length_quartiles(df).groupBy("len_quartile").count().collect()}
    assert set(q) == {0, 1, 2, 3}
    g = golden.golden_sample(df).collect()
    assert sum(r.auto_intent == "rare" for r in g) == 3 and sum(r.auto_intent == "other" for r in g) == 100
    assert sorted(r.id for r in g) == list(range(1, 104)) and sum(r.double_label == "YES" for r in g) == 50
    assert golden.golden_sample(df, target=20).count() == 20
    assert golden.golden_sample(df, per_intent=25).where("auto_intent = 'other'").count() == 24
    assert golden.double_label_subset(golden.golden_sample(df), 7).count() == 7


def test_confusion_and_examples(spark):
    df = spark.createDataFrame([(i, f"text {i}", "a", "b" if i % 2 else "a") for i in range(10)], "id int, text string, y_true string, y_pred string")
    assert [(r.example, r.text) for r in metrics.error_examples(df, "id").orderBy("example").collect()] == [(1, "text 1"), (2, "text 3")]
    assert metrics.error_list(df, "id", n=3).count() == 3
    e = metrics.error_pairs(metrics.confusion_cells(df)).first()
    assert (e.errors, e.total_errors, e.error_rate) == (5, 5, 0.5)
    assert df.select(decision.normalize_truth(F.lit(" yes "))).first()[0] == "ESCALATE"


def test_missing_inputs_escalate(spark):
    from threadlens.operators.decision import escalation_gates
    rows = spark.createDataFrame([("a", None, 0.9, 3), ("b", 0.9, None, 3), ("c", 0.9, 0.9, None), ("d", float("nan"), 0.9, 3), ("e", 0.95, 0.9, 3)],
                                 "intent string, confidence double, evidence_score double, n_evidence int")
    got = {r.intent: (r.decision, r.gate_triggered) for r in escalation_gates(rows).collect()}
    assert got == {"a": ("ESCALATE", "low_confidence"), "b": ("ESCALATE", "weak_evidence"), "c": ("ESCALATE", "no_evidence"),
                   "d": ("ESCALATE", "low_confidence"), "e": ("AUTO_HANDLE", "none")}
