"""Prompt and reply text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.numeric import fixed2

# Prompt wording, rubric names and reply templates.
SYSTEM_RULES = """You are a customer support agent for {brand}.
Write a helpful, professional reply to the customer message below.

Rules:
1. Base your reply ONLY on the historical examples provided.
2. Never invent refund amounts, dates, policies, or promises not in the examples.
3. If examples lack enough information, say you will escalate to a specialist.
4. Keep the reply concise (2-4 sentences maximum).
5. Be empathetic and professional.
6. Do not mention that you are an AI or that you are using examples."""

JUDGE_DIMENSIONS = [
    "relevance", "grounding", "helpfulness", "tone",
    "no_hallucination", "escalation_correct", "conciseness",
]

REPLY_TEMPLATES = {
    "account_access": "We're sorry you're having trouble with your Apple ID. Please DM us and we'll help you regain access.",
    "billing_payment": "We understand your concern about the charge. Please DM us your Apple ID and we'll review this for you.",
    "device_hardware": "We're sorry to hear about your device issue. Please DM us your serial number and we'll look into repair options.",
    "software_update": "We're sorry you're having trouble with the update. Please DM us your device model and iOS version.",
    "app_issue": "We're sorry the app isn't working as expected. Please DM us with details and we'll assist you.",
    "icloud_sync": "We're sorry you're having iCloud issues. Please DM us and we'll help you get synced up.",
    "connectivity": "We're sorry you're having connectivity issues. Please DM us your device model and we'll troubleshoot together.",
    "warranty_repair": "We can help with your warranty or repair question. Please DM us your serial number to get started.",
    "other": "We're sorry to hear about your issue. Please DM us and we'll be happy to help.",
}
GENERIC_REPLY = REPLY_TEMPLATES["other"]


JUDGE_CHARS = 100   # of an example's texts in a judge prompt


def _blank(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def generation_prompt(brand: Column, message: Column, intent: Column,
                      confidence: Column, evidence: Column, max_examples: int = 5) -> Column:
    """Prompt for a drafting model; ``evidence`` is an array of structs or null."""
    head, tail = SYSTEM_RULES.split("{brand}")
    examples = F.transform(
        F.slice(evidence, 1, max_examples),
        lambda e, i: F.concat(
            F.lit("Example "), (i + 1).cast("string"), F.lit(":\n  Customer: "),
            _blank(e["customer_text"]), F.lit("\n  Support:  "), _blank(e["brand_text"])),
    )
    section = F.when(
        F.size(evidence) > 0,
        F.concat(F.lit("Historical support examples:\n"), F.array_join(examples, "\n\n")),
    ).otherwise(F.lit("No historical examples available."))
    return F.concat(
        F.lit(head), _blank(brand), F.lit(tail), F.lit("\n\nIntent: "), _blank(intent),
        F.lit(" (confidence: "), fixed2(confidence), F.lit(")\n\n"), section,
        F.lit('\n\nCustomer message: "'), _blank(message), F.lit('"\n\nSupport reply:'),
    )


def judge_prompt(message: Column, reply: Column, evidence: Column, intent: Column,
                 decision: Column, brand: str, max_examples: int = 3, max_chars: int = JUDGE_CHARS) -> Column:
    """Rubric prompt for a judge model."""
    examples = F.transform(
        F.slice(evidence, 1, max_examples),
        lambda e, i: F.concat(
            F.lit("  ["), (i + 1).cast("string"), F.lit("] Customer: "),
            F.substring(_blank(e["customer_text"]), 1, max_chars), F.lit(" | Support: "),
            F.substring(_blank(e["brand_text"]), 1, max_chars)),
    )
    shown = F.when(F.size(evidence) > 0, F.array_join(examples, "\n")) \
        .otherwise(F.lit("  None available."))
    rubric = "\n".join(
        f'  "{d}": {{"score": <1-5>, "reason": "<one sentence>"}}' for d in JUDGE_DIMENSIONS)
    return F.concat(
        F.lit(f"You are evaluating an {brand} reply. "
              'Score each criterion 1 (poor) to 5 (excellent).\n\nCustomer message: "'),
        _blank(message), F.lit('"\nDetected intent: '), _blank(intent),
        F.lit("\nDecision: "), _blank(decision),
        F.lit("\nHistorical examples used:\n"), shown,
        F.lit('\n\nGenerated reply: "'), _blank(reply),
        F.lit('"\n\nRespond ONLY with valid JSON in this exact format:\n{\n' + rubric + "\n}"),
    )


def template_reply(intent: Column, evidence: Column) -> Column:
    """Best past reply verbatim, else the intent's template, else the generic one."""
    templates = F.create_map(*[F.lit(x) for kv in REPLY_TEMPLATES.items() for x in kv])
    return F.when(F.size(evidence) > 0, F.try_element_at(evidence, F.lit(1))["brand_text"]) \
        .otherwise(F.coalesce(F.try_element_at(templates, intent), F.lit(GENERIC_REPLY)))
