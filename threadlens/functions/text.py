"""Column expressions for cleaning, labelling and tokenising message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware classes.  Java's \s and \w are ASCII-only, so they are spelled out.
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
WORD = r"\p{L}\p{N}_"

# The labelling rules, in the order they are tried.
INTENT_RULES = {
    "account_access": [
        r"\bapple id\b", r"\bcan'?t log\b", r"\bcan'?t sign\b", r"\blocke?d out\b",
        r"\bforgot password\b", r"\breset password\b", r"\bhacked\b",
        r"\baccount.*suspend\b", r"\bcan'?t access\b", r"\btwo.?factor\b",
        r"\bverification code\b", r"\bicloud.*lock\b",
    ],
    "billing_payment": [
        r"\brefund\b", r"\bcharged twice\b", r"\bwrong charge\b",
        r"\bunauthorized charge\b", r"\bpayment.*fail\b", r"\bovercharged\b",
        r"\bmoney back\b", r"\bget.*refund\b", r"\bapp store.*charge\b",
        r"\bitunes.*charge\b", r"\bsubscription.*charge\b",
    ],
    "device_hardware": [
        r"\biphone\b.*\bbroken\b", r"\bscreen.*crack\b", r"\bbattery\b.*\bdrain\b",
        r"\bwon'?t turn on\b", r"\bdead\b.*\bphone\b", r"\bphone.*dead\b",
        r"\bwater damage\b", r"\brepair\b", r"\bgenius bar\b",
        r"\bhardware\b", r"\bphysical damage\b",
    ],
    "software_update": [
        r"\bios\b.*\bupdate\b", r"\bupdate\b.*\bios\b", r"\bios \d\b",
        r"\bsoftware update\b", r"\bupgrade\b.*\bios\b", r"\binstall.*update\b",
        r"\bupdate.*fail\b", r"\bstuck.*update\b", r"\bmacos\b.*\bupdate\b",
    ],
    "app_issue": [
        r"\bapp.*crash\b", r"\bapp.*not.*work\b", r"\bapp.*won'?t\b",
        r"\bapp store\b.*\bproblem\b", r"\bcan'?t.*download\b", r"\bapp.*freez\b",
        r"\bapp.*open\b", r"\bapp.*load\b", r"\bapp.*error\b",
    ],
    "icloud_sync": [
        r"\bicloud\b", r"\bbackup\b.*\bfail\b", r"\bsync\b.*\bproblem\b",
        r"\bphotos.*not.*sync\b", r"\bstorage.*full\b", r"\bicloud.*storage\b",
        r"\bcloud.*backup\b",
    ],
    "connectivity": [
        r"\bwifi\b.*\bnot.*connect\b", r"\bbluetooth\b.*\bnot.*work\b",
        r"\bno.*signal\b", r"\bcellular\b.*\bproblem\b", r"\bairpods\b.*\bconnect\b",
        r"\bhotspot\b", r"\binternet.*not.*work\b",
    ],
    "warranty_repair": [
        r"\bwarranty\b", r"\bapplecare\b", r"\bapple care\b",
        r"\brepair.*cost\b", r"\bservice.*center\b", r"\bfind.*store\b",
        r"\bbook.*appointment\b",
    ],
}
FALLBACK_INTENT = "other"
INTENTS = [*INTENT_RULES, FALLBACK_INTENT]


def strip(col: Column) -> Column:
    """Trim Unicode whitespace, not only blanks."""
    return F.regexp_replace(col, f"^[{SPACE}]+|[{SPACE}]+$", "")


def is_blank(col: Column) -> Column:
    return F.coalesce(strip(col) == "", F.lit(True))


def clean_text(col: Column) -> Column:
    """Drop URLs, then mentions, collapse whitespace; null becomes ''.  Case is kept."""
    out = F.regexp_replace(col, f"https?://[^{SPACE}]+", " ")
    out = F.regexp_replace(out, f"@[{WORD}]+", " ")
    out = F.trim(F.regexp_replace(out, f"[{SPACE}]+", " "))
    return F.coalesce(out, F.lit(""))


def is_valid_id(col: Column) -> Column:
    return F.coalesce(strip(col).rlike(r"^\p{Nd}+$"), F.lit(False))


def label_intent(col: Column, rules: dict[str, list[str]] | None = None,
                 fallback: str = FALLBACK_INTENT) -> Column:
    """First rule set with a matching pattern wins; no match or blank gives ``fallback``.

    Each rule set is one alternation, so a row runs at most ``len(rules)`` regexes.
    Flags: ``i``+``u`` Unicode case folding, ``d`` so that only \\n ends a line.
    """
    expr = None
    for intent, patterns in (rules or INTENT_RULES).items():
        joined = "|".join(p.replace(r"\d", r"\p{Nd}") for p in patterns)
        hit = col.rlike(f"(?iud)(?:{joined})")
        expr = F.when(hit, intent) if expr is None else expr.when(hit, intent)
    return F.coalesce(expr, F.lit(fallback))


def tokens(col: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(f"([{WORD}]{{2,}})"), F.lit(1))


def ngrams(toks: Column, max_n: int = 2) -> Column:
    """Unigrams followed by the space-joined n-grams up to ``max_n``.

    Each order zips the previous one with the shifted tokens: linear in the text.
    """
    out = grams = toks
    for n in range(2, max_n + 1):
        left = F.greatest(F.size(toks) - (n - 1), F.lit(0))
        grams = F.zip_with(F.slice(grams, 1, left), F.slice(toks, n, left), lambda a, b: F.concat_ws(" ", a, b))
        out = F.concat(out, grams)
    return out
