"""License scans: phrases by an Aho-Corasick automaton, identifier expressions by a shunting-yard parser.

A text's words are runs of letters, digits and non-ASCII bytes, ASCII letters folded to lower case.  One
automaton over the words joined by single blanks finds every place of every phrase, overlapping ones too.
Where the identifier tag stands, the rest of its line is parsed as an expression with AND, OR, WITH and
parentheses (WITH binds strongest, then AND); the identifiers become labels and the expression is evaluated
against the accepted licences.  Behind 'licensed under' the same parser reads as far as known identifiers go; names in
words stop it, so prose is never an invalid expression, and an expression that is not whole gives labels only.  Of
notice phrases within one another the longest decides the label ('cc by nc' is no 'cc by').

Null and empty texts have no words, no labels and score 0.  An expression that does not parse is counted as
invalid and lowers the score, as do identifiers of no known family behind the tag, which are no labels either.  Places are counted once per occurrence; repeated rows are scanned each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import slices

# Phrase -> label.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICE_PHRASES = {
    "apache license version 2 0": "apache-2.0", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl", "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "eclipse public license": "epl", "creative commons attribution": "cc-by", "isc license": "isc", "boost software license": "bsl",
    "permission is hereby granted free of charge": "mit-like", "this is free and unencumbered software": "unlicense",
    "all rights reserved": "all-rights-reserved", "cc0": "cc0", "creative commons zero": "cc0",
}
# Creative Commons terms in any written form: (short, spelled out) for every combination.
NC, SA, ND = ["noncommercial", "non commercial"], ["sharealike", "share alike"], ["noderivatives", "no derivatives", "noderivs", "no derivs"]
for short, spelled in [("", [""]), ("nc", NC), ("sa", SA), ("nd", ND), ("nc sa", [f"{x} {y}" for x in NC for y in SA]), ("nc nd", [f"{x} {y}" for x in NC for y in ND]),
                       ("nd nc", [f"{y} {x}" for x in NC for y in ND])]:
    label = "-".join(["cc-by", *sorted(short.split(), key=["nc", "sa", "nd"].index)])
    NOTICE_PHRASES |= {f"{start} {rest}".strip(): label for start, rests in (("cc by", [short]), ("creative commons attribution", spelled), ("creative commons by", [short])) for rest in rests}
BARE = "cc by"   # also a word of letters ('please cc by Friday'), so its writing decides
BARE_WRITTEN = regex.compile(r"(?<![A-Za-z0-9])(?:CC[\s_-]+BY|(?i:cc[-_]by)|(?i:cc\s+by)(?=[\s_-]+(?:[1-4][.]\d|(?i:licen[cs]e|international))))(?![A-Za-z0-9])(?![\s_-]+(?i:nc|sa|nd)(?![A-Za-z0-9]))")
TAG = "spdx license identifier"
TAG_LINE = regex.compile(r"(?i)spdx-license-identifier\s*:[ \t]*([^\r\n]*)")
UNDER = ("licensed under", "licenced under")
UNDER_PLACE = regex.compile(r"(?i)licen[cs]ed[^A-Za-z0-9\x80-\U0010FFFF]+under[^A-Za-z0-9\x80-\U0010FFFF(]+(?:the\s+)?")
UNDER_TOKEN = regex.compile(r"[ \t]*(?:(?P<cc>(?i:cc[ \t_-]+by)(?:[ \t_-]+(?i:nc|sa|nd)(?![A-Za-z0-9]))*(?:[ \t_-]+[1-4]\.\d(?!\d))?(?![A-Za-z0-9]))|(?P<sign>[(),/&])|(?P<word>[A-Za-z0-9][A-Za-z0-9.+:-]*))")
KNOWN = regex.compile(
    r"mit(-0)?|isc|zlib|unlicense|0bsd|wtfpl|x11|ncsa|postgresql|openssl|ms-(pl|rl)|bsd(-\d-clause(-[a-z-]+)?)?|cc0(-1\.0)?|cc-by(-nc)?(-sa|-nd)?(-\d\.\d)?|"
    r"(apache|mpl|epl|cddl|cpl|bsl|afl|apsl|osl|ofl|eupl|artistic|lppl|odbl|pddl|python|psf|ecl|upl|mulanpsl|blueoak|cecill)-[0-9][0-9.a-z-]*|"
    r"([al]?gpl|gfdl)(-\d(\.\d)*)?(-only|-or-later|\+)?|licenseref-[a-z0-9.-]+")
EXCEPTION = regex.compile(r"[a-z0-9.-]*(exception|linking|foss)[a-z0-9.-]*")
ACCEPTED = frozenset("mit apache-2.0 bsd-2-clause bsd-3-clause isc unlicense 0bsd bsl-1.0 zlib cc0-1.0 cc-by-4.0".split())
ACCEPTED_WITH = frozenset({("apache-2.0", "llvm-exception")})

SEPARATORS = bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
WORDS = bytes.maketrans(SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(SEPARATORS) + bytes(range(0x61, 0x7B)))
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


class BadExpression(ValueError):
    pass


def to_postfix(expression: str) -> list[str]:
    """Shunting-yard: operands and operators of an infix expression in postfix order, in lower case.

    WITH stands between a single identifier and a single exception, never beside a group or another WITH.
    """
    out, stack, operand, last = [], [], False, ["", ""]
    for token in regex.findall(r"[()]|[^\s()]+", expression.lower()):
        before, last = last, [last[1], token]
        if token == "with" and (before[1] in ("", ")") or before[0] == "with") or token == "(" and before[1] == "with":
            raise BadExpression(expression)
        if token == "(":
            if operand:
                raise BadExpression(expression)
            stack.append(token)
        elif token == ")":
            if not operand:
                raise BadExpression(expression)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise BadExpression(expression)
            stack.pop()
        elif token in PRECEDENCE:
            if not operand:
                raise BadExpression(expression)
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = False
        else:
            if operand or not regex.fullmatch(r"[a-z0-9.+:-]+", token):
                raise BadExpression(expression)
            out.append(token)
            operand = True
    if not operand or "(" in stack:
        raise BadExpression(expression)
    return out + stack[::-1]


def evaluate(postfix: list[str], accepted: frozenset = ACCEPTED, accepted_with: frozenset = ACCEPTED_WITH) -> bool:
    """Whether an expression can be met with accepted licences only."""
    stack: list = []
    for token in postfix:
        if token not in PRECEDENCE:
            stack.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":  # two names: the parser lets nothing else through
            stack.append((left, right) in accepted_with or left in accepted)
            continue
        left, right = (x if isinstance(x, bool) else x in accepted for x in (left, right))
        stack.append(left and right if token == "and" else left or right)
    return stack[0] if isinstance(stack[0], bool) else stack[0] in accepted


def identifiers(postfix: list[str]) -> list[str]:
    """Licence identifiers of an expression; one before WITH carries its exception."""
    stack: list[list[str]] = []
    for token in postfix:
        if token in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append([f"{left[0]} with {right[0]}"] if token == "with" and len(left) == len(right) == 1 else left + right)
        else:
            stack.append([token])
    return stack[0]


def is_known(name: str) -> bool:
    """Whether an identifier, with its exception if it has one, is of a known family."""
    licence, _, exception = name.partition(" with ")
    return bool(KNOWN.fullmatch(licence)) and (not exception or bool(EXCEPTION.fullmatch(exception)))


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick
    made = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICE_PHRASES, TAG, *UNDER]:
        made.add_word(f" {phrase} ", phrase)
    made.make_automaton()
    return made


def read_under(text: str, at: int) -> tuple[list[str], str | None]:
    """(identifiers, expression) written at ``at``; the expression is None if it does not parse or is not whole."""
    tokens, whole, gap = [], True, False
    while m := UNDER_TOKEN.match(text, at):
        sign, word = m["sign"], m["cc"] and regex.sub(r"[ \t_-]+", "-", m["cc"]) or (m["word"] or "").rstrip(".:-")
        low = word.lower()
        if sign and sign in ",/&":
            gap = True
        elif sign:
            tokens.append(sign)
        elif low in PRECEDENCE or KNOWN.fullmatch(low) or tokens and tokens[-1].lower() == "with" and EXCEPTION.fullmatch(low):
            whole &= not gap  # a list does not say whether all of it or one of it holds
            tokens.append(word)
        else:
            break
        at = m.end()
        if m["word"] and m["word"] != word:
            break  # end of the sentence
    while tokens and (tokens[-1] == "(" or tokens[-1].lower() in PRECEDENCE):
        whole &= tokens.pop() == "("
    if tokens.count(")") == tokens.count("(") + 1 and tokens[-1] == ")":
        tokens.pop()  # closes what was opened before 'licensed'
    names = [t.lower() for t in tokens if KNOWN.fullmatch(t.lower())]
    written = regex.sub(r"\( | \)", lambda x: x[0].strip(), " ".join(tokens))
    try:
        identifiers(to_postfix(written))
    except BadExpression:
        whole = False
    return names, written if whole else None


def longest(places: list[tuple[int, int, str]]) -> set[str]:
    """Phrases of (start, end, phrase) that stand somewhere outside a longer one."""
    kept, reach = set(), -1
    for start, end, phrase in sorted(places, key=lambda p: (p[0], -p[1])):
        if end > reach:
            kept.add(phrase)
            reach = end
    return kept


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, invalid, acceptable)."""
    words = (text or "").encode().translate(WORDS).split()
    line = " " + b" ".join(words).decode("latin-1") + " "  # one character per byte
    starts, found, tagged, under, notices = [], set(), False, False, []
    for end, phrase in automaton().iter(line):
        if phrase in BASE_PHRASES:
            starts.append(end - len(phrase) - 1)
            found.add(BASE_PHRASES[phrase])
        elif phrase == TAG:
            tagged = True
        elif phrase in UNDER:
            under = True
        else:
            notices.append((end - len(phrase) - 1, end, phrase))
    found.update(NOTICE_PHRASES[p] for p in longest(notices) if p != BARE or BARE_WRITTEN.search(text))
    base = sorted(found & set(BASE_PHRASES.values()))
    expressions, invalid, unknown, verdicts, named = [], 0, False, [], set()
    for written in TAG_LINE.findall(text) if tagged else []:
        written = regex.sub(r"(?:\*/|-->).*$", "", written).strip()
        try:
            postfix = to_postfix(written)
        except BadExpression:
            invalid += 1
            continue
        names = identifiers(postfix)
        known = {name for name in names if is_known(name)}
        unknown |= len(known) < len(set(names))
        verdicts.append(evaluate(postfix))
        named.update(known)
        expressions.append(written)
    for place in UNDER_PLACE.finditer(text) if under else []:
        names, written = read_under(text, place.end())
        if written is None:
            found.update(names)
            continue
        postfix = to_postfix(written)
        verdicts.append(evaluate(postfix))
        named.update(identifiers(postfix))
        expressions.append(written)
    if not (found or named or invalid or unknown):
        score = 0.0
    else:
        score = 1.0 if named and not invalid and not unknown else 0.9 if base else 0.7 if found or named else 0.3
    first = last = None
    if starts:
        first, last = (line.count(" ", 0, s + 1) - 1 for s in (min(starts), max(starts)))
    return (len(words), len(starts), first, last, ",".join(base), ",".join(sorted(found | named)), score,
            expressions, invalid, all(verdicts) if verdicts else None)


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; words count from 0, first and last word are of base phrases."""
    kind = docs.schema[id_col].dataType.simpleString()
    columns = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
               ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(pa.string())),
               ("invalid_expressions", pa.int32()), ("acceptable", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                rows = list(zip(*[scan(t) for t in batch.column(1).slice(start, stop - start).to_pylist()]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *[pa.array(r, k) for r, (_, k) in zip(rows, columns)]],
                                                 names=["id", *[c for c, _ in columns]])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
             "expressions array<string>, invalid_expressions int, acceptable boolean").withColumnRenamed("id", id_col)
