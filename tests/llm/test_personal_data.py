"""Personal data: base patterns against the plain expressions, disguises by example, places by mapping back."""

import hashlib
import random
import re
import time

import pytest

from threadlens.llm import personal_data as pd_
from threadlens.llm import queries

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(digits[::-1])]
    return sum(sum(map(int, str(n))) for n in doubled) % 10 == 0


def plain(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(int(p) for p in m[0].split(".")) > 255 or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)) \
                    or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), list(PATTERNS).index(kind), m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(found)]


def base_of(text):
    return [s[:3] for s in pd_.find_spans(text) if s[3]]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    parts = ["a", "Z", "9", "0", "4111111111111111", "1", "255", "256", "007", ".", ".", "-", " ", "@", "@", "+", "(", ")", "_", "%", "é", "\n", "x.y", "192.168.0.1", "+1 (555) 010-2030"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert base_of(text) == plain(text), text


DISGUISED = [
    ("email", "john.doe [at] example [dot] com", "john.doe@example.com"), ("email", "john dot doe at example dot com", "john.doe@example.com"),
    ("email", "jane(at)mail.example.org", "jane@mail.example.org"), ("email", "jane AT mail DOT example DOT org", "jane@mail.example.org"),
    ("email", "info&#64;firma.de", "info@firma.de"), ("email", "info {at} firma (punkt) de", "info@firma.de"), ("email", "ana arroba correo punto es", "ana@correo.es"),
    ("email", "luc arobase exemple point fr", "luc@exemple.fr"), ("email", "jоhn@exаmple.com", "john@example.com"), ("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "john@example.com"),
    ("email", "jo​hn@exam​ple.com", "john@example.com"), ("email", "john @ example.com", "john@example.com"), ("email", "john_at_example_dot_com", "john@example.com"),
    ("ip", "１９２.168.0.1", "192.168.0.1"), ("ip", "192[.]168[.]0[.]1", "192.168.0.1"), ("ip", "192 dot 168 dot 0 dot 1", "192.168.0.1"), ("ip", "l92.168.O.1", "192.168.0.1"),
    ("ip", "one nine two dot one six eight dot zero dot one", "192.168.0.1"),
    ("card", "４１１１ 1111 1111 1111", "4111 1111 1111 1111"), ("card", "four one one one 1111 one one one one one one one one", "4111111111111111"),
    ("card", "4111–1111–1111–1111", "4111-1111-1111-1111"), ("card", "4lll 1111 llll 1111", "4111 1111 1111 1111"),
    ("phone", "plus one five five five oh one two three four five six", "+15550123456"), ("phone", "five five five, oh one two three, four five six", "5550123456"),
    ("phone", "+49 null eins fünf eins 2345678", "+49 0151 2345678"), ("phone", "+1 (５５５) 010-2030", "+1 (555) 010-2030"),
    ("phone", "cinco cinco cinco cero uno dos tres cuatro cinco seis", "5550123456"), ("phone", "double five five oh one two three triple four six", "55501234446"),
]


@pytest.mark.parametrize("kind, written, value", DISGUISED)
def test_disguises_are_found_at_their_place(kind, written, value):
    for before, after in (("", ""), ("Please contact me: ", ", thanks"), ("été ﬁ “x” ½ ​ ", ".\nNext line"), ("(", ")")):
        text = before + written + after
        found = [(k, text[s:e], v) for k, s, e, base, v in pd_.find_spans(text) if not base]
        assert (kind, written, value) in found, found
        assert base_of(text) == plain(text)


CLEAN = ["We meet at noon. Dot the i, cross the t.", "Look at example.com for details", "one two three four five six seven eight nine ten", "zero one two three four five six seven eight nine",
         "The point at issue is a point of order", "vier oder fünf, sechs, sieben", "uno o dos, tres", "version 1.2.3 of 2024-01-01", "I scored 10 l0 and O0", 
         "neuf, un, deux huit sept", "почта и текст на русском языке", "ａｂｃ １２３", "a.b.c at the dot of noon", "1st, 2nd, 3rd at 5 p.m. dot", "+1 and + two", ""]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay_clean(text):
    assert pd_.find_spans(text) == []


def test_back_through_one_transducer():
    rng = random.Random(4)
    for _ in range(500):
        source = "".join(rng.choice("abcde") for _ in range(rng.randint(1, 30)))
        cuts = sorted(rng.sample(range(len(source) + 1), min(len(source) + 1, 2 * rng.randint(0, 4))))
        edits = [(a, b, "X" * rng.randint(0, 3)) for a, b in zip(cuts[::2], cuts[1::2])]
        done, want, at = pd_.Rewriting(source, edits), [], 0
        for a, b, out in edits:
            want += [(k, k + 1) for k in range(at, a)] + [(a, b)] * len(out)
            at = b
        want += [(k, k + 1) for k in range(at, len(source))]
        assert [done.source(k) for k in range(len(done.text))] == want


def test_linear_in_the_length():
    for unit in ("a.", "1", "1.", "+1 (", "@a", "one ", " at ", "[ ", "a@", "1 ", "﻿", "0l", "－"):
        times = []
        for n in (20_000, 80_000):
            start = time.perf_counter()
            pd_.find_spans(unit * n)
            times.append(time.perf_counter() - start)
        assert times[1] < 12 * times[0] + 0.5, (unit, times)


def test_rows(spark, monkeypatch):
    texts = [None, "", "x" * 200_000 + " a@b.co", "mail a@b.co or c [at] d [dot] org, a@b.co", "mail a@b.co or c [at] d [dot] org, a@b.co", "no data"]
    rows = [(k if k != 1 else None, t, 5, "s") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_email int, spans string")
    got = {r.doc_id: r for r in pd_.find_personal_data(df, redacted=True).collect()}
    assert len(got) == len(rows) and got[0].spans == [] and got[0].redacted is None and got[None].redacted == ""
    assert got[3].redacted == "mail <EMAIL> or <EMAIL>, <EMAIL>" and [s.base for s in got[3].spans] == [True, False, True]
    monkeypatch.setattr(queries, "table", lambda *_: df)
    out = {r.doc_id: r for r in queries.op13_personal_data(spark, "").collect()}
    for k, t in enumerate(texts):
        r = out[k if k != 1 else None]
        want = plain(t)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == kind for s in want) for kind in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{a}:{b}:{c}" for a, b, c in want).encode()).hexdigest()
    assert out[3].spans == "email:5:11,email:15:33,email:35:41" and out[0].spans == ""
    monkeypatch.setattr(queries, "table", lambda *_: df.limit(0))
    assert queries.op13_personal_data(spark, "").collect() == []
