"""Personal data in texts, disguised forms included, at their places in the source.

Four transducers rewrite a text one after the other, each a list of edits (source start, source end, output):

1. look-alikes: characters that Unicode folds to ASCII, digits of any script, and Cyrillic, Greek and other letters that
   look like Latin ones; invisible format characters vanish;
2. spelled digits: three or more digit words in a row, English, German, French or Spanish, with separators between
   them ('four one double one', 'null-eins-fünf', 'plus four nine ...'); 'dot' between them is a dot;
3. letters for digits: O, o, I and l inside numbers;
4. at and dot: '[at]', '(dot)', '&#64;', ' @ ' and the words at, arroba, dot, punkt, punto, point between the parts of an
   address.  A bare 'at' counts only if a disguised dot follows its next word, so prose stays prose.

The same detectors (email, ip, card, phone) run on the source and on the rewritten text.  What they find there and no edit
touches is what they find in the source.  The others' ends are mapped back through the transducers by binary search on
their edits: an end inside an output maps to the end of what it stands for.  A found disguise must not continue into
letters or digits, the last label of its address has letters only (and is a usual one, if the address is written in words
without any mark), and 10 to 15 digits spelled out count as a phone
number without a plus, too, unless they only count up or down.

Null and empty texts hold nothing.  Places are code points, end exclusive.  Spans are ordered by start, kind (email, ip,
card, phone) and end; those of the source are marked and never dropped, and a disguise inside one of its kind is not
told again.  Repeated rows are searched each; texts of any length are searched whole, in time linear in their length.
Only the id and text columns are read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import slices

KINDS = ["email", "ip", "card", "phone"]
SPAN = "struct<kind: string, start: bigint, end: bigint, base: boolean, value: string>"

# Letters and signs that look like ASCII ones beyond what Unicode folds.
LOOK_ALIKES = {
    **dict(zip("аеорсухіјѕһԁԛԝԍ", "aeopcyxijshdqwg")), **dict(zip("АВЕКМНОРСТХУІЈЅԌ", "ABEKMHOPCTXYIJSG")),
    **dict(zip("αορνικυχ", "aopvikux")), **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX")),
    **dict(zip("ıɑɡɩʟ", "iagil")), **dict(zip("‐‑‒–—―−﹣", "--------")), **dict(zip("。·•∙⋅", ".....")),
}
DIGITS = {
    "zero": 0, "oh": 0, "o": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "ein": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "fuenf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
TIMES = {"double": 2, "triple": 3, "treble": 3}
# Last labels that an address written in words only may have.
LAST_LABELS = frozenset("""com org net edu gov mil int info biz name pro io co ai app dev tv eu de at ch fr be lu it es pt nl uk ie us ca mx br ar cl pe au nz
                        jp cn kr tw hk sg in za se no dk fi is pl cz sk hu ro bg gr tr ru ua il""".split())

LEAST_WORDS, PHONE_WORDS = 3, 7
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NUMBER = "|".join(sorted((w.replace("ü", "[üÜ]").replace("é", "[éÉ]") for w in DIGITS), key=len, reverse=True))
SPELLED = re.compile(rf"(?:(?:{'|'.join(TIMES)})[ -])?(?:{NUMBER})(?![^\W_])")
BETWEEN = re.compile(r"(?:[ \t,_/–-]{1,3}|[ \t]*\.[ \t]*|[ \t]+(?:dot|point|punkt|punto)[ \t]+)(?:[0-9]+(?:[ \t,_/–-]{1,3}|[ \t]*\.[ \t]*|[ \t]+(?:dot|point|punkt|punto)[ \t]+))*")
STEP = re.compile(r"[0-9]+|[^0-9]+")
PLUS = re.compile(r"(?:\+|(?<![^\W_])plus)[ \t]*\Z")
MIXED = re.compile(r"(?<![^\W_])(?:[OoIl]+[0-9][0-9OoIl]*+|[0-9]++[OoIl][0-9OoIl]*+)(?![^\W_])")
LONE = re.compile(r"(?<=[0-9][ .-])[OoIl]{1,4}(?=[ .-][0-9])")
AS_DIGITS = str.maketrans("OoIl", "0011")

OPEN, CLOSE = r"[ \t]*[\[({<]{1,2}[ \t]*", r"[ \t]*[\])}>]{1,2}[ \t]*"
DOT_MARK = rf"{OPEN}(?:dot|punkt|punto|point|\.){CLOSE}|&#46;|&#x2e;|&period;|%2e"
DOT_WORD = r"[ \t_]+(?:dot|punkt|punto|point)[ \t_]+"
AT_MARK = rf"{OPEN}(?:at|arroba|arobase|@|a){CLOSE}|&#64;|&#x40;|&commat;|%40"
AT_DOT = re.compile(
    rf"(?P<at>(?<=[a-z0-9])(?:(?:{AT_MARK})(?=[a-z0-9])"
    rf"|[ \t_]+(?:at|arroba|arobase|klammeraffe)[ \t_]+(?=[a-z0-9-]{{1,63}}(?:{DOT_MARK}|{DOT_WORD})[a-z0-9])"
    rf"|(?:[ \t]+@[ \t]*|@[ \t]+)(?=[a-z0-9-]{{1,63}}(?:\.|{DOT_MARK}|{DOT_WORD})[a-z0-9])))"
    rf"|(?P<dot>(?<=[a-z0-9])(?:{DOT_MARK}|{DOT_WORD})(?=[a-z0-9]))")
HINT = re.compile(r"[\[({<][ \t]*(?:at|arroba|arobase|@|a|dot|punkt|punto|point|\.)[ \t]*[\])}>]|[ \t_](?:at|arroba|arobase|klammeraffe|dot|punkt|punto|point)[ \t_]|&#|&commat|&period|%40|%2e|@[ \t]|[ \t]@")

MARK = re.compile(r"[^\w\s.+-]")  # a bracket, an entity or an at sign: not words only

Edit = tuple[int, int, str]


def low(text: str) -> str:
    """ASCII letters in lower case, place by place."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


@lru_cache(maxsize=1 << 16)
def alike(c: str) -> str | None:
    """What a character outside ASCII looks like; None if it is itself."""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    if unicodedata.category(c) == "Cf":
        return ""
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded != c and folded.isascii() else None


@lru_cache(maxsize=256)
def one_of(characters: frozenset[str]) -> re.Pattern:
    return re.compile("[" + "".join(map(re.escape, sorted(characters))) + "]")


def look_alikes(text: str) -> list[Edit]:
    if text.isascii():
        return []
    odd = frozenset(c for c in set(text) if c > "\x7f" and alike(c) is not None)
    return [(m.start(), m.end(), alike(m[0])) for m in one_of(odd).finditer(text)] if odd else []


def spelled_digits(text: str) -> list[Edit]:
    plain, chains = low(text), []
    for m in SPELLED.finditer(plain):
        if m.start() and (plain[m.start() - 1].isalnum()):
            continue
        if chains and (gap := BETWEEN.fullmatch(plain, chains[-1][-1].end(), m.start())):
            chains[-1].extend((gap, m))
        else:
            chains.append([m])
    edits = []
    for chain in chains:
        if len(chain) < 2 * LEAST_WORDS - 1:
            continue
        if plus := PLUS.search(plain, max(0, chain[0].start() - 8), chain[0].start()):
            edits.append((*plus.span(), "+"))
        for k, m in enumerate(chain):
            if k % 2 == 0:
                first, _, word = m[0].replace("-", " ").rpartition(" ")
                edits.append((*m.span(), str(DIGITS[word.replace("Ü", "ü").replace("É", "é")]) * TIMES.get(first, 1)))
                continue
            for step in STEP.finditer(plain, *m.span()):  # what separates, and numbers as they are
                if not step[0].isdecimal():
                    edits.append((*step.span(), "." if re.search(r"[.a-z]", step[0]) else ""))
    return edits


def letters_in_numbers(text: str) -> list[Edit]:
    found = {m.span(): m[0].translate(AS_DIGITS) for p in (MIXED, LONE) for m in p.finditer(text)}
    return [(*span, found[span]) for span in sorted(found)]


def at_and_dot(text: str) -> list[Edit]:
    plain = low(text)
    if not HINT.search(plain):
        return []
    return [(m.start(), m.end(), "@" if m["at"] else ".") for m in AT_DOT.finditer(plain)]


TRANSDUCERS = (look_alikes, spelled_digits, letters_in_numbers, at_and_dot)


class Rewriting:
    """A text after one transducer, with the way back."""

    def __init__(self, source: str, edits: list[Edit]):
        parts, at, size = [], 0, 0
        self.starts, self.ends, self.edits = [], [], edits  # of the outputs
        for low_, high, output in edits:
            parts += [source[at:low_], output]
            size += low_ - at
            self.starts.append(size)
            size += len(output)
            self.ends.append(size)
            at = high
        self.text = "".join([*parts, source[at:]])

    def source(self, place: int) -> tuple[int, int]:
        """Where the character at ``place`` comes from."""
        k = bisect_right(self.starts, place) - 1  # of several outputs at one place all but the last are empty
        if k < 0:
            return place, place + 1
        low_, high, _ = self.edits[k]
        if place < self.ends[k]:
            return low_, high
        at = high + place - self.ends[k]
        return at, at + 1

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """(start, end, whether an edit lies between) in the source."""
        low_, high = self.source(start)[0], self.source(end - 1)[1]
        touched = bisect_right(self.starts, end - 1) > bisect_right(self.ends, start)
        return low_, high, touched


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, one @ after the other: the local part reaches back at most to the end of the last one."""
    free, at = 0, text.find("@")
    while at >= 0:
        if at >= free and (domain := DOMAIN.match(text, at + 1)):
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                free = domain.end()
                yield start, free
        at = text.find("@", max(at + 1, free))


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all identifiers written plainly."""
    found = [(s, 0, e) for s, e in emails(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int("0" + p.lstrip("0")) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(map(str.isdecimal, m[0])) <= 15]
    return sorted(found)


SPELLED_PHONE = re.compile(r"(?<![0-9+])[0-9]{10,15}(?![0-9])")


def only_counting(digits: str) -> bool:
    return len({(int(b) - int(a)) % 10 for a, b in zip(digits, digits[1:])}) == 1


def disguised(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, normalised) of identifiers that only the rewritten text shows."""
    layers, spelled, current = [], False, text
    for transducer in TRANSDUCERS:
        if edits := transducer(current):
            layers.append(Rewriting(current, edits))
            current = layers[-1].text
            spelled |= transducer is spelled_digits
    if not layers:
        return []
    found = detect(current)
    if spelled:
        found += [(m.start(), 3, m.end()) for m in SPELLED_PHONE.finditer(current) if not only_counting(m[0]) and not (len(m[0]) > 13 and luhn(m[0]))]
    out, known = [], {}
    for start, kind, end in plain:
        known.setdefault(kind, []).append((start, end))
    for start, kind, end in found:
        low_, high, touched = start, end, False
        for layer in reversed(layers):
            low_, high, changed = layer.back(low_, high)
            touched |= changed
        if not touched or low_ and text[low_ - 1].isalnum() or high < len(text) and text[high].isalnum():
            continue
        value, written = current[start:end], text[low_:high]
        if kind == 0 and (not re.search(r"\.[A-Za-z]{2,}\Z", value) or not MARK.search(written) and value.rpartition(".")[2].lower() not in LAST_LABELS):
            continue
        if kind == 3 and value[0] != "+" and len(value) - sum(c.isdecimal() for c in written) < PHONE_WORDS:
            continue
        inside = known.get(kind, [])
        k = bisect_right(inside, (low_, len(text))) - 1
        if k >= 0 and inside[k][1] >= high:
            continue
        out.append((low_, kind, high, value))
    return sorted(set(out))


def find_spans(text: str | None) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, end, whether written plainly, normalised identifier) in order."""
    if not text:
        return []
    plain = detect(text)
    spans = [(s, k, e, True, text[s:e]) for s, k, e in plain] + [(s, k, e, False, v) for s, k, e, v in disguised(text, plain)]
    return [(KINDS[k], s, e, base, value) for s, k, e, base, value in sorted(spans)]


def redact(text: str | None, spans: list[tuple]) -> str | None:
    """The text with a mark of the first kind instead of every stretch that spans cover."""
    if text is None:
        return None
    parts, at, reach = [], 0, -1
    for kind, start, end, *_ in spans:
        if start >= reach:
            parts += [text[at:start], f"<{kind.upper()}>"]
        reach = max(reach, end)
        at = max(at, reach)
    return "".join([*parts, text[at:]])


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False) -> DataFrame:
    """(id, spans[, redacted]) of every row; a span is (kind, start, end, base, value)."""
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("value", pa.string())])
    names = [f.name for f in span]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                texts = part.column(1).to_pylist()
                found = [find_spans(t) for t in texts]
                columns = [part.column(0), pa.array([[dict(zip(names, s)) for s in spans] for spans in found], pa.list_(span))]
                if redacted:
                    columns.append(pa.array([redact(t, s) for t, s in zip(texts, found)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "spans", *["redacted"] * redacted])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, spans array<{SPAN}>" + ", redacted string" * redacted).withColumnRenamed("id", id_col)
