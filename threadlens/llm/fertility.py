"""Quality rules on tokeniser fertility.

Public vocabularies are applied word by word: a sentencepiece vocabulary with byte fallback and a byte-level
one.  For each, a document gets characters per token, the share of tokens that are only bytes (fallback pieces,
or parts of a split character) and the entropy of its tokens relative to the largest possible for their number.
Rejection bands stand per language, and per script for every other or missing language.  ``fit_bands`` narrows them
for each vocabulary on all good labelled documents; fixed wide bands hold beside them, and alone where too few documents
are labelled.  Base rules (too few words, too many repeated three-word windows) come first.

Null and empty texts have no words and fail the base rule.  Words are runs of anything but ASCII white space.
Very long texts are measured whole; repeated rows each; only id, text and language are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.bpe import read_ranks
from threadlens.llm.common import slices, values_at
from threadlens.llm.near_dedup import SLICE, Shingler
from threadlens.sources.scratch import materialize

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
REMEMBERED = 250_000       # distinct words a worker remembers per vocabulary
PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
# Learned bands: documents of a language at least, margin beyond the furthest good document, deviations
# (from the median, by measure) that every band spans, and words from which characters per token count in full.
FIT_LEAST = 30
MARGIN, SPANS, FULL_WORDS = 1.25, np.array([6.0, 9.0, 3.3]), 1000


@dataclass(frozen=True)
class Band:
    """Accepted range for one language or script, for the two kinds of vocabulary alike."""

    low: float              # characters per token
    high: float
    byte_share: float       # at most
    entropy: float          # at least, relative


# A document is far outside what prose of the language needs before it is rejected: fertility of running text in
# these vocabularies lies between 1.5 and 5 characters per token for alphabets and near or under 1 for ideographs.
BANDS = {
    "en": Band(1.4, 7.0, 0.10, 0.35), "de": Band(1.3, 7.0, 0.10, 0.35), "fr": Band(1.2, 7.0, 0.10, 0.35), "es": Band(1.2, 7.0, 0.10, 0.35),
    "Latin": Band(1.1, 7.0, 0.20, 0.35), "Cyrillic": Band(0.8, 6.0, 0.40, 0.35), "Greek": Band(0.5, 5.0, 0.80, 0.30),
    "Arabic": Band(0.5, 5.0, 0.80, 0.30), "Hebrew": Band(0.5, 5.0, 0.80, 0.30), "Devanagari": Band(0.3, 5.0, 0.98, 0.25),
    "Thai": Band(0.3, 5.0, 0.98, 0.25), "Hangul": Band(0.3, 4.0, 0.98, 0.25), "Han": Band(0.3, 4.0, 0.98, 0.25),
    "Hiragana": Band(0.3, 4.0, 0.98, 0.25), "Katakana": Band(0.3, 4.0, 0.98, 0.25), "other": Band(0.2, 8.0, 1.0, 0.2),
}
SCRIPTS = [s for s in BANDS if s[0].isupper()]
SCRIPT_OF = {s: regex.compile(rf"\p{{Script={s}}}") for s in SCRIPTS}


def script_of(text: str) -> str:
    """The script with most letters; Latin at once for texts of mostly ASCII letters."""
    letters = sum(c.isalpha() for c in text) if not text.isascii() else 0
    ascii_letters = len(regex.findall(r"[A-Za-z]", text)) if letters else 1
    if 2 * ascii_letters > letters:
        return "Latin"
    counts = {s: len(p.findall(text)) for s, p in SCRIPT_OF.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


@dataclass(frozen=True)
class Learned:
    """Accepted deviations from the good documents' median in one vocabulary, for the three measures."""

    middle: tuple[float, ...]
    below: tuple[float, ...]
    above: tuple[float, ...]


def slack(n_words: np.ndarray | int) -> np.ndarray:
    """How much further a short document may lie: characters per token vary with the root of the length."""
    return np.maximum(1.0, np.sqrt(FULL_WORDS / np.maximum(1, n_words)))


def learn_band(values: np.ndarray, n_words: np.ndarray) -> Learned:
    """Band of one vocabulary from the (documents x 3) measures of good documents."""
    middle = np.median(values, axis=0)
    off = values - middle
    off[:, 0] /= slack(n_words)
    return band_from(middle, np.median(np.abs(off), axis=0), np.stack([off.min(axis=0), off.max(axis=0)], axis=1))


def band_from(middle: np.ndarray, spread: np.ndarray, ends: np.ndarray) -> Learned:
    """Band around the medians of three measures, from the median and the (lowest, highest) of the deviations."""
    usual = SPANS * 1.4826 * spread
    below, above = (np.maximum(MARGIN * np.maximum(0, x), usual) for x in (-ends[:, 0], ends[:, 1]))
    return Learned(tuple(middle.tolist()), tuple(below.tolist()), tuple((above + [0, 0.01, 0]).tolist()))


class WordTokens:
    """Token ids of words for one vocabulary, with a bounded memory."""

    def __init__(self, path: str, pattern: str):
        if path.endswith(".model"):
            import sentencepiece
            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.only_byte = np.array([pieces.is_byte(k) for k in range(pieces.get_piece_size())])
            self.run = lambda words: pieces.encode(words, num_threads=1)
        else:
            import tiktoken
            ranks = read_ranks(path)
            words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.only_byte = np.zeros(1 + max(ranks.values()), dtype=bool)
            self.only_byte[[k for token, k in ranks.items() if not valid(token)]] = True
            self.run = lambda new: [words.encode_ordinary(" " + w) for w in new]
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, list(words)
        for at in range(0, len(new), 8192):
            part = new[at:at + 8192]
            ids = self.run([w.decode() for w in part])
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32).tobytes()
            cuts = [0, *(4 * np.cumsum(list(map(len, ids)))).tolist()]
            self.known.update(zip(part, [flat[low:high] for low, high in zip(cuts, cuts[1:])]))

    def measure(self, words: list[bytes], characters: int) -> tuple[float, float, float]:
        """(characters per token, byte share, relative entropy) of one document."""
        ids = np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=np.int32)
        if not len(ids):
            return 0.0, 0.0, 0.0
        counts = np.unique(ids, return_counts=True)[1] / len(ids)
        entropy = float(-(counts * np.log2(counts)).sum()) / np.log2(len(ids)) if len(ids) > 1 else 1.0
        return characters / len(ids), float(self.only_byte[ids].mean()), float(abs(entropy))


def valid(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


@lru_cache(maxsize=4)
def word_tokens(path: str, pattern: str) -> WordTokens:
    return WordTokens(path, pattern)


def repeated_words(windows: np.ndarray, n_words: int) -> int:
    """Words that stand in a window found twice or more."""
    if len(windows) < 2:
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(counts) == len(windows):
        return 0
    twice = counts[inverse] > 1
    covered = np.zeros(n_words, dtype=bool)
    for k in range(n_words - len(windows) + 1):
        covered[k:k + len(windows)] |= twice
    return int(covered.sum())


def measure_texts(texts: list[str | None], shingler: Shingler, vocabularies: list[WordTokens]) -> list[tuple]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then three measures per vocabulary."""
    hashes, firsts = shingler.words(texts)
    n = max(0, len(hashes) - shingler.width + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(shingler.width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    split = [(t or "").encode().split() for t in texts]
    distinct = set().union(*split)
    for v in vocabularies:
        v.learn(distinct)
    out = []
    for k, (text, words) in enumerate(zip(texts, split)):
        text, low, high = text or "", int(firsts[k]), int(firsts[k + 1])
        data = text.encode()
        blank = sum(text.count(c) for c in " \t\n\v\f\r")
        lines = [x for x in data.split(b"\n") if x.strip(b" \t\n\v\f\r")]
        out.append((high - low, len(text) - blank, len(data) - len(data.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)),
                    repeated_words(rolled[low:max(low, high - shingler.width + 1)], high - low),
                    *(m for v in vocabularies for m in v.measure(words, len(text) - blank))))
    return out


def band_of(lang: str | None, text: str, learned: dict[str, tuple[Learned, ...]]) -> str:
    return lang if lang in BANDS or lang in learned else script_of(text)


def judge(lang: str | None, text: str, measures: list[tuple], n_words: int = 0, learned: dict[str, tuple[Learned, ...]] | None = None) -> tuple[str, str]:
    """(band used, reasons joined by commas; empty if accepted)."""
    learned = learned or {}
    name = band_of(lang, text, learned)
    band, why = BANDS.get(name), set()
    for k, (per_token, byte_share, entropy) in enumerate(measures):
        bad = {}
        if band:
            bad = {"short_tokens": per_token < band.low, "long_tokens": per_token > band.high,
                   "byte_fallback": byte_share > band.byte_share, "low_entropy": entropy < band.entropy}
        if name in learned:
            own = learned[name][k]
            off = (per_token - own.middle[0]) / slack(n_words)
            for reason, beyond in (("short_tokens", off < -own.below[0]), ("long_tokens", off > own.above[0]),
                                   ("byte_fallback", byte_share - own.middle[1] > own.above[1]), ("low_entropy", entropy - own.middle[2] < -own.below[2])):
                bad[reason] = bad.get(reason, False) or beyond
        why |= {r for r, beyond in bad.items() if beyond}
    return name, ",".join(sorted(why))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def parts_of(paths: dict[str, str]) -> list[str]:
    """Columns of the measures, three for each vocabulary."""
    return [f"{name}_{m}" for name in paths for m in ("chars_per_token", "byte_share", "entropy")]


def measure_documents(docs: DataFrame, paths: dict[str, str], pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str | None = "lang") -> DataFrame:
    """``id``, stated language, script (null where the language has a fixed band), counts, base rule and measures per document.

    The one pass over the texts: bands are learned from these rows and judge them.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    parts = parts_of(paths)
    schema = ", ".join([f"id {kind}", "lang string", "script string", *[f"{c} long" for c in BASE], "base_failed boolean", *[f"{c} double" for c in parts]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(3, fold=False)
        vocabularies = [word_tokens(p, pattern) for p in paths.values()]
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE):
                part = batch.slice(start, stop - start)
                texts, langs = part.column(1).to_pylist(), part.column(2).to_pylist()
                rows = []
                for text, lang, m in zip(texts, langs, measure_texts(texts, shingler, vocabularies)):
                    failed = m[0] < MIN_WORDS or 100 * m[4] > MAX_REPEAT_PERCENT * m[0]
                    rows.append((None if lang in BANDS else script_of(text or ""), *m[:5], failed, *m[5:]))
                kinds = [pa.string(), *[pa.int64()] * 5, pa.bool_(), *[pa.float64()] * len(parts)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                                                 names=["id", "lang", "script", *BASE, "base_failed", *parts])
        for v in vocabularies:
            v.known = {}

    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang")).mapInArrow(run, schema)


def fit_bands(measures: DataFrame, labels: DataFrame, paths: dict[str, str], *, id_col: str = "doc_id", label_col: str = "quality") -> dict[str, tuple[Learned, ...]]:
    """Bands per language (script where none is stated), one for each of ``paths``, from all documents labelled 1 only.

    ``measures`` are rows of ``measure_documents``, as a written table.  Medians are exact over every such document that passes
    the base rule; a language with fewer than FIT_LEAST gets no band of its own.  The driver sees numbers per language.
    """
    good = labels.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("worst"), F.max(label_col).alias("best")).where("worst = 1 and best = 1").select("id")
    name = F.when(F.col("lang") != "", F.col("lang")).otherwise(F.coalesce("script", F.lit("other")))
    rows = measures.where("not base_failed").join(good, "id", "left_semi").select(
        name.alias("name"), "n_words", F.posexplode(F.array(*parts_of(paths))).alias("k", "value"))
    rows = materialize(rows.select(F.concat_ws(":", F.col("k"), F.col("name")).alias("key"), "k", "n_words", "value"), "band-rows")
    counts = {r.key: r.n for r in rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FIT_LEAST).collect()}
    if not counts:
        return {}

    def medians(table: DataFrame) -> dict[str, float]:
        found = values_at(table, {key: ((n - 1) // 2, n // 2) for key, n in counts.items()})
        return {key: (found[key, (n - 1) // 2] + found[key, n // 2]) / 2 for key, n in counts.items()}

    middle = medians(rows.select("key", "value"))
    centres = F.broadcast(rows.sparkSession.createDataFrame(list(middle.items()), "key string, middle double"))
    room = F.when(F.col("k") % 3 == 0, F.greatest(F.lit(1.0), F.sqrt(F.lit(float(FULL_WORDS)) / F.greatest(F.lit(1), F.col("n_words"))))).otherwise(F.lit(1.0))
    off = materialize(rows.join(centres, "key").select("key", ((F.col("value") - F.col("middle")) / room).alias("off")), "band-deviations")
    ends = {r.key: (r.low, r.high) for r in off.groupBy("key").agg(F.min("off").alias("low"), F.max("off").alias("high")).collect()}
    spread = medians(off.select("key", F.abs("off").alias("value")))
    return {name: tuple(band_from(*(np.array([of[f"{k}:{name}"] for k in range(at, at + 3)]) for of in (middle, spread, ends)))
                        for at in range(0, 3 * len(paths), 3))
            for name in sorted({key.split(":", 1)[1] for key in counts})}


def judge_documents(measures: DataFrame, paths: dict[str, str], learned: dict[str, tuple[Learned, ...]] | None = None, *, id_col: str = "doc_id") -> DataFrame:
    """Counts, base rule, verdict and measures per row of ``measure_documents``."""
    parts, learned = parts_of(paths), learned or {}
    kind = measures.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *[f"{c} long" for c in BASE], "base_failed boolean", "kept boolean", "band string", "reasons string", *[f"{c} double" for c in parts]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, script, words, failed, *own = (batch.column(c).to_pylist() for c in ("lang", "script", "n_words", "base_failed", *parts))
            names = [x if x in BANDS or x in learned else s for x, s in zip(lang, script)]
            said = [judge(name, "", [m[k:k + 3] for k in range(0, len(m), 3)], n, learned) for name, n, m in zip(names, words, zip(*own))]
            kept = [not bad and not why for bad, (_, why) in zip(failed, said)]
            columns = [pa.array(kept, pa.bool_()), pa.array([band for band, _ in said], pa.string()), pa.array([why for _, why in said], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", *BASE, "base_failed")), *columns, *(batch.column(c) for c in parts)],
                                             names=["id", *BASE, "base_failed", "kept", "band", "reasons", *parts])

    return measures.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def fertility_rules(docs: DataFrame, paths: dict[str, str], pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str | None = "lang", learned: dict[str, tuple[Learned, ...]] | None = None) -> DataFrame:
    """Counts, base rule, measures per vocabulary (columns named by the keys of ``paths``) and verdict per document.

    ``learned`` are bands of ``fit_bands`` for the same ``paths``; without them only the fixed bands hold.
    """
    return judge_documents(measure_documents(docs, paths, pattern, id_col=id_col, text_col=text_col, lang_col=lang_col), paths, learned, id_col=id_col)
