"""Benchmark decontamination by latent semantic retrieval.

1. Distinct benchmark texts are cut into passages, each with the words around it; they are the stated query set.  Passages
   are dealt by hash into blocks, each with its own latent space, so that neither a long item nor a repeated one is ever
   held whole.  The documents are read once to count words and once to search for each ROUND_BLOCKS blocks.
2. Words are weighted by inverse document frequency, counted over *all* documents.
3. A distributed randomised SVD of the passages' TF-IDF matrix gives the latent space: Spark tasks weigh their
   passages, multiply them with a thin matrix, and Spark adds up the partial products (``gram_times``); only matrices of
   vocabulary x rank of one block reach the driver, never anything from the documents.
4. Every window of every document is looked at.  Windows whose weight lies too little in benchmark words, counted
   over documents and over passages, are skipped; the others are projected and compared with all passages by cosine.
   Besides, every run of three words that stands in a passage makes a candidate, however common its words are.
5. Candidates are proved on the words around them: the longest common subsequence with the passage must reach
   ``SURE`` of its words, or ``LIKELY`` of them while the answer is found too (paraphrases).  The answer is the
   ``answer`` column, if there is one, else the last ``ANSWER_WORDS`` words of the passage.  An item of several passages
   is proved on runs of PASSAGE words at every PROOF_STEP words around the passage, so that a quote across the border
   of two passages counts whole; ``QUOTE`` words of it in one piece are proof, too.

Only contaminated (document, item) pairs are returned, each once with its best proof, also where rows repeat an id.  Null
and empty texts match nothing, items without an id or a word are never matched; items of equal text are matched
each; texts of any length are searched whole; only ids, texts and answers are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import slices
from threadlens.plans.skew import skew_lookup
from threadlens.sources.scratch import materialize

WORD = re.compile(r"[^\W_]+")
BLOCK_PASSAGES, ROUND_BLOCKS = 512, 8
SLICE = 2 << 20        # bytes of text searched at once
SLOTS = 16             # tasks that add up the partial products of a block
PASSAGE, PASSAGE_STEP, PROOF_STEP = 64, 48, 8
QUOTE = 39             # LIKELY words of a passage
RANK, OVERSAMPLE, SEED = 256, 16, 5
WINDOWS = (20, 48)      # words; a window starts every quarter of its size
AT_ONCE = 2048         # words projected at once
MIN_MASS, MIN_COSINE = 0.25, 0.55
SURE, LIKELY, ANSWER_WORDS, ANSWER_SHARE = 0.8, 0.6, 8, 0.75


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


# Bytes that part words if all characters beyond ASCII are letters or digits; those are kept whole.
PARTS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def coded_words(text: str) -> list[bytes]:
    """The words of a text in UTF-8, cut without an expression where only ASCII characters part them."""
    text = text.lower()
    if text.isascii() or "".join(c for c in set(text) if c > "\x7f").isalnum():
        return text.encode().translate(PARTS).split()
    return [w.encode("utf-8", "surrogatepass") for w in WORD.findall(text)]


def passage_starts(n_words: int) -> list[int]:
    """Runs of at most PASSAGE words, PASSAGE_STEP apart; a short rest is part of the last run."""
    last = max(0, n_words - PASSAGE)
    return [*range(0, last, PASSAGE_STEP), last] if n_words else []


PASSAGES = "tid string, place int, start int, base int, single boolean, words array<string>, around array<string>, answer array<string>, given boolean"


def cut_passages(texts: DataFrame) -> DataFrame:
    """Passages of (tid, text, answer) rows; ``around`` holds the words of the item from ``base`` on, at most 3 * PASSAGE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tid, text, answer in zip(*(c.to_pylist() for c in batch.columns)):
                words, said = words_of(text), words_of(answer)
                starts = passage_starts(len(words))
                for at in range(0, len(starts), 512):
                    rows = []
                    for place, start in enumerate(starts[at:at + 512], at):
                        run_ = words[start:start + PASSAGE]
                        base = max(0, start - PASSAGE)
                        rows.append((tid, place, start, base, len(words) <= PASSAGE, run_, words[base:start + 2 * PASSAGE], said or run_[-ANSWER_WORDS:], bool(said)))
                    kinds = [pa.string(), *[pa.int32()] * 3, pa.bool_(), *[pa.list_(pa.string())] * 3, pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                     names=["tid", "place", "start", "base", "single", "words", "around", "answer", "given"])

    return texts.select("tid", "text", "answer").mapInArrow(run, PASSAGES)


def grams(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """One number for each run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    key = np.zeros(n, dtype=np.int64)
    for k in range(size):
        key = key * base + words[k:k + n]
    return key


def numbers(words: list[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Places of words in a vocabulary; its size for words outside."""
    return np.fromiter(map(vocabulary.get, words, repeat(len(vocabulary))), dtype=np.int32, count=len(words))


def running_sums(table: np.ndarray, rows: np.ndarray, run: int = 32) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... of the given rows of a table (some zero rows more are added at the end).

    Whole rows are added up along runs of ``run`` rows, all runs at once; then every run gets the sum of those before.
    """
    n_runs = max(1, -(-len(rows) // run))
    out = np.zeros((n_runs * run + 1, table.shape[1]), dtype=table.dtype)
    np.take(table, rows, axis=0, out=out[1:len(rows) + 1], mode="clip")  # "raise" would copy once more
    runs = out[1:].reshape(n_runs, run, -1)
    for k in range(1, run):
        runs[:, k] += runs[:, k - 1]
    runs[1:] += np.cumsum(runs[:-1, -1], axis=0)[:, None]
    return out


def seed_size(n_words: int) -> int:
    """Length of the run that a passage shares with every text holding SURE of its words in order."""
    return min(n_words, 3) if n_words not in (2, 5) else n_words // 2


def quoted(a: list[int], b: list[int], size: int) -> bool:
    """Whether ``size`` words of ``a`` stand in ``b`` in one piece."""
    a, b = ("".join(map(chr, x)) for x in (a, b))
    return any(a[k:k + size] in b for k in range(len(a) - size + 1))


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence; a row of the table is one big integer."""
    where: dict = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & where.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: set[str]) -> tuple[int, dict[str, int]]:
    """(number of documents, documents with each vocabulary word), over all documents; tasks add up first."""
    coded = {w.encode("utf-8", "surrogatepass") for w in vocabulary}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                for t in batch.column(0).slice(start, stop - start).to_pylist():
                    seen[b""] += 1
                    seen.update(coded.intersection(coded_words(t or "")))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "surrogatepass") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary of one round
    found = {r.word: r.n for r in rows}
    return found.pop("", 0), found


def gram_times(rows: DataFrame, thin: np.ndarray) -> np.ndarray:
    """Sum over passages a of a (a . thin): one multiplication with A'A; passages stay distributed, Spark adds up partial products."""
    n, width = thin.shape
    shared = rows.sparkSession.sparkContext.broadcast(thin)  # vocabulary of one block x rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        thin = shared.value
        total = np.zeros_like(thin)
        for batch in batches:
            for terms, weights in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = np.array(weights)
                total[terms] += w[:, None] * (w @ thin[terms])
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used % SLOTS, pa.int32()), pa.array(used, pa.int32()), pa.array([total[u].tobytes() for u in used], pa.binary())],
                                         names=["slot", "term", "part"])

    def add(group: pa.Table) -> pa.Table:
        terms = group["term"].to_numpy()
        parts = np.frombuffer(b"".join(group["part"].to_pylist())).reshape(len(terms), width)
        found, place = np.unique(terms, return_inverse=True)
        sums = np.zeros((len(found), width))
        np.add.at(sums, place, parts)
        return pa.table({"term": pa.array(found, pa.int32()), "part": pa.array([x.tobytes() for x in sums], pa.binary())})

    summed = rows.select("terms", "weights").mapInArrow(run, "slot int, term int, part binary").groupBy("slot").applyInArrow(add, "term int, part binary")
    out = np.zeros((n, width))
    for r in summed.collect():  # vocabulary of one block x rank
        out[r.term] = np.frombuffer(r.part)
    shared.destroy()
    return out


def randomised_svd(rows: DataFrame, n_terms: int, n_rows: int, rank: int = RANK, powers: int = 2) -> np.ndarray:
    """Right singular vectors (terms x k) of the TF-IDF rows, k at most the rank."""
    k = min(rank, n_rows, n_terms)
    basis = np.random.default_rng(SEED).normal(size=(n_terms, min(n_terms, k + OVERSAMPLE)))
    for _ in range(powers):
        basis, _ = np.linalg.qr(gram_times(rows, basis))
    small = basis.T @ gram_times(rows, basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    strong = np.argsort(values)[::-1][:k]
    return basis @ turn[:, strong[values[strong] > 1e-9 * max(1e-30, values.max())]]


@dataclass
class LatentIndex:
    """What a search task needs of one block of the benchmark."""

    vocabulary: dict[str, int]
    idf: np.ndarray                 # one entry more: words outside the vocabulary
    space: np.ndarray               # terms x k, idf folded in; last row 0
    points: np.ndarray              # passages x k, unit length
    items: list[str]                # text of each passage
    words: list[list[int]]          # passage words as vocabulary numbers
    answers: list[list[int]]
    given: list[bool]               # whether the passage's item has an answer of its own, else the last words
    rarity: np.ndarray              # as idf, but over the passages
    bases: list[int | None]         # where ``around`` begins in the item; None for an item of one passage
    around: list[list[int]]         # words of the item around the passage
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # length of run: (sorted keys, place after each key's last, passages)

    def __post_init__(self) -> None:
        self.sizes = [len(w) for w in self.words]

    def windows(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int, float]]]:
        """Per text the (passage, first word, end, cosine) of all windows near a passage; the last window of a size ends with the text.

        A window is the difference of two running sums over its words in the latent space.  Running sums are taken
        anew every AT_ONCE words, so they stay small and exact enough; words outside the vocabulary add nothing.
        """
        out: list[list] = [[] for _ in texts]
        ids = np.concatenate([*texts, np.empty(0, np.int64)])
        offsets = np.cumsum([0, *map(len, texts)])
        known = ids < len(self.vocabulary)
        shares = []
        for weights in (self.idf, self.rarity):
            mass = weights[ids] ** 2
            shares.append([np.concatenate([[0.0], np.cumsum(x)]) for x in (mass, np.where(known, mass, 0.0))])
        upto, words = np.concatenate([[0], np.cumsum(known)]), ids[known]
        lengths, near = np.diff(offsets), []
        for size in WINDOWS:
            step = size // 4
            last = np.maximum(0, lengths - size)
            regular = -(-last // step)
            owner = np.repeat(np.arange(len(texts)), regular + 1)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(regular + 1) - regular - 1, regular + 1)
            starts = offsets[owner] + np.where(number < regular[owner], number * step, last[owner])
            ends = np.minimum(starts + size, offsets[owner + 1])
            share = np.maximum(*((k[ends] - k[starts]) / np.maximum(1e-12, m[ends] - m[starts]) for m, k in shares))
            keep = (share >= MIN_MASS) & (upto[ends] > upto[starts])
            near.append((owner[keep], starts[keep], ends[keep]))
        owner, starts, ends = map(np.concatenate, zip(*near))
        low, high = upto[starts], upto[ends]
        order = np.argsort(low // AT_ONCE, kind="stable")
        cuts = np.flatnonzero(np.diff(low[order] // AT_ONCE, prepend=-1, append=-1))
        for first, stop in zip(cuts, cuts[1:]):
            part = order[first:stop]
            base, top = int(low[part[0]] // AT_ONCE * AT_ONCE), int(high[part].max())
            running = running_sums(self.space, words[base:top])
            x = running[high[part] - base]
            x -= running[low[part] - base]
            norm = np.maximum(1e-12, np.sqrt(np.einsum("ij,ij->i", x, x)))
            dots = x @ self.points.T
            likely = np.flatnonzero(dots.max(axis=1) >= MIN_COSINE * norm)
            cosine = dots[likely] / norm[likely, None]
            for w, p in np.argwhere(cosine >= MIN_COSINE).tolist():
                k = part[likely[w]]
                at = offsets[owner[k]]
                out[owner[k]].append((p, int(starts[k] - at), int(ends[k] - at), float(cosine[w, p])))
        return out

    def seeded(self, ids: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(passage, first word, end, cosine) of all runs of words that stand in a passage; places near each other once."""
        out = []
        for size, (keys, ends, owners) in self.seeds.items():
            here = grams(ids, size, len(self.vocabulary) + 1)
            at = np.minimum(np.searchsorted(keys, here), len(keys) - 1)
            hits = np.flatnonzero(keys[at] == here)
            last: dict[int, int] = {}
            for s, k in zip(hits.tolist(), at[hits].tolist()):
                for p in owners[ends[k - 1] if k else 0:ends[k]].tolist():
                    if s - last.get(p, -size) >= size:  # every word of the run lies in a region already, or begins one
                        last[p] = s
                        x, y = self.space[ids[s:s + size]].sum(axis=0), self.points[p]
                        out.append((p, s, s + size, float(x @ y) / max(1e-12, float(np.linalg.norm(x)))))
        return out

    def share(self, p: int, region: list[int]) -> tuple[float, bool, bool]:
        """(share in common, answer found, quoted in one piece) of a passage or of the best run around it in its item."""
        inside, best, low = set(region), (0.0, False, False), self.bases[p]
        if low is None:
            runs = [self.words[p]]
        else:
            high = low + len(self.around[p])
            firsts = {*range(-(-low // PROOF_STEP) * PROOF_STEP, high - PASSAGE + 1, PROOF_STEP), low, high - PASSAGE}
            runs = [self.around[p][s - low:s - low + PASSAGE] for s in sorted(firsts)]
        for run in runs:
            if sum(map(inside.__contains__, run)) < LIKELY * len(run):
                continue  # an upper bound of the common subsequence
            share = common_length(run, region) / len(run)
            if share < LIKELY:
                continue
            answer = self.answers[p] if self.given[p] or len(runs) == 1 else run[-ANSWER_WORDS:]
            found = bool(answer) and common_length(answer, region) >= ANSWER_SHARE * len(answer)
            piece = len(runs) > 1 and share < SURE and not found and quoted(run, region, QUOTE)
            best = max(best, (share, found, piece), key=lambda x: (x[0] >= SURE or x[1] or x[2], x))
        return best

    def search(self, keys: list, texts: list[np.ndarray]) -> Iterator[tuple]:
        """(key, proof) of all proven passages of texts of this block's numbers."""
        for key, ids, windows in zip(keys, texts, self.windows(texts)):
            for hit in self.prove(ids, windows):
                yield key, hit

    def prove(self, ids: np.ndarray, windows: list[tuple[int, int, int, float]]) -> list[tuple]:
        """(item, cosine, share of the passage in common, answer found, first word) of proven passages, best per item."""
        regions: dict[int, list] = {}
        sizes, n = self.sizes, len(ids)
        for p, s, e, cosine in sorted(self.seeded(ids) + windows):
            size = sizes[p]
            low, high = e - size, s + size
            low, high = s if s < low else low if low > 0 else 0, e if e > high else high if high < n else n
            runs = regions.setdefault(p, [])
            if runs and low <= (last := runs[-1])[1] and high - last[0] <= 4 * (size if size > PASSAGE else PASSAGE):
                if high > last[1]:
                    last[1] = high
                if cosine > last[2]:
                    last[2] = cosine
            else:
                runs.append([low, high, cosine])
        best: dict = {}
        for p, runs in regions.items():
            for low, high, cosine in runs:
                share, found, piece = self.share(p, ids[low:high].tolist())
                if share >= SURE or found or piece:
                    mine = (share, cosine, found, low)
                    best[self.items[p]] = max(best.get(self.items[p], mine), mine)
        return [(item, b[1], b[0], b[2], b[3]) for item, b in best.items()]


def build_index(block: DataFrame, n: int, seen: dict[str, int], rank: int = RANK) -> LatentIndex | None:
    """Index of the passages of one block; ``seen`` of ``n`` documents hold each word."""
    found = block.collect()  # one block: some BLOCK_PASSAGES passages of at most 3 * PASSAGE words
    if not found:
        return None
    vocabulary = {w: k for k, w in enumerate(sorted({w for r in found for w in (*r.around, *r.answer)}))}
    idf = np.log((1.0 + n) / (1.0 + np.array([seen.get(w, 0) for w in vocabulary]))) + 0.05
    idf = np.append(idf, np.quantile(idf, 0.75))  # words outside the vocabulary weigh like its content words
    numbered = [[vocabulary[w] for w in r.words] for r in found]
    held = np.bincount([t for p in numbered for t in set(p)], minlength=len(vocabulary))
    rarity = np.log((1.0 + len(found)) / (1.0 + held)) + 0.05
    rarity = np.append(rarity, np.quantile(rarity, 0.75))
    space = randomised_svd(weighted(block, vocabulary, idf), len(vocabulary), len(found), rank)
    space = np.concatenate([space * idf[:-1, None], np.zeros((1, space.shape[1]))])
    points = np.stack([space[p].sum(axis=0) for p in numbered])
    points /= np.maximum(1e-12, np.linalg.norm(points, axis=1, keepdims=True))
    return LatentIndex(vocabulary, idf, space.astype(np.float32), points.astype(np.float32), [r.tid for r in found], numbered,
                       [[vocabulary[w] for w in r.answer] for r in found], [r.given for r in found], rarity, [None if r.single else r.base for r in found],
                       [[vocabulary[w] for w in r.around] for r in found], seeds_of(numbered, len(vocabulary) + 1))


def weighted(block: DataFrame, vocabulary: dict[str, int], idf: np.ndarray) -> DataFrame:
    """(terms, weights): TF-IDF rows of a block's passages, made where the passages lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(vocabulary[w] for w in words) for words in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([list(c) for c in counts], pa.list_(pa.int32())),
                                              pa.array([[float(f * idf[t]) for t, f in c.items()] for c in counts], pa.list_(pa.float64()))], names=["terms", "weights"])

    return materialize(block.select("words").mapInArrow(run, "terms array<int>, weights array<double>"), "weighted")


def seeds_of(numbered: list[list[int]], base: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of words of all passages by their length; see ``LatentIndex.seeds``."""
    pairs: dict[int, set] = {}
    for p, words in enumerate(numbered):
        size = seed_size(len(words))
        pairs.setdefault(size, set()).update((key, p) for key in grams(np.array(words), size, base).tolist())
    out = {}
    for size, found in pairs.items():
        flat = np.array(sorted(found), dtype=np.int64)
        keys, counts = np.unique(flat[:, 0], return_counts=True)
        out[size] = keys, np.cumsum(counts), flat[:, 1]
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None,
                       block_passages: int = BLOCK_PASSAGES, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """(doc id, item id, cosine, common_share, answer_found, first_word) of every contaminated pair."""
    spark = docs.sparkSession
    answer = F.col(answer_col) if answer_col else F.lit(None)
    # null ids and empty texts stand for no item
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text"), answer.cast("string").alias("answer")) \
        .where("item is not null and text is not null").withColumn("tid", F.sha2(F.to_json(F.struct("text", "answer")).cast("binary"), 256))
    texts = items.groupBy("tid").agg(F.first("text").alias("text"), F.first("answer").alias("answer"))
    cut = materialize(cut_passages(texts), "passages")
    half = max(1, block_passages // 2)
    blocks = -(-cut.count() // half)  # half full on average, so that a hashed block keeps near the bound
    cut = cut.withColumn("block", F.pmod(F.xxhash64("tid", F.floor(F.col("place") / half)), F.lit(max(1, blocks))))
    id_kind = docs.schema[id_col].dataType
    schema = f"d {id_kind.simpleString()}, tid string, cosine double, common_share double, answer_found boolean, first_word int"
    source = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t"))
    found = spark.createDataFrame([], schema)
    for first in range(0, blocks, max(1, round_blocks)):
        mine = cut.where((F.col("block") >= first) & (F.col("block") < first + round_blocks))
        vocabulary = {r.w for r in mine.select(F.explode(F.array_union("around", "answer")).alias("w")).distinct().collect()}  # words of one round
        n, seen = document_frequencies(source, "t", vocabulary)
        indexes = [build_index(mine.where(F.col("block") == b), n, seen) for b in range(first, min(blocks, first + round_blocks))]
        ordered = sorted(vocabulary)
        common = {w.encode("utf-8", "surrogatepass"): k for k, w in enumerate(ordered)}
        turned = [(np.array([x.vocabulary.get(w, len(x.vocabulary)) for w in [*ordered, ""]], dtype=np.int32), x) for x in indexes if x]
        shared = spark.sparkContext.broadcast((common, turned))  # vocabulary x rank of each block of a round

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type
            kind = [to_arrow_type(id_kind), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.int32()]
            common, turned = shared.value
            for batch in batches:
                for start, stop in slices(batch.column(1), SLICE):
                    part = batch.slice(start, stop - start)
                    rows = [(d, numbers(coded_words(t), common)) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if t]
                    keys, texts = [d for d, _ in rows], [x for _, x in rows]
                    hits = [(d, *hit) for own, index in turned for d, hit in index.search(keys, [own[x] for x in texts])]
                    yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in hits], kind[k]) for k in range(6)],
                                                     names=["d", "tid", "cosine", "common_share", "answer_found", "first_word"])

        found = found.unionByName(materialize(source.mapInArrow(run, schema), "contaminated"))
        shared.destroy()
    # a text may be held by very many documents, and by several items
    named = items.groupBy("tid").agg(F.collect_set("item").alias("items"))
    pairs = skew_lookup(found, named, "tid", "tid", spread="d", how="inner").withColumn("item", F.explode("items"))
    best = pairs.groupBy("d", "item").agg(F.max(F.struct("common_share", "cosine", "answer_found", "first_word")).alias("b"))
    return best.select(F.col("d").alias(id_col), F.col("item").alias(item_col), "b.cosine", "b.common_share", "b.answer_found", "b.first_word")
