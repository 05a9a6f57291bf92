"""Document quality by Bradley-Terry pairwise ranking.

Preference pairs (a document of label 1 is preferred to one of label 0) give a linear score: the probability
that a is preferred is the logistic of the score difference, so weights are fitted by logistic loss on
*feature differences*, over all pairs of all labelled documents.  Documents are then accepted above a quantile of the scores: the cut
lies half-way between the low quantile of preferred and the high quantile of rejected training documents, or at the former
where they overlap.  ``score`` is the logistic of the distance to the cut, so 0.5 is the cut.

A text has surface features (``FEATURES``, from byte histograms and word counts) and hashed ones: the shares of its words
in ``BUCKETS`` buckets and of its runs of four bytes in as many, so that a score also sees which words occur and how
they are spelled.  Shares enter by their square root, all features standardised; hashed ones carry a stronger penalty.
The fit takes Newton steps over a written table of features.  The pull of all pairs on a row depends on its score and on how the
other label's scores are spread, so a step counts scores in ``CELLS`` cells and then sums rows up; its work grows with the rows,
not with the pairs.  The quantiles of the cut are exact, of the scores of all rows by a fit on the other half of the rows.
``fit_pairs`` is the same fit on arrays, with ``PAIRS`` random pairs; ``training_rows`` are a few rows for it.  No query uses them.

Null and empty texts have all features 0 but ``is_empty``, and get score 0.  Rows without a label, and ids with
contradicting labels, are not learned from; of rows that repeat an id one is.  Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import first_rows, slices, values_at
from threadlens.llm.near_dedup import Shingler
from threadlens.sources.scratch import materialize

FEATURES = ["symbols", "marks", "upper", "digits", "repeated_next", "distinct_share", "long_words", "short_lines",
            "repeated_lines", "letters", "word_length", "is_empty"]
PER_CLASS, PAIRS, SEED = 4000, 40_000, 11
LOW_QUANTILE, HIGH_QUANTILE = 0.002, 0.98
BUCKETS = 256          # of words, and of runs of four bytes
SLICE = 1 << 18        # bytes of text described at once
RIDGE, HASHED_RIDGE, STEPS = 1e-3, 1e-1, 60
FITS, CELLS, COARSE, STILL = 3, 4096, 64, 1e-4  # all rows and each half of them; cells of scores, of sums; largest move that ends the steps
REACH = 40.0           # scores beyond it count as that far: no chance of a pair changes there
PARTS, PART_ROWS = 64, 4096  # tasks of a pass at most, each of which hands over one packed matrix a fit; rows that are worth one
WIDTH = len(FEATURES) + 2 * BUCKETS
EMPTY = FEATURES.index("is_empty")

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>{}[]=+~^\\@_/", dtype=np.uint8))
MARKS = np.isin(np.arange(256), np.frombuffer(b"!?", dtype=np.uint8))


def describe(text: str | None) -> list[float]:
    """The features of one text, each between 0 and 1."""
    words = (text or "").split()
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    count = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    n, low, up = len(words), int(count[97:123].sum()), int(count[65:91].sum())
    high = int(count[128:].sum())
    seen = int(count.sum()) - int(count[[9, 10, 11, 12, 13, 32]].sum())
    same = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    return [int(count[SYMBOLS].sum()) / seen, int(count[MARKS].sum()) / seen, up / max(1, up + low), int(count[48:58].sum()) / seen,
            same / n, (len(set(words)) / n) ** 0.5 if n >= 20 else 1.0, sum(len(w) > 30 for w in words) / n,
            sum(len(x) < 12 for x in lines) / len(lines), 1 - len(set(lines)) / len(lines), (low + up + high) / seen,
            min(1.0, seen / n / 20), 0.0]


def shares(buckets: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Square roots of the shares of each owner's numbers in BUCKETS buckets."""
    counts = np.bincount(owner * BUCKETS + buckets, minlength=n * BUCKETS).reshape(n, BUCKETS)
    return np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True))).astype(np.float32)


def run_buckets(data: np.ndarray) -> np.ndarray:
    """Buckets of all runs of four bytes, by multiplying them as one number."""
    code = np.zeros(max(0, len(data) - 3), dtype=np.uint32)
    for k in range(4):
        code = code << np.uint32(8) | data[k:len(data) - 3 + k]
    return (code * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.int64)


def describe_all(texts: list[str | None], shingler: Shingler) -> np.ndarray:
    """float32 features of many texts: surface, words, runs of bytes (in lower case, within a text)."""
    n = len(texts)
    hashes, firsts = shingler.words(texts)
    words = shares((hashes & np.uint64(BUCKETS - 1)).astype(np.int64), np.repeat(np.arange(n), np.diff(firsts)), n)
    raw = [(t or "").encode().lower() for t in texts]
    owner = np.repeat(np.arange(n), [len(r) for r in raw])
    buckets = run_buckets(np.frombuffer(b"".join(raw), dtype=np.uint8))
    inside = owner[:len(buckets)] == owner[len(owner) - len(buckets):]  # first and last byte of one text
    runs = shares(buckets[inside], owner[:len(buckets)][inside], n)
    return np.concatenate([np.array([describe(t) for t in texts], dtype=np.float32).reshape(n, len(FEATURES)), words, runs], axis=1)


def feature_column(text: Column) -> Column:
    """Features of a text column as float32 bytes."""

    @F.arrow_udf(T.BinaryType())
    def features(texts: pa.Array) -> pa.Array:
        shingler = Shingler(1)
        return pa.array([row.tobytes() for start, stop in slices(texts, SLICE) for row in describe_all(texts.slice(start, stop - start).to_pylist(), shingler)], pa.binary())

    return features(text.cast("string"))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ranker:
    """Standardised linear score, its cut, and the spread that one unit of log-odds has."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.where(x[:, EMPTY] > 0, 0.0, logistic(self.raw(x) - self.cut))


def fit_weights(good: np.ndarray, bad: np.ndarray, pairs: int, seed: int) -> np.ndarray:
    """Newton steps on the ridge-penalised logistic loss of feature differences over random preference pairs."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, len(good), pairs), rng.integers(0, len(bad), pairs)
    width = good.shape[1]
    ridge = np.where(np.arange(width) < len(FEATURES), RIDGE, HASHED_RIDGE)
    w = np.zeros(width)
    for _ in range(STEPS):
        gradient, hessian = ridge * w, np.diag(ridge)
        for at in range(0, pairs, 4096):  # differences of a few thousand pairs at once
            gap = good[a[at:at + 4096]] - bad[b[at:at + 4096]]
            p = logistic(-(gap @ w))
            gradient = gradient - gap.T @ p / pairs
            hessian = hessian + (gap * (p * (1 - p))[:, None]).T @ gap / pairs
        move = np.linalg.solve(hessian, gradient)
        w = w - move * min(1.0, 2.0 / max(1e-12, float(np.abs(move).max())))
        if np.abs(move).max() < 1e-4:
            break
    return w


def fit_pairs(good: np.ndarray, bad: np.ndarray, *, pairs: int = PAIRS, seed: int = SEED) -> Ranker:
    """Weights from all rows; the cut from scores of each half of the rows by a fit on the other half."""
    if not len(good) or not len(bad):
        return Ranker(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0)
    both = np.concatenate([good, bad])
    ranker = Ranker(both.mean(axis=0, dtype=float), both.std(axis=0, dtype=float) + 1e-2, np.zeros(WIDTH), 0.0)
    good, bad = (np.clip((x - ranker.mean) / ranker.scale, -8, 8) for x in (good, bad))
    ranker.weights = fit_weights(good, bad, pairs, seed)
    seen = [[], []]
    for k in range(2):
        learn = [x[k::2] if len(x) > 1 else x for x in (good, bad)]
        w = fit_weights(*learn, pairs // 4, seed + 1 + k)
        for held, x in zip(seen, (good, bad)):
            held.append((x[1 - k::2] if len(x) > 1 else x) @ w)
    low, high = np.quantile(np.concatenate(seen[0]), LOW_QUANTILE), np.quantile(np.concatenate(seen[1]), HIGH_QUANTILE)
    ranker.cut = float((low + high) / 2 if high < low else low)
    return ranker


def agreed_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(i, y): ids whose labels agree."""
    return (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("i"))
            .agg(F.min(label_col).alias("y"), F.max(label_col).alias("z")).where("y = z").select("i", "y"))


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str,
                  per_class: int = PER_CLASS) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of a bounded sample of each label."""
    agreed = agreed_labels(labels, id_col, label_col)
    ids = first_rows(docs.select(F.col(id_col).alias("i")).distinct().join(agreed, "i"), "y", [F.xxhash64("i"), "i"], per_class)
    rows = (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .join(F.broadcast(ids), "i")  # at most 2 * per_class ids
            .select("i", "y", feature_column(F.col("t")).alias("x")).groupBy("i", "y").agg(F.max("x").alias("x")).orderBy("i").collect())
    pick = [np.frombuffer(b"".join(bytes(r.x) for r in rows if r.y == y), dtype=np.float32).reshape(-1, WIDTH) for y in (1, 0)]
    return pick[0], pick[1]


def feature_table(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(y, half, x): features of every labelled id, written; of rows that repeat an id one is kept."""
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(agreed_labels(labels, id_col, label_col), "i")
    once = rows.select("i", "y", feature_column(F.col("t")).alias("x")).groupBy("i", "y").agg(F.max("x").alias("x"))
    return materialize(once.select(F.col("y").cast("int").alias("y"), F.pmod(F.xxhash64("i"), F.lit(2)).cast("int").alias("half"), "x"), "quality-features")


def matrices(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(labels, halves, features) of some rows at once."""
    for at in range(0, part.num_rows, 2048):
        some = part.slice(at, 2048)
        x = np.frombuffer(b"".join(some.column("x").to_pylist()), dtype=np.float32).reshape(-1, WIDTH)
        yield some.column("y").to_numpy(), some.column("half").to_numpy(), x


def learned_by(fit: int, halves: np.ndarray) -> np.ndarray:
    """Rows that a fit learns from: all for the first, those of its half for the others."""
    return np.ones(len(halves), dtype=bool) if fit == 0 else halves == fit - 1


def add_up(rows: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]], parts: int = PARTS) -> dict[str, np.ndarray]:
    """Sums over all tasks of the named arrays that ``task`` makes of its rows; at most ``parts`` tasks hand any over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = task(batches)
        yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([v.astype(float).tobytes() for v in found.values()], pa.binary())], names=["name", "sums"])

    def merged(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, dtype=float) for v in group["sums"].to_pylist())
        return pa.table({"name": pa.array([key[0].as_py()]), "sums": pa.array([total.tobytes()], pa.binary())})

    sums = rows.coalesce(parts).mapInArrow(run, "name string, sums binary")
    return {r.name: np.frombuffer(r.sums, dtype=float) for r in sums.groupBy("name").applyInArrow(merged, "name string, sums binary").collect()}


def moments(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    out = {f"n{y}{h}": np.zeros(1) for y in (0, 1) for h in (0, 1)} | {"sum": np.zeros(WIDTH), "square": np.zeros(WIDTH)}
    for batch in batches:
        for y, half, x in matrices(batch):
            out["sum"] += x.sum(axis=0, dtype=float)
            out["square"] += (x.astype(float) ** 2).sum(axis=0)
            for a in (0, 1):
                for h in (0, 1):
                    out[f"n{a}{h}"] += ((y == a) & (half == h)).sum()
    return out


def cells_of(scores: np.ndarray) -> np.ndarray:
    return np.clip(((scores + REACH) * (CELLS / (2 * REACH))).astype(int), 0, CELLS - 1)


def pulls(scores: np.ndarray, counts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean chance that the other label's rows stand above, its slope) at each score; both are smooth, so read off a fine grid."""
    grid = np.linspace(scores.min(), scores.max(), 2048) if len(scores) > 2048 else scores
    held = counts > 0
    p = logistic(places[held][None, :] - grid[:, None])
    share = counts[held] / max(1.0, counts.sum())
    chance, slope = p @ share, (p * (1 - p)) @ share
    return (chance, slope) if grid is scores else (np.interp(scores, grid, chance), np.interp(scores, grid, slope))


def newton_steps(rows: DataFrame, ranker: Ranker, start: np.ndarray, fits: list[int], sizes: dict[tuple[int, int], float]) -> np.ndarray:
    """(FITS x features) weights at the optimum of the penalised mean loss over all pairs, all fits side by side.

    ``sizes`` counts the rows of (fit, label).  A task gets PART_ROWS rows at least, so that its matrices are smaller than its rows,
    however many files these lie in.
    """
    parts = max(1, min(PARTS, int(sizes[0, 0] + sizes[0, 1]) // PART_ROWS))
    ridge = np.where(np.arange(WIDTH) < len(FEATURES), RIDGE, HASHED_RIDGE)
    weights, moving = start.copy(), list(fits)
    upper = np.triu_indices(WIDTH)

    def scaled(x: np.ndarray) -> np.ndarray:
        return np.clip((x - ranker.mean) / ranker.scale, -8, 8)

    for _ in range(STEPS):
        now, w = list(moving), weights.copy()

        def ends(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
            """Counts and sums of scores in cells."""
            out = {f"{kind}{f}{y}": np.zeros(CELLS) for f in now for y in (0, 1) for kind in ("count", "sum")}
            for batch in batches:
                for y, half, x in matrices(batch):
                    scores = scaled(x) @ w.T
                    for f in now:
                        for a in (0, 1):
                            own = scores[(y == a) & learned_by(f, half), f]
                            cell = cells_of(own)
                            out[f"count{f}{a}"] += np.bincount(cell, minlength=CELLS)
                            out[f"sum{f}{a}"] += np.bincount(cell, weights=own, minlength=CELLS)
            return out

        spread = add_up(rows, ends, parts)
        places = {(f, y): spread[f"sum{f}{y}"] / np.maximum(1.0, spread[f"count{f}{y}"]) for f in now for y in (0, 1)}
        counts = {(f, y): spread[f"count{f}{y}"] for f in now for y in (0, 1)}
        # coarse cells of equal shares of all scores, for the part of the Hessian that crosses the labels
        edges = {}
        for f in now:
            both = np.cumsum(counts[f, 0] / sizes[f, 0] + counts[f, 1] / sizes[f, 1])
            edges[f] = np.minimum((both / both[-1] * COARSE).astype(int), COARSE - 1)

        def slopes(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
            out = {f"g{f}": np.zeros(WIDTH) for f in now} | {f"h{f}": np.zeros((WIDTH, WIDTH)) for f in now}
            out |= {f"x{f}{y}": np.zeros((COARSE, WIDTH)) for f in now for y in (0, 1)}
            for batch in batches:
                for y, half, x in matrices(batch):
                    z = scaled(x)
                    for f in now:
                        for a in (0, 1):
                            own = z[(y == a) & learned_by(f, half)]
                            if not len(own):
                                continue
                            scores = own @ w[f]
                            if a:  # a good row is pulled up by the bad rows that stand above it
                                chance, slope = pulls(scores, counts[f, 0], places[f, 0])
                            else:
                                chance, slope = pulls(-scores, counts[f, 1], -places[f, 1])
                            out[f"g{f}"] += (chance @ own) * (-1 if a else 1) / sizes[f, a]
                            out[f"h{f}"] += (own * (slope / sizes[f, a])[:, None]).T @ own
                            at = edges[f][cells_of(scores)]
                            np.add.at(out[f"x{f}{a}"], at, own / sizes[f, a])
            return {k: v[upper] if k[0] == "h" else v.ravel() for k, v in out.items()}

        sums = add_up(rows, slopes, parts)
        for f in now:
            own = np.zeros((WIDTH, WIDTH))
            own[upper] = sums[f"h{f}"]
            own = own + np.triu(own, 1).T
            middle = {y: np.bincount(edges[f], weights=counts[f, y] * places[f, y], minlength=COARSE)
                      / np.maximum(1.0, np.bincount(edges[f], weights=counts[f, y], minlength=COARSE)) for y in (0, 1)}
            p = logistic(middle[0][None, :] - middle[1][:, None])
            good, bad = (sums[f"x{f}{y}"].reshape(COARSE, WIDTH) for y in (1, 0))
            cross = good.T @ (p * (1 - p)) @ bad
            hessian = own - cross - cross.T + np.diag(ridge)
            move = np.linalg.solve(hessian, ridge * w[f] + sums[f"g{f}"])
            weights[f] -= move * min(1.0, 2.0 / max(1e-12, float(np.abs(move).max())))
            if np.abs(move).max() < STILL:
                moving.remove(f)
        if not moving:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranker:
    """The ranker of all pairs of all labelled rows, and its cut."""
    names = {"id_col": id_col, "text_col": text_col, "label_col": label_col}
    rows = feature_table(docs, labels, **names)
    found = add_up(rows, moments)
    n = {(y, h): float(found[f"n{y}{h}"][0]) for y in (0, 1) for h in (0, 1)} if found else {}
    sizes = {(0, y): n[y, 0] + n[y, 1] for y in (0, 1)} if n else {}
    if not n or not sizes[0, 0] or not sizes[0, 1]:
        return fit_pairs(np.empty((0, WIDTH)), np.empty((0, WIDTH)))
    sizes |= {(1 + h, y): n[y, h] for h in (0, 1) for y in (0, 1)}
    total = sizes[0, 0] + sizes[0, 1]
    mean = found["sum"] / total
    ranker = Ranker(mean, np.sqrt(np.maximum(0.0, found["square"] / total - mean ** 2)) + 1e-2, np.zeros(WIDTH), 0.0)
    fits = [f for f in range(FITS) if sizes[f, 0] and sizes[f, 1]]
    weights = newton_steps(rows, ranker, np.zeros((FITS, WIDTH)), fits, sizes)
    ranker.weights = weights[0]
    judges = [weights[2 - h] if 2 - h in fits else weights[0] for h in (0, 1)]  # each half by the fit on the other one

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores of texts with words; the others get score 0, whatever the cut."""
        for batch in batches:
            for y, half, x in matrices(batch):
                told = x[:, EMPTY] == 0
                z = np.clip((x - ranker.mean) / ranker.scale, -8, 8)
                yield pa.RecordBatch.from_arrays([pa.array(y[told].astype(str), pa.string()), pa.array(np.where(half == 0, z @ judges[0], z @ judges[1])[told])], names=["key", "value"])

    scores = materialize(rows.mapInArrow(held_out, "key string, value double"), "held-out-scores")
    counts = {r.key: r["count"] for r in scores.groupBy("key").count().collect()}
    places = {y: share * (counts[y] - 1) for y, share in (("1", LOW_QUANTILE), ("0", HIGH_QUANTILE)) if y in counts}
    at = values_at(scores, {y: (int(np.floor(p)), int(np.ceil(p))) for y, p in places.items()})
    cuts = {y: at[y, int(np.floor(p))] + (p - np.floor(p)) * (at[y, int(np.ceil(p))] - at[y, int(np.floor(p))]) for y, p in places.items()}
    low = cuts.get("1", cuts.get("0", 0.0))
    high = cuts.get("0", low)
    ranker.cut = float((low + high) / 2 if high < low else low)
    return ranker


def score_column(text: Column, ranker: Ranker) -> Column:
    """Quality score between 0 and 1 of a text column."""

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        shingler = Shingler(1)
        out = [ranker.score(describe_all(texts.slice(start, stop - start).to_pylist(), shingler)) for start, stop in slices(texts, SLICE)]
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return score(text.cast("string"))
