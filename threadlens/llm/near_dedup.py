"""MinHash near-duplicate detection on word shingles.

1. Every text becomes the set of its distinct five-word shingles (64-bit hashes), and some 400 universal hash
   minima of that set at most (``banding``).  Rows with equal sets form one class; its smallest id stands for it.
2. Bands of minima put class representatives into buckets.  Their number and width follow from the threshold, so
   that a pair at it shares no bucket with probability 1e-5 at most, a more similar pair with less: 44 bands of 9 at
   0.85, (1 - 0.85**9)**44 = 9e-6, and 49 bands of 7 at 0.80.
3. Every member of a bucket meets the smallest one.  Pairs pass size and signature estimates and are confirmed
   on the full sets; links join components.  This settles groups of copies, however large, with one pair each.
4. Buckets that still hold several components are dealt out in cells of bounded size (pairs of blocks), where
   signatures of documents from *different* components are compared.  Only pairs that can reach the threshold
   leave a cell, each from the first band it shares, and are confirmed on the full sets.
5. Components are the fixed point of alternating large-star and small-star steps over the links.

A pair whose signatures agree in less than 4.5 standard deviations below the threshold is not confirmed on
sets; at the threshold that has a probability of about 3e-6.  No bucket, cell or partner count is capped.

Null, empty and blank texts have an empty set and stay alone.  Texts of fewer than five words have one
shingle, the whole sequence.  Rows that repeat an id are one node of the links, and each gets the component of
its own text.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import slices
from threadlens.sources.scratch import materialize

WIDTH = 5
MISSED, MOST_MINIMA = 1e-5, 400
DEVIATIONS = 4.5
BLOCK = 512            # documents of one side of a cell
SLICE = 1 << 20        # bytes of text hashed at once
HASHED = 1 << 18       # bytes of text whose words are hashed at once
SEED = 20_011

SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
FOLD = np.arange(256) + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing generator (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of texts, a slice of texts at a time.

    A word's hash is the sum of one mixed 64-bit number for each byte and its place in the word, mixed again;
    with ``fold``, upper-case ASCII counts as lower case.  No algebra of a base relates the numbers of different
    places, so words of a regular build collide no more often than any others.
    """

    def __init__(self, width: int = WIDTH, fold: bool = True):
        self.width = width
        self.bytes = (FOLD if fold else np.arange(256)).astype(np.uint64)
        self.odd = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes of all texts, position of every text's first word with the total at the end)."""
        raw = [(t or "").encode() for t in texts]
        found, firsts, total, start, size = [], [np.zeros(1, np.int64)], 0, 0, 0
        for k, r in enumerate(raw, 1):  # few bytes at once: every one of them takes several numbers of eight
            size += len(r)
            if size >= HASHED or k == len(raw):
                hashes, places = self.hash_words(raw[start:k])
                found.append(hashes), firsts.append(places[1:] + total)
                total, start, size = total + len(hashes), k, 0
        return np.concatenate([*found, np.empty(0, np.uint64)]), np.concatenate(firsts)

    def hash_words(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        inside = np.concatenate([[False], ~SPACE[data]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
        begins = np.cumsum(lengths) - lengths
        places = np.arange(lengths.sum()) - np.repeat(begins, lengths)
        numbers = mix((self.bytes[data[inside[1:]]] | (places.astype(np.uint64) + np.uint64(1)) << np.uint64(8)) * np.uint64(0x9E3779B97F4A7C15))
        hashes = mix(np.add.reduceat(numbers, begins)) if len(starts) else np.empty(0, dtype=np.uint64)
        return hashes, np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raw)]))

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text the sorted distinct uint64 shingle hashes."""
        h, firsts = self.words(texts)
        n = max(0, len(h) - self.width + 1)
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(self.width):
            rolled += h[k:k + n] * self.odd[k]
        rolled = mix(rolled)
        out = []
        for low, high in zip(firsts.tolist(), firsts[1:].tolist()):
            if high - low >= self.width:
                out.append(np.unique(rolled[low:high - self.width + 1]))
            elif high == low:
                out.append(np.empty(0, dtype=np.uint64))
            else:  # one shingle, which also says how many words it has
                total = np.full(1, high - low, dtype=np.uint64)
                for k in range(high - low):
                    total = mix(total + h[low + k:low + k + 1] * self.odd[k])
                out.append(total)
        return out


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the universal hash functions x -> (a x + b) mod 2**32."""
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 1 << 31, n, dtype=np.uint32) << 1) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """uint32 minimum of each hash function over the set, in blocks that stay in the processor's cache."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    room = np.empty((64, len(a)), dtype=np.uint32)
    for at in range(0, len(x), 64):
        part = x[at:at + 64, None]
        block = room[:len(part)]
        np.multiply(part, a, out=block)
        np.add(block, b, out=block)
        np.minimum(least, np.minimum.reduce(block, axis=0), out=least)
    return least


@lru_cache
def banding(percent: int) -> tuple[int, int]:
    """(bands, minima in each): the widest bands that miss a pair at the threshold with probability MISSED at most."""
    found = (1, 1)  # equal sets agree in everything
    for width in range(1, MOST_MINIMA + 1) if percent < 100 else ():
        bands = math.ceil(math.log(MISSED) / math.log1p(-(percent / 100) ** width))
        if bands * width > MOST_MINIMA and width > 1:
            break
        found = (bands, width)
    return found


def band_hashes(least: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    rows = least.reshape(bands, -1).astype(np.uint64)
    key = mix(np.arange(bands, dtype=np.uint64))
    for k in range(rows.shape[1]):
        key = mix(key * np.uint64(31) + rows[:, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = 85) -> DataFrame:
    """(id, n_shingles, set_key, signature, bands) per row; the last three are null for empty sets.

    The signature keeps the lowest byte of every minimum, bands their 64-bit keys.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    bands, band_rows = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, (a, b) = Shingler(width), coefficients(bands * band_rows)
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE):
                sets = shingler.sets(batch.column(1).slice(start, stop - start).to_pylist())
                least = [minima(s, a, b) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, stop - start), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([None if m is None else m.astype(np.uint8).tobytes() for m in least], pa.binary()),
                    pa.array([None if m is None else band_hashes(m, bands) for m in least], pa.list_(pa.int64()))],
                    names=["id", "n_shingles", "set_key", "signature", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_shingles long, set_key binary, signature binary, bands array<long>")


def shingle_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, shingles): the sorted set as little-endian 64-bit values."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE):
                sets = shingler.sets(batch.column(1).slice(start, stop - start).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "shingles"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, shingles binary")


@F.arrow_udf(T.BooleanType())
def sets_similar(left: pa.Array, right: pa.Array, percent: pa.Array) -> pa.Array:
    out = []
    for at in range(0, len(left), 64):  # few sets at a time as Python objects
        for x, y, p in zip(left.slice(at, 64).to_pylist(), right.slice(at, 64).to_pylist(), percent.slice(at, 64).to_pylist()):
            a, b = sorted((np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)), key=len)
            places = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int(np.count_nonzero(b[places] == a))
            out.append(100 * both >= p * (len(a) + len(b) - both))
    return pa.array(out, pa.bool_())


def enough(percent: int) -> float:
    """Agreeing minima that a pair at the threshold has with all but a negligible probability."""
    n, s = math.prod(banding(percent)), percent / 100
    return n * s - DEVIATIONS * (n * s * (1 - s)) ** 0.5


def signatures_close(percent: int):
    @F.arrow_udf(T.BooleanType())
    def close(left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.bool_())
        a, b = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint8).reshape(len(c), -1) for c in (left, right))
        return pa.array((a == b).sum(axis=1) >= enough(percent))
    return close


def star_step(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over (u, v) links, u > v.

    The smallest neighbour of a node is a map-side combined minimum, joined back to the links, so a node
    with very many links is never gathered in one place.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        made = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        near = edges.join(least, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        made = near.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return made.where("u <> v").distinct()


def mark(edges: DataFrame) -> tuple:
    """Count and two order-free checksums of a link table."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame, name: str = "stars") -> DataFrame:
    """(id, component) for every node of the undirected links (a, b); component is the smallest id reachable."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = mark(edges)
    while before[0]:
        edges = materialize(star_step(star_step(edges, large=True), large=False), name)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough on their full sets."""
    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
            .where(sets_similar("set_a", "set_b", F.lit(percent))).select("a", "b"))


def cell_pairs(cells: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components inside each (bucket, i, j) cell.

    A cell holds block i and block j of a bucket; i = j stands for pairs within one block.
    """
    kind = cells.schema["id"].dataType.simpleString()

    def meet(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        bucket, i, j = (k.as_py() for k in key)
        size = group["n"].to_numpy()
        order = np.argsort(size, kind="stable")
        group, size = group.take(pa.array(order)), size[order]
        block, component, ids = group["block"].to_numpy(), group["component"].to_pylist(), group["id"].to_pylist()
        names = {c: k for k, c in enumerate(dict.fromkeys(component))}
        component = np.array([names[c] for c in component])
        signature = np.frombuffer(b"".join(group["signature"].to_pylist()), dtype=np.uint8).reshape(len(size), -1)
        bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(len(size), -1)
        band = int(np.flatnonzero(bands[0] == bucket)[0])
        left, right = [], []
        for x in range(len(size)):
            last = np.searchsorted(size, size[x] * 100 // percent, side="right")  # larger sets cannot reach the threshold
            others = np.arange(x + 1, last)
            others = others[(component[others] != component[x]) & ((block[others] != block[x]) | (i == j))]
            others = others[(signature[others] == signature[x]).sum(axis=1) >= enough(percent)]
            others = others[(bands[others] == bands[x]).argmax(axis=1) == band]  # else another bucket reports the pair
            left += [min(ids[x], ids[y]) for y in others]
            right += [max(ids[x], ids[y]) for y in others]
        return pa.table({"a": pa.array(left, group["id"].type), "b": pa.array(right, group["id"].type)})

    return cells.groupBy("bucket", "i", "j").applyInArrow(meet, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    width: int = WIDTH) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every document; see the module's text."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(signatures(source, id_col="id", width=width, percent=percent), "signatures")
    classes = signed.where("set_key is not null").groupBy("set_key").agg(F.min("id").alias("first"))
    member = signed.select("id", "n_shingles", "set_key").join(classes, "set_key", "left").select(
        "id", "n_shingles", F.coalesce("first", "id").alias("first"))
    firsts = materialize(signed.join(classes, "set_key").where(F.col("id") == F.col("first"))
                         .dropDuplicates(["set_key"]).select("id", F.col("n_shingles").alias("n"), "signature", "bands"), "representatives")

    entries = firsts.select("id", F.explode("bands").alias("bucket"))
    ends = entries.groupBy("bucket").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(entries.join(ends, "bucket"), "buckets")
    sets = materialize(shingle_sets(source.join(shared.select("id").distinct(), "id", "left_semi"), width), "shingle-sets")

    pairs = shared.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    facts = firsts.select("id", "n", "signature")
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"s_{side}")), side)
    likely = pairs.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").where(
        signatures_close(percent)("s_a", "s_b")).select("a", "b")
    links = materialize(confirm(likely, sets, percent), "links")
    labels = materialize(components(links), "components")

    rows = shared.join(labels, "id", "left").select("bucket", "id", "size", F.coalesce("component", "id").alias("component"))
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    rows = (rows.join(mixed, "bucket").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).join(firsts, "id"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = rows.select("*", other.alias("o")).select(
        "bucket", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "id", "component", "n", "signature", "bands")
    more = confirm(cell_pairs(cells, percent), sets, percent)
    labels = components(links.unionByName(more))
    out = member.join(labels.withColumnRenamed("id", "first"), "first", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "first").alias("component_id")) \
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
