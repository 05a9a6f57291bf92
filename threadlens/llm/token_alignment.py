"""Alignment of two tokenizers by merge-path partitioning.

1. A text is encoded twice: blank + text by a byte-level vocabulary (A), the text by a sentencepiece vocabulary that adds
   the blank itself (B).  Both are cut where no merge can cross - A by its own split pattern, B before every run of
   blanks - and every distinct piece of a slice is encoded once.
2. The token ends of all texts of a slice, as byte offsets, are two ascending lists.  Their merge is divided into pieces of
   PIECE steps each by binary searches on the diagonals, so a very long text gives many pieces and short ones share a
   piece.  Every piece alone finds the ends that both lists have; it looks back at one A end before its first.
   Group boundaries of neighbouring pieces are stitched to groups afterwards.
3. Tokens linked by a group give id pairs.  Blocks of texts of about BLOCK bytes are written with the distinct pairs of
   every text, packed; counts of a pair - the texts that hold it - are added up over blocks, and an id of A has one
   highest count.
4. Blocks ask for the counts of their distinct pairs only, and the answers meet the block they belong to, so what is
   shuffled grows with distinct pairs a block instead of links.  No key stands for more rows than there are blocks.

Null and empty texts have no tokens, and neither have texts that one of the vocabularies does not give back
byte by byte (those that hold U+2581 among them); their counts are 0 and their digest is ''.  Repeated rows and rows
without an id are texts each.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.bpe import byte_characters
from threadlens.llm.common import slices
from threadlens.sources.scratch import materialize

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core
PIECE = 4096           # merge steps of one piece
SLICE = 1 << 20        # bytes of text aligned at once
BLOCK = 8 << 20        # bytes of text of one block
REMEMBERED = 100_000   # distinct pieces of a generation that a worker remembers, per vocabulary
LINKS = 1 << 20        # links laid out at once
WIDE = 1 << 12         # groups with more links are counted by distinct ids first
BLANK = "▁"


class Pieces:
    """Token ids of distinct pieces in one vocabulary; those seen lately are remembered, in two generations."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}   # int32 ids
        self.older: dict[str, bytes] = {}
        self.broken: set[str] = set()       # pieces whose tokens are not their bytes

    def learn(self, pieces: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.broken.intersection_update(self.known)
            self.known, self.older = {}, self.known
        new = []
        for piece in pieces.difference(self.known):
            ids = self.older.get(piece)
            if ids is None:
                new.append(piece)
            else:
                self.known[piece] = ids
        for at in range(0, len(new), 8192):
            part = new[at:at + 8192]
            ids, counts = self.encode(part)
            cuts = np.cumsum(counts)
            data = ids.tobytes()
            bounds = [0, *(4 * cuts).tolist()]
            self.known.update(zip(part, [data[low:high] for low, high in zip(bounds, bounds[1:])]))
            sizes = np.diff(np.concatenate([[0], np.cumsum(self.lengths[ids])])[cuts], prepend=0)
            raw = [p.encode() for p in part]
            if sizes.tolist() != [len(r) for r in raw] or b"".join(map(self.bytes.__getitem__, ids.tolist())) != b"".join(raw):
                self.broken.update(p for p, r, low, high in zip(part, raw, [0, *cuts.tolist()], cuts.tolist())
                                   if b"".join(map(self.bytes.__getitem__, ids[low:high].tolist())) != r)

    def finish(self) -> None:
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        names = [b"%d" % k for k in range(len(self.bytes))]
        self.written = [n + self.inner for n in names] + [n + self.last for n in names]


class ByteLevel(Pieces):
    """A: blank + text, cut by the split pattern."""

    inner, last = b",", b"|"

    def __init__(self, path: str, pattern: str):
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings inside texts are plain text
        code = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (1 + max(vocabulary.values()))
        for token, k in vocabulary.items():
            self.bytes[k] = bytes(code[c] for c in token) if all(c in code for c in token) else token.encode()
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)  # pieces are cut already
        self.cut = regex.compile(pattern).findall
        self.finish()

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        done = self.model.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(done.ids, dtype=np.int32), np.bincount(np.array(done.word_ids, dtype=np.int64), minlength=len(pieces))


class SentencePieces(Pieces):
    """B: blank + text, cut before every run of blanks; no token holds a blank behind another character."""

    inner, last = b",", b";"

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size, self.blank = self.model.get_piece_size(), [self.model.piece_to_id(BLANK)]
        names = [self.model.id_to_piece(k) for k in range(size)]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(k) else n.replace(BLANK, " ").encode() for k, n in enumerate(names)]
        if any(BLANK in n.lstrip(BLANK) for n in names):
            raise ValueError("a token holds a blank behind another character, so texts cannot be cut before blanks")
        self.cut = regex.compile(r" +[^ ]*").findall
        self.finish()

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the model adds the first blank, but none to nothing
        ids = [x or self.blank for x in self.model.encode([p[1:] for p in pieces], num_threads=1)]
        return np.fromiter(chain.from_iterable(ids), dtype=np.int32), np.array([len(x) for x in ids], dtype=np.int64)


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str, pattern: str) -> tuple[ByteLevel, SentencePieces]:
    return ByteLevel(a_path, pattern), SentencePieces(b_path)


def encode_texts(texts: list[str | None], vocabulary: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, tokens of each, whether its tokens are its bytes)."""
    cut = [vocabulary.cut(" " + t) if t else [] for t in texts]
    vocabulary.learn(set().union(*cut))
    get = vocabulary.known.__getitem__
    coded = [b"".join(map(get, pieces)) for pieces in cut]
    broken = vocabulary.broken
    whole = np.array([not broken or broken.isdisjoint(pieces) for pieces in cut], dtype=bool)
    return np.frombuffer(b"".join(coded), dtype=np.int32), np.array([len(c) // 4 for c in coded], dtype=np.int64), whole


def merge_path(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces of the merge of two ascending lists begin: (places in a, places in b), the ends last.

    The place on a diagonal is found by binary search, on all diagonals at once; of equal values a's comes first.
    """
    diagonals = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b))
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        across = np.clip(diagonals - 1 - middle, 0, max(0, len(b) - 1))
        takes = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[across])
        low = np.where(takes, middle + 1, low)
        high = np.where(open_ & ~takes, middle, high)
    return low, diagonals - low


def common_ends(a: np.ndarray, b: np.ndarray, low_a: int, high_a: int, low_b: int, high_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of one piece that both lists have, as (A tokens, B tokens) up to and with them, counted over the whole lists."""
    back = max(0, low_a - 1)  # an A end and the equal B end may lie on two sides of a border
    mine, other = a[back:high_a], b[low_b:high_b]
    if not len(mine) or not len(other):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(mine, other)
    same = mine[np.minimum(at, len(mine) - 1)] == other
    return back + at[same] + 1, low_b + np.flatnonzero(same) + 1


def cut_groups(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Group boundaries, (A tokens, B tokens) before each, with 0 first: pieces find theirs alone, then they are stitched."""
    if not len(a) or not len(b):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    in_a, in_b = merge_path(a, b, step)
    found = [common_ends(a, b, *where) for where in zip(in_a.tolist(), in_a[1:].tolist(), in_b.tolist(), in_b[1:].tolist())]
    return tuple(np.concatenate([[0], *part]) for part in zip(*found))


def spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... for ``counts[k]`` numbers, one run after the other."""
    begins = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(first - begins, counts)


def links(owner: np.ndarray, first_a: np.ndarray, n_a: np.ndarray, first_b: np.ndarray, n_b: np.ndarray,
          ids_a: np.ndarray, ids_b: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(owner, id pair as one number, links) of all groups, LINKS at once or one wide group's distinct ids."""
    sizes = n_a * n_b
    small = np.flatnonzero(sizes <= WIDE)
    upto = np.cumsum(sizes[small])
    at = 0
    while at < len(small):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, "right")))
        part = small[at:stop]
        left = spread(first_a[part], n_a[part])          # A tokens of these groups
        times = np.repeat(n_b[part], n_a[part])
        right = spread(np.repeat(first_b[part], n_a[part]), times)
        yield np.repeat(owner[part], sizes[part]), np.repeat(ids_a[left].astype(np.int64) * width, times) + ids_b[right], None
        at = stop
    for g in np.flatnonzero(sizes > WIDE).tolist():
        (a, times_a), (b, times_b) = (np.unique(ids[f:f + n], return_counts=True) for ids, f, n in ((ids_a, first_a[g], n_a[g]), (ids_b, first_b[g], n_b[g])))
        rows = max(1, LINKS // len(b))
        for k in range(0, len(a), rows):
            pairs = (a[k:k + rows, None].astype(np.int64) * width + b).ravel()
            yield np.full(len(pairs), owner[g]), pairs, (times_a[k:k + rows, None] * times_b).ravel()


def sum_links(parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, pair, links) with every owner's pair once, in order."""
    codes, times = [], []
    for owner, pair, n in parts:
        code = owner * span + pair
        if n is None:
            code, n = np.unique(code, return_counts=True)
        codes.append(code), times.append(n)
    if not codes:
        return (np.empty(0, np.int64),) * 3
    code, n = np.concatenate(codes), np.concatenate(times)
    if len(codes) > 1:
        order = np.argsort(code, kind="stable")
        code, n = code[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        code, n = code[first], np.add.reduceat(n, first)
    return code // span, code % span, n


@dataclass
class Aligned:
    """Texts of one slice: per text its counts and digest, then its distinct linked pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    owner: np.ndarray
    pair: np.ndarray
    times: np.ndarray
    groups: list[str] = field(default_factory=list)


def align(texts: list[str | None], a: ByteLevel, b: SentencePieces, step: int = PIECE, keep_groups: bool = False) -> Aligned:
    (ids_a, n_a, whole_a), (ids_b, n_b, whole_b) = encode_texts(texts, a), encode_texts(texts, b)
    sizes = np.array([len(t.encode()) + 1 if t else 0 for t in texts], dtype=np.int64)
    good = whole_a & whole_b & (sizes > 0)
    if not good.all():
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        n_a, n_b, sizes = (np.where(good, x, 0) for x in (n_a, n_b, sizes))
    ends_a, ends_b = np.cumsum(a.lengths[ids_a]), np.cumsum(b.lengths[ids_b])
    cut_a, cut_b = cut_groups(ends_a, ends_b, step)  # a text's end is an end of both, so no group crosses it
    in_a, in_b = np.diff(cut_a), np.diff(cut_b)
    upto = np.searchsorted(cut_a, np.cumsum(n_a))    # groups up to the end of each text
    n_groups = np.diff(upto, prepend=0)
    owner = np.repeat(np.arange(len(texts)), n_groups)
    width = len(b.bytes)
    found = sum_links(links(owner, cut_a[:-1], in_a, cut_b[:-1], in_b, ids_a, ids_b, width), len(a.bytes) * width)
    # tokens of a group stand together: A's, then B's, each with what is written behind it
    codes, place = np.empty(len(ids_a) + len(ids_b), np.int64), np.arange(len(in_a))
    last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    last_a[cut_a[1:] - 1] = len(a.bytes)
    last_b[cut_b[1:] - 1] = len(b.bytes)
    codes[np.arange(len(ids_a)) + np.repeat(cut_b[:-1], in_a)] = ids_a + last_a
    codes[np.arange(len(ids_b)) + np.repeat(cut_a[1:], in_b)] = ids_b + last_b + len(a.written)
    written = a.written + b.written
    bounds = [0, *np.cumsum(n_a + n_b).tolist()]
    told = [b"".join(map(written.__getitem__, codes[low:high].tolist()))[:-1] for low, high in zip(bounds, bounds[1:])]
    return Aligned(n_a, n_b, n_groups, [hashlib.sha256(t).hexdigest() if t else "" for t in told], *found,
                   groups=[t.decode() for t in told] if keep_groups else [])


def pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, kind: type, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), dtype=kind) if n else np.empty(0, kind)


def to_block(name: int, ids: list, done: list[Aligned], kind: pa.DataType) -> pa.RecordBatch:
    """One row: the texts of a block, its distinct pairs with the texts that hold each, and every text's pairs by their place."""
    pairs, places = np.unique(np.concatenate([d.pair for d in done]), return_inverse=True)
    texts = [np.bincount(d.owner, minlength=len(d.n_a)) for d in done]
    times = np.concatenate([d.times for d in done])
    held = np.bincount(places, minlength=len(pairs))
    n_links = [int(x) for d in done for x in np.bincount(d.owner, weights=d.times, minlength=len(d.n_a))]
    lists = [np.concatenate([getattr(d, f) for d in done]).tolist() for f in ("n_a", "n_b", "n_groups")]
    row = [pa.array([name], pa.int64()), pa.array([ids], pa.list_(kind)), *[pa.array([x], pa.list_(pa.int64())) for x in (*lists, n_links)],
           pa.array([[h for d in done for h in d.digests]], pa.list_(pa.string())), pa.array([len(pairs)], pa.int64()), pa.array([len(places)], pa.int64()),
           *[pa.array([pack(x)], pa.binary()) for x in (np.diff(pairs, prepend=0), held.astype(np.uint32), np.concatenate(texts).astype(np.uint32),
                                                        places.astype(np.uint32), times.astype(np.int64) if len(times) and times.max() >= 1 << 32 else times.astype(np.uint32))],
           pa.array([bool(len(times)) and int(times.max()) >= 1 << 32], pa.bool_())]
    return pa.RecordBatch.from_arrays(row, names=BLOCK_FIELDS)


BLOCK_FIELDS = ["block", "ids", "n_a", "n_b", "n_groups", "n_links", "digests", "n_pairs", "n_places", "pairs", "held", "texts", "places", "times", "long_times"]


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, pattern: str, *, id_col: str, text_col: str, block_bytes: int = BLOCK) -> DataFrame:
    """One row a block of texts; see ``to_block``.  Blocks are numbered by partition and place in it."""
    id_type = docs.schema[id_col].dataType
    schema = (f"block long, ids array<{id_type.simpleString()}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
              "digests array<string>, n_pairs long, n_places long, pairs binary, held binary, texts binary, places binary, times binary, long_times boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        a, b = vocabularies(a_path, b_path, pattern)
        kind = to_arrow_type(id_type)
        name, ids, done, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE):
                part = batch.slice(start, stop - start)
                texts = part.column(1).to_pylist()
                done.append(align(texts, a, b))
                ids += part.column(0).to_pylist()
                size += sum(len(t) for t in texts if t)
                if size >= block_bytes:
                    yield to_block(name, ids, done, kind)
                    name, ids, done, size = name + 1, [], [], 0
        if done:
            yield to_block(name, ids, done, kind)
        a.forget(), b.forget()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, place, pair, n): the distinct pairs of every block and the texts in it that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                pairs, held = np.cumsum(unpack(r["pairs"], np.int64, r["n_pairs"])), unpack(r["held"], np.uint32, r["n_pairs"])
                for at in range(0, len(pairs), 1 << 16):
                    part = pairs[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), r["block"])), pa.array(np.arange(at, at + len(part)), pa.int32()),
                                                      pa.array(part), pa.array(held[at:at + len(part)].astype(np.int64))], names=["block", "place", "pair", "n"])

    return blocks.select("block", "n_pairs", "pairs", "held").mapInArrow(run, "block long, place int, pair long, n long")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``n_best`` counts links whose pair is held by as many texts as any pair of the same A id, ``count_sum`` adds up
    the texts that hold the pair over all links.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = materialize(aligned_blocks(docs, a_path, b_path, pattern, id_col=id_col, text_col=text_col, block_bytes=block_bytes), "alignment")
    asked = block_pairs(blocks)
    counts = pair_counts(asked, width_of(b_path))
    answers = asked.select("block", "place", "pair").join(counts, "pair").select("block", "place", "n", "best")

    def meet(key, block: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        for r in block.to_pylist():  # one block
            n, best = np.zeros(r["n_pairs"], np.int64), np.zeros(r["n_pairs"], np.int64)
            place = answer["place"].to_numpy()
            n[place], best[place] = answer["n"].to_numpy(), answer["best"].to_numpy().astype(np.int64)
            places, texts = unpack(r["places"], np.uint32, r["n_places"]), unpack(r["texts"], np.uint32, len(r["ids"]))
            times = unpack(r["times"], np.int64 if r["long_times"] else np.uint32, r["n_places"]).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(texts, dtype=np.int64)])
            sums = [np.concatenate([[0], np.cumsum(times * x[places])]) for x in (best, n)]
            n_best, count_sum = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
            out.append(pa.table({"id": pa.array(r["ids"], block.schema.field("ids").type.value_type), **{c: pa.array(r[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")},
                                 "n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": pa.array(r["digests"], pa.string())}))
        return pa.concat_tables(out) if out else None

    met = blocks.drop("pairs", "held").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        meet, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return met.withColumnRenamed("id", id_col)


@lru_cache(maxsize=4)
def width_of(b_path: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def pair_counts(asked: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): texts that hold each id pair, and whether no pair of its A id is held by more."""
    counts = materialize(asked.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.expr(f"cast(pair div {width} as int)").alias("a")
    highest = counts.groupBy(a).agg(F.max("n").alias("highest"))  # one row an A id: at most the vocabulary
    return counts.withColumn("a", a).join(F.broadcast(highest), "a") \
        .select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
