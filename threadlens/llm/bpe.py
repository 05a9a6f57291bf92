"""Byte-level BPE over Arrow batches with the ``tokenizers`` library.

A rank file lists byte strings in merge order.  The library wants characters and merge pairs, so bytes
are shown as the 256 printable characters of the usual byte table and every way to split a token into
two tokens becomes a merge, in rank order.  A text is cut by the split pattern and every *distinct* piece
of a batch is encoded once, with offsets; ids and offsets of whole texts are then put together from the
pieces' buffers.  Decoding looks ids up in the reverse table and joins bytes, so characters that are split
over several tokens come back whole.

Null texts count as empty and have no tokens.  A token that holds only part of a character gets the
offsets of that whole character.  Duplicated rows are encoded each; other columns are never read.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import list_array, slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core
CACHED_PIECES = 120_000  # distinct pieces a worker remembers within a partition
SLICE = 2 << 20          # bytes of text encoded at once


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All (left, right) token pairs whose concatenation is a token, by that token's rank."""
    return [(token[:cut], token[cut:]) for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks]


class PieceEncoder:
    """Encodes texts piece by piece; one per worker process and vocabulary."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer, models, pre_tokenizers
        ranks = read_ranks(path)
        show = byte_characters()
        shown = {token: "".join(show[b] for b in token) for token in ranks}
        self.model = Tokenizer(models.BPE(
            vocab={shown[t]: r for t, r in ranks.items()}, merges=[(shown[a], shown[b]) for a, b in merge_pairs(ranks)],
            ignore_merges=True))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.find = regex.compile(pattern).findall
        self.ids: dict[str, bytes] = {}                 # int32 ids of a piece
        self.spans: dict[str, tuple[bytes, bytes]] = {}  # int32 character starts and ends of its tokens

    def forget(self) -> None:
        self.ids, self.spans = {}, {}

    def learn(self, pieces: set[str], offsets: bool) -> None:
        """Encode the pieces not seen yet, thousands per call."""
        new = [p for p in pieces if p not in self.ids or offsets and p not in self.spans]
        if len(self.ids) + len(new) > CACHED_PIECES:
            self.forget()
            new = list(pieces)
        for at in range(0, len(new), 8192):
            part = new[at:at + 8192]
            done = self.model.encode(part, is_pretokenized=True, add_special_tokens=False)
            counts = np.bincount(np.array(done.word_ids, dtype=np.int64), minlength=len(part))
            cuts = [0, *(4 * np.cumsum(counts)).tolist()]
            ids = np.array(done.ids, dtype=np.int32).tobytes()
            self.ids.update((p, ids[low:high]) for p, low, high in zip(part, cuts, cuts[1:]))
            if offsets:
                starts, ends = (x.tobytes() for x in np.array(done.offsets, dtype=np.int32).reshape(-1, 2).T)
                self.spans.update((p, (starts[low:high], ends[low:high])) for p, low, high in zip(part, cuts, cuts[1:]))

    def encode(self, texts: list[str], offsets: bool = True) -> list[tuple[np.ndarray, ...]]:
        """Per text its ids, or with ``offsets`` its (ids, starts, ends), as int32 arrays."""
        cut = [self.find(t) for t in texts]
        self.learn(set().union(*cut), offsets)
        out = []
        for pieces in cut:
            coded = [self.ids[p] for p in pieces]
            ids = np.frombuffer(b"".join(coded), dtype=np.int32)
            if not offsets:
                out.append((ids,))
                continue
            lengths = np.fromiter(map(len, pieces), dtype=np.int32, count=len(pieces))
            counts = np.fromiter(map(len, coded), dtype=np.int32, count=len(pieces)) // 4
            base = np.repeat(np.cumsum(lengths, dtype=np.int32) - lengths, counts)
            spans = [self.spans[p] for p in pieces]
            out.append((ids, *(np.frombuffer(b"".join([s[k] for s in spans]), dtype=np.int32) + base for k in (0, 1))))
        return out


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> PieceEncoder:
    return PieceEncoder(path, pattern)


@lru_cache(maxsize=4)
def id_bytes(path: str) -> dict[int, bytes]:
    """The reverse table: token id to bytes."""
    return {rank: token for token, rank in read_ranks(path).items()}


def decode(ids: list[int], table: dict[int, bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


def encode_column(df: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id",
                  text_col: str = "text", offsets: bool = True, decoded: bool = False) -> DataFrame:
    """(id, ids array<int>[, starts array<int>, ends array<int>][, decoded binary]) for every row.

    ``decoded`` adds the bytes that the ids stand for, decoded in the same worker.  ``ranks_path`` must be
    readable on every executor.  Work and output go in slices of about 2 MB of text; what a worker remembers is
    dropped at the end of each partition.
    """
    lists = ["ids", "starts", "ends"] if offsets else ["ids"]
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            texts = batch.column(1)
            for start, stop in slices(texts, SLICE):
                done = enc.encode([t or "" for t in texts.slice(start, stop - start).to_pylist()], offsets)
                counts = [len(d[0]) for d in done]
                columns = [batch.column(0).slice(start, stop - start),
                           *[list_array(np.concatenate([d[k] for d in done]), counts) for k in range(len(lists))]]
                if decoded:
                    table = id_bytes(ranks_path)
                    columns.append(pa.array([decode(d[0].tolist(), table) for d in done], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", *lists, *["decoded"] * decoded])
        enc.forget()

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, " + ", ".join(f"{c} array<int>" for c in lists) + ", decoded binary" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode_ids(ids: Column, ranks_path: str) -> Column:
    """Bytes of a list of ids; null for null, an error for an id outside the vocabulary."""

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        table = id_bytes(ranks_path)
        return pa.array([None if row is None else decode(row, table)
                         for at in range(0, len(column), 256) for row in column.slice(at, 256).to_pylist()],
                        type=pa.binary())

    return decoded(ids)


def token_digests(df: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Encode, decode again and return counts and digests: (id, n_tokens, ids_sha256, decoded_sha256)."""
    coded = encode_column(df, ranks_path, pattern, id_col=id_col, text_col=text_col, offsets=False, decoded=True)
    return coded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
