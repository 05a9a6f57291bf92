"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: ``<|turn|>role<|text|>text<|end|>`` for every turn.  The three marks are added
to the vocabulary as special tokens, so a turn's text always begins and ends at a token border.  Texts and roles
are escaped reversibly: a backslash is doubled and a backslash is put inside ``<|``, so no mark can be written by
a text.  The rendering is encoded once; the sorted character spans of turns meet the sorted spans of tokens by
binary search, which gives the loss mask over tokens: exactly the assistant's texts.

Null roles and texts count as empty.  Turns are ordered by number, then role, then text (null first); repeated
turns stay.  Rows with a null conversation id form one conversation.  Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
SPAN = regex.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", regex.DOTALL)
LEARNED_ROLES = ("assistant",)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return regex.sub(r"\\(.)", r"\1", text, flags=regex.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """(formatted text, sorted [start, end) character spans of learned texts)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role in LEARNED_ROLES and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
        parts += [head, body, END]
    return "".join(parts), np.array(spans, dtype=np.int64).reshape(-1, 2)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer
    made = Tokenizer.from_file(path)
    made.add_special_tokens([AddedToken(m, normalized=False) for m in (TURN, TEXT, END)])
    return made


def token_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """True for tokens inside a span: the last span that starts at or before the token must end after it."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), dtype=bool)
    span = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    return (span >= 0) & (offsets[:, 1] <= spans[np.maximum(span, 0), 1])


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> str:
    """What the masked tokens say, unescaped; runs of masked tokens are read as one piece."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return "".join(unescape(formatted[offsets[a, 0]:offsets[b - 1, 1]]) for a, b in zip(edges[0::2], edges[1::2]))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in SPAN.findall(formatted)]


def gather_turns(rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(id, turns array<struct<role, text>>) in turn order."""
    turn = F.struct(F.col(turn_col).alias("n"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def format_conversations(rows: DataFrame, vocabulary: str, *, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>) per conversation.

    A conversation is one training example and is rendered in one task.
    """
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        model = tokenizer(vocabulary)
        for batch in batches:
            turns = batch.column(1)
            for at in range(0, len(turns), 64):
                out = []
                for row in turns.slice(at, 64).to_pylist():
                    formatted, spans = render([(t["role"], t["text"]) for t in row])
                    coded = model.encode(formatted, add_special_tokens=False)
                    offsets = np.array(coded.offsets, dtype=np.int32).reshape(-1, 2)
                    out.append((formatted, coded.ids, offsets[:, 0], offsets[:, 1], token_mask(offsets, spans)))
                kinds = [pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 64), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                                                 names=["id", "formatted", "ids", "starts", "ends", "loss"])

    return gather_turns(rows, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col).mapInArrow(
        run, f"id {kind}, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>") \
        .withColumnRenamed("id", id_col)


READ = T.StructType([T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                     T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType())])


@F.arrow_udf(READ)
def read_back(formatted: pa.Array, starts: pa.Array, ends: pa.Array, loss: pa.Array) -> pa.Array:
    """Digests of turns and of the text under the mask, from the formatted output alone."""
    rows = []
    for low, high in slices(formatted):
        part = [c.slice(low, high - low).to_pylist() for c in (formatted, starts, ends, loss)]
        for text, s, e, m in zip(*part):
            turns = parse(text)
            said = masked_text(text, np.array([s, e], dtype=np.int64).T.reshape(-1, 2), np.array(m, dtype=bool))
            whole = "".join(f"{role}\n{body}\n" for role, body in turns)
            rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()))
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string()))],
                                      names=[f.name for f in READ])
