"""Chat formatting with loss masks that follow the tokens exactly.

A conversation is rendered whole, `### role:` + MARK + text + MARK + line break for each turn, and
encoded once with offsets. MARK is an added token of the vocabulary, so no token reaches over it;
inside roles and texts `|` after `<` and every backslash are escaped by a backslash, so neither MARK
nor any other control string can stand there, and `unescape` gives the text back. The spans of the
turns that carry loss are sorted, as the tokens' spans are, and binary search cuts one by the other.

Rows are dealt by conversation and sorted by turn inside the task; a task holds one conversation
at a time.

Defined cases: null role or text is empty; null conv_ids form one conversation; null turns come
first; rows that repeat a turn follow in the order of role and text; an empty table gives an empty
result; an empty turn that carries loss has no token; other columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import read_vocabulary

MARK = "<|endoftext|>"
OUT_CHARS = 2 << 20
_ESCAPED = re.compile(r"\\([\\|])")
SCHEMA = "conv_id long, formatted string, ids array<int>, loss array<boolean>, spans array<struct<start:int,end:int>>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], loss_roles: frozenset[str]) -> tuple[str, np.ndarray]:
    """The formatted conversation and the spans (code points) of the texts that carry loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escape(role)}:{MARK}", escape(text)
        at += len(head)
        if role in loss_roles:
            spans.append((at, at + len(body)))
        at += len(body) + len(MARK) + 1
        parts += [head, body, MARK, "\n"]
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    parts = formatted.split(MARK)
    return [(unescape(head.removeprefix("\n")[4:-1]), unescape(body)) for head, body in zip(parts[:-1:2], parts[1::2], strict=True)]


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens (sorted spans) that lie inside one of the sorted, disjoint spans."""
    change = np.zeros(len(offsets) + 1, np.int64)
    first = np.searchsorted(offsets[:, 0], spans[:, 0], "left")
    last = np.searchsorted(offsets[:, 1], spans[:, 1], "right")
    full = first < last
    np.add.at(change, first[full], 1)
    np.add.at(change, last[full], -1)
    return np.cumsum(change[:-1]) > 0


def masked_spans(offsets: np.ndarray, mask: np.ndarray) -> list[tuple[int, int]]:
    """Code point spans under the mask, touching ones merged."""
    out: list[tuple[int, int]] = []
    for a, z in offsets[mask].tolist():
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True))
    for conv_id, group in groupby(rows, key=lambda r: r[0]):
        yield conv_id, [(role or "", text or "") for _, role, text in group]


def format_chats(conversations: DataFrame, path: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: formatted text, ids, the tokens' loss mask and the spans of text under it."""
    source, roles = read_vocabulary(conversations, path), frozenset(loss_roles)
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        from tokenizers import Tokenizer

        coder = Tokenizer.from_str(source.value)
        if MARK not in {t.content for t in coder.get_added_tokens_decoder().values()}:
            raise ValueError(f"{MARK} is no added token of the vocabulary")
        held, chars = [], 0

        def batch():
            codes = coder.encode_batch([text for _, text, _ in held], add_special_tokens=False)
            columns = {"conv_id": [], "formatted": [], "ids": [], "loss": [], "spans": []}
            for (conv_id, text, spans), code in zip(held, codes, strict=True):
                offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
                mask = loss_mask(offsets, spans)
                for name, value in zip(columns, (conv_id, text, code.ids, mask.tolist(), [{"start": a, "end": z} for a, z in masked_spans(offsets, mask)]), strict=True):
                    columns[name].append(value)
            kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns.values(), kinds, strict=True)], names=list(columns))

        for conv_id, own in _conversations(batches):
            text, spans = render(own, roles)
            held.append((conv_id, text, spans))
            chars += len(text)
            if chars >= OUT_CHARS:
                yield batch()
                held, chars = [], 0
        if held:
            yield batch()

    return turns.mapInArrow(run, SCHEMA)
