"""Byte-level BPE encoding and decoding of whole texts, exactly as the tokenizers library does.

The vocabulary file (tokenizers JSON) is read once by the driver and broadcast; its size is
that of the vocabulary. Inside a task the regular pieces of a text go through one native call.
Text that the vocabulary's pattern leaves unsplit for more than `LEAF` bytes (a run of letters,
digits, signs or white space) would be one sequential merge; it is encoded as a tree instead:
its halves are cut down to leaves, the leaves are encoded in parallel, and neighbours are joined
by encoding a window around the join anew. The window grows until its first token is the left
side's and its last token the right side's. As a token sequence is the BPE encoding of its bytes
exactly if each pair of neighbours is the encoding of the pair's bytes, the result is exact.

Defined cases: null text is encoded as empty; the strings of added tokens become their ids;
decoding gives U+FFFD for bytes that are no UTF-8; repeated rows, other columns and any row order
are kept; columns named like a result column are replaced; unknown ids raise.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

LEAF = 1 << 14
#: Characters of text encoded before a batch goes out: bounds the ids held by a task.
OUT_CHARS = 4 << 20
THREADS = 2
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RUN_OF_SPACE = re.compile(r"\s{%d}" % LEAF)


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encoder and decoder of one vocabulary; made in each worker from the file's text.

    A worker that only decodes holds the tokens' bytes alone: the encoder is built at its first use.
    """

    def __init__(self, source: str):
        spec = json.loads(source)
        pre, added = spec["pre_tokenizer"], spec["added_tokens"]
        plain = spec["model"]["type"] == "BPE" and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not spec["normalizer"]
        if not plain or any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in added):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        alphabet, special = byte_alphabet(), {x["content"]: x["id"] for x in added}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        tokens = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in special.items()}
        self.lengths = np.zeros(max(tokens) + 1, np.int64)
        self.known = np.zeros(max(tokens) + 1, bool)
        for i, b in tokens.items():
            self.lengths[i], self.known[i] = len(b), True
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(max(tokens) + 1)), np.uint8)

    def token(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()

    @cached_property
    def encoding(self):
        import tiktoken

        special = set(self.special.values())
        ranks = {self.token(i): i for i in np.flatnonzero(self.known).tolist() if i not in special}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    @cached_property
    def pieces(self):
        from tokenizers.pre_tokenizers import ByteLevel

        return ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str

    @cached_property
    def pool(self) -> ThreadPoolExecutor:
        return ThreadPoolExecutor(THREADS)

    def encode(self, text: str) -> np.ndarray:
        if len(text) * 4 > LEAF and (max(map(len, text.split()), default=0) * 4 > LEAF or _RUN_OF_SPACE.search(text)):
            return np.array(self._encode_with_long_pieces(text), np.uint32)
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def _encode_with_long_pieces(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            for _, (start, end) in self.pieces(part):
                piece = part[start:end].encode()
                out += self.encoding._encode_single_piece(piece) if len(piece) <= LEAF else self.encode_tree(piece)
        return out

    def encode_tree(self, piece: bytes, leaf: int = LEAF) -> list[int]:
        """BPE of one unsplit run of bytes by tree concatenation."""
        n = 1
        while len(piece) > n * leaf:
            n *= 2
        size = -(-len(piece) // n)
        leaves = [piece[i : i + size] for i in range(0, len(piece), size)]
        level = list(self.pool.map(self.encoding._encode_single_piece, leaves))
        while len(level) > 1:
            pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
            level = list(self.pool.map(lambda p: self.join(*p) if len(p) == 2 else p[0], pairs))
        return level[0] if level else []

    def join(self, left: list[int], right: list[int]) -> list[int]:
        w = 2
        while True:
            a, b = left[-w:], right[:w]
            middle = self.encoding._encode_single_piece(b"".join(self.token(t) for t in a + b))
            if (w >= len(left) or middle[0] == a[0]) and (w >= len(right) or middle[-1] == b[-1]):
                return left[:-w] + middle + right[w:]
            w *= 2

    def decode_lists(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of lists of ids that lie one after the other."""
        at = np.concatenate([[0], np.cumsum(self.lengths[ids])])[bounds]
        data = self.decode_bytes(ids).tobytes()
        return [data[a:z].decode("utf-8", "replace") for a, z in zip(at[:-1], at[1:], strict=True)]

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("unknown token id")
        n = self.lengths[ids]
        at = np.repeat(self.starts[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return self.bytes[at]


_CODECS: dict[int, Codec] = {}


def codec(source: str) -> Codec:
    """The codec of a vocabulary, made once in a worker."""
    key = hash(source)
    if key not in _CODECS:
        _CODECS[key] = Codec(source)
    return _CODECS[key]


def read_vocabulary(df: DataFrame, path: str):
    """The vocabulary file as a broadcast (a vocabulary has a fixed size)."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded_slices(batch: pa.RecordBatch, text_col: str, coder: Codec) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows of a batch with the ids of each row's text."""
    lo, ids, chars = 0, [], 0
    for r, text in enumerate(batch.column(text_col)):
        value = text.as_py() or ""
        ids.append(coder.encode(value))
        chars += len(value)
        if chars >= OUT_CHARS or r == batch.num_rows - 1:
            yield batch.slice(lo, len(ids)), ids
            lo, ids, chars = r + 1, [], 0


def _with(schema: pa.Schema, batch: pa.RecordBatch, **new: pa.Array) -> pa.RecordBatch:
    columns = {n: batch.column(n) for n in batch.schema.names} | new
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def _plus(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType, pa.Schema]:
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c != name])
    schema = T.StructType([*kept.schema.fields, T.StructField(name, kind)])
    return kept, schema, to_arrow_schema(schema)


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """docs with the token ids of the whole text as array<int>."""
    kept, schema, arrow = _plus(docs, out, T.ArrayType(T.IntegerType(), False))
    source = read_vocabulary(docs, path)

    def run(batches):
        coder = codec(source.value)
        for batch in batches:
            for rows, ids in encoded_slices(batch, text_col, coder):
                yield _with(arrow, rows, **{out: _lists(ids)[0]})

    return kept.mapInArrow(run, schema)


def _lists(ids: list[np.ndarray]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lists of ids as an Arrow column, all ids, and the bounds of each list in them."""
    bounds, every = np.concatenate([[0], np.cumsum([len(x) for x in ids])]), np.concatenate(ids).astype(np.int32)
    return pa.LargeListArray.from_arrays(bounds, every).cast(pa.list_(pa.int32())), every, bounds


def round_trip(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """docs with the token ids of the text, and what they decode to in the text's place: one pass, one worker a task."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (ids_col, out) or c == text_col])
    others = [f for f in kept.schema.fields if f.name != text_col]
    schema = T.StructType([*others, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)), T.StructField(out, T.StringType())])
    arrow = to_arrow_schema(schema)
    source = read_vocabulary(docs, path)

    def run(batches):
        coder = codec(source.value)
        for batch in batches:
            for rows, ids in encoded_slices(batch, text_col, coder):
                lists, every, bounds = _lists(ids)
                yield _with(arrow, rows, **{ids_col: lists, out: pa.array(coder.decode_lists(every, bounds), pa.string())})

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """df with the text that the ids stand for; null ids give the empty text."""
    kept, schema, arrow = _plus(df, out, T.StringType())
    source = read_vocabulary(df, path)

    def run(batches):
        coder = codec(source.value)
        for batch in batches:
            column = batch.column(ids_col)
            for lo in range(0, batch.num_rows, 1024):
                rows = column.slice(lo, 1024)
                ids = rows.flatten().to_numpy(zero_copy_only=False)
                n = [len(x) if x.is_valid else 0 for x in rows]
                texts = coder.decode_lists(ids, np.concatenate([[0], np.cumsum(n, dtype=np.int64)]))
                yield _with(arrow, batch.slice(lo, 1024), **{out: pa.array(texts, pa.string())})

    return kept.mapInArrow(run, schema)
