"""Byte-level BPE encoding and decoding (operator 1).

A sentencepiece BPE model is written straight from a rank file: the piece of
a token is its bytes mapped one to one to characters, its score the negative
rank, and the normaliser is the identity.  Merging the best-scored pair first
is then the same as merging the lowest rank first.  Texts are cut into
pre-tokens by the tokenizer's pattern, every pre-token is encoded by that
model, and decoding joins the bytes of the ids.

Results on odd input: a null or empty text has no ids and decodes to empty
bytes; null ids decode to empty bytes; texts of any length are encoded whole;
repeated rows give repeated rows; an empty table gives an empty table; other
columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
import struct
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemelens.llm.common import map_batches

#: Distinct chunks and pre-tokens whose ids one task remembers.
CACHE = 350_000
_UP = {b: 256 + b for b in range(256)}  # byte b is the character 256 + b


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def as_piece(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_UP)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, raw: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(raw)) + raw


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; the piece at place r is the token of rank r, <unk> comes after all."""
    order = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in order] != list(range(len(order))):
        raise ValueError("ranks must run from 0 without gaps")
    pieces = b"".join(
        _block(1, _block(1, as_piece(t).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(r)))
        for r, t in enumerate(order))
    unknown = _block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(order) + 1) + _number(40, len(order))  # BPE, size, id of <unk>
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + unknown + _block(2, trainer) + _block(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one rank file and pre-token pattern."""

    #: A single space between two other characters always opens a pre-token, so text may be cut there.
    CUT = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece
        ranks = read_ranks(path)
        self.ranks = ranks
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.find = regex.compile(pattern).findall
        # ids as the bytes of 32-bit numbers
        self.chunks: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [array("i", x).tolist() for x in self.encode_raw(texts)]

    def encode_raw(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of 32-bit numbers."""
        cut = [self.CUT.split(t) for t in texts]
        if len(self.chunks) > CACHE:
            self.chunks.clear()
        if len(self.tokens) > CACHE:
            self.tokens.clear()
        known = self.chunks
        self._learn({c for row in cut for c in row if c not in known})
        return [b"".join([known[c] for c in row]) for row in cut]

    def _learn(self, chunks: set[str]) -> None:
        known = self.tokens
        pre = {c: self.find(c) for c in chunks}
        new = [t for t in {t for row in pre.values() for t in row} if t not in known]
        raw = [t.encode("utf-8") for t in new]
        whole = [self.ranks.get(r) for r in raw]  # a pre-token that is a token stands for itself
        rest = [i for i, r in enumerate(whole) if r is None]
        parts = self.model.encode([as_piece(raw[i]) for i in rest], out_type=int, num_threads=1) if rest else []
        known.update((t, array("i", (r,)).tobytes()) for t, r in zip(new, whole) if r is not None)
        known.update((new[i], array("i", ids).tobytes()) for i, ids in zip(rest, parts))
        for c, row in pre.items():
            self.chunks[c] = known[row[0]] if len(row) == 1 else b"".join([known[t] for t in row])


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.BinaryArray:
    """The bytes of each id."""
    ranks = read_ranks(path)
    return pa.array(sorted(ranks, key=ranks.__getitem__), pa.binary())


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of each row's whole text."""
    rows = df.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema[0].dataType.simpleString()

    def run(batch):
        ids = coder(path, pattern).encode_raw([t or "" for t in batch.column(1).to_pylist()])
        ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
        flat = np.frombuffer(b"".join(ids), np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                         names=[id_col, "ids"])

    return map_batches(rows, run, f"`{id_col}` {id_type}, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded binary): the bytes that the ids stand for.  The pattern is taken as ``encode`` takes it; the
    bytes of an id do not depend on it."""
    rows = df.select(F.col(id_col), F.col(ids_col).alias("ids"))
    id_type = rows.schema[0].dataType.simpleString()

    def run(batch):
        col = batch.column(1)
        yield pa.RecordBatch.from_arrays([batch.column(0), col, _joined(token_bytes(path), col)],
                                         names=[id_col, "ids", "decoded"])

    return map_batches(rows, run, f"`{id_col}` {id_type}, ids array<int>, decoded binary")


def _joined(token: pa.BinaryArray, col: pa.ListArray) -> pa.BinaryArray:
    """The bytes of each list of ids; those of a missing list are empty."""
    sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
    ids = col.flatten()  # leaves out missing lists
    if not len(ids):
        return pa.array([b""] * len(col), pa.binary())
    _, starts, raw = token.take(ids).buffers()
    # the taken tokens lie side by side, so a list's bytes run from its first token to its last
    ends = np.frombuffer(starts, np.int32)[np.concatenate(([0], np.cumsum(sizes)))]
    return pa.Array.from_buffers(pa.binary(), len(col), [None, pa.py_buffer(ends), raw])
