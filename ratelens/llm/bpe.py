"""Byte-level BPE: encoding in linear time, and decoding.

The vocabulary's byte strings, read as Latin-1, form the trie of an
Aho-Corasick automaton, which gives the longest match at a position; no token
is longer than a fixed number of bytes.  Encoding walks a piece from the left,
takes the longest token that may stand after the last one, and steps back to
the next shorter one where no token fits.  Two tokens may stand side by side exactly if merging
the bytes of both by rank gives these two tokens again; that answer is
remembered per pair.  A prefix has only one valid tokenisation, so a position
once found to be a dead end is never entered again: the work is linear in the
piece's length, and the result is that of merging by rank.

Pieces are the matches of the tokenizer's pattern, encoded separately and
without special tokens.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import in_workers

MEMO = 1 << 17      # pieces a Python worker remembers in each of two generations
PAIRS = 1 << 20     # token pairs remembered by a Python worker
SLICE = 4 << 20     # bytes of text encoded between two output batches


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


class Memo(dict):
    """Packed ids by piece.  When it is full it becomes the old generation, of
    which only pieces that are met again are carried over."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= 64:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class ByteBPE:
    """Encoder and decoder of one vocabulary.

    ``encode`` gives the same ids as merging the lowest-ranked adjacent pair
    again and again, for any text; a piece that is itself a token is that
    token.  Empty text or None has no ids.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        # for ASCII texts the standard library finds the same pieces faster
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(
            r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.ascii_pieces = self.pieces if "\\p" in plain else re.compile(plain, re.ASCII).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            # a token that merging its own bytes doesn't give can't be chosen
            if self.merge(token) == [rank]:
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo = Memo(lambda piece: array("i", self.encode_piece(piece.encode("utf-8"))).tobytes())

    def merge(self, piece: bytes) -> list[int]:
        """Plain merging by rank, used on one or two tokens' bytes only."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """True if ``right`` may follow ``left`` in an encoding."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, latin = len(piece), piece.decode("latin-1")
        pairs, get, reach = self.pairs, self.automaton.get, self.longest
        out: list[int] = []
        ends = [0]                  # where each token of ``out`` starts, and the next one
        dead = bytearray(n + 1)
        pos, length = 0, -1         # -1: nothing tried at this place yet
        while pos < n:
            if length < 0:
                length = self.automaton.longest_prefix(latin[pos:pos + reach])
            while length:
                rank = get(latin[pos:pos + length], -1)
                if rank >= 0 and not dead[pos + length]:
                    if not out:
                        break
                    fits = pairs.get((out[-1], rank))
                    if fits or fits is None and self.compatible(out[-1], rank):
                        break
                length -= 1
            if length:
                out.append(rank)
                pos += length
                ends.append(pos)
                length = -1
            else:                   # a dead end: the token before it has to be shorter
                dead[pos] = 1
                if not out:
                    raise ValueError("the vocabulary lacks a single byte")
                out.pop()
                ends.pop()
                length = pos - ends[-1] - 1
                pos = ends[-1]
        return out

    def packed(self, text: str | None) -> bytes:
        """The text's ids as native 32-bit integers."""
        text = text or ""
        pieces = self.ascii_pieces(text) if text.isascii() else self.pieces(text)
        return b"".join(map(self.memo.__getitem__, pieces))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids) -> bytes:
        """The bytes of a sequence of ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBPE:
    """One coder per Python worker; the file is installed on every machine."""
    return ByteBPE(read_ranks(path), pattern)


def _by_bytes(batch: pa.RecordBatch, column: int, weight: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about SLICE bytes in one column."""
    values = batch.column(column)
    count = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    start = size = 0
    for i, n in enumerate(count(values).to_pylist()):
        size += (n or 0) * weight
        if size >= SLICE:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
           ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` array<int>: the whole text's token ids.

    NULL and empty texts have an empty array.  A column named ``ids_col`` is
    replaced; all others are kept.  Texts of any length are encoded whole.
    """
    docs = docs.drop(ids_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            for part in _by_bytes(batch, at, 1):
                blobs = [bpe.packed(t.as_py()) for t in part.column(at)]
                offsets = np.zeros(len(blobs) + 1, np.int32)
                np.cumsum([len(b) // 4 for b in blobs], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(blobs), np.int32), pa.int32())
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*part.columns, ids],
                                                 names=[*part.schema.names, ids_col])

    return in_workers(docs).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, ids_col: str = "ids",
           bytes_col: str = "decoded") -> DataFrame:
    """``tokens`` with ``bytes_col`` binary: the bytes of ``ids_col``.

    NULL ids give empty bytes; a column named ``bytes_col`` is replaced.
    """
    tokens = tokens.drop(bytes_col)
    schema = T.StructType([*tokens.schema.fields, T.StructField(bytes_col, T.BinaryType())])
    at = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            for part in _by_bytes(batch, at, 4):
                blobs = [bpe.decode(ids.as_py() or ()) for ids in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(blobs, pa.binary())],
                                                 names=[*part.schema.names, bytes_col])

    return in_workers(tokens).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``: every text encoded, and the ids
    decoded again."""
    return decode(encode(docs, path, pattern, text_col), path, pattern)


def digests(coded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` per coded row; the
    ids are hashed as decimal numbers joined by commas."""
    return coded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
