"""Byte-level BPE by a sentencepiece model that is written straight from the ranks."""

from __future__ import annotations

import base64
import functools
import itertools
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.caches import BoundedCache
from tickwatch.llm.frames import quoted, with_struct

# Matches held at once for one text, so that a very long one needs no more memory.
MATCHES = 1 << 18
LONG = 1 << 20
# Pieces whose ids are kept, in each of two generations.
ENTRIES = 150_000
UNKNOWN = "\ue000"

# Field numbers and values of the sentencepiece model format (fixed values).
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID, UNK_PIECE = 3, 4, 40, 41, 42, 43, 45
NAME, DUMMY_PREFIX, EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5
BPE, NORMAL, UNKNOWN_TYPE = 2, 1, 2


def byte_chars() -> list[str]:
    """One visible character for each byte: itself where it prints in Latin-1, else one beyond."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return [chr(byte if byte in printing else next(spare)) for byte in range(256)]


BYTE_CHARS = byte_chars()
TO_CHARS = dict(enumerate(BYTE_CHARS))
TO_BYTES = {ord(char): byte for byte, char in enumerate(BYTE_CHARS)}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(TO_CHARS)


def unmapped(text: str) -> bytes:
    return text.translate(TO_BYTES).encode("latin-1")


def varint(number: int) -> bytes:
    number &= (1 << 64) - 1
    out = bytearray()
    while number > 0x7F:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    return bytes([*out, number])


def number_field(field: int, number: int) -> bytes:
    return varint(field << 3) + varint(number)


def bytes_field(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def piece_field(piece: str, score: float, kind: int) -> bytes:
    body = bytes_field(PIECE, piece.encode()) + varint(SCORE << 3 | 5) + struct.pack("<f", score)
    return bytes_field(PIECES, body + number_field(TYPE, kind))


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks.

    Each piece is the byte-mapped token, its score the negative rank, so that the
    best-scored merge is the lowest-ranked. Normalisation is the identity. The
    ranks must be 0 to n - 1; n itself is the unknown piece, which no text can hold.
    """
    ordered = sorted(ranks, key=ranks.__getitem__)
    if [ranks[token] for token in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must run from 0 without gaps")
    pieces = [piece_field(mapped(token), -float(rank), NORMAL) for rank, token in enumerate(ordered)]
    pieces.append(piece_field(UNKNOWN, 0.0, UNKNOWN_TYPE))
    trainer = number_field(MODEL_TYPE, BPE) + number_field(VOCAB_SIZE, len(pieces))
    trainer += number_field(UNK_ID, len(ordered)) + bytes_field(UNK_PIECE, UNKNOWN.encode())
    trainer += b"".join(number_field(field, -1) for field in (BOS_ID, EOS_ID, PAD_ID))
    normalizer = bytes_field(NAME, b"identity")
    normalizer += b"".join(number_field(field, 0) for field in (DUMMY_PREFIX, EXTRA_WHITESPACES, ESCAPE_WHITESPACES))
    return b"".join(pieces) + bytes_field(TRAINER, trainer) + bytes_field(NORMALIZER, normalizer)


class Codec:
    """Encodes texts to packed ids (little-endian unsigned 32-bit) and back to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import sentencepiece

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(ranks))
        self.packed = BoundedCache(self.encode_piece, ENTRIES)
        self.tokens = [unmapped(self.model.id_to_piece(number)) for number in range(len(ranks))]

    def encode_piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = self.model.encode(mapped(data)) if whole is None else [whole]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        packed = self.packed.__getitem__
        if len(text) <= LONG:
            return b"".join(map(packed, self.pattern.findall(text)))
        out, found = bytearray(), (match[0] for match in self.pattern.finditer(text))
        while part := b"".join(map(packed, itertools.islice(found, MATCHES))):
            out += part
        return bytes(out)

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        parts = (numbers[at : at + MATCHES].tolist() for at in range(0, len(numbers), MATCHES))
        return b"".join(b"".join(map(self.tokens.__getitem__, part)) for part in parts)


@functools.lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """The codec for a file of ranks, made once in each worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern)


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the packed token ids of each whole text (binary, four little-endian bytes an id).

    Each match of ``pattern`` is merged separately. Null counts as the empty text and
    gives no ids. Very long texts are encoded part by part, whole. Rows stay as they are,
    repeated rows too; a same-named column is replaced, and an empty table stays empty.
    """

    @F.arrow_udf("ids binary")
    def encoded(texts: pa.Array) -> pa.Array:
        one = codec(path, pattern)
        return pa.StructArray.from_arrays([pa.array([one.encode(t.as_py() or "") for t in texts], pa.binary())], ["ids"])

    return with_struct(df, encoded(F.col(quoted(text_col)).cast("string")), {"ids": ids_col})


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for; null ids give no bytes, an id outside the vocabulary fails.

    Ids of any number are decoded part by part. Rows stay as they are, repeated rows too; a
    same-named column is replaced, and an empty table stays empty.
    """

    @F.arrow_udf("decoded binary")
    def decoded(ids: pa.Array) -> pa.Array:
        one = codec(path, pattern)
        return pa.StructArray.from_arrays([pa.array([one.decode(i.as_py() or b"") for i in ids], pa.binary())], ["decoded"])

    return with_struct(df, decoded(F.col(quoted(ids_col))), {"decoded": bytes_col})
