"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

A rank file lists byte strings in merge order. Each becomes a piece of a sentencepiece BPE model, its bytes
mapped to characters one to one, its score the negative rank; normalisation is the identity. Sentencepiece then
merges, of all adjacent pairs that form a piece, the one of the lowest rank, leftmost first, which is byte-level BPE.
The text is first cut by the vocabulary's pattern, and each match ("pre-token") is encoded by itself.

`encode` and `decode` take one row to one row, without a shuffle; a lost task is simply run again. Null and empty
texts give no ids. Whole texts are encoded; repeated rows and ties play no part; an empty table gives an empty one.
Other columns are passed on, and a column of the input that has an output's name is replaced.
"""

import base64
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices
from .pretokens import PretokenCache


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: varint, 32-bit float or length-delimited, by the type of the value."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


#: Byte b is written as the character 256 + b, which no white-space or normalisation rule touches.
BYTE_CHARS = {b: chr(256 + b) for b in range(256)}


def mapped(piece: bytes) -> str:
    return piece.decode("latin-1").translate(BYTE_CHARS)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto whose piece ids are the ranks; the unknown piece comes after them."""
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[p] for p in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    out = [
        _field(1, _field(1, mapped(piece).encode()) + _field(2, -float(rank)) + _field(3, 1))
        for rank, piece in enumerate(by_rank)
    ]
    out.append(_field(1, _field(1, "".encode()) + _field(2, 0.0) + _field(3, 2)))
    # model_type BPE, vocab_size, unk_id; no begin, end or padding piece
    spec = _field(3, 2) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank))
    spec += _field(41, -1) + _field(42, -1) + _field(43, -1)
    # identity: no dummy prefix, white space neither removed nor escaped
    plain = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, spec) + _field(3, plain)


class Codec:
    """Encoder and decoder of one vocabulary, built once per worker process."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.ranks = read_ranks(path)
        self.pieces = sorted(self.ranks, key=self.ranks.get)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(self.ranks))
        self.cache = PretokenCache(pattern, self._encode_words)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """A match that is a token itself is that token; the model merges the others."""
        raw = [w.encode() for w in words]
        out = [self.ranks.get(r) for r in raw]
        rest = [i for i, rank in enumerate(out) if rank is None]
        for i, ids in zip(rest, self.model.encode([mapped(raw[i]) for i in rest], num_threads=1)):
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        return [x if isinstance(x, bytes) else x.to_bytes(4, "little") for x in out]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text the ids, as little-endian unsigned 32-bit integers."""
        return list(self.cache.encode(texts))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        pieces = self.pieces
        return [b"".join([pieces[i] for i in memoryview(x).cast("I")]) for x in ids]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _mapped(
    df: DataFrame, source: str, targets: list[str], empty: str | bytes, make: Callable[[], Callable],
    done_with: Callable[[], None] = lambda: None,
) -> DataFrame:
    """`df` with binary columns: make() turns a list of values of `source`, null as `empty`, into
    a list for each of them. A task ends with done_with()."""
    kept = df.drop(*targets)
    schema, width = kept.withColumns({t: F.lit(b"") for t in targets}).schema, len(kept.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in slices(batches, width):
            *columns, values = batch.columns
            done = apply([empty if v is None else v for v in values.to_pylist()])
            arrays = [*columns, *(pa.array(d, pa.binary()) for d in done)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        done_with()

    return df.select(*kept.columns, F.col(source).alias("_in")).mapInArrow(run, schema)


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """`docs` with a binary column `ids`: the token ids of `text` as little-endian unsigned 32-bit
    integers, none for a null text. With `decoded`, the ids are decoded in the same pass into a
    column of that name. `vocabulary`: path of the rank file, the same on all machines."""

    def make():
        own = codec(vocabulary, pattern)

        def apply(texts: list[str]) -> list[list[bytes]]:
            encoded = own.encode(texts)
            return [encoded, own.decode(encoded)] if decoded else [encoded]

        return apply

    def done_with() -> None:
        codec(vocabulary, pattern).cache.forget()

    return _mapped(docs, text, [ids, decoded] if decoded else [ids], "", make, done_with)


def decode(
    docs: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """`docs` with a binary column `decoded`: the bytes that `ids` stand for. Null ids give none."""
    return _mapped(docs, ids, [decoded], b"", lambda: lambda raw: [codec(vocabulary, pattern).decode(raw)])
