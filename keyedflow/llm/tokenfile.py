"""Token ids of a corpus as binary files, with document boundaries in Elias-Fano code.

Documents are range partitioned by id and sorted, and each partition is one file:

    ids          all ids one after another, little-endian, 16 bits each if the vocabulary allows, else 32
    boundaries   Elias-Fano code of where each document ends, counted in ids
    documents    Elias-Fano code of the document ids, less the smallest
    footer       sizes and offsets, JSON, then its length as 4 bytes and MAGIC

Elias-Fano keeps of each value the low bits as they are, and the high bits as ones in a bit vector. Value i is found
by select(i), the place of the i-th one; the only table for it has a 32-bit count for every 4096 bits. A file takes about
2 + log2(ids / documents) bits for a boundary.

The folder must be one that all executors share, in a file system that pyarrow opens by its address (local or mounted
paths, hdfs, s3, gs). A file is written under a name of its own and then renamed, and its content depends on its rows alone, so a task that is
run again, or twice, leaves the same file. Null and empty texts have only the end id. Documents without an id come first
and are read back without one. Rows of one id are ordered by their text's hash. An empty table gives no file and reads back as
an empty table. Only the id and the text are written, so other columns do no harm.
"""

import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.files import shared_dir
from .common import slices, stored
from .pretokens import PartCache

MAGIC = b"EFID0001"
DOCS_PER_FILE = 8192
#: Text of a file when documents alone would make more files than there are shuffle partitions.
FILE_BYTES = 256 << 20
#: Bits of the high part that share one count.
SAMPLE = 4096


# -- Elias-Fano -------------------------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of non-negative numbers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ranks = n, low_bits, low, high, ranks

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        n = len(values)
        values = np.asarray(values, np.uint64)
        top = int(values[-1]) if n else 0
        low_bits = max((top // max(n, 1)).bit_length() - 1, 0)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(places[-1]) + 1 if n else 0) // SAMPLE) * SAMPLE, np.uint8)
        bits[places] = 1
        ranks = np.concatenate([[0], np.cumsum(bits.reshape(-1, SAMPLE).sum(axis=1, dtype=np.int64))])
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ranks.astype("<u4"))

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.ranks.astype("<u4").tobytes()]

    @classmethod
    def read(cls, n: int, low_bits: int, low: bytes, high: bytes, ranks: bytes) -> "EliasFano":
        return cls(n, low_bits, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(ranks, "<u4"))

    def select(self, index: np.ndarray) -> np.ndarray:
        """The places of the ones of these numbers, in the high bits."""
        index = np.asarray(index, np.int64)
        block = np.searchsorted(self.ranks, index, "right") - 1
        out = np.empty(len(index), np.int64)
        for b in np.unique(block):
            mine = block == b
            raw = self.high[b * SAMPLE // 8 : (b + 1) * SAMPLE // 8]
            ones = np.flatnonzero(np.unpackbits(raw, bitorder="little"))
            out[mine] = b * SAMPLE + ones[index[mine] - int(self.ranks[b])]
        return out

    def get(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        high = (self.select(index) - index).astype(np.uint64) << np.uint64(self.low_bits)
        low = np.zeros(len(index), np.uint64)
        for bit in range(self.low_bits):
            at = index * self.low_bits + bit
            low |= (self.low[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(np.uint64) << np.uint64(bit)
        return (high | low).astype(np.int64)


# -- ids --------------------------------------------------------------------------------------


def byte_alphabet() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: themselves where they can be
    seen, and from U+0100 on for the others, in order."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)}


class IdEncoder:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library; none are put around a text.

    The library's model encodes each match of the pattern that the file's pre-tokenizer uses. With `added`, texts that may
    hold one of the file's added tokens are encoded by the library as a whole, which recognises them by its defaults.
    `entries` bounds the cache of parts.
    """

    def __init__(self, path: str, pattern: str, added: bool = False, entries: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        tokens = list(tokenizer.get_added_tokens_decoder().values()) if added else []
        # Some tokens are sought in the normalised text, where they can differ from the text itself.
        self.any_text = tokenizer.normalizer is not None and any(t.normalized for t in tokens)
        self.holds_added = re.compile("|".join(re.escape(t.content) for t in tokens)).search if tokens else None
        self.model = tokenizer.model
        self.dtype = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[32]
        width = np.dtype(self.dtype).itemsize
        self.raw = [i.to_bytes(width, "little") for i in range(tokenizer.get_vocab_size())]
        self.cache = PartCache(pattern, self._encode_word, self._encode_letters, entries)

    def _encode_letters(self, letters: str) -> bytes:
        """ASCII letters and the space before them."""
        raw = self.raw
        return b"".join([raw[t.id] for t in self.model.tokenize(self.space + letters)])

    def _encode_word(self, word: str) -> bytes:
        raw, written = self.raw, word.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([raw[t.id] for t in self.model.tokenize(written)])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if self.holds_added is None:
            return self.cache.encode(texts)
        marked = [self.any_text or self.holds_added(t) is not None for t in texts]
        plain = self.cache.encode([t for t, m in zip(texts, marked) if not m])
        return (self._whole(t) if m else next(plain) for t, m in zip(texts, marked))

    def _whole(self, text: str) -> bytes:
        return b"".join([self.raw[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])


@lru_cache(maxsize=2)
def id_encoder(path: str, pattern: str, entries: int | None = None) -> IdEncoder:
    return IdEncoder(path, pattern, added=True, entries=entries)


# -- files ------------------------------------------------------------------------------------


def _filesystem(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def _write_file(folder: str, part: int, batches: Iterator[pa.RecordBatch], encoder: IdEncoder, end_id: int):
    """One file from batches of (id, text) in order; (documents, ids) in it."""
    fs, root = _filesystem(folder)
    fs.create_dir(root)
    temporary, final = f"{root}/.{part:06d}-{uuid.uuid4().hex}", f"{root}/{part:06d}.ids"
    width, end = np.dtype(encoder.dtype).itemsize, np.array([end_id], encoder.dtype).tobytes()
    docs, lengths = [], []
    with fs.open_output_stream(temporary) as out:
        for batch in slices(batches, 1):
            docs += batch.column(0).to_pylist()
            for ids in encoder.encode([t or "" for t in batch.column(1).to_pylist()]):
                out.write(ids)
                out.write(end)
                lengths.append(len(ids) // width + 1)
        if not docs:
            out.close()
            fs.delete_file(temporary)
            return 0, 0
        nulls = docs.count(None)  # they come first
        known = np.array(docs[nulls:], np.int64)
        least = int(known[0]) if len(known) else 0
        offsets = (known.astype(np.uint64) - np.uint64(least % (1 << 64)))
        codes = {"boundaries": EliasFano.encode(np.cumsum(lengths)), "documents": EliasFano.encode(offsets)}
        footer = {"dtype": encoder.dtype, "ids": sum(lengths), "nulls": nulls, "least": least}
        for name, code in codes.items():
            parts = code.parts()
            footer[name] = [code.n, code.low_bits, *map(len, parts)]
            for part_bytes in parts:
                out.write(part_bytes)
        raw = json.dumps(footer).encode()
        out.write(raw + len(raw).to_bytes(4, "little") + MAGIC)
    fs.move(temporary, final)
    return len(docs), sum(lengths)


class IdFile:
    """Random access to a file's documents."""

    def __init__(self, folder: str, part: int):
        fs, root = _filesystem(folder)
        self.file = fs.open_input_file(f"{root}/{part:06d}.ids")
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError("no id file, or not a whole one")
        length = int.from_bytes(tail[:4], "little")
        self.footer = json.loads(self.file.read_at(length, size - 12 - length))
        self.width = np.dtype(self.footer["dtype"]).itemsize
        at = self.footer["ids"] * self.width
        for name in ("boundaries", "documents"):
            n, low_bits, *sizes = self.footer[name]
            parts = []
            for s in sizes:
                parts.append(self.file.read_at(s, at))
                at += s
            setattr(self, name, EliasFano.read(n, low_bits, *parts))

    def __len__(self) -> int:
        return self.boundaries.n

    def starts_and_ends(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        ends = self.boundaries.get(np.arange(max(first - 1, 0), last))
        return (np.concatenate([[0], ends[:-1]]), ends) if first == 0 else (ends[:-1], ends[1:])

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        nulls = self.footer["nulls"]
        known = self.documents.get(np.arange(max(first - nulls, 0), max(last - nulls, 0)))
        return [None] * max(min(nulls, last) - first, 0) + (known + self.footer["least"]).tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - start) * self.width, start * self.width)
        return np.frombuffer(raw, self.footer["dtype"])


def write_ids(
    docs: DataFrame, vocabulary: str, pattern: str, end_id: int, id: str = "doc_id", text: str = "text",
    folder: str | None = None, docs_per_file: int = DOCS_PER_FILE,
) -> DataFrame:
    """Write the files; returns their list (folder, part, docs, first_id): one row a file, stored.

    `first_id` is the number of ids in the files before, so places count through the corpus.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "ids")
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    files, partitions = max(-(-rows.count() // docs_per_file), 1), int(spark.conf.get("spark.sql.shuffle.partitions"))
    if files > partitions:  # few large files rather than millions, whose ranges the driver would have to sort
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = min(files, max(partitions, -(-size // FILE_BYTES)))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), id_encoder(vocabulary, pattern)
        n, ids = _write_file(folder, part, batches, encoder, end_id)
        encoder.cache.forget()
        if n:
            yield pa.RecordBatch.from_pydict({
                "folder": [folder], "part": pa.array([part], pa.int32()), "docs": [n], "ids": [ids],
            })

    written = stored(dealt.mapInArrow(run, "folder string, part int, docs long, ids long"), "files")
    # One row for each file of thousands of documents, so one task can add them up.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("ids").over(before), F.lit(0))
    return written.select("folder", "part", "docs", first.alias("first_id"))


def read_ids(files: DataFrame, docs_at_once: int = 1024) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; `ids` are little-endian
    unsigned 32-bit integers, the end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = IdFile(row["folder"], row["part"])
                for first in range(0, len(file), docs_at_once):
                    last = min(first + docs_at_once, len(file))
                    starts, ends = file.starts_and_ends(first, last)
                    ids = file.ids(int(starts[0]), int(ends[-1])).astype("<u4")
                    local = (starts - starts[0]).tolist(), (ends - starts[0]).tolist()
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(file.doc_ids(first, last), pa.int64()),
                        "start": pa.array(starts + row["first_id"], pa.int64()),
                        "n_tokens": pa.array(ends - starts, pa.int64()),
                        "ids": pa.array([ids[a:b].tobytes() for a, b in zip(*local)], pa.binary()),
                    })

    # A number of partitions that is given is not merged: few rows here stand for much to read.
    spread = files.repartition(max(files.count(), 1), "part")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
