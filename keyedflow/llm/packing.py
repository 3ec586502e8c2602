"""Harmonic packing of token ids into sequences of one capacity.

A document's ids and an end id are cut into pieces: as many as fill a sequence alone, then the rest. A piece of length r is of the
class of k = capacity // r, whose sequences hold k pieces each, whatever their lengths between capacity / (k + 1) and
capacity / k. Where that would leave more than `slack` ids of a sequence empty, capacity // (k + 1) ids are cut off first,
which are a piece of the next class and fill it to the last k ids; so a rest becomes few pieces. From TAIL pieces a sequence on,
a rest is not cut again, and classes are four to a doubling.

A task encodes its documents and fills the sequences of its classes by itself, as each holds a fixed number of pieces:
there is no shuffle, and nothing is known of other tasks. What a task has left, fewer than k pieces of each class and so a
bounded number, is stored and packed the same way by groups of TASKS tasks; the few pieces that a group has left then are
put together by first fit, longest first. Whatever the number of tasks, few sequences in many thousands are not full.

Null and empty texts have only the end id. Very long texts are cut like others; a task holds one of them at a time.
Repeated rows and ids are documents of their own, a null id is passed on. An empty table gives an empty one. Only the
id and the text are read, so other columns and their names do no harm. Ids of sequences are unique, not consecutive. The pieces of
all tasks are stored once, with the ids as they are returned, and a task run again replaces what it gave.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import slices, stored
from .tokenfile import id_encoder

#: From so many pieces a sequence on, rests stay whole and classes are coarser.
TAIL = 16
#: Tasks whose left pieces are packed together.
TASKS = 64
#: Entries of a generation of a task's cache of parts: so many that a task of 16 MB need not encode a part again.
HELD_PARTS = 600_000

_COLUMNS = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long"


def pieces_a_sequence(length: int, capacity: int) -> int:
    """The class of a piece: how many of its kind share a sequence. Above TAIL the three leading bits count."""
    count = capacity // length
    drop = max(count.bit_length() - 3, 0) if count > TAIL else 0
    return count >> drop << drop


def cut(length: int, capacity: int, slack: int) -> list[int]:
    """The lengths of a document's pieces, in order."""
    pieces, rest = [capacity] * (length // capacity), length % capacity
    while rest:
        count = capacity // rest
        if count >= TAIL or capacity - count * rest <= slack:
            return [*pieces, rest]
        pieces.append(capacity // (count + 1))
        rest -= pieces[-1]
    return pieces


class Classes:
    """Sequences being filled, one for each class. A piece is a tuple that begins with its length."""

    def __init__(self, capacity: int):
        self.capacity, self.open = capacity, {}

    def add(self, piece: tuple) -> list[tuple] | None:
        """The pieces of a sequence when this one completes it."""
        count = pieces_a_sequence(piece[0], self.capacity)
        mine = self.open.setdefault(count, [])
        mine.append(piece)
        return self.open.pop(count) if len(mine) == count else None

    def left(self) -> list[tuple]:
        return [piece for mine in self.open.values() for piece in mine]


def first_fit(pieces: list[tuple], capacity: int) -> list[list[tuple]]:
    """Sequences for a few pieces of any class, the longest first."""
    sequences, free = [], []
    for piece in sorted(pieces, key=lambda p: -p[0]):
        at = next((i for i, room in enumerate(free) if room >= piece[0]), len(free))
        if at == len(free):
            sequences.append([])
            free.append(capacity)
        sequences[at].append(piece)
        free[at] -= piece[0]
    return sequences


class _Rows:
    """Rows of placed pieces, and of left ones, whose sequence is null. A piece is (length, doc_id, start, ids, doc_tokens)."""

    def __init__(self, first_sequence: int):
        self.sequence, self.rows, self.size = first_sequence, [], 0

    def place(self, sequence: list[tuple]) -> None:
        at = 0
        for length, doc_id, start, ids, total in sequence:
            self.rows.append((doc_id, start, length, ids, total, self.sequence, at))
            at += length
            self.size += len(ids)
        self.sequence += 1

    def leave(self, pieces: list[tuple]) -> None:
        self.rows += [(doc_id, start, length, ids, total, None, None) for length, doc_id, start, ids, total in pieces]

    def take(self, schema: pa.Schema, **more: int) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*self.rows)] or [[]] * 7
        columns += [[value] * len(self.rows) for value in more.values()]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema(*more: str) -> pa.Schema:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", *more]
    return pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])


def _fill_by_task(rows: DataFrame, vocabulary: str, pattern: str, end_id: int, capacity: int, slack: int) -> DataFrame:
    """The pieces of each task's documents with their sequences, and those left without; `task` numbers the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, schema = id_encoder(vocabulary, pattern, HELD_PARTS), TaskContext.get().partitionId(), _schema("task")
        classes, out = Classes(capacity), _Rows(task << 36)
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, 1, 1 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids = np.frombuffer(ids, encoder.dtype).astype("<u4").tobytes() + end
                total, start = len(ids) // 4, 0
                for length in cut(total, capacity, slack):
                    own = ids[4 * start : 4 * (start + length)]
                    full = classes.add((length, doc_id, start, own, total))
                    if full:
                        out.place(full)
                    start += length
                if out.size > 4 << 20:
                    yield out.take(schema, task=task)
        encoder.cache.forget()
        out.leave(classes.left())
        yield out.take(schema, task=task)

    return rows.mapInArrow(run, f"{_COLUMNS}, task long")


def _fill_left(left: DataFrame, capacity: int) -> DataFrame:
    """Sequences for what tasks have left, TASKS of them at a time: a bounded number of pieces."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        rows.sort(key=lambda r: (r["task"], r["length"], r["doc_id"] is None, r["doc_id"], r["start"], r["ids"]))
        classes, out = Classes(capacity), _Rows(1 << 62 | (rows[0]["task"] // TASKS) << 30)
        for r in rows:
            full = classes.add((r["length"], r["doc_id"], r["start"], r["ids"], r["doc_tokens"]))
            if full:
                out.place(full)
        for sequence in first_fit(classes.left(), capacity):
            out.place(sequence)
        return pa.Table.from_batches([out.take(_schema())])

    return left.groupBy(F.expr(f"task div {TASKS}")).applyInArrow(run, _COLUMNS)


def pack(
    docs: DataFrame, vocabulary: str, pattern: str, end_id: int, capacity: int = 1024, slack: int | None = None,
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece.

    `ids` are little-endian unsigned 32-bit integers; `start` counts the document's ids before the piece, `offset`
    those before it in its sequence. `slack`: ids that a class may leave empty in a sequence; capacity / 64 unless given.
    """
    slack = capacity // 64 if slack is None else slack
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    placed = stored(_fill_by_task(rows, vocabulary, pattern, end_id, capacity, slack), "pieces")
    full = placed.where("sequence_id is not null").drop("task")
    left = _fill_left(placed.where("sequence_id is null"), capacity)
    return full.union(left).withColumnRenamed("doc_id", id)
