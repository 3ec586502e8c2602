"""A keyed table as plain parquet: a folder of partial aggregates for each batch, merged on reading.

    stream=S/batches=N-N/    the partials of batch N of a stream
    stream=S/batches=0-N/    batches 0 to N folded into one

What a batch delivered again does is a matter of how its folder is written: left as it is, replaced, or added to. Folders appear as a
whole, by a rename. Folding writes one folder for a range of batches; from its rename on it stands for those within its range, which
a reader leaves out by their names and which are then deleted. So there is nothing to keep beside the data.

One writer at a time for a stream, as a checkpoint has one running query, and batches in the order of their ids, as streams deliver them;
streams do not disturb each other. A reader that was begun before a fold, or while a batch is replaced, may miss a folder and then fails.
"""

from __future__ import annotations

import re
from typing import Literal

from pyspark.sql import DataFrame, SparkSession, types as T

from . import files

Mode = Literal["transactional", "opaque", "non_transactional"]
_FOLDER = re.compile(r".*/stream=([^/]*)/batches=(\d+)-(\d+)")


class BatchTable:
    """`merge` says how rows become partials and partials combine; `schema` is the DDL of the rows that `commit` takes.

    mode: what the second delivery of a batch does.
      transactional      nothing: it has the same rows
      opaque             it replaces the first one, as long as that is not folded
      non_transactional  it counts again, under the next free number
    """

    def __init__(self, spark: SparkSession, path: str, merge, schema: str | T.StructType, mode: Mode = "transactional"):
        self.spark, self.path, self.merge, self.mode = spark, path.rstrip("/"), merge, mode
        self._partials = merge.partial(spark.createDataFrame([], schema)).schema

    def _folders(self, stream: str = "*") -> list[tuple[str, str, int, int]]:
        """(path, stream, first, last) of the folders that count: those within no other one's range."""
        found = [
            (path, m[1], int(m[2]), int(m[3]))
            for path in files.glob(self.spark, f"{self.path}/stream={stream}/batches=*") if (m := _FOLDER.fullmatch(path))
        ]
        return [f for f in found if not any(_within(f, g) for g in found)]

    def commit(
        self, rows: DataFrame, batch_id: int, unique_keys: bool = False, stream: str | None = None, partials: bool = False
    ) -> bool:
        """Add a batch; False if it was there and nothing was done. The options are those of the streaming jobs' tables."""
        stream = stream or "none"
        there = [f for f in self._folders(stream) if f[2] <= batch_id <= f[3]]
        if there and self.mode == "transactional":
            return False
        if there and self.mode == "opaque" and there[0][2:] != (batch_id, batch_id):
            raise ValueError(f"batch {batch_id} is folded and can no longer be replaced")
        if self.mode == "non_transactional":
            batch_id = 1 + max((f[3] for f in self._folders(stream)), default=-1)
        folder = f"{self.path}/stream={stream}/batches={batch_id}-{batch_id}"
        new = self.merge.combine(rows) if partials else self.merge.partial(rows, unique_keys)
        files.publish_folder(new, folder, replace=self.mode == "opaque")
        return True

    def fold(self, keep: int = 1) -> bool:
        """Combine all batches of each stream but the newest `keep` into one folder."""
        done = False
        for stream in sorted({f[1] for f in self._folders()}):
            # What is within a fold's range was not yet deleted when its writer died.
            every = files.glob(self.spark, f"{self.path}/stream={stream}/batches=*")
            live = sorted(self._folders(stream), key=lambda f: f[3])
            for path in set(every) - {f[0] for f in live}:
                files.delete(self.spark, path)
            last = sorted({f[3] for f in live})[: -keep or None]
            cut = [f for f in live if last and f[3] <= last[-1]]
            if len(cut) < 2:
                continue
            target = f"{self.path}/stream={stream}/batches={min(f[2] for f in cut)}-{last[-1]}"
            files.publish_folder(self.merge.combine(self._read([f[0] for f in cut])), target)
            for path, *_ in cut:
                files.delete(self.spark, path)
            done = True
        return done

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self._partials)
        return self.spark.read.schema(self._partials).parquet(*paths)

    def view(self) -> DataFrame:
        """One row a key, of all batches there are now."""
        return self.merge.finish(self.merge.combine(self._read([f[0] for f in self._folders()])))


def _within(inner: tuple, outer: tuple) -> bool:
    """Whether a folder's batches are part of a longer range of its stream."""
    return inner[1] == outer[1] and outer[2] <= inner[2] and inner[3] <= outer[3] and inner[2:] != outer[2:]
