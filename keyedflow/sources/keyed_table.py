"""A keyed table on plain parquet: each batch adds its partial aggregates, reading merges them.

A read-modify-write of every touched key would cost a join with the whole state per batch. As the
merge is associative, a batch only writes one partial per key, and `view()` merges them. Folders:

    log/generation=G/batch_id=N/attempt=K/      partials of a batch
    deletes/generation=G/batch_id=N/attempt=K/  keys deleted after batch N
    base/generation=G/batch_id=N/attempt=K/     a run: folded batches, one partial per key, N the
                                                newest of them; a folder per bucket of the key hash
    manifest/NUMBER.json                        which of these folders count

A change writes its data first and then the next manifest, which appears as a whole or not at all.
So a job that dies half-way leaves nothing visible and is simply run again, and a reader sees one
state of the table. Every change costs one listing, of the few newest manifests. One writer at a
time per table, as a checkpoint has one running query.

Folding is levelled: the log becomes a run, and `FANOUT` runs of a level become one of the next, so
a row is rewritten as often as there are levels, and a fold reads the runs it merges and no others.

A batch is known by its generation and batch id. Ids of a stream start at 0 again with each new
checkpoint, so `commit(stream=...)` gives every stream a generation of its own.
"""

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.lookup import lookup
from ..operators.merge import Merge
from . import files

Mode = Literal["transactional", "opaque", "non_transactional"]
Version = tuple[int, int]

#: Runs of a level that are merged into one of the next, and manifests that are kept.
FANOUT, KEPT_MANIFESTS = 4, 20
VERSION = ("generation", "batch_id")


@dataclass
class Piece:
    """A folder that counts. `number`: the manifest that brought it. Deletes act on versions up to
    `version`, and `id` is the batch they were made for."""

    path: str
    version: Version
    number: int
    level: int = 0
    id: Version | None = None


@dataclass
class Manifest:
    number: int = 0
    log: list[Piece] = field(default_factory=list)
    runs: list[Piece] = field(default_factory=list)
    deletes: list[Piece] = field(default_factory=list)
    #: Folded batch ids, and ids of deletes done with: generation -> ranges [first, last].
    folded: dict[int, list[list[int]]] = field(default_factory=dict)
    done_deletes: dict[int, list[list[int]]] = field(default_factory=dict)
    #: The newest version that a delete done with acted on.
    deleted: Version = (-1, -1)
    streams: dict[str, int] = field(default_factory=dict)
    #: Folders that no longer count, and since when.
    dropped: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def read(text: str) -> "Manifest":
        raw = json.loads(text)
        pieces = {
            kind: [
                Piece(**p | {"version": tuple(p["version"]), "id": p["id"] and tuple(p["id"])})
                for p in raw[kind]
            ]
            for kind in ("log", "runs", "deletes")
        }
        ranges = {
            kind: {int(g): r for g, r in raw[kind].items()} for kind in ("folded", "done_deletes")
        }
        return Manifest(**raw | pieces | ranges | {"deleted": tuple(raw["deleted"])})

    def newest(self) -> Version | None:
        """The newest batch there is, of any generation."""
        folded = [(g, ranges[-1][1]) for g, ranges in self.folded.items()]
        return max([*(p.version for p in self.log), *folded], default=None)

    def generations(self) -> set[int]:
        return {p.version[0] for p in self.log} | set(self.folded) | set(self.streams.values())


def _within(ranges: dict[int, list[list[int]]], version: Version) -> bool:
    return any(a <= version[1] <= b for a, b in ranges.get(version[0], []))


def _add(ranges: dict[int, list[list[int]]], version: Version) -> None:
    g, n = version
    joined: list[list[int]] = []
    for a, b in sorted([*ranges.get(g, []), [n, n]]):
        if joined and a <= joined[-1][1] + 1:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    ranges[g] = joined


class KeyedTable:
    """`schema` holds the columns of the rows passed to `commit` (DDL text or a StructType).

    mode: what a second commit of a batch id does.
      transactional      nothing; the batch has the same rows as before
      opaque             replaces the first one; the batch may hold other rows
      non_transactional  adds again

    generation: of batches that are committed without a stream.
    compact_every: fold the log whenever it holds that many batches, all but the newest `keep`, and
      remove what was folded `retain` seconds ago or more: views begun before then are complete.
    buckets: folders of a run by key hash; a selective lookup reads those of its keys. Choose them
      for the size the state will have, and keep the number.
    versioned: commit adds the columns `generation` and `batch_id`, which the schema and the merge
      name, so that values of a newer batch win, across checkpoints too.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        merge: Merge,
        schema: str | T.StructType,
        mode: Mode = "transactional",
        generation: int = 0,
        partition_by: Sequence[str] = (),
        compact_every: int | None = None,
        keep: int = 1,
        retain: float = 24 * 3600,
        buckets: int = 16,
        versioned: bool = False,
    ):
        self.spark, self.path, self.merge = spark, path.rstrip("/"), merge
        self.mode, self.generation, self.partition_by = mode, generation, list(partition_by)
        self.compact_every, self.keep, self.retain = compact_every, keep, retain
        self.buckets, self.versioned = buckets, versioned
        rows = spark.createDataFrame([], schema)
        self._partials = merge.partial(rows).schema
        self._keys = rows.select(*merge.keys).schema

    # -- manifests ----------------------------------------------------------------------------

    def manifest(self) -> Manifest:
        names = [int(p.rsplit("/", 1)[1][:-5]) for p in files.glob(self.spark, f"{self.path}/manifest/*.json")]
        return Manifest.read(files.read_text(self.spark, self._manifest_path(max(names)))) if names else Manifest()

    def _manifest_path(self, number: int) -> str:
        return f"{self.path}/manifest/{number:012d}.json"

    def _publish(self, state: Manifest, dropped: Sequence[Piece] = ()) -> None:
        state.number += 1
        now = time.time()
        state.dropped |= {p.path: now for p in dropped}
        files.publish_text(self.spark, self._manifest_path(state.number), json.dumps(asdict(state)))
        if state.number > KEPT_MANIFESTS:
            files.delete(self.spark, self._manifest_path(state.number - KEPT_MANIFESTS))

    # -- writing ------------------------------------------------------------------------------

    def _write(self, df: DataFrame, kind: str, version: Version, folders: Sequence[str] = ()) -> str:
        if folders:
            # One file per folder and task would be very many; this also splits a large folder.
            df = df.hint("rebalance", *folders).sortWithinPartitions(*folders, *self.merge.keys)
        path = f"{kind}/generation={version[0]}/batch_id={version[1]}/attempt={uuid.uuid4().hex}"
        df.write.partitionBy(*folders).parquet(f"{self.path}/{path}")
        return path

    def _generation(self, state: Manifest, stream: str | None) -> int:
        if stream is None:
            return self.generation
        return state.streams.get(stream, 1 + max(state.generations(), default=-1))

    def commit(
        self, rows: DataFrame, batch_id: int, unique_keys: bool = False, stream: str | None = None,
        partials: bool = False,
    ) -> bool:
        """Add a batch; False if it was already there and nothing was done.

        `unique_keys` says that the rows hold each key once, which saves a shuffle. `stream` is the
        id that a stream keeps in its checkpoint: each has its own generation, so the batches of a
        new checkpoint are new ones. Without it, the batch is of the table's `generation`.
        `partials` says that the rows are partials of the table's merge already.
        """
        state = self.manifest()
        generation = self._generation(state, stream)
        if self.mode == "non_transactional":
            known = [p.version for p in state.log] + [(g, r[-1][1]) for g, r in state.folded.items()]
            batch_id = 1 + max((n for g, n in known if g == generation), default=-1)
        version = (generation, batch_id)
        before = next((p for p in state.log if p.version == version), None)
        folded = _within(state.folded, version)
        if self.mode == "transactional" and (folded or before):
            return False
        if folded:
            raise ValueError(f"batch {version} is folded and can no longer be replaced")
        if before is None and version <= state.deleted:
            raise ValueError(f"batch {version} comes after a later delete was folded")
        if self.versioned:
            rows = rows.withColumns({n: F.lit(v).cast("bigint") for n, v in zip(VERSION, version)})
        rows = self.merge.combine(rows) if partials else self.merge.partial(rows, unique_keys)
        path = self._write(rows, "log", version, self.partition_by)
        piece = Piece(path, version, state.number + 1)
        state.log = sorted([*(p for p in state.log if p is not before), piece], key=lambda p: p.version)
        if stream is not None:
            state.streams[stream] = generation
        self._publish(state, [before] if before else [])
        if self.compact_every and len(state.log) >= self.compact_every:
            self.compact(self.keep)
            self.vacuum(self.retain)
        return True

    def delete(self, keys: DataFrame, batch_id: int | None = None, stream: str | None = None) -> bool:
        """Forget what the batches so far, up to `batch_id` if given, say about these keys.

        Batches that come later start afresh. With a `batch_id`, a second delete for it is a replay:
        done already, or, in the other modes, replaced. False if nothing was done.
        """
        state = self.manifest()
        made_for = None if batch_id is None else (self._generation(state, stream), batch_id)
        before = next((p for p in state.deletes if made_for and p.id == made_for), None)
        if made_for and self.mode == "transactional" and (before or _within(state.done_deletes, made_for)):
            return False
        known = [p.version for p in state.log]
        known += [(g, n) for g, ranges in state.folded.items() for r in ranges for n in r]
        if made_for:
            inside = [min(made_for[1], b) for a, b in state.folded.get(made_for[0], []) if a <= made_for[1]]
            known = [v for v in known if v <= made_for] + [(made_for[0], n) for n in inside]
        version = max(known, default=None)
        if version is None:
            return False
        if any(p.version > version for p in state.runs):
            raise ValueError(f"batch {version} is folded together with later ones")
        path = self._write(keys.select(*self.merge.keys).distinct(), "deletes", version)
        piece = Piece(path, version, state.number + 1, id=made_for)
        state.deletes = [*(p for p in state.deletes if p is not before), piece]
        self._publish(state, [before] if before else [])
        return True

    def compact(self, keep: int = 1, where: Column | None = None) -> bool:
        """Fold all but the newest `keep` batches into a run, and full levels into one run each.

        Keep the batches an opaque source may still replay. Runs that a delete acts on are rewritten
        once. With `where`, all are: keys whose partial does not meet it are dropped (last-seen
        values are below `_last` there), which needs every partial of a key. Readers are not
        disturbed; `vacuum()` removes what is folded.
        """
        state = self.manifest()
        cut = state.log[: max(len(state.log) - keep, 0)]
        if not cut:
            return False
        level = 0
        merged = list(cut)
        acting = [d for d in state.deletes if d.version <= cut[-1].version]
        if where is not None or any(r.version <= d.version and r.number < d.number for r in state.runs for d in acting):
            merged, level = [*state.runs, *cut], max([0, *(r.level for r in state.runs)])
        while len(same := [r for r in state.runs if r.level == level and r not in merged]) >= FANOUT - 1:
            merged, level = [*same, *merged], level + 1
        folded = self.merge.combine(self._live(state, merged))
        if where is not None:
            folded = folded.where(where)
        version = max(p.version for p in merged)
        bucketed = folded.withColumn("_bucket", self._bucket())
        path = self._write(bucketed, "base", version, [*self.partition_by, "_bucket"])
        run = Piece(path, version, state.number + 1, level)
        state.log = [p for p in state.log if p not in cut]
        state.runs = [*(r for r in state.runs if r not in merged), run]
        for p in cut:
            _add(state.folded, p.version)
        # A delete is done with once everything it acts on was written after it, without its keys.
        live = [*state.log, *(r for r in state.runs)]
        done = [
            d for d in state.deletes
            if all(p.version > d.version or (p in state.runs and p.number > d.number) for p in live)
        ]
        state.deletes = [d for d in state.deletes if d not in done]
        for d in done:
            state.deleted = max(state.deleted, d.version)
            if d.id:
                _add(state.done_deletes, d.id)
        self._publish(state, [*merged, *done])
        return True

    def vacuum(self, retain: float = 0) -> None:
        """Remove folders that have not counted for `retain` seconds, those of jobs that died among
        them. A view begun before that still reads them, and fails if they go meanwhile."""
        state = self.manifest()
        before = time.time() - retain
        for path in [p for p, since in state.dropped.items() if since <= before]:
            files.delete(self.spark, f"{self.path}/{path}")
            del state.dropped[path]
        known = {p.path for p in (*state.log, *state.runs, *state.deletes)} | set(state.dropped)
        for path, changed in files.modified(self.spark, f"{self.path}/*/generation=*/batch_id=*/attempt=*").items():
            if "/".join(path.split("/")[-4:]) not in known and changed <= before:
                files.delete(self.spark, path)
        self._publish(state)

    # -- reading ------------------------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.merge.keys), F.lit(self.buckets)).cast("int")

    def _read(self, kind: str, pieces: Sequence[Piece], columns: T.StructType) -> DataFrame:
        extra = "generation int, batch_id bigint, attempt string" + (", _bucket int" if kind == "base" else "")
        # The columns of a versioned merge are inside `_last`, so these names are free.
        schema = T.StructType([*columns, *T.StructType.fromDDL(extra)])
        if not pieces:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}")
        return reader.parquet(*[f"{self.path}/{p.path}" for p in pieces])

    def _live(self, state: Manifest, pieces: Sequence[Piece], buckets: Sequence[int] | None = None) -> DataFrame:
        """Partials of these pieces without what deletes cover: one row per key and piece."""
        rows = self._read("log", [p for p in pieces if p.path.startswith("log/")], self._partials)
        runs = [p for p in pieces if p.path.startswith("base/")]
        if runs:
            base = self._read("base", runs, self._partials)
            if buckets is not None:
                base = base.where(F.col("_bucket").isin([int(b) for b in buckets]))
            rows = base.drop("_bucket").unionByName(rows)
        oldest = min((p.version for p in pieces), default=None)
        deletes = [d for d in state.deletes if oldest is not None and d.version >= oldest]
        if deletes:
            version = F.struct(*VERSION)
            keys = self._read("deletes", deletes, self._keys)
            newest = keys.groupBy(*self.merge.keys).agg(F.max(version).alias("_deleted"))
            rows = rows.join(newest, list(self.merge.keys), "left").where(
                F.col("_deleted").isNull() | (version > F.col("_deleted"))
            )
        return rows.select(*self._partials.names)

    def _current(self, buckets: Sequence[int] | None = None) -> tuple[DataFrame, bool]:
        """All partials as of now, and whether they may hold a key more than once."""
        state = self.manifest()
        pieces = [*state.runs, *state.log]
        return self._live(state, pieces, buckets), len(pieces) > 1

    def view(self) -> DataFrame:
        """One row per key as of now. Filters on the keys reach the parquet scans."""
        partials, repeated = self._current()
        return self.merge.finish(self.merge.combine(partials) if repeated else partials)

    def lookup(
        self, requests: DataFrame, spread: Sequence[str] | None = None, selective: bool = False
    ) -> DataFrame:
        """The stored row of each requested key, nulls for a miss.

        `selective` is for requests that name few of the stored keys: only the buckets they fall in
        are read (the driver gets those numbers, at most `buckets`), and the partials there are
        reduced to the keys before anything is shuffled, if the keys are small enough to broadcast.
        """
        keys = list(self.merge.keys)
        if not selective:
            return lookup(requests, self._current()[0], keys, spread, self.merge)
        asked = requests.select(*keys).distinct()
        wanted = [r[0] for r in asked.select(self._bucket().alias("b")).distinct().collect()]
        partials = self._current(wanted)[0].join(asked, keys, "left_semi")
        return lookup(requests, partials, keys, spread, self.merge)
