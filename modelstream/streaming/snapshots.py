"""A table of updates by batch whose readers touch few files, however long it has been written.

Every batch writes one delta. Every `every` deltas the rows that still matter are written as a snapshot. A manifest names the
two newest snapshots and the deltas after the older one; it is replaced by a rename, so a reader sees a commit whole or not
at all. A batch that is run again replaces its own delta, and what it may have put into a snapshot is left out: the older
snapshot and the deltas before the batch are still there. Files that no manifest names any more stay for `KEPT` further
commits, for readers that planned with an older one, and are then removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
KEPT = 32


class Folder:
    """Small files of a folder in whatever file system Spark reaches it by, from the driver."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self._fs.exists(self._path("")):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path("")))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write under a name of its own first: the file appears whole."""
        draft = f".{name}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(self._path(draft), self._path(name)):
            self._fs.delete(self._path(draft), False)
            raise RuntimeError(f"{self.path}/{name} is there already: a second writer?")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


@dataclass
class Manifest:
    """Parts as [batch, folder], in the order of the batches; `retired` are [commit, folder] that nothing names any more."""

    commit: int = 0
    snapshots: list[list] = field(default_factory=list)
    deltas: list[list] = field(default_factory=list)
    retired: list[list] = field(default_factory=list)

    def parts(self, before: int | None = None) -> list[str]:
        """The folders that hold the updates of the batches before `before`: a snapshot and the deltas after it."""
        limit = float("inf") if before is None else before
        base = [s for s in self.snapshots if s[0] < limit][-1:]
        if not base and self.snapshots:
            raise ValueError(f"updates before batch {before} are no longer kept")
        after = base[0][0] if base else float("-inf")
        return [*[s[1] for s in base], *[d[1] for d in self.deltas if after < d[0] < limit]]


class SnapshotTable:
    """Updates of `schema` by batch under `path`, with one writer.

    `reduce` takes all updates, each with its batch in column ``batch_id``, and returns those that still matter; it must give the
    same for a snapshot and later updates as for all of them.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, reduce: Callable[[DataFrame], DataFrame], every: int = 16
    ) -> None:
        self.path, self.schema, self.every, self.reduce = path.rstrip("/"), schema, every, reduce
        self.full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        self._top, self._log = Folder(spark, self.path), Folder(spark, f"{self.path}/_manifest")

    def manifest(self) -> Manifest:
        """The newest commit."""
        for attempt in range(5):
            names = [n for n in self._log.names() if n.endswith(".json") and not n.startswith(".")]
            if not names:
                return Manifest()
            try:
                return Manifest(**json.loads(self._log.read(names[-1])))
            except Exception:  # replaced by the writer between listing and reading
                if attempt == 4:
                    raise
        raise AssertionError

    def _commit(self, manifest: Manifest) -> None:
        manifest.commit += 1
        gone = [r for r in manifest.retired if r[0] + KEPT < manifest.commit]
        manifest.retired = [r for r in manifest.retired if r not in gone]
        self._log.write(f"{manifest.commit:012d}.json", json.dumps(manifest.__dict__))
        for _, name in gone:
            self._top.remove(name)
        for name in self._log.names():
            if name.endswith(".json") and name < f"{manifest.commit - 1:012d}.json":
                self._log.remove(name)

    def _write(self, rows: DataFrame, kind: str, batch_id: int) -> str:
        name = f"{kind}-{max(batch_id, 0):012d}-{uuid.uuid4().hex}"
        # Few files, whatever the number of tasks.
        rows.select(*self.full.names).hint("rebalance").write.parquet(f"{self.path}/{name}")
        return name

    def _read(self, spark: SparkSession, parts: list[str]) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], self.full)
        return spark.read.schema(self.full).parquet(*[f"{self.path}/{p}" for p in parts])

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Keep the updates of a batch; they replace what an earlier run of it wrote."""
        spark = batch.sparkSession
        manifest = self.manifest()
        manifest.parts(batch_id)
        old = [d for d in manifest.deltas if d[0] == batch_id] + [s for s in manifest.snapshots if s[0] >= batch_id]
        manifest.retired += [[manifest.commit, name] for _, name in old]
        manifest.deltas = [d for d in manifest.deltas if d not in old]
        manifest.snapshots = [s for s in manifest.snapshots if s not in old]
        rows = batch.select(*self.schema.names).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        manifest.deltas = sorted([*manifest.deltas, [batch_id, self._write(rows, "delta", batch_id)]])
        newest = manifest.snapshots[-1][0] if manifest.snapshots else float("-inf")
        if sum(d[0] > newest for d in manifest.deltas) >= self.every and manifest.deltas[-1][0] == batch_id:
            rows = self.reduce(self._read(spark, manifest.parts()))
            manifest.snapshots.append([batch_id, self._write(rows, "snapshot", batch_id)])
            if len(manifest.snapshots) > 2:
                manifest.retired.append([manifest.commit, manifest.snapshots.pop(0)[1]])
                oldest = manifest.snapshots[0][0]
                manifest.retired += [[manifest.commit, name] for at, name in manifest.deltas if at <= oldest]
                manifest.deltas = [d for d in manifest.deltas if d[0] > oldest]
        self._commit(manifest)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The updates of a batch that is still kept."""
        found = [name for at, name in self.manifest().deltas if at == batch_id]
        return self._read(spark, found).drop(BATCH)

    def rows(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """What matters of the updates of the batches before `before` (of all without it), with ``batch_id``."""
        return self.reduce(self._read(spark, self.manifest().parts(before)))
