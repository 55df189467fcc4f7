"""Tables whose content changes in one step: parts of data, and manifests that name the live ones.

A writer first writes a part, a Parquet folder nobody reads yet. Then it puts manifest n + 1 beside
manifest n by a rename that does not overwrite: of two writers that started from the same
version one wins, the other starts again from the new version. Readers take the newest manifest,
so they see the old content or the new one, never half of either, also when a writer dies.
Manifests are small: the names of live parts and of the batches added so far, no rows.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.sources.bucketed import read_bucketed, write_bucketed
from loanloom.sources.files import file_system, names, read_text

TRIES = 10
#: A local file system, as in tests, looks before it renames; writers of one session take turns there.
_TURN = threading.Lock()


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    parts: tuple[str, ...] = ()
    batches: tuple[str, ...] = ()


@dataclass(frozen=True)
class VersionedTable:
    """A table at ``root`` on storage all executors reach, its parts partitioned by ``by``.

    With ``buckets`` the rows of a part lie in that many files by the hash of ``bucket_by``, sorted
    by it, so a join on that column shuffles and sorts the other side only. Such a table is
    changed by ``replace`` and has one part.
    """

    spark: SparkSession
    root: str
    schema: str
    by: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0

    def manifest(self) -> Manifest:
        """The newest version; version 0 has no parts."""
        found = sorted(n for n in names(self.spark, f"{self.root}/manifests") if n.endswith(".json"))
        if not found:
            return Manifest()
        told = json.loads(read_text(self.spark, f"{self.root}/manifests/{found[-1]}"))
        return Manifest(told["version"], tuple(told["parts"]), tuple(told["batches"]))

    def read(self, at: Manifest | None = None) -> DataFrame:
        """Rows of a version, the newest by default; its partitions are pruned as in any store."""
        parts = (at or self.manifest()).parts
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        if self.bucket_by:
            return self._bucketed(parts[-1])
        # A part is a partition of its own, so that one scan covers them all.
        stored = self.spark.read.schema(f"{self.schema}, _part string").option("basePath", f"{self.root}/parts")
        return stored.parquet(*[self._part(p) for p in parts]).drop("_part")

    def append(self, rows: DataFrame, batch: str) -> bool:
        """Add the rows of a batch; False, and nothing done, if this batch was added before."""
        if batch in self.manifest().batches:
            return False
        part = self._write(rows)
        for _ in range(TRIES):
            old = self.manifest()
            if batch in old.batches:
                return False
            if self._put(Manifest(old.version + 1, (*old.parts, part), (*old.batches, batch))):
                return True
        raise RuntimeError(f"{self.root}: other writers were faster {TRIES} times")

    def replace(self, change: Callable[[DataFrame], DataFrame], batch: str | None = None) -> bool:
        """Swap the content for what ``change`` makes of it; made anew when another writer was first.

        With ``batch``, False and nothing done if this batch was added before.
        """
        for _ in range(TRIES):
            old = self.manifest()
            if batch in old.batches:
                return False
            part = self._write(change(self.read(old)))
            if self._put(Manifest(old.version + 1, (part,), (*old.batches, *([batch] if batch else [])))):
                return True
        raise RuntimeError(f"{self.root}: other writers were faster {TRIES} times")

    def vacuum(self, keep: int = 2, older_than_hours: float = 24 * 7) -> list[str]:
        """Remove parts that none of the last ``keep`` versions has, and older manifests.

        The age spares the parts of writers that have not put their manifest yet.
        """
        found = sorted(n for n in names(self.spark, f"{self.root}/manifests") if n.endswith(".json"))
        live = set()
        for name in found[-keep:]:
            live |= set(json.loads(read_text(self.spark, f"{self.root}/manifests/{name}"))["parts"])
        before = time.time() - older_than_hours * 3600
        gone = [p for p in names(self.spark, f"{self.root}/parts", before) if p.removeprefix("_part=") not in live]
        for path in [*(f"manifests/{n}" for n in found[:-keep]), *(f"parts/{p}" for p in gone)]:
            fs, target = file_system(self.spark, f"{self.root}/{path}")
            fs.delete(target, True)
        return gone

    def _part(self, name: str) -> str:
        return f"{self.root}/parts/_part={name}"

    def _write(self, rows: DataFrame) -> str:
        part = uuid.uuid4().hex
        if self.by:
            rows = rows.hint("rebalance", *map(F.col, self.by))
        if not self.bucket_by:
            rows.write.partitionBy(*self.by).parquet(self._part(part))
            return part
        write_bucketed(rows, self._part(part), self.bucket_by, self.buckets)
        return part

    def _bucketed(self, part: str) -> DataFrame:
        return read_bucketed(self.spark, self._part(part), self.schema, self.bucket_by, self.buckets)

    def _put(self, manifest: Manifest) -> bool:
        """Whether the manifest is now the one of its version; False if another one is."""
        text = json.dumps({"version": manifest.version, "parts": manifest.parts, "batches": manifest.batches})
        jvm = self.spark._jvm
        fs, draft = file_system(self.spark, f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifests/{manifest.version:012d}.json")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            with _TURN:
                files.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True
