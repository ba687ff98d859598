"""Partitioned Parquet tables whose changes become visible in one rename.

Every write goes to folders of its own; a numbered commit file names the folder of each partition, further
tables written along, and a small dictionary. A commit file is written under another name and renamed to the next number,
which fails if someone else has taken that number since the table was read. So a reader sees one commit, a crash before the
rename changes nothing, and of two writers that start from one commit the second is refused and may start again.
The rename must not replace an existing file: true of HDFS; an object store needs a committer with that guarantee.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since the table was read."""


@dataclass
class Snapshot:
    """One commit: its number, the folder of each partition (by its values as strings), other tables, and what the writer noted."""

    number: int = 0
    folders: dict[tuple[str | None, ...], str] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)
    meta: dict = field(default_factory=dict)


def _slot(by: Iterable[str]) -> Column:
    """Folder name of a partition: a hash of its values, in which NULL differs from any string."""
    return F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in by]), {"ignoreNullFields": "false"}))


class PartitionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- files -------------------------------------------------------------
    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _numbers(self) -> list[int]:
        fs, path = self._path("_commits")
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _load(self, number: int) -> Snapshot:
        fs, path = self._path(f"_commits/{number:012d}.json")
        jvm = self.spark.sparkContext._jvm
        stream = fs.open(path)
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        raw = json.loads(text)
        return Snapshot(number, {tuple(values): folder for values, folder in raw["folders"]}, raw["tables"], raw["meta"])

    # -- reading -----------------------------------------------------------
    def snapshot(self) -> Snapshot:
        """The newest commit (number 0 and no folders where there is none)."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else Snapshot()

    def read(self, only: Iterable[tuple] | None = None, at: Snapshot | None = None) -> DataFrame | None:
        """The rows of the commit, or of the partitions with these values; None where there are none. Any failing read is raised."""
        at = at or self.snapshot()
        wanted = None if only is None else {tuple(None if v is None else str(v) for v in values) for values in only}
        folders = [f for values, f in at.folders.items() if wanted is None or values in wanted]
        return self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.root}/{f}" for f in sorted(folders)]) if folders else None

    def table(self, name: str, at: Snapshot | None = None) -> DataFrame | None:
        """A table that was committed along."""
        folder = (at or self.snapshot()).tables.get(name)
        return None if folder is None else self.spark.read.parquet(f"{self.root}/{folder}")

    # -- writing -----------------------------------------------------------
    def commit(self, rows: DataFrame, by: list[str], base: Snapshot, spread: Iterable[str] = (), tables: dict[str, DataFrame] | None = None,
               meta: dict | None = None, keep: int = 2) -> Snapshot:
        """Replace the partitions that ``rows`` holds, whole, on top of ``base``.

        ``rows`` is read twice (materialise it first); it is range-partitioned by partition and the columns of ``spread``, so a
        busy partition is written by many tasks and a quiet one into few files. ``keep`` commits stay readable.
        """
        version = f"data/{uuid.uuid4().hex}"
        slots = rows.select(*[F.col(c).cast("string").alias(c) for c in by]).distinct().withColumn("_slot", _slot(by)).collect()
        if slots:
            rows.withColumn("_slot", _slot(by)).repartitionByRange("_slot", *spread).write.partitionBy("_slot").parquet(f"{self.root}/{version}")
        folders = dict(base.folders) | {tuple(r[c] for c in by): f"{version}/_slot={r['_slot']}" for r in slots}
        named = dict(base.tables)
        for name, df in (tables or {}).items():
            named[name] = f"{version}-{name}"
            df.write.parquet(f"{self.root}/{named[name]}")
        new = Snapshot(base.number + 1, folders, named, dict(base.meta) | (meta or {}))
        self._publish(new)
        self._forget(new, keep)
        return new

    def _publish(self, new: Snapshot) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, target = self._path(f"_commits/{new.number:012d}.json")
        _, tmp = self._path(f"_commits/{new.number:012d}.{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps({"folders": [[list(k), f] for k, f in new.folders.items()], "tables": new.tables, "meta": new.meta}).encode()))
        out.close()
        if fs.exists(target):
            fs.delete(tmp, False)
            raise ConcurrentCommit(f"commit {new.number} of {self.root} is taken")
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(tmp, target, options)
        except Exception as e:
            if fs.exists(tmp):
                fs.delete(tmp, False)
                if fs.exists(target):
                    raise ConcurrentCommit(f"commit {new.number} of {self.root} is taken") from e
            raise

    def _forget(self, new: Snapshot, keep: int) -> None:
        """Delete commits older than the ``keep`` newest, and the folders that only they name."""
        old = [n for n in self._numbers() if n <= new.number - max(2, keep)]
        if not old:
            return
        used = {f for n in self._numbers() if n not in old for s in [self._load(n)] for f in [*s.folders.values(), *s.tables.values()]}
        for n in old:
            gone = self._load(n)
            for folder in {*gone.folders.values(), *gone.tables.values()} - used:
                fs, path = self._path(folder)
                fs.delete(path, True)
            fs, path = self._path(f"_commits/{n:012d}.json")
            fs.delete(path, False)
