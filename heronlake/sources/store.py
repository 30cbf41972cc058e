"""Transactional tables over plain Parquet: a commit log decides which files a table has.

A write goes to new files, then one new numbered commit file names all files of the table; readers follow the newest
commit. A commit file is created exclusively, so of two writers of one version one fails and may retry. Commits and file
lists are kept through Hadoop's file system, so a table can live wherever Spark can write. A batch id leaves a marker file
behind its commit, so whether a batch was written is one look, however long the log.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # files and log

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self, text: str):
        return self._path(text).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _log(self, name: str) -> str:
        return f"{self.root}/{name}/_commits"

    def _versions(self, name: str) -> list[int]:
        fs, log = self._fs(self.root), self._path(self._log(name))
        return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(log) if s.getPath().getName().endswith(".json")) if fs.exists(log) else []

    def _commit_of(self, name: str, version: int) -> dict:
        stream = self._fs(self.root).open(self._path(f"{self._log(name)}/{version:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, name: str, version: int, **what) -> int:
        stream = self._fs(self.root).create(self._path(f"{self._log(name)}/{version:010d}.json"), False)
        try:
            stream.write(bytearray(json.dumps(what | {"version": version, "at": time.time()}).encode()))
        finally:
            stream.close()
        if what.get("batch") is not None:
            self._fs(self.root).create(self._path(self._marker(name, what["batch"])), True).close()
        return version

    def _marker(self, name: str, batch: str) -> str:
        return f"{self.root}/{name}/_batches/{hashlib.sha256(batch.encode()).hexdigest()}"

    def _written(self, name: str, batch: str | None) -> bool:
        """Whether a batch is in the log: its marker is there, or it is the newest commit (whose marker may be missing)."""
        if batch is None or not self.exists(name):
            return False
        return self._fs(self.root).exists(self._path(self._marker(name, batch))) or self._latest(name).get("batch") == batch

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def history(self, name: str) -> list[dict]:
        """Commits, newest first: version, operation, predicate, batch."""
        return [{k: c.get(k) for k in ("version", "operation", "predicate", "batch")} for c in (self._commit_of(name, v) for v in reversed(self._versions(name)))]

    def _latest(self, name: str, version: int | None = None) -> dict:
        versions = self._versions(name)
        if not versions:
            raise FileNotFoundError(f"no table {name} in {self.root}")
        return self._commit_of(name, versions[-1] if version is None else version)

    # reading

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table as of a version (default: newest); columns added later read as null in older files."""
        commit = self._latest(name, version)
        return self._files(name, commit, commit["files"])

    def _files(self, name: str, commit: dict, files: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(commit["schema"])
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}/data").parquet(*files).select(*schema.names)

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    # writing

    def _write(self, name: str, df: DataFrame, partition_by: list[str]) -> list[str]:
        """Write df as new files and return them: folders (one for each partition), or files where there are no partitions."""
        run = uuid.uuid4().hex
        target = f"{self.root}/{name}/data/run={run}"
        if partition_by:
            # rows of a partition come together, in pieces that adaptive execution keeps to a good size: else each task writes a file a partition
            df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(target)
        else:
            df.write.parquet(target)
        fs = self._fs(self.root)

        def leaves(at, depth: int) -> list[str]:
            if depth == 0:
                return [at.toString()] if partition_by else sorted(s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-"))
            return [x for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName() for x in leaves(s.getPath(), depth - 1)]

        return leaves(self._path(target), len(partition_by))

    def overwrite(self, name: str, df: DataFrame, partition_by: list[str] | None = None, operation: str = "overwrite") -> int:
        """Replace all rows and the schema (columns may go as well as come)."""
        versions = self._versions(name)
        files = self._write(name, df, partition_by or [])
        return self._commit(name, versions[-1] + 1 if versions else 0, operation=operation, schema=df.schema.jsonValue(), files=files, partition_by=partition_by or [])

    def drop(self, name: str) -> None:
        """Remove a table with its files and its log."""
        self._fs(self.root).delete(self._path(f"{self.root}/{name}"), True)

    def ensure(self, name: str, schema: T.StructType, partition_by: list[str] | None = None) -> None:
        """Create an empty table of a schema where there is none."""
        if not self.exists(name):
            self._commit(name, 0, operation="create", schema=schema.jsonValue(), files=[], partition_by=partition_by or [])

    def append(self, name: str, df: DataFrame, batch: str | None = None, partition_by: list[str] | None = None) -> int:
        """Add rows; new columns extend the schema. A batch that is already in the log is not added again."""
        if not self.exists(name):
            self.ensure(name, df.schema, partition_by)
        if self._written(name, batch):
            return self._versions(name)[-1]
        old = self._latest(name)
        files = self._write(name, df, old["partition_by"])
        return self._commit(name, old["version"] + 1, operation="append", batch=batch, schema=self._merged(old, df), files=old["files"] + files, partition_by=old["partition_by"])

    def _merged(self, old: dict, df: DataFrame) -> dict:
        fields = {f.name: f for f in T.StructType.fromJson(old["schema"]).fields}
        for f in df.schema.fields:
            if f.name in fields and fields[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name} changes its type")
            fields.setdefault(f.name, f)
        return T.StructType(list(fields.values())).jsonValue()

    def replace_range(self, name: str, df: DataFrame, start: str, end: str, column: str = "event_date") -> int:
        """Replace the partitions with start <= column < end by df, whose rows must lie in the range.

        Partitions of the range that df has no rows for are gone afterwards; others keep their very files. df is evaluated
        once: the range is checked on the partitions written, before they are committed.
        """
        old = self._latest(name)
        if old["partition_by"] != [column]:
            raise ValueError(f"{name} is not partitioned by {column}")
        inside = lambda value: start <= value < end
        schema = self._merged(old, df)
        files = self._write(name, df, [column])
        if not all(inside(f.rpartition("=")[2]) for f in files):
            for f in files:
                self._fs(f).delete(self._path(f), True)
            raise ValueError("rows outside the range")
        kept = [f for f in old["files"] if not inside(f.rpartition("=")[2])]
        return self._commit(name, old["version"] + 1, operation="replace_range", predicate=f"{start} <= {column} < {end}", schema=schema, files=kept + files, partition_by=[column])

    def upsert(self, name: str, df: DataFrame, key: list[str], batch: str | None = None) -> int:
        """Rows of df replace those with equal keys, others are added; the first call creates the table.

        Of rows of df with equal keys one is taken: the greatest by its other columns. Null keys are equal to each other.
        Only files that hold a key of df are rewritten; df should be a batch that is small beside the table.
        """
        if self._written(name, batch):
            return self._versions(name)[-1]
        others = [c for c in df.columns if c not in key]
        one = df.groupBy(*key).agg(F.max(F.struct(*others)).alias("_v")).select(*key, "_v.*").select(*df.columns) if others else df.distinct()
        if not self.exists(name):
            files = self._write(name, one, [])
            return self._commit(name, 0, operation="upsert", batch=batch, schema=df.schema.jsonValue(), files=files, partition_by=[])
        old = self._latest(name)
        new = one.persist()
        try:
            table = self.read(name)
            keys = new.select(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(key)))

            def same(df: DataFrame):
                out = F.lit(True)
                for i, c in enumerate(key):
                    out = out & df[c].eqNullSafe(keys[f"_k{i}"])
                return out

            placed = table.withColumn("_file", F.input_file_name())
            hit = {self._tail(r["_file"]) for r in placed.join(keys, same(placed), "left_semi").select("_file").distinct().collect()}  # at most the table's files
            touched = [f for f in old["files"] if any(t.startswith(self._tail(f)) for t in hit)]
            merged = new
            if touched:
                rows = self._files(name, old, touched)
                merged = rows.join(keys, same(rows), "left_anti").unionByName(new, allowMissingColumns=True)
            files = self._write(name, merged, old["partition_by"])
            return self._commit(name, old["version"] + 1, operation="upsert", batch=batch, schema=self._merged(old, df), files=[f for f in old["files"] if f not in set(touched)] + files, partition_by=old["partition_by"])
        finally:
            new.unpersist()

    @staticmethod
    def _tail(path: str) -> str:
        """The part of a file's name that every way to spell its folder agrees on."""
        return unquote(path).rpartition("/run=")[2]
