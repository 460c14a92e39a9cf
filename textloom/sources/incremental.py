"""S8 / S9 with a manifest: an index over files that only reads the files that are new.

The manifest lists every indexed file with its size, modification time and the fragment that holds its rows; a
fragment is the table one update wrote. An update compares the listing of the input with the last manifest, builds
rows for new and changed files alone, and commits by writing the next manifest: readers see the old index until
that write has succeeded, and a failed update leaves a fragment that no manifest names. Rows of vanished or
changed files drop out because the manifest no longer names them. ``compact`` writes one fragment of all live rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_store
from .index import read_if_present

_ENTRY = ["file", "size", "modified"]


def _name(c):
    """One spelling of a file's path, whatever listed it."""
    return F.regexp_replace(c, "^file:/+", "file:/")


class IncrementalIndex:
    """An index kept at ``path``; ``build(spark, files)`` gives the rows of some files with their ``file`` (``_metadata.file_path``)."""

    def __init__(self, spark: SparkSession, path: str, build: Callable[[SparkSession, list[str]], DataFrame]):
        self.spark, self.path, self.build = spark, path.rstrip("/"), build

    def _version(self) -> int:
        """The last committed manifest; -1 where there is none."""
        from pyarrow import fs

        store, name = file_store(f"{self.path}/manifest")
        if store.get_file_info(name).type == fs.FileType.NotFound:
            return -1
        found = [int(f.base_name) for f in store.get_file_info(fs.FileSelector(name)) if f.base_name.isdigit()]
        return max((v for v in found if read_if_present(self.spark, f"{self.path}/manifest/{v}") is not None), default=-1)

    def manifest(self) -> DataFrame | None:
        v = self._version()
        return None if v < 0 else self.spark.read.parquet(f"{self.path}/manifest/{v}")

    def _listing(self, paths) -> DataFrame:
        # the content column is not read: this is the listing alone
        files = self.spark.read.format("binaryFile").load(paths if isinstance(paths, list) else [paths])
        return files.select(_name("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))

    def update(self, paths) -> dict[str, int]:
        """Bring the index up to the files now at ``paths`` (folders or globs); returns how many files were read, kept and dropped."""
        version = self._version()
        listed = self._listing(paths)
        old = None if version < 0 else self.spark.read.parquet(f"{self.path}/manifest/{version}")
        fresh = listed if old is None else listed.join(old, _ENTRY, "left_anti")
        new = [r.file for r in fresh.select("file").collect()]  # the scan needs their names
        kept = None if old is None else old.join(listed, _ENTRY, "left_semi")
        counts = {"read": len(new), "kept": 0 if kept is None else kept.count(), "dropped": 0}
        counts["dropped"] = 0 if old is None else old.count() - counts["kept"]
        if not new and not counts["dropped"] and old is not None:
            return counts
        entries = kept
        if new:
            fragment = uuid.uuid4().hex
            self.build(self.spark, new).withColumn("file", _name("file")).write.parquet(f"{self.path}/fragments/{fragment}")
            added = fresh.select(*_ENTRY, F.lit(fragment).alias("fragment"))
            entries = added if kept is None else kept.select(*_ENTRY, "fragment").unionByName(added)
        if entries is not None:
            entries.select(*_ENTRY, "fragment").write.mode("overwrite").parquet(f"{self.path}/manifest/{version + 1}")
        return counts

    def read(self) -> DataFrame:
        """The rows of all live files, with their ``file``."""
        manifest = self.manifest()
        if manifest is None:
            raise ValueError("the index has no manifest; call update first")
        out = None
        for r in manifest.select("fragment").distinct().orderBy("fragment").collect():  # one row an update
            rows = self.spark.read.parquet(f"{self.path}/fragments/{r.fragment}")
            live = manifest.filter(F.col("fragment") == r.fragment).select("file")
            part = rows.join(live, "file", "left_semi")
            out = part if out is None else out.unionByName(part)
        if out is None:
            raise ValueError("the index holds no file")
        return out

    def compact(self) -> None:
        """One fragment of all live rows in place of many."""
        version, manifest = self._version(), self.manifest()
        fragment = uuid.uuid4().hex
        self.read().write.parquet(f"{self.path}/fragments/{fragment}")
        manifest.withColumn("fragment", F.lit(fragment)).write.mode("overwrite").parquet(f"{self.path}/manifest/{version + 1}")
