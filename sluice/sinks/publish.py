"""Publishing files that survives a crash: stage, manifest, swap, and recovery of what was left open.

A table in a folder is never deleted to be written again. Its new files are written to a
hidden folder inside it, by Spark's own commit protocol. Then a manifest names what goes and what
comes, and one rename makes it valid: that is the commit. Only after it are old folders moved
away and new ones moved in, rename by rename. Every step of the swap can be repeated, so a
run that is killed at any point loses nothing: before the manifest the table is as it was, and
after it :func:`recover`, which every later publish calls first, finishes the swap.

Scans skip the hidden folder, as they skip every name that begins with an underscore. One
writer works on a table at a time. The driver handles names of partitions only, never rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

HIDDEN = "_sluice_publish"
MANIFEST = "manifest.json"
#: a stage without a manifest is a run that failed or is still writing; after so long it is removed
ABANDONED_SECONDS = 7 * 24 * 3600


class Folder:
    """Hadoop file-system calls below one path, whatever store it lies in."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._path = spark, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = self._path(path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, rel: str = ""):
        return self._path(self.root, rel) if rel else self.root

    def uri(self, rel: str = "") -> str:
        return self.at(rel).toString()

    def exists(self, rel: str = "") -> bool:
        return self.fs.exists(self.at(rel))

    def entries(self, rel: str = "") -> list[tuple[str, bool, int]]:
        """``(name, is a folder, modified in ms)`` of what lies directly below."""
        if not self.exists(rel):
            return []
        return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in self.fs.listStatus(self.at(rel))]

    def visible(self, rel: str = "") -> list[tuple[str, bool]]:
        return sorted((n, d) for n, d, _ in self.entries(rel) if not n.startswith(("_", ".")))

    def move(self, old: str, new: str) -> None:
        self.fs.mkdirs(self.at(new).getParent())
        if not self.fs.rename(self.at(old), self.at(new)):
            raise OSError(f"cannot move {self.uri(old)} to {self.uri(new)}")

    def delete(self, rel: str) -> None:
        self.fs.delete(self.at(rel), True)

    def read(self, rel: str) -> str:
        stream = self.fs.open(self.at(rel))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, rel: str, text: str) -> None:
        """The file appears under its name at once and whole, in place of one that was there."""
        part = f"{rel}.{uuid.uuid4().hex[:8]}.tmp"
        stream = self.fs.create(self.at(part), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(rel):
            self.delete(rel)
        self.move(part, rel)

    def partitions(self, rel: str, depth: int) -> list[str]:
        """Folders ``depth`` levels below ``rel``, relative to it: the partitions of a table."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{n}".lstrip("/") for f in found for n, is_dir in self.visible(f"{rel}/{f}".strip("/")) if is_dir]
        return found


def _swap(folder: Folder, tx: str) -> None:
    """Carry out a manifest; each move is skipped if it was made before."""
    plan = json.loads(folder.read(f"{tx}/{MANIFEST}"))
    for rel in plan["remove"]:
        if folder.exists(rel) and not folder.exists(f"{tx}/old/{rel}"):
            folder.move(rel, f"{tx}/old/{rel}")
    for rel in plan["add"]:
        if folder.exists(f"{tx}/data/{rel}"):
            folder.move(f"{tx}/data/{rel}", rel)


def recover(spark: SparkSession, path: str, committed: Callable[[str], None] | None = None) -> list[str]:
    """Finish every publish of the table that was committed but not carried out; returns their names.

    ``committed`` is called with each name before its traces are deleted.
    """
    folder, finished = Folder(spark, path), []
    for name, is_dir, modified in sorted(folder.entries(HIDDEN)):
        tx = f"{HIDDEN}/{name}"
        if not is_dir:
            continue
        if folder.exists(f"{tx}/{MANIFEST}"):
            _swap(folder, tx)
            if committed:
                committed(name)
            folder.delete(tx)
            finished.append(name)
        elif modified / 1000 < time.time() - ABANDONED_SECONDS:
            folder.delete(tx)
    return finished


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_cols: Sequence[str] = (), scope: str = "table",
            below: str = "", options: dict[str, str] | None = None, name: str | None = None, committed: Callable[[], None] | None = None) -> str:
    """Write ``df`` and put it in the place of what ``scope`` names; returns the publish's name.

    ``scope``: ``"table"`` replaces everything, ``"present"`` the partitions that ``df`` holds,
    ``"append"`` nothing. With ``below``, a partition folder (``"dt=1"``), that folder is replaced
    by ``df``, also when ``df`` is empty. ``committed`` is called when the swap is done, before its
    traces are deleted. If the write fails, the table is as it was.
    """
    spark = df.sparkSession
    recover(spark, path)
    folder = Folder(spark, path)
    name = name or uuid.uuid4().hex[:16]
    tx = f"{HIDDEN}/{name}"
    folder.delete(tx)  # what a failed run of the same name left
    writer = df.write.mode("overwrite").format(fmt).options(**(options or {}))
    try:
        (writer.partitionBy(*partition_cols) if partition_cols else writer).save(folder.uri(f"{tx}/data/{below}".rstrip("/")))
        if below:
            add, remove = [below], [below] if folder.exists(below) else []
        elif scope == "table":
            add = [n for n, _ in folder.visible(f"{tx}/data")]
            remove = [n for n, _ in folder.visible()]
        elif scope == "append":
            # files keep apart from those of other runs: Spark gives every write its own file names
            add, remove = _files(folder, f"{tx}/data", len(partition_cols)), []
        else:
            add = folder.partitions(f"{tx}/data", len(partition_cols))
            remove = [rel for rel in add if folder.exists(rel)]
        folder.write(f"{tx}/{MANIFEST}", json.dumps({"remove": remove, "add": add}))
    except BaseException:
        if not folder.exists(f"{tx}/{MANIFEST}"):
            folder.delete(tx)
        raise
    _swap(folder, tx)
    if committed:
        committed()
    folder.delete(tx)
    return name


def _files(folder: Folder, rel: str, depth: int) -> list[str]:
    return [f"{p}/{n}".lstrip("/") for p in folder.partitions(rel, depth) for n, is_dir in folder.visible(f"{rel}/{p}".rstrip("/")) if not is_dir]
