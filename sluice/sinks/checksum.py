"""Checksums of written files: sidecars, and a manifest that files are verified against.

Sidecars are ``<file>.md5`` files holding ``MD5 name``, in the hidden folder ``_md5`` beside the files,
so that a scan of the folder does not read them as rows. The manifest is one hidden table for all
files of a folder (path, length, MD5); :func:`verify_checksums` joins what is there to it.

The sums are computed by :func:`sluice.sources.inventory.file_checksums` (streamed in
tasks). Each sidecar is written by the task that summed the file, so the work stays
distributed; rewriting a sidecar is idempotent, so a retried task is harmless.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sinks.publish import Folder, publish
from sluice.sources.inventory import file_checksums, list_files

MD5_SUFFIX = ".md5"
SIDECARS = "_md5"
MANIFEST = "_sluice_md5"


def _write_sidecars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for pdf in batches:
        for p, name, md5 in zip(pdf["path"], pdf["name"], pdf["md5"]):
            above, _, file = p.rpartition("/")
            sidecar = f"{above}/{SIDECARS}/{file}{MD5_SUFFIX}"
            parsed = urlparse(sidecar)
            if parsed.scheme in ("", "file"):
                filesystem, target = fs.LocalFileSystem(), unquote(parsed.path)
            else:
                filesystem, target = fs.FileSystem.from_uri(sidecar)
            filesystem.create_dir(target.rpartition("/")[0], recursive=True)
            with filesystem.open_output_stream(target) as out:
                out.write(f"{md5} {name}\n".encode())
        yield pdf


def write_checksums(spark: SparkSession, path: str, name_glob: str = "part-*") -> int:
    """Write a sidecar next to every matching file; returns the number of files summed."""
    sums = file_checksums(spark, path, name_glob=name_glob)
    return sums.mapInPandas(_write_sidecars, sums.schema).count()


def _sums(spark: SparkSession, path: str, name_glob: str | None) -> DataFrame:
    """``file`` (relative to ``path``), ``length`` and ``md5`` of every visible file below it."""
    root = Folder(spark, path)
    root = root.fs.makeQualified(root.at()).toUri().getPath().rstrip("/") + "/"
    sums = file_checksums(spark, path, name_glob=name_glob).join(list_files(spark, path, name_glob=name_glob).select("path", "length"), "path")
    plain = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    return sums.select(F.substring_index(plain, root, -1).alias("file"), "length", "md5")


def write_manifest(spark: SparkSession, path: str, name_glob: str | None = None) -> int:
    """Sum every visible file below ``path`` and keep the sums in a hidden table there; how many there are.

    The table is replaced as a whole, by a publish: a killed run leaves the old or the new one.
    """
    publish(_sums(spark, path, name_glob), f"{path.rstrip('/')}/{MANIFEST}")
    return spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}").count()


def verify_checksums(spark: SparkSession, path: str, name_glob: str | None = None) -> DataFrame:
    """``file, status, length, md5``: ``ok``, ``changed``, ``missing`` or ``extra`` against the manifest.

    Length and sum are those found, or of a missing file those it should have.
    """
    known = spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}").select("file", F.col("length").alias("known_length"), F.col("md5").alias("known_md5"))
    status = (F.when(F.col("known_md5").isNull(), "extra").when(F.col("md5").isNull(), "missing")
              .when((F.col("md5") == F.col("known_md5")) & (F.col("length") == F.col("known_length")), "ok").otherwise("changed"))
    return (_sums(spark, path, name_glob).join(known, "file", "full")
            .select("file", status.alias("status"), F.coalesce("length", "known_length").alias("length"), F.coalesce("md5", "known_md5").alias("md5")))
