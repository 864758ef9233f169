"""Tables as numbered versions: a reader sees one whole version, or the one before it, at any moment.

`path/versions/<n>-<id>` holds the files of a version and `path/manifests/<n>` names the folder that counts
as version n. A manifest is created, never replaced: of several writers that prepare the same number
one succeeds, and the others take the next number. A version without a manifest is not seen.

That rests on a rename that refuses an existing target, as distributed file systems have it. Where a rename
replaces files (local disks), writers of one table must take turns; readers are safe there too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from issuelens.sources.sinks import file_system, write_table

# Digits of a version number in the name of its manifest.
DIGITS = 12


def _manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, smallest first."""
    system, folder = file_system(spark, f"{path}/manifests")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def _folder_of(spark: SparkSession, path: str, number: int) -> str:
    system, manifest = file_system(spark, f"{path}/manifests/{number:0{DIGITS}d}")
    stream = system.open(manifest)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The newest published version, or null if there is none."""
    numbers = _manifests(spark, path)
    return numbers[-1] if numbers else None


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """One whole version: the newest if no number is given."""
    number = latest_version(spark, path) if number is None else number
    if number is None:
        raise FileNotFoundError(f"no published version of {path}")
    return spark.read.parquet(f"{path}/versions/{_folder_of(spark, path, number)}")


def _claim(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Create the manifest of `number`; false if another writer has it already.

    The name is written whole under a name of its own and then renamed, which fails if the target exists, so that
    a reader never meets half a manifest.
    """
    system, manifest = file_system(spark, f"{path}/manifests/{number:0{DIGITS}d}")
    draft = file_system(spark, f"{path}/manifests/.{folder}")[1]
    stream = system.create(draft, True)
    try:
        stream.writeUTF(folder)
    finally:
        stream.close()
    if not system.exists(manifest) and system.rename(draft, manifest):
        return _folder_of(spark, path, number) == folder
    system.delete(draft, False)
    return False


def publish_version(df: DataFrame, path: str, partition: str | None = None) -> int:
    """Write a new version, publish it and return its number. Earlier versions stay readable."""
    spark = df.sparkSession
    number = (latest_version(spark, path) or 0) + 1
    folder = f"{number:0{DIGITS}d}-{uuid.uuid4().hex}"
    write_table(df, f"{path}/versions/{folder}", partition)
    while not _claim(spark, path, number, folder):
        number += 1
    return number


def drop_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all versions but the newest `keep`, manifests first; returns the numbers that went."""
    if keep < 1:
        raise ValueError("at least one version stays")
    gone = _manifests(spark, path)[:-keep]
    for number in gone:
        folder = _folder_of(spark, path, number)
        for old in (f"{path}/manifests/{number:0{DIGITS}d}", f"{path}/versions/{folder}"):
            system, target = file_system(spark, old)
            system.delete(target, True)
    return gone
