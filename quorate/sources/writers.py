"""Versioned tables, manifests and releases. Paths may be local or of any store that Spark reads."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; empty where there is none."""
    fs, p = _fs(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect()))  # one file


def write_json(spark: SparkSession, path: str, value: Mapping) -> None:
    write_text(spark, path, json.dumps(value, indent=1, sort_keys=True, ensure_ascii=False))


def write_versioned(df: DataFrame, folder: str, name: str, version: str, keep: int = 1, partition_by: Sequence[str] = ()) -> str:
    """Writes name.version.parquet (ZSTD) and drops older versions of the name, but for `keep`."""
    spark, path = df.sparkSession, f"{folder}/{name}.{version}.parquet"
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    own = [n for n in names(spark, folder) if re.fullmatch(rf"{re.escape(name)}\.\d+\.parquet", n)]
    for old in own[:-keep] if keep else []:
        delete(spark, f"{folder}/{old}")
    return path


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_keyed(df: DataFrame, path: str, key: str, files: int) -> None:
    """ZSTD Parquet with the rows of a key in one of `files` files."""
    df.repartition(files, key).write.mode("overwrite").option("compression", "zstd").parquet(path)


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Ends a swap that a lost driver left half-way: the new table if it was written to its end, else the old one."""
    if not exists(spark, path):
        if exists(spark, f"{path}.new/_SUCCESS"):
            _move(spark, f"{path}.new", path)
        elif exists(spark, f"{path}.old"):
            _move(spark, f"{path}.old", path)
    if exists(spark, path):
        delete(spark, f"{path}.old")


def rewrite(df: DataFrame, path: str) -> None:
    """Replaces a table that df may read from: written beside it, then swapped.

    At every moment the old or the new rows are whole in path, path.old or
    path.new; recover() puts them back in place, and comes first here.
    """
    spark = df.sparkSession
    recover(spark, path)
    delete(spark, f"{path}.new")
    df.write.parquet(f"{path}.new")
    if exists(spark, path):
        _move(spark, path, f"{path}.old")
    _move(spark, f"{path}.new", path)
    delete(spark, f"{path}.old")


def release_version(stamps: Sequence[str]) -> str:
    """The latest stamp with 12 hex digits of the MD5 of all, sorted; equal inputs give equal versions."""
    return f"{max(stamps)}-{hashlib.md5(''.join(sorted(stamps)).encode()).hexdigest()[:12]}"


def releases(spark: SparkSession, folder: str) -> list[str]:
    """Versions in a folder, oldest first."""
    return [n for n in names(spark, folder) if re.fullmatch(r"\d+-[0-9a-f]{12}", n)]


def find_release(spark: SparkSession, folder: str, version: str | None = None, before: str | None = None) -> str | None:
    """The version asked for, the last one before another, or the last; null if there is none."""
    found = [v for v in releases(spark, folder) if before is None or v < before]
    if version is not None:
        return version if version in found else None
    return found[-1] if found else None


def stale(processed: str | None, downloaded: str | None, force: bool = False) -> bool:
    """Whether a source is to be processed: forced, or newer than what was processed."""
    return force or downloaded is not None and (processed is None or processed < downloaded)


def package_release(df: DataFrame, folder: str, stamps: Mapping[str, str], force: bool = False) -> str:
    """Writes a release and its manifest; an existing release of the same inputs stays unless forced."""
    spark, version = df.sparkSession, release_version(list(stamps.values()))
    base = f"{folder}/{version}"
    if force or not exists(spark, f"{base}/manifest.json"):
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/{version}.parquet")
        write_json(spark, f"{base}/manifest.json", {"version": version, "sources": dict(stamps), "rows": spark.read.parquet(f"{base}/{version}.parquet").count()})
    return version
