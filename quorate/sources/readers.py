"""Readers for the formats of source files. Schemas are declared, not guessed, where they are given."""

from __future__ import annotations

import zipfile
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def csv(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",", lenient: bool = False) -> DataFrame:
    """Quoted text with a header; lenient drops rows that do not fit."""
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", False).option("mode", "DROPMALFORMED" if lenient else "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).csv(path)


def tsv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """Tab-separated text in which quotes mean nothing."""
    reader = spark.read.option("header", header).option("sep", "\t").option("quote", "").option("escape", "")
    return (reader.schema(schema) if schema else reader).csv(path)


def dump(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "\t|\t", trailer: str = "\t|") -> DataFrame:
    """Text with a separator of several characters and a row trailer."""
    line = F.regexp_replace("value", f"\\Q{trailer}\\E$", "")
    parts = F.split(line, f"\\Q{sep}\\E", -1)
    return spark.read.text(path).select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object in each line; lines that do not parse are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def filtered_dump(spark: SparkSession, path: str, pattern: str, schema: str) -> DataFrame:
    """Objects of a (compressed) dump, one in each line with a trailing comma, whose text matches a pattern.

    The pattern is tested before anything is parsed.
    """
    lines = spark.read.text(path).where(F.col("value").rlike(pattern))
    return lines.select(F.from_json(F.regexp_replace("value", r",\s*$", ""), schema).alias("x")).where("x IS NOT NULL").select("x.*")


def excel(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """One sheet, read on the driver; needs an Excel engine of pandas."""
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet, dtype=str).astype(object).where(lambda x: x.notna(), None))


def unpack(archive: str, member: str, folder: str) -> list[str]:
    """Members of a zip file (and of zip files in it) whose name ends so, staged in a folder for Spark."""
    out: list[str] = []
    Path(folder).mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(archive) as z:
        for name in z.namelist():
            to = Path(folder) / Path(name).name
            if name.endswith(".zip") and not member.endswith(".zip"):
                to.write_bytes(z.read(name))
                out += unpack(str(to), member, str(to.with_suffix("")))
            elif name.endswith(member):
                to.write_bytes(z.read(name))
                out.append(str(to))
    return sorted(out)


def inline(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table given in code."""
    return spark.createDataFrame(list(rows), schema)


def arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    """An Arrow table that the driver holds, without a detour by rows."""
    return spark.createDataFrame(table)


def merged(*frames: DataFrame) -> DataFrame:
    """All rows; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
