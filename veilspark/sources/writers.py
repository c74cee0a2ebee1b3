"""Sinks: guarded CSV, JSON lines, staged packages with manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.functions.scalars import csv_safe


def guarded(df: DataFrame) -> DataFrame:
    """Strings that a spreadsheet would run get a quote; nested values become JSON."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            c = csv_safe(c)
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
            c = F.to_json(c)
        out.append(c.alias(field.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    guarded(df).write.csv(path, header=True, escape='"')


def write_json_lines(df: DataFrame, path: str) -> None:
    """Keys sorted, nulls kept."""
    df.select(*sorted(df.columns)).write.option("ignoreNullFields", "false").json(path)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(file, sha256, length) of a package's data files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"), "length")


def publish(tables: dict[str, DataFrame], leaks: DataFrame, folder: str) -> None:
    """Write the tables beside the target and rename; nothing is written while a leak is found.

    A package that is there already is renamed aside, and deleted only when the new one has its place;
    if that fails, it is put back. Between the two renames the target is absent for a moment.
    """
    spark = leaks.sparkSession
    if leaks.limit(1).count():
        raise ValueError("candidate has leaks")
    draft = f"{folder}.{uuid.uuid4().hex}"
    for name, table in tables.items():
        write_csv(table, f"{draft}/{name}")
    manifest(spark, draft).write.json(f"{draft}/manifest")
    _place(spark, draft, folder)


def _files(spark: SparkSession, folder: str):  # noqa: ANN202
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _place(spark: SparkSession, draft: str, folder: str) -> None:
    fs, path = _files(spark, draft)
    old = f"{draft}.old"
    there = fs.exists(path(folder))
    if there and not fs.rename(path(folder), path(old)):
        raise OSError(f"cannot move {folder} aside")
    if not fs.rename(path(draft), path(folder)):
        if there:
            fs.rename(path(old), path(folder))
        raise OSError(f"cannot move {draft} to {folder}")
    if there:
        fs.delete(path(old), True)


def emit(packages: dict[str, dict[str, DataFrame]], leaks: DataFrame, folder: str) -> None:
    """Several packages under one folder, each with its manifest: all of them take their place by one rename, or none.

    Nothing is written while a leak is found. Where a table of any package fails, the draft is deleted and what
    stood in the folder before stays. Beyond that, as `publish`.
    """
    spark = leaks.sparkSession
    if leaks.limit(1).count():
        raise ValueError("candidate has leaks")
    draft = f"{folder}.{uuid.uuid4().hex}"
    fs, path = _files(spark, draft)
    try:
        for package, tables in packages.items():
            for name, table in tables.items():
                write_csv(table, f"{draft}/{package}/{name}")
            manifest(spark, f"{draft}/{package}").write.json(f"{draft}/{package}/manifest")
        _place(spark, draft, folder)
    except Exception:
        fs.delete(path(draft), True)
        raise


def changed_files(approved: DataFrame, current: DataFrame) -> DataFrame:
    """Files whose digest is not the approved one: any voids the review."""
    return current.join(approved.select("file", "sha256"), ["file", "sha256"], "left_anti")
