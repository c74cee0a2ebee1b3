"""Sources: listings, JSON and CSV inputs with their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of a listing, nothing but names and sizes is read.
LISTED = ["path", "modificationTime", "length"]


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all files under a root, paths relative to it; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(*LISTED)
    inside = F.regexp_replace("path", rf"^.*?\Q{root.rstrip('/').split('://')[-1].removeprefix('file:')}\E/", "")
    return files.select(inside.alias("path"), "length")


def checksums(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "length")


def aggregates(spark: SparkSession, paths: list[str], schema: str, keys: list[str]) -> DataFrame:
    """The union of JSON documents; a key that occurs twice is an error."""
    rows = spark.read.schema(schema).option("multiLine", True).json(paths)
    twice = rows.groupBy(*keys).count().where("count > 1").limit(1).count()
    if twice:
        raise ValueError("duplicate keys in aggregates")
    return rows


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of a JSON-lines file; lines of another kind are left out."""
    return spark.read.text(path).select(F.from_json("value", schema).alias("row")).where("row IS NOT NULL").select("row.*")


def lenient_letters(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): a file's rows, or, if one of its lines is no JSON object, its whole text as one row."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    parsed = F.transform(lines, lambda x: F.from_json(x, "text string"))
    good = F.forall(lines, lambda x: F.coalesce(F.get_json_object(x, "$").startswith("{"), F.lit(False)))
    texts = F.when(good, F.transform(parsed, lambda p: p["text"])).otherwise(F.array("value"))
    return files.select("file", F.explode(texts).alias("text"))


def decisions(spark: SparkSession, path: str, columns: list[str], domain: list[str], decision: str = "decision") -> DataFrame:
    """Review decisions; blank ones are left out, others outside the domain are an error."""
    rows = spark.read.schema(", ".join(f"{c} string" for c in columns)).csv(path, header=True, enforceSchema=False)
    given = rows.where(F.trim(decision) != "").withColumn(decision, F.trim(decision))
    if given.where(~F.col(decision).isin(*domain)).limit(1).count():
        raise ValueError("invalid decision")
    return given
