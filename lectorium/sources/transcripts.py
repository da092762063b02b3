"""Transcript files in folders, and the listing of outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_spaces, word_count


def relative(path: Column, root: str) -> Column:
    """A path below the root; decoded, since listings escape blanks and accents."""
    plain = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^[a-z0-9]+:/*", "/")
    return F.regexp_replace(F.replace(plain, F.lit("/" + root.strip("/") + "/"), F.lit("")), "^/+", "")


def course_of(rel: Column) -> Column:
    """The first folder below the root; '_root' for a file directly in it."""
    return F.when(F.contains(rel, F.lit("/")), F.split(rel, "/")[0]).otherwise("_root")


def subject_of(rel: Column) -> Column:
    """The first folder below the root; the name without ending for a file directly in it."""
    return F.when(F.contains(rel, F.lit("/")), F.split(rel, "/")[0]).otherwise(F.regexp_replace(rel, r"(?<=.)\.[^.]*$", ""))


def read_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """(course, subject, file_name, path, text) of every .txt file below the root, at any depth.

    Files are read as bytes, so that bytes that aren't UTF-8 are dropped and not replaced; white space
    is collapsed; files without text are left out. path gives the order.
    """

    @F.pandas_udf("string")
    def decoded(content):
        return content.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)
    rel = relative(F.col("path"), root)
    rows = files.select(rel.alias("path"), normalize_spaces(decoded("content")).alias("text")).where("text <> ''")
    return rows.select(course_of(F.col("path")).alias("course"), subject_of(F.col("path")).alias("subject"), F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "text")


def list_outputs(spark: SparkSession, root: str) -> DataFrame:
    """(name, folder, bytes, created) of subtitle and transcript files; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
    rel = relative(F.col("path"), root)
    named = files.select(F.element_at(F.split(rel, "/"), -1).alias("name"), F.regexp_extract(rel, "^(.*)/[^/]*$", 1).alias("folder"), F.col("length").alias("bytes"), F.col("modificationTime").alias("created"))
    return named.where(F.lower("name").rlike(r"\.(vtt|txt)$"))


def long_enough(text: Column, least: int = 500) -> Column:
    return word_count(text) >= least
