"""Writers. Each writes distributed and through Spark's committer, so that a lost task leaves no part of a file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_subtitles(blocks: DataFrame, path: str) -> None:
    """Pieces of subtitle files under media_id=.../, in order of their names; the first piece has the header."""
    first = blocks.groupBy("media_id").agg(F.min("block").alias("first"))
    rows = blocks.join(first, "media_id").withColumn("body", F.when(F.col("block") == F.col("first"), F.concat(F.lit("WEBVTT\n\n"), F.col("body"))).otherwise(F.col("body")))
    rows.repartitionByRange("media_id", "block").sortWithinPartitions("media_id", "block").select("media_id", F.rtrim("body", F.lit("\n")).alias("body")).withColumn("body", F.concat("body", F.lit("\n"))).write.mode("overwrite").partitionBy("media_id").text(path)


def write_transcripts(blocks: DataFrame, path: str) -> None:
    blocks.repartitionByRange("media_id", "block").sortWithinPartitions("media_id", "block").select("media_id", "body").write.mode("overwrite").partitionBy("media_id").text(path)


def write_nodes(nodes: DataFrame, path: str, order: str = "place") -> None:
    """Nodes as JSON lines under course=.../, in order, in as many files as a course needs."""
    nodes.repartitionByRange("course", order).sortWithinPartitions("course", order).write.mode("overwrite").partitionBy("course").json(path)


def write_course_arrays(nodes: DataFrame, path: str, order: str = "place") -> None:
    """One file per course under course=.../, holding one indented JSON array of its nodes in order.

    A course's lines pass through one task one by one; nothing gathers them.
    """
    fields = [c for c in nodes.columns if c not in ("course", order)]
    place = Window.partitionBy("course").orderBy(order)
    body = F.regexp_replace(F.to_json(F.struct(*fields), {"pretty": "true", "ignoreNullFields": "false"}), "(?m)^", "  ")
    line = F.concat(F.when(F.row_number().over(place) == 1, "[\n").otherwise(""), body, F.when(F.lead(F.lit(1)).over(place).isNull(), "\n]").otherwise(","))
    nodes.withColumn("value", line).select("course", "value").write.mode("overwrite").partitionBy("course").text(path)


def append_collection(nodes: DataFrame, path: str) -> None:
    """Adds nodes to a collection; earlier files stay as they are, so a failed run loses nothing."""
    nodes.write.mode("append").json(path)
