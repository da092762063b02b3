"""Transcription jobs: latest state, metrics, recovery, results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN = ["queued", "processing"]


def latest(jobs: DataFrame) -> DataFrame:
    """The last row of each job; equal times are told apart by status, so that order doesn't matter."""
    rest = [c for c in jobs.columns if c != "job_id"]
    order = F.struct(*(F.col(c) for c in ("updated_at", "status", "progress", "error") if c in rest))
    rows = jobs.where(F.col("job_id").isNotNull()).groupBy("job_id").agg(F.max_by(F.struct(*rest), order).alias("r"))
    return rows.select("job_id", *(F.col("r")[c].alias(c) for c in rest))


def merged(updates: DataFrame, deletions: DataFrame | None = None) -> DataFrame:
    """The state of each job after partial updates, in which a null field is one that isn't set.

    Each field has the value last set. An update counts only for a job that was created, which the
    first row with a status does, and rows up to a job's deletion (job_id, deleted_at) don't count: a
    job that isn't created again after it is gone. Rows of one time are told apart by their values.
    """
    rows = updates.where(F.col("job_id").isNotNull())
    if deletions is not None:
        gone = deletions.groupBy("job_id").agg(F.max("deleted_at").alias("deleted_at"))
        rows = rows.join(gone, "job_id", "left").where(F.col("deleted_at").isNull() | (F.col("updated_at") > F.col("deleted_at"))).drop("deleted_at")
    created = rows.where(F.col("status").isNotNull()).groupBy("job_id").agg(F.min("updated_at").alias("created_at"))
    counted = rows.join(created, "job_id").where(F.col("updated_at") >= F.col("created_at"))
    fields = [c for c in rows.columns if c not in ("job_id", "updated_at")]
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct("updated_at", F.col(c).alias("v")))).alias(c) for c in fields]
    state = counted.groupBy("job_id").agg(F.max("updated_at").alias("updated_at"), *last)
    return state.select("job_id", *(F.col(c)["v"].alias(c) for c in fields), "updated_at")


def metrics(jobs: DataFrame) -> DataFrame:
    counts = latest(jobs).agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in ("queued", "processing", "completed", "failed")))
    return counts.withColumn("open", F.col("queued") + F.col("processing"))


def recover(status: DataFrame, payloads: DataFrame) -> DataFrame:
    """(job_id, action, error): open jobs go back into the queue with their payload; without one they fail."""
    left = status.where(F.col("status").isin(*OPEN)).select("job_id").distinct()
    has = payloads.select("job_id").where(F.col("job_id").isNotNull()).distinct().withColumn("has", F.lit(True))
    joined = left.join(has, "job_id", "left")
    return joined.select("job_id", F.when(F.col("has"), "requeue").otherwise("fail").alias("action"), F.when(F.col("has"), F.lit(None).cast("string")).otherwise("payload is missing").alias("error"))


def source_type(url: Column) -> Column:
    return F.when(F.contains(F.lower(url), F.lit("m3u8")), "m3u8_stream").otherwise("direct_file")


def results(jobs: DataFrame, stats: DataFrame) -> DataFrame:
    """(media_id, result): what a finished recording reports, from its last completed job and its segments' counts."""
    done = latest(jobs).where("status = 'completed'").groupBy("media_id").agg(F.max_by(F.struct("job_id", "result"), F.struct("updated_at", "job_id")).alias("r"))
    joined = done.join(stats, "media_id")
    name = F.col("media_id")
    return joined.select(
        "media_id",
        F.col("r.job_id").alias("job_id"),
        F.concat(name, F.lit(".vtt")).alias("vtt_filename"),
        F.concat(name, F.lit(".txt")).alias("txt_filename"),
        F.concat(F.lit("/download/"), name, F.lit(".vtt")).alias("vtt_download_url"),
        F.coalesce("r.result.source_type", F.lit("direct_file")).alias("source_type"),
        F.coalesce("r.result.llm_refined", F.lit(False)).alias("llm_refined"),
        "total_segments",
        "valid_segments",
        "filtered_hallucinations",
        F.col("r.result.stats.detected_language").alias("detected_language"),
    )
