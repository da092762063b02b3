"""Job state as a stream: the latest row of each job, with restart from a checkpoint."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.jobs import OPEN
from ..operators.storage import shared_folder


def latest_state(updates: DataFrame) -> DataFrame:
    """A streaming aggregate: the row with the greatest update time (then status) of each job.

    The state holds one row per job. Updates may come late and out of order, more than once, and in
    any batches; the result is the same.
    """
    fields = ["updated_at", "status", "progress", "error"]
    best = updates.where(F.col("job_id").isNotNull()).groupBy("job_id").agg(F.max(F.struct(*fields)).alias("r"))
    return best.select("job_id", *(F.col(f"r.{c}").alias(c) for c in fields))


def read_updates(spark: SparkSession, path: str, per_trigger: int = 64) -> DataFrame:
    """The files of a job table as a stream, so many in a batch."""
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", per_trigger)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        folder, _, name = path.rpartition("/")
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(path)


def run_to_end(spark: SparkSession, path: str, checkpoint: str | None = None) -> DataFrame:
    """Runs the stream over all there is, and returns the state.

    With a checkpoint folder, a later call goes on where this one ended. Each batch writes the jobs
    it changed; the newest batch of a job counts.
    """
    base = checkpoint or f"{shared_folder(spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"
    out = f"{base}/state"

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = latest_state(read_updates(spark, path)).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    state = spark.read.option("basePath", out).parquet(out)
    last = state.groupBy("job_id").agg(F.max_by(F.struct("updated_at", "status", "progress", "error"), "batch").alias("r"))
    return last.select("job_id", *(F.col(f"r.{c}").alias(c) for c in ("updated_at", "status", "progress", "error")))


def open_jobs(state: DataFrame) -> DataFrame:
    """What a restart has to take up again."""
    return state.where(F.col("status").isin(*OPEN))
