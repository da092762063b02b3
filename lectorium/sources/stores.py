"""Stores written as JSON: jobs, payloads, extracted collections; and fetching with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE = "struct<id_:string,text:string,metadata:struct<file_name:string,subject:string,page:int,topic:string,category:string,keywords:array<string>,has_code:boolean>>"


def read_job_store(spark: SparkSession, path: str) -> DataFrame:
    """(job_id, status, progress, error, result) of a store that is one JSON object by job id.

    Entries that aren't objects or have no status are skipped one by one; a store that can't be parsed
    has no rows.
    """
    text = spark.read.text(path, wholetext=True)
    each = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("job_id", "e"))
    field = lambda k: F.get_json_object("e", f"$.{k}").alias(k)
    rows = each.where(F.ltrim("e").startswith("{")).select("job_id", field("status"), field("progress"), field("error"), field("result"))
    return rows.where(F.col("status").isNotNull())


def read_payload_store(spark: SparkSession, path: str) -> DataFrame:
    """(job_id, video_url, language, request) of a store that is one JSON object by job id; request stays JSON.

    A store that can't be parsed has no rows; a payload without an address stays, with a null one.
    """
    text = spark.read.text(path, wholetext=True)
    each = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("job_id", "e")).where(F.ltrim("e").startswith("{"))
    return each.select("job_id", *(F.get_json_object("e", f"$.{k}").alias(k) for k in ("video_url", "language", "request")))


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of an extracted collection, which is one JSON array; the key id_ becomes id."""
    text = spark.read.text(path, wholetext=True)
    nodes = text.select(F.explode(F.from_json("value", "array<string>")).alias("e")).select(F.from_json("e", NODE).alias("n")).where(F.col("n").isNotNull())
    return nodes.select(F.col("n.id_").alias("id"), "n.text", "n.metadata")


def done_files(collection: DataFrame) -> DataFrame:
    return collection.select(F.col("metadata.file_name").alias("file_name")).where(F.col("file_name").isNotNull()).distinct()


def enrich(node: Column, file_name: Column, subject: Column, page: Column) -> Column:
    """A node with its place written over what the model gave; its id is made from the place and text."""
    meta = node["metadata"].withField("file_name", file_name).withField("subject", subject).withField("page", page.cast("int"))
    return node.withField("metadata", meta).withField("id_", F.sha2(F.concat_ws("\u0001", file_name, page.cast("string"), node["text"]), 256))


def fetched(urls: DataFrame, url_col: str, fetch: Callable[[str], bytes], attempts: int = 4, delay: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """urls with content and error: each address fetched in the tasks, with a growing pause between attempts.

    Empty contents count as failures. A null address gives neither content nor error. A task that is
    run again fetches again, so fetch must be safe to repeat.
    """
    schema = T.StructType([*urls.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])

    def one(url: str | None) -> tuple[bytes | None, str | None]:
        error = None
        for attempt in range(1, attempts + 1) if url else ():
            try:
                if content := fetch(url):
                    return content, None
                error = "empty"
            except Exception as e:  # noqa: BLE001
                error = f"{type(e).__name__}: {e}"
            if attempt < attempts:
                sleep(delay * attempt)
        return None, error

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            pairs = [one(u) for u in frame[url_col]]
            yield frame.assign(content=[c for c, _ in pairs], error=[e for _, e in pairs])

    return urls.mapInPandas(run, schema)
