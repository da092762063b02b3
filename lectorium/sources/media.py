"""Fetching recordings and documents, and reading pages and speech: what differs by service or model is a given function."""

from __future__ import annotations

import os
import subprocess
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import urls
from ..operators import documents
from . import stores

#: Seconds after which copying a stream is given up, and what a copied stream goes through.
STREAM_TIMEOUT = 1800
STREAM_OPTIONS = ["-c", "copy", "-bsf:a", "aac_adtstoasc", "-avoid_negative_ts", "make_zero", "-y"]
PAGE_DPI = 200


def stream_copy(url: str, program: str = "ffmpeg", timeout: float = STREAM_TIMEOUT) -> bytes:
    """The contents of a stream, copied by a program of the machine; an error if it fails, takes too long or copies nothing."""
    with tempfile.TemporaryDirectory() as folder:  # of one task, gone with it
        target = os.path.join(folder, "stream.mp4")
        ended = subprocess.run([program, "-i", url, *STREAM_OPTIONS, target], capture_output=True, text=True, timeout=timeout, check=False)
        if ended.returncode:
            raise OSError(f"copying the stream failed: {ended.stderr[-500:]}")
        with open(target, "rb") as f:
            return f.read()


def fetch_recordings(recordings: DataFrame, url_col: str, direct: Callable[[str], bytes], drive: Callable[[str], bytes], stream: Callable[[str], bytes] = stream_copy, attempts: int = 4, delay: float = 1.0, **more) -> DataFrame:
    """The rows with route, content and error, each address fetched in the way its form asks for.

    drive gets a file's id; an address of a folder is an error, since folders are listed first.
    Streams are tried once, the others so many times.
    """
    place = urls.drive_id(F.col(url_col))
    rows = recordings.withColumn("route", urls.route(F.col(url_col))).withColumn("drive_kind", place["kind"]).withColumn("drive_id", place["id"])

    def some(route: str, column: str, fetch: Callable[[str], bytes], times: int) -> DataFrame:
        return stores.fetched(rows.where(F.col("route") == route), column, fetch, times, delay, **more)

    from_drive = rows.where("route = 'drive'")
    folders = from_drive.where("drive_kind = 'folder' OR drive_kind IS NULL").withColumn("content", F.lit(None).cast("binary")).withColumn("error", F.when(F.col("drive_kind") == "folder", "a folder has to be listed").otherwise("no file in this address"))
    files = stores.fetched(from_drive.where("drive_kind = 'file'"), "drive_id", drive, attempts, delay, **more)
    every = files.unionByName(folders).unionByName(some("stream", url_col, stream, 1)).unionByName(some("direct", url_col, direct, attempts))
    return every.drop("drive_kind", "drive_id")


def acquire(listing: DataFrame, fetchers: dict[str, Callable[[str], bytes]], present: DataFrame | None = None, **more) -> DataFrame:
    """(id, name, route, pdf, content, error): the documents of a listing as PDF.

    fetchers has a function of the file's id for each of export, office and pdf; other files have
    neither content nor error. present (target) lists the PDFs that are there already; those files
    are left out.
    """
    rows = documents.files_in(listing).select("id", "name", documents.route(F.col("name"), F.col("mime_type")).alias("route"), documents.pdf_name(F.col("name")).alias("pdf"))
    rows = rows if present is None else documents.without_target(rows, present, "pdf")
    out = rows.where(~F.col("route").isin(*fetchers)).withColumn("content", F.lit(None).cast("binary")).withColumn("error", F.lit(None).cast("string"))
    for route, fetch in fetchers.items():
        out = out.unionByName(stores.fetched(rows.where(F.col("route") == route), "id", fetch, **more))
    return out


def _expanded(df: DataFrame, keys: list[str], given: list[str], added: str, rule: Callable[..., Iterable[tuple]]) -> DataFrame:
    """keys and the columns of each of the rows that a function yields for a row; pulled one by one."""
    schema = T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL(added).fields])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held: list[dict] = []
                for values in rule(*(row[c] for c in given)):
                    held.append({**{k: row[k] for k in keys}, **dict(zip(schema.names[len(keys) :], values))})
                    if len(held) == 64:
                        yield pa.RecordBatch.from_pylist(held, target)
                        held = []
                yield pa.RecordBatch.from_pylist(held, target)

    return df.select(*dict.fromkeys([*keys, *given])).mapInArrow(run, schema)


def page_images(files: DataFrame, render: Callable[[bytes, int], Iterable[bytes]], dpi: int = PAGE_DPI) -> DataFrame:
    """(path, page, image): a row per page (from 1) of files with path and content, as rendered by a function.

    Files without content, and ones that can't be rendered, have no row.
    """

    def pages(content: bytes | None) -> Iterator[tuple[int, bytes]]:
        try:
            yield from enumerate(render(content, dpi) if content else (), 1)
        except Exception:  # noqa: BLE001
            return

    return _expanded(files, ["path"], ["content"], "page int, image binary", pages)


def decoded(recordings: DataFrame, decode: Callable[[bytes, str | None, str | None], Iterable[tuple[float, float, str]]]) -> DataFrame:
    """(media_id, seg_idx, start_sec, end_sec, text): the segments that a speech model yields for recordings.

    recordings: media_id, content, language, prompt. Segments are taken from the model one by one.
    """

    def run(content: bytes | None, language: str | None, prompt: str | None) -> Iterator[tuple]:
        for i, (start, end, text) in enumerate(decode(content, language, prompt) if content else ()):
            yield i, start, end, text

    return _expanded(recordings, ["media_id"], ["content", "language", "prompt"], "seg_idx int, start_sec double, end_sec double, text string", run)
