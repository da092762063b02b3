"""Cutting lineage in storage that all executors share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that are compressed as one piece, small enough for equal texts of a row's columns to be seen.
PRESSED_ROWS = 512
#: Keys that are broadcast; more are first told by a filter.
FEW_KEYS = 50_000
#: Bits that a set of keys is marked in, for each key and at most (16 MB, whatever the set).
BITS_A_KEY, MOST_BITS = 16, 1 << 27


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset: a new local one on a single machine, else an error.

    On several machines every executor would write to a disk of its own.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="lectorium-")


def kept(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def pressed(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder whose rows lie there compressed; reading them is a pass of its own."""

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PRESSED_ROWS):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(batch.slice(at, PRESSED_ROWS))
                raw = sink.getvalue()
                yield pa.RecordBatch.from_arrays([pa.array([raw.size], pa.int64()), pa.array([pa.compress(raw, "zstd", asbytes=True)], pa.binary())], names=["size", "rows"])

    def unpress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from pa.ipc.open_stream(pa.decompress(rows, size, "zstd"))

    return kept(df.mapInArrow(press, "size long, rows binary")).mapInArrow(unpress, df.schema)


def _may_hold(keys: DataFrame, names: list[str], count: int) -> Column:
    """Whether a row's values may be among so many keys; never false where they are."""
    bits = min(1 << (BITS_A_KEY * count).bit_length(), MOST_BITS)
    place = F.pmod(F.xxhash64(*names), F.lit(bits)).cast("long")
    at = keys.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("word"))
    words = np.zeros(bits >> 6, np.int64)
    for r in at.collect():  # at most MOST_BITS / 64 rows
        words[r["at"]] = r["word"]

    @F.arrow_udf("boolean")
    def held(p: pa.Array) -> pa.Array:
        x = p.to_numpy(zero_copy_only=False)
        return pa.array((words[x >> 6] >> (x & 63)) & 1 == 1)

    return held(place)


def among(df: DataFrame, keys: DataFrame, names: list[str], few: int = FEW_KEYS) -> DataFrame:
    """The rows whose values are among the keys, a table or checkpoint; few other rows are shuffled."""
    count, own = keys.count(), keys.select(*names).distinct()
    if count <= few:
        return df.join(F.broadcast(own), names, "left_semi")
    return df.where(_may_hold(keys, names, count)).join(own, names, "left_semi")


def without(df: DataFrame, keys: DataFrame, names: list[str], few: int = FEW_KEYS) -> DataFrame:
    """The rows whose values aren't among the keys, a table or checkpoint; few of them are shuffled. Beyond few keys, df is read twice."""
    count, own = keys.count(), keys.select(*names).distinct()
    if count <= few:
        return df.join(F.broadcast(own), names, "left_anti") if count else df
    may = _may_hold(keys, names, count)
    return df.where(~may).unionByName(df.where(may).join(own, names, "left_anti"))
