"""Timed speech segments: delivery, quality, cleaning, cues, subtitle and transcript lines.

Columns of a segment table: media_id, seg_idx, start_sec, end_sec, text (and ingested_at). One
recording may hold any share of the rows, so nothing here gathers a recording in one task: orders
and look-backs run inside blocks of consecutive segments, joined by one summary row per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from .. import lexicon as L
from ..functions.text import WS_SET, any_of, collapse_repeats, let, timestamp, words

KEY = ["media_id", "seg_idx"]
#: Consecutive segments of one recording that are handled together.
BLOCK = 1024


def delivered_once(segments: DataFrame) -> DataFrame:
    """One row per (media_id, seg_idx): of rows delivered again, the one that came last.

    Rows without a key are dropped. Rows that came at one time are told apart by their text and
    times, so that the choice doesn't depend on the order of the input.
    """
    keyed = segments.where(F.col("media_id").isNotNull() & F.col("seg_idx").isNotNull())
    rest = [c for c in segments.columns if c not in KEY]
    order = F.struct(*(c for c in ("ingested_at", "text", "start_sec", "end_sec") if c in rest))
    return keyed.groupBy(*KEY).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*KEY, *(F.col("r")[c].alias(c) for c in rest))


def hallucinated(text: Column) -> Column:
    """Eleven equal characters in a row; one word as more than 30 % of more than five; spam wording."""

    def dominated(w: Column) -> Column:
        # In order, a word with more than so many copies stands again that many places on.
        most = F.floor(F.size(w) * F.lit(0.3)).cast("int")
        return F.when(F.size(w) > 5, F.exists(F.sequence(F.lit(1), F.size(w) - most), lambda i: F.element_at(w, i) == F.element_at(w, i + most))).otherwise(False)

    return text.rlike(r"(.)\1{10,}") | let(F.array_sort(words(text)), dominated) | F.lower(text).rlike(any_of(L.SPAM))


def verdict(segments: DataFrame, min_duration: float = 0.5, max_duration: float = 30.0) -> DataFrame:
    """The segments with verdict: keep, duration, short_text, hallucination or blank, and clean text.

    Null texts count as empty, null times as a duration out of bounds.
    """
    text = F.coalesce("text", F.lit(""))
    duration = F.col("end_sec") - F.col("start_sec")
    judged = segments.withColumn("clean", collapse_repeats(text))
    return judged.withColumn(
        "verdict",
        F.when(duration.isNull() | (duration < min_duration) | (duration > max_duration), "duration")
        .when((duration > 8) & (F.length(F.btrim(text, F.lit(WS_SET))) < 10), "short_text")
        .when(hallucinated(text), "hallucination")
        .when(F.btrim("clean", F.lit(WS_SET)) == "", "blank")
        .otherwise("keep"),
    )


def valid_segments(segments: DataFrame) -> DataFrame:
    """The segments that pass, with their clean text as text."""
    return verdict(segments).where("verdict = 'keep'").withColumn("text", F.col("clean")).drop("clean", "verdict")


def segment_stats(segments: DataFrame) -> DataFrame:
    """By recording: all, valid and filtered segments. Blank ones are in neither of the last two."""
    counted = verdict(segments).groupBy("media_id")
    return counted.agg(F.count("*").alias("total_segments"), F.count_if(F.col("verdict") == "keep").alias("valid_segments"), F.count_if(F.col("verdict").isin("duration", "short_text", "hallucination")).alias("filtered_hallucinations"))


def cue_parts(text: Column, min_chars: int = 50, max_chars: int = 70) -> Column:
    """Parts of a cleaned text of about 50 to 70 characters, cut at punctuation where possible."""
    none = F.array().cast("array<string>")

    def pack(acc: Column, w: Column) -> Column:
        candidate = F.btrim(F.concat_ws(" ", acc["cur"], w))
        full = (F.length(candidate) > max_chars) & (acc["cur"] != "")
        cut = ~full & (F.length(candidate) >= min_chars) & candidate.rlike("[.!?;:,]$")
        done = F.when(full, F.array_append(acc["done"], acc["cur"])).when(cut, F.array_append(acc["done"], candidate)).otherwise(acc["done"])
        return F.struct(done.alias("done"), F.when(full, w).when(cut, F.lit("")).otherwise(candidate).alias("cur"))

    def packed(x: Column) -> Column:
        return F.aggregate(words(x), F.struct(none.alias("done"), F.lit("").alias("cur")), pack, lambda a: F.when(a["cur"] != "", F.array_append(a["done"], a["cur"])).otherwise(a["done"]))

    def merge(acc: Column, part: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat_ws(" ", last, part)
        fits = (F.size(acc) > 0) & (F.length(part) < min_chars) & (F.length(joined) <= max_chars + 20)
        return F.when(F.size(acc) == 0, F.array(part)).when(fits, F.array_append(F.slice(acc, 1, F.size(acc) - 1), joined)).otherwise(F.array_append(acc, part))

    return let(text, lambda x: F.when(F.length(x) <= max_chars, F.array(x)).otherwise(F.aggregate(packed(x), none, merge)))


def wrapped_parts(text: Column, max_chars: int = 80) -> Column:
    """The plain wrap of the first version: a first word of 80 or more characters leaves an empty part."""
    none = F.array().cast("array<string>")

    def pack(acc: Column, w: Column) -> Column:
        fits = F.length(F.concat(acc["cur"], F.lit(" "), w)) <= max_chars
        joined = F.when(acc["cur"] != "", F.concat(acc["cur"], F.lit(" "), w)).otherwise(w)
        return F.struct(F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], F.btrim(acc["cur"]))).alias("done"), F.when(fits, joined).otherwise(w).alias("cur"))

    packed = lambda x: F.aggregate(words(x), F.struct(none.alias("done"), F.lit("").alias("cur")), pack, lambda a: F.when(a["cur"] != "", F.array_append(a["done"], F.btrim(a["cur"]))).otherwise(a["done"]))
    return let(F.btrim(text, F.lit(WS_SET)), lambda x: F.when(F.length(x) <= max_chars, F.array(x)).otherwise(packed(x)))


def cues(segments: DataFrame, min_duration: float = 1.0, first_version: bool = False) -> DataFrame:
    """(media_id, seg_idx, cue_idx, cue_start, cue_end, cue_text) of segments with clean texts.

    A segment's time is shared evenly. Ends are held to the segment's end, starts are not, so that a
    short segment's later cues can start after they end; blank parts have no cue. The first version
    wraps at 80 characters and shares the time without a least duration.
    """
    parts = wrapped_parts(F.col("text")) if first_version else cue_parts(collapse_repeats(F.btrim("text", F.lit(WS_SET))))
    split = segments.withColumn("parts", parts).withColumn("n", F.size("parts"))
    one = (F.col("end_sec") - F.col("start_sec")) / F.col("n")
    length = one if first_version else F.greatest(one, F.lit(min_duration))
    each = split.select(*KEY, "start_sec", "end_sec", "n", length.alias("len"), F.posexplode("parts").alias("cue_idx", "cue_text"))
    start = F.col("start_sec") + F.col("cue_idx") * F.col("len")
    end = F.col("start_sec") + (F.col("cue_idx") + 1) * F.col("len")
    alone = F.col("n") == 1
    bounded = end if first_version else F.least(end, F.col("end_sec"))
    return each.where(F.btrim("cue_text", F.lit(WS_SET)) != "").select(*KEY, "cue_idx", F.when(alone, F.col("start_sec")).otherwise(start).alias("cue_start"), F.when(alone, F.col("end_sec")).otherwise(bounded).alias("cue_end"), "cue_text")


def vtt_cues(cue_df: DataFrame) -> DataFrame:
    """The cue blocks of subtitle files, one row per cue: line of times, text, blank line."""
    times = F.concat(timestamp(F.col("cue_start"), vtt=True), F.lit(" --> "), timestamp(F.col("cue_end"), vtt=True))
    return cue_df.select(*KEY, "cue_idx", F.concat(times, F.lit("\n"), F.col("cue_text"), F.lit("\n\n")).alias("cue"))


def vtt_blocks(cue_df: DataFrame) -> DataFrame:
    """(media_id, block, body): the files' bodies in pieces of bounded size.

    A file is 'WEBVTT', a blank line and its pieces in order; a recording of any length is spread
    over as many rows as it needs.
    """
    lines = vtt_cues(cue_df).withColumn("block", F.floor(F.col("seg_idx") / BLOCK).cast("int"))
    return lines.groupBy("media_id", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", "cue_idx", "cue"))), lambda x: x["cue"]), "").alias("body"))


def txt_blocks(segments: DataFrame, with_times: bool = False) -> DataFrame:
    """(media_id, block, body): transcripts in pieces; pieces are joined by a space, or a line break with times."""
    text = F.btrim("text", F.lit(WS_SET))
    line = F.concat(F.lit("["), timestamp(F.col("start_sec")), F.lit("] "), text) if with_times else text
    rows = segments.where(text != "").select("media_id", "seg_idx", F.floor(F.col("seg_idx") / BLOCK).cast("int").alias("block"), line.alias("line"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", "line"))), lambda x: x["line"]), "\n" if with_times else " ")
    return rows.groupBy("media_id", "block").agg(joined.alias("body"))


def with_ordinal(segments: DataFrame, name: str = "ordinal") -> DataFrame:
    """Each row's place (from 0) in its recording.

    Rows are numbered inside blocks; the blocks' offsets come from a running sum over one row per
    block. A recording that holds most rows is numbered by many tasks.
    """
    rows = segments.withColumn("block", F.floor(F.col("seg_idx") / BLOCK).cast("long"))
    sizes = rows.groupBy("media_id", "block").count()
    before = Window.partitionBy("media_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("media_id", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("media_id", "block").orderBy("seg_idx")
    return rows.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, ["media_id", "block"]).withColumn(name, (F.col("offset") + F.col("inside")).cast("int")).drop("block", "inside", "offset")


def batch_contexts(segments: DataFrame, batch_size: int = 20, window: int = 5) -> DataFrame:
    """(media_id, batch, context): for each refinement batch, the texts of the segments before it.

    This is the parallel form, over texts as they are before refinement; the first batch's context
    is empty. A batch finds its few predecessors by an equi-join on their places.
    """
    numbered = with_ordinal(segments)
    batches = numbered.select("media_id", F.floor(F.col("ordinal") / batch_size).cast("int").alias("batch")).distinct()
    first = F.col("batch") * batch_size
    places = F.when(first > 0, F.sequence(F.greatest(first - window, F.lit(0)), first - 1)).otherwise(F.array().cast("array<int>"))
    wanted = batches.select("media_id", "batch", F.explode_outer(places).alias("ordinal"))
    found = wanted.join(numbered.select("media_id", "ordinal", "text"), ["media_id", "ordinal"], "left")
    texts = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("ordinal", "text"))))
    return found.groupBy("media_id", "batch").agg(F.array_join(F.transform(texts, lambda x: x["text"]), " ").alias("context"))


def refined_in_order(segments: DataFrame, refine: Callable[[list[str], str], list[str | None]], batch_size: int = 20, window: int = 5) -> DataFrame:
    """The segments with refined texts, each batch's context being the texts before it as they are after refinement.

    refine gets a batch's texts and its context ('' for the first), and gives a text or None for
    each; a text is taken if it has 3 to 300 characters, and is cleaned. A recording is one chain of
    batches, each of which needs the one before, so it is refined by one task, which holds one batch
    and its context at a time; batch_contexts is the form that many tasks can share.
    """
    rows = segments.select("media_id", "seg_idx", F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType([*rows.schema.fields, T.StructField("is_refined", T.BooleanType())])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        before: list[str] = []

        def finish() -> pa.RecordBatch:
            replies = refine([r["text"] for r in held], " ".join(t.strip() for t in before))
            for row, reply in zip(held, [*replies, *[None] * len(held)]):
                reply = (reply or "").strip()
                row["is_refined"] = 3 <= len(reply) <= 300
                row["text"] = reply if row["is_refined"] else row["text"]
            before[:] = [*before, *(r["text"] for r in held)][-window:]
            out = pa.RecordBatch.from_pylist(held, target)
            held.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == batch_size or held[0]["media_id"] != row["media_id"]):
                    same = held[0]["media_id"] == row["media_id"]
                    yield finish()
                    if not same:
                        before.clear()
                held.append(row)
        if held:
            yield finish()

    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = rows.repartition(parts, "media_id").sortWithinPartitions("media_id", "seg_idx").mapInArrow(run, schema)
    return done.withColumn("text", F.when(F.col("is_refined"), collapse_repeats(F.col("text"))).otherwise(F.col("text")))


def apply_refinements(segments: DataFrame, replies: DataFrame) -> DataFrame:
    """Segments with the texts that a refiner gave back.

    replies: media_id, pos (place in the reply), id (place of the segment), text. The last reply for
    an id counts; a text is taken if it has 3 to 300 characters, and is cleaned. Others keep theirs.
    """
    useful = replies.where(F.col("id").isNotNull() & (F.btrim("text", F.lit(WS_SET)) != "")).withColumn("text", F.btrim("text", F.lit(WS_SET)))
    last = useful.groupBy("media_id", F.col("id").alias("ordinal")).agg(F.max_by("text", "pos").alias("refined"))
    joined = with_ordinal(segments).join(last, ["media_id", "ordinal"], "left")
    ok = F.length("refined").between(3, 300)
    return joined.withColumn("is_refined", F.coalesce(ok, F.lit(False))).withColumn("text", F.when(ok, collapse_repeats(F.col("refined"))).otherwise(F.col("text"))).drop("refined")
