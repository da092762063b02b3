"""Whole flows: transcripts to nodes, and stand-ins for models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import passages
from ..functions.arrow import mapped
from ..functions.text import normalize_punctuation, sentences, word_count
from ..operators import chunking, nodes, quality
from ..operators.storage import among, kept, pressed, without

FILE = ["course", "file_name"]


def punctuation_refiner(numbered: DataFrame) -> DataFrame:
    """Stand-in for a refining model: replies (media_id, pos, id, text) with tidied punctuation."""
    return numbered.select("media_id", F.col("ordinal").alias("pos"), F.col("ordinal").alias("id"), normalize_punctuation(F.col("text")).alias("text"))


def extractive_nodes(chunks: DataFrame, sentences_per_node: int = 6) -> DataFrame:
    """Stand-in for an extracting model: every six sentences of a chunk are a raw node, its first the topic."""
    raw = lambda i: F.struct(F.array_join(F.slice("sents", i + 1, F.lit(sentences_per_node)), " ").alias("text"), F.lit("").alias("topic"), F.lit(None).cast("string").alias("category"), F.array().cast("array<string>").alias("keywords"), F.lit(None).cast("boolean").alias("has_code"), F.array().cast("array<string>").alias("question_templates"))
    starts = F.when(F.size("sents") > 0, F.sequence(F.lit(0), F.size("sents") - 1, F.lit(sentences_per_node))).otherwise(F.array().cast("array<int>"))
    return chunks.withColumn("sents", sentences(F.col("chunk_text"))).withColumn("nodes", F.transform(starts, raw)).drop("sents")


def transcript_nodes(documents: DataFrame, extractor: Callable[[DataFrame], DataFrame] = extractive_nodes, min_words: int = 900, max_words: int = 1400, overlap: int = 70, threshold: float = 0.76, retries: int = 1) -> DataFrame:
    """Nodes of every course: chunk, extract, sanitise, remove near-duplicates and merge in the file, then remove near-duplicates in the course.

    documents: doc_id, course, file_name, text. A document without a course belongs to '_root', one
    without a file name is its own file. extractor adds to chunks a column nodes, an array of
    nodes.RAW; null means that the chunk failed. All chunks of a file with a failed one are tried
    again so many times; a file that still fails gives no node. A file's place in the order doesn't
    depend on its attempts.
    """
    files = documents.select(F.coalesce("course", F.lit("_root")).alias("course"), F.concat_ws("/", F.coalesce("file_name", F.lit("")), F.col("doc_id").cast("string")).alias("file_name"), "text")

    first = min_words, max_words, overlap, threshold, threshold
    # Files that are long but came to one node or none, and didn't fail, get a second pass with
    # smaller chunks; its nodes count only if there are more of them.
    second = max(200, min_words // 3), max(450, max_words // 2), max(50, overlap), min(0.92, threshold + 0.12), min(0.90, threshold + 0.10)
    if extractor is extractive_nodes:
        every = pressed(_extractive_files(files, first, second))
    else:
        every = _extracted_files(files, extractor, retries, first, second)
    place = F.concat_ws("\u0001", "file_name", *(F.format_string("%08d", c) for c in ("chunk_idx", "node_idx", "part_idx")))
    return nodes.dedupe(nodes.named(every).withColumn("place", place), ["course"], "place", threshold=threshold)


def _extractive_files(files: DataFrame, first: tuple, second: tuple, sentences_per_node: int = 6) -> DataFrame:
    """Nodes of each file by the stand-in, which can't fail: both passes are made in the task that reads the text.

    Only texts that share a file's name with others are brought together.
    """
    several = kept(files.groupBy(*FILE).agg(F.count("*").alias("n")).where("n > 1"))
    single = lambda df: df.select(*FILE, F.array("text").alias("texts"))
    every = single(files)
    if not several.isEmpty():
        every = single(without(files, several, FILE)).unionByName(among(files, several, FILE).groupBy(*FILE).agg(F.collect_list("text").alias("texts")))
    names = ["course", "file_name", "subject", "chunk_idx"]
    kinds = T.StructType.fromDDL("course string, file_name string, subject string, chunk_idx int, node_idx int, part_idx int, text string, topic string, category string, keywords array<string>, has_code boolean, question_templates array<string>, source_coverage double, source_quote string")

    def make() -> Callable[[dict], list[dict]]:
        finish = nodes.finisher(names, provenance=True)

        def one_pass(row: dict, texts: list[str], least: int, most: int, shared: int, low: float, high: float) -> list[dict]:
            found = []
            for text in filter(None, texts):
                for k, chunk in enumerate(passages.transcript_chunks(text, least, most, shared)):
                    sents = passages.sentences(chunk)
                    raw = [{"text": " ".join(sents[i : i + sentences_per_node]), "topic": "", "category": None, "keywords": [], "has_code": None, "question_templates": []} for i in range(0, len(sents), sentences_per_node)]
                    found += finish({"course": row["course"], "file_name": row["file_name"], "subject": row["course"], "chunk_idx": k, "chunk_text": chunk, "nodes": raw})
            found.sort(key=lambda r: (r["chunk_idx"], r["node_idx"], r["part_idx"]))
            return nodes.file_rule(found, low, high)

        def rule(row: dict) -> list[dict]:
            held = one_pass(row, row["texts"], *first)
            long = [t for t in row["texts"] if t and len(t.split()) >= 500] if len(held) <= 1 else []
            rescued = one_pass(row, long, *second) if long else []
            return rescued if len(rescued) > len(held) else held

        return rule

    return mapped(every, kinds, make)


def _extracted_files(files: DataFrame, extractor: Callable[[DataFrame], DataFrame], retries: int, first: tuple, second: tuple) -> DataFrame:
    """Nodes of each file by an extractor over tables of chunks."""

    def one_pass(texts: DataFrame, least: int, most: int, shared: int, low: float, high: float) -> tuple[DataFrame, DataFrame]:
        chunks = texts.select("course", "file_name", F.col("course").alias("subject"), F.posexplode(chunking.transcript_chunks(F.col("text"), least, most, shared)).alias("chunk_idx", "chunk_text"))
        raw, lost = extracted(chunks, extractor, retries)
        return pressed(nodes.file_nodes(nodes.sanitize(raw, provenance=True).drop("id", "page"), FILE, low, high)), lost

    low, lost = one_pass(files, *first)
    few = low.groupBy(*FILE).agg(F.count("*").alias("n"))
    poor = pressed(files.join(lost, FILE, "left_anti").where(word_count(F.col("text")) >= 500).join(few, FILE, "left").where(F.coalesce("n", F.lit(0)) <= 1))
    if poor.isEmpty():
        return low
    rescued, _ = one_pass(poor.drop("n"), *second)
    more = kept(rescued.groupBy(*FILE).agg(F.count("*").alias("m")).join(few, FILE, "left").where(F.col("m") > F.coalesce("n", F.lit(0))).select(*FILE))
    return pressed(without(low, more, FILE).unionByName(among(rescued, more, FILE)))


def extracted(chunks: DataFrame, extractor: Callable[[DataFrame], DataFrame], retries: int) -> tuple[DataFrame, DataFrame]:
    """Chunks with their raw nodes, of the files none of whose chunks failed in their last attempt, and the other files."""
    done, todo = None, chunks
    for attempt in range(retries + 1):
        tried = kept(extractor(todo))
        failed = tried.where(F.col("nodes").isNull()).select(*FILE).distinct()
        good = nodes.keep_error_free(tried, failed, FILE)
        done = good if done is None else done.unionByName(good)
        if attempt == retries or failed.isEmpty():
            break
        todo = chunks.join(failed, FILE, "left_semi")
    return done, failed


def surviving_passages(documents: DataFrame) -> DataFrame:
    """(course, reason, n): passages of about 120 words by what becomes of them; kept ones without near-duplicates."""
    parts = documents.select(F.coalesce("course", F.lit("_root")).alias("course"), "doc_id", F.posexplode(chunking.oversized_parts(F.col("text"), 120)).alias("part_idx", "text"))
    judged = kept(parts.withColumn("reason", quality.drop_reason(F.col("text"))).withColumn("place", F.format_string("%020d/%08d", "doc_id", "part_idx")).withColumn("topic", F.lit("")))
    good = judged.where("reason = 'keep'")
    left = nodes.dedupe(good, ["course"], "place")
    counts = judged.where("reason <> 'keep'").groupBy("course", "reason").agg(F.count("*").alias("n"))
    dropped = good.groupBy("course").agg(F.count("*").alias("n")).join(left.groupBy("course").agg(F.count("*").alias("m")), "course", "left").select("course", F.lit("duplicate").alias("reason"), (F.col("n") - F.coalesce("m", F.lit(0))).alias("n"))
    stay = left.groupBy("course").agg(F.count("*").alias("n")).select("course", F.lit("kept").alias("reason"), "n")
    return counts.unionByName(dropped.where("n > 0")).unionByName(stay)
