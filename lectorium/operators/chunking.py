"""Greedy packing of sentences into chunks and parts: one walk over each text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import passages
from ..functions.arrow import per_row


def transcript_chunks(text: Column, min_words: int = 900, max_words: int = 1400, overlap: int = 70) -> Column:
    """Chunks of whole sentences for extraction, each beginning with the end of the one before."""
    return per_row("array<string>", lambda t: passages.transcript_chunks(t, min_words, max_words, overlap), text)


def oversized_parts(text: Column, max_words: int = 500) -> Column:
    """Parts of whole sentences of at most so many words; a short text is one part, unchanged."""
    return per_row("array<string>", lambda t: passages.oversized_parts(t, max_words), text)


def distinct_sentences(text: Column) -> Column:
    """The first of all sentences with one match form, in order; sentences without one are dropped."""
    return per_row("array<string>", lambda t: passages.distinct_sentences(passages.sentences(t)), text)


def exploded(df: DataFrame, keys: list[str], parts: Column, index: str, name: str) -> DataFrame:
    """One row per part. Null and empty texts have none."""
    return df.select(*keys, F.posexplode(parts).alias(index, name))
