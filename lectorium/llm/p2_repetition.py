"""Problem 2: repetition inside a single text, through tokeniser fertility.

Each text is described by what a public vocabulary makes of it: characters per token, the share
of tokens that are lone bytes, and the entropy of its tokens. The share of words in repeats is
counted exactly. Where only repetitive texts are asked for, a rejection band on the entropy picks
those that can be.

The band is derived, not fitted, so that it loses no case: if half of the n words lie in
repeats, every token of those words also stands in the other half, so there are at most T - S
different tokens, T being all tokens and S those of the n/2 words with the fewest. Entropy is
then at most log2(T - S). A text above that is rejected without looking at its word order.
Bands by script, as quantiles over all texts, are reported by p2_bands.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_text import WORDS, Memo, slices, spread, table
from .p8_encode import VOCABULARY_DIR, encoder

#: A vocabulary of many languages: its tokens are close to the words of each, so that the band is tight.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MIN_SHARE = 0.5
#: What rounding may add to an entropy.
SLACK = 1e-9
_LINE_EDGE = re.compile(r"(?m)^[^\w\n]*\d+(?=[^\w\n]*(?:\s|$))|(?<=\s)\d+[^\w\n]*$|\b\d+(?=[.)]\s)")
_ACCENT = re.compile("[ạảãầấậẩẫằắặẳẵẹẻẽềếệểễỉịĩọỏõồốộổỗơờớợởỡụủũưừứựửữỳỵỷỹđ]", re.I)


def counted_words(text: str) -> list[str]:
    """Words in lower case, without running numbers: those at the edge of a line or before '.' or
    ')', and integers that count on (whose neighbour stands in the text as well)."""
    text = unicodedata.normalize("NFC", text.lower())
    if not any(map(str.isdigit, text)):
        return WORDS.findall(text)
    words = WORDS.findall(_LINE_EDGE.sub(" ", text))
    numbers = {int(w) for w in words if w.isdecimal() and len(w) < 7}
    running = {n for n in numbers if n - 1 in numbers or n + 1 in numbers}
    return [w for w in words if not (w.isdecimal() and len(w) < 7 and int(w) in running)] if running else words


def repeated_share(words: list[str]) -> float:
    """Share of words in stretches of two or more words that occur earlier in the same text."""
    if len(words) < 2:
        return 0.0
    pairs = list(zip(words, words[1:]))
    if len(set(pairs)) == len(pairs):
        return 0.0
    seen: set[tuple[str, str]] = set()
    covered = bytearray(len(words))
    for i, pair in enumerate(pairs):
        if pair in seen:
            covered[i] = covered[i + 1] = 1
        else:
            seen.add(pair)
    return sum(covered) / len(words)


def fertility(df: DataFrame, keys: list[str], text_col: str, path: str | None = None, suspects_only: bool = False) -> DataFrame:
    """keys, script, n_words, chars_per_token, byte_share, entropy, band, repeated_share of each text.

    Every text has a row. One without a word (null and blank ones too) has 0 words, a share of 0
    and no other measures. With suspects_only the texts that the band rejects and those without
    a word aren't returned. Rows that are repeated stay repeated; other columns are ignored. Long
    texts are counted whole.
    """
    path = path or f"{VOCABULARY_DIR}/{VOCABULARY}"
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{fields}, script string, n_words int, chars_per_token double, byte_share double, entropy double, band double, repeated_share double"
    plogp = [0.0] + [n * log2(n) for n in range(1, 4096)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        lone = {i for t, i in enc.transducer.ranks.items() if len(t) == 1 and t[0] > 127}
        ids_of = Memo(lambda w: tuple(enc.encode(" " + w)))
        for batch in slices(batches, 8192):
            at, rows = [], []
            for i, text in enumerate(batch.column(len(keys)).to_pylist()):
                words = counted_words(text) if text else []
                n = len(words)
                if not n:
                    if not suspects_only:
                        at.append(i)
                        rows.append((None, 0, None, None, None, None, 0.0))
                    continue
                tokens = list(map(ids_of.__getitem__, words))
                sizes = sorted(map(len, tokens))
                total = sum(sizes)
                counts = Counter(chain.from_iterable(tokens))
                entropy = log2(total) - sum(plogp[c] if c < 4096 else c * log2(c) for c in counts.values()) / total
                band = log2(max(1, total - sum(sizes[: (n + 1) // 2])))
                if not suspects_only or entropy <= band + SLACK:
                    at.append(i)
                    script = "vi" if _ACCENT.search(text) else "latin" if text.isascii() else "other"
                    rows.append((script, n, sum(map(len, words)) / total, sum(c for t, c in counts.items() if t in lone) / total, entropy, band, repeated_share(words)))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.string(), pa.int32()] + [pa.float64()] * 5
            own = [batch.column(j).take(pa.array(at, pa.int32())) for j in range(len(keys))]
            yield pa.RecordBatch.from_arrays(own + [pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in keys] + ["script", "n_words", "chars_per_token", "byte_share", "entropy", "band", "repeated_share"])

    return spread(df.select(*keys, text_col)).mapInArrow(run, schema)


KEYS = ["media_id", "seg_idx"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fertility(table(spark, sf_dir, "segments"), KEYS, "text", suspects_only=True).where(F.col("repeated_share") >= MIN_SHARE)
    return found.select(*KEYS).distinct()


def p2_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of every segment, one row for each key."""
    return fertility(table(spark, sf_dir, "segments").dropDuplicates(KEYS), KEYS, "text")


def p2_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By script: quantiles of the measures over all texts with words, and how many fall below the band."""
    measures = fertility(table(spark, sf_dir, "segments"), KEYS, "text").where("n_words > 0")
    quantiles = [F.percentile_approx(c, [0.01, 0.05, 0.5, 0.95, 0.99], 1000).alias(f"q_{c}") for c in ("chars_per_token", "byte_share", "entropy")]
    return measures.groupBy("script").agg(F.count("*").alias("n"), F.count_if(F.col("entropy") <= F.col("band") + SLACK).alias("n_in_band"), *quantiles)


QUERIES = {"p2_found": p2_found, "p2_shares": p2_shares, "p2_bands": p2_bands}
