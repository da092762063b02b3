"""Problem 1: statistics of each text that tell prose from lists, tables and junk.

A text is cut into units (lines, and the sentences of long lines). Each unit has five statistics:
the share of words that hold sentences together, the share of letters, of strange tokens, of links,
times and wrongly decoded characters, and the marks of lists and tables. Mergeable quantile sketches
(KLL) of the units that have the form of a sentence give, per language, what is usual; robust
z-scores of a unit against them add up to a score, and the units in the tail of the score lie
outside readable sentences. A document is a case if more than half of its characters do.

The form of a sentence (a capital, an end, few commas) doesn't look at the words, so a source of
junk, whatever its share, doesn't become what is usual. A language with few such units takes fixed
values. For whole texts there are statistics as well, with percentiles and z-scores per language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.storage import kept
from .arrow_text import Memo, slices, spread, table
from .p10_residue import residue_kind

MIN_SHARE = 0.5
#: Score from which a unit lies in the tail, and the weight of each statistic's z in it.
TAIL_SCORE = 1.85
WEIGHTS = {"glue": 1.0, "letters": 0.1, "strange": 0.1, "marks": 0.1, "alien": 0.5}
#: Sides of the tails: few binding words and letters, many of the others.
UNIT_SIDES = {"glue": -1, "letters": -1, "strange": 1, "marks": 1, "alien": 1}
#: Largest z that counts: of binding words (which may also speak for a unit), and of the others.
MOST_GLUE_Z, MOST_Z = 3.0, 12.0
#: Robust z from which a whole text's statistic lies in the tail.
TAIL_Z = 3.5
#: Smallest scale of a statistic, where half of all units or texts have one value; binding words vary more from sentence to sentence.
LEAST_SCALE, LEAST_GLUE_SCALE = 0.02, 0.06
SKETCH_K = 400
#: Units with the form of a sentence (or texts mostly inside sentences) that a language needs for values of its own.
LEAST_REFERENCE = 30
#: Lines before and after with which a line without a sentence end is judged.
NEAR = 4

#: Common words that hold sentences together, without those that also stand in terms.
COMMON = {
    "vi": frozenset("và của là các được khi cho này để nếu vào mỗi lại bởi vì theo như nhưng tại bằng trên sau trước đã bị với ta hoặc thì mà cũng về nhờ đó đến ở sao qua do hãy rất nào ai gì đây kia đang sẽ còn chưa rồi nên hay cùng trong ra những từng bạn em tôi chúng vẫn".split()),
    "en": frozenset("the a an of and is in to that by with on for if from our be as at it or no has have are was were whenever either whether but not this these there what why how should because since after before although without even when than then you your we i they he she can will would do does did its is so let me once up into over any much like".split()),
}
_COMMON = COMMON["vi"] | COMMON["en"]

_WORD = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_BULLET = re.compile(r"^\s*(?:[-*•–—→▪◦‣·+>○●■□✓✔☐]|\(?\d{1,4}[.):]|\(?[a-zA-Z][.)]|\(?[ivxIVX]{1,5}[.)])\s+")
_TIME = r"[\[(<]?(?:\d{1,2}[:h]\d{2}(?:[:m]\d{2})?(?:[.,]\d{1,3})?s?)[\])>]?"
_TIMES = re.compile(rf"^(?:\s*(?:-->|-|–)?\s*{_TIME}\s*(?:-->|-|–)?)+\s*$")
_LINK = re.compile(r"https?://\S+|www\.\S+|\b[\w.-]+@[\w.-]+\.\w+")
_RECORD = re.compile(r"^\s*[\w.\- ]{1,30}\s*(?:=>|=|:)\s*\S+(?:\s\S+){0,2}\s*$")
_LEADER = re.compile(r"(?:\.{4,}|…{2,}|(?:\. ){4,})\s*\d+\s*$")
#: What UTF-8 looks like when it was read as Latin-1 or Windows-1252.
_WRONG = re.compile(r"[ÂÃÄÅÆ][-¿‘-„†-•…‰‹›€™šœžŸƒˆ˜]|á[º»]|Ã.|Ä.|Æ°|Æ¡|â€|ï»¿|�")
_END = re.compile(r"[.!?…:;\"”’)]\s*$")
_SPLIT = re.compile(r"(?<=[.!?])\s+")
_VOWEL = re.compile(r"[aeiouy]")


def _odd(token: str) -> bool:
    """A token that is no word: no vowel, digits mixed with letters, or far too long."""
    low = token.lower()
    letters = _WORD.findall(low)
    if not letters:
        return True
    joined = "".join(letters)
    if len(joined) > 22 or (any(map(str.isdigit, low)) and len(low) > 3):
        return True
    return joined.isascii() and len(joined) > 2 and not _VOWEL.search(joined)


#: What lies between the cells of a table.
_CELL = re.compile(r"\||\t|(?<=\S) {2,}(?=\S)|[;,](?=\S)")


def _marks(text: str, words: int) -> float:
    """How much a line looks like an entry, a row or a record."""
    out = 0.5 * bool(_BULLET.match(text))
    if "…" in text or text.count(".") >= 4:
        out += 2.0 * bool(_LEADER.search(text))
    if "," in text or "|" in text or "  " in text or ";" in text or "\t" in text:
        cells = len(_CELL.findall(text))
        out += min(cells, 6) / 2 if cells >= 2 else 0.0
    return out + (words <= 8 and (":" in text or "=" in text) and bool(_RECORD.match(text)))


def _alien(text: str, size: int) -> float:
    """Share of links, bare times and wrongly decoded characters."""
    n = size if text[:8].strip()[:1] in "0123456789[(<-–" and _TIMES.match(text) else 0
    if "http" in text or "www." in text or "@" in text:
        n += sum(map(len, _LINK.findall(text)))
    if not text.isascii():
        n += sum(map(len, _WRONG.findall(text)))
    return n / size


def _sentence_form(text: str, words: int) -> bool:
    """Begins with a capital, ends as a sentence does, has few commas."""
    t = text.strip()
    return words >= 3 and t[:1].isupper() and t[-1:] in ".!?" and t.count(",") * 4 <= words


def units(text: str) -> list[str]:
    out = []
    for line in text.splitlines():
        if line.strip():
            out += [p for p in (_SPLIT.split(line) if len(line) > 110 else [line]) if p.strip()]
    return out


STATISTICS = ["n_words", "mean_word_length", "symbol_share", "digit_share", "line_end_share", "common_share", "outside_share"]
#: Statistics of whole texts whose tail marks junk, and on which side.
SIDES = {"symbol_share": 1, "digit_share": 1, "common_share": -1, "outside_share": 1, "mean_word_length": 1}
#: Median and scale of each where a language has too few texts for its own; wide enough for both languages.
FALLBACK = {"symbol_share": (0.02, 0.02), "digit_share": (0.01, 0.02), "common_share": (0.25, 0.06), "outside_share": (0.0, 0.02), "mean_word_length": (4.4, 0.5)}


UNITS = ["size", *WEIGHTS, "form", "residue"]
#: Median and scale of the units' statistics where a language has too few sentences for its own; wide enough for both.
UNIT_FALLBACK = {"glue": (0.25, 0.09), "letters": (0.97, 0.04), "strange": (0.0, 0.08), "marks": (0.0, 0.02), "alien": (0.0, 0.02)}


def measured(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, language, statistics of the text, statistics of its units as arrays) of each text with a visible character.

    language is that of the text (vi or en), not the label. Null, empty and blank texts have no
    row; repeated rows stay repeated; other columns are ignored; texts are read whole.
    """
    arrays = [T.StructField(u, T.ArrayType(T.BooleanType() if u in ("form", "residue") else T.FloatType())) for u in UNITS]
    schema = T.StructType([df.schema[id_col], T.StructField("language", T.StringType()), *(T.StructField(s, T.DoubleType()) for s in STATISTICS if s != "outside_share"), *arrays])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strange = Memo(_odd)
        for batch in slices(batches, 512):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text or not text.strip():
                    continue
                parts = units(text)
                counts, values = [], []
                for part in parts:
                    words = _WORD.findall(part.lower())
                    tokens = part.split()
                    n, common, letters, size = len(words), sum(map(_COMMON.__contains__, words)), sum(map(len, words)), sum(map(len, tokens))
                    marks, alien = _marks(part, n), _alien(part, size)
                    # Residue is only looked for where a unit might be in the tail.
                    plain = n >= 4 and common >= 0.25 * n and letters >= 0.85 * size and not marks and not alien
                    residue = not plain and marks < 2 and residue_kind(part) is not None
                    counts.append((n, common, not _END.search(part), letters))
                    values.append((size, letters / size, sum(map(strange.__getitem__, tokens)) / len(tokens), marks, alien, _sentence_form(part, n), residue))
                c = np.array(counts, np.int64)
                bare = c[:, 2] == 1
                own = c[:, 1] / np.maximum(c[:, 0], 1)
                sums = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(c[:, :2] * bare[:, None], axis=0)))
                at = np.arange(len(parts))
                around = sums[np.minimum(at + NEAR + 1, len(parts))] - sums[np.maximum(at - NEAR, 0)]
                glue = np.where(bare, np.maximum(own, around[:, 1] / np.maximum(around[:, 0], 1)), own)
                size, letters, odd, marks, alien, form, residue = zip(*values)
                total, n, common = sum(size), int(c[:, 0].sum()), int(c[:, 1].sum())
                all_letters, digits = int(c[:, 3].sum()), len("".join(_DIGITS.findall(text)))
                lines = [x for x in text.splitlines() if x.strip()]
                language = "vi" if len(text.encode("utf-8")) - len(text) > 0.06 * total else "en"
                whole = (float(n), all_letters / n if n else 0.0, (total - all_letters - digits) / total, digits / total, sum(bool(_END.search(x)) for x in lines) / len(lines), common / n if n else 0.0)
                rows.append((key, language, *whole, size, glue.tolist(), letters, odd, marks, alien, form, residue))
            columns = list(zip(*rows)) if rows else [()] * len(target)
            yield pa.RecordBatch.from_arrays([pa.array(list(map(list, c)) if isinstance(f.type, pa.ListType) else list(c), f.type) for c, f in zip(columns, target)], schema=target)

    return spread(df.select(id_col, text_col)).mapInArrow(run, schema)


def unit_sketches(measures: DataFrame) -> DataFrame:
    """One row per language: a KLL sketch of each statistic over the units that have the form of a sentence."""
    zipped = measures.select("language", F.explode(F.arrays_zip(*UNITS)).alias("u")).where("u.form")
    return zipped.groupBy("language").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_float(F.col(f"u.{s}"), F.lit(SKETCH_K)).alias(s) for s in WEIGHTS))


def unit_bounds(measures: DataFrame) -> dict[str, dict[str, tuple[float, float]]]:
    """(median, scale) of each statistic by language; two rows are brought to the driver."""
    at = lambda s, q: F.kll_sketch_get_quantile_float(F.col(s), F.lit(q))
    points = [F.struct(at(s, 0.5).alias("m"), at(s, 0.25 if UNIT_SIDES[s] < 0 else 0.75).alias("q")).alias(s) for s in WEIGHTS]
    rows = unit_sketches(measures).where(F.col("n") >= LEAST_REFERENCE).select("language", *points).collect()
    return {r["language"]: {s: (r[s]["m"], max(LEAST_GLUE_SCALE if s == "glue" else LEAST_SCALE, 2 * abs(r[s]["m"] - r[s]["q"]) / 1.349)) for s in WEIGHTS} for r in rows}


def scored(measures: DataFrame, id_col: str, bounds: dict[str, dict[str, tuple[float, float]]]) -> DataFrame:
    """(id, language, main_kind, the statistics): outside_share is the share of characters of units in the tail.

    main_kind is the statistic that speaks most against these units.
    """
    held = [c for c in measures.columns if c not in UNITS]
    schema = T.StructType([*(measures.schema[c] for c in held), T.StructField("outside_share", T.DoubleType()), T.StructField("main_kind", T.StringType())])
    names = list(WEIGHTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = {u: batch.column(len(held) + i) for i, u in enumerate(UNITS)}
            flat = {u: x.flatten().to_numpy(zero_copy_only=False) for u, x in lists.items()}
            lengths = lists["size"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(batch.num_rows), lengths)
            known = [bounds.get(x, UNIT_FALLBACK) for x in batch.column(1).to_pylist()]
            parts = np.zeros((len(names), len(rows)))
            for k, s in enumerate(names):
                median, scale = (np.array([b[s][j] for b in known])[rows] for j in (0, 1))
                z = UNIT_SIDES[s] * (flat[s] - median) / scale
                parts[k] = WEIGHTS[s] * (np.clip(z, -MOST_GLUE_Z, MOST_GLUE_Z) if s == "glue" else np.clip(z, 0, MOST_Z))
            out = (parts.sum(axis=0) > TAIL_SCORE) & ~flat["residue"].astype(bool)
            weight = np.where(out, flat["size"], 0)
            total = np.bincount(rows, flat["size"], batch.num_rows)
            outside = np.bincount(rows, weight, batch.num_rows)
            # Few letters or binding words alone are a list; the others say more.
            leads = np.stack([np.bincount(rows, weight * parts[k] * (1 if names[k] != "glue" else 0.3), batch.num_rows) for k in range(len(names))])
            kind = [names[k] if o > 0 else None for k, o in zip(leads.argmax(axis=0), outside)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(held)], pa.array(outside / np.maximum(total, 1)), pa.array(kind, pa.string())], names=schema.names)

    return measures.mapInArrow(run, schema)


def statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, language, the statistics, main_kind) of each text with a visible character."""
    measures = kept(measured(df, id_col, text_col))
    return scored(measures, id_col, unit_bounds(measures))


def sketches(stats: DataFrame) -> DataFrame:
    """One row per language: a KLL sketch of each statistic. Partial sketches are built before the
    shuffle and merged after it, so that a language that holds most rows moves no rows."""
    return stats.groupBy("language").agg(F.count("*").alias("n"), *(F.kll_sketch_agg_double(s, F.lit(SKETCH_K)).alias(s) for s in STATISTICS))


def tails(stats: DataFrame, id_col: str) -> DataFrame:
    """The statistics with robust z-scores and the flag of the tails.

    stats is read twice (for the sketches and for the rows), so pass a table or a checkpoint.
    """
    at = lambda s, q: F.kll_sketch_get_quantile_double(F.col(s), F.lit(q))
    reference = sketches(stats.where(F.col("outside_share") <= MIN_SHARE)).where(F.col("n") >= LEAST_REFERENCE)
    bounds = reference.select("language", *(at(s, 0.5).alias(f"m_{s}") for s in SIDES), *((2 * F.abs(at(s, 0.5) - at(s, 0.25 if side > 0 else 0.75)) / 1.349).alias(f"s_{s}") for s, side in SIDES.items()))
    scored = stats.join(F.broadcast(bounds), "language", "left")  # one row per language
    for s, (median, scale) in FALLBACK.items():
        scored = scored.withColumn(f"z_{s}", (F.col(s) - F.coalesce(f"m_{s}", F.lit(median))) / F.greatest(F.coalesce(f"s_{s}", F.lit(scale)), F.lit(LEAST_SCALE)))
    flag = F.lit(False)
    for s, side in SIDES.items():
        flag = flag | (side * F.col(f"z_{s}") > TAIL_Z)
    return scored.withColumn("in_tail", flag).select(id_col, "language", "main_kind", *STATISTICS, *(f"z_{s}" for s in SIDES), "in_tail")


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tails(kept(statistics(table(spark, sf_dir, "documents"), "doc_id", "text")), "doc_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which more than half of the characters lie in the tail of the units' scores."""
    return statistics(table(spark, sf_dir, "documents"), "doc_id", "text").where(F.col("outside_share") > MIN_SHARE).select("doc_id").distinct()


def p1_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics, z-scores and tail flag of every document."""
    return scored_documents(spark, sf_dir)


def p1_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By language and statistic: the 1st to 99th percentile from the sketches."""
    whole = sketches(kept(statistics(table(spark, sf_dir, "documents"), "doc_id", "text")))
    long = whole.select("language", "n", F.explode(F.array(*(F.struct(F.lit(s).alias("statistic"), F.col(s).alias("sketch")) for s in STATISTICS))).alias("x"))
    points = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    return long.select("language", "n", "x.statistic", *(F.kll_sketch_get_quantile_double("x.sketch", F.lit(q)).alias(k) for k, q in points.items()))


QUERIES = {"p1_found": p1_found, "p1_statistics": p1_statistics, "p1_percentiles": p1_percentiles}
