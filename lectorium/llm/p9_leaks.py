"""Problem 9: passages of evaluation items in a corpus, through template canonicalisation.

Numbers, names and units become typed placeholders; windows of the resulting template are
hash-joined between items and documents; the slots of a joined window are then compared. Equal
slots: the passage stands there verbatim. Slots that differ, but each item value always by one
document value and the other way round: the question was re-parameterised.

A word's type depends on the word alone (folded: no case, no accents), never on its context, so
equal passages always have equal templates and no verbatim passage is lost. A word that no item has
as a literal is a name only if it is written like one: where slots differ, both sides must begin with
a capital, and at least one number, unit or name of the window must differ consistently.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.storage import kept
from .arrow_text import Memo, fold, slices, spread, table, word_runs

WINDOW = 12
#: Words a re-parameterised window must share besides its slots.
MIN_LITERAL = 6
#: Item windows up to which the item side is sent to the tasks (8 bytes each and the words); more are joined by shuffle.
MOST_BROADCAST_WINDOWS = 1_000_000

#: Places that a word's row is sent to where texts are joined with the literal words.
SALTS = 32
#: Bits of the filter of item windows that documents are read against before the join (16 MB, whatever the list).
FILTER_BITS = 1 << 27

#: Units of measure, folded.
UNITS = frozenset("kg g mg km m cm mm nm l ml s ms h v w kw hz khz mhz gb mb kb giay phut gio met lit gam kilogam seconds second minutes minute hours hour metres metre meters meter litres liters grams percent dong vnd usd".split())

SEPARATOR, NUMBER, UNIT, NAME, FIRST_WORD = 0, 1, 2, 3, 4
_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(codes: np.ndarray) -> np.ndarray:
    if len(codes) < WINDOW:
        return np.empty(0, np.uint64)
    codes, size = codes.astype(np.uint64) + np.uint64(1), len(codes) - WINDOW + 1
    out = np.zeros(size, np.uint64)
    for k in range(WINDOW):
        out += codes[k : k + size] * _MULTIPLIERS[k]
    return out ^ (out >> np.uint64(29))


def literal_words(text: str) -> set[str]:
    """The words of an item that aren't numbers, units or names."""
    words = word_runs(text)
    starts = {0} | {i for i in range(1, len(words)) if _begins_sentence(text, words, i)}
    folded = {fold(w) for i, w in enumerate(words) if not w[:1].isupper() or i in starts}
    return {w for w in folded if not w.isdecimal() and w not in UNITS}


class Template:
    """The words that count as literal: those of the items that aren't numbers, units or names."""

    def __init__(self, texts: list[str]):
        self.codes = {w: i + FIRST_WORD for i, w in enumerate(sorted(set().union(*map(literal_words, texts))))}

    def code(self, word: str) -> int:
        word = fold(word)
        return self.codes.get(word) or slot(word)


def slot(word: str) -> int:
    """The type of a folded word that isn't literal."""
    return NUMBER if word.isdecimal() else UNIT if word in UNITS else NAME


def _begins_sentence(text: str, words: list[str], i: int) -> bool:
    at = text.find(words[i - 1] + " " + words[i])
    return at < 0 or text[at - 1 : at] in ".!?"


def compare(item: list[str], doc: list[str], codes: np.ndarray, item_caps: str, doc_caps: str) -> str | None:
    """What a window that has the item's template is: verbatim, reparameterised or nothing.

    item and doc are folded words; the caps say by '1' which of them begin with a capital.
    """
    if item == doc:
        return "verbatim"
    if int((codes >= FIRST_WORD).sum()) < MIN_LITERAL:
        return None
    there: dict = {}
    back: dict = {}
    for a, b, c, up, doc_up in zip(item, doc, codes, item_caps, doc_caps):
        if c >= FIRST_WORD:
            if a != b:
                return None
        elif there.setdefault((c, a), b) != b or back.setdefault((c, b), a) != a:
            return None
        elif c == NAME and a != b and (up, doc_up) != ("1", "1"):
            return None
    return "reparameterised"


def capitals(words: list[str]) -> str:
    return "".join("1" if w[:1].isupper() else "0" for w in words)


def leaks(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, most_broadcast: int = MOST_BROADCAST_WINDOWS) -> DataFrame:
    """(doc id, item id, kind, n_windows): every document and item that share a window of twelve words.

    kind is 'verbatim' if any shared window is, else 'reparameterised'. Null and empty texts and
    texts shorter than a window share nothing. Repeated rows of either table count once. Documents
    are never shuffled while the items' windows fit the stated bound; beyond it both sides are
    joined by the hash of the template window.
    """
    items = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull()).distinct()
    words = F.size(F.split("text", r"\s+"))
    total = items.agg(F.sum(words)).first()[0] or 0
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField(item_id, items.schema["item"].dataType), T.StructField("kind", T.StringType()), T.StructField("n_windows", T.LongType())])
    source = spread(docs.select(doc_id, doc_text))
    if total > most_broadcast:
        return _leaks_by_shuffle(source, doc_id, items, item_id, schema)
    rows = [(r["item"], r["text"]) for r in items.collect()]
    template = Template([t for _, t in rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: dict[int, list[tuple[object, list[str], str]]] = {}
        for key, text in rows:
            own = word_runs(text)
            hashes = window_hashes(np.array([template.code(w) for w in own], np.int64))
            caps = capitals(own)
            own = [fold(w) for w in own]
            for i, h in enumerate(hashes.tolist()):
                windows.setdefault(h, []).append((key, own[i : i + WINDOW], caps[i : i + WINDOW]))
        known = np.array(sorted(windows), np.uint64)
        code = Memo(template.code)
        for batch in slices(batches):
            words, starts = [], []
            for text in batch.column(1).to_pylist():
                starts.append(len(words))
                if text:
                    words += word_runs(text)
                words.append("")
            code[""] = SEPARATOR
            codes = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
            hashes = window_hashes(codes)
            hits = np.flatnonzero(np.isin(hashes, known)) if len(known) else []
            rows_of = np.searchsorted(np.array(starts), hits, "right") - 1
            found: dict = {}
            for at, row in zip(hits, rows_of):
                doc, doc_caps = [fold(w) for w in words[at : at + WINDOW]], capitals(words[at : at + WINDOW])
                for key, own, caps in windows[int(hashes[at])]:
                    kind = compare(own, doc, codes[at : at + WINDOW], caps, doc_caps)
                    if kind:
                        n, best = found.get((int(row), key), (0, ""))
                        found[int(row), key] = (n + 1, max(best, kind))
            pairs = list(found.items())
            ids = batch.column(0).take(pa.array([r for (r, _), _ in pairs], pa.int32()))
            out = pa.Table.from_pandas(pd.DataFrame({item_id: [k for (_, k), _ in pairs], "kind": [b for _, (_, b) in pairs], "n_windows": [n for _, (n, _) in pairs]}), preserve_index=False) if pairs else None
            if out is not None:
                yield pa.RecordBatch.from_arrays([ids, *(out.column(i).combine_chunks() for i in range(3))], names=schema.names)

    found = source.mapInArrow(run, schema)
    return found.groupBy(doc_id, item_id).agg(F.max("kind").alias("kind"), F.max("n_windows").alias("n_windows"))


def _bits_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each window hash in the filter."""
    u = h.view(np.uint64)
    return (u % np.uint64(FILTER_BITS)).astype(np.int64), ((u >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) % np.uint64(FILTER_BITS)).astype(np.int64)


def window_filter(windows: DataFrame) -> np.ndarray:
    """A Bloom filter of the column h: bytes of fixed number, put together from one part of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for at in _bits_of(batch.column(0).to_numpy()):
                bits[at] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["b"])

    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in windows.select("h").coalesce(8).mapInArrow(run, "b binary").toLocalIterator():
        out |= np.frombuffer(row["b"], np.uint8)
    return out


def may_hold(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each hash; never false for one that it was made of."""
    one, two = _bits_of(h)
    return (bits[one >> 3] >> (7 - (one & 7)) & 1).astype(bool) & (bits[two >> 3] >> (7 - (two & 7)) & 1).astype(bool)


def _leaks_by_shuffle(source: DataFrame, doc_id: str, items: DataFrame, item_id: str, schema: T.StructType) -> DataFrame:
    """The same rows as by broadcast, both sides being joined by hash.

    The literal words of all items are a table, joined with the distinct words of each text, so that
    both sides get the same templates. A window with fewer than MIN_LITERAL literal words can only be
    verbatim and is hashed by its words; others by their template, and then compared slot by slot.
    """

    def words_of(name: str, make):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 256):
                at, out = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    own = make(text) if text else ()
                    at += [i] * len(own)
                    out += own
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(out, pa.string())], names=["key", name])

        return run

    vocabulary = items.select(F.md5("text"), "text").mapInArrow(words_of("word", literal_words), "key string, word string").select("word").distinct()
    # Frequent words are in almost every text, so each goes to SALTS places.
    salted = vocabulary.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def side(df: DataFrame, key: str, name: str, bits: np.ndarray | None = None) -> DataFrame:
        texts = df.select(F.col(key).alias("id"), F.col(df.columns[1]).alias("text")).where(F.col("text").isNotNull()).distinct().withColumn("key", F.md5("text"))
        each = texts.select("key", "text").dropDuplicates(["key"]).mapInArrow(words_of("word", lambda t: {fold(w) for w in word_runs(t)}), "key string, word string")
        known = each.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(salted, ["word", "salt"]).groupBy("key").agg(F.collect_list("word").alias("literal"))
        out = T.StructType([T.StructField("h", T.LongType()), T.StructField(name, df.schema[key].dataType), T.StructField(f"{name}_key", T.StringType()), T.StructField(f"{name}_words", T.StringType()), T.StructField(f"{name}_types", T.StringType()), T.StructField(f"{name}_caps", T.StringType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            folded = Memo(fold)
            number = Memo(lambda w: (xxhash.xxh3_64_intdigest(w) >> 2) + FIRST_WORD)
            for batch in slices(batches, 64):
                h, at, runs, types, caps = [], [], [], [], []
                for i, (text, known) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                    written = word_runs(text)
                    words, literal, upper = [folded[w] for w in written], set(known or ()), capitals(written)
                    kinds = [FIRST_WORD if w in literal else slot(w) for w in words]
                    plain = np.array([number[w] for w in words], np.int64)
                    kind = np.array(kinds, np.int64)
                    by_words, by_template = window_hashes(plain), window_hashes(np.where(kind == FIRST_WORD, plain, kind))
                    size = len(by_words)
                    if not size:
                        continue
                    count = np.convolve(kind == FIRST_WORD, np.ones(WINDOW, np.int64), "valid")
                    own = np.where(count < MIN_LITERAL, by_words, by_template).view(np.int64)
                    places = range(size) if bits is None else np.flatnonzero(may_hold(bits, own)).tolist()
                    h += own[list(places)].tolist()
                    at += [i] * len(places)
                    runs += [" ".join(words[j : j + WINDOW]) for j in places]
                    line = "".join(map(str, kinds))
                    types += [line[j : j + WINDOW] for j in places]
                    caps += [upper[j : j + WINDOW] for j in places]
                take = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), batch.column(0).take(take), batch.column(1).take(take), pa.array(runs, pa.string()), pa.array(types, pa.string()), pa.array(caps, pa.string())], names=out.names)

        windows = texts.join(known, "key", "left").select("id", "key", "text", "literal").mapInArrow(run, out)
        return windows.groupBy(*out.names).agg(F.count("*").alias(f"{name}_n"))

    @F.pandas_udf("string")
    def kind(item: pd.Series, doc: pd.Series, types: pd.Series, item_caps: pd.Series, doc_caps: pd.Series) -> pd.Series:
        return pd.Series([compare(a.split(" "), b.split(" "), np.array(list(map(int, c))), *caps) for a, b, c, *caps in zip(item, doc, types, item_caps, doc_caps)], dtype=object)

    # Only windows that some item may have leave the task that read them.
    of_items = kept(side(items, "item", "i"))
    joined = side(source, doc_id, "d", window_filter(of_items)).join(of_items, "h").withColumn("kind", kind("i_words", "d_words", "d_types", "i_caps", "d_caps")).where(F.col("kind").isNotNull())
    by_text = joined.groupBy(F.col("d").alias(doc_id), "d_key", F.col("i").alias(item_id)).agg(F.max("kind").alias("kind"), F.sum(F.col("d_n") * F.col("i_n")).alias("n_windows"))
    return by_text.groupBy(doc_id, item_id).agg(F.max("kind").alias("kind"), F.max("n_windows").alias("n_windows"))


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim and re-parameterised leaks with the number of shared windows."""
    return leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_leaks(spark, sf_dir).where(F.col("kind") == "verbatim").select("doc_id", "item_id")


QUERIES = {"p9_found": p9_found, "p9_leaks": p9_leaks}
SQL = {
    "p9_found": """
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT 'i', item_id, text FROM eval_items WHERE text IS NOT NULL),
words AS (
  SELECT side, id, regexp_extract_all(replace(strip_accents(lower(text)), 'đ', 'd'), '[\\p{L}\\p{N}]+') AS a FROM w),
grams AS (
  SELECT DISTINCT side, id, unnest(list_transform(generate_series(1, len(a) - 11), lambda i: array_to_string(a[i:i+11], ' '))) AS g
  FROM words WHERE len(a) >= 12)
SELECT DISTINCT d.id AS doc_id, i.id AS item_id
FROM grams d JOIN grams i ON d.g = i.g WHERE d.side = 'd' AND i.side = 'i'
"""
}
