"""Problem 5: freely typed values onto a list of entries.

The entries and their aliases form a trie; a value is searched in it with a Levenshtein automaton
(transpositions count as one edit), which returns every entry within a distance that depends on
the length. A value means an entry if exactly one is nearest; it means none if no entry is near
enough, several are equally near, or its parts mean several. Values are compared in a folded form.
Where the whole value means nothing, the runs of its words are tried that leave out a few words at
either end, since people put wording around a name; the run that leaves out the fewest counts.

Only distinct values are searched, so a value that fills a third of the rows costs one search. A
list of entries that is too long for one trie is cut into blocks, each searched on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.storage import kept
from .arrow_text import Memo, slices, table
from .p7_forms import consistent

#: Names in one trie; a longer list of entries is searched in so many blocks as it takes.
MOST_NAMES = 200_000
#: Words that may stand before and after a name.
AROUND = 3
NONE = "none"

_SIGNS = re.compile(r"[^\w&]+|_")
#: Signs between several names in one value.
_SEVERAL = re.compile(r"[/,;|]|\s(?:or|and|hoặc|và/hoặc)\s", re.I)


def key(value: str) -> str:
    """The folded form: no case, no accents, đ as d, signs as one space."""
    import unicodedata

    plain = unicodedata.normalize("NFD", value.casefold()).replace("đ", "d")
    plain = "".join(c for c in plain if not unicodedata.combining(c))
    return " ".join(_SIGNS.sub(" ", plain).split())


def runs(k: str) -> list[list[str]]:
    """Runs of the words of a folded value, without the value itself: by how many words they leave out."""
    words = k.split()
    out: list[list[str]] = []
    for left_out in range(1, min(2 * AROUND, len(words) - 1) + 1):
        out.append([" ".join(words[a : len(words) - (left_out - a)]) for a in range(max(0, left_out - AROUND), min(AROUND, left_out) + 1)])
    return out


def most_edits(length: int) -> int:
    """Edits allowed for a name of so many characters: none for abbreviations."""
    return 0 if length <= 4 else 1 if length <= 6 else 2 if length <= 12 else 3


class Trie:
    """Names by character; each node may end names of several entries."""

    def __init__(self):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[dict[str, int]] = [{}]

    def add(self, name: str, ref: str) -> None:
        at = 0
        for c in name:
            if c not in self.children[at]:
                self.children[at][c] = len(self.children)
                self.children.append({})
                self.ends.append({})
            at = self.children[at][c]
        self.ends[at][ref] = len(name)

    def search(self, word: str, most: int) -> dict[str, int]:
        """Every entry that has a name within so many edits (and within the name's own limit), with its least distance.

        The automaton's state is the row of edit distances between the path and all prefixes of
        the word; a branch ends where the whole row is beyond the limit.
        """
        found: dict[str, int] = {}
        first = list(range(len(word) + 1))
        stack = [(0, "", first, None)]
        while stack:
            at, last, row, before = stack.pop()
            for ref, length in self.ends[at].items():
                if row[-1] <= min(most, most_edits(length)):
                    found[ref] = min(row[-1], found.get(ref, most + 1))
            for c, to in self.children[at].items():
                new = [row[0] + 1]
                for j, w in enumerate(word, 1):
                    cost = min(new[j - 1] + 1, row[j] + 1, row[j - 1] + (w != c))
                    if before is not None and j > 1 and w == last and word[j - 2] == c:
                        cost = min(cost, before[j - 2] + 1)
                    new.append(cost)
                if min(new) <= most or (min(row) <= most and min(new) <= most + 1):
                    stack.append((to, c, new, row))
        return found


Found = dict[str, int]
Hits = tuple[bool, Found, list[Found], list[Found]]


class Matcher:
    """Values of one field to the entries, or a block of them, that are near."""

    def __init__(self, entries: list[tuple[str, str, list[str] | None]]):
        self.trie = Trie()
        self.entries = set()
        for ref, entry, aliases in entries:
            self.entries.add(entry)
            for name in [entry, *(aliases or [])]:
                if name and (k := key(name)):
                    self.trie.add(k, ref)
        self.search = Memo(lambda k: self.trie.search(k, most_edits(len(k))), 1 << 16)

    def hits(self, value: str, plain: str) -> Hits:
        """Whether the value is an entry; entries near to the whole of it, to each of its parts, and to
        its runs of words by how many words these leave out."""
        k = key(plain)
        whole = self.search[k] if k else {}
        exact = bool(whole) and min(whole.values()) == 0
        parts = [p for p in _SEVERAL.split(plain) if p.strip()]
        by_part = [self._nearest(key(p)) for p in parts] if len(parts) > 1 and not exact else []
        # What isn't needed for the decision isn't searched.
        return value in self.entries, whole, by_part, [self._union(r) for r in runs(k)] if not whole else []

    def _union(self, keys: list[str]) -> Found:
        out: Found = {}
        for k in keys:
            for ref, d in self.search[k].items():
                out[ref] = min(d, out.get(ref, d))
        return out

    def _nearest(self, k: str) -> Found:
        """Entries near to a part, or else to its runs; the words left out count more than any edit."""
        for left_out, keys in enumerate([[k], *runs(k)]) if k else ():
            if found := self._union(keys):
                return {ref: d + 100 * left_out for ref, d in found.items()}
        return {}

    def match(self, value: str) -> tuple[str, int | None, list[str]]:
        """(reference or none, distance, all entries within the distance) by these entries alone."""
        return decide(self.hits(value, value))


def merged(blocks: list[Hits]) -> Hits:
    """What several blocks of entries found for one value."""

    def union(found: list[Found]) -> Found:
        out: Found = {}
        for f in found:
            for ref, d in f.items():
                out[ref] = min(d, out.get(ref, d))
        return out

    each = lambda i: [union([f for f in some if f]) for some in zip_longest(*(b[i] for b in blocks))]
    return any(b[0] for b in blocks), union([b[1] for b in blocks]), each(2), each(3)


def decide(hits: Hits) -> tuple[str, int | None, list[str]]:
    """(reference or none, distance, all entries within the distance, nearest first)."""
    _, whole, parts, by_left_out = hits

    def one(found: Found) -> tuple[str, int | None, list[str]]:
        least = min(found.values())
        near = sorted(found, key=lambda r: (found[r], r))
        return (near[0] if sum(d == least for d in found.values()) == 1 else NONE), least, near

    if whole and min(whole.values()) == 0:
        return one(whole)
    named = {r for f in parts for r, d in f.items() if d == min(f.values())}
    if len(named) > 1:
        return NONE, None, sorted(named)
    for found in (whole, *by_left_out):
        if found:
            return one(found)
    return NONE, None, []


_PAIRS = "array<struct<ref:string,d:int>>"
_HITS = f"is_entry boolean, whole {_PAIRS}, parts array<{_PAIRS}>, left_out array<{_PAIRS}>"


def canonical(values: DataFrame, entries: DataFrame, field_col: str, value_col: str, most_names: int = MOST_NAMES) -> DataFrame:
    """(field, value, is_entry, ref_id, distance, near array<string>) of each distinct non-blank value.

    ref_id is 'none' for a value that means no entry or several; near has every entry within the
    distance. Null fields and null or blank values have no row; other columns are ignored; repeated
    rows and repeated entries count once. A field without entries maps all its values to none. A list
    of more names than fit one trie is searched block by block, with the same rows.
    """
    listed = entries.select("ref_id", "field", "entry", "aliases").where(F.col("entry").isNotNull()).distinct()
    names = listed.agg(F.sum(1 + F.coalesce(F.size("aliases"), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-names // most_names))
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = values.select(F.col(field_col).alias("field"), F.col(value_col).alias("value")).where(F.col("field").isNotNull() & F.col("value").rlike(r"(?U)\S")).distinct().repartition(parts, "value")
    distinct = kept(distinct) if blocks > 1 else distinct
    out = "field string, value string, is_entry boolean, ref_id string, distance int, near array<string>"
    pairs = lambda f: [{"ref": r, "d": d} for r, d in f.items()]
    found = lambda p: {x["ref"]: x["d"] for x in p}

    def decided(fields: list, values: list, hits: list[Hits]) -> pa.RecordBatch:
        ref, distance, near = zip(*map(decide, hits)) if hits else ((),) * 3
        return pa.RecordBatch.from_arrays([pa.array(fields, pa.string()), pa.array(values, pa.string()), pa.array([h[0] for h in hits], pa.bool_()), pa.array(ref, pa.string()), pa.array(distance, pa.int32()), pa.array(near, pa.list_(pa.string()))], names=["field", "value", "is_entry", "ref_id", "distance", "near"])

    def searched(block: int, alone: bool) -> DataFrame:
        rows = listed.where(F.pmod(F.xxhash64("ref_id"), F.lit(blocks)) == block).collect()  # of one block
        own = [(r["field"], (r["ref_id"], r["entry"], list(r["aliases"] or []))) for r in rows]
        target = None if alone else to_arrow_schema(T.StructType.fromDDL(f"field string, value string, {_HITS}"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fields = Memo(lambda f: Matcher([e for g, e in own if g == f]))
            for batch in slices(batches):
                plain = consistent(batch.column(1))[0].to_pylist()
                f, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                hits = [fields[x].hits(y, p) for x, y, p in zip(f, v, plain)]
                if alone:
                    yield decided(f, v, hits)
                else:
                    yield pa.RecordBatch.from_pylist([{"field": x, "value": y, "is_entry": e, "whole": pairs(w), "parts": list(map(pairs, p)), "left_out": list(map(pairs, o))} for x, y, (e, w, p, o) in zip(f, v, hits)], target)

        return distinct.mapInArrow(run, out if alone else f"field string, value string, {_HITS}")

    if blocks == 1:
        return searched(0, True)
    every = searched(0, False)
    for block in range(1, blocks):
        every = every.unionByName(searched(block, False))
    gathered = every.groupBy("field", "value").agg(F.collect_list(F.struct("is_entry", "whole", "parts", "left_out")).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hits = [merged([(h["is_entry"], found(h["whole"]), list(map(found, h["parts"])), list(map(found, h["left_out"]))) for h in row]) for row in batch.column(2).to_pylist()]
            yield decided(batch.column(0).to_pylist(), batch.column(1).to_pylist(), hits)

    return gathered.mapInArrow(run, out)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "knowledge_base_qwen")
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"metadata.{f}").alias("value")) for f in ("subject", "category")))
    return nodes.select("id_", F.explode(pairs).alias("x")).select("id_", "x.field", "x.value")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _typed(spark, sf_dir).where(F.col("value").rlike(r"(?U)\S")).distinct()
    meant = canonical(typed, table(spark, sf_dir, "ref_entries"), "field", "value").where(~F.col("is_entry"))
    # Rows with one value are many; the values are few and usually small enough to be broadcast by
    # their size, and AQE splits the hot ones where they aren't.
    return typed.join(meant, ["field", "value"]).select("id_", "field", "ref_id").distinct()


def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct value with the entry it means and all nearest entries."""
    return canonical(_typed(spark, sf_dir), table(spark, sf_dir, "ref_entries"), "field", "value")


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that mean no entry or several, with the number of their rows."""
    typed = _typed(spark, sf_dir).distinct()
    counts = typed.groupBy("field", "value").agg(F.count("*").alias("n"))
    return p5_values(spark, sf_dir).where(F.col("ref_id") == NONE).join(counts, ["field", "value"]).select("field", "value", "n", "near")


QUERIES = {"p5_found": p5_found, "p5_values": p5_values, "p5_unmatched": p5_unmatched}
