"""Problem 7: one consistent form for text that only looks ordinary.

An Arrow batch becomes one array of code points. Lookup tables say of each code point what it
is; gathers and expansion offsets replace it; marks are ordered and composed with their letters
by searching sorted pair tables. Nothing is called row by row or word by word.

The form: full-width, half-width, styled and circled letters, digits and signs and ligatures
become plain ones; accents are composed with their letter; invisible characters go; every other
space becomes the ordinary one; and in a word of Latin letters, letters of another script that
look the same become Latin. Line breaks, tabs, typographic quotes and dashes, superscripts,
mathematical signs, symbols and words of other scripts stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_text import code_points, from_code_points, slices, spread, table

LIMIT = 0x110000
#: Classes of code points.
PLAIN, SPACE, INVISIBLE, STYLED, MARK, FOREIGN, JOINER = range(7)
#: Scripts of letters, for judging words.
NOT_A_LETTER, LATIN, LOOKALIKE, OTHER = range(4)

#: Letters of other alphabets that look like a Latin letter, and the letter.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝӏѵ", "ABESIJKMHOPCTYXaesijopcyxhdqwlv"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονιραυκ", "ABEZHIKMNOPTYXovipauk"))
ARMENIAN = dict(zip("օոսհցզ", "onuhgq"))
LATIN_TWINS = dict(zip("ðÐƉɖıɑɡ", "đĐĐđiag"))
#: Greek letters that also serve as symbols beside one or two Latin letters.
SYMBOLS = "αικνρυ"
LOOKALIKES = CYRILLIC | GREEK | ARMENIAN | LATIN_TWINS

#: Ranges whose characters are styled forms, besides those Unicode calls wide, narrow or font.
_STYLED_RANGES = ((0xFB00, 0xFB06), (0xFF01, 0xFF5E), (0x2460, 0x24FF), (0x1D400, 0x1D7FF), (0x1F100, 0x1F169))
#: Invisible characters that Unicode does not put into the format category.
_INVISIBLE = (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, 0x2800, 0x3164, 0xFFA0)


class Tables:
    """Lookup tables over all code points; about 15 MB, built once for each Python worker."""

    def __init__(self):
        self.kind = np.zeros(LIMIT, np.uint8)
        self.script = np.zeros(LIMIT, np.uint8)
        self.twin = np.zeros(LIMIT, np.int32)
        self.order = np.zeros(LIMIT, np.uint8)
        self.emoji = np.zeros(LIMIT, bool)
        self.emoji[0x1F000:0x1FB00] = True
        self.emoji[0x2600:0x27C0] = True
        styled: dict[int, list[int]] = {}
        marks = {}
        for i in (*range(0xD800), *range(0xE000, 0x11000), *range(0x1D000, 0x1F200), *range(0xE0000, 0xE0200)):
            c = chr(i)
            category = unicodedata.category(c)
            if category == "Cf":
                self.kind[i] = JOINER if i == 0x200D else INVISIBLE
            elif category == "Zs" and i != 0x20:
                self.kind[i] = SPACE
            elif category[0] == "M":
                order = unicodedata.combining(c)
                self.order[i] = order
                if order:
                    self.kind[i] = MARK
            elif category[0] == "L":
                self.script[i] = LATIN if unicodedata.name(c, "").startswith("LATIN") or i < 0x80 else OTHER
            tag = unicodedata.decomposition(c).partition(" ")[0]
            if any(a <= i <= b for a, b in _STYLED_RANGES) or (tag in ("<wide>", "<narrow>") and not 0xFF61 <= i <= 0xFFDC):
                plain = unicodedata.normalize("NFKC", c)
                if plain != c:
                    self.kind[i] = STYLED
                    styled[i] = list(map(ord, plain))
            elif tag and tag[0] != "<" and (parts := [int(x, 16) for x in unicodedata.decomposition(c).split()]) and len(parts) == 2 and unicodedata.normalize("NFC", c) == c:
                marks[parts[0], parts[1]] = i
        for i in (*_INVISIBLE, 0xFEFF):
            self.kind[i] = INVISIBLE
        self.kind[0x600:0x606] = self.kind[0x6DD] = self.kind[0x70F] = PLAIN  # signs that show
        for a, b in LOOKALIKES.items():
            self.kind[ord(a)] = FOREIGN
            self.script[ord(a)] = LOOKALIKE
            self.twin[ord(a)] = ord(b)
        self.special = self.kind != PLAIN
        keys = sorted(styled)
        self.length = np.ones(LIMIT, np.int32)
        self.length[keys] = [len(styled[k]) for k in keys]
        self.start = np.zeros(LIMIT, np.int32)
        self.start[keys] = np.cumsum([0, *(len(styled[k]) for k in keys)])[:-1]
        self.plain = np.array([x for k in keys for x in styled[k]], np.uint32)
        pairs = sorted((a * LIMIT + b, c) for (a, b), c in marks.items())
        self.pairs = np.array([p for p, _ in pairs], np.int64)
        self.composed = np.array([c for _, c in pairs], np.uint32)


tables = cache(Tables)


def _runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flag, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


class _Text:
    """Code points of many rows, which row each belongs to, and which rows have been changed."""

    def __init__(self, points: np.ndarray, rows: np.ndarray, n_rows: int):
        self.points, self.rows, self.changed = points.copy(), rows, np.zeros(n_rows, bool)

    def keep(self, flag: np.ndarray) -> None:
        self.points, self.rows = self.points[flag], self.rows[flag]

    def set(self, where: np.ndarray, values: np.ndarray) -> None:
        self.points[where] = values
        self.changed[self.rows[where]] = True


def _expand(t: _Text, tab: Tables) -> None:
    styled = tab.kind[t.points] == STYLED
    if not styled.any():
        return
    t.changed[t.rows[styled]] = True
    length = tab.length[t.points]
    begins = np.cumsum(length) - length
    source = np.repeat(np.arange(len(t.points)), length)
    offset = np.arange(len(source)) - begins[source]
    old = t.points[source]
    t.points = np.where(styled[source], tab.plain[np.where(styled[source], tab.start[old] + offset, 0)], old).astype(np.uint32)
    t.rows = t.rows[source]


def _drop_invisible(t: _Text, tab: Tables) -> None:
    kind = tab.kind[t.points]
    gone = kind == INVISIBLE
    joiner = np.flatnonzero(kind == JOINER)
    if len(joiner):
        # A joiner or selector inside an emoji sequence is part of the emoji.
        shown = tab.emoji | (np.arange(LIMIT) == 0xFE0F)
        before = np.where(joiner > 0, t.points[joiner - 1], 0)
        after = np.where(joiner + 1 < len(t.points), t.points[np.minimum(joiner + 1, len(t.points) - 1)], 0)
        gone[joiner] = ~(shown[before] & tab.emoji[after])
    if gone.any():
        t.changed[t.rows[gone]] = True
        t.keep(~gone)


def _compose(t: _Text, tab: Tables) -> None:
    order = tab.order[t.points]
    if not order.any():
        return
    # Canonical order inside each run of marks; rows never share a run, since a row's first mark follows no letter of it.
    while True:
        same = t.rows[1:] == t.rows[:-1]
        swap = np.flatnonzero((order[1:] > 0) & (order[:-1] > order[1:]) & same)
        if not len(swap):
            break
        swap = swap[np.concatenate(([True], np.diff(swap) > 1))]
        for a in (t.points, order):
            a[swap], a[swap + 1] = a[swap + 1].copy(), a[swap].copy()
        t.changed[t.rows[swap]] = True
    while True:
        order = tab.order[t.points]
        marks = np.flatnonzero(order > 0)
        if not len(marks):
            return
        # The starter of each mark, and whether an equal or higher class stands between.
        starter = np.maximum.accumulate(np.where(order == 0, np.arange(len(order)), -1))[marks]
        inside = (starter >= 0) & (t.rows[np.maximum(starter, 0)] == t.rows[marks])
        blocked = (marks - 1 > starter) & (order[marks - 1] >= order[marks])
        key = t.points[np.maximum(starter, 0)].astype(np.int64) * LIMIT + t.points[marks]
        at = np.minimum(np.searchsorted(tab.pairs, key), len(tab.pairs) - 1)
        fits = inside & ~blocked & (tab.pairs[at] == key)
        if not fits.any():
            return
        # One mark for each starter and round.
        first = np.flatnonzero(fits)
        first = first[np.unique(starter[first], return_index=True)[1]]
        t.set(starter[first], tab.composed[at[first]])
        left = np.ones(len(t.points), bool)
        left[marks[first]] = False
        t.keep(left)


def _letters(t: _Text, tab: Tables) -> None:
    script = tab.script[t.points]
    if not (script == LOOKALIKE).any():
        return
    same_row = np.concatenate(([False], t.rows[1:] == t.rows[:-1]))
    letter = script != NOT_A_LETTER
    begin = letter & ~(np.concatenate(([False], letter[:-1])) & same_row)
    word = np.cumsum(begin) - 1
    word[~letter] = -1
    n = int(begin.sum())
    at = word[letter]
    count = lambda s: np.bincount(at[script[letter] == s], minlength=n)
    latin, alike, other = count(LATIN), count(LOOKALIKE), count(OTHER)
    row_of = t.rows[begin]
    symbol = np.bincount(at[np.isin(t.points[letter], np.array(list(map(ord, SYMBOLS)), np.uint32))], minlength=n) > 0
    greek = np.bincount(at[(t.points[letter] >= 0x370) & (t.points[letter] < 0x400)], minlength=n) > 0
    plain_twin = np.isin(t.points[letter], np.array([ord(c) for c in LATIN_TWINS], np.uint32))
    twin_only = (np.bincount(at[plain_twin], minlength=n) == alike) & (alike > 0)
    # Mixed words: of Latin letters with look-alikes. Some Greek letters beside one or two Latin ones are symbols.
    mixed = (alike > 0) & (latin > 0) & (other == 0) & ~(symbol & (latin + alike < 3))
    # Words of look-alikes only: another script's own words stand beside such words.
    latin_row = np.zeros(len(t.changed), bool)
    latin_row[row_of[latin > 1]] = True
    near = _beside(genuine_word=(other > 0) & (latin == 0), row_of=row_of)
    whole = (alike > 0) & (latin == 0) & (other == 0) & ~near & latin_row[row_of] & ~(greek & (alike < 2)) & ~(symbol & (alike < 3)) & ~twin_only
    turn = np.zeros(len(t.points), bool)
    turn[letter] = (mixed | whole)[at] & (script[letter] == LOOKALIKE)
    if turn.any():
        t.set(turn, tab.twin[t.points[turn]])


def _beside(genuine_word: np.ndarray, row_of: np.ndarray) -> np.ndarray:
    """Words next to a word that is genuinely of another script, in the same row."""
    out = np.zeros(len(genuine_word), bool)
    same = row_of[1:] == row_of[:-1]
    out[1:] |= genuine_word[:-1] & same
    out[:-1] |= genuine_word[1:] & same
    return out


def consistent(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(texts in the consistent form, which rows were not in it). Nulls come back as empty."""
    tab = tables()
    points, bounds = code_points(column)
    rows = np.repeat(np.arange(len(column)), np.diff(bounds))
    suspect = np.zeros(len(column), bool)
    suspect[rows[tab.special[points]]] = True
    if not suspect.any():
        return from_code_points(points, bounds), suspect
    of_suspect = suspect[rows]
    t = _Text(points[of_suspect], rows[of_suspect], len(column))
    _expand(t, tab)
    _drop_invisible(t, tab)
    spaces = tab.kind[t.points] == SPACE
    if spaces.any():
        t.set(spaces, np.uint32(0x20))
    # Letters before marks, so that marks find the letter they belong to; and again for twins that
    # only a composed word shows.
    _compose(t, tab)
    _letters(t, tab)
    _compose(t, tab)
    own = np.bincount(t.rows, minlength=len(column))
    sizes = np.where(suspect, own, np.diff(bounds))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(ends[-1], np.uint32)
    where = np.repeat(suspect, sizes)
    out[where] = t.points
    out[~where] = points[~of_suspect]
    return from_code_points(out, ends), t.changed


def consistent_texts(column: pa.Array) -> list[str]:
    """The texts in the consistent form. Only those with a character that may not belong to it are worked on."""
    texts = column.fill_null("").to_pylist()
    search = _suspects().search
    if at := [i for i, text in enumerate(texts) if search(text)]:
        for i, text in zip(at, consistent(column.take(pa.array(at, pa.int32())))[0].to_pylist()):
            texts[i] = text
    return texts


@cache
def _suspects() -> re.Pattern:
    """Every special character; all beyond the basic plane count as such, so that one look-up per character is enough."""
    points = np.flatnonzero(tables().special[:0x10000])
    return re.compile("[" + "".join(rf"\u{x:04x}" for x in points) + "\U00010000-\U0010ffff]")


def normalised(df: DataFrame, keys: list[str], text_col: str, changed_only: bool = False) -> DataFrame:
    """keys, text in the consistent form, changed.

    Null texts stay null and count as unchanged, as blank ones do; empty texts stay empty. Repeated rows stay
    repeated; other columns are ignored, and long texts are done whole. No shuffle.
    """
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField("text", T.StringType()), T.StructField("changed", T.BooleanType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            column = batch.column(len(keys))
            texts, changed = consistent(column)
            if changed.any():
                # A blank text is in no form.
                at = np.flatnonzero(changed)
                changed[at] = pa.compute.not_equal(pa.compute.utf8_trim_whitespace(texts.take(pa.array(at))), "").to_numpy(zero_copy_only=False)
            if column.null_count:
                nulls = column.is_null()
                texts = pa.compute.if_else(nulls, pa.scalar(None, pa.string()), texts)
            if changed_only:
                at = pa.array(np.flatnonzero(changed))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(len(keys))), texts.take(at), pa.array(np.ones(len(at), bool))], names=schema.names)
            else:
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), texts, pa.array(changed)], names=schema.names)

    return spread(df.select(*keys, text_col)).mapInArrow(run, schema)


def _rows(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    segments, nodes = table(spark, sf_dir, "segments"), table(spark, sf_dir, "knowledge_base_qwen")
    return [
        segments.select(F.lit("segments").alias("tbl"), F.col("media_id").alias("rec_id"), F.col("seg_idx").cast("int").alias("pos"), "text"),
        nodes.select(F.lit("knowledge_base_qwen").alias("tbl"), F.col("id_").alias("rec_id"), F.lit(-1).alias("pos"), "text"),
    ]


KEYS = ["tbl", "rec_id", "pos"]


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (normalised(x, KEYS, "text", changed_only=True).select(*KEYS) for x in _rows(spark, sf_dir))
    return a.unionByName(b).distinct()


def p7_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's text in the consistent form, and whether it had been in it."""
    a, b = (normalised(x, KEYS, "text") for x in _rows(spark, sf_dir))
    return a.unionByName(b).dropDuplicates(KEYS)


QUERIES = {"p7_found": p7_found, "p7_forms": p7_forms}
