"""String, token and array functions on columns. All of them stay inside the JVM.

Null gives null, unless said otherwise. Functions that need a value several times take it through
let(), so that Catalyst evaluates it once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicon as L

#: White space as Unicode has it, with the four separators that string splitting also takes as space.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same characters for trim(), which takes a set.
WS_SET = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with the column computed once, whatever reads it later.

    Catalyst merges projections and pushes filters through them, which would repeat a costly
    expression in every place it is read. It does neither across a generator of one row.
    """
    return df.select(*(c for c in df.columns if c != name), F.explode(F.array(value)).alias(name))


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def literals(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def normalize_spaces(x: Column) -> Column:
    return F.btrim(F.regexp_replace(x, f"{WS}+", " "), F.lit(" "))


def normalize_punctuation(x: Column) -> Column:
    """No space before , . ; : ! ?; runs of . ? ! as one; exactly one space after a dot (3.14 becomes 3. 14)."""
    x = F.regexp_replace(x, f"{WS}+([,.;:!?])", "$1")
    x = F.regexp_replace(x, r"([.?!])\1+", "$1")
    return normalize_spaces(F.regexp_replace(x, rf"{WS}*\.{WS}*", ". "))


@cache
def accent_map() -> tuple[str, str]:
    """(from, to) for translate(): letters to their base, marks to nothing; đ has no base and stays."""
    bases, marks, to = [], [], []
    for i in (*range(0x00A0, 0x3100), *range(0xA640, 0xAC00), *range(0xF900, 0xFB50), *range(0xFE20, 0xFE30)):
        c = chr(i)
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if len(plain) == 1 and plain != c:
            bases.append(c)
            to.append(plain)
    return "".join(bases + marks), "".join(to)


def strip_accents(x: Column) -> Column:
    a, b = accent_map()
    return F.translate(x, a, b)


def normalize_terms(x: Column) -> Column:
    """Whole-word corrections in the order of the table; texts without any of them are passed over."""
    fixed = x
    for wrong, right in L.TERMS:
        fixed = F.regexp_replace(fixed, rf"(?iU)\b{wrong}\b", right)
    return F.when(x.rlike("(?i)" + "|".join(w for w, _ in L.TERMS)), fixed).otherwise(x)


def match_form(x: Column) -> Column:
    """Lower case, terms, no accents, only a-z, 0-9 and single spaces. Not idempotent; apply once."""
    return normalize_spaces(F.regexp_replace(strip_accents(normalize_terms(F.lower(x))), r"[^a-z0-9\s]", " "))


def words(x: Column) -> Column:
    """What lies between white space, like splitting a string without a separator."""
    return F.filter(F.split(x, f"{WS}+"), lambda w: w != "")


def word_count(x: Column) -> Column:
    return F.size(words(x))


def tokens(norm: Column) -> Column:
    """All tokens of a text in match form."""
    return F.filter(F.split(norm, " "), lambda w: w != "")


def keyword_tokens(norm: Column) -> Column:
    """Tokens of two letters or more that aren't stop words or numbers."""
    return F.filter(tokens(norm), lambda t: (F.length(t) >= 2) & ~t.isin(*L.STOPWORDS) & ~t.rlike("^[0-9]+$"))


def token_set(norm: Column) -> Column:
    return F.array_distinct(tokens(norm))


def unique_ratio(norm: Column) -> Column:
    return let(tokens(norm), lambda t: F.when(F.size(t) > 0, F.size(F.array_distinct(t)) / F.size(t)).otherwise(0.0))


def repetition_ratio(norm: Column) -> Column:
    return let(tokens(norm), lambda t: F.when(F.size(t) >= 12, 1 - F.size(F.array_distinct(t)) / F.size(t)).otherwise(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Of sets; 0 where either is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def containment(a: Column, b: Column) -> Column:
    """Share of the set a that is in b; 0 where either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def char_ngrams(norm: Column, n: int = 4) -> Column:
    """Distinct n-grams of the text without spaces; a shorter text is its own."""

    def grams(s: Column) -> Column:
        every = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - (n - 1)), lambda i: s.substr(i, F.lit(n))))
        return F.when(F.length(s) == 0, F.array().cast("array<string>")).when(F.length(s) < n, F.array(s)).otherwise(every)

    return let(F.replace(norm, F.lit(" "), F.lit("")), grams)


def bigrams(t: Column) -> Column:
    return F.when(F.size(t) < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(t) - 1), lambda i: F.concat_ws(" ", F.element_at(t, i), F.element_at(t, i + 1))))


def sentences(x: Column) -> Column:
    """Split after . ! ? and a space; an unpunctuated text of more than 80 words at , ; : instead."""

    def split(s: Column) -> Column:
        first = F.filter(F.split(s, r"(?<=[.!?])" + f"{WS}+"), lambda p: p != "")
        by_comma = F.filter(F.transform(F.split(s, rf"[,;:]{WS}+"), lambda p: F.btrim(p, F.lit(WS_SET))), lambda p: p != "")
        return F.when(s == "", F.array().cast("array<string>")).when((F.size(first) <= 1) & (word_count(s) > 80), by_comma).otherwise(first)

    return let(normalize_spaces(x), split)


def collapse_repeats(x: Column) -> Column:
    """Runs of six or more equal characters as one, and at most two equal words in a row."""

    def keep(w: Column) -> Column:
        same = lambda i, j: F.lower(F.element_at(w, i)) == F.lower(F.element_at(w, j))
        return F.array_join(F.filter(w, lambda _, i: ~F.when(i >= 2, same(i + 1, i) & same(i, i - 1)).otherwise(False)), " ")

    return let(words(F.regexp_replace(x, r"(.)\1{5,}", "$1")), keep)


def timestamp(seconds: Column, vtt: bool = False) -> Column:
    """HH:MM:SS and milliseconds, cut (not rounded) from the binary number."""
    whole = F.floor(seconds)
    return F.format_string(f"%02d:%02d:%02d{'.' if vtt else ','}%03d", F.floor(seconds / 3600), F.floor((seconds % 3600) / 60), F.floor(seconds % 60), ((seconds - whole) * 1000).cast("int"))


def category(x: Column) -> Column:
    low = F.lower(F.btrim(F.coalesce(x, F.lit("")), F.lit(WS_SET)))
    return F.when(F.btrim(x, F.lit(WS_SET)).isin(*L.ALLOWED_CATEGORIES), F.btrim(x, F.lit(WS_SET))).when(low.rlike("|".join(L.EXAMPLE_WORDS)), "Example").when(low.rlike("|".join(L.PROCESS_WORDS)), "Process").otherwise("Theory")


def contains_code(x: Column) -> Column:
    return x.rlike(r"(?U)\b(def|class|return|for\s+\w+\s+in|if\s+\w+|import)\b") | (x.rlike(r"[{}<>]=?|==|!=") & x.rlike(r"(?U)\b[A-Za-z_]\w*\s*\("))


def topic(x: Column, text: Column) -> Column:
    """The cleaned topic, or the first 120 characters of the first sentence."""
    return F.coalesce(F.nullif(normalize_terms(normalize_spaces(F.coalesce(x, F.lit("")))), F.lit("")), F.substring(F.element_at(sentences(text), 1), 1, 120))


def safe_file_name(x: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(F.btrim(F.regexp_replace(x, r'[\\/:*?"<>|]', "_"), F.lit(WS_SET)), f"{WS}+", "_"), F.lit("")), fallback)


def nfc_lower(x: Column) -> Column:
    """Lower case with composed accents. Composition has no built-in, so this one goes through Arrow."""

    @F.pandas_udf("string")
    def compose(s):
        return s.str.lower().str.normalize("NFC")

    return compose(x)
