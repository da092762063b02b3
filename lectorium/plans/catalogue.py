"""The queries of the library: each takes a session and a folder of tables."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicon as L
from ..functions import json_text, prompts, text, urls
from ..operators import chunking, documents, jobs, nodes, quality, segments
from ..operators.storage import kept
from ..sources import tables
from . import pipelines, sql

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers once per application.

    A worker's path doesn't follow the driver's sys.path.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(), "lectorium.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "lectorium")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(statement: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if statement:
            SQL[f.__name__] = statement
        return f

    return register


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return tables.spread(tables.read(spark, d, "documents")).where(F.col("text").isNotNull())


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return segments.delivered_once(tables.read(spark, d, "segments"))


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes once each, with the fields of their metadata as columns."""
    once = tables.read(spark, d, "nodes").dropDuplicates(["id"])
    return once.select("id", "text", *(F.col(f"metadata.{c}").alias(c) for c in ("subject", "topic", "category", "keywords", "has_code", "file_name", "question_templates", "source_quote")))


def _kb(spark: SparkSession, d: str) -> DataFrame:
    once = tables.read(spark, d, "knowledge_base_qwen").dropDuplicates(["id_"])
    return once.select("id_", "text", *(F.col(f"metadata.{c}").alias(c) for c in ("subject", "topic", "category", "keywords", "has_code", "file_name", "page")))


_DOC = "FROM documents WHERE text IS NOT NULL"
_NODE = "n AS (SELECT DISTINCT id, text, metadata FROM nodes)"
_KB = "k AS (SELECT DISTINCT id_, text, metadata FROM knowledge_base_qwen)"

# ---- text


@query(f"SELECT doc_id, {sql.spaces('text')} AS spaced, {sql.match('text')} AS norm {_DOC}")
def norm_text(spark, d):
    return _documents(spark, d).select("doc_id", text.normalize_spaces(F.col("text")).alias("spaced"), text.match_form(F.col("text")).alias("norm"))


@query(f"SELECT doc_id, {sql.punctuation('text')} AS clean {_DOC}")
def punct_clean(spark, d):
    return _documents(spark, d).select("doc_id", text.normalize_punctuation(F.col("text")).alias("clean"))


@query(f"SELECT doc_id, {sql.terms('text')} AS fixed {_DOC}")
def term_fix(spark, d):
    return _documents(spark, d).select("doc_id", text.normalize_terms(F.col("text")).alias("fixed"))


@query(f"WITH s AS (SELECT doc_id, {sql.sentences('text')} AS p {_DOC}) SELECT doc_id, unnest(p) AS sentence, generate_subscripts(p, 1) - 1 AS sentence_idx FROM s")
def sentence_split(spark, d):
    return chunking.exploded(_documents(spark, d), ["doc_id"], text.sentences(F.col("text")), "sentence_idx", "sentence")


@query(f"""WITH s AS (SELECT doc_id, {sql.sentences('text')} AS p {_DOC}),
e AS (SELECT doc_id, unnest(p) AS sentence, generate_subscripts(p, 1) AS i FROM s), k AS (SELECT *, {sql.match('sentence')} AS key FROM e),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, key ORDER BY i) AS r FROM k WHERE key <> '')
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS sentence_idx, sentence FROM f WHERE r = 1""")
def sentence_distinct(spark, d):
    return chunking.exploded(_documents(spark, d), ["doc_id"], chunking.distinct_sentences(F.col("text")), "sentence_idx", "sentence")


@query(f"""WITH n AS (SELECT doc_id, {sql.tokens(sql.match('text'))} AS t {_DOC})
SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_unique, round(CASE WHEN len(t) > 0 THEN len(list_distinct(t))::DOUBLE / len(t) ELSE 0 END, 9) AS unique_ratio,
round(CASE WHEN len(t) >= 12 THEN 1 - len(list_distinct(t))::DOUBLE / len(t) ELSE 0 END, 9) AS repetition FROM n""")
def token_stats(spark, d):
    docs = _documents(spark, d).select("doc_id", text.match_form(F.col("text")).alias("norm"))
    t = text.tokens(F.col("norm"))
    return docs.select("doc_id", F.size(t).alias("n_tokens"), F.size(F.array_distinct(t)).alias("n_unique"), F.round(text.unique_ratio(F.col("norm")), 9).alias("unique_ratio"), F.round(text.repetition_ratio(F.col("norm")), 9).alias("repetition"))


@query(f"""WITH n AS (SELECT item_id, replace({sql.match('text')}, ' ', '') AS s FROM eval_items WHERE text IS NOT NULL)
SELECT DISTINCT item_id, unnest(CASE WHEN s = '' THEN [] WHEN length(s) < 4 THEN [s] ELSE list_transform(generate_series(1, length(s) - 3), lambda i: substring(s, i, 4)) END) AS gram FROM n""")
def char_ngrams(spark, d):
    items = tables.read(spark, d, "eval_items").where(F.col("text").isNotNull())
    return items.select("item_id", F.explode(text.char_ngrams(text.match_form(F.col("text")))).alias("gram")).distinct()


@query(f"""WITH n AS (SELECT doc_id, list_filter({sql.tokens(sql.match('text'))}, lambda t: length(t) >= 2 AND t NOT IN {sql.in_list(L.STOPWORDS)} AND NOT regexp_matches(t, '^[0-9]+$')) AS t {_DOC}),
b AS (SELECT doc_id, list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1]) AS p FROM n WHERE len(t) > 1),
e AS (SELECT doc_id, unnest(p) AS bigram, generate_subscripts(p, 1) AS i FROM b), c AS (SELECT doc_id, bigram, count(*) AS n, min(i) AS first FROM e GROUP BY doc_id, bigram)
SELECT doc_id, bigram, n, r FROM (SELECT doc_id, bigram, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS r FROM c) WHERE r <= 5""")
def bigram_top(spark, d):
    """The five most frequent pairs of words of each document; ties by first place."""
    pairs = _documents(spark, d).select("doc_id", F.posexplode(text.let(text.keyword_tokens(text.match_form(F.col("text"))), text.bigrams)).alias("at", "bigram"))
    ranked = F.row_number().over(tables.window(["doc_id"], [F.col("n").desc(), F.col("first")]))
    return pairs.groupBy("doc_id", "bigram").agg(F.count("*").alias("n"), F.min("at").alias("first")).withColumn("r", ranked).where("r <= 5").drop("first")


# ---- segments


@query(f"WITH {sql.SEGMENTS}, {sql.COLLAPSED} SELECT media_id, seg_idx, clean FROM fixed")
def repeat_clean(spark, d):
    return _segments(spark, d).select("media_id", "seg_idx", text.collapse_repeats(F.coalesce("text", F.lit(""))).alias("clean"))


@query(f"WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED} SELECT media_id, seg_idx, verdict FROM judged")
def segment_filter(spark, d):
    return segments.verdict(_segments(spark, d)).select("media_id", "seg_idx", "verdict")


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}
SELECT media_id, count(*) AS total_segments, count(*) FILTER (verdict = 'keep') AS valid_segments, count(*) FILTER (verdict IN ('duration', 'short_text', 'hallucination')) AS filtered_hallucinations FROM judged GROUP BY media_id""")
def segment_stats(spark, d):
    return segments.segment_stats(_segments(spark, d))


@query(f"WITH {sql.SEGMENTS} SELECT media_id, seg_idx, {sql.timestamp('start_sec', '.')} AS vtt_start, {sql.timestamp('start_sec', ',')} AS txt_start FROM seg")
def timestamp_format(spark, d):
    return _segments(spark, d).select("media_id", "seg_idx", text.timestamp(F.col("start_sec"), vtt=True).alias("vtt_start"), text.timestamp(F.col("start_sec")).alias("txt_start"))


_PARTS = f"""valid AS (SELECT media_id, seg_idx, start_sec, end_sec, clean AS text FROM judged WHERE verdict = 'keep'),
packed AS (SELECT *, CASE WHEN length(text) <= 70 THEN {{'done': [text], 'cur': ''}} ELSE list_reduce({sql.words('text')}, lambda a, w:
  CASE WHEN length(trim(a.cur || ' ' || w)) > 70 AND a.cur <> '' THEN {{'done': list_append(a.done, a.cur), 'cur': w}}
       WHEN length(trim(a.cur || ' ' || w)) >= 50 AND regexp_matches(trim(a.cur || ' ' || w), '[.!?;:,]$') THEN {{'done': list_append(a.done, trim(a.cur || ' ' || w)), 'cur': ''}}
       ELSE {{'done': a.done, 'cur': trim(a.cur || ' ' || w)}} END, {{'done': []::VARCHAR[], 'cur': ''}}) END AS acc FROM valid),
flat AS (SELECT * EXCLUDE (acc), CASE WHEN acc.cur <> '' THEN list_append(acc.done, acc.cur) ELSE acc.done END AS p FROM packed),
merged AS (SELECT *, CASE WHEN length(text) <= 70 THEN p ELSE list_reduce(p, lambda a, x:
  CASE WHEN len(a) = 0 THEN [x] WHEN length(x) < 50 AND length(a[-1] || ' ' || x) <= 90 THEN list_append(a[:len(a) - 1], a[-1] || ' ' || x) ELSE list_append(a, x) END, []::VARCHAR[]) END AS parts FROM flat),
each AS (SELECT *, len(parts) AS n, unnest(parts) AS cue_text, generate_subscripts(parts, 1) - 1 AS cue_idx FROM merged),
cues AS (SELECT media_id, seg_idx, cue_idx, CASE WHEN n = 1 THEN start_sec ELSE start_sec + cue_idx * greatest((end_sec - start_sec) / n, 1.0) END AS cue_start,
  CASE WHEN n = 1 THEN end_sec ELSE least(start_sec + (cue_idx + 1) * greatest((end_sec - start_sec) / n, 1.0), end_sec) END AS cue_end, cue_text FROM each WHERE trim(cue_text) <> '')"""


@query(f"WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}, {_PARTS} SELECT media_id, seg_idx, cue_idx, round(cue_start, 6) AS cue_start, round(cue_end, 6) AS cue_end, cue_text FROM cues")
def cue_split(spark, d):
    c = segments.cues(segments.valid_segments(_segments(spark, d)))
    return c.withColumn("cue_start", F.round("cue_start", 6)).withColumn("cue_end", F.round("cue_end", 6))


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}, {_PARTS}
SELECT media_id, seg_idx, cue_idx, {sql.timestamp('cue_start', '.')} || ' --> ' || {sql.timestamp('cue_end', '.')} || chr(10) || cue_text || chr(10) || chr(10) AS cue FROM cues""")
def vtt_cues(spark, d):
    return segments.vtt_cues(segments.cues(segments.valid_segments(_segments(spark, d))))


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}
SELECT media_id, CAST(floor(seg_idx / {segments.BLOCK}) AS INT) AS block, string_agg(clean, ' ' ORDER BY seg_idx) AS body FROM judged WHERE verdict = 'keep' GROUP BY ALL""")
def txt_blocks(spark, d):
    return segments.txt_blocks(segments.valid_segments(_segments(spark, d)))


_CUE = f"{sql.timestamp('cue_start', '.')} || ' --> ' || {sql.timestamp('cue_end', '.')} || chr(10) || cue_text || chr(10) || chr(10)"


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}, {_PARTS}
SELECT media_id, CAST(floor(seg_idx / {segments.BLOCK}) AS INT) AS block, string_agg({_CUE}, '' ORDER BY seg_idx, cue_idx) AS body FROM cues GROUP BY ALL""")
def vtt_blocks(spark, d):
    return segments.vtt_blocks(segments.cues(segments.valid_segments(_segments(spark, d))))


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}, valid AS (SELECT media_id, seg_idx, start_sec, end_sec, trim(clean, {sql.text(text.WS_SET)}) AS text FROM judged WHERE verdict = 'keep'),
w AS (SELECT *, CASE WHEN length(text) <= 80 THEN {{'done': [text], 'cur': ''}} ELSE list_reduce({sql.words('text')}, lambda a, x:
  CASE WHEN length(a.cur) + 1 + length(x) <= 80 THEN {{'done': a.done, 'cur': CASE WHEN a.cur = '' THEN x ELSE a.cur || ' ' || x END}} ELSE {{'done': list_append(a.done, a.cur), 'cur': x}} END, {{'done': []::VARCHAR[], 'cur': ''}}) END AS acc FROM valid),
p AS (SELECT *, CASE WHEN acc.cur <> '' THEN list_append(acc.done, acc.cur) ELSE acc.done END AS parts FROM w),
e AS (SELECT *, len(parts) AS n, unnest(parts) AS cue_text, generate_subscripts(parts, 1) - 1 AS cue_idx FROM p)
SELECT media_id, seg_idx, cue_idx, round(CASE WHEN n = 1 THEN start_sec ELSE start_sec + cue_idx * ((end_sec - start_sec) / n) END, 6) AS cue_start,
round(CASE WHEN n = 1 THEN end_sec ELSE start_sec + (cue_idx + 1) * ((end_sec - start_sec) / n) END, 6) AS cue_end, cue_text FROM e WHERE trim(cue_text) <> ''""")
def cue_split_first(spark, d):
    """Cues of the first version: wrapped at 80 characters."""
    c = segments.cues(segments.valid_segments(_segments(spark, d)), first_version=True)
    return c.withColumn("cue_start", F.round("cue_start", 6)).withColumn("cue_end", F.round("cue_end", 6))


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED},
o AS (SELECT media_id, clean, row_number() OVER (PARTITION BY media_id ORDER BY seg_idx) - 1 AS i FROM judged WHERE verdict = 'keep'),
b AS (SELECT DISTINCT media_id, CAST(floor(i / 20) AS INT) AS batch FROM o)
SELECT b.media_id, b.batch, coalesce(string_agg(o.clean, ' ' ORDER BY o.i), '') AS context FROM b LEFT JOIN o ON o.media_id = b.media_id AND o.i >= b.batch * 20 - 5 AND o.i < b.batch * 20 GROUP BY ALL""")
def context_window(spark, d):
    return segments.batch_contexts(segments.valid_segments(_segments(spark, d)))


_REPLY = f"""o AS (SELECT media_id, seg_idx, clean, row_number() OVER (PARTITION BY media_id ORDER BY seg_idx) - 1 AS i FROM judged WHERE verdict = 'keep'),
rep AS (SELECT *, {sql.punctuation('clean')} AS refined FROM o)"""


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}, {_REPLY}
SELECT media_id, seg_idx, length(refined) BETWEEN 3 AND 300 AS is_refined, CASE WHEN length(refined) BETWEEN 3 AND 300 THEN
array_to_string(list_filter({sql.words('refined')}, lambda x, k: NOT (k > 2 AND lower({sql.words('refined')}[k]) = lower({sql.words('refined')}[k - 1]) AND lower({sql.words('refined')}[k - 1]) = lower({sql.words('refined')}[k - 2]))), ' ')
ELSE clean END AS text FROM rep""")
def refine_join(spark, d):
    """Segments with replies of the stand-in refiner, which only tidies punctuation."""
    valid = kept(segments.valid_segments(_segments(spark, d)))
    replies = pipelines.punctuation_refiner(segments.with_ordinal(valid))
    return segments.apply_refinements(valid, replies).select("media_id", "seg_idx", "is_refined", "text")


@query(f"""WITH {_KB} SELECT id_, CASE WHEN metadata.subject IS NULL OR metadata.subject = '' THEN 'Đây là bài giảng học thuật tiếng Việt. Nội dung mang tính học thuật, chuyên ngành.'
ELSE 'Đây là bài giảng học thuật tiếng Việt môn ' || metadata.subject || '. Nội dung mang tính học thuật, chuyên ngành.' END AS prompt FROM k""")
def speech_prompts(spark, d):
    return _kb(spark, d).select("id_", urls.speech_prompt(F.lit("vi"), F.col("subject")).alias("prompt"))


@query(f"""WITH {_KB} SELECT id_, CASE WHEN regexp_full_match(coalesce(text, ''), '{sql.WS}*') THEN '' ELSE 'Đây là transcript ASR tiếng Việt ' || CASE WHEN coalesce(metadata.subject, '') = '' THEN 'học thuật' ELSE 'môn ' || metadata.subject END
|| ' bị lỗi chính tả và thuật ngữ. Hãy sửa lại các thuật ngữ chuyên ngành cho đúng:' || chr(10) || chr(10) || substring(text, 1, 300) END AS question FROM k""")
def retrieval_questions(spark, d):
    return _kb(spark, d).select("id_", prompts.retrieval_question(F.col("text"), F.col("subject")).alias("question"))


# ---- chunks and nodes


def _fold(e: str, most: int, least: int | None, overlap: int) -> str:
    """Greedy packing of the sentences of a column as a list_reduce."""
    counted = f"list_transform({sql.sentences(e)}, lambda s: {{'s': s, 'n': len({sql.words('s')})}})"
    full = f"len(a.cur) > 0 AND a.n + p.n > {most}" + (f" AND a.n >= {least}" if least is not None else "")
    joined = "array_to_string(list_transform(a.cur, lambda q: q.s), ' ')"
    empty = "{'done': []::VARCHAR[], 'cur': []::STRUCT(s VARCHAR, n BIGINT)[], 'n': 0::BIGINT}"
    tail = f"list_append(list_filter(a.cur, lambda q, k: k = len(a.cur) OR coalesce(list_sum(list_transform(a.cur[k + 1:], lambda z: z.n)), 0) < {overlap}), p)" if overlap else "[p]"
    cut = f"WHEN p.n > {most} THEN {{'done': list_concat(CASE WHEN len(a.cur) > 0 THEN list_append(a.done, {joined}) ELSE a.done END, list_transform(generate_series(0, CAST(ceil(p.n / {most}) AS BIGINT) - 1), lambda i: array_to_string({sql.words('p.s')}[i * {most} + 1:(i + 1) * {most}], ' '))), 'cur': []::STRUCT(s VARCHAR, n BIGINT)[], 'n': 0::BIGINT}}" if overlap else ""
    step = f"CASE {cut} WHEN {full} THEN {{'done': list_append(a.done, {joined}), 'cur': {tail}, 'n': list_sum(list_transform({tail}, lambda z: z.n))::BIGINT}} ELSE {{'done': a.done, 'cur': list_append(a.cur, p), 'n': (a.n + p.n)::BIGINT}} END"
    return f"list_reduce({counted}, lambda a, p: {step}, {empty})"


def _folded(table: str, key: str, most: int, least: int | None, overlap: int, index: str, name: str, whole: bool) -> str:
    parts = "list_filter(CASE WHEN len(acc.cur) > 0 THEN list_append(acc.done, array_to_string(list_transform(acc.cur, lambda q: q.s), ' ')) ELSE acc.done END, lambda c: c <> '')"
    short = f"CASE WHEN len({sql.words('text')}) <= {most} THEN [text] ELSE {parts} END" if whole else parts
    return f"""WITH src AS ({table}), f AS (SELECT {key}, text, {_fold('text', most, least, overlap)} AS acc FROM src),
g AS (SELECT {key}, {short} AS p FROM f) SELECT {key}, unnest(p) AS {name}, generate_subscripts(p, 1) - 1 AS {index} FROM g"""


@query(_folded(f"SELECT doc_id, text {_DOC}", "doc_id", 140, 90, 7, "chunk_idx", "chunk_text", False))
def chunk_transcript(spark, d):
    """Overlapping chunks, at a tenth of the usual sizes so that these texts have several."""
    return chunking.exploded(_documents(spark, d), ["doc_id"], chunking.transcript_chunks(F.col("text"), 90, 140, 7), "chunk_idx", "chunk_text")


@query(_folded(f"SELECT doc_id, text {_DOC}", "doc_id", 1400, 900, 70, "chunk_idx", "chunk_text", False))
def chunk_transcript_full(spark, d):
    """Overlapping chunks at the usual sizes."""
    return chunking.exploded(_documents(spark, d), ["doc_id"], chunking.transcript_chunks(F.col("text")), "chunk_idx", "chunk_text")


@query(_folded(f"SELECT doc_id, text {_DOC}", "doc_id", 120, None, 0, "part_idx", "part", True))
def oversize_split(spark, d):
    return chunking.exploded(_documents(spark, d), ["doc_id"], chunking.oversized_parts(F.col("text"), 120), "part_idx", "part")


def _ends(e: str, tails: list[str]) -> str:
    return "(" + " OR ".join(f"ends_with({e}, {sql.text(t)})" for t in tails) + ")"


_REASON = f"""CASE WHEN norm = '' THEN 'empty' WHEN len(t) <= 10 THEN 'short' WHEN len(t) <= 18 AND NOT regexp_matches(text, '[.!?]') THEN 'unpunctuated'
WHEN len(t) >= 12 AND 1 - len(list_distinct(t))::DOUBLE / len(t) > 0.42 THEN 'repetitive' WHEN {_ends('norm', L.OPEN_ENDS)} THEN 'incomplete'
WHEN (len(t) < 30 AND ({' OR '.join(f'starts_with(norm, {sql.text(h)})' for h in L.ORPHAN_STARTS)})) OR {_ends('norm', L.ORPHAN_ENDS)} THEN 'orphan'
WHEN regexp_matches(norm, {sql.any_pattern(L.META_TALK)}) THEN 'meta' WHEN len(t) < 20 AND regexp_matches(norm, {sql.any_pattern(L.FILLERS)}) THEN 'filler' ELSE 'keep' END"""


@query(f"WITH {_NODE}, m AS (SELECT id, coalesce(text, '') AS text, {sql.match("coalesce(text, '')")} AS norm FROM n), t AS (SELECT *, {sql.tokens('norm')} AS t FROM m) SELECT id, {_REASON} AS reason FROM t")
def drop_reason(spark, d):
    return _nodes(spark, d).select("id", quality.drop_reason(F.coalesce("text", F.lit(""))).alias("reason"))


@query(f"""WITH {_NODE}, m AS (SELECT id, text, {sql.tokens(sql.match('text'))} AS t, {sql.tokens(sql.match("coalesce(metadata.source_quote, '')"))} AS s FROM n WHERE text IS NOT NULL)
SELECT id, coalesce(len({sql.words('text')}) BETWEEN 28 AND 500 AND len(list_distinct(t)) >= 0.30 * len(t) AND len(t) > 0 AND {sql.containment('list_distinct(t)', 'list_distinct(s)')} >= 0.52, false) AS passes,
round({sql.containment('list_distinct(t)', 'list_distinct(s)')}, 3) AS coverage FROM m""")
def quality_gate(spark, d):
    rows = _nodes(spark, d).where(F.col("text").isNotNull()).withColumn("source_quote", F.coalesce("source_quote", F.lit("")))
    return rows.select("id", quality.gate(F.col("text"), F.col("source_quote")).alias("passes"), F.round(quality.coverage(F.col("text"), F.col("source_quote")), 3).alias("coverage"))


@query(f"""WITH {_NODE} SELECT id, CASE WHEN trim(coalesce(metadata.category, '')) IN {sql.in_list(L.ALLOWED_CATEGORIES)} THEN trim(metadata.category)
WHEN regexp_matches(lower(coalesce(metadata.category, '')), {sql.text('|'.join(L.EXAMPLE_WORDS))}) THEN 'Example' WHEN regexp_matches(lower(coalesce(metadata.category, '')), {sql.text('|'.join(L.PROCESS_WORDS))}) THEN 'Process' ELSE 'Theory' END AS category FROM n""")
def category_norm(spark, d):
    return _nodes(spark, d).select("id", text.category(F.col("category")).alias("category"))


@query(f"""WITH {_KB} SELECT id_, regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}_])(def|class|return|for\\s+[\\p{{L}}\\p{{N}}_]+\\s+in|if\\s+[\\p{{L}}\\p{{N}}_]+|import)($|[^\\p{{L}}\\p{{N}}_])')
OR (regexp_matches(text, '[{{}}<>]=?|==|!=') AND regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}_])[A-Za-z_][\\p{{L}}\\p{{N}}_]*\\s*\\(')) AS has_code FROM k WHERE text IS NOT NULL""")
def code_flag(spark, d):
    return _kb(spark, d).where(F.col("text").isNotNull()).select("id_", text.contains_code(F.col("text")).alias("has_code"))


@query(f"""WITH {_NODE}, q AS (SELECT id, text, unnest(metadata.question_templates) AS q, generate_subscripts(metadata.question_templates, 1) AS i FROM n WHERE text IS NOT NULL),
f AS (SELECT id, text, i, {sql.spaces('q')} AS s FROM q WHERE q IS NOT NULL), g AS (SELECT id, text, i, CASE WHEN ends_with(s, '?') THEN s ELSE regexp_replace(s, '[.!]+$', '') || '?' END AS q FROM f),
h AS (SELECT *, {sql.match('q')} AS k, list_filter({sql.tokens(sql.match('text'))}, lambda w: w NOT IN {sql.in_list(L.STOPWORDS)}) AS t FROM g WHERE length(q) BETWEEN 10 AND 250),
r AS (SELECT *, row_number() OVER (PARTITION BY id, k ORDER BY i) AS first FROM h),
v AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i) AS place FROM r WHERE first = 1 AND list_has_any(list_filter({sql.tokens('k')}, lambda w: w NOT IN {sql.in_list(L.STOPWORDS)}), t))
SELECT id, place - 1 AS place, q AS question FROM v WHERE place <= 3""")
def questions_valid(spark, d):
    rows = _nodes(spark, d).where(F.col("text").isNotNull())
    return rows.select("id", F.posexplode(nodes.validate_questions(F.col("question_templates"), F.col("text"))).alias("place", "question"))


def _ranked(ts: str, by_first: bool) -> str:
    """Distinct terms by falling frequency; ties by first place, or by the alphabet."""
    at = f"list_position({ts}, x)" if by_first else "0"
    return f"list_transform(list_sort(list_transform(list_distinct({ts}), lambda x: {{'n': -len(list_filter({ts}, lambda y: y = x)), 'at': {at}, 't': x}})), lambda z: z.t)"


def _inferred(t: str, most: int) -> str:
    pairs = f"list_transform(generate_series(1, len({t}) - 1), lambda i: {t}[i] || ' ' || {t}[i + 1])"
    terms = f"list_concat({_ranked(pairs, True)}, {_ranked(f'list_filter({t}, lambda w: length(w) >= 3)', False)})"
    return f"list_reduce({terms}, lambda a, x: CASE WHEN len(a.p) < {most} AND NOT list_has_any(a.seen, string_split(x, ' ')) THEN {{'p': list_append(a.p, x), 'seen': list_concat(a.seen, string_split(x, ' '))}} ELSE a END, {{'p': []::VARCHAR[], 'seen': []::VARCHAR[]}}).p"


def _fit(k: str) -> str:
    """Whether a keyword is valid."""
    parts = sql.tokens(sql.match(k))
    own = f"list_filter({parts}, lambda w: w NOT IN {sql.in_list(L.STOPWORDS)})"
    syllable = f"(?:{L.SYLLABLE_STARTS})?(?:{L.SYLLABLE_CORES})(?:{L.SYLLABLE_ENDS})?"
    noise = f"(length(w) <= 1 OR NOT regexp_matches(w, '[{L.VOWELS}]') OR (length(w) <= 6 AND NOT (length(w) >= 3 AND substring(w, 1, 3) IN {sql.in_list(L.ENGLISH_STARTS)}) AND NOT regexp_full_match(w, '{syllable}')))"
    noisy = f"len(list_filter({own}, lambda w: {noise}))"
    return f"(length(replace({k}, ' ', '')) >= 2 AND length(replace({sql.match(k)}, ' ', '')) >= 3 AND len({own}) > 0 AND {noisy} < len({own}) AND NOT (len({parts}) = 1 AND {noisy} > 0))"


_TERMS = "list_filter({}, lambda t: length(t) >= 2 AND t NOT IN " + sql.in_list(L.STOPWORDS) + " AND NOT regexp_matches(t, '^[0-9]+$'))"
_TOP_UP = "CASE WHEN len({h}) >= 3 THEN {h} ELSE list_concat({h}, list_filter({m}, lambda k: NOT list_contains({h}, k))[:greatest({n} - len({h}), 0)]) END"


@query(f"""WITH {_NODE}, m AS (SELECT id, {sql.match('text')} AS norm, metadata.keywords AS kw, {_TERMS.format(sql.tokens(sql.match('text')))} AS t, {_TERMS.format(sql.tokens(sql.match("coalesce(metadata.topic, '')")))} AS tt FROM n WHERE text IS NOT NULL),
i AS (SELECT id, norm, coalesce({_inferred('t', 5)}, []) AS own, coalesce({_inferred('tt', 3)}, []) AS top, list_transform(coalesce(kw, []), lambda k: {sql.spaces("coalesce(k, 'None')")}) AS given FROM m),
g AS (SELECT *, list_filter(given, lambda k, j: k <> '' AND list_position(given, k) = j AND contains(norm, {sql.match('k')}) AND {_fit('k')}) AS h1 FROM i),
h AS (SELECT *, {_TOP_UP.format(h='h1', m='own', n=5)} AS h2 FROM g), f AS (SELECT *, {_TOP_UP.format(h='h2', m='top', n=3)} AS h3 FROM h)
SELECT id, array_to_string(own, ' | ') AS inferred, array_to_string(list_filter(list_transform(h3, lambda k: {sql.terms('k')}), lambda k: {_fit('k')})[:5], ' | ') AS keywords FROM f""")
def keywords(spark, d):
    """Keywords of every node: given ones that are valid, topped up from the text and the topic."""
    rows = _nodes(spark, d).where(F.col("text").isNotNull())
    joined = lambda c: F.array_join(c, " | ")
    return rows.select("id", joined(nodes.infer_keywords(F.col("text"))).alias("inferred"), joined(nodes.validate_keywords(F.col("keywords"), F.col("text"), F.coalesce("topic", F.lit("")))).alias("keywords"))


_MEANT = "list_distinct(list_filter({}, lambda w: w NOT IN " + sql.in_list(L.STOPWORDS) + "))"


@query(f"""WITH s AS (SELECT doc_id, {sql.sentences('text')} AS p {_DOC}), d AS (SELECT doc_id, p, len(p) AS n, least(3, len(p)) AS size FROM s WHERE len(p) > 0),
e AS (SELECT doc_id, n, size, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM d),
k AS (SELECT doc_id, i, n, size, unnest({_MEANT.format(sql.tokens(sql.match('x')))}) AS w FROM e),
o AS (SELECT doc_id, unnest({_MEANT.format(sql.tokens(sql.match('p[-1]')))}) AS w FROM d),
v AS (SELECT o.doc_id, o.w, 1 / sqrt(greatest(count(k.i), 1)) AS weight FROM o LEFT JOIN k ON k.doc_id = o.doc_id AND k.w = o.w GROUP BY o.doc_id, o.w),
t AS (SELECT doc_id, sum(weight) AS total FROM v GROUP BY doc_id),
r AS (SELECT DISTINCT v.doc_id, v.w, v.weight, unnest(generate_series(greatest(1, k.i - size + 1), least(k.i, n - size + 1))) AS i FROM v JOIN k ON k.doc_id = v.doc_id AND k.w = v.w),
c AS (SELECT r.doc_id, r.i, round(sum(r.weight) / any_value(t.total), 12) AS score FROM r JOIN t ON t.doc_id = r.doc_id GROUP BY r.doc_id, r.i),
b AS (SELECT doc_id, i, score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS place FROM c) WHERE place = 1)
SELECT d.doc_id AS doc_id, CASE WHEN coalesce(b.score, 0) < 0.1 THEN '' ELSE substring({sql.spaces("array_to_string(d.p[b.i:b.i + d.size - 1], ' ')")}, 1, 700) END AS quote FROM d LEFT JOIN b ON b.doc_id = d.doc_id""")
def source_quote(spark, d):
    """For every document: the run of sentences that best supports its last sentence."""
    docs = _documents(spark, d).withColumn("sents", text.sentences(F.col("text"))).where(F.size("sents") > 0)
    return docs.select("doc_id", nodes.best_quote(F.element_at("sents", -1), F.col("text")).alias("quote"))


#: Classes of nodes that are equal in text and topic words, and the links between them.
_LINKS = f"""k AS (SELECT id, coalesce(metadata.subject, '_root') AS subject, {sql.match("coalesce(text, '')")} AS key, {sql.match("coalesce(metadata.topic, '')")} AS top FROM n),
every AS (SELECT id, subject, key, list_sort(list_distinct(list_filter({sql.tokens('top')}, lambda w: w NOT IN {sql.in_list(L.STOPWORDS)}))) AS p FROM k WHERE key <> ''),
c AS (SELECT subject, key, p, min(id) AS id FROM every GROUP BY ALL),
f AS (SELECT *, list_distinct({sql.tokens('key')}) AS t, replace(key, ' ', '') AS s FROM c),
p AS (SELECT a.subject, a.id AS i, b.id AS j, {sql.jaccard('a.t', 'b.t')} AS similarity, a.p AS pa, b.p AS pb, a.s AS sa, b.s AS sb FROM f a JOIN f b ON a.subject = b.subject AND a.id < b.id AND {sql.jaccard('a.t', 'b.t')} >= 0.5),
g AS (SELECT *, list_distinct(list_transform(generate_series(1, greatest(length(sa) - 3, 1)), lambda x: substring(sa, x, 4))) AS ga, list_distinct(list_transform(generate_series(1, greatest(length(sb) - 3, 1)), lambda x: substring(sb, x, 4))) AS gb FROM p),
links AS (SELECT subject, i, j, round(similarity, 9) AS similarity FROM g WHERE similarity >= 0.76 OR (similarity >= 0.65 AND {sql.jaccard('ga', 'gb')} >= 0.82) OR (len(pa) > 0 AND len(pb) > 0 AND {sql.jaccard('pa', 'pb')} >= 0.80)),
before AS (SELECT f.subject, f.id, coalesce(list(l.i) FILTER (l.i IS NOT NULL), []) AS nb FROM f LEFT JOIN links l ON l.subject = f.subject AND l.j = f.id GROUP BY ALL),
folded AS (SELECT subject, list_reduce(list({{'id': id, 'nb': nb}} ORDER BY id), lambda a, x: CASE WHEN list_has_any(a, x.nb) THEN a ELSE list_append(a, x.id) END, []::VARCHAR[]) AS kept FROM before GROUP BY subject)"""


def _courses(spark: SparkSession, d: str) -> DataFrame:
    """Nodes by course; those without a subject belong to '_root'."""
    return _nodes(spark, d).withColumn("subject", F.coalesce("subject", F.lit("_root")))


@query(f"WITH {_NODE}, {_LINKS} SELECT subject, i, j, similarity FROM links")
def dup_pairs(spark, d):
    """Pairs of different texts of a course that count as near-duplicates; copies are named by dup_classes."""
    return nodes.similar_pairs(_courses(spark, d), ["subject"], "id")[0].withColumn("similarity", F.round("similarity", 9))


@query(f"WITH {_NODE}, {_LINKS} SELECT every.subject, every.id, c.id AS head FROM every JOIN c USING (subject, key, p)")
def dup_classes(spark, d):
    """The first of the nodes that are equal in text and topic words, for every node with a word."""
    return nodes.similar_pairs(_courses(spark, d), ["subject"], "id")[1].select("subject", F.col("o").alias("id"), "head")


@query(f"WITH {_NODE}, {_LINKS} SELECT subject, unnest(kept) AS id FROM folded")
def dedupe_course(spark, d):
    """Nodes that remain in every course, in the order of their ids."""
    return nodes.dedupe(_courses(spark, d), ["subject"], "id").select("subject", "id")


_TOPIC = "list_distinct(list_filter({}, lambda w: w NOT IN " + sql.in_list(L.STOPWORDS) + "))"


@query(f"""WITH {_NODE}, r AS (SELECT coalesce(metadata.subject, '_root') AS subject, metadata.file_name AS file_name, CASE WHEN metadata.file_name IS NULL THEN id END AS own_file,
{{'id': id, 'text': coalesce(text, ''), 'topic': coalesce(metadata.topic, ''), 'category': coalesce(metadata.category, ''), 'q': coalesce(metadata.question_templates, []), 'n': len({sql.words("coalesce(text, '')")}), 't': {_TOPIC.format(sql.tokens(sql.match("coalesce(metadata.topic, '')")))}}} AS x FROM n),
l AS (SELECT subject, file_name, own_file, list(x ORDER BY x.id) AS xs FROM r GROUP BY ALL),
m AS (SELECT subject, file_name, CASE WHEN len(xs) <= 3 THEN xs ELSE list_reduce(xs[2:], lambda a, x:
  CASE WHEN a[-1].category = x.category AND (a[-1].n < 150 OR x.n < 150) AND a[-1].n + x.n <= 400 AND {sql.jaccard('a[-1].t', 'x.t')} >= 0.5
  THEN list_append(a[:len(a) - 1], {{'id': a[-1].id, 'text': {sql.punctuation("(trim(a[-1].text) || '. ' || trim(x.text))")}, 'topic': a[-1].topic, 'category': a[-1].category,
    'q': list_filter(list_concat(a[-1].q, x.q), lambda z, k: list_position(list_concat(a[-1].q, x.q), z) = k)[:3], 'n': len({sql.words(sql.punctuation("(trim(a[-1].text) || '. ' || trim(x.text))"))}), 't': a[-1].t}})
  ELSE list_append(a, x) END, [xs[1]]) END AS ys FROM l), o AS (SELECT subject, file_name, unnest(ys) AS y FROM m)
SELECT subject, file_name, y.id AS id, y.text AS text, y.topic AS topic, y.category AS category, array_to_string(y.q, ' | ') AS questions FROM o""")
def merge_short(spark, d):
    """Short nodes of one file merged; a node without a file name is a file of its own."""
    rows = _courses(spark, d).withColumn("own_file", F.when(F.col("file_name").isNull(), F.col("id")))
    merged = nodes.merge_short(rows, ["subject", "file_name", "own_file"], "id", 150, 400).drop("own_file")
    return merged.withColumn("questions", F.array_join("question_templates", " | ")).drop("question_templates")


@query("""WITH c AS (SELECT coalesce(course, '_root') AS course, coalesce(file_name, CAST(doc_id AS VARCHAR)) AS f, len(list_filter(string_split_regex(text, '[\\s]+'), lambda w: w <> '')) AS w FROM documents WHERE text IS NOT NULL)
SELECT course, count(*) AS n_docs, count(DISTINCT f) AS n_files FROM c GROUP BY ROLLUP (course)""")
def course_rollup(spark, d):
    rows = _documents(spark, d).select(F.coalesce("course", F.lit("_root")).alias("course"), F.coalesce("file_name", F.col("doc_id").cast("string")).alias("f"))
    return rows.rollup("course").agg(F.count("*").alias("n_docs"), F.countDistinct("f").alias("n_files"))


@query("SELECT DISTINCT coalesce(course, '_root') AS course, regexp_replace(coalesce(course, '_root'), '[\\\\/:*?\"<>|]', '_', 'g') || '.textnodes.json' AS path FROM documents")
def course_files(spark, d):
    return tables.read(spark, d, "documents").select(F.coalesce("course", F.lit("_root")).alias("course")).distinct().withColumn("path", documents.course_file(F.col("course")))


# ---- JSON

_BROKEN = """b AS (SELECT id, '```json' || chr(10) || '[{"id": "' || id || '", "page": 1, "ok": true}, {"id": "' || substring(id, 1, 5) AS reply, 'Here: [{"id": "' || id || '",}, 5, {"ok": "yes"},] done' AS loose FROM (SELECT DISTINCT id FROM nodes))"""


def _replies(spark: SparkSession, d: str) -> DataFrame:
    ids = tables.read(spark, d, "nodes").select("id").distinct()
    return ids.select("id", F.concat(F.lit('```json\n[{"id": "'), "id", F.lit('", "page": 1, "ok": true}, {"id": "'), F.substring("id", 1, 5)).alias("reply"), F.concat(F.lit('Here: [{"id": "'), "id", F.lit('",}, 5, {"ok": "yes"},] done')).alias("loose"))


@query(f"""WITH {_BROKEN} SELECT id, '[{{"id": "' || id || '", "page": 1, "ok": true}}, {{"id": "' || substring(id, 1, 5) || '"}}]' AS repaired, '[{{"id": "' || id || '"}}, 5, {{"ok": "yes"}}]' AS array_text FROM b""")
def json_repair(spark, d):
    """Cut-off and loose replies made for each node, repaired."""
    return _replies(spark, d).select("id", json_text.repair(F.col("reply")).alias("repaired"), json_text.array_text(F.col("loose")).alias("array_text"))


@query(f"""WITH {_BROKEN} SELECT id, 0 AS place, id AS node_id, 'none' AS ok FROM b UNION ALL SELECT id, 1, 'none', 'none' FROM b""")
def json_nodes(spark, d):
    """The objects of a loose reply, one by one; a boolean that is written as text is none."""
    rows = _replies(spark, d).select("id", F.posexplode(json_text.elements(F.col("loose"))).alias("place", "e"))
    return rows.select("id", "place", F.coalesce(F.get_json_object("e", "$.id"), F.lit("none")).alias("node_id"), F.coalesce(json_text.real_boolean(F.col("e"), "$.ok").cast("string"), F.lit("none")).alias("ok"))


# ---- addresses and documents


@query("""WITH u AS (SELECT DISTINCT unnest(regexp_extract_all(text, 'https?://[^\\s<>"()]+')) AS url FROM documents WHERE text IS NOT NULL)
SELECT url, CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) IN ('drive.google.com', 'www.drive.google.com') THEN 'drive' WHEN contains(lower(url), 'm3u8') THEN 'stream' ELSE 'direct' END AS route,
regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host,
CASE WHEN regexp_replace(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') = '' THEN 'recording'
ELSE regexp_replace(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') END AS name FROM u""")
def url_parse(spark, d):
    found = _documents(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(r'(https?://[^\s<>"()]+)'), F.lit(1))).alias("url")).distinct()
    return found.select("url", urls.route(F.col("url")).alias("route"), urls.host(F.col("url")).alias("host"), urls.base_name(F.col("url"), F.lit("recording")).alias("name"))


def _dots(endings: list[str]) -> str:
    return sql.text("(?:" + "|".join(e.replace(".", r"\.") for e in endings) + ")$")


_LIST = "l AS (SELECT DISTINCT id, parent_id, name, mime_type, target_id, target_mime FROM drive_files WHERE NOT coalesce(trashed, false))"


def _route(name: str, mime: str) -> str:
    return f"""CASE WHEN regexp_matches(lower({name}), {_dots(L.SKIPPED_ENDINGS)}) OR coalesce({mime}, '') IN {sql.in_list(L.SKIPPED_TYPES)} THEN 'skip' WHEN coalesce({mime}, '') IN {sql.in_list(L.EXPORTED_TYPES)} THEN 'export'
WHEN coalesce({mime}, '') = 'application/pdf' OR ends_with(lower({name}), '.pdf') THEN 'pdf' WHEN coalesce({mime}, '') IN {sql.in_list(L.OFFICE_TYPES)} OR regexp_matches(lower({name}), {_dots(L.OFFICE_ENDINGS)}) THEN 'office' ELSE 'unknown' END"""


_KNOWN = "|".join(e[1:] for e in [*L.OFFICE_ENDINGS, ".pdf"])


@query(f"WITH {_LIST} SELECT id, name, {_route('name', 'mime_type')} AS route, regexp_replace(name, '(?i)\\.(?:{_KNOWN})$', '') || '.pdf' AS pdf FROM l WHERE coalesce(mime_type, '') NOT IN {sql.in_list(L.FOLDER_TYPES)}")
def file_route(spark, d):
    return documents.files_in(tables.read(spark, d, "drive_files")).select("id", "name", documents.route(F.col("name"), F.col("mime_type")).alias("route"), documents.pdf_name(F.col("name")).alias("pdf"))


@query(f"""WITH {_LIST} SELECT id, name, CASE WHEN ends_with(name, '.vtt') THEN 'text/vtt' WHEN ends_with(name, '.txt') THEN 'text/plain' ELSE 'application/octet-stream' END AS media_type,
left(regexp_replace(regexp_replace(name, '(.)\\.[^.]*$', '\\1'), '[\\\\/*?:"<>|]', '', 'g'), 1000) || '.pdf' AS local_pdf FROM l WHERE coalesce(mime_type, '') NOT IN {sql.in_list(L.FOLDER_TYPES)}""")
def file_names(spark, d):
    """The media type of each file, and its name as a local PDF."""
    return documents.files_in(tables.read(spark, d, "drive_files")).select("id", "name", urls.media_type(F.col("name")).alias("media_type"), documents.local_pdf_name(F.col("name")).alias("local_pdf"))


@query(f"WITH {_LIST} SELECT id, regexp_replace(name, '(?i)\\.(?:{_KNOWN})$', '') || '.pdf' AS pdf FROM l WHERE coalesce(mime_type, '') NOT IN {sql.in_list(L.FOLDER_TYPES)} AND regexp_replace(name, '(?i)\\.(?:{_KNOWN})$', '') || '.pdf' NOT IN (SELECT metadata.file_name FROM knowledge_base_qwen WHERE metadata.file_name IS NOT NULL)")
def targets_left(spark, d):
    """Files whose PDF isn't among those already extracted."""
    present = tables.read(spark, d, "knowledge_base_qwen").select(F.col("metadata.file_name").alias("target"))
    files = documents.files_in(tables.read(spark, d, "drive_files")).select("id", documents.pdf_name(F.col("name")).alias("pdf"))
    return documents.without_target(files, present, "pdf").select("id", "pdf")


@query(f"WITH {_LIST} SELECT id, name, mime_type FROM l WHERE contains(mime_type, 'video/')")
def video_listing(spark, d):
    return documents.videos(tables.read(spark, d, "drive_files"))


@query(f"""WITH RECURSIVE {_LIST}, r AS (SELECT parent_id, name, CASE WHEN mime_type IN {sql.in_list(L.SHORTCUT_TYPES)} AND target_id IS NOT NULL THEN target_id ELSE id END AS id, CASE WHEN mime_type IN {sql.in_list(L.SHORTCUT_TYPES)} AND target_id IS NOT NULL THEN target_mime ELSE mime_type END AS mime FROM l),
w AS (SELECT id, name AS path, name, mime, [id] AS seen, 0 AS level, true AS opens FROM r WHERE parent_id IS NULL
UNION ALL SELECT r.id, w.path || '/' || r.name, r.name, r.mime, list_append(w.seen, r.id), w.level + 1, NOT list_contains(w.seen, r.id) FROM w JOIN r ON r.parent_id = w.id WHERE w.opens AND (w.level = 0 OR coalesce(w.mime, '') IN {sql.in_list(L.FOLDER_TYPES)}))
SELECT DISTINCT id, name, mime AS mime_type, path, level, {_route('name', 'mime')} AS route FROM w WHERE level > 0 AND coalesce(mime, '') NOT IN {sql.in_list(L.FOLDER_TYPES)}""")
def folder_walk(spark, d):
    return documents.walk(tables.read(spark, d, "drive_files"))


@query(f"""WITH RECURSIVE {_LIST}, f AS (SELECT id, max({{'parent_id': parent_id, 'name': name}}) AS r FROM l WHERE mime_type IN {sql.in_list(L.FOLDER_TYPES)} GROUP BY id),
n AS (SELECT id, r.parent_id AS parent, r.name AS name, regexp_matches(lower(r.name), {sql.text('|'.join(L.SUBJECT_FOLDERS))}) OR NOT regexp_matches(lower(r.name), {sql.text('|'.join(L.OTHER_FOLDERS))}) OR r.parent_id IS NULL AS takes FROM f),
c AS (SELECT id, id AS at, 1 AS step FROM n UNION ALL SELECT c.id, n.parent, c.step + 1 FROM c JOIN n ON n.id = c.at WHERE NOT n.takes AND c.step < {L.CLIMB}),
t AS (SELECT c.id, n.name AS subject FROM c JOIN n ON n.id = c.at WHERE n.takes)
SELECT n.id, coalesce(t.subject, '{L.NO_SUBJECT}') AS subject FROM n LEFT JOIN t ON t.id = n.id""")
def subject_climb(spark, d):
    return documents.subjects(tables.read(spark, d, "drive_files"))


@query(f"WITH {_LIST} SELECT id, name FROM l WHERE coalesce(mime_type, '') NOT IN {sql.in_list(L.FOLDER_TYPES)} AND name NOT IN (SELECT metadata.file_name FROM knowledge_base_qwen WHERE metadata.file_name IS NOT NULL)")
def resume_antijoin(spark, d):
    done = tables.read(spark, d, "knowledge_base_qwen").select(F.col("metadata.file_name").alias("file_name"))
    return documents.remaining(tables.read(spark, d, "drive_files"), done, "file_name").select("id", "name")


_SPACE = text.WS[1:-1]


@query(f"""WITH s AS (SELECT DISTINCT metadata.subject AS subject FROM knowledge_base_qwen WHERE metadata.subject IS NOT NULL), k AS (SELECT subject, regexp_replace(subject, '[^\\p{{L}}\\p{{N}}_{_SPACE}-]', '', 'g') AS x FROM s)
SELECT subject, replace(lower(regexp_replace(regexp_replace(x, '^{text.WS}+', ''), '{text.WS}+$', '')), ' ', '') || '_slides.json' AS file FROM k""")
def collection_names(spark, d):
    """The collection's file of every subject."""
    subjects = tables.read(spark, d, "knowledge_base_qwen").select(F.col("metadata.subject").alias("subject")).where(F.col("subject").isNotNull()).distinct()
    return subjects.select("subject", documents.collection_name(F.col("subject"), F.lit("Slides")).alias("file"))


# ---- jobs

_JOBS = "j AS (SELECT job_id, max({'updated_at': updated_at, 'status': status, 'progress': progress, 'error': error}) AS r FROM jobs WHERE job_id IS NOT NULL GROUP BY job_id)"


@query(f"WITH {_JOBS} SELECT count(*) AS total, count(*) FILTER (r.status = 'queued') AS queued, count(*) FILTER (r.status = 'processing') AS processing, count(*) FILTER (r.status = 'completed') AS completed, count(*) FILTER (r.status = 'failed') AS failed, count(*) FILTER (r.status IN ('queued', 'processing')) AS open FROM j")
def job_metrics(spark, d):
    return jobs.metrics(tables.read(spark, d, "jobs"))


@query(f"WITH {_JOBS} SELECT job_id, r.status AS status, r.error AS error FROM j")
def job_latest(spark, d):
    return jobs.latest(tables.read(spark, d, "jobs")).select("job_id", "status", "error")


@query("""WITH u AS (SELECT DISTINCT job_id, CASE WHEN status = 'processing' AND error IS NULL AND progress IS NOT NULL THEN NULL ELSE status END AS status, progress, error, updated_at FROM jobs WHERE job_id IS NOT NULL),
g AS (SELECT job_id, min(updated_at) AS deleted_at FROM jobs WHERE status = 'failed' GROUP BY job_id),
r AS (SELECT u.* FROM u LEFT JOIN g USING (job_id) WHERE g.deleted_at IS NULL OR u.updated_at > g.deleted_at),
c AS (SELECT job_id, min(updated_at) AS created_at FROM r WHERE status IS NOT NULL GROUP BY job_id)
SELECT job_id, max({'at': updated_at, 'v': status}) FILTER (status IS NOT NULL).v AS status, max({'at': updated_at, 'v': progress}) FILTER (progress IS NOT NULL).v AS progress, max({'at': updated_at, 'v': error}) FILTER (error IS NOT NULL).v AS error
FROM r JOIN c USING (job_id) WHERE updated_at >= created_at GROUP BY job_id""")
def job_updates(spark, d):
    """Rows of the job table as partial updates (progress alone leaves the status unset), failed jobs as deleted at their first failure."""
    table = tables.read(spark, d, "jobs")
    unset = (F.col("status") == "processing") & F.col("error").isNull() & F.col("progress").isNotNull()
    updates = table.select("job_id", F.when(F.coalesce(~unset, F.lit(True)), F.col("status")).alias("status"), "progress", "error", "updated_at")
    gone = table.where("status = 'failed' AND job_id IS NOT NULL").groupBy("job_id").agg(F.min("updated_at").alias("deleted_at"))
    return jobs.merged(updates, gone).select("job_id", "status", "progress", "error")


@query(f"WITH {_JOBS} SELECT job_id, CASE WHEN EXISTS (SELECT 1 FROM segments s, jobs k WHERE k.job_id = j.job_id AND s.media_id = k.media_id) THEN 'requeue' ELSE 'fail' END AS action FROM j WHERE r.status IN ('queued', 'processing')")
def job_recovery(spark, d):
    """Open jobs and what becomes of them; the payload here is the recording's segments."""
    table = tables.read(spark, d, "jobs")
    have = tables.read(spark, d, "segments").select("media_id").distinct()
    payloads = table.join(have, "media_id", "left_semi").select("job_id")
    return jobs.recover(jobs.latest(table), payloads).select("job_id", "action")


@query(f"""WITH {sql.SEGMENTS}, {sql.COLLAPSED}, {sql.JUDGED}, s AS (SELECT media_id, count(*) AS total_segments, count(*) FILTER (verdict = 'keep') AS valid_segments, count(*) FILTER (verdict IN ('duration', 'short_text', 'hallucination')) AS filtered_hallucinations FROM judged GROUP BY media_id),
l AS (SELECT job_id, max({{'o': {{'updated_at': updated_at, 'status': status, 'progress': progress, 'error': error}}, 'media_id': media_id, 'result': result}}) AS r FROM jobs WHERE job_id IS NOT NULL GROUP BY job_id),
x AS (SELECT r.media_id AS media_id, max({{'at': r.o.updated_at, 'job_id': job_id, 'result': r.result}}) AS b FROM l WHERE r.o.status = 'completed' GROUP BY 1)
SELECT x.media_id, b.job_id AS job_id, x.media_id || '.vtt' AS vtt_filename, x.media_id || '.txt' AS txt_filename, '/download/' || x.media_id || '.vtt' AS vtt_download_url, coalesce(b.result.source_type, 'direct_file') AS source_type, coalesce(b.result.llm_refined, false) AS llm_refined,
total_segments, valid_segments, filtered_hallucinations, b.result.stats.detected_language AS detected_language FROM x JOIN s USING (media_id)""")
def job_results(spark, d):
    return jobs.results(tables.read(spark, d, "jobs"), segments.segment_stats(_segments(spark, d)))


@query(f"WITH {_JOBS} SELECT job_id, r.status AS status FROM j")
def job_stream(spark, d):
    """The latest state of each job, kept by a stream over the job table."""
    from ..streaming.jobs import run_to_end

    return run_to_end(spark, f"{d}/jobs.parquet").select("job_id", "status")


_LOW = f"regexp_matches(z.k, {sql.any_pattern([*L.FILLERS, *L.LOW_INFO])})"
_GRAMS = "list_distinct(list_transform(generate_series(1, greatest(length(replace({0}, ' ', '')) - 3, 1)), lambda i: substring(replace({0}, ' ', ''), i, 4)))"
_CODE = """(regexp_matches(text, '(^|[^\\p{L}\\p{N}_])(def|class|return|for\\s+[\\p{L}\\p{N}_]+\\s+in|if\\s+[\\p{L}\\p{N}_]+|import)($|[^\\p{L}\\p{N}_])')
OR (regexp_matches(text, '[{}<>]=?|==|!=') AND regexp_matches(text, '(^|[^\\p{L}\\p{N}_])[A-Za-z_][\\p{L}\\p{N}_]*\\s*\\(')))"""


def _like(y: str, x: str, threshold: float) -> str:
    same = sql.jaccard(f"{y}.t", f"{x}.t")
    return f"({same} >= {threshold} OR ({same} >= 0.5 AND len({y}.top) > 0 AND len({x}.top) > 0 AND {sql.jaccard(f'{y}.top', f'{x}.top')} >= 0.8) OR ({same} >= 0.65 AND {sql.jaccard(f'{y}.g', f'{x}.g')} >= 0.82))"


def _keyed(text: str, topic: str) -> str:
    """What the near-duplicate rule needs of a node, as fields of a struct."""
    norm = sql.match(text)
    return f"'t': list_distinct({sql.tokens(norm)}), 'top': {_TOPIC.format(sql.tokens(sql.match(topic)))}, 'g': list_transform([{norm}], lambda nn: {_GRAMS.format('nn')})[1]"


def _alike_gone(xs: str, threshold: float) -> str:
    return f"list_reduce({xs}[2:], lambda a, x: CASE WHEN len(list_filter(a, lambda y: {_like('y', 'x', threshold)})) > 0 THEN a ELSE list_append(a, x) END, [{xs}[1]])"


def _file_pass(p: str, source: str, least: int, most: int, shared: int, first: float, second: float) -> str:
    """Tables p_file (course, f, xs): the nodes of each file of a source."""
    joined = "array_to_string(list_transform(acc.cur, lambda q: q.s), ' ')"
    chunks = f"list_filter(CASE WHEN len(acc.cur) > 0 THEN list_append(acc.done, {joined}) ELSE acc.done END, lambda c: c <> '')"
    text = sql.punctuation("array_to_string(list_transform(list_filter(base, lambda z, i: z.k <> '' AND list_position(list_transform(base, lambda y: y.k), z.k) = i), lambda z: z.s), ' ')")
    merged = sql.punctuation("(trim(a[-1].text) || '. ' || trim(x.text))")
    return f"""{p}_a AS (SELECT course, f, {_fold('text', most, least, shared)} AS acc FROM {source}),
{p}_b AS (SELECT course, f, {chunks} AS c FROM {p}_a), {p}_c AS (SELECT course, f, generate_subscripts(c, 1) - 1 AS chunk, unnest(c) AS c FROM {p}_b),
{p}_d AS (SELECT course, f, chunk, {sql.sentences('c')} AS p, list_distinct({sql.tokens(sql.match('c'))}) AS src FROM {p}_c),
{p}_e AS (SELECT *, unnest(generate_series(0, len(p) - 1, 6)) AS k FROM {p}_d WHERE len(p) > 0),
{p}_r AS MATERIALIZED (SELECT course, f, chunk, k // 6 AS node, src, {sql.terms(sql.spaces("array_to_string(p[k + 1:k + 6], ' ')"))} AS raw FROM {p}_e), {p}_s AS MATERIALIZED (SELECT * EXCLUDE (raw), {sql.sentences('raw')} AS sents FROM {p}_r),
{p}_f AS MATERIALIZED (SELECT * EXCLUDE (sents), list_transform(sents, lambda s: {{'s': s, 'k': {sql.match('s')}}}) AS q FROM {p}_s),
{p}_g AS MATERIALIZED (SELECT * EXCLUDE (q), CASE WHEN len(list_filter(q, lambda z: z.k <> '' AND NOT {_LOW})) > 0 THEN list_filter(q, lambda z: z.k <> '' AND NOT {_LOW}) ELSE q END AS base FROM {p}_f),
{p}_h AS MATERIALIZED (SELECT * EXCLUDE (base), {text} AS text FROM {p}_g), {p}_i AS MATERIALIZED (SELECT *, {sql.match('text')} AS norm FROM {p}_h), {p}_j AS (SELECT *, {sql.tokens('norm')} AS t FROM {p}_i),
{p}_k AS (SELECT *, {_REASON} AS reason, {sql.containment('list_distinct(t)', 'src')} AS cover FROM {p}_j),
{p}_l AS MATERIALIZED (SELECT *, substring({sql.sentences('text')}[1], 1, 120) AS topic FROM {p}_k WHERE reason = 'keep' AND len({sql.words('text')}) BETWEEN 28 AND 500 AND len(list_distinct(t)) >= 0.30 * len(t) AND cover >= 0.52),
{p}_m AS MATERIALIZED (SELECT course, f, list({{'chunk': chunk, 'node': node, 'text': text, 'topic': topic, 'cover': cover, 'code': {_CODE}, 'norm': norm, 'n': len({sql.words('text')}), {_keyed('text', 'topic')}}} ORDER BY chunk, node) AS xs FROM {p}_l GROUP BY course, f),
{p}_n AS MATERIALIZED (SELECT course, f, {_alike_gone('xs', first)} AS xs FROM {p}_m),
{p}_o AS MATERIALIZED (SELECT course, f, CASE WHEN len(xs) <= 3 THEN xs ELSE list_reduce(xs[2:], lambda a, x: CASE WHEN (a[-1].n < 28 OR x.n < 28) AND a[-1].n + x.n <= 220 AND {sql.jaccard('a[-1].top', 'x.top')} >= 0.5
  THEN list_append(a[:len(a) - 1], {{'chunk': a[-1].chunk, 'node': a[-1].node, 'text': {merged}, 'topic': a[-1].topic, 'cover': a[-1].cover, 'code': a[-1].code, 'norm': a[-1].norm, 'n': len({sql.words(merged)}), {_keyed(merged, 'a[-1].topic')}}}) ELSE list_append(a, x) END, [xs[1]]) END AS xs FROM {p}_n),
{p}_file AS MATERIALIZED (SELECT course, f, {_alike_gone('xs', second)} AS xs FROM {p}_o)"""


@query(f"""WITH src AS (SELECT coalesce(course, '_root') AS course, coalesce(file_name, '') || '/' || CAST(doc_id AS VARCHAR) AS f, text {_DOC}), {_file_pass('low', 'src', 900, 1400, 70, 0.76, 0.76)},
poor AS (SELECT src.* FROM src LEFT JOIN low_file l ON l.course = src.course AND l.f = src.f WHERE len({sql.words('src.text')}) >= 500 AND coalesce(len(l.xs), 0) <= 1), {_file_pass('more', 'poor', 300, 700, 70, 0.88, 0.86)},
picked AS (SELECT coalesce(l.course, m.course) AS course, coalesce(l.f, m.f) AS f, CASE WHEN coalesce(len(m.xs), 0) > coalesce(len(l.xs), 0) THEN m.xs ELSE l.xs END AS xs FROM low_file l FULL JOIN more_file m ON m.course = l.course AND m.f = l.f),
nodes_of AS (SELECT course, f, unnest(xs) AS x FROM picked), placed AS MATERIALIZED (SELECT course, f, x, f || chr(1) || printf('%08d', x.chunk) || chr(1) || printf('%08d', x.node) AS place FROM nodes_of),
pair AS (SELECT a.course, a.place AS i, b.place AS j FROM placed a JOIN placed b ON a.course = b.course AND a.place < b.place AND len(b.x.t) >= 0.5 * len(a.x.t) AND len(a.x.t) >= 0.5 * len(b.x.t) AND {_like('a.x', 'b.x', 0.76)}),
before AS (SELECT q.course, q.place, coalesce(list(l.i) FILTER (l.i IS NOT NULL), []) AS nb FROM placed q LEFT JOIN pair l ON l.course = q.course AND l.j = q.place GROUP BY ALL),
folded AS (SELECT course, list_reduce(list({{'id': place, 'nb': nb}} ORDER BY place), lambda a, z: CASE WHEN list_has_any(a, z.nb) THEN a ELSE list_append(a, z.id) END, []::VARCHAR[]) AS kept FROM before GROUP BY course),
stay AS (SELECT course, unnest(kept) AS place FROM folded),
done AS (SELECT q.course, q.f, q.x.chunk AS chunk, q.x.node AS node, q.x.text AS text, q.x.topic AS topic, q.x.code AS code, q.x.cover AS cover, {_TERMS.format(sql.tokens('q.x.norm'))} AS t, {_TERMS.format(sql.tokens(sql.match('q.x.topic')))} AS tt FROM placed q JOIN stay ON stay.course = q.course AND stay.place = q.place),
h AS (SELECT *, coalesce({_inferred('t', 5)}, []) AS h2, coalesce({_inferred('tt', 3)}, []) AS top FROM done), k AS (SELECT *, {_TOP_UP.format(h='h2', m='top', n=3)} AS h3 FROM h)
SELECT course, f AS file_name, sha256(course || chr(1) || f || chr(1) || chunk || chr(1) || node || chr(1) || '0') AS id, text, topic, 'Theory' AS category, array_to_string(list_filter(list_transform(h3, lambda k: {sql.terms('k')}), lambda k: {_fit('k')})[:5], ' | ') AS keywords, code AS has_code, round(cover, 3) AS source_coverage FROM k""")
def nodes_e2e(spark, d):
    """Transcripts to nodes, with the extractive stand-in for the model."""
    found = pipelines.transcript_nodes(_documents(spark, d))
    return found.select("course", "file_name", "id", "text", "topic", "category", F.array_join("keywords", " | ").alias("keywords"), "has_code", F.round("source_coverage", 3).alias("source_coverage"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """By course and reason: passages of transcripts that are dropped or kept, and those left after near-duplicates."""
    return pipelines.surviving_passages(_documents(spark, d))


def _survivors() -> str:
    parts = "list_filter(CASE WHEN len(acc.cur) > 0 THEN list_append(acc.done, array_to_string(list_transform(acc.cur, lambda q: q.s), ' ')) ELSE acc.done END, lambda c: c <> '')"
    return f"""WITH a AS (SELECT coalesce(course, '_root') AS course, doc_id, text, {_fold('text', 120, None, 0)} AS acc {_DOC}),
b AS (SELECT course, doc_id, CASE WHEN len({sql.words('text')}) <= 120 THEN [text] ELSE {parts} END AS p FROM a),
m AS (SELECT course, printf('%020d/%08d', doc_id, generate_subscripts(p, 1) - 1) AS place, unnest(p) AS text FROM b),
n AS (SELECT *, {sql.match('text')} AS norm FROM m), j AS (SELECT *, {sql.tokens('norm')} AS t FROM n), judged AS (SELECT *, {_REASON} AS reason FROM j),
c AS (SELECT course, norm, min(place) AS place FROM judged WHERE reason = 'keep' GROUP BY ALL),
f AS (SELECT *, list_distinct({sql.tokens('norm')}) AS t, replace(norm, ' ', '') AS s FROM c),
p AS (SELECT a.course, a.place AS i, b.place AS j, {sql.jaccard('a.t', 'b.t')} AS similarity, a.s AS sa, b.s AS sb FROM f a JOIN f b ON a.course = b.course AND a.place < b.place AND len(b.t) >= 0.6 * len(a.t) AND len(a.t) >= 0.6 * len(b.t) AND {sql.jaccard('a.t', 'b.t')} >= 0.65),
g AS (SELECT *, list_distinct(list_transform(generate_series(1, greatest(length(sa) - 3, 1)), lambda x: substring(sa, x, 4))) AS ga, list_distinct(list_transform(generate_series(1, greatest(length(sb) - 3, 1)), lambda x: substring(sb, x, 4))) AS gb FROM p),
links AS (SELECT course, i, j FROM g WHERE similarity >= 0.76 OR {sql.jaccard('ga', 'gb')} >= 0.82),
before AS (SELECT f.course, f.place, coalesce(list(l.i) FILTER (l.i IS NOT NULL), []) AS nb FROM f LEFT JOIN links l ON l.course = f.course AND l.j = f.place GROUP BY ALL),
folded AS (SELECT course, len(list_reduce(list({{'id': place, 'nb': nb}} ORDER BY place), lambda a, x: CASE WHEN list_has_any(a, x.nb) THEN a ELSE list_append(a, x.id) END, []::VARCHAR[])) AS kept FROM before GROUP BY course),
all_kept AS (SELECT course, count(*) AS n FROM judged WHERE reason = 'keep' GROUP BY course)
SELECT course, reason, count(*) AS n FROM judged WHERE reason <> 'keep' GROUP BY ALL
UNION ALL SELECT course, 'duplicate', n - kept FROM all_kept JOIN folded USING (course) WHERE n > kept UNION ALL SELECT course, 'kept', kept FROM folded"""


@query(_survivors())
def surviving_passages(spark, d):
    return flagship(spark, d)
