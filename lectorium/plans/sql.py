"""Pieces of SQL for the other engine that results are compared with."""

from __future__ import annotations

from .. import lexicon as L
from ..functions.text import WS


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def spaces(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS}+', ' ', 'g'))"


def punctuation(e: str) -> str:
    e = f"regexp_replace({e}, '{WS}+([,.;:!?])', '\\1', 'g')"
    for sign in ("[.]", "[?]", "!"):
        e = f"regexp_replace({e}, '{sign}{{2,}}', '{sign.strip('[]')}', 'g')"
    return spaces(f"regexp_replace({e}, '{WS}*\\.{WS}*', '. ', 'g')")


def terms(e: str) -> str:
    for wrong, right in L.TERMS:
        e = f"regexp_replace({e}, '(^|[^\\p{{L}}\\p{{N}}_]){wrong}($|[^\\p{{L}}\\p{{N}}_])', '\\1{right}\\2', 'gi')"
    return e


def match(e: str) -> str:
    inner = terms(f"lower({e})")
    return spaces(f"regexp_replace(strip_accents({inner}), '[^a-z0-9\\s]', ' ', 'g')")


def words(e: str) -> str:
    return f"list_filter(string_split_regex({e}, '{WS}+'), lambda w: w <> '')"


def tokens(norm: str) -> str:
    return f"list_filter(string_split({norm}, ' '), lambda w: w <> '')"


def sentences(e: str) -> str:
    s = spaces(e)
    by_end = f"list_filter(string_split(regexp_replace({s}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda p: p <> '')"
    by_comma = f"list_filter(list_transform(string_split_regex({s}, '[,;:]{WS}+'), lambda p: trim(p)), lambda p: p <> '')"
    return f"CASE WHEN {s} = '' THEN [] WHEN len({by_end}) <= 1 AND len({words(s)}) > 80 THEN {by_comma} ELSE {by_end} END"


def string_list(values: list[str]) -> str:
    return "[" + ", ".join(map(text, values)) + "]"


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(map(text, values)) + ")"


def any_pattern(patterns: list[str]) -> str:
    return text("|".join(f"(?:{p})" for p in patterns))


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"


def containment(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len({a}) END"


def timestamp(e: str, mark: str) -> str:
    return f"printf('%02d:%02d:%02d{mark}%03d', CAST(floor({e} / 3600) AS BIGINT), CAST(floor(({e} % 3600) / 60) AS BIGINT), CAST(floor({e} % 60) AS BIGINT), CAST(trunc(({e} - floor({e})) * 1000) AS BIGINT))"


#: Segments delivered once, as a common table expression named seg.
SEGMENTS = """seg AS (
  SELECT media_id, seg_idx, r.start_sec AS start_sec, r.end_sec AS end_sec, coalesce(r.text, '') AS text
  FROM (SELECT media_id, seg_idx, max({'ingested_at': ingested_at, 'text': text, 'start_sec': start_sec, 'end_sec': end_sec}) AS r FROM segments WHERE media_id IS NOT NULL AND seg_idx IS NOT NULL GROUP BY ALL))"""

#: Runs of six or more equal characters as one, then at most two equal words in a row; seg to fixed(media_id, seg_idx, clean).
COLLAPSED = f"""chars AS (
  SELECT media_id, seg_idx, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i FROM seg WHERE text <> ''),
islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY media_id, seg_idx, c ORDER BY i) AS island FROM chars),
runs AS (
  SELECT media_id, seg_idx, c, min(i) AS i, count(*) AS n FROM islands GROUP BY media_id, seg_idx, c, island),
shorter AS (
  SELECT media_id, seg_idx, string_agg(CASE WHEN n >= 6 AND c <> chr(10) THEN c ELSE repeat(c, n) END, '' ORDER BY i) AS t FROM runs GROUP BY media_id, seg_idx),
split AS (
  SELECT media_id, seg_idx, {words('t')} AS w FROM shorter),
fixed AS (
  SELECT seg.media_id, seg.seg_idx, seg.start_sec, seg.end_sec, seg.text,
    coalesce(array_to_string(list_filter(w, lambda x, k: NOT (k > 2 AND lower(w[k]) = lower(w[k - 1]) AND lower(w[k - 1]) = lower(w[k - 2]))), ' '), '') AS clean
  FROM seg LEFT JOIN split USING (media_id, seg_idx))"""

_HALLUCINATED = f"""(coalesce((SELECT max(n) FROM runs r WHERE r.media_id = f.media_id AND r.seg_idx = f.seg_idx AND r.c <> chr(10)), 0) >= 11
   OR (len({words('f.text')}) > 5 AND list_max(list_transform(list_distinct({words('f.text')}), lambda x: len(list_filter({words('f.text')}, lambda y: y = x)))) > len({words('f.text')}) * 0.3::DOUBLE)
   OR regexp_matches(lower(f.text), {any_pattern(L.SPAM)}))"""

#: fixed with verdict.
JUDGED = f"""judged AS (
  SELECT f.*, CASE
    WHEN end_sec - start_sec IS NULL OR end_sec - start_sec < 0.5 OR end_sec - start_sec > 30 THEN 'duration'
    WHEN end_sec - start_sec > 8 AND length({spaces('f.text')}) < 10 AND length(regexp_replace(regexp_replace(f.text, '^{WS}+', ''), '{WS}+$', '')) < 10 THEN 'short_text'
    WHEN {_HALLUCINATED} THEN 'hallucination'
    WHEN clean = '' THEN 'blank' ELSE 'keep' END AS verdict
  FROM fixed f)"""
