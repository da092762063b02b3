"""JSON as models write it: fenced, cut off, with trailing commas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS_SET, let


def array_text(x: Column, repair_commas: bool = True) -> Column:
    """The text of a JSON array in a reply: unfenced, from the first [ to the last ]; null if there is none."""

    def cut(s: Column) -> Column:
        begin, end = F.instr(s, "["), F.length(s) - F.instr(F.reverse(s), "]") + 1
        found = (begin > 0) & (F.instr(s, "]") > 0) & (end > begin)
        body = F.when(found, s.substr(begin, end - begin + 1))
        if not repair_commas:
            return body
        return F.when(F.try_parse_json(body).isNull(), F.regexp_replace(body, r",\s*([\]}])", "$1")).otherwise(body)

    fenced = F.regexp_extract(x, r"(?i)```(?:json)?\s*([\s\S]*?)\s*```", 1)
    return let(F.btrim(F.when(x.rlike(r"(?i)```(?:json)?\s*[\s\S]*?\s*```"), fenced).otherwise(x), F.lit(WS_SET)), cut)


def elements(x: Column, repair_commas: bool = True) -> Column:
    """The array's objects, each as JSON text; elements that aren't objects are skipped; null if it can't be parsed."""
    body = array_text(x, repair_commas)
    parsed = F.from_json(F.when(F.try_parse_json(body).isNotNull(), body), "array<string>")
    return F.filter(parsed, lambda e: F.ltrim(e).startswith("{"))


def repair(x: Column) -> Column:
    """A cut-off array closed again: quote, at most one brace, bracket. A text without [ comes back unfenced."""

    def close(s: Column) -> Column:
        trimmed = F.rtrim(s, F.lit(", \n\r\t"))
        times = lambda t, c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
        quoted = let(trimmed, lambda t: F.concat(t, F.when(times(t, '"') % 2 != 0, '"').otherwise("")))
        braced = let(quoted, lambda t: F.concat(t, F.when(times(t, "{") > times(t, "}"), "}").otherwise(""), F.lit("]")))
        return F.when(s.endswith("]"), s).otherwise(braced)

    def from_bracket(s: Column) -> Column:
        at = F.instr(s, "[")
        return F.when(at == 0, s).otherwise(close(s.substr(at, F.length(s))))

    return let(F.btrim(F.regexp_replace(F.regexp_replace(x, r"```json\s*", ""), r"```\s*", ""), F.lit(WS_SET)), from_bracket)


def reply_text(x: Column) -> Column:
    """What a service's reply says: choices[0].message.content, else response, else text, by the first key that is there."""
    v = F.try_parse_json(x)
    has = lambda path: F.get_json_object(x, path).isNotNull()
    return F.when(v.isNull(), F.lit(None).cast("string")).when(has("$.choices"), F.coalesce(F.get_json_object(x, "$.choices[0].message.content"), F.lit(""))).when(has("$.response"), F.get_json_object(x, "$.response")).otherwise(F.coalesce(F.get_json_object(x, "$.text"), F.lit("")))


def real_boolean(element: Column, path: str) -> Column:
    """A boolean only if it is written as one; the text "yes" is none."""
    v = F.try_parse_json(element)
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "BOOLEAN", F.try_variant_get(v, path, "boolean"))


def string_list(element: Column, path: str) -> Column:
    """A list of strings; null if it is something else."""
    return F.from_json(F.get_json_object(element, path), "array<string>")
