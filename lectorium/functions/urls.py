"""What addresses say about where a recording comes from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import safe_file_name

#: Hosts of the document store.
DRIVE_HOSTS = ["drive.google.com", "www.drive.google.com"]


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def is_drive(url: Column) -> Column:
    return host(url).isin(*DRIVE_HOSTS) | url.startswith("gdrive://")


def is_stream(url: Column) -> Column:
    return F.contains(F.lower(url), F.lit("m3u8"))


def route(url: Column) -> Column:
    """The way a recording is fetched: drive, stream or direct, in this order."""
    return F.when(is_drive(url), "drive").when(is_stream(url), "stream").otherwise("direct")


def drive_id(url: Column) -> Column:
    """struct(kind, id) of a document store address; null if it is none."""

    def some(kind: str, pattern: str) -> Column:
        found = F.regexp_extract(url, pattern, 1)
        return F.when(found != "", F.struct(F.lit(kind).alias("kind"), found.alias("id")))

    return F.coalesce(some("file", r"^gdrive://file/(.+)$"), some("folder", r"/folders/([^?/]+)"), some("file", r"/file/d/([^/?]+)"), some("file", r"\?(?:[^#]*?)id=([^&#]+)"))


def folder_id(link: Column) -> Column:
    return F.nullif(F.regexp_extract(link, r"/folders/([a-zA-Z0-9_-]+)", 1), F.lit(""))


def base_name(url: Column, fallback: Column) -> Column:
    """The file name in the address without its last ending, made safe; streams without one are named by host."""
    last = F.regexp_extract(path(url), r"([^/]*)$", 1)
    bare = F.regexp_replace(last, r"(?<=.)\.[^.]*$", "")
    named = F.when((bare == "") & is_stream(url), F.concat(F.lit("m3u8_"), F.replace(host(url), F.lit("."), F.lit("_")))).otherwise(bare)
    return safe_file_name(named, fallback)


def media_type(name: Column) -> Column:
    """The media type under which an output is handed out."""
    return F.when(name.endswith(".vtt"), "text/vtt").when(name.endswith(".txt"), "text/plain").otherwise("application/octet-stream")


def service_urls(base: Column) -> Column:
    """Addresses to try for a model service."""
    bare = F.rtrim(base, F.lit("/"))
    return F.when(bare.endswith("/v1/chat/completions") | bare.endswith("/chat/completions"), F.array(bare)).otherwise(F.array(*(F.concat(bare, F.lit(s)) for s in ("/v1/chat/completions", "/chat/completions", "/chat"))))


#: The wording of the hint for a speech model.
ENGLISH_HINT = ("Academic lecture on ", ". Technical terminology expected.")
VIETNAMESE_HINT = ("Đây là bài giảng học thuật tiếng Việt", " môn ", ". Nội dung mang tính học thuật, chuyên ngành.")


def speech_prompt(language: Column, subject: Column) -> Column:
    """The hint for a speech model; null where there is nothing to hint at."""
    subject = F.nullif(subject, F.lit(""))
    english = F.when(subject.isNotNull(), F.concat(F.lit(ENGLISH_HINT[0]), subject, F.lit(ENGLISH_HINT[1])))
    begin, of, end = map(F.lit, VIETNAMESE_HINT)
    vietnamese = F.concat(begin, F.coalesce(F.concat(of, subject), F.lit("")), end)
    return F.when(language == "vi", vietnamese).otherwise(english)
