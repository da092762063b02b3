"""The document store: listing, walking folders, routing files, naming outputs, resuming.

Columns of a listing: id, parent_id, name, mime_type, trashed, target_id, target_mime.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicon as L
from .storage import kept


def entries(listing: DataFrame) -> DataFrame:
    """One row per entry that isn't in the trash; rows listed twice are equal."""
    return listing.where(~F.coalesce("trashed", F.lit(False))).dropDuplicates(["id", "parent_id"])


def videos(listing: DataFrame) -> DataFrame:
    return entries(listing).where(F.contains("mime_type", F.lit("video/"))).select("id", "name", "mime_type")


def files_in(listing: DataFrame) -> DataFrame:
    """Everything but folders; an unknown type isn't a folder."""
    return entries(listing).where(~F.coalesce(F.col("mime_type"), F.lit("")).isin(*L.FOLDER_TYPES))


def shortcut_target(listing: DataFrame) -> DataFrame:
    """id and type an entry stands for: a shortcut's target, else itself."""
    short = F.col("mime_type").isin(*L.SHORTCUT_TYPES) & F.col("target_id").isNotNull()
    return listing.withColumn("real_id", F.when(short, F.col("target_id")).otherwise(F.col("id"))).withColumn("real_type", F.when(short, F.col("target_mime")).otherwise(F.col("mime_type")))


def _ends_in(name: Column, endings: list[str]) -> Column:
    return F.lower(name).rlike("(?:" + "|".join(e.replace(".", r"\.") for e in endings) + ")$")


def route(name: Column, mime: Column) -> Column:
    """skip, export, pdf, office or unknown: the first that holds."""
    mime = F.coalesce(mime, F.lit(""))
    return (
        F.when(_ends_in(name, L.SKIPPED_ENDINGS) | mime.isin(*L.SKIPPED_TYPES), "skip")
        .when(mime.isin(*L.EXPORTED_TYPES), "export")
        .when((mime == "application/pdf") | _ends_in(name, [".pdf"]), "pdf")
        .when(mime.isin(*L.OFFICE_TYPES) | _ends_in(name, L.OFFICE_ENDINGS), "office")
        .otherwise("unknown")
    )


def pdf_name(name: Column) -> Column:
    """The name with one known ending taken off, and .pdf."""
    known = "|".join(e[1:] for e in [*L.OFFICE_ENDINGS, ".pdf"])
    return F.concat(F.regexp_replace(name, rf"(?i)\.(?:{known})$", ""), F.lit(".pdf"))


def local_pdf_name(name: Column) -> Column:
    """The other naming: illegal characters and the last ending dropped."""
    return F.concat(F.regexp_replace(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), r'[\\/*?:"<>|]', ""), F.lit(".pdf"))


def collection_name(subject: Column, folder: Column) -> Column:
    """Both names in lower case, with nothing but letters, digits, underscores, hyphens and inner white space other than blanks.

    Marks that aren't composed with their letter are no letters and go.
    """
    kept_only = lambda x: F.regexp_replace(x, r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f-]", "")
    part = lambda x: F.replace(F.lower(F.regexp_replace(kept_only(x), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")), F.lit(" "), F.lit(""))
    return F.concat(part(subject), F.lit("_"), part(folder), F.lit(".json"))


def course_file(course: Column) -> Column:
    return F.concat(F.regexp_replace(course, r'[\\/:*?"<>|]', "_"), F.lit(".textnodes.json"))


def walk(listing: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(id, name, mime_type, path, level, route): every file reached from the roots, through folders and shortcuts.

    Level by level, to any depth: each round joins the frontier of folders with their children. A
    folder reached again on the same path ends there, so shortcut cycles end. A shortcut to a folder opens that
    folder under the shortcut's name. Without roots, entries without a parent are the roots.
    """
    real = kept(shortcut_target(entries(listing)).select("parent_id", "real_id", "name", "real_type"))
    if roots is None:
        roots = real.where(F.col("parent_id").isNull()).select(F.col("real_id").alias("id"), F.col("name").alias("path"))
    front = roots.select("id", "path", F.array("id").alias("seen"))
    found, level = None, 0
    while True:
        level += 1
        children = kept(front.join(real, front.id == real.parent_id).select(F.col("real_id").alias("id"), "name", F.col("real_type").alias("mime_type"), F.concat_ws("/", "path", "name").alias("path"), "seen"))
        if children.limit(1).count() == 0:
            break
        folder = F.coalesce(F.col("mime_type"), F.lit("")).isin(*L.FOLDER_TYPES)
        files = children.where(~folder).select("id", "name", "mime_type", "path", F.lit(level).alias("level"))
        found = files if found is None else found.unionByName(files)
        front = children.where(folder & ~F.array_contains("seen", F.col("id"))).select("id", "path", F.array_append("seen", F.col("id")).alias("seen"))
    if found is None:
        found = real.limit(0).select(F.col("real_id").alias("id"), "name", F.col("real_type").alias("mime_type"), F.col("name").alias("path"), F.lit(0).alias("level"))
    return found.withColumn("route", route(F.col("name"), F.col("mime_type"))).distinct()


def subjects(listing: DataFrame) -> DataFrame:
    """(id, subject) of every folder: the name of the nearest folder upwards that names a subject.

    That is one with a subject word, or one without any other word of folders; at the root its own
    name. Six folders are looked at; beyond that the subject is unknown, as it is where a parent is
    missing from the listing. Names are compared in lower case and composed form.
    """
    from ..functions.text import nfc_lower

    folders = entries(listing).where(F.col("mime_type").isin(*L.FOLDER_TYPES)).select("id", "parent_id", "name").groupBy("id").agg(F.max_by(F.struct("parent_id", "name"), F.struct("parent_id", "name")).alias("r")).select("id", "r.parent_id", "r.name")
    low = nfc_lower(F.coalesce("name", F.lit("")))
    words = folders.withColumn("low", low)
    named = words.withColumn("takes", F.col("low").rlike("|".join(L.SUBJECT_FOLDERS)) | ~F.col("low").rlike("|".join(L.OTHER_FOLDERS)) | F.col("parent_id").isNull()).drop("low")
    named = kept(named)
    up = named.select(F.col("id").alias("up_id"), F.col("parent_id").alias("up_parent"), F.col("name").alias("up_name"), F.col("takes").alias("up_takes"))
    state = named.select("id", F.when(F.col("takes"), F.col("name")).alias("subject"), F.when(~F.col("takes"), F.col("parent_id")).alias("next"))
    for _ in range(L.CLIMB - 1):
        state = state.join(up, F.col("next") == F.col("up_id"), "left").select("id", F.coalesce("subject", F.when(F.col("up_takes"), F.col("up_name"))).alias("subject"), F.when(F.col("subject").isNull() & ~F.coalesce("up_takes", F.lit(True)), F.col("up_parent")).alias("next"))
    return state.select("id", F.coalesce("subject", F.lit(L.NO_SUBJECT)).alias("subject"))


def without_target(files: DataFrame, present: DataFrame, target_col: str) -> DataFrame:
    """Files whose target isn't there yet; present has a column target of paths or names."""
    there = present.select(F.col("target").alias(target_col)).where(F.col("target").isNotNull()).distinct()
    return files.join(there, target_col, "left_anti")


def remaining(listing: DataFrame, done: DataFrame, name_col: str) -> DataFrame:
    """Files whose name isn't among those already extracted."""
    return files_in(listing).join(done.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct(), "name", "left_anti")
