"""Files, stores, fetching, writers and SQL functions."""

import json
import re

import pytest

from pyspark.sql import functions as F

from lectorium.functions.registry import register_functions
from lectorium.operators import segments
from lectorium.plans import catalogue
from lectorium.sources import sinks, stores, transcripts


def test_transcripts(spark, tmp_path):
    root = tmp_path / "file transcript"
    (root / "Môn Triết" / "Bài 1").mkdir(parents=True)
    (root / "Môn Triết" / "Bài 1" / "a b.txt").write_bytes("Xin  chào\n".encode() + b"\xff" + "bạn".encode())
    (root / "top.txt").write_text("x")
    (root / "empty.txt").write_text(" \n")
    (root / "other.md").write_text("y")
    got = {(r["course"], r["subject"], r["file_name"], r["text"]) for r in transcripts.read_transcripts(spark, str(root)).collect()}
    assert got == {("Môn Triết", "Môn Triết", "a b.txt", "Xin chào bạn"), ("_root", "top", "top.txt", "x")}
    assert {r["name"] for r in transcripts.list_outputs(spark, str(root)).collect()} == {"a b.txt", "top.txt", "empty.txt"}


def test_job_store(spark, tmp_path):
    path = tmp_path / "jobs.json"
    path.write_text(json.dumps({"a": {"status": "queued", "progress": "x"}, "b": 5, "c": {"progress": "y"}, "d": {"status": "failed", "result": {"k": 1}}}))
    assert {(r["job_id"], r["status"]) for r in stores.read_job_store(spark, str(path)).collect()} == {("a", "queued"), ("d", "failed")}
    path.write_text("not json")
    assert stores.read_job_store(spark, str(path)).count() == 0


def test_collection(spark, tmp_path):
    path = tmp_path / "kb.json"
    path.write_text(json.dumps([{"id_": "1", "text": "t", "metadata": {"file_name": "f.pdf", "page": 2}}, {"id_": "2", "text": "u", "metadata": {}}]))
    nodes = stores.read_collection(spark, str(path))
    assert nodes.count() == 2 and [r["file_name"] for r in stores.done_files(nodes).collect()] == ["f.pdf"]
    made = nodes.select(F.struct(F.col("id").alias("id_"), "text", "metadata").alias("n")).select(stores.enrich(F.col("n"), F.lit("g.pdf"), F.lit("s"), F.lit(3)).alias("n"))
    assert {(r["n"]["metadata"]["file_name"], r["n"]["metadata"]["page"]) for r in made.collect()} == {("g.pdf", 3)}


def test_fetch(spark):
    def fetch(url):
        if url == "bad":
            raise OSError("no")
        return b"" if url == "empty" else url.encode()

    df = spark.createDataFrame([("ok",), ("bad",), ("empty",), (None,)], "url string")
    got = {r["url"]: (bytes(r["content"]) if r["content"] else None, r["error"]) for r in stores.fetched(df, "url", fetch, 2, 0.0).collect()}
    assert got == {"ok": (b"ok", None), "bad": (None, "OSError: no"), "empty": (None, "empty"), None: (None, None)}


def test_writers(spark, tmp_path):
    rows = [("m", i, float(i), i + 1.0, f"câu {i}") for i in (0, 1, 3000)]
    seg = spark.createDataFrame(rows, "media_id string, seg_idx int, start_sec double, end_sec double, text string")
    sinks.write_subtitles(segments.vtt_blocks(segments.cues(seg)), str(tmp_path / "vtt"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "vtt")).collect()]
    assert lines[0] == "WEBVTT" and "00:50:00.000 --> 00:50:01.000" in lines and lines.index("câu 0") < lines.index("câu 1")
    sinks.write_transcripts(segments.txt_blocks(seg), str(tmp_path / "txt"))
    assert {r["value"] for r in spark.read.text(str(tmp_path / "txt")).collect()} == {"câu 0 câu 1", "câu 3000"}
    nodes = spark.createDataFrame([("Môn A", "p1", "x"), ("Môn B", "p2", "y")], "course string, place string, text string")
    sinks.write_nodes(nodes, str(tmp_path / "nodes"))
    assert {(r["course"], r["text"]) for r in spark.read.json(str(tmp_path / "nodes")).collect()} == {("Môn A", "x"), ("Môn B", "y")}


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql("SELECT norm_spaces('  a   b ') AS a, set_jaccard(array('x','y'), array('y')) AS b, vtt_time(1.001D) AS c, set_containment(array(), array('x')) AS d").first()
    assert tuple(row) == ("a b", 0.5, "00:00:01.000", 0.0)


def test_prompts(spark):
    from lectorium.functions import prompts

    row = spark.createDataFrame([("c" * 400, None, "Đáp án\n\n📚 Nguồn: a\nb", " ")], "t string, s string, a string, b string")
    got = row.select(prompts.retrieval_question(F.col("t"), F.col("s")), prompts.retrieval_answer(F.col("a")), prompts.retrieval_question(F.col("b"), F.col("s")), prompts.node_prompt(F.lit("x {CHUNK_TEXT} y"), F.lit("z"), F.lit("!"))).first()
    assert got[0].endswith("\n\n" + "c" * 300) and "học thuật" in got[0] and tuple(got)[1:] == ("Đáp án", "", "x z y!")


def test_collection_names_of_all_subjects(spark, tmp_path):
    subjects = ["HP: Giải tích", "Học máy (K65)", "He_dieu_hanh", "Mạng [2].x", " Hai\ndòng \t", "To\u00e1n", "Toa\u0301n", "m² ½", "a\u00a0b\u3000", "C++ & C#", "İSTANBUL", "\x1ca", "???", "", "Vật lý - 1", None, "HP: Giải tích"]
    spark.createDataFrame([((s,),) for s in subjects], "metadata struct<subject: string>").write.parquet(f"{tmp_path}/knowledge_base_qwen.parquet")
    want = {(s, re.sub(r"[^\w\s-]", "", s).strip().lower().replace(" ", "") + "_slides.json") for s in subjects if s is not None}
    assert sorted(map(tuple, catalogue.QUERIES["collection_names"](spark, str(tmp_path)).collect())) == sorted(want)


def test_recordings_are_fetched_by_their_route(spark):
    from lectorium.sources import media

    rows = spark.createDataFrame([("https://a.b/x.mp4",), ("https://a.b/live.m3u8",), ("gdrive://file/F1",), ("https://drive.google.com/drive/folders/D1",), ("https://a.b/bad",), (None,)], "url string")

    def direct(u):
        if u.endswith("bad"):
            raise OSError("gone")
        return b"direct"

    got = {r["url"]: (r["route"], r["content"] and bytes(r["content"]), r["error"]) for r in media.fetch_recordings(rows, "url", direct, lambda i: i.encode(), lambda u: b"stream", attempts=2, delay=0).collect()}
    assert got["https://a.b/x.mp4"] == ("direct", b"direct", None) and got["https://a.b/live.m3u8"] == ("stream", b"stream", None)
    assert got["gdrive://file/F1"] == ("drive", b"F1", None) and got["https://drive.google.com/drive/folders/D1"][2] == "a folder has to be listed"
    assert got["https://a.b/bad"][2] == "OSError: gone" and len(got) == 6


def test_stream_copy_reports_failure(tmp_path):
    from lectorium.sources import media

    program = tmp_path / "copy"
    program.write_text('#!/bin/sh\nfor last; do :; done\nprintf "$2" > "$last"\n')
    program.chmod(0o755)
    assert media.stream_copy("abc", str(program)) == b"abc"
    program.write_text("#!/bin/sh\necho no >&2\nexit 1\n")
    with pytest.raises(OSError, match="no"):
        media.stream_copy("abc", str(program))


def test_documents_are_acquired_once(spark):
    from lectorium.sources import media

    listing = spark.createDataFrame([("1", "r", "a.docx", None, False, None, None), ("2", "r", "b.pdf", None, False, None, None), ("3", "r", "c.mp4", None, False, None, None), ("4", "r", "d", "application/vnd.google-apps.document", False, None, None)], "id string, parent_id string, name string, mime_type string, trashed boolean, target_id string, target_mime string")
    fetchers = {k: (lambda i, k=k: f"{k}{i}".encode()) for k in ("export", "office", "pdf")}
    present = spark.createDataFrame([("b.pdf",), (None,)], "target string")
    got = {r["id"]: (r["pdf"], r["content"] and bytes(r["content"])) for r in media.acquire(listing, fetchers, present, delay=0).collect()}
    assert got == {"1": ("a.pdf", b"office1"), "3": ("c.mp4.pdf", None), "4": ("d.pdf", b"export4")}


def test_pages_and_speech(spark):
    from lectorium.sources import media

    files = spark.createDataFrame([("a", b"xyz"), ("b", b""), ("c", None), ("d", b"!")], "path string, content binary")

    def render(content, dpi):
        if content == b"!":
            raise ValueError
        return (bytes([c]) + str(dpi).encode() for c in content)

    assert sorted((r["path"], r["page"], bytes(r["image"])) for r in media.page_images(files, render).collect()) == [("a", 1, b"x200"), ("a", 2, b"y200"), ("a", 3, b"z200")]
    recordings = spark.createDataFrame([("m", b"ab", "vi", None), ("n", None, "vi", None)], "media_id string, content binary, language string, prompt string")
    got = media.decoded(recordings, lambda content, language, prompt: ((float(i), i + 1.0, chr(c) + language) for i, c in enumerate(content)))
    assert sorted(map(tuple, got.collect())) == [("m", 0, 0.0, 1.0, "avi"), ("m", 1, 1.0, 2.0, "bvi")]


def test_settings():
    from lectorium.sources import settings

    assert settings.number("JOB_QUEUE_MAXSIZE", {}) == 2000 and settings.number("JOB_QUEUE_MAXSIZE", {"JOB_QUEUE_MAXSIZE": "7"}) == 100 and settings.number("GOOGLE_API_RETRIES", {"GOOGLE_API_RETRIES": "x"}) == 5
    key = {"GOOGLE_DRIVE_API_KEY": "e"}
    assert settings.access('{"type": "service_account", "api_key": "a"}', key).kind == "service_account"
    assert settings.access('{"key": "k"}', key).value == "k" and settings.access('{"api_key": "a", "key": "k"}', key).value == "a"
    assert settings.access("no json", key).value == "e" and settings.access("[]", {}) is None and settings.access(None, {}) is None


def test_payloads(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"a": {"video_url": "u", "language": "vi", "request": {"beam": 5}}, "b": 3, "c": {}}')
    got = {r["job_id"]: (r["video_url"], r["language"], r["request"]) for r in stores.read_payload_store(spark, str(tmp_path / "p.json")).collect()}
    assert got == {"a": ("u", "vi", '{"beam":5}'), "c": (None, None, None)}
    (tmp_path / "q.json").write_text("{")
    assert stores.read_payload_store(spark, str(tmp_path / "q.json")).count() == 0


def test_course_arrays(spark, tmp_path):
    import json

    rows = spark.createDataFrame([(c, f"{k:03d}", f"t{k}", None if k else ["k"]) for c in ("a", "b/c") for k in range(5)], "course string, place string, text string, keywords array<string>").repartition(3)
    sinks.write_course_arrays(rows, str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("course=*/part-*"))
    assert len(files) == 2 and [json.loads(f.read_text()) for f in files] == [[{"text": f"t{k}", "keywords": None if k else ["k"]} for k in range(5)]] * 2
    sinks.append_collection(rows.limit(2), str(tmp_path / "all"))
    sinks.append_collection(rows.limit(3), str(tmp_path / "all"))
    assert spark.read.json(str(tmp_path / "all")).count() == 5


def test_small_helpers(spark):
    from lectorium.functions import urls
    from lectorium.operators import documents
    from lectorium.sources import transcripts

    row = spark.range(1).select(
        urls.folder_id(F.lit("https://drive.google.com/drive/folders/a-B_1?x")).alias("f"), urls.service_urls(F.lit("http://h/")).alias("s"), urls.service_urls(F.lit("http://h/chat/completions")).alias("t"),
        documents.local_pdf_name(F.lit('a:b.tar.gz')).alias("p"), transcripts.long_enough(F.lit("a " * 500)).alias("l"), urls.media_type(F.lit("x.vtt")).alias("m"),
    ).first()
    assert row["f"] == "a-B_1" and row["s"] == ["http://h/v1/chat/completions", "http://h/chat/completions", "http://h/chat"] and row["t"] == ["http://h/chat/completions"] and row["p"] == "ab.tar.pdf" and row["l"] and row["m"] == "text/vtt"
