"""Nodes: keywords, questions, quotes, near-duplicates, merging, sanitising, JSON, documents, jobs."""

import random

import pytest
from pyspark.sql import functions as F

from lectorium import lexicon as L
from lectorium.functions import json_text, urls
from lectorium.operators import documents, jobs, nodes


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_keywords(spark):
    assert one(spark, "tri thức khoa học và tri thức khoa học là nền tảng", nodes.infer_keywords)[:2] == ["tri thuc", "khoa hoc"]
    assert one(spark, "", nodes.infer_keywords) == []
    row = spark.createDataFrame([(["Tri thức", "không có", None, "Tri thức"], "Tri thức khoa học là nền tảng của xã hội", "chủ đề")], "k array<string>, t string, p string")
    got = row.select(nodes.validate_keywords(F.col("k"), F.col("t"), F.col("p")).alias("y")).first()["y"]
    assert got[0] == "Tri thức" and 3 <= len(got) <= 5


def test_questions(spark):
    row = spark.createDataFrame([(["Tri thức là gì", "tri thức là gì?", "ngắn?", None, "Hoàn toàn khác hẳn chuyện này?"], "Tri thức khoa học")], "q array<string>, t string")
    assert row.select(nodes.validate_questions(F.col("q"), F.col("t")).alias("y")).first()["y"] == ["Tri thức là gì?"]


def test_quote(spark):
    source = "Một câu mở đầu. Hai câu tiếp theo. Mạng nơ ron học sâu. Dữ liệu huấn luyện lớn. Câu cuối cùng đây."
    row = spark.createDataFrame([("mạng nơ ron học sâu dữ liệu huấn luyện", source), ("zzz qqq www", source), ("abc", "")], "t string, s string")
    got = [r["y"] for r in row.select(nodes.best_quote(F.col("t"), F.col("s")).alias("y")).collect()]
    assert got[0] == "Hai câu tiếp theo. Mạng nơ ron học sâu. Dữ liệu huấn luyện lớn." and got[1:] == ["", ""]


def _tokens(text):
    return set(text.split())


def _jac(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def _brute_pairs(rows):
    out = set()
    for g, i, a, ta in rows:
        for h, j, b, tb in rows:
            if g == h and i < j and a and b:
                s = _jac(_tokens(a), _tokens(b))
                ga, gb = ({x.replace(" ", "")[k : k + 4] for k in range(len(x.replace(" ", "")) - 3)} for x in (a, b))
                pa, pb = (_tokens(t) - set(L.STOPWORDS) for t in (ta, tb))
                if s >= 0.76 or (s >= 0.65 and _jac(ga, gb) >= 0.82) or (s >= 0.5 and pa and pb and _jac(pa, pb) >= 0.8):
                    out.add((g, i, j))
    return out


@pytest.fixture(scope="module")
def made():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(140):
        base = rnd.sample(vocabulary, 25) if not rows or rnd.random() < 0.4 else rnd.choice(rows)[2].split()
        words = [w if rnd.random() > 0.15 else rnd.choice(vocabulary) for w in base]
        rows.append((rnd.choice(["g", "h"]), f"n{k:03d}", " ".join(words), rnd.choice(["", "alpha beta", "alpha beta gamma"])))
    rows += [("g", "n900", rows[0][2], "alpha"), ("g", "n901", rows[0][2], "alpha"), ("g", "n902", "", "x"), ("h", "n903", None, "x")]
    return rows


def test_pairs_against_brute_force(spark, made):
    df = spark.createDataFrame(made, "course string, id string, text string, topic string").repartition(3)
    want = _brute_pairs([(g, i, a or "", t) for g, i, a, t in made])
    for hot in (nodes.HOT_KEY, 3):  # cut into blocks, and many nodes of one topic
        pairs, members = nodes.similar_pairs(df, ["course"], "id", hot=hot)
        head = {(r["course"], r["o"]): r["head"] for r in members.collect()}
        assert len(head) == sum(bool(a) for _, _, a, _ in made) and all(h <= o for (_, o), h in head.items())
        got = {(r["course"], r["i"], r["j"]) for r in pairs.collect()}
        apart = {(g, i, j) for g, i, j in want if head[g, i] != head[g, j]}
        assert got == {(g, i, j) for g, i, j in apart if head[g, i] == i and head[g, j] == j}
        assert {(g, *sorted((head[g, i], head[g, j]))) for g, i, j in apart} == got


def test_dedupe_against_greedy(spark, made):
    df = spark.createDataFrame(made, "course string, id string, text string, topic string").withColumn("key", F.lit("clash"))
    pairs = _brute_pairs([(g, i, a or "", t) for g, i, a, t in made])
    kept = []
    for g, i, a, _ in sorted(made, key=lambda r: r[1]):
        if a and not any((g, x, i) in pairs for h, x in kept if h == g):
            kept.append((g, i))
    for most, hot in ((nodes.MOST_LINKS, nodes.HOT_KEY), (0, 3)):
        got = nodes.dedupe(df, ["course"], "id", most_links=most, hot=hot)
        assert {(r["course"], r["id"]) for r in got.collect()} == set(kept)
    assert got.columns == df.columns


def test_chain_keeps_both_ends(spark):
    words = [f"w{i}" for i in range(40)]
    a, b, c = (" ".join(words[k : k + 30]) for k in (0, 4, 8))
    df = spark.createDataFrame([("g", "1", a, ""), ("g", "2", b, ""), ("g", "3", c, "")], "course string, id string, text string, topic string")
    assert {r["id"] for r in nodes.dedupe(df, ["course"], "id", threshold=0.76).collect()} == {"1", "3"}
    assert nodes.dedupe(df.limit(0), ["course"], "id").count() == 0


def test_merge(spark):
    def rows(n):
        return spark.createDataFrame([("f", i, f"câu số {i}", "mạng máy tính", "Theory", [f"q{i}?"]) for i in range(n)], "file_name string, id int, text string, topic string, category string, question_templates array<string>")

    assert nodes.merge_short(rows(3), ["file_name"], "id").count() == 3
    merged = nodes.merge_short(rows(4), ["file_name"], "id").collect()
    assert len(merged) == 1 and merged[0]["text"] == "câu số 0. câu số 1. câu số 2. câu số 3" and merged[0]["question_templates"] == ["q0?", "q1?", "q2?"]


def test_sanitize(spark):
    words = " ".join(f"khái{i}" for i in range(40)) + "."
    raw = lambda t: (t, "", None, None, None, None)
    chunks = spark.createDataFrame([("c", "f", "s", 0, words, [raw(words), raw(None), raw("ngắn"), None]), ("c", "f", "s", 1, None, [raw(words)]), ("c", "f", "s", 2, words, None)], f"course string, file_name string, subject string, chunk_idx int, chunk_text string, nodes array<{nodes.RAW}>")
    got = nodes.sanitize(chunks, provenance=True).collect()
    assert [(r["node_idx"], r["category"], r["has_code"], r["page"], r["source_coverage"]) for r in got] == [(0, "Theory", False, None, 1.0)]


def test_replies(spark):
    reply = 'Here: [{"text": "a", "metadata": {"topic": "t", "has_code": "yes", "keywords": ["k"]}}, 5, {"text": "b", "has_code": true},]'
    got = one(spark, reply, nodes.parsed_reply)
    assert [tuple(r) for r in got] == [("a", "t", None, ["k"], None, None), ("b", None, None, None, True, None)]
    assert one(spark, "sorry", nodes.parsed_reply) is None


def _file(rnd, n=60):
    return " ".join("Mạng " + " ".join(f"khái{rnd.randrange(900)}" for _ in range(9)) + "." for _ in range(n))


def test_failed_files_are_tried_again(spark, tmp_path):
    from lectorium.plans import pipelines

    rnd = random.Random(6)
    docs = spark.createDataFrame([(k, "c", f"f{k}", _file(rnd)) for k in range(3)], "doc_id long, course string, file_name string, text string")
    calls = []

    def flaky(chunks):
        calls.append(1)
        bad = F.col("file_name").startswith("f2") | (F.lit(len(calls) == 1) & F.col("file_name").startswith("f1"))
        return pipelines.extractive_nodes(chunks).withColumn("nodes", F.when(~bad, F.col("nodes")))

    want = {r["file_name"] for r in pipelines.transcript_nodes(docs).collect()}
    got = lambda n: {r["file_name"] for r in pipelines.transcript_nodes(docs, flaky, retries=n).collect()}
    assert want == {"f0/0", "f1/1", "f2/2"} and got(1) == {"f0/0", "f1/1"}
    calls.clear()
    assert got(0) == {"f0/0"}


def test_flow_against_plain_steps(spark):
    """The whole flow, and the same rules applied one after the other to lists."""
    from lectorium.functions import passages as P
    from lectorium.plans import pipelines

    rnd = random.Random(7)
    base = [_file(rnd, rnd.randint(3, 90)) for _ in range(8)]
    rows = [(k, rnd.choice(["c", None]), rnd.choice([None, "f"]), (t if k % 3 else t.replace("khái1", "khác1")) + " " + rnd.choice(base)[:900]) for k, t in enumerate(base * 2)] + [(90, "c", "f", None), (91, "c", "f", "")]
    want = []
    by_course: dict = {}
    for doc, course, name, t in rows:
        course, name = course or "_root", f"{name or ''}/{doc}"
        found = []
        for chunk, c in enumerate(P.transcript_chunks(t or "")):
            sents, source = P.sentences(c), P.Source(c)
            for n, i in enumerate(range(0, len(sents), 6)):
                x = P.clean_text(" ".join(sents[i : i + 6]))
                if P.drop_reason(x) == "keep" and P.gate(x, P.match_form(x), source.tokens):
                    found.append({"text": x, "topic": P.topic("", x), "category": "Theory", "question_templates": [], "place": (name, chunk, n)})
        distinct = lambda held: [held[i] for i in P.first_of_alike([P.Keyed(r["text"], r["topic"]) for r in held], 0.76)]
        by_course.setdefault(course, []).extend(distinct(P.merge_short(distinct(found))))
    for course, held in by_course.items():
        held.sort(key=lambda r: r["place"])
        want += [(course, r["place"][0], r["text"]) for r in distinct(held)]
    docs = spark.createDataFrame(rows, "doc_id long, course string, file_name string, text string").repartition(3)
    got = sorted((r["course"], r["file_name"], r["text"]) for r in pipelines.transcript_nodes(docs).collect())
    assert got == sorted(want) and got


@pytest.mark.parametrize(
    ("value", "want"),
    [('[{"a": 1}, 5, {"b": 2},]', ['{"a":1}', '{"b":2}']), ("no array", None), ("```json\n[]\n```", []), ('x [{"a": "[y]"}] z', ['{"a":"[y]"}']), (None, None)],
)
def test_elements(spark, value, want):
    assert one(spark, value, json_text.elements) == want


def test_repair(spark):
    assert one(spark, '```json\n[{"a": "b', json_text.repair) == '[{"a": "b"}]'
    assert one(spark, '[{"a": {"b": "c", ', json_text.repair) == '[{"a": {"b": "c"}]'
    assert one(spark, "none", json_text.repair) == "none"
    assert one(spark, '{"choices": [{"message": {"content": "x"}}], "text": "y"}', json_text.reply_text) == "x"
    assert one(spark, '{"response": "r", "text": "y"}', json_text.reply_text) == "r"


def test_urls(spark):
    ids = {u: one(spark, u, urls.drive_id) for u in ("gdrive://file/ab", "https://drive.google.com/drive/folders/F1?x=1", "https://drive.google.com/file/d/Q2/view", "https://drive.google.com/open?a=1&id=Z3&b=2", "https://a.b/c")}
    assert [tuple(v) if v else None for v in ids.values()] == [("file", "ab"), ("folder", "F1"), ("file", "Q2"), ("file", "Z3"), None]
    assert one(spark, "https://h.x/a/my file.tar.gz?q", lambda c: urls.base_name(c, F.lit("z"))) == "my_file.tar"
    assert one(spark, "https://h.x/live.M3U8", urls.route) == "stream"


LISTING = "id string, parent_id string, name string, mime_type string, trashed boolean, target_id string, target_mime string"


def test_walk_and_climb(spark):
    folder, short = "application/x-folder", "application/x-shortcut"
    rows = [
        ("r", None, "Kho", folder, False, None, None),
        ("m", "r", "Môn Học máy", folder, False, None, None),
        ("s", "m", "Slides", folder, False, None, None),
        ("p", "s", "Tuần 1", folder, False, None, None),
        ("f", "p", "A.DOCX", None, False, None, None),
        ("f", "p", "A.DOCX", None, False, None, None),
        ("t", "p", "b.pdf", "application/pdf", True, None, None),
        ("k", "p", "back", short, False, "m", folder),
        ("g", "m", "v.mp4", "video/mp4", None, None, None),
        ("x", "gone", "Bài giảng", folder, False, None, None),
    ]
    listing = spark.createDataFrame(rows, LISTING)
    got = {(r["path"], r["route"]) for r in documents.walk(listing).collect()}
    assert ("Kho/Môn Học máy/Slides/Tuần 1/A.DOCX", "office") in got and ("Kho/Môn Học máy/v.mp4", "skip") in got
    assert not any("b.pdf" in p for p, _ in got) and all(p.count("back") <= 1 for p, _ in got)
    subject = {r["id"]: r["subject"] for r in documents.subjects(listing).collect()}
    assert subject["p"] == subject["s"] == "Môn Học máy" and subject["r"] == "Kho" and subject["x"] == L.NO_SUBJECT
    assert documents.walk(listing.limit(0)).count() == 0


def test_walk_of_any_depth(spark):
    folder = "application/x-folder"
    rows = [(f"d{i}", f"d{i - 1}" if i else None, f"n{i}", folder, False, None, None) for i in range(66)] + [("f", "d65", "a.pdf", None, False, None, None)]
    got = documents.walk(spark.createDataFrame(rows, LISTING)).collect()
    assert [(r["id"], r["level"]) for r in got] == [("f", 66)]


def test_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from lectorium.operators import storage

    session = lambda master, named: SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": named}))
    assert storage.shared_folder(session("spark://h:1", "hdfs://x")) == "hdfs://x" and storage.shared_folder(session("local[4]", None))
    with pytest.raises(ValueError):
        storage.shared_folder(session("yarn", None))


def test_jobs(spark):
    from datetime import datetime

    rows = [("a", "queued", datetime(2025, 1, 1), None, None), ("a", "completed", datetime(2025, 1, 2), None, None), ("b", "processing", datetime(2025, 1, 1), None, None), ("c", "queued", None, None, None), ("c", "queued", None, None, None), (None, "queued", None, None, None)]
    table = spark.createDataFrame(rows, "job_id string, status string, updated_at timestamp, progress string, error string")
    assert {(r["job_id"], r["status"]) for r in jobs.latest(table).collect()} == {("a", "completed"), ("b", "processing"), ("c", "queued")}
    payloads = spark.createDataFrame([("b",)], "job_id string")
    assert {(r["job_id"], r["action"]) for r in jobs.recover(jobs.latest(table), payloads).collect()} == {("b", "requeue"), ("c", "fail")}


def test_stream_restart(spark, tmp_path):
    from datetime import datetime

    from lectorium.streaming.jobs import run_to_end

    schema = "job_id string, status string, updated_at timestamp, progress string, error string"
    path, state = str(tmp_path / "jobs"), str(tmp_path / "state")
    spark.createDataFrame([("a", "queued", datetime(2025, 1, 1), None, None), ("b", "queued", datetime(2025, 1, 5), None, None)], schema).write.parquet(path)
    assert {(r["job_id"], r["status"]) for r in run_to_end(spark, path, state).collect()} == {("a", "queued"), ("b", "queued")}
    spark.createDataFrame([("a", "completed", datetime(2025, 1, 2), None, None), ("b", "processing", datetime(2025, 1, 4), None, None)], schema).write.mode("append").parquet(path)
    assert {(r["job_id"], r["status"]) for r in run_to_end(spark, path, state).collect()} == {("a", "completed"), ("b", "queued")}


def test_nodes_do_not_depend_on_partitions(spark):
    from lectorium.plans import pipelines

    rnd = random.Random(5)
    text = " ".join("Mạng " + " ".join(f"khái{rnd.randrange(900)}" for _ in range(9)) + "." for _ in range(60))
    docs = spark.createDataFrame([(k, "c", "f", text if k % 2 else text.replace("mạng", "đồ thị")) for k in range(4)], "doc_id long, course string, file_name string, text string")
    a, b = (sorted(r["id"] for r in pipelines.transcript_nodes(docs.repartition(n)).collect()) for n in (1, 5))
    assert a == b and a


def test_merge_short_without_file_name(spark, monkeypatch):
    from lectorium.plans import catalogue

    rows = spark.createDataFrame([(f"n{i}", "Một câu ngắn.", "t", "Theory", None, "s", None) for i in range(5)], "id string, text string, topic string, category string, question_templates array<string>, subject string, file_name string")
    monkeypatch.setattr(catalogue, "_nodes", lambda spark, d: rows)
    got = catalogue.merge_short(spark, "").collect()
    assert {(r["id"], r["file_name"], r["text"]) for r in got} == {(f"n{i}", None, "Một câu ngắn.") for i in range(5)}


def test_flow_keeps_little_on_disk(spark):
    """Intermediate data of the whole flow, with all its checkpoints, stays near the size of the texts."""
    from pathlib import Path

    from lectorium.operators.storage import kept
    from lectorium.plans import pipelines

    rnd = random.Random(11)
    texts = [_file(rnd, 40) for _ in range(120)]
    docs = kept(spark.createDataFrame([(k, "c", None, t) for k, t in enumerate(texts)], "doc_id long, course string, file_name string, text string"))
    folder = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    size = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    before = size()
    assert pipelines.transcript_nodes(docs).count() > 120
    assert size() - before < 1.5 * sum(len(t.encode()) for t in texts)


def test_texts_of_one_file_name_are_one_file(spark):
    """Documents without an id share their file's name: their nodes are decided together."""
    from lectorium.plans import pipelines

    rnd = random.Random(12)
    a, b = _file(rnd, 30), _file(rnd, 30)
    rows = [(None, "c", "f", a), (None, "c", "f", a), (None, "c", "f", b), (None, "c", "f", None), (1, "c", "f", b)]
    got = pipelines.transcript_nodes(spark.createDataFrame(rows, "doc_id long, course string, file_name string, text string")).collect()
    assert len({r["text"] for r in got}) == len(got) == 10 and {r["file_name"] for r in got} == {"f"}


def test_rows_by_keys(spark):
    from lectorium.operators import storage

    df = storage.pressed(spark.range(5000).selectExpr("id % 7 AS g", "cast(id AS string) AS o", "IF(id % 3 = 0, NULL, array(id)) AS a", "cast(NULL AS int) AS z").repartition(3))
    keys = spark.range(0, 5000, 11).selectExpr("id % 7 AS g", "cast(id AS string) AS o")
    for few in (storage.FEW_KEYS, 0):
        inside, outside = storage.among(df, keys, ["g", "o"], few), storage.without(df, keys, ["g", "o"], few)
        assert {int(r["o"]) for r in inside.collect()} == set(range(0, 5000, 11))
        assert {int(r["o"]): r["a"] for r in outside.collect()} == {i: None if i % 3 == 0 else [i] for i in range(5000) if i % 11}
    assert storage.pressed(df.limit(0)).count() == 0 and storage.without(df, keys.limit(0), ["g", "o"], 0).count() == 5000
