"""Hand-worked cases of the text functions."""

import random

import pytest
from pyspark.sql import functions as F

from lectorium.functions import passages
from lectorium.functions import text as T
from lectorium.operators import chunking, quality, segments


@pytest.fixture(scope="module")
def run(spark):
    def one(value, f):
        return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]

    return one


@pytest.mark.parametrize(
    ("value", "want"),
    [("  a 　b \n c ", "a b c"), ("", ""), ("​", "​"), (None, None)],
)
def test_spaces(run, value, want):
    assert run(value, T.normalize_spaces) == want


@pytest.mark.parametrize(("value", "want"), [("3.14", "3. 14"), ("a , b !!", "a, b!"), ("so...on", "so. on"), ("ok ??", "ok?")])
def test_punctuation(run, value, want):
    assert run(value, T.normalize_punctuation) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("đối tượng", "oi tuong"), ("marx lenin", "marx enin"), ("marx-lenin", "marx lenin"), ("Chi Thuc mới", "tri thuc moi"), ("chi thức", "chi thuc"), ("ệ́", "e"), ("", "")],
)
def test_match_form(run, value, want):
    assert run(value, T.match_form) == want


def test_repeats(run):
    assert run("a A a b", T.collapse_repeats) == "a A b"
    assert run("haaaaa haaaaaa", T.collapse_repeats) == "haaaaa ha"
    assert run("", T.collapse_repeats) == ""


def test_timestamp(spark):
    row = spark.createDataFrame([(1.001, 3661.5)], "a double, b double").select(T.timestamp(F.col("a")).alias("a"), T.timestamp(F.col("b"), vtt=True).alias("b")).first()
    assert (row["a"], row["b"]) == ("00:00:01,000", "01:01:01.500")


def test_sentences(run):
    assert run("A b. C d? E", T.sentences) == ["A b.", "C d?", "E"]
    long = " ".join(["w"] * 50) + ", " + " ".join(["v"] * 50)
    assert run(long, T.sentences) == [" ".join(["w"] * 50), " ".join(["v"] * 50)]
    assert run("", T.sentences) == []


@pytest.mark.parametrize(("value", "want"), [("Theory", "Theory"), ("Algorithm", "Theory"), ("Ví dụ", "Theory"), ("showcase", "Example"), ("Steps", "Process"), (None, "Theory")])
def test_category(run, value, want):
    assert run(value, T.category) == want


def test_code(run):
    assert run("if you see", T.contains_code) and run("f(x) == 1", T.contains_code) and not run("a == b", T.contains_code)


@pytest.mark.parametrize(
    ("value", "want"),
    [
        (" ".join(f"w{i}" for i in range(10)) + ".", "short"),
        (" ".join(f"w{i}" for i in range(11)) + ".", "keep"),
        (" ".join(f"w{i}" for i in range(18)), "unpunctuated"),
        (" ".join(f"w{i}" for i in range(40)) + " quan trọng", "orphan"),
        ("a b. " * 20, "repetitive"),
        (" ".join(f"w{i}" for i in range(20)) + " va", "incomplete"),
        ("", "empty"),
        (None, "empty"),
    ],
)
def test_drop_reason(run, value, want):
    assert run(value, quality.drop_reason) == want


def test_noise(run):
    assert passages.noise_token("x") and passages.noise_token("bcd")
    assert not passages.noise_token("tuong") and not passages.noise_token("theory")
    assert run("oi tuong", quality.valid_keyword) and not run("cua", quality.valid_keyword)


def test_chunks(run):
    text = " ".join(f"s{i} a b c d." for i in range(10))
    parts = run(text, lambda x: chunking.transcript_chunks(x, 10, 15, 5))
    assert parts[0] == "s0 a b c d. s1 a b c d. s2 a b c d."
    assert parts[1].startswith("s2 a b c d. s3")
    assert all(len(p.split()) <= 15 for p in parts)
    assert run(" ".join(["w"] * 40) + ".", lambda x: chunking.transcript_chunks(x, 5, 15, 5)) == [" ".join(["w"] * 15), " ".join(["w"] * 15), " ".join(["w"] * 9 + ["w."])]
    assert run("", lambda x: chunking.transcript_chunks(x, 5, 15, 5)) == []


def test_packing_against_a_plain_walk():
    def walk(sizes, most, least, overlap):
        out, cur = [], []
        for i, n in enumerate(sizes):
            held = sum(sizes[k] for k in cur)
            if cur and held + n > most and held >= least:
                out.append((cur[0], cur[-1] + 1))
                tail = []
                while overlap and cur and sum(sizes[k] for k in tail) < overlap:
                    tail.insert(0, cur.pop())
                cur = tail
            cur.append(i)
        return [*out, (cur[0], cur[-1] + 1)] if cur else out

    rnd = random.Random(1)
    for _ in range(2000):
        sizes = [rnd.randint(1, 20) for _ in range(rnd.randint(0, 40))]
        given = (sizes, rnd.randint(20, 60), rnd.choice([0, rnd.randint(0, 60)]), rnd.choice([0, rnd.randint(1, 30)]))
        assert passages.packed(*given) == walk(*given)


def test_plain_forms_are_those_of_the_columns(spark):
    rnd = random.Random(2)
    parts = ["Mac Le Nin", "triết học", "clip classroom", "  ", "\u00a0", "\t", "3.14", "!!", "..", "A,b", " ;", "ĐỐI tượng", "é", "maclean", "x=1", "漢字", "\u2028", "?"]
    texts = ["", *("".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randint(1, 9))) for _ in range(300))]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    forms = {"match_form": T.match_form, "normalize_spaces": T.normalize_spaces, "normalize_punctuation": T.normalize_punctuation, "normalize_terms": T.normalize_terms, "sentences": T.sentences, "category": T.category, "contains_code": T.contains_code}
    for row in df.select("x", *(f(F.col("x")).alias(k) for k, f in forms.items())).collect():
        for k in forms:
            assert getattr(passages, k)(row["x"]) == row[k], (k, row["x"])


def test_long_texts_take_linear_time(spark):
    long = " ".join(f"từ{i} khác." for i in range(60_000))
    assert len(passages.distinct_sentences(passages.sentences(long))) == 60_000 and len(passages.transcript_chunks(long)) > 80
    assert len(passages.infer_keywords(passages.match_form(long))) == 5
    assert passages.Source(long).quote(passages.match_form("từ59999 khác")).startswith("từ59997")


def test_parts(run):
    assert run("a b c", lambda x: chunking.oversized_parts(x, 3)) == ["a b c"]
    assert run("a b. c d. e f.", lambda x: chunking.oversized_parts(x, 4)) == ["a b. c d.", "e f."]


def _seg(spark, rows):
    return spark.createDataFrame(rows, "media_id string, seg_idx int, start_sec double, end_sec double, text string")


def test_verdicts(spark):
    rows = [("m", 0, 0.0, 0.49, "abc def"), ("m", 1, 0.0, 0.5, "abc def"), ("m", 2, 0.0, 30.0, "một câu khá dài ở đây"), ("m", 3, 0.0, 30.01, "x y"), ("m", 4, 0.0, 9.0, "123456789"), ("m", 5, 0.0, 2.0, "a" * 10), ("m", 6, 0.0, 2.0, "a" * 11), ("m", 7, 0.0, 2.0, "a b c d e a"), ("m", 8, 0.0, 2.0, "  "), ("m", 9, None, 2.0, "x"), ("m", 10, 0.0, 2.0, None), ("m", 11, 0.0, 2.0, "Hãy đăng ký kênh")]
    got = {r["seg_idx"]: r["verdict"] for r in segments.verdict(_seg(spark, rows)).collect()}
    assert got == {0: "duration", 1: "keep", 2: "keep", 3: "duration", 4: "short_text", 5: "keep", 6: "hallucination", 7: "hallucination", 8: "blank", 9: "duration", 10: "blank", 11: "hallucination"}


def test_cues(spark):
    words = " ".join(["abcdefg"] * 24)
    got = segments.cues(_seg(spark, [("m", 0, 1.0, 2.5, words), ("m", 1, 0.0, 1.0, "short")])).orderBy("seg_idx", "cue_idx").collect()
    first = [r for r in got if r["seg_idx"] == 0]
    assert " ".join(r["cue_text"] for r in first) == "abcdefg abcdefg"  # equal words: two are left
    long = " ".join(f"word{i:02d}" for i in range(24))
    got = segments.cues(_seg(spark, [("m", 0, 0.0, 1.5, long)])).orderBy("cue_idx").collect()
    assert len(got) == 3 and got[2]["cue_start"] == 2.0 and got[2]["cue_end"] == 1.5
    assert " ".join(r["cue_text"] for r in got) == long


def test_delivery_and_order(spark):
    from datetime import datetime

    df = spark.createDataFrame([("m", 0, 0.0, 1.0, "old", datetime(2025, 1, 1)), ("m", 0, 0.0, 1.0, "new", datetime(2025, 1, 2)), ("m", 5000, 0.0, 1.0, "b", None), ("m", 7, 0.0, 1.0, "a", None), (None, 1, 0.0, 1.0, "x", None)], "media_id string, seg_idx int, start_sec double, end_sec double, text string, ingested_at timestamp")
    once = segments.delivered_once(df)
    assert {(r["seg_idx"], r["text"]) for r in once.collect()} == {(0, "new"), (5000, "b"), (7, "a")}
    assert {(r["seg_idx"], r["ordinal"]) for r in segments.with_ordinal(once).collect()} == {(0, 0), (7, 1), (5000, 2)}


def test_refinements(spark):
    seg = _seg(spark, [("m", i, float(i), i + 1.0, f"text {i}") for i in range(4)])
    replies = spark.createDataFrame([("m", 0, 0, "first"), ("m", 1, 0, "last"), ("m", 2, 1, "no"), ("m", 3, 2, " "), ("m", 4, None, "lost")], "media_id string, pos int, id int, text string")
    got = {r["seg_idx"]: (r["text"], r["is_refined"]) for r in segments.apply_refinements(seg, replies).collect()}
    assert got == {0: ("last", True), 1: ("text 1", False), 2: ("text 2", False), 3: ("text 3", False)}


def test_contexts(spark):
    seg = _seg(spark, [("m", i, 0.0, 1.0, f"t{i}") for i in range(45)])
    got = {r["batch"]: r["context"] for r in segments.batch_contexts(seg).collect()}
    assert got == {0: "", 1: "t15 t16 t17 t18 t19", 2: "t35 t36 t37 t38 t39"}


def test_refinement_in_order(spark):
    seg = _seg(spark, [("m", i, 0.0, 1.0, f"t{i}") for i in range(45)] + [("n", i, 0.0, 1.0, f"u{i}") for i in range(3)] + [("o", 0, 0.0, 1.0, None)]).repartition(3)
    seen = lambda texts, context: [f"{t}' <{context}>" if t != "t1" else None for t in texts]
    got = {(r["media_id"], r["seg_idx"]): (r["text"], r["is_refined"]) for r in segments.refined_in_order(seg, seen, 20, 2).collect()}
    assert got["m", 0] == ("t0' <>", True) and got["m", 1] == ("t1", False) and got["m", 20] == ("t20' <t18' <> t19' <>>", True)
    assert got["m", 40][0] == "t40' <t38' <t18' <> t19' <>> t39' <t18' <> t19' <>>>" and got["n", 2] == ("u2' <>", True) and len(got) == 49


def test_partial_updates_and_deletion(spark):
    from datetime import datetime

    from lectorium.operators import jobs

    day = lambda d: datetime(2025, 1, d)
    rows = [("a", "queued", None, None, day(1)), ("a", None, "half", None, day(2)), ("a", "completed", None, None, day(3)), ("b", None, "lost", None, day(1)), ("c", "queued", "x", None, day(1)), ("c", None, "late", None, day(4)), ("d", "queued", None, None, day(1)), ("d", "queued", None, None, day(1)), ("d", "queued", "again", None, day(5)), (None, "queued", None, None, day(1))]
    updates = spark.createDataFrame(rows, "job_id string, status string, progress string, error string, updated_at timestamp")
    gone = spark.createDataFrame([("c", day(3)), ("d", day(3))], "job_id string, deleted_at timestamp")
    got = {r["job_id"]: (r["status"], r["progress"]) for r in jobs.merged(updates, gone).collect()}
    assert got == {"a": ("completed", "half"), "d": ("queued", "again")}
    assert {r["job_id"]: r["progress"] for r in jobs.merged(updates).collect()} == {"a": "half", "c": "late", "d": "again"}
