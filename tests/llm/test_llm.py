"""Problems 1 to 10: edge cases with defined results, and brute force on small fixtures."""

import random
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectorium.llm import p1_quality, p2_repetition, p3_markup, p4_near, p5_canonical, p6_turns, p7_forms, p8_encode, p9_leaks, p10_residue
from lectorium.llm.arrow_text import fold, word_runs

PROSE = "Với 128 nhóm sinh viên, giả thuyết này được kiểm chứng theo quan điểm của nhà thiết kế. Nếu bảng băm bị khóa thì tiến trình sẽ dừng lại sau hữu hạn bước."


def docs(spark, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, kind string, words int")


LISTED = "\n".join(f"{i}. bộ lọc mềm dẻo" for i in range(30))


def test_p1(spark, tmp_path):
    texts = [PROSE, LISTED, None, "", " \n ", PROSE + "\n1. một\n2. hai", "\n".join(["Mạng máy tính | 3 | 4"] * 20).replace("|", "\t"), "74 de76 55 71 49 dd73 24cf " * 20, PROSE.lower().replace(".", "").replace(",", ""), PROSE.encode().decode("latin-1") * 3, "https://a.b/c?p=1\n" * 9, PROSE * 2000, LISTED]
    docs(spark, texts * 1).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r[0] for r in p1_quality.p1_found(spark, str(tmp_path)).collect()} == {1, 6, 7, 9, 10, 12}
    stats = p1_quality.p1_statistics(spark, str(tmp_path))
    assert stats.count() == 10 and {r["language"] for r in stats.collect()} <= {"vi", "en"}
    assert p1_quality.p1_percentiles(spark, str(tmp_path)).where("statistic = 'outside_share'").count() >= 1


def test_p1_junk_source(spark, tmp_path):
    rnd = random.Random(7)
    english = "The model is trained on all of the data that we have, and it can be used by anyone who needs it."
    junk = [" ".join("".join(rnd.choice("0123456789abcdef") for _ in range(rnd.choice([2, 4]))) for _ in range(120)) for _ in range(75)]
    docs(spark, [PROSE] * 100 + [english] * 50 + junk).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r[0] for r in p1_quality.p1_found(spark, str(tmp_path)).collect()} == set(range(150, 225))
    scores = p1_quality.p1_statistics(spark, str(tmp_path)).where("doc_id >= 150").select(F.min("z_outside_share")).first()[0]
    assert scores > p1_quality.TAIL_Z


def test_p1_junk_only(spark, tmp_path):
    docs(spark, ["74 de76 55 71 49 dd73 24cf " * 20] * 40).write.parquet(f"{tmp_path}/documents.parquet")
    assert p1_quality.p1_found(spark, str(tmp_path)).count() == 40


def test_p2():
    share = lambda t: p2_repetition.repeated_share(p2_repetition.counted_words(t))
    assert share("") == 0 and share("một") == 0
    assert share("mở. mở. mở. mở. mở. mở") > 0.5
    assert share("Với 5 bản ghi, tiên đề tắt 1\n2. Với 5 bản ghi, tiên đề tắt\n3. VỚI 5 BẢN GHI tiên đề tắt") > 0.6
    assert share("rất rất hay và rất rất đẹp nhé các bạn ơi") < 0.5
    assert share(PROSE) < 0.2


def test_p2_band_loses_nothing(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(400):
        base = [rnd.choice("ánh sáng mạng học sâu dữ liệu the of neural net 12 7".split()) + rnd.choice(["", "a", "ng"]) for _ in range(rnd.randint(1, 30))]
        loop = base[: rnd.randint(1, 6)] * rnd.randint(0, 6)
        rows.append(("m", k, " ".join(base + loop)))
    df = spark.createDataFrame([*rows, ("m", 900, None), ("m", 901, ""), ("m", 902, "...")], "media_id string, seg_idx int, text string")
    got = {r["seg_idx"] for r in p2_repetition.fertility(df, ["media_id", "seg_idx"], "text", suspects_only=True).where("repeated_share >= 0.5").collect()}
    want = {k for _, k, t in rows if p2_repetition.repeated_share(p2_repetition.counted_words(t)) >= 0.5}
    assert got == want and want


def test_p2_shares_of_every_segment(spark, tmp_path):
    words = "the model learns from many old pages while her small team keeps every second note about water and light under one open roof near our house".split()
    texts = [" ".join(words), " ".join(words + words[:6]), "mở. mở. mở. mở", "một", "...", " \n", "", None]
    rows = [("m", k, t) for k, t in enumerate(texts)]
    spark.createDataFrame([*rows, rows[1], rows[-1]], "media_id string, seg_idx int, text string").write.parquet(f"{tmp_path}/segments.parquet")
    got = {r["seg_idx"]: r for r in p2_repetition.p2_shares(spark, str(tmp_path)).collect()}
    want = {k: p2_repetition.repeated_share(p2_repetition.counted_words(t or "")) for _, k, t in rows}
    assert {k: r["repeated_share"] for k, r in got.items()} == want and 0 < want[1] < 0.5
    assert got[1]["entropy"] > got[1]["band"] and [got[k]["n_words"] for k in range(4, 8)] == [0] * 4 and got[7]["entropy"] is None
    bands = p2_repetition.p2_bands(spark, str(tmp_path)).collect()
    assert sum(r["n"] for r in bands) == 5 and sum(r["n_in_band"] for r in bands) == 2
    assert [tuple(r) for r in p2_repetition.p2_found(spark, str(tmp_path)).collect()] == [("m", 2)]


@pytest.mark.parametrize("text", ["<p>x</p>", "a &nbsp; b", "# Tiêu đề", "**đậm** nhé", "một *từ* thôi", "- mục\n- hai", "[x](https://a.b)", "`mã`", "~~cũ~~", "> trích", "| a | b |\n|---|---|", "[[Trang|tên]]", "{{Hộp|a=1}}", "'''đậm'''", "== Mục ==", "=== Mục ==", r"\textbf{x}", r"$x^2 + y$", r"$$\frac{a}{b}$$", r"\begin{a}", r"\sum_{i=1}^{n} x_{i}", "```\nx\n```", "__đậm__", "một<br/>hai"])
def test_p3_markup(text):
    assert p3_markup.pieces(text)


@pytest.mark.parametrize("text", ["", "x = a[i] + g(i)", "for (int i = 0; i < n; i++) { tong += i; }", "Khi a < b và c > d", "2 * 3 * 4", "C# và F#", r"C:\bai_giang\tuan_3", "so_luong_toi_da", "từ 5 $ lên 9 $ thôi", "Map<K, V>", "R&D", "tài liệu [3]", "p -> next", "x == y", "f(x) = x^2 - 4x + 1", "__init__", "3 : 2 và > 40 %", "a | b"])
def test_p3_plain(text):
    assert not p3_markup.pieces(text)


def test_p3_clean(spark):
    page = "<h2>Mở đầu</h2><p>Câu một &amp; hai.</p><ul><li>mục</li></ul>{{Hộp|a=1}} $x^2$ **đậm** [a](https://b.c)\n\n```\ncode\n```"
    df = spark.createDataFrame([("1", page, "h", "clash"), ("2", None, "h", ""), ("3", "", None, ""), ("4", PROSE, None, "")], "id_ string, text string, host string, clean string")
    got = {r["id_"]: r for r in p3_markup.cleaned(df, "id_", "text", "host").collect()}
    assert got["1"]["clean"] == "## Mở đầu\n\nCâu một & hai.\n\n- mục\n\n $x^2$ đậm a\n\n```\ncode\n```" and got["1"]["dropped"] == ["template.hộp"]
    assert got["2"]["clean"] is None and got["3"]["clean"] == "" and got["4"]["clean"] == PROSE and got["4"]["n_html"] == 0


def test_p3_found_by_the_vote(spark):
    code = "y = f(x) *a* g(b);"
    rows = [("1", code, "h"), ("2", code + "\n" + code, "h"), ("3", "một *từ* thôi", "h"), ("4", "một *từ* thôi", "i"), ("5", "một *từ* thôi", "i"), ("6", code, "i"), ("7", "<p>x</p>", "h"), ("7", "<p>x</p>", "h"), ("8", None, "h"), ("9", "", None), ("10", "<b>x</b>", None), ("11", PROSE, "h")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id_ string, text string, host string, path string").repartition(3)
    got = sorted(r["id_"] for r in p3_markup.affected(df, "id_", "text", "host").collect())
    assert got == ["10", "4", "5", "6", "7"]  # emphasis lost on h, where mostly code speaks of it, and won on i
    assert p3_markup.affected(df.limit(0), "id_", "text", "host").count() == 0


def near(spark, texts, threshold=0.7, **more):
    df = spark.createDataFrame([(f"n{i:03d}", t, i) for i, t in enumerate(texts)], "id string, text string, k1 int").repartition(3)
    members, pairs = p4_near.near_classes(df, "id", "text", threshold, **more)
    own = {r["id"]: (r["k1"], r["k2"]) for r in members.collect()}
    linked = {frozenset([(r["k1"], r["k2"]), (r["j1"], r["j2"])]) for r in pairs.collect()}
    return {(a, b) for a in own for b in own if a < b and (own[a] == own[b] or frozenset([own[a], own[b]]) in linked)}


def test_p4_against_brute_force(spark):
    rnd = random.Random(2)
    words = [f"từ{i}" for i in range(80)]
    texts = []
    for _ in range(160):
        base = rnd.sample(words, rnd.randint(1, 40)) if not texts or rnd.random() < 0.4 else rnd.choice(texts).split()
        texts.append(" ".join(w if rnd.random() > 0.12 else rnd.choice(words) for w in base))
    texts += [None, "", " . ", texts[0].upper(), "đi", "ĐI!", "di", "dài " * 3000 + "x"]
    sets = [{fold(w) for w in word_runs(t or "")} for t in texts]
    want = {(f"n{i:03d}", f"n{j:03d}") for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and a and b and len(a & b) >= 0.7 * len(a | b)}
    assert near(spark, texts) == want
    assert near(spark, texts, leaf_pairs=64, shard=8) == want  # a deep tree, and leaves cut into shards


def test_p4_tree_places_partners_in_reach():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rnd.sample(words, rnd.randint(1, 30))) for _ in range(300)]
    tree = p4_near.Tree(texts, 300, 0.7, leaf_pairs=900)
    hashes, bounds = p4_near.word_sets(texts, p4_near.Memo(p4_near._hash))
    leaf, visits = tree.places(hashes, bounds)
    sets = [set(t.split()) for t in texts]
    assert tree.leaves > 3 and len(set(leaf)) > 3
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if len(b) <= len(a) and len(a & b) >= 0.7 * len(a | b):
                assert i in visits[leaf[j]]


def test_p4_many_copies(spark, tmp_path, monkeypatch):
    """Classes of many copies are met in several lots, with the same pairs."""
    monkeypatch.setattr(p4_near, "COPIES", 3)
    base = [f"từ{i}" for i in range(20)]
    texts = [" ".join(base)] * 11 + [" ".join(reversed(base[2:]))] * 8 + ["khác hẳn mọi câu"] * 5 + [None, ""]
    rows = [(f"n{i:02d}", t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows + rows[:4], "id string, text string").repartition(3).write.parquet(f"{tmp_path}/nodes.parquet")
    sets = {i: set(t.split()) for i, t in rows if t}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b])}
    got = [tuple(r) for r in p4_near.p4_found(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(r)[:2] for r in p4_near.p4_pairs(spark, str(tmp_path)).collect()} == {("n00", "n11")}
    assert {(r["id"], r["class_id"], r["n_links"]) for r in p4_near.p4_classes(spark, str(tmp_path)).collect()} >= {("n10", "n00", 1), ("n18", "n11", 1), ("n23", "n19", 0)}


def test_p4_empty(spark):
    assert near(spark, []) == set() and near(spark, ["a b c"]) == set() and near(spark, ["a b", "b a"]) == {("n000", "n001")}


def test_p5():
    m = p5_canonical.Matcher([("S1", "Học máy", ["Machine Learning"]), ("S2", "Giải tích 1", ["GT1"]), ("S3", "Giải tích 2", ["GT2"]), ("S4", "Mạng máy tính", None)])
    for value, want in [("hoc may", "S1"), ("Môn Học máy", "S1"), ("[học máy] (K65)", "S1"), ("Họ cmáy", "S1"), ("MACHINE LEARNING", "S1"), ("gt2", "S3"), ("Giải tích", "none"), ("Bơi lội", "none"), ("Giải tích 1 - học kỳ II", "S2"), ("Mạng may tíhn_bản mới", "S4"), ("???", "none"), ("Học máy / Mạng máy tính", "none")]:
        assert m.match(value)[0] == want, value


def test_p5_against_edit_distance():
    def distance(a, b):
        d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rnd = random.Random(4)
    names = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(3, 14))) for _ in range(40)]
    trie = p5_canonical.Trie()
    for n in names:
        trie.add(n, n)
    for _ in range(300):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(2, 14)))
        most = p5_canonical.most_edits(len(word))
        want = {n: distance(n, word) for n in names if distance(n, word) <= min(most, p5_canonical.most_edits(len(n)))}
        assert trie.search(word, most) == want


def test_p5_rows(spark):
    values = spark.createDataFrame([("subject", "Hoc may", 1), ("subject", None, 1), ("subject", " ", 1), (None, "x", 1), ("other", "x", 1), ("subject", "Hoc may", 2)], "field string, value string, near int")
    entries = spark.createDataFrame([("S1", "subject", "Học máy", None), ("S1", "subject", "Học máy", None), ("S2", "subject", None, None)], "ref_id string, field string, entry string, aliases array<string>")
    assert {(r["field"], r["value"], r["ref_id"]) for r in p5_canonical.canonical(values, entries, "field", "value").collect()} == {("subject", "Hoc may", "S1"), ("other", "x", "none")}


#: Values written for this test after the rules, none of them taken from the tables.
NEW_VALUES = [
    ("Tài liệu Học máy 2023", "S1"), ("Lecture notes: machine learning", "S1"), ("học  máy (lớp A2)", "S1"), ("HOC MAY - bo mon CNTT", "S1"), ("Tổng hợp đề thi Học máy", "S1"), ("Machin Learnig", "S1"), ("ôn tập gt1", "S2"), ("Giải tích 1 - phần đầu", "S2"),
    ("Mang may tinhh", "S4"), ("mạng-máy-tính", "S4"), ("Sách Mạng máy tính tập 2", "S4"), ("Học máy / Mạng máy tính", "none"), ("Học máy, GT1", "none"), ("Giải tích", "none"), ("Lịch sử nghệ thuật", "none"), ("chưa đặt tên", "none"), ("??", "none"), ("Học", "none"), ("máy", "none"), ("G T 1", "none"),
]


def test_p5_new_wording():
    m = p5_canonical.Matcher([("S1", "Học máy", ["Machine Learning"]), ("S2", "Giải tích 1", ["GT1"]), ("S3", "Giải tích 2", ["GT2"]), ("S4", "Mạng máy tính", None)])
    wrong = [(v, m.match(v)[0]) for v, want in NEW_VALUES if m.match(v)[0] != want]
    assert len(wrong) <= 1, wrong


def test_p5_blocks_agree(spark):
    rnd = random.Random(11)
    words = ["mạng", "máy", "tính", "học", "sâu", "dữ", "liệu", "giải", "tích", "một"]
    names = sorted({" ".join(rnd.sample(words, rnd.randint(1, 3))) for _ in range(60)})
    entries = spark.createDataFrame([(f"R{i:02d}", "subject", n, [f"a{i}"] if i % 3 else None) for i, n in enumerate(names)], "ref_id string, field string, entry string, aliases array<string>")
    typed = [*names[:9], "", "zzz", *(rnd.choice(["môn ", "", "x y "]) + "".join(c for c in rnd.choice(names) if rnd.random() > 0.05) + rnd.choice(["", " k65", " / " + rnd.choice(names)]) for _ in range(80))]
    values = spark.createDataFrame([("subject", v) for v in typed], "field string, value string")
    ways = [sorted(map(str, p5_canonical.canonical(values, entries, "field", "value", most).collect())) for most in (10**6, 7)]
    assert ways[0] == ways[1] and len(ways[0]) > 60


SPEAKERS = [("GV", "Giảng viên", ["GV", "Lecturer"]), ("TA", "Trợ giảng", ["TG", "TA"]), ("SV1", "Sinh viên 1", ["SV1", "Student 1"]), ("SV2", "Sinh viên 2", None)]


def test_p6_turns(spark):
    rows = [
        ("m", 0, "không ai nói"),
        ("m", 1, "[00:05] GV: ờ... ừm..."),
        ("m", 2, "chào các em [vỗ tay]"),
        ("m", 2, "chào các em [vỗ tay]"),
        ("m", 3, "(sinh vien #01): dạ\n**TG**: mời em"),
        ("m", 4, "<v Student 1> [inaudible 00:03]"),
        ("m", 5, "TA - tiếp đi Ví dụ: xong"),
        ("m", 5000, "giảng viên >> ta có hai khả năng"),
        ("m", 5001, None),
        ("n", 0, "không có nhãn"),
        ("n", 1, "Sinh viên 12: ai đó"),
        (None, 1, "GV: x"),
    ]
    seg = spark.createDataFrame([(a, b, 1.0, 2.0, t, None) for a, b, t in rows], "media_id string, seg_idx int, start_sec double, end_sec double, text string, ingested_at timestamp").repartition(3)
    who = spark.createDataFrame(SPEAKERS, "speaker_id string, label string, aliases array<string>")
    assert {tuple(r) for r in p6_turns.turn_starts(seg, who).collect()} == {("m", 2, "GV"), ("m", 3, "SV1"), ("m", 3, "TA"), ("m", 5000, "GV")}
    texts = {(r["seg_idx"], r["speaker_id"]): r["text"] for r in p6_turns.turns(seg, who).collect()}
    assert texts[2, "GV"] == "chào các em" and texts[3, "TA"].startswith("mời em") and texts[3, "TA"].endswith("tiếp đi Ví dụ: xong")
    assert p6_turns.turn_starts(seg.limit(0), who).count() == 0


def test_p6_turns_over_blocks(spark, monkeypatch):
    rnd = random.Random(8)
    who = spark.createDataFrame(SPEAKERS, "speaker_id string, label string, aliases array<string>")
    rows, at, tail = [], 0.0, []
    for i in range(60):
        label = rnd.choice(["GV: ", "TA: ", "", "", ""]) if i else "GV: "
        own = [f"từ{i:02d}{k:02d}" for k in range(rnd.randint(2, 60))]
        said, tail = ([] if label or i in (12, 44) else tail) + own, own
        at += 30.0 if i in (12, 44) else 0.2
        rows.append(("m", i, at, at + 1, label + " ".join(said)))
        at += 1
    rows += [("n", i, None, None, f"{'GV: ' if i == 0 else ''}lời{i}") for i in range(25)]
    seg = spark.createDataFrame(rows, "media_id string, seg_idx int, start_sec double, end_sec double, text string").repartition(3)
    found = lambda **k: sorted(map(tuple, p6_turns.turns(seg, who, **k).collect()))
    want = found()
    words = " ".join(w for m, *_, w in want if m == "m").split()
    assert len(words) == len(set(words)) and {("m", 12), ("m", 44)} <= {r[:2] for r in want} and [r[-1] for r in want if r[0] == "n"] == [" ".join(f"lời{i}" for i in range(25))]
    monkeypatch.setattr(p6_turns, "BLOCK", 4)
    assert found() == want
    assert [(r[1], r[3], len(r[-1].split())) for r in found(piece=8) if r[0] == "n"] == [(0, 0, 8), (0, 1, 8), (0, 2, 8), (0, 3, 1)]


CAPTIONS = "media_id string, seg_idx int, start_sec double, end_sec double, text string"


def test_p6_captions_repeat_labels(spark, monkeypatch):
    rnd = random.Random(21)
    who = spark.createDataFrame(SPEAKERS, "speaker_id string, label string, aliases array<string>")
    rows, starts, words = [], set(), {}
    # Captions of "m" begin with a label, those of "n" only where the speaker changes.
    for media in "mn":
        by, shown, before = ["GV"], 0, 0
        while len(by) < 600:
            by += [rnd.choice([n for n in ("GV", "TA", "SV1") if n != by[-1]])] * rnd.randint(1, 6)
        changes = [j == 0 or by[j] != by[j - 1] for j in range(len(by))]
        for i in range(70):
            begin = shown - rnd.choice([0, *range(2, before + 1)]) if before > 1 else shown
            end = shown + rnd.randint(1, 8)
            text = " ".join(f"{by[j]}: từ{j}" if changes[j] or j == begin and media == "m" else f"từ{j}" for j in range(begin, end))
            rows.append((media, i, i * 1.0, i + 0.9, text))
            starts |= {(media, i, by[j]) for j in range(shown, end) if changes[j]}
            shown, before = end, end - begin
        words[media] = [(by[j], f"từ{j}") for j in range(shown)]
    seg = spark.createDataFrame(rows, CAPTIONS).repartition(3)
    for block in (2048, 4):
        monkeypatch.setattr(p6_turns, "BLOCK", block)
        assert {tuple(r) for r in p6_turns.turn_starts(seg, who).collect()} == starts
        turns = sorted(p6_turns.turns(seg, who).collect(), key=lambda r: (r["seg_idx"], r["pos"]))
        assert {m: [(r["speaker_id"], w) for r in turns if r["media_id"] == m for w in r["text"].split()] for m in "mn"} == words


def test_p6_captions_after_a_pause(spark):
    who = spark.createDataFrame(SPEAKERS, "speaker_id string, label string, aliases array<string>")
    both = "SV1: có ai đó GV: vâng thưa em"
    rows = [("near", 0, 0.0, 1.0, both), ("near", 1, 1.2, 2.0, both), ("far", 0, 0.0, 1.0, both), ("far", 1, 61.0, 62.0, both), ("none", 0, None, None, both), ("none", 1, None, None, both + " ạ")]
    # Others who say the same repeat no caption, nor does a single word.
    rows += [("echo", 0, 0.0, 1.0, both), ("echo", 1, 1.2, 2.0, "TA: vâng thưa em SV1: dạ"), ("one", 0, 0.0, 1.0, "GV: mời TA: vâng"), ("one", 1, 1.2, 2.0, "GV: vâng")]
    rows += [("far", i, 60.0 + i * 1.3, 61.0 + i * 1.3, "tiếp") for i in range(2, 60)]
    got = {tuple(r) for r in p6_turns.turn_starts(spark.createDataFrame(rows, CAPTIONS), who).collect()}
    at = lambda m: {r[1:] for r in got if r[0] == m}
    assert at("near") == at("none") == {(0, "SV1"), (0, "GV")} and at("far") == {(0, "SV1"), (0, "GV"), (1, "SV1"), (1, "GV")}
    assert at("echo") == {(0, "SV1"), (0, "GV"), (1, "TA"), (1, "SV1")} and at("one") == {(0, "GV"), (0, "TA"), (1, "GV")}


def test_p6_grammars_agree(spark):
    rnd = random.Random(12)
    people = [(f"S{i:02d}", f"Sinh viên {i}", [f"SV{i}", f"Student {i}"] if i % 2 else None) for i in range(1, 16)] + SPEAKERS[:2]
    who = spark.createDataFrame(people, "speaker_id string, label string, aliases array<string>")
    said = lambda: " ".join(rnd.choice(["dạ", "SV3:", "Sinh viên 12:", "sinh viên 1:", "[Student 7]", "GV >>", "Ví dụ:", "từ", "vâng"]) for _ in range(rnd.randint(0, 9)))
    seg = spark.createDataFrame([(rnd.choice("mn"), i, 0.0, 1.0, said()) for i in range(120)] + [("m", 900, 0.0, 1.0, None)], "media_id string, seg_idx int, start_sec double, end_sec double, text string")
    ways = [sorted(map(str, p6_turns.read_segments(seg, who, True, most).collect())) for most in (None, 4)]
    assert ways[0] == ways[1] and len(ways[0]) > 150


class Counted:
    """A pattern that counts its substitutions."""

    def __init__(self, pattern):
        self.pattern, self.calls = pattern, 0

    def sub(self, by, text):
        self.calls += 1
        return self.pattern.sub(by, text)


def test_p6_plain_speech_needs_no_substitution(monkeypatch):
    counted = [Counted(getattr(p6_turns, name)) for name in ("_NOTE", "_TIME", "_HESITATION")]
    for name, pattern in zip(("_NOTE", "_TIME", "_HESITATION"), counted):
        monkeypatch.setattr(p6_turns, name, pattern)
    assert all(map(p6_turns._says_something, ["chúng ta xét trường hợp thứ hai", "00:05 ừm, the matrix [Music] is regular"])) and not sum(p.calls for p in counted)
    assert not any(map(p6_turns._says_something, ["[vỗ tay]", "(tiếng ồn) ừ thì hmm 00:12", "Uh huh, 1h20m05s <noise>", ""])) and sum(p.calls for p in counted) == 12


def test_p6_shortcuts_agree():
    rnd = random.Random(31)
    bits = ["ừ thì", "uh huh", "uh", "HUH", "12:30", "1h20m3s", "abcd", "abc", "hmm", *"()[]{}<>♪*_- :.\nxhms1", "**", "-->", "=>", " – ", "²²²²", "ſſſſ", "SV1", "GV", "ệ", "tạ\u200bi", "wһо", "ｔ", "\U0001d427", "\U0001f4bb", "\ufeff", "\u00a0", "学习"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))) for _ in range(20_000)]
    full = lambda t: bool(p6_turns._SPEECH.search(p6_turns._HESITATION.sub(" ", p6_turns._TIME.sub(" ", p6_turns._NOTE.sub(" ", t)))))
    assert [t for t in texts if p6_turns._says_something(t) != full(t)] == []
    labels = p6_turns.Labels(SPEAKERS)
    assert [t for t in texts if p6_turns.labels_in(t, labels) != (labels.find(t) if p6_turns._TRIGGER.search(t) else [])] == []
    column = pa.array([None, *texts, None], pa.string())
    for part in (column, column[7:900], column[:0], pa.array(["không", "plain"])):
        assert p7_forms.consistent_texts(part) == p7_forms.consistent(part)[0].to_pylist()


def test_p6_overlap():
    assert p6_turns.overlap("a b c".split(), "b c d".split()) == 2 and p6_turns.overlap(["a"], []) == 0 and p6_turns.overlap("a b".split(), "c".split()) == 0
    say = lambda t: [(w[0], w[1:] or None) for w in t.split()]
    assert p6_turns.repeated(say("a1 b2 c2"), say("a1 b2 c2 d2")) == 3 and p6_turns.repeated(say("a1 b2 c2"), say("a b2 c2 d1")) == 3
    assert p6_turns.repeated(say("a1 b2 c2"), say("b1 c1")) == 0 and p6_turns.repeated(say("a2 a1 a1"), say("a1 a1 a1")) == 2 and p6_turns.repeated(say("a1"), say("a1")) == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("ｔｈế", "thế"), ("ế", "ế"), ("ệ", "ệ"), ("tạ​i", "tại"), ("a b", "a b"), ("wһо", "who"), ("Βộ", "Bộ"), ("ðẩy", "đẩy"), ("ﬁn", "fin"), ("\U0001d427x", "nx"),
        ("Từ слово", None), ("λ ≥ 0, π", None), ("m² – “x”", None), ("学习", None), ("\U0001f469‍\U0001f4bb", None), ("a\nb\tc", None), ("", None), (None, None),
    ],
)
def test_p7(text, want):
    out, changed = p7_forms.consistent(pa.array([text], pa.string()))
    assert (out.to_pylist()[0], bool(changed[0])) == ((want, True) if want else (text or "", False))


def test_p7_composes_like_nfc():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("aeouOE\u1ef0\u0300\u0301\u0302\u0303\u0306\u0309\u031b\u0323x\u0111 b") for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    assert p7_forms.consistent(pa.array(texts))[0].to_pylist() == [unicodedata.normalize("NFC", t) for t in texts]


def test_p8(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    own.encode_special_tokens = True
    rnd = random.Random(6)
    texts = [None, "", " ", PROSE, "a" * 5000, "<|endoftext|>", *("".join(rnd.choice("aabcdehit  \n'Ééựđ漢😀{}=-12") for _ in range(rnd.randint(0, 80))) for _ in range(300))]
    got = p8_encode.encode_corpus(docs(spark, texts), "doc_id", "text")
    ids = {r["doc_id"]: r["ids"] for r in got.collect()}
    assert ids == {i: own.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["text"] for r in p8_encode.decode_corpus(got, "doc_id", window=3).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_p8_stream_keeps_started_characters():
    enc = p8_encode.encoder("/opt/tokenizers/byte_bpe_50k.tiktoken")
    stream = p8_encode.Utf8Stream(enc.transducer.bytes_of)
    lone = {t: i for i, t in enc.transducer.bytes_of.items() if len(t) == 1}
    parts = [stream.feed([lone[bytes([b])]]) for b in "漢😀é".encode()]
    assert "".join(parts) == "漢😀é" and parts[0] == ""
    stream.feed([lone[b"\xf0"]])
    with pytest.raises(ValueError):
        stream.end()
    with pytest.raises(ValueError):
        p8_encode.Utf8Stream(enc.transducer.bytes_of).feed([lone[b"\xff"]])


ITEM = "Một trạm thu Jorosson nhận 332 bức điện mỗi giờ, trạm Draunven chỉ nhận 795 bức, hãy tính xem sau bao lâu hai trạm có cùng số điện tồn"


@pytest.mark.parametrize("most", [10**6, 0])
def test_p9(spark, most):
    w = ITEM.split()
    texts = ["mở đầu " + " ".join(w[3:15]).upper() + " kết", " ".join(w[3:14]), " ".join(w[:24]).replace("332", "9").replace("Jorosson", "Zelkor").replace("795", "8"), None, "", (PROSE + " ") * 300 + " ".join(w[-12:])]
    items = spark.createDataFrame([(7, ITEM, "d"), (7, ITEM, "d"), (8, None, ""), (9, "ngắn", "")], "item_id long, text string, h string")
    got = p9_leaks.leaks(docs(spark, texts), "doc_id", "text", items, "item_id", "text", most)
    assert {(r["doc_id"], r["item_id"]) for r in got.where("kind = 'verbatim'").collect()} == {(0, 7), (5, 7)}
    assert {r["doc_id"] for r in got.where("kind = 'reparameterised'").collect()} == {2}


def test_p9_both_ways_agree(spark):
    rnd = random.Random(9)
    w = ITEM.split()
    other = "Nếu kho Zelkor có 40 kg gạo và kho Marn có 25 kg gạo, hỏi sau 3 giờ thì kho nào còn nhiều hơn"
    numbers = " ".join(str(k) for k in range(40))
    texts = [
        " ".join(w[:23]).replace("Jorosson", "Zelkor").replace("Draunven", "Marn"),
        " ".join(w[:23]).replace("Jorosson", "Zelkor").replace("Draunven", "Zelkor"),
        " ".join(w).replace("bức", "lá"),
        (ITEM + ". ") * 3,
        other.replace("kg", "l").replace("40", "7") + " " + numbers,
        numbers.replace("1", "2"),
    ]
    for _ in range(60):
        base = (rnd.choice([ITEM, other]) + " " + numbers).split()
        texts.append(" ".join(rnd.choice(["9", "Marn", "kg", "lá"]) if rnd.random() < 0.06 else x for x in base))
    frame = docs(spark, texts).unionByName(docs(spark, texts[:9]))
    items = spark.createDataFrame([(1, ITEM), (2, other), (2, other + " " + numbers), (3, numbers), (3, numbers), (4, None)], "item_id long, text string")
    ways = [sorted(map(tuple, p9_leaks.leaks(frame, "doc_id", "text", items, "item_id", "text", most).collect())) for most in (10**6, 0)]
    assert ways[0] == ways[1] and {(0, 1, "reparameterised")} <= {r[:3] for r in ways[0]}


def test_p9_planted_and_similar(spark):
    """Items of one kind, planted with other numbers and names, beside texts that only share their wording."""
    rnd = random.Random(13)
    name = lambda: "".join(rnd.choice(["Ka", "Zo", "Mir", "Del", "Tu"]) for _ in range(3))
    frames = ["Một kho tại {a} chứa {x} kg gạo, kho tại {b} chứa {y} kg, hỏi sau {z} giờ kho nào còn nhiều gạo hơn nếu mỗi giờ bán hai bao", "A pump in {a} fills {x} litres per minute while the pump in {b} fills {y} litres, find how long both need for {z} tanks of the same size"]
    made = lambda f: f.format(a=name(), b=name(), x=rnd.randint(2, 99), y=rnd.randint(100, 999), z=rnd.randint(1000, 9999))
    items = [(i, made(frames[i % 2])) for i in range(6)]
    planted = [made(frames[k % 2]) for k in range(30)]
    other = {"kho": "nhà", "hơn": "kém", "bán": "mua", "pump": "pipe", "both": "each", "tanks": "jars"}
    similar = [" ".join(other.get(w, w) for w in t.split()) if k % 3 else " ".join(w for i, w in enumerate(t.split()) if i % 4) for k, t in enumerate(made(frames[k % 2]) for k in range(30))]
    frame = docs(spark, [*planted, *similar])
    got = p9_leaks.leaks(frame, "doc_id", "text", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text").collect()
    found = {r["doc_id"] for r in got}
    assert len(found & set(range(30))) >= 27 and len(found - set(range(30))) <= 3


def test_p10(spark):
    texts = [
        "Chào mừng {{ten}} đến với học phần <TIÊU ĐỀ>.\nNội dung tóm tắt: @@topic@@.",
        "Lorem ipsum dolor sit amet.",
        "Lỗi 404. Không tìm thấy trang bạn yêu cầu. Hãy quay về trang chủ hoặc thử tìm kiếm.",
        "Please enable JavaScript to view the comments.",
        PROSE * 3 + " Vui lòng bật JavaScript để xem bình luận.",
        "Trong khuôn mẫu, cú pháp {{ten}} sẽ được thay bằng giá trị thật khi trang được dựng.",
        "Mã trạng thái 404 báo rằng máy chủ hiểu yêu cầu nhưng không thấy tài nguyên. " + PROSE,
        None,
        "",
        "\n".join(f"Mục 1.{i} mô hình tối ưu ............ {i}" for i in range(1, 9)),
        "Họ tên: __________\nLớp: __________",
        PROSE,
    ]
    got = p10_residue.residue_of(docs(spark, texts), "doc_id", "text", 0.5).where(F.col("share") > 0.5)
    assert {r["doc_id"] for r in got.collect()} == {0, 1, 2, 3, 10}


def test_p10_gate_lets_every_wording_pass(spark):
    texts = [
        "The page could not be found.", "The server is down.", "This is sample text.", "Your title here", "to be added later", "Quote this number to the helpdesk.", "Phiên làm việc đã hết hiệu lực", "Không thể hiển thị trang", "Không thể tải tệp", "404", "Status 500",
        "Duis aute irure dolor in reprehenderit.", "Write two sentences here", "Insert: điền tên tại đây", "Tripped over a cable.", "Bad gateway", "The site is temporarily unavailable", "Cần bật cookie", "Scripting must be enabled", "Checking your browser",
    ]
    assert [t for t in texts if not p10_residue.residue_kind(t)] == []
    got = p10_residue.residue_of(docs(spark, [*texts, PROSE]), "doc_id", "text", 0.5)
    assert {r["doc_id"] for r in got.collect()} == set(range(len(texts)))
    assert all(w == w.lower() and p10_residue.words_of_sorts(w) for sort in p10_residue._SORTS for w in sort)


#: Wording written for this test after the rules, none of it taken from the tables.
NEW_RESIDUE = """The requested document has been removed by its owner.
We are unable to process your request at the moment.
This video is no longer available in your region.
Your account does not have permission to open this folder.
Please refresh the page or contact support.
HTTP 403 Forbidden
Error 0x80070005
Cookies must be accepted before you can continue.
Turn JavaScript on to see the exercise.
We are verifying your browser, one moment.
Type your summary here.
[INSERT LECTURE TITLE]
Dear {{student.name}}, your seat is {{seat_no}}.
Nullam vestibulum porttitor ligula sollicitudin.
This page will be completed soon.
Sample text for the introduction.
Máy chủ đang quá tải, xin hãy tải lại trang.
Liên kết này không còn tồn tại.
Bạn không được phép truy cập tài nguyên này.
Phiên của bạn đã hết, hãy đăng nhập lại.
Mã tham chiếu: 7F-2210
Trình duyệt của bạn đang tắt JavaScript.
Nhập mô tả ngắn của bài học tại đây.
Nội dung đang được cập nhật.
Kính gửi <HO_TEN>, điểm của bạn là ${diem}.
Phần này sẽ được bổ sung trong học kỳ tới.""".split("\n")
NEW_CONTENT = """The gradient of the loss is computed for every batch.
A server accepts a connection and starts a thread for it.
Sorting the list takes longer when most of it is in reverse order.
Students often forget that the integral has two limits.
The parser reads the file line by line and builds a tree.
In 1905 the first paper on the subject was published.
The word please is used more often in the second corpus.
If the queue is empty, the consumer waits for the producer.
We add the two vectors and divide by their length.
The cookie was baked for twelve minutes.
Bộ nhớ đệm giúp chương trình đọc dữ liệu nhanh hơn.
Máy chủ gửi lại kết quả cho mọi nút trong mạng.
Sinh viên cần nộp bài trước buổi học thứ năm.
Tệp được chia thành nhiều khối có cùng kích thước.
Hãy xét một dãy số tăng dần và bị chặn trên.
Biến ${n} trong đoạn lệnh trên giữ số phần tử.
Cú pháp {{ten}} cho phép chèn giá trị vào khuôn mẫu.
Thuật toán dừng khi không còn đỉnh nào chưa xét.
Lỗi làm tròn tăng dần theo số phép tính.
Trang đầu của cuốn sách nói về lịch sử hình học.
Nguyen Van An, Tran Thi Binh, Le Hoang Cuong
mang may tinh la mot he thong ket noi nhieu thiet bi""".split("\n")


def test_p10_new_wording():
    found = [t for t in NEW_RESIDUE if p10_residue.residue_kind(t)]
    wrong = [t for t in NEW_CONTENT if p10_residue.residue_kind(t)]
    assert len(found) >= 0.9 * len(NEW_RESIDUE) and len(wrong) <= 0.05 * len(NEW_CONTENT)


def test_p10_mention_in_speech_without_sentence_ends(spark):
    speech = "hôm nay ta nói về cấu trúc dữ liệu và cách lưu chúng trong bộ nhớ của máy tính Trong khuôn mẫu, cú pháp {{ten}} được thay khi dựng trang rồi ta xét tiếp các hàm băm cùng độ phức tạp của chúng khi số phần tử tăng lên rất nhiều lần so với ban đầu và kết luận"
    assert p10_residue.residue_of(docs(spark, [speech]), "doc_id", "text", 0.5).where("share > 0.5").count() == 0


def test_p1_decided_by_the_sketches(spark):
    """The bounds decide: with bounds of a language in which nothing binds sentences, nothing is in the tail."""
    m = p1_quality.measured(docs(spark, [PROSE, LISTED]), "doc_id", "text")
    share = lambda b: {r["doc_id"]: r["outside_share"] for r in p1_quality.scored(m, "doc_id", b).collect()}
    wide = {"vi": {s: (0.0, 9.0) for s in p1_quality.WEIGHTS}}
    assert share({})[1] > 0.9 and share(wide)[1] == 0.0 and share({})[0] < 0.1


def test_p1_contents_are_a_list(spark, tmp_path):
    lines = "\n".join(f"Mục {i}.1 mô hình tối ưu {'.' * (i + 6)} {i}" for i in range(1, 12))
    docs(spark, [lines, PROSE]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r[0] for r in p1_quality.p1_found(spark, str(tmp_path)).collect()} == {0}


def test_p6_label_with_en_dash():
    labels = p6_turns.Labels(SPEAKERS)
    text = "Giảng viên – chào các em"
    assert p6_turns.spans(text, p6_turns.labels_in(text, labels))[-1] == ("GV", "chào các em")


def test_p10_indented_text_is_no_code(spark):
    texts = ["  Trang đang bảo trì.\nPlease enable JavaScript to view the comments.\nLorem ipsum dolor sit amet.", "if this page stays empty\nPlease enable JavaScript to view the comments.", "def chao(ten):\n    # coming soon\n    return 404"]
    got = p10_residue.residue_of(docs(spark, texts), "doc_id", "text", 0.5)
    assert {r["doc_id"] for r in got.collect()} == {0, 1}
