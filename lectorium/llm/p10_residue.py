"""Problem 10: template residue, filler and site messages in place of content.

Unfilled placeholders are found with one small grammar for each delimiter. Notices and filler are
found by what they are made of: a short sentence that joins a thing and what is wrong with it, a
request and where it leads, something to fill in and a place for it, scripts and a switch. Filler in
a pseudo-language is told by vocabulary statistics. What stands in code blocks, and a placeholder
that is named as syntax, is discounted. A document is residue if most of its characters belong to
such sentences, so that real content with some such lines, or speech that mentions them, is none;
speech without sentence ends is judged in pieces, so that a mention doesn't take in what is around it.

An Aho-Corasick automaton finds the words of all sorts in one walk over a sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_text import slices, spread, table
from .p8_encode import VOCABULARY, VOCABULARY_DIR, load_ranks

MIN_SHARE = 0.5

_NAME = r"[^\W\d][\w.\- ]{0,40}"
#: Delimiters that hardly occur in prose: any name between them counts.
STRONG = {
    "{{": rf"\{{\{{\s*{_NAME}\s*\}}\}}",
    "{%": rf"\{{%[=-]?\s*{_NAME}\s*%\}}",
    "<%": rf"<%[=-]?\s*{_NAME}\s*%>",
    "${": rf"\$\{{\s*{_NAME}\s*\}}",
    "#{": rf"#\{{\s*{_NAME}\s*\}}",
    "%(": rf"%\(\s*{_NAME}\s*\)[sd]",
    "@@": rf"@@\s*{_NAME}\s*@@",
    "[[": rf"\[\[\s*{_NAME}\s*\]\]",
    "«": rf"(?<!\w)«\s*{_NAME}\s*»(?!\w)",
    "__": rf"(?<!\w)__(?=[^\W_]){_NAME}?__(?!\w)",
    "##": rf"##\s*{_NAME}\s*##",
}
#: Delimiters that also have other uses: what is between them must look like a field.
_FIELD = (
    r"(?:[^\W\d]\w*_\w+|[^\W\d]\w*\.\w+|[A-ZĐÀ-Ỹ]{2,}(?: [A-ZĐÀ-Ỹ]{2,})+"
    r"|(?i:điền[^<>\[\]{}%]{0,30}|chèn[^<>\[\]{}%]{0,30}|nhập [^<>\[\]{}%]{0,30}|insert [^<>\[\]{}%]{0,30}|your [^<>\[\]{}%]{0,30}|enter [^<>\[\]{}%]{0,30}"
    r"|tiêu đề|tên [^<>\[\]{}%]{0,20}|họ tên[^<>\[\]{}%]{0,20}|nội dung[^<>\[\]{}%]{0,20}|title|name|first name|last name|topic|summary|room|lecturer|teacher|student|course|subject|unit|week|date|email|phone|address|company|footer|header|author|keywords?))"
)
WEAK = {
    "<": rf"<\s*{_FIELD}\s*>",
    "[": rf"(?<!\[)\[\s*{_FIELD}\s*\](?!\])",
    "{": rf"(?<![\w{{$#\\]){{\s*{_FIELD}\s*}}(?!}})",
    "%": rf"(?<!\w)%{_FIELD}%(?!\w)",
}
_WEAK = re.compile("|".join(WEAK.values()))
PLACEHOLDER = re.compile("|".join([*STRONG.values(), *WEAK.values()]))
BLANK = re.compile(r"_{4,}|\.{6,}|…{2,}|\bX{4,}\b|\b(?:TODO|TBD|FIXME)\b")

#: The usual pseudo-Latin of typesetting.
LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
#: Words of English and of unaccented Vietnamese that hold sentences together; pseudo-language has none.
FUNCTION_WORDS = frozenset("the a an of and is are was were to that by with on for if from be as at it or has have this these what why how when which can will you we i they he la va cua cac duoc khi cho nay de neu vao mot nhung trong voi khong co se da bi tu den".split())

#: What a notice speaks of, what is wrong with it, what visitors are asked to do and to
#: what, and what authors are asked to fill in. A notice joins two of these within one short sentence.
THINGS = "page|pages|requests|network|response|upstream|cache|library|database|phản hồi|bộ nhớ đệm|mạng|số lượt|lượt tải|cơ sở dữ liệu|thư viện|site|website|server|service|system|file|document|resource|content|content you|address|url|link|request|session|token|account|connection|gateway|course|lesson|lecture|slides|video|viewer|player|preview|item|access|permission|something|nothing|đường dẫn|địa chỉ|trang|tệp|tập tin|máy chủ|dịch vụ|hệ thống|phiên|phiên làm việc|liên kết|tài liệu|tài nguyên|nội dung|yêu cầu|tài khoản|kết nối|khóa học|bài giảng|bài học|lượt truy cập|truy cập|quyền|mục này|chúng tôi|bạn".split("|")
FAILURES = "not found|not be found|cannot be found|can't be found|couldn't find|could not find|does not exist|doesn't exist|never existed|not available|unavailable|not available yet|no longer|not be displayed|not be shown|not be loaded|not be opened|not be rendered|not be reached|cannot be shown|cannot be displayed|cannot be opened|cannot be reached|unable to|failed to|went wrong|gone wrong|an error|internal error|internal server error|bad gateway|gateway timeout|timed out|time out|in time|too many|denied|forbidden|not allowed|not authorized|unauthorized|not have permission|do not have access|expired|stale|missing|has moved|been moved|removed|deleted|under maintenance|maintenance|overloaded|is down|temporarily|rejected|invalid|tripped over|has been suspended|không tìm thấy|không tồn tại|không còn|không khả dụng|không truy cập được|không phản hồi|không thể mở|không thể tải|không thể hiển thị|không thể kết xuất|không thể truy cập|không thể kết nối|không thể xử lý|không có quyền|không được phép|không hợp lệ|bị từ chối|từ chối|bị chặn|hết hạn|hết hiệu lực|hết phiên|đã hết|gặp sự cố|sự cố|gặp lỗi|có lỗi|đã xảy ra lỗi|bảo trì|quá tải|tạm ngừng|tạm thời|bị gỡ|đã bị xóa|đã gỡ|đã chuyển|chưa mở|chưa sẵn sàng|chưa được chia sẻ|vượt quá|quá nhiều|rỗng".split("|")
REQUESTS = "please|try again|retry|refresh|reload|return|go back|go to|use the|contact|report|quote|sign in|log in|login|wait|come back|vui lòng|xin hãy|hãy|thử lại|tải lại|làm mới|quay lại|quay về|trở về|liên hệ|báo cho|đăng nhập|chờ|đợi|gửi kèm".split("|")
PLACES = "again|later|minutes|seconds|moment|home page|homepage|search|search box|support|help desk|helpdesk|administrator|admin|webmaster|browser|page|account|your instructor|view|continue|trang chủ|tìm kiếm|kỹ thuật|hỗ trợ|quản trị|trình duyệt|tài khoản|ít phút|sau vài|sau ít|lần sau|thử lại|tải lại trang|lại sau|phút nữa|giây nữa|để xem|để tiếp tục".split("|")
FILLS = "replace|insert|add|enter|type|write|click|edit|your|sample|placeholder|dummy|example text|blank|empty|draft|goes here|go here|to be|coming soon|will appear|will be|not yet|under construction|layout|nhập|thêm|chèn|viết|điền|bấm|nhấn|thay|bản nháp|mẫu|giữ chỗ|đang|sẽ|chưa có|để trống|ghi chú".split("|")
FILLED = "here|text|paragraph|block|title|heading|headline|caption|content|section|slide|image|picture|figure|biography|description|generated|unedited|edited|soon|later|now|purposes|announced|completed|added|updated|sentences|copy|đây|vị trí này|chỗ này|nội dung|tiêu đề|đoạn văn|đoạn|văn bản|hình|hình ảnh|mô tả|tiểu sử|cập nhật|bổ sung|thay bằng|hiện ở|soạn|biên tập|tự sinh|tự động|hoàn thiện|trang chiếu|mục này|phần này".split("|")
SCRIPTING = "javascript|script|scripts|scripting|cookie|cookies|kịch bản".split("|")
SWITCHES = "enable|enabled|disable|disabled|turn on|turned on|turn off|turned off|off|on|allow|allowed|accept|activate|block|blocked|require|requires|required|need|needs|must|bật|tắt|chặn|cho phép|cần|chấp nhận|yêu cầu|không chạy".split("|")
BROWSER, CHECKS = "browser|trình duyệt".split("|"), "check|checks|checked|checking|verify|verifies|verifying|verification|kiểm tra|xác minh|xác nhận".split("|")
#: Words that name a piece of syntax, and so what follows them is spoken about and not filled in.
METALANGUAGE = "syntax|variable|expression|parameter|placeholder syntax|tag|tags|macro|template language|template engine|status code|cú pháp|biến|biểu thức|tham số|thẻ|khuôn mẫu|mã trạng thái|ký hiệu".split("|")
#: Short lines that notices begin with, and lines that give a number to an error or a request.
_CALLS = re.compile(r"^\W*(?:oops|uh-oh|sorry|notice|warning|error|rất tiếc|ôi không|thông báo|xin lỗi|lỗi)\W*$", re.I)
_NUMBERED = re.compile(r"^\W*(?:(?:http|error|code|status|request|reference|incident|ref|ticket|id|mã|lỗi|yêu cầu|tham chiếu|thời điểm|ghi nhận|time|timestamp)\W+){0,4}(?:id\W*)?(?:[a-z]{1,3}-)?[0-9a-f:./T-]*\d[\w:./-]*(?:\W+(?:not found|forbidden|unauthorized|bad request|bad gateway|internal server error|service unavailable|gateway timeout|error|lỗi))?\W*$", re.I)
_VALUE = re.compile(r"^\W*(?:\w+ ){0,3}\w+\s*:\s*\S*\d\S*(?: \S+){0,2}$")
_CODE_GIVEN = re.compile(r"(?<![\d.,:])[45]\d\d(?![\d:]|[.,]\d)")
_LABELLED = re.compile(r"\b(?:error|code|status|request|reference|incident|id|mã|lỗi|yêu cầu|(?<![\d.,:])[45]\d\d(?![\d:]|[.,]\d)|thời điểm)\b", re.I)

#: Most words of a notice; a longer stretch without a sentence end is judged in pieces of so many words.
SHORT, LONG, PIECE = 18, 30, 12


#: The two sorts of words that a notice joins, by its kind, in the order in which they are tried.
_PAIRS = [("script", SCRIPTING, SWITCHES), ("script", BROWSER, CHECKS), ("message", THINGS, FAILURES), ("message", REQUESTS, PLACES), ("filler", FILLS, FILLED)]
_SORTS = [*(sort for _, *two in _PAIRS for sort in two), METALANGUAGE]
_BITS = [(kind, 1 << 2 * i, 2 << 2 * i) for i, (kind, *_) in enumerate(_PAIRS)]
_META_BIT, _FAILURE_BIT = 1 << 2 * len(_PAIRS), 2 << 2 * 2
_MARKS = re.compile(r"[{<\[$%#@«_]")
_ABOUT = re.compile(r"(?<!\w)(?:" + "|".join(sorted(METALANGUAGE, key=len, reverse=True)) + r")(?!\w)[^\w{<\[$%#@«]*(?:\w+[^\w{<\[$%#@«]+){0,2}$", re.I)


@cache
def automaton():
    """One automaton over the words of all sorts; each is found with its length and the sorts it belongs to."""
    import ahocorasick

    sorts: dict[str, int] = {}
    for i, words in enumerate(_SORTS):
        for w in words:
            sorts[w] = sorts.get(w, 0) | 1 << i
    a = ahocorasick.Automaton()
    for w, bits in sorts.items():
        a.add_word(w, (len(w), bits))
    a.make_automaton()
    return a


def words_of_sorts(low: str) -> list[tuple[int, int, int]]:
    """(begin, end, sorts) of the whole words of any sort in a text in lower case."""
    out = []
    for last, (n, bits) in automaton().iter(low):
        begin, end = last - n + 1, last + 1
        if (begin == 0 or not (low[begin - 1].isalnum() or low[begin - 1] == "_")) and (end == len(low) or not (low[end].isalnum() or low[end] == "_")):
            out.append((begin, end, bits))
    return out



_SENTENCE = re.compile(r"[^\n.!?]*(?:[.!?]+(?!\s|$)[^\n.!?]*)*(?:[.!?]+|\n|$)")
_CODE = re.compile(r"```.*?```|<code>.*?</code>|<pre>.*?</pre>|^[ \t]*(?:def |int |for |return |if |\})[^\n]*(?:\n[ \t]+\S[^\n]*)*", re.S | re.M)
_SPACE = re.compile(r"\s+")


#: Dots that lead to a page number are not a field to fill in.
_LEADER = re.compile(r"\.{4,}[ \t]*(?=\d+[ \t]*$)", re.M)


def sentences(text: str) -> list[str]:
    return [s.strip() for s in _SENTENCE.findall(_LEADER.sub(" ", text)) if s.strip()]


def pieces(sentence: str) -> list[str]:
    """The sentence; one that is too long to be a single statement in pieces of some words."""
    words = sentence.split()
    if len(words) <= LONG:
        return [sentence]
    return [" ".join(words[i : i + PIECE]) for i in range(0, len(words), PIECE)]


_VIETNAMESE = re.compile(r"(?:ngh|ch|gh|gi|kh|ng|nh|ph|qu|th|tr|[bcdghklmnprstvx])?(?:uye|uya|oai|oay|uay|uoi|ieu|yeu|uou|ia|ie|iu|oa|oe|oo|oi|ua|ue|ui|uo|uu|uy|ye|ai|ao|au|ay|eo|eu|[aeiouy])(?:ch|ng|nh|[cmnpt])?")
_LATIN = re.compile(r"[a-z]+")


@cache
def known_words(path: str) -> frozenset[str]:
    """Words that a public vocabulary holds as one token each."""
    return frozenset(t[1:].decode() for t in load_ranks(path) if len(t) > 3 and t[:1] == b" " and t[1:].isalpha() and t[1:].isascii())


def pseudo_language(sentence: str, path: str | None = None) -> bool:
    """Whether a sentence consists of letter strings that only look like words.

    No word holds it together, it isn't unaccented Vietnamese, and hardly any of its words outside
    the usual filler is known to a public vocabulary.
    """
    if not sentence.isascii():
        return False
    words = [w.strip(".,;:!?\"'()") for w in sentence.lower().split()]
    if len(words) < 2 or not FUNCTION_WORDS.isdisjoint(words):
        return False
    if sum(len(w) <= 16 and _LATIN.fullmatch(w) is not None for w in words) < 0.9 * len(words):
        return False
    lorem = sum(w in LOREM for w in words)
    rest = [w for w in words if w not in LOREM]
    if lorem >= 0.8 * len(words):
        return True
    known = known_words(path or f"{VOCABULARY_DIR}/{VOCABULARY}")
    strange = sum(w not in known and not _VIETNAMESE.fullmatch(w) for w in rest)
    # Names stand in titles as well: filler runs on in one case after its first word.
    plain = sentence.isupper() or sum(w[:1].islower() for w in sentence.split()[1:]) >= 0.8 * (len(words) - 1)
    return plain and (strange >= 0.5 * len(words) or (lorem > 0 and strange + lorem >= 0.7 * len(words)))


def residue_kind(sentence: str) -> str | None:
    """placeholder, blank, filler, message or script; None for content and for talk about syntax."""
    if _MARKS.search(sentence) and (found := PLACEHOLDER.search(sentence)):
        return None if _ABOUT.search(sentence[: found.start()].lower()) else "placeholder"
    n = sentence.count(" ") + 1
    if n <= 2 * SHORT:
        low = sentence.lower()
        if "/" in low or "@" in low or "www." in low:
            low = _ADDRESS.sub(" ", low)
        n = len(low.split())
        if 0 < n <= SHORT:
            if n <= 8 and (_CALLS.match(low) or (_DIGIT.search(low) and _LABELLED.search(low) and (_NUMBERED.match(low) or _VALUE.match(low) or _CODE_GIVEN.search(low)))):
                return "message"
            if kind := notice(low, n):
                return kind
    if pseudo_language(sentence):
        return "filler"
    return "blank" if n <= 12 and BLANK.search(sentence) else None


def notice(low: str, n: int) -> str | None:
    """The kind of a notice of n words in lower case; None where it names syntax or joins nothing."""
    hits = words_of_sorts(low)
    sorts = 0
    for _, _, bits in hits:
        sorts |= bits
    if not sorts or sorts & _META_BIT:
        return None
    for kind, one, other in _BITS:
        if other == _FAILURE_BIT and n <= 5 and sorts & other:
            return kind
        # Two different words: one that stands on both lists isn't both.
        if sorts & one and sorts & other and any(x & one and y & other and (b <= c or d <= a) for a, b, x in hits for c, d, y in hits):
            return kind
    return None


_DIGIT = re.compile(r"\d")
#: Addresses and paths, whose words say nothing.
_ADDRESS = re.compile(r"\S+://\S+|www\.\S+|\S+@\S+|\S*\w/\w+/\S*")


def _solid(text: str) -> int:
    return len("".join(text.split()))


def residue(text: str) -> tuple[float, str | None, int]:
    """Share of non-space characters in residue sentences, the most frequent kind, placeholders."""
    kinds: dict[str, int] = {}
    code = {line.strip() for block in _CODE.findall(text) for line in block.split("\n")}
    parts = [p for s in sentences(text) for p in ([s] if s in code else pieces(s))]
    sizes = list(map(_solid, parts))
    total = sum(sizes)
    for s, n in zip(parts, sizes):
        if s not in code and (kind := residue_kind(s)):
            kinds[kind] = kinds.get(kind, 0) + n
    if not kinds:
        return 0.0, None, 0
    return sum(kinds.values()) / total, max(kinds, key=lambda k: (kinds[k], k)), len(PLACEHOLDER.findall(text))


def residue_of(df: DataFrame, id_col: str, text_col: str, least: float = 0.0) -> DataFrame:
    """(id, share, kind, n_placeholders) of each text that holds residue, from a share of least on.

    Null, empty and blank texts have no row. Repeated rows stay repeated, other columns are
    ignored, and long texts are read whole. No shuffle.
    """
    schema = T.StructType([df.schema[id_col], T.StructField("share", T.DoubleType()), T.StructField("kind", T.StringType()), T.StructField("n_placeholders", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text:
                    share, kind, n = residue(text)
                    if kind and share >= least:
                        at.append(i)
                        rows.append((share, kind, n))
            share, kind, n = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(share, pa.float64()), pa.array(kind, pa.string()), pa.array(n, pa.int32())], names=schema.names)

    return spread(df.select(id_col, text_col)).mapInArrow(run, schema)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = residue_of(table(spark, sf_dir, "documents"), "doc_id", "text", MIN_SHARE).where(F.col("share") > MIN_SHARE)
    return found.select("doc_id").distinct()


def p10_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents hold residue, by its kind, and how many consist of it."""
    found = residue_of(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.groupBy("kind").agg(F.count("*").alias("n_docs"), F.count_if(F.col("share") > MIN_SHARE).alias("n_found"), F.sum("n_placeholders").alias("n_placeholders"))


QUERIES = {"p10_found": p10_found, "p10_kinds": p10_kinds}
