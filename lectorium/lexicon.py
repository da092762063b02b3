"""Word lists and limits of the text rules. Patterns apply to text in its match form (no case, no accents)."""

from __future__ import annotations

# What results depend on, in the order in which rules are tried.

ALLOWED_CATEGORIES = ["Theory", "Example", "Process"]
EXAMPLE_WORDS = ["example", "vi du", "minh hoa", "instance", "case"]
PROCESS_WORDS = ["process", "step", "quy trinh", "buoc", "procedure"]

FILLERS = [r"\bxin chao\b", r"\bcam on\b", r"\bhen gap lai\b", r"\bthua cac ban\b", r"\bnhu chung ta da biet\b", r"\bv\s*v\b"]
LOW_INFO = [
    "sau nay co dieu kien chung ta se",
    "chung toi dung lai o day",
    "chung toi dung o day xin",
    "hen gap lai cac ban",
    "xin cam on cac ban",
    "trong buoi trao doi hom nay",
    "chung toi se tiep tuc o chuyen de",
    "tu nhien toi lai nho den",
    "bong chan toi lai nho",
]
ORPHAN_STARTS = ["cung de cap den", "noi cach khac", "nhung ma", "vi vay", "tuy nhien", "nhu vay", "do do", "nhu da noi", "nhu toi da", "thua cac ban", "toi nho den"]
ORPHAN_ENDS = ["trong", "nhu the"]
OPEN_ENDS = ["noi chung la", " va", " nhung", " hoac", " thi", " do la"]
META_TALK = [
    r"\bthua cac ban\b",
    r"\btoi nho den\b",
    r"\btu nhien toi\b",
    r"\bchung toi gioi thieu\b",
    r"\bchung toi se tiep tuc\b",
    r"\btrong buoi trao doi\b",
    r"\bbong chan toi\b",
    r"\bchung ta chuyen sang\b",
    r"\bchung ta da tim hieu\b",
    r"\btiep theo chung ta\b",
    r"\bnhu da trinh bay\b",
    r"\bnhu toi da noi\b",
    r"\btrong qua trinh hoc tap co mot chuyen de\b",
    r"\bkhi den chuyen de do\b",
    r"\bchung ta se trao doi ky\b",
    r"\bvoi tu gio den het chuong trinh\b",
    r"\bchung ta trao doi voi nhau o cap do\b",
    r"\bhen gap lai\b",
    r"\bxin cam on\b",
]
SPAM = ["subscribe.*kênh", "đăng ký.*kênh", "like.*share", "ghiền.*gõ", "không.*bỏ.*lỡ", "video.*hấp.*dẫn"]

STOPWORDS_VI = [
    "la", "va", "cua", "cho", "voi", "trong", "nhung", "duoc", "mot", "cac", "cung", "roi", "theo", "nay", "kia", "nhieu", "nhat", "nhu", "khi",
    "neu", "thi", "do", "ay", "noi", "chung", "de", "chi", "phan", "nao", "thoi", "dang", "se", "da", "qua", "rat", "van", "con", "nguoi", "moi",
    "hay", "hoac", "them", "deu", "lieu", "tren", "duoi", "sau", "truoc", "giua", "ben", "cuoi", "bat", "dau", "hai", "ba", "bon", "nam", "bay",
    "tam", "chin", "muoi",
]
STOPWORDS_EN = [
    "the", "this", "that", "with", "from", "into", "about", "your", "have", "will", "been", "were", "they", "their", "there", "when", "which",
    "would", "could", "should", "also", "more", "some", "than", "then", "each", "both", "such", "only", "very", "just", "over", "after", "before",
    "these", "those", "being", "other", "while", "what", "where", "how", "why", "who", "and", "but", "for", "not", "are", "was", "its", "our", "can",
    "all", "has", "had", "may",
]
STOPWORDS = STOPWORDS_VI + STOPWORDS_EN

TERMS = [
    ("chi thuc", "tri thuc"),
    ("chiet hoc", "triet hoc"),
    ("trinh the", "chinh the"),
    ("clip classroom", "flip classroom"),
    ("mac le nin", "marx-lenin"),
    ("mac lennin", "marx-lenin"),
    ("maclenin", "marx-lenin"),
    ("magnin", "marx-lenin"),
    ("mark denny", "marx-lenin"),
    ("maclean", "marx-lenin"),
    ("marx lenin", "marx-Lenin"),
]

ENGLISH_STARTS = [
    "abs", "acc", "act", "add", "adm", "ago", "aid", "aim", "air", "all", "ana", "and", "app", "arc", "are", "art", "ask", "ass", "aud", "aug", "bas",
    "beh", "bio", "bus", "cap", "cat", "cen", "cha", "che", "chi", "cla", "col", "com", "con", "cor", "cri", "cul", "dat", "def", "dep", "des", "dev",
    "dia", "dif", "dir", "dis", "doc", "dom", "dyn", "eco", "edu", "ele", "emp", "eng", "env", "est", "eth", "eve", "evo", "exa", "exc", "exp", "ext",
    "fac", "far", "fie", "fin", "for", "fra", "fun", "gen", "geo", "gov", "gro", "gui", "hab", "hea", "his", "hum", "hyp", "ide", "ima", "imp", "inc",
    "ind", "inf", "ins", "int", "inv", "iso", "jus", "kno", "lan", "law", "lea", "leg", "lib", "lin", "log", "man", "mar", "mat", "mea", "mec", "med",
    "met", "mig", "mod", "mol", "mon", "mor", "mot", "mul", "nat", "net", "neu", "nor", "obj", "obs", "off", "ont", "opt", "ord", "org", "ori", "out",
    "par", "pat", "per", "phi", "pho", "phy", "pla", "pol", "pos", "pre", "pri", "pro", "psy", "pub", "qua", "ran", "rat", "rec", "red", "ref", "rel",
    "rep", "res", "rev", "sci", "sec", "sel", "sem", "ser", "soc", "sol", "spe", "sta", "str", "sub", "sys", "tax", "tec", "the", "thr", "tra", "tri",
    "typ", "und", "uni", "use", "val", "var", "ver", "vis", "voc", "war", "wor",
]
SYLLABLE_STARTS = "b|c|ch|d|đ|g|gh|gi|h|k|kh|l|m|n|ng|ngh|nh|p|ph|qu|r|s|t|th|tr|v|x|z"
SYLLABLE_CORES = "a|ă|â|e|ê|i|o|ô|ơ|u|ư|y|ai|ao|au|ay|âu|âi|eo|eu|ia|ie|io|iu|oa|oe|oi|ôi|ơi|ua|ue|ui|uo|uô|ươ|uy|ya|ye"
SYLLABLE_ENDS = "c|ch|m|n|ng|nh|p|t"
VOWELS = "aeiouaăâêôơư"

SUBJECT_FOLDERS = ["môn", "course", "subject", "học phần", "class", "lớp"]
OTHER_FOLDERS = [
    "slide", "bài giảng", "tài liệu", "pdf", "file", "folder", "chương", "week", "tuần", "files", "slides", "document", "docs", "tài liệu tham khảo", "references",
    "đề cương", "syllabus", "lab", "thực hành", "assignment", "bài tập", "exercise", "đề thi", "exam", "quiz", "video",
]
CLIMB = 6
NO_SUBJECT = "General Subject"

SKIPPED_ENDINGS = [
    ".mp4", ".avi", ".mov", ".mkv", ".flv", ".wmv", ".webm", ".m4v", ".mpeg", ".mpg", ".mp3", ".wav", ".flac", ".aac", ".ogg", ".wma", ".m4a", ".jpg",
    ".jpeg", ".png", ".gif", ".bmp", ".svg", ".webp", ".ico", ".zip", ".rar", ".7z", ".tar", ".gz", ".exe", ".dmg", ".app", ".apk",
]
SKIPPED_TYPES = [
    "video/mp4",
    "video/x-msvideo",
    "video/quicktime",
    "video/x-matroska",
    "video/x-flv",
    "video/x-ms-wmv",
    "video/webm",
    "video/mpeg",
    "audio/mpeg",
    "audio/wav",
    "audio/flac",
    "audio/aac",
    "audio/ogg",
    "image/jpeg",
    "image/png",
    "image/gif",
    "image/bmp",
    "image/svg+xml",
    "image/webp",
    "application/vnd.google-apps.form",
    "application/vnd.google-apps.site",
    "application/vnd.google-apps.map",
]
EXPORTED_TYPES = [
    "application/vnd.google-apps.document",
    "application/vnd.google-apps.spreadsheet",
    "application/vnd.google-apps.presentation",
    "application/vnd.google-apps.drawing",
]
OFFICE_ENDINGS = [
    ".docx", ".doc", ".pptx", ".ppt", ".xlsx", ".xls", ".txt", ".rtf", ".odt", ".odp", ".ods",
]
OFFICE_TYPES = [
    "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.ms-powerpoint",
    "application/msword",
    "application/vnd.ms-excel",
    "application/vnd.oasis.opendocument.text",
    "application/vnd.oasis.opendocument.presentation",
    "application/vnd.oasis.opendocument.spreadsheet",
    "text/plain",
    "application/rtf",
]
FOLDER_TYPES = ["application/vnd.google-apps.folder", "application/x-folder"]
SHORTCUT_TYPES = ["application/vnd.google-apps.shortcut", "application/x-shortcut"]
