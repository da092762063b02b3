"""Problem 3: markup left in page texts, and clean text that keeps structure.

A text is read as containers and pieces, each with a generalised tag-class path (tag names and
classes, without numbers and ids; the kind, for other markup). Every page gives its ballots, which
are added up per host (the source file that the pages come from) in Spark. For finding markup, a
page speaks for a path with every piece of it, and against it with one that stands in a line of
program code, where the signs of some kinds mean something else: a page is affected if it holds a
piece of a path that won on its host. For clean text, containers are scored by what they hold; each
text is extracted again, without the containers whose path lost. Headings, lists, code, tables,
quotes and formulas are kept whatever the vote; it decides on templates, categories, references and
plain containers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.storage import kept
from .arrow_text import slices, spread, table

#: Names of HTML elements.
TAGS = "a abbr article aside audio b big blockquote body br button caption center cite code col colgroup dd del details div dl dt em embed figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark math meta nav noscript object ol option p param pre q ref references s samp script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video nowiki gallery syntaxhighlight".split()
#: LaTeX commands that are markup wherever they stand.
COMMANDS = "section subsection subsubsection paragraph chapter part title author textbf textit texttt textsc textrm emph underline begin end item caption label ref eqref cite footnote includegraphics centering hline frac dfrac tfrac sqrt sum prod int iint oint lim infty partial nabla cdot cdots ldots dots times div pm mp leq geq le ge neq ne approx equiv sim propto in notin subset subseteq cup cap forall exists to rightarrow leftarrow Rightarrow Leftarrow iff implies mapsto alpha beta gamma delta epsilon varepsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi varphi chi psi omega Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega vec hat bar tilde dot ddot overline mathbb mathcal mathrm mathbf mathit text left right big Big quad qquad binom sin cos tan log ln exp max min det".split()

#: Special names of Python, which are no emphasis.
_DUNDERS = "init|new|del|name|main|str|repr|len|dict|class|doc|file|call|enter|exit|iter|next|getitem|setitem|contains|eq|lt|gt|add|hash|bool|all|slots|version|future|import|module|path"

_TAG_NAMES = "|".join(sorted(TAGS, key=len, reverse=True))
_COMMAND_NAMES = "|".join(sorted(COMMANDS, key=len, reverse=True))

#: The kinds of pieces, tried in this order at every place of a text.
PIECES = {
    "md_fence": r"```[^\n`]*\n.*?(?:```|\Z)|~~~[^\n~]*\n.*?~~~|```",
    "html_comment": r"<!--.*?-->|<!DOCTYPE[^>]*>|<\?xml[^>]*>",
    "html_tag": rf"</?(?:{_TAG_NAMES})(?=[\s/>])(?:\s+[\w:@.-]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)*\s*/?>",
    "html_entity": r"&(?:[A-Za-z][A-Za-z0-9]{1,30}|#\d{1,7}|#[xX][0-9a-fA-F]{1,6});",
    "tex_environment": r"\\(?:begin|end)\{[A-Za-z*]+\}(?:\[[^\]\n]*\])?",
    "tex_display": r"\$\$.+?\$\$|\\\[.+?\\\]",
    "tex_inline": r"(?<![\\$\w])\$(?=[^\s$])(?:[^$\n]*[\\^_=+{}<>][^$\n]*|[A-Za-z](?:\([^$\n]{1,20}\))?)(?<=[^\s$])\$(?![\w$])|\\\(.+?\\\)",
    "wiki_template": r"\{\{[^{}]+\}\}",
    "wiki_table": r"^\{\|.*$|^\|\}.*$|^\|-+\s*$",
    "wiki_link": r"\[\[[^\[\]\n]+\]\]|\[https?://[^\s\]]+(?:\s[^\]\n]+)?\](?!\()",
    "wiki_style": r"'''''[^'\n]+'''''|'''[^\n]+?'''|(?<!')''(?!')[^\n]+?(?<!')''(?!')",
    "wiki_heading": r"^[ \t]*={2,6}[ \t]*[^=\n]+?[ \t]*={2,6}[ \t]*$",
    "md_heading": r"^ {0,3}#{1,6}[ \t]+\S.*$",
    "md_setext": r"^(?=\S)[^\n]+\n(?:={3,}|-{3,})[ \t]*$",
    "md_link": r"!?\[(?:[^\[\]\n]|\[[^\[\]\n]*\])*\]\((?:<[^>\n]*>|(?:https?:|mailto:|ftp:|/|#|\.{1,2}/|[\w%-]+(?:/|\.(?:html?|png|jpe?g|gif|svg|pdf|md)))[^)\n]*)\)|<https?://[^>\s]+>",
    "md_strong": rf"(?<![\w*])\*\*(?=[^\s*])[^\n]+?(?<=[^\s*])\*\*(?![\w*])|(?<!\w)__(?=[^\s_])(?!(?:{_DUNDERS})__)[^_\n]+(?<=[^\s_])__(?!\w)",
    "md_emphasis": r"(?<![\w*\\])\*(?=[^\s*])[^*\n]{1,160}?(?<=[^\s*])\*(?![\w*])|(?<![\w_\\])_(?=[^\s_])[^_\n]{1,160}?(?<=[^\s_])_(?![\w_])",
    "md_strike": r"~~(?=\S)[^~\n]+?(?<=\S)~~",
    "md_code": r"(?<!`)`(?=[^`\s])[^`\n]*`(?!`)",
    "md_rule": r"^[ \t]{0,3}(?:-[ \t]*){3,}$|^[ \t]{0,3}(?:\*[ \t]*){3,}$|^[ \t]{0,3}(?:_[ \t]*){3,}$",
    "md_table": r"^[ \t]*\|(?:[^|\n]*\|)+[ \t]*$|^[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+$",
    "md_list": r"^[ \t]{0,8}[-*+][ \t]+(?=\S)|^[ \t]{0,8}[*#]{1,4}[ \t]+(?=\S)",
    "md_quote": r"^[ \t]{0,3}>[ \t]*(?=\S)",
    "tex_command": rf"(?<![\w:\\])\\(?:{_COMMAND_NAMES})\*?(?![A-Za-z])(?:\[[^\]\n]*\])?",
    "tex_script": r"(?<=[A-Za-z0-9)\]])[_^]\{[^{}\n]+\}",
}
_PIECE = re.compile("|".join(f"(?P<{k}>{p})" for k, p in PIECES.items()), re.S | re.M)
#: Any of the characters without which no piece can begin.
_POSSIBLE = re.compile(r"[<&\\$\[{'=#*_~`|>-]|\{\||^\s*\+\s", re.M)

#: Hosts and losing paths up to which the outcome of the vote is sent to the tasks.
MOST_BROADCAST_PATHS = 200_000

_SINGLE = re.compile(r"<(/?)([abiqsu])>")
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*["']?([\w -]+)""")
_NAME = re.compile(r"</?\s*(\w+)")
_DIGITS = re.compile(r"\d+")
_BLOCK = frozenset("address article aside blockquote br caption center dd details div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
#: Paths on which the vote decides; all others are kept as structure.
_VOTED = frozenset("template category reference div section aside nav footer header figure script style form span".split())


def pieces(text: str) -> list[tuple[str, int, int]]:
    """(kind, begin, end) of every piece of markup, in order, without overlaps."""
    if not text or not _POSSIBLE.search(text):
        return []
    out = []
    for m in _PIECE.finditer(text):
        kind = m.lastgroup
        if kind == "html_entity" and m.group()[1] != "#" and m.group()[1:] not in html5:
            continue
        if kind == "html_tag" and (single := _SINGLE.fullmatch(m.group())):
            name = single[2]
            paired = f"<{name}>" in text and f"</{name}>" in text
            if not paired:
                continue
        out.append((kind, m.start(), m.end()))
    return out


def _entity(raw: str) -> str:
    import html

    return html.unescape(raw).replace("\u00a0", " ")


def _path(raw: str) -> str:
    """The generalised step of a tag: its name and classes without numbers."""
    name = _NAME.match(raw)[1].lower()
    found = _CLASS.search(raw)
    if not found:
        return name
    classes = sorted({_DIGITS.sub("", c).strip("-_").lower() for c in found[1].split()} - {""})
    return ".".join([name, *classes])


class _Page:
    """One reading of a text: the pieces become clean text, and containers are scored on the way."""

    def __init__(self, text: str, losing: frozenset[str] = frozenset()):
        self.losing, self.out, self.scores, self.stack, self.muted = losing, [], {}, [], 0
        self.kinds: dict[str, int] = {}
        at = 0
        for kind, begin, end in pieces(text):
            self.put(text[at:begin])
            self.kinds[kind.split("_")[0]] = self.kinds.get(kind.split("_")[0], 0) + 1
            getattr(self, "on_" + kind)(text[begin:end])
            at = end
        self.put(text[at:])
        while self.stack:
            self.close(self.stack[-1][0])

    def put(self, text: str) -> None:
        if text and not self.muted:
            self.out.append(text)
        if self.stack:
            self.stack[-1][2].append(text)

    def score(self, path: str, inner: str, links: int = 0) -> None:
        """Text counts for a container, sentence ends more, links and short labels against it."""
        size = len(inner.strip())
        value = size + 25 * len(re.findall(r"[.!?](?:\s|$)", inner)) - 60 * links - 40
        self.scores[path] = self.scores.get(path, 0) + value

    def voted(self, step: str, path: str) -> bool:
        return step.split(".")[0] in _VOTED and path in self.losing

    def open(self, step: str) -> None:
        path = ">".join([*(s for s, *_ in self.stack), step])
        mute = self.voted(step, path)
        self.stack.append((step, path, [], mute))
        self.muted += mute

    def close(self, step: str) -> None:
        name = step.split(".")[0]
        if not any(s.split(".")[0] == name for s, *_ in self.stack):
            return
        while self.stack:
            step, path, inner, mute = self.stack.pop()
            self.muted -= mute
            text = "".join(inner)
            self.score(path, text, text.count("http"))
            if self.stack:
                self.stack[-1][2].append(text)
            if step.split(".")[0] == name:
                break

    # HTML
    def on_html_comment(self, raw: str) -> None:
        pass

    def on_html_entity(self, raw: str) -> None:
        self.put(_entity(raw))

    def on_html_tag(self, raw: str) -> None:
        step = _path(raw)
        name = step.split(".")[0]
        closing, void = raw.startswith("</"), raw.endswith("/>") or name in ("br", "hr", "img", "input", "meta", "link", "col")
        if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.put("\n\n" if closing else "\n\n" + "#" * int(name[1]) + " ")
        elif name == "li":
            self.put("\n" if closing else "\n- ")
        elif name in ("td", "th"):
            self.put("" if closing else "| ") if not closing else self.put(" ")
        elif name == "tr":
            self.put("|\n" if closing else "\n")
        elif name == "pre":
            self.put("\n```\n")
        elif name in _BLOCK:
            self.put("\n")
        elif name == "sup" and not closing:
            self.put("^")
        if void:
            return
        if closing:
            self.close(step)
        elif name in ("div", "section", "aside", "nav", "footer", "header", "span", "p", "ul", "ol", "table", "form", "figure", "script", "style", "ref"):
            self.open("reference" if name == "ref" else step)

    # Wiki
    def on_wiki_template(self, raw: str) -> None:
        name, *fields = raw[2:-2].split("|")
        path = "template." + _DIGITS.sub("", name.strip().lower())
        inner = "; ".join(f.partition("=")[2] or f for f in fields)
        self.score(path, inner)
        if not self.voted("template", path):
            self.put(inner)

    def on_wiki_link(self, raw: str) -> None:
        if raw.startswith("[["):
            target, _, label = raw[2:-2].partition("|")
            prefix = target.partition(":")[0].strip().lower()
            if ":" in target and prefix in ("thể loại", "category", "file", "image", "tập tin", "hình"):
                self.score("category." + prefix, "")
                if not self.voted("category", "category." + prefix):
                    self.put(target.partition(":")[2])
            else:
                self.put(label or target)
        else:
            self.put(raw[1:-1].partition(" ")[2] or raw[1:-1])

    def on_wiki_style(self, raw: str) -> None:
        self.put(raw.strip("'"))

    def on_wiki_heading(self, raw: str) -> None:
        bare = raw.strip()
        level = min(len(bare) - len(bare.lstrip("=")), len(bare) - len(bare.rstrip("=")))
        self.put("\n\n" + "#" * level + " " + bare.strip("= ") + "\n")

    def on_wiki_table(self, raw: str) -> None:
        self.put("\n")

    # Markdown: its structure is the form that is kept
    def on_md_fence(self, raw: str) -> None:
        self.put(raw)

    on_md_heading = on_md_table = on_md_list = on_md_quote = on_md_rule = on_md_fence

    def on_md_setext(self, raw: str) -> None:
        title, line = raw.split("\n", 1)
        self.put(("# " if line.startswith("=") else "## ") + title)

    def on_md_link(self, raw: str) -> None:
        if raw.startswith("<"):
            self.put(raw[1:-1])
        else:
            self.put(raw.lstrip("!")[1:].rpartition("](")[0])

    def on_md_strong(self, raw: str) -> None:
        self.put(raw[2:-2])

    on_md_strike = on_md_strong

    def on_md_emphasis(self, raw: str) -> None:
        self.put(raw[1:-1])

    on_md_code = on_md_emphasis

    # LaTeX: formulas are kept as they are
    def on_tex_display(self, raw: str) -> None:
        self.put(raw)

    on_tex_inline = on_tex_script = on_tex_display

    def on_tex_environment(self, raw: str) -> None:
        self.put("\n")

    def on_tex_command(self, raw: str) -> None:
        name = raw[1:].partition("[")[0].rstrip("*")
        if name in ("section", "chapter", "title"):
            self.put("\n\n# ")
        elif name in ("subsection", "subsubsection", "paragraph"):
            self.put("\n\n## ")
        elif name == "item":
            self.put("\n- ")
        elif name not in ("textbf", "textit", "texttt", "textsc", "textrm", "emph", "underline", "label", "centering"):
            self.put(raw)

    def text(self) -> str:
        t = "".join(self.out)
        t = re.sub(r"(?m)^(#+ )\{([^{}\n]*)\}", r"\1\2\n", t)
        t = re.sub(r"(?<![\w\\}\^_])\{([^{}\\$^_=;\n]*)\}", r"\1", t)
        t = re.sub(r"[ \t]+(?=\n)", "", t)
        return re.sub(r"\n{3,}", "\n\n", t).strip()


def read(text: str, losing: frozenset[str] = frozenset()) -> tuple[str, dict[str, int], dict[str, int]]:
    """(clean text, pieces by family html/wiki/md/tex, scores by path)."""
    page = _Page(text, losing)
    return page.text(), page.kinds, page.scores


def votes(df: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """(host, losing array<string>): the generalised paths that lost on the pages of a host.

    Scores are added up before the shuffle; a path loses when its pages' scores sum to less than
    nothing. Hosts without a losing path have no row; null hosts count as one host.
    """
    schema = "host string, path string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sums: dict[tuple[str | None, str], int] = {}
            for text, host in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    for path, value in read(text)[2].items():
                        if path.rpartition(">")[2].split(".")[0] not in _VOTED:
                            continue
                        sums[host, path] = sums.get((host, path), 0) + value
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in sums], pa.string()), pa.array([p for _, p in sums], pa.string()), pa.array(map(float, sums.values()), pa.float64())], names=["host", "path", "score"])

    ballots = spread(df.select(text_col, F.col(host_col).alias("host"))).mapInArrow(run, schema)
    lost = ballots.groupBy("host", "path").agg(F.sum("score").alias("score")).where("score < 0")
    return lost.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("losing"))


#: Kinds whose signs also stand in program code, and what a line of code looks like.
_UNSURE = frozenset("md_emphasis md_strong md_list md_quote md_rule tex_script tex_inline md_setext wiki_heading wiki_table".split())
_CODE_LINE = re.compile(r"[;{}]\s*$|\w\([^()]*\)\s*[:;{]?\s*$|[=!<>]=|\+\+|->|::|^\s*(?:def|for|if|elif|while|return|int|float|import|print|class|public|private|void|var|let|const|#include)\b")


def ballots(text: str) -> dict[str, int]:
    """The paths of a page's pieces, each with the pieces that speak for it less those that speak against it."""
    out: dict[str, int] = {}
    stack: list[str] = []
    for kind, begin, end in pieces(text):
        path, value = kind, 1
        if kind == "html_tag":
            raw = text[begin:end]
            step = _path(raw)
            path = "html:" + ">".join([*stack[-3:], step])
            if raw.startswith("</"):
                name = step.split(".")[0]
                while stack and stack.pop().split(".")[0] != name:
                    pass
            elif not raw.endswith("/>") and step.split(".")[0] in _BLOCK:
                stack.append(step)
        elif kind in _UNSURE:
            stop = text.find("\n", end)
            around = text[text.rfind("\n", 0, begin) + 1 : begin] + " " + text[end : stop if stop >= 0 else len(text)]
            value = -1 if _CODE_LINE.search(around) else 1
        out[path] = out.get(path, 0) + value
    return out


def marked(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(id, host, paths array<struct<path, votes>>) of each text that holds a piece of markup.

    Null and empty texts have no row; a null host counts as one host; repeated rows stay repeated;
    other columns are ignored; texts are read once and whole, and don't leave their task.
    """
    paths = T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("votes", T.LongType())]))
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("host", T.StringType()), T.StructField("paths", paths)])
    kind = to_arrow_type(paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, found = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text and (own := ballots(text)):
                    at.append(i)
                    found.append([{"path": k, "votes": v} for k, v in own.items()])
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), pa.array(found, kind)], names=schema.names)

    return spread(df.select(F.col(id_col), F.col(text_col), F.coalesce(host_col, F.lit("")))).mapInArrow(run, schema)


def affected(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(id) of the pages that hold a piece of a path that won on their host; one row each."""
    each = kept(marked(df, id_col, text_col, host_col)).select("id", "host", F.explode("paths").alias("p")).select("id", "host", "p.path", "p.votes")
    # Added up before the shuffle; one row per path of a host is left, whatever the pages.
    won = each.groupBy("host", "path").agg(F.sum("votes").alias("total")).where("total > 0").select("host", "path")
    return each.join(won, ["host", "path"], "left_semi").select(F.col("id").alias(id_col)).distinct()


def cleaned(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(id, clean, n_html, n_md, n_wiki, n_tex, dropped array<string>) of every row.

    Null and empty texts stay null and empty with no piece counted. Repeated rows stay repeated;
    columns of df other than these three are ignored, whatever their names; texts are read whole.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(host_col, F.lit("")).alias("host"))
    # One row per host with a losing path. Sent to the tasks if it is small, so that texts stay where
    # they are; else joined, where AQE splits a host that holds many rows.
    losing = kept(votes(source, "text", "host"))
    size = losing.agg(F.count("*"), F.sum(F.size("losing"))).first()
    losing = F.broadcast(losing) if size[0] + (size[1] or 0) <= MOST_BROADCAST_PATHS else losing
    joined = source.join(losing, "host", "left").select("id", "text", "losing")
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("clean", T.StringType()), *(T.StructField(f"n_{k}", T.IntegerType()) for k in ("html", "md", "wiki", "tex")), T.StructField("dropped", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text, losing in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if not text:
                    rows.append((text, 0, 0, 0, 0, []))
                    continue
                lost = frozenset(losing or ())
                clean, kinds, scores = read(text, lost)
                rows.append((clean, *(kinds.get(k, 0) for k in ("html", "md", "wiki", "tex")), sorted(lost & scores.keys())))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=schema.names)

    return joined.mapInArrow(run, schema)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "knowledge_base_qwen")
    return nodes.select("id_", "text", F.regexp_replace("metadata.file_name", r"(?:[\s_.-]+\p{L}*\d+\p{L}*)*(?:\.\p{L}\w*)?$", "").alias("host"))


def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean text of every node with the pieces removed by family and the paths dropped."""
    return cleaned(_pages(spark, sf_dir), "id_", "text", "host").dropDuplicates(["id_"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affected(_pages(spark, sf_dir), "id_", "text", "host")


def p3_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths that lost the vote, by host."""
    return votes(_pages(spark, sf_dir), "text", "host").select("host", F.explode("losing").alias("path"))


QUERIES = {"p3_found": p3_found, "p3_clean": p3_clean, "p3_paths": p3_paths}
