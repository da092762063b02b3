"""Problem 6: clean speaker turns from timed transcripts.

Segments of a recording are swept in their order. Labels, time stamps, sound notes and hesitation
sounds are read off each segment on its own; what a label stands for is then carried on across
segments. Words that a rolling caption repeats (the longest suffix of one segment that is a prefix
of the next, said by the same speakers) are taken out, so that labels shown again begin no turn;
after a pause longer than the recording's own calibration nothing counts as repeated. Turns split
where the speaker changes, and, for the text of turns, at such pauses.

A recording may hold any share of the rows. Its segments are cut into blocks of consecutive
numbers; windows run inside blocks only, and what one block hands to the next comes from one
summary row per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .arrow_text import slices, spread, table
from .p7_forms import consistent_texts

#: Segments of one recording that are swept together.
BLOCK = 2048
#: Speakers in one grammar of labels; a longer list is cut into so many grammars as it takes.
MOST_SPEAKERS = 10_000
#: Seconds below which a pause never splits a turn, and the quantile of gaps that calibrates it.
LEAST_PAUSE, PAUSE_QUANTILE, PAUSE_FACTOR = 1.5, 0.95, 2.0
#: Words that a caption must repeat, so that they count as repeated.
LEAST_REPEATED = 2
#: Spans after which the text of a turn goes on in a further row at the next block's end, so that rows stay bounded.
PIECE = 16_384

#: Hesitation sounds.
HESITATIONS = "ừ thì|uh huh|ờ|ờm|ừm|ừ|à|ơ|hừm|hm|hmm|mm|mmm|uh|uhm|um|umm|erm|er|ah|eh"
_HESITATION = re.compile(rf"(?<!\w)(?:{HESITATIONS})(?!\w)", re.I)
_TIME = re.compile(r"[\[(<]?\b\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\b[\])>]?|[\[(<]?\b\d{1,2}h\d{1,2}m(?:\d{1,2}s)?\b[\])>]?|--+>|=>")
_NOTE = re.compile(r"\(\([^()\n]{1,60}\)\)|\[[^\[\]\n]{1,60}\]|\([^()\n]{1,60}\)|\{[^{}\n]{1,60}\}|</?[^<>\n]{1,60}>|♪[^♪\n]{0,60}♪|(?<!\*)\*[^*\n]{1,60}\*(?!\*)|♪")
_SPEECH = re.compile(r"[^\W_]")
_TRIGGER = re.compile(r"[:>\]*)]|\s[-–]\s")
#: A sign without which there is no trigger, found faster.
_SIGN = re.compile(r"[:>\]*)–-]")
#: Four letters in a row before any sign that begins a note are speech: time stamps have no two, hesitation sounds three at most.
_PLAIN_SPEECH = re.compile(r"[^(\[{<♪*]*?[^\W\d_]{4}")


class _Fold(dict):
    """Lower case without accents, one character for one, so that places stay the same."""

    def __missing__(self, point: int) -> int:
        import unicodedata

        low = chr(point).lower()
        plain = unicodedata.normalize("NFD", low)[:1] if len(low) == 1 else chr(point)
        self[point] = ord("d" if plain == "đ" else plain)
        return self[point]


_FOLD = _Fold()


def folded(text: str) -> str:
    return text.translate(_FOLD)


class Labels:
    """A grammar of labels made from the list of speakers."""

    def __init__(self, speakers: list[tuple[str, str, list[str] | None]]):
        names: dict[str, str] = {}
        for speaker, label, aliases in speakers:
            for name in [label, *(aliases or [])]:
                if name and name.strip():
                    names[" ".join(folded(name).split())] = speaker
        self.speakers = names
        one = "|".join(sorted((self._pattern(n) for n in names), key=len, reverse=True)) or r"(?!)"
        name = rf"(?:{one})"
        #: The ways to write a label, NAME standing for a name.
        forms = [r"<v[ .]\s*NAME\s*>", r"\[\s*NAME\s*\](?:\s*:(?!\d))?", r"\(\s*NAME\s*\)\s*:", r"\*\*\s*NAME\s*:?\s*\*\*\s*:?", r"(?:>>\s*|(?<![^\s\])>}*-])-\s+)?(?<!\w)NAME(?:\s*:(?![\d/])|\s*>>|\s+[-–]\s+)"]
        self.pattern = re.compile("|".join(f.replace("NAME", name) for f in forms))
        self.name = re.compile(name)

    @staticmethod
    def _pattern(name: str) -> str:
        base, number = re.fullmatch(r"(.*?)\s*(\d*)", name).groups()
        words = r"[\s_-]+".join(re.escape(w) for w in base.split())
        return rf"{words}[\s_-]*#?\s*0*{number}(?!\d)" if number else words + r"(?!\w)"

    def find(self, text: str) -> list[tuple[int, int, int, str]]:
        """(begin, begin of the name, end, speaker) of each label."""
        plain = folded(text)
        out = []
        for m in self.pattern.finditer(plain):
            name = self.name.search(m.group())
            base, number = re.fullmatch(r"(.*?)[\s_#-]*(\d*)", name.group()).groups()
            base = " ".join(re.split(r"[\s_-]+", base.strip()))
            key = f"{base} {int(number)}" if number else base
            speaker = self.speakers.get(key) or self.speakers.get(key.replace(" ", "")) or self.speakers.get(f"{base}{int(number)}" if number else base)
            if speaker:
                out.append((m.start(), m.start() + name.start(), m.end(), speaker))
        return out


def speech(text: str) -> str:
    """A text without time stamps, sound notes and hesitation sounds."""
    return re.sub(r"^[\s.,;:…>-]+|(?<=\s)[.,…]+(?=\s|$)", "", " ".join(_HESITATION.sub(" ", _TIME.sub(" ", _NOTE.sub(" ", text))).split())).strip()


def _says_something(text: str) -> bool:
    return bool(_PLAIN_SPEECH.match(text) or _SPEECH.search(_HESITATION.sub(" ", _TIME.sub(" ", _NOTE.sub(" ", text)))))


def spoken_words(words: str) -> list[str]:
    """The words of a text that speech() gave, in lower case, without bare signs."""
    return [w.lower() for w in words.split() if _SPEECH.search(w)]


def labels_in(text: str, labels: Labels) -> list[tuple[int, int, int, str]]:
    return labels.find(text) if _SIGN.search(text) and _TRIGGER.search(text) else []


def spans(text: str, found: list[tuple[int, int, int, str]]) -> list[tuple[str | None, str]]:
    """(speaker, what follows) of a segment with such labels; None for what stands before the first of them.

    Of labels whose names overlap, the first counts, and the longest of those that begin together;
    signs between two labels belong to the first.
    """
    if not found:
        return [(None, text)]
    cuts, at = [], 0
    for begin, name, end, who in sorted(found, key=lambda f: (f[1], -f[2], f[3])):
        if name >= at:
            cuts.append((max(begin, at), end, who))
            at = end
    starts = [(None, 0), *((who, end) for _, end, who in cuts)]
    return [(who, text[a:b]) for (who, a), b in zip(starts, [*(b for b, _, _ in cuts), len(text)])]


def read_segments(df: DataFrame, speakers: DataFrame, with_text: bool = False, most_speakers: int | None = None) -> DataFrame:
    """(media_id, block, seg_idx, pos, speaker, speaks, before, n, said, start_sec, end_sec[, words]): one row per span.

    Spans without speech are kept only where they hold a label. Null and blank texts have none. n are
    the words of the span and before those of its segment before it; said, on the first span with
    speech, is what all of a segment with labels says. Without text n is 0 where there is no label. A list
    of more speakers than one grammar takes is cut into grammars; each reads the segments, and what
    they found is put together by segment, with the same rows.
    """
    most = most_speakers or MOST_SPEAKERS
    listed = speakers.select("speaker_id", "label", "aliases").distinct()
    grammars = max(1, -(-listed.count() // most))
    times = ["start_sec", "end_sec"]
    said_type = pa.list_(pa.struct([("who", pa.string()), ("words", pa.string())]))
    schema = "media_id string, block int, seg_idx int, pos int, speaker string, speaks boolean, before int, n int, said array<struct<who string, words string>>, start_sec double, end_sec double" + (", words string" if with_text else "")
    # Segments delivered twice are equal but for the time of delivery: their spans are equal as well.
    texts = spread(df.select("media_id", F.col("seg_idx").cast("int").alias("seg_idx"), "text", *times).where(F.col("media_id").isNotNull() & F.col("seg_idx").isNotNull() & (F.trim("text") != "")))

    def grammar(part: int) -> list[tuple]:
        rows = listed.where(F.pmod(F.xxhash64("speaker_id"), F.lit(grammars)) == part).collect()
        return [(r["speaker_id"], r["label"], r["aliases"]) for r in rows]

    known = grammar(0) if grammars == 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = Labels(known) if known is not None else None
        for batch in slices(batches, 8192):
            plain = consistent_texts(batch.column(2))
            given = None if labels else batch.column(batch.num_columns - 1).to_pylist()
            at, pos, speaker, speaks, before, n, said, words = [], [], [], [], [], [], [], []
            for i, text in enumerate(plain):
                found = labels_in(text, labels) if labels else [(f["begin"], f["name"], f["end"], f["who"]) for f in given[i] or ()]
                parts, told, heard, first = spans(text, found), [], 0, None
                for p, (who, part) in enumerate(parts):
                    says = _says_something(part)
                    if says or who:
                        own = speech(part) if with_text or says and len(parts) > 1 else ""
                        if says and first is None:
                            first = len(at)
                        at.append(i)
                        pos.append(p)
                        speaker.append(who)
                        speaks.append(says)
                        before.append(heard)
                        n.append(len(spoken_words(own)))
                        said.append(None)
                        heard += n[-1]
                        if says:
                            told.append((who, own))
                        if with_text:
                            words.append(own)
                if first is not None and len(parts) > 1:
                    said[first] = [{"who": who, "words": own} for who, own in told]
            take = pa.array(at, pa.int32())
            index = batch.column(1).cast(pa.int32()).take(take)
            columns = [batch.column(0).take(take), pa.compute.divide(index, pa.scalar(BLOCK, pa.int32())), index, pa.array(pos, pa.int32()), pa.array(speaker, pa.string()), pa.array(speaks, pa.bool_())]
            columns += [pa.array(before, pa.int32()), pa.array(n, pa.int32()), pa.array(said, said_type), batch.column(3).take(take), batch.column(4).take(take)]
            names = ["media_id", "block", "seg_idx", "pos", "speaker", "speaks", "before", "n", "said", *times]
            if with_text:
                columns.append(pa.array(words, pa.string()))
                names.append("words")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    if grammars == 1:
        return texts.mapInArrow(run, schema)

    def find(part: int) -> DataFrame:
        own = grammar(part)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labels = Labels(own)
            for batch in slices(batches, 8192):
                rows = [(i, *f) for i, text in enumerate(consistent_texts(batch.column(0))) for f in labels_in(text, labels)]
                at, begin, name, end, who = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *(pa.array(x, pa.int32()) for x in (begin, name, end)), pa.array(who, pa.string())], names=["text", "begin", "name", "end", "who"])

        return texts.select("text").distinct().mapInArrow(each, "text string, begin int, name int, end int, who string")

    found = find(0)
    for part in range(1, grammars):
        found = found.unionByName(find(part))
    by_text = found.groupBy("text").agg(F.collect_set(F.struct("begin", "name", "end", "who")).alias("found"))
    return texts.join(by_text, "text", "left").select("media_id", "seg_idx", "text", *times, "found").mapInArrow(run, schema)


def _carried(rows: DataFrame, value: Column, order: list[str], name: str) -> DataFrame:
    """(media_id, block, name): the last value of the blocks before, from one row per block."""
    last = rows.where(value.isNotNull()).groupBy("media_id", "block").agg(F.max_by(value, F.struct(*order)).alias("v"))
    blocks = rows.select("media_id", "block").distinct().join(last, ["media_id", "block"], "left")
    before = Window.partitionBy("media_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("media_id", "block", F.last("v", ignorenulls=True).over(before).alias(name))


def resolved(spans_df: DataFrame) -> DataFrame:
    """The spans that hold speech of a known speaker, with the speaker carried on and starts: whether a turn begins.

    Besides, gap and prior: the time since the span before and its words (with words only); usual: the
    pause that calibrates the recording; cut and removed: how many words of the segment and of the span
    repeat the segment before. A span of which all words are repeated stays in the turn that goes on.
    """
    from ..operators.storage import kept

    with_text = "words" in spans_df.columns
    text = ["words"] if with_text else []
    order = ["seg_idx", "pos"]
    inside = Window.partitionBy("media_id", "block").orderBy(*order)
    earlier, so_far = (inside.rowsBetween(Window.unboundedPreceding, end) for end in (-1, 0))
    carry = _carried(spans_df, F.col("speaker"), order, "carry")
    filled = spans_df.join(carry, ["media_id", "block"]).withColumn("speaker", F.coalesce(F.last("speaker", ignorenulls=True).over(so_far), "carry")).drop("carry")

    # A segment is known to all of its spans, so that the span before tells what the segment before said.
    begins = F.col("before") == 0
    spoken = filled.where("speaks").drop("speaks").withColumn("own", F.last(F.when(begins, F.struct("said", F.col("speaker").alias("by"))), ignorenulls=True).over(so_far)).drop("said")
    span = F.struct("own", "speaker", "end_sec", *text)
    left = F.coalesce(F.lag(span).over(inside), "carry")
    spoken = spoken.join(_carried(spoken, span, order, "carry"), ["media_id", "block"]).withColumn("left", left).drop("carry")
    gap = F.when(F.col("left.speaker").isNotNull(), F.col("start_sec") - F.col("left.end_sec"))
    # Where the segment before has no label, all of its words are of one speaker: no label can be repeated.
    rolls = begins & F.col("left.own.said").isNotNull()
    said = F.coalesce("own.said", F.array(F.struct(F.lit(None).cast("string").alias("who"), F.col("words")))) if with_text else F.col("own.said")
    cut = _repeats(F.when(rolls, F.col("left.own.said")), F.when(rolls, F.col("left.own.by")), F.when(rolls, said))
    # Without text the times are done with once gap is known.
    more = [*text, "start_sec", "end_sec", F.col("left.words").alias("prior")] if with_text else []
    spoken = kept(spoken.select("media_id", "block", *order, "speaker", "before", "n", gap.alias("gap"), cut.alias("cut"), *more))

    pauses = spoken.where("speaker IS NOT NULL AND gap > 0").groupBy("media_id").agg(F.percentile_approx("gap", PAUSE_QUANTILE, 1000).alias("usual"))
    spoken = spoken.join(pauses, "media_id", "left")
    rolling = F.when(begins, F.when(_pause(), 0).otherwise(F.col("cut")))
    spoken = spoken.withColumn("cut", F.last(rolling, ignorenulls=True).over(so_far)).where(F.col("speaker").isNotNull())
    spoken = spoken.withColumn("removed", F.least("n", F.greatest(F.col("cut") - F.col("before"), F.lit(0))))
    fresh = F.when(_anew(), F.col("speaker"))
    goes_on = F.coalesce(F.last(fresh, ignorenulls=True).over(earlier), "carry")
    spoken = spoken.join(_carried(spoken, fresh, order, "carry"), ["media_id", "block"]).withColumn("goes_on", goes_on).drop("carry")
    return spoken.withColumn("starts", F.coalesce(fresh != F.col("goes_on"), fresh.isNotNull())).withColumn("speaker", F.coalesce(fresh, "goes_on")).drop("goes_on").where(F.col("speaker").isNotNull())


def _pause() -> Column:
    """Whether a pause stands before a span; null times never make one."""
    return F.coalesce(F.col("gap") > F.greatest(F.lit(LEAST_PAUSE), PAUSE_FACTOR * F.col("usual")), F.lit(False))


def _anew() -> Column:
    """Whether a span says anything that the segment before didn't."""
    return (F.col("removed") == 0) | (F.col("removed") < F.col("n"))


def _repeats(before: Column, by: Column, after: Column) -> Column:
    """repeated() of each row; 0 where one of the segments is null."""

    def tagged(said, first):
        return [(w, part["who"] or first) for part in said for w in spoken_words(part["words"])]

    @F.arrow_udf("int")
    def count(before: pa.Array, by: pa.Array, after: pa.Array) -> pa.Array:
        out = [0] * len(before)
        for i in pa.compute.indices_nonzero(pa.compute.and_(before.is_valid(), after.is_valid())).to_pylist():
            out[i] = repeated(tagged(before[i].as_py(), by[i].as_py()), tagged(after[i].as_py(), None))
        return pa.array(out, pa.int32())

    return count(before, by, after)


def turn_starts(df: DataFrame, speakers: DataFrame) -> DataFrame:
    """(media_id, seg_idx, speaker_id): the segment of the first word of every turn."""
    from ..operators.storage import kept

    rows = kept(read_segments(df, speakers).distinct())
    return resolved(rows).where("starts").select("media_id", "seg_idx", F.col("speaker").alias("speaker_id")).distinct()


def overlap(before: list[str], after: list[str]) -> int:
    """Length of the longest suffix of before that is a prefix of after (by Knuth-Morris-Pratt)."""
    return next(_overlaps(before, after), 0)


def repeated(before: list[tuple[str, str | None]], after: list[tuple[str, str | None]]) -> int:
    """How many words a segment repeats of the one before, two at least, both as (word, speaker).

    Speakers agree as well; words that stand before any label of the later segment can be anyone's.
    """
    open_words = next((i for i, (_, who) in enumerate(after) if who), len(after))
    speakers = [[who for _, who in side] for side in (before, after)]
    for k in _overlaps([w for w, _ in before], [w for w, _ in after]):
        if k < LEAST_REPEATED:
            break
        if speakers[0][len(before) - k + open_words :] == speakers[1][open_words:k]:
            return k
    return 0


def _overlaps(before: list[str], after: list[str]) -> Iterator[int]:
    """Lengths of the suffixes of before that are prefixes of after, longest first."""
    if not before or not after:
        return
    joined = [*after[: len(before)], None, *before]
    fail = [0] * len(joined)
    for i in range(1, len(joined)):
        k = fail[i - 1]
        while k and joined[i] != joined[k]:
            k = fail[k - 1]
        fail[i] = k + (joined[i] == joined[k])
    k = fail[-1]
    while k:
        yield k
        k = fail[k - 1]


def turns(df: DataFrame, speakers: DataFrame, piece: int = PIECE) -> DataFrame:
    """(media_id, seg_idx, pos, piece, speaker_id, start_sec, end_sec, text) of every turn, with clean text.

    A turn is also split where the pause before a segment exceeds the calibration of its recording.
    Null times never split. Turns, pauses and repeated words are followed over the ends of blocks.
    A turn is one row, of piece 0; only from the stated number of spans on does its text go on in
    rows of pieces 1, 2, ..., which repeat the place, speaker and times of the turn.
    """
    from ..operators.storage import kept

    rows = read_segments(df.dropDuplicates(["media_id", "seg_idx"]), speakers, with_text=True)
    spoken = resolved(kept(rows))
    order = Window.partitionBy("media_id", "block").orderBy("seg_idx", "pos")

    @F.pandas_udf("string")
    def fresh(words, prior, removed):
        def one(w, p, k):
            own = w.split()
            if k:
                spoken = [i for i, x in enumerate(own) if _SPEECH.search(x)]
                return " ".join(own[spoken[k] :] if k < len(spoken) else [])
            cut = overlap([x.lower() for x in p.split()[-len(own) :]], [x.lower() for x in own]) if p and own else 0
            return " ".join(own[cut:] if cut >= LEAST_REPEATED else own)

        return words.combine(prior.fillna(""), lambda w, p: (w, p)).combine(removed, lambda wp, k: one(*wp, k))

    marked = spoken.withColumn("split", (F.col("starts") | (_pause() & _anew())).cast("int"))
    # What a segment repeats is taken out once: what remains is not compared again with the span before.
    compared = (F.col("split") == 0) & ((F.col("cut") == 0) | (F.col("before") > F.col("cut")))
    marked = marked.withColumn("turn", F.sum("split").over(order)).withColumn("words", fresh("words", F.when(compared, F.col("prior")), "removed"))
    parts = F.array_sort(F.collect_list(F.struct("seg_idx", "pos", "words", "start_sec", "end_sec")))
    inside = marked.groupBy("media_id", "block", "turn", "speaker").agg(parts.alias("p"), F.max("split").alias("begins"))
    text = F.array_join(F.filter(F.transform("p", lambda x: x["words"]), lambda w: w != ""), " ")
    place = F.struct(F.col("p")[0]["seg_idx"].alias("seg_idx"), F.col("p")[0]["pos"].alias("pos"))
    times = [F.array_min(F.transform("p", lambda x: x["start_sec"])).alias("start_sec"), F.array_max(F.transform("p", lambda x: x["end_sec"])).alias("end_sec")]
    inside = kept(inside.select("media_id", "block", "speaker", "turn", "begins", F.size("p").alias("n"), place.alias("place"), *times, text.alias("text")))

    # One row per block says how many turns began before it and whether its last turn goes on after it.
    sums = inside.groupBy("media_id", "block").agg(F.sum("begins").alias("begun"), F.max("turn").alias("last"), (F.min("begins") == 0).alias("goes_on"))
    by_block = Window.partitionBy("media_id").orderBy("block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("media_id", "block", "last", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("begun"), F.coalesce(F.lead("goes_on").over(by_block), F.lit(False)).alias("cut"))
    whole = inside.join(sums, ["media_id", "block"]).withColumn("several", (F.col("begins") == 0) | (F.col("cut") & (F.col("turn") == F.col("last")))).withColumn("turn", F.col("turn") + F.col("begun"))
    done = whole.where(~F.col("several")).select("media_id", "place.seg_idx", "place.pos", F.lit(0).alias("piece"), F.col("speaker").alias("speaker_id"), "start_sec", "end_sec", "text")
    # Turns over several blocks, at most two parts a block.
    parts = kept(whole.where("several").select("media_id", "turn", "block", "speaker", "place", "n", "start_sec", "end_sec", "text"))
    key = ["media_id", "turn"]
    passed = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = parts.select(*key, "block", F.floor(F.coalesce(F.sum("n").over(passed), F.lit(0)) / piece).cast("int").alias("piece"))
    of_turn = parts.groupBy(*key).agg(F.min("place").alias("place"), F.first("speaker").alias("speaker_id"), F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"))
    bodies = parts.select(*key, "block", "text").join(pieces, [*key, "block"]).groupBy(*key, "piece").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("p"))
    body = F.array_join(F.filter(F.transform("p", lambda x: x["text"]), lambda w: w != ""), " ")
    return done.unionByName(bodies.join(of_turn, key).select("media_id", "place.seg_idx", "place.pos", "piece", "speaker_id", "start_sec", "end_sec", body.alias("text")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_starts(table(spark, sf_dir, "segments"), table(spark, sf_dir, "speakers"))


def p6_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with its times and clean text."""
    return turns(table(spark, sf_dir, "segments"), table(spark, sf_dir, "speakers"))


QUERIES = {"p6_found": p6_found, "p6_turns": p6_turns}
