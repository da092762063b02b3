"""Text nodes: keywords, questions, provenance, sanitising, merging, near-duplicate removal.

A node is (course, file_name, chunk_idx, node_idx, part_idx, text, topic, category, keywords,
has_code, question_templates ...). The order of nodes is that of (file, chunk, node, part), always.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import json_text, passages
from ..functions.arrow import in_order, mapped, per_row
from ..functions.text import char_ngrams, jaccard, once
from .storage import among, kept, pressed, without

#: What a model gives for one node.
RAW = "struct<text:string,topic:string,category:string,keywords:array<string>,has_code:boolean,question_templates:array<string>>"
_FINISHED = "text string, topic string, category string, keywords array<string>, has_code boolean, question_templates array<string>"

#: Rows of one key that are compared with each other in one place; more are split into blocks.
HOT_KEY = 4096
#: Nodes of one group whose fingerprints are compared in one place; more are split into blocks.
BLOCK = 1 << 14
#: Rows and columns of fingerprints that are compared at once, so that they stay in a core's cache.
TILE = 64, 1024
#: Links of one group that are decided in one task; a group with more is decided in rounds.
MOST_LINKS = 500_000
#: Buckets in which words are counted to put them into an order from rare to frequent.
BUCKETS = 1 << 16


def infer_keywords(text: Column, most: int = 5) -> Column:
    """Frequent pairs of words first, then single words of three letters or more, no word twice."""
    return per_row("array<string>", lambda t: passages.infer_keywords(passages.match_form(t), most), text)


def validate_keywords(raw: Column, text: Column, topic: Column) -> Column:
    """Given keywords that are valid and stand in the text, topped up from the text, then the topic; at most five."""
    return per_row("array<string>", lambda t, k, p: passages.validate_keywords(k, passages.match_form(t), p or ""), text, raw, topic)


def validate_questions(questions: Column, text: Column) -> Column:
    """Questions of 10 to 250 characters that share a meaningful word with the text; the first three, no two alike."""
    return per_row("array<string>", lambda t, q: passages.validate_questions(q, passages.match_form(t)), text, questions)


def best_quote(text: Column, source: Column, window: int = 3, most: int = 700) -> Column:
    """The run of three sentences of the source that holds most of the text's rare words; '' below a tenth."""
    return per_row("string", lambda t, s: passages.Source(s).quote(passages.match_form(t), window, most), text, source)


def parsed_reply(reply: Column) -> Column:
    """The raw nodes of a model's reply; null, which means an error, if it holds no JSON array.

    A boolean counts only if it is written as one, a list of strings only if it is one.
    """

    def node(e: Column) -> Column:
        some = lambda k: F.get_json_object(e, f"$.{k}")
        meta = lambda k: F.coalesce(some(f"metadata.{k}"), some(k))
        lists = lambda k: F.coalesce(json_text.string_list(e, f"$.metadata.{k}"), json_text.string_list(e, f"$.{k}"))
        flag = F.coalesce(json_text.real_boolean(e, "$.metadata.has_code"), json_text.real_boolean(e, "$.has_code"))
        return F.struct(some("text").alias("text"), meta("topic").alias("topic"), meta("category").alias("category"), lists("keywords").alias("keywords"), flag.alias("has_code"), lists("question_templates").alias("question_templates"))

    return F.transform(json_text.elements(reply), node).cast(f"array<{RAW}>")


def finisher(names: list[str], min_words: int = 28, max_words: int = 500, min_overlap: float = 0.52, min_unique: float = 0.30, provenance: bool = False) -> Callable[[dict], list[dict]]:
    """The rule of sanitize for the row of one chunk. names: the columns that its nodes keep."""

    def finish(row: dict) -> list[dict]:
        out: list[dict] = []
        raw = row["nodes"] or []
        source = passages.Source(row["chunk_text"]) if raw else None
        passes = lambda t, norm: passages.drop_reason(t, norm) == "keep" and passages.gate(t, norm, source.tokens, min_words, max_words, min_overlap, min_unique)
        for node_idx, r in enumerate(raw):
            text = passages.clean_text((r and r["text"]) or "")
            norm = passages.text_form(text)
            if not passes(text, norm):
                continue
            topic = passages.topic(r["topic"], text)
            code = passages.contains_code(text) if r["has_code"] is None else r["has_code"]
            shared = {k: row[k] for k in names} | {"node_idx": node_idx, "topic": topic, "category": passages.category(r["category"]), "has_code": code}
            shared |= {"keywords": passages.validate_keywords(r["keywords"], norm, topic or ""), "question_templates": passages.validate_questions(r["question_templates"], norm)}
            parts = passages.oversized_parts(text, max_words)
            for part_idx, part in enumerate(parts):
                own = norm if len(parts) == 1 else passages.match_form(part)
                if len(parts) == 1 or passes(part, own):
                    from_source = {"source_coverage": source.coverage(own), "source_quote": source.quote(own)} if provenance else {}
                    out.append(shared | {"part_idx": part_idx, "text": part} | from_source)
        return out

    return finish


def sanitize(extracted: DataFrame, min_words: int = 28, max_words: int = 500, min_overlap: float = 0.52, min_unique: float = 0.30, provenance: bool = False) -> DataFrame:
    """Raw nodes to finished ones, one row each.

    extracted: one row per chunk with course, file_name, subject, chunk_idx, chunk_text and nodes, an
    array of RAW. A source is read once for all its nodes. Null arrays and missing texts become no
    node; other missing fields get their defaults. The rules run on the whole text first and on each
    part of a long one again.
    """
    place = [f for f in extracted.schema.fields if f.name in ("course", "file_name", "subject", "chunk_idx")]
    added = T.StructType.fromDDL("node_idx int, part_idx int, " + _FINISHED + (", source_coverage double, source_quote string" if provenance else ""))
    names = [f.name for f in place]

    finished = mapped(extracted.select(*names, "chunk_text", "nodes"), T.StructType([*place, *added.fields]), lambda: finisher(names, min_words, max_words, min_overlap, min_unique, provenance))
    return named(finished)


def named(finished: DataFrame) -> DataFrame:
    """Finished nodes with their id, a hash of their place."""
    key = F.concat_ws("\u0001", *(F.col(c).cast("string") for c in ("course", "file_name", "chunk_idx", "node_idx", "part_idx")))
    return finished.withColumn("page", F.lit(None).cast("int")).withColumn("id", F.sha2(key, 256))


def file_nodes(finished: DataFrame, group: list[str], first: float, second: float) -> DataFrame:
    """The nodes of each file without near-duplicates, short ones merged, and again without near-duplicates.

    A file's nodes come from a text that was one row, so they fit into a task.
    """

    return in_order(finished, group, ["chunk_idx", "node_idx", "part_idx"], finished.schema, lambda rows: file_rule(rows, first, second))


def file_rule(rows: list[dict], first: float, second: float) -> list[dict]:
    """What file_nodes leaves of one file's nodes, in order."""

    def distinct(held: list[dict], threshold: float) -> list[dict]:
        if len(held) == 1:
            return held if passages.text_form(held[0]["text"] or "") else []
        return [held[i] for i in passages.first_of_alike([passages.Keyed(r["text"], r["topic"]) for r in held], threshold)]

    return distinct(passages.merge_short(distinct(rows, first)), second)


def merge_short(nodes: DataFrame, group: list[str], order: str, min_words: int = 28, max_words: int = 220) -> DataFrame:
    """(group, order, text, topic, category, question_templates): short neighbours of like topic and category as one.

    Groups of up to three nodes stay as they are. The head keeps its place, topic and category, and
    gets the first three of both nodes' questions. A group is one file's nodes, as each merge decides
    the next.
    """
    none = F.array().cast("array<string>")
    rows = nodes.select(*group, order, *(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "topic", "category")), F.coalesce("question_templates", none).alias("question_templates"))
    return in_order(rows, group, [order], rows.schema, lambda held: passages.merge_short(held, min_words, max_words))


# ---- near-duplicates


def _features(nodes: DataFrame, group: list[str], order: str, text_col: str, topic_col: str) -> DataFrame:
    """(group, o, key, tok, top, n, f0..f3) of each node with a key: hashes of its distinct words and
    of its topic's, and 256 bits with the parity of its words by hash.

    Two fingerprints differ in no more bits than there are words that the texts don't share.
    """
    own = nodes.select(*group, F.col(order).alias("o"), F.coalesce(text_col, F.lit("")).alias("text"), F.coalesce(topic_col, F.lit("")).alias("topic"))
    keys = [own.schema[c] for c in [*group, "o"]]
    schema = T.StructType([*keys, *T.StructType.fromDDL("key string, tok array<bigint>, top array<bigint>, n int, f0 bigint, f1 bigint, f2 bigint, f3 bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def number(w: str) -> int:
            if w not in known:
                if len(known) > 1 << 18:
                    known.clear()
                known[w] = xxhash.xxh64_intdigest(w)
            return known[w]

        for batch in batches:
            at, norms, toks, tops = [], [], [], []
            for i, (text, topic) in enumerate(zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist())):
                if norm := passages.match_form(text):
                    at.append(i)
                    norms.append(norm)
                    toks.append(np.fromiter(map(number, set(norm.split(" "))), np.uint64))
                    tops.append(np.sort(np.fromiter(map(number, passages.meant(passages.match_form(topic).split())), np.uint64)))
            lists = []
            for sets in (toks, tops):
                bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                lists.append((bounds, flat))
            bounds, flat = lists[0]
            rows = np.repeat(np.arange(len(at)), np.diff(bounds))
            parity = np.bincount(rows * 256 + (flat & np.uint64(255)).astype(np.int64), minlength=len(at) * 256) & 1
            bits = np.packbits(parity.reshape(len(at), 256).astype(np.uint8), axis=1).view(np.int64)
            take = pa.array(at, pa.int32())
            arrays = [pa.ListArray.from_arrays(pa.array(b), pa.array(f.view(np.int64))) for b, f in lists]
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(len(keys))), pa.array(norms, pa.string()), *arrays, pa.array(np.diff(bounds), pa.int32()), *(pa.array(bits[:, k]) for k in range(4))], names=schema.names)

    return own.mapInArrow(run, schema)


def _classes(feat: DataFrame, group: list[str]) -> DataFrame:
    """The first of all nodes of a group that are equal in text and topic words, with its features."""
    rest = ["tok", "n", "f0", "f1", "f2", "f3"]
    return feat.groupBy(*group, "key", "top").agg(F.min("o").alias("o"), *(F.first(c).alias(c) for c in rest))


#: What the pairs' cheap filter needs of a node.
_FACTS = ["n", "f0", "f1", "f2", "f3"]


def _postings(own: DataFrame, group: list[str], sets: str, least: float, counts: np.ndarray, facts: list[str]) -> DataFrame:
    """(group, o, facts, w): the rarest words of each set, so many that two sets that agree by the least share have one in common."""
    held = [own.schema[c] for c in [*group, "o", *facts]]
    schema = T.StructType([*held, T.StructField("w", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(held))
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((flat, counts[(flat % np.uint64(BUCKETS)).astype(np.int64)], rows))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            length = sizes - np.ceil(sizes * least - 1e-9).astype(np.int64) + 1
            pick = order[place < length[rows]]
            take = pa.array(rows[pick], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(len(held))), pa.array(flat[pick].view(np.int64))], names=schema.names)

    return own.select(*group, "o", *facts, sets).mapInArrow(run, schema)


def _met(postings: DataFrame, keys: list[str], group: list[str], fits: Column, hot: int) -> DataFrame:
    """(group, i, j): pairs, i before j, that meet at a key and fit. postings is a checkpoint.

    The rows of a key that has more than the hot number are cut into blocks by their node, and each
    pair of blocks meets in a place of its own; pairs of one block meet where it meets itself.
    """
    often = kept(postings.groupBy(*keys).agg(F.ceil(F.count("*") / hot).cast("int").alias("cuts")).where("cuts > 1"))
    rows, place, apart = postings, list(keys), F.lit(True)
    if not often.isEmpty():
        cut = postings.join(often, keys, "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
        cut = cut.withColumn("b", F.pmod(F.xxhash64("o"), F.col("cuts")).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        rows = kept(cut.withColumn("lo", F.least("b", "x")).withColumn("hi", F.greatest("b", "x")).drop("x", "cuts"))
        place, apart = [*keys, "lo", "hi"], (F.col("i_b") != F.col("j_b")) | (F.col("lo") == F.col("hi"))
    side = lambda k: rows.select(*place, *(F.col(c).alias(f"{k}_{c}") for c in rows.columns if c in ("o", "b", *_FACTS)))
    met = side("i").join(side("j"), place).where((F.col("i_o") < F.col("j_o")) & fits & apart)
    return met.select(*group, F.col("i_o").alias("i"), F.col("j_o").alias("j"))


def _can_agree(least: float) -> Column:
    """Whether the sizes and fingerprints of i_ and j_ allow sets that agree by the least share."""
    sizes = F.least("i_n", "j_n") >= least * F.greatest("i_n", "j_n") - 1e-9
    bits = sum((F.bit_count(F.col(f"i_f{k}").bitwiseXOR(F.col(f"j_f{k}"))) for k in range(1, 4)), F.bit_count(F.col("i_f0").bitwiseXOR(F.col("j_f0"))))
    return sizes & (bits <= F.floor((1 - least) / (1 + least) * (F.col("i_n") + F.col("j_n")) + 1e-9))


def _similar(own: DataFrame, group: list[str], threshold: float, hot: int = HOT_KEY) -> DataFrame:
    """(group, i, j, similarity): pairs of classes, given as a table or checkpoint, that count as near-duplicates.

    Two do if their words agree by the threshold, or by less if also their character 4-grams or
    their topics agree. The first two need words that agree by the lower of their thresholds; the
    third needs words and topics that agree: both candidate sets are exact prefix filters, with sizes
    and fingerprints as a strict second filter. Where many nodes share a topic word, they meet at
    that word together with a rare word of the text.
    """
    buckets = F.pmod(F.col("w"), F.lit(BUCKETS)).cast("int")
    seen = own.select(F.explode("tok").alias("w")).groupBy(buckets.alias("bucket")).count().collect()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS, np.int64)
    for r in seen:
        counts[r["bucket"]] = r["count"]
    words = min(threshold, passages.SOFT)
    # What two nodes may meet at: a rare word of their texts, or one of their topics with nothing or a rare word.
    meet = _postings(own, group, "tok", words, counts, _FACTS).select(*group, "o", *_FACTS, "w", F.lit(0).cast("long").alias("v"), F.lit(False).alias("by_topic"))
    topics = own.where(F.size("top") > 0)
    if not topics.isEmpty():
        rare = kept(_postings(topics, group, "top", passages.TOPIC_LEAST, counts, _FACTS))
        often = rare.groupBy(*group, "w").count().where(F.col("count") > hot // 16).drop("count")
        alone = rare.join(often, [*group, "w"], "left_anti").withColumn("v", F.lit(0).cast("long"))
        within = _postings(topics, group, "tok", passages.TOPIC_SOFT, counts, []).withColumnRenamed("w", "v")
        both = rare.join(often, [*group, "w"], "left_semi").join(within, [*group, "o"])
        meet = meet.unionByName(alone.unionByName(both).withColumn("by_topic", F.lit(True)))
    fits = F.when(F.col("by_topic"), _can_agree(passages.TOPIC_SOFT)).otherwise(_can_agree(words))
    cand = _met(kept(meet), [*group, "w", "v", "by_topic"], group, fits, hot)
    return _agreeing(cand.distinct(), own, group, threshold)


def _agreeing(cand: DataFrame, own: DataFrame, group: list[str], threshold: float) -> DataFrame:
    """(group, i, j, similarity): the candidates that count as near-duplicates. own has the features of all their nodes."""
    words = min(threshold, passages.SOFT)
    left = own.select(*group, F.col("o").alias("i"), F.col("key").alias("ki"), F.col("tok").alias("ti"), F.col("top").alias("pi"))
    right = own.select(*group, F.col("o").alias("j"), F.col("key").alias("kj"), F.col("tok").alias("tj"), F.col("top").alias("pj"))
    sim = cand.join(left, [*group, "i"]).join(right, [*group, "j"])
    sim = once(sim, "similarity", jaccard(F.col("ti"), F.col("tj"))).where(F.col("similarity") >= min(words, passages.TOPIC_SOFT))
    by_gram = F.when(F.col("similarity") >= passages.SOFT, jaccard(char_ngrams(F.col("ki")), char_ngrams(F.col("kj"))) >= passages.NGRAM).otherwise(False)
    by_topic = (F.col("similarity") >= passages.TOPIC_SOFT) & (F.size("pi") > 0) & (F.size("pj") > 0) & (jaccard(F.col("pi"), F.col("pj")) >= passages.TOPIC_LEAST)
    return sim.where((F.col("similarity") >= threshold) | by_topic | by_gram).select(*group, "i", "j", "similarity")


def similar_pairs(nodes: DataFrame, group: list[str], order: str, text_col: str = "text", topic_col: str = "topic", threshold: float = 0.76, hot: int = HOT_KEY) -> tuple[DataFrame, DataFrame]:
    """(pairs, membership): (group, i, j, similarity) of classes of a group, i before j, that count as
    near-duplicates, and (group, o, head) of every node with a word.

    Nodes equal in text and topic words are one class, named by the first of them; copies, whatever
    their number, are never paired with each other. Null and empty texts have no class. order is a
    unique number or string of each node; group columns must not be null.
    """
    feat = kept(_features(nodes, group, order, text_col, topic_col))
    heads = kept(_classes(feat, group))
    members = feat.select(*group, "o", "key", "top").join(heads.select(*group, "key", "top", F.col("o").alias("head")), [*group, "key", "top"]).select(*group, "o", "head")
    return _similar(heads, group, threshold, hot), members


def _dropped(links: DataFrame, group: list[str], most: int) -> DataFrame:
    """(group, o): the nodes that go when, in order, each is dropped that has a link to a remaining one before it.

    links is a checkpoint. A group's links are decided in one task up to a number of them; those of
    larger groups in rounds: a node without an undecided earlier neighbour remains, its later
    neighbours go. Both give the same nodes.
    """
    kind = links.schema["i"].dataType
    schema = T.StructType([*(links.schema[g] for g in group), T.StructField("o", kind)])

    def greedy(rows: list[dict]) -> list[dict]:
        gone: dict = {}
        for r in rows:
            if r["i"] not in gone:
                gone.setdefault(r["j"], {**{g: r[g] for g in group}, "o": r["j"]})
        return list(gone.values())

    large = links.groupBy(*group).count().where(F.col("count") > most).drop("count")
    dropped = in_order(links.join(large, group, "left_anti"), group, ["i", "j"], schema, greedy)
    left = links.join(large, group, "left_semi").select(*group, "i", "j")
    if large.isEmpty():
        return dropped
    while True:
        left = kept(left)
        if left.isEmpty():
            return dropped
        later = left.select(*group, F.col("j").alias("i")).distinct()
        remain = left.select(*group, "i").distinct().join(later, [*group, "i"], "left_anti")
        gone = kept(left.join(remain, [*group, "i"], "left_semi").select(*group, F.col("j").alias("o")).distinct())
        dropped = dropped.unionByName(gone)
        for end in ("i", "j"):
            left = left.join(gone.select(*group, F.col("o").alias(end)), [*group, end], "left_anti")
        left = left.join(remain, [*group, "i"], "left_anti").select(*group, "i", "j")


def _marks(nodes: DataFrame, group: list[str], order: str, text_col: str, topic_col: str) -> DataFrame:
    """(group, o, h0, h1, n, f0..f3, m, g) of each node: a 128-bit hash of its match form and its topic's
    words, the number and 256-bit parity of its distinct words, the number and 64-bit parity of its topic's.

    A node without a word has n 0.
    """
    own = nodes.select(*group, F.col(order).alias("o"), F.coalesce(text_col, F.lit("")).alias("text"), F.coalesce(topic_col, F.lit("")).alias("topic"))
    keys = [own.schema[c] for c in [*group, "o"]]
    schema = T.StructType([*keys, *T.StructType.fromDDL("h0 bigint, h1 bigint, n int, f0 bigint, f1 bigint, f2 bigint, f3 bigint, m int, g bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def number(w: str) -> int:
            if w not in known:
                if len(known) > 1 << 18:
                    known.clear()
                known[w] = xxhash.xxh64_intdigest(w)
            return known[w]

        def parity(sets: list[list[int]], bits: int) -> np.ndarray:
            flat = np.fromiter((x % bits for s in sets for x in s), np.int64)
            rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            odd = np.bincount(rows * bits + flat, minlength=len(sets) * bits) & 1
            return np.packbits(odd.reshape(len(sets), bits).astype(np.uint8), axis=1).view(np.int64)

        for batch in batches:
            hashes, toks, tops = [], [], []
            for text, topic in zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist()):
                norm = passages.match_form(text)
                top = passages.meant(passages.match_form(topic).split())
                hashes.append(xxhash.xxh3_128_digest(norm + "\u0001" + " ".join(sorted(top))))
                toks.append([number(w) for w in set(norm.split())])
                tops.append([number(w) for w in top])
            halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            text_bits, topic_bits = parity(toks, 256), parity(tops, 64)
            counts = [pa.array(list(map(len, sets)), pa.int32()) for sets in (toks, tops)]
            found = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), counts[0], *(pa.array(text_bits[:, k]) for k in range(4)), counts[1], pa.array(topic_bits[:, 0])]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), *found], names=schema.names)

    return own.mapInArrow(run, schema)


def _near(marks: DataFrame, group: list[str], threshold: float, block: int) -> DataFrame:
    """(group, i, j): every pair of a group, i before j, whose sizes and fingerprints allow near-duplicates.

    Fingerprints are compared pair by pair, in blocks: nodes are sent as often as their group has
    blocks, and each pair of blocks meets in a place of its own. A prefix filter would send a node
    once for a third of its words; where texts share a vocabulary its pairs are more than all pairs.
    """
    words = min(threshold, passages.SOFT)
    kind = marks.schema["o"].dataType
    held = [marks.schema[g] for g in group]
    schema = T.StructType([*held, T.StructField("i", kind), T.StructField("j", kind)])
    target = to_arrow_schema(schema)

    def agree(least: float, n: np.ndarray, m: np.ndarray, bits: np.ndarray) -> np.ndarray:
        small, large = np.minimum(n, m), np.maximum(n, m)
        return (small >= least * large - 1e-9) & (bits <= np.floor((1 - least) / (1 + least) * (n + m) + 1e-9))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        if not rows.num_rows:
            return
        lo, hi = rows["lo"][0].as_py(), rows["hi"][0].as_py()
        col = {c: rows[c].to_numpy() for c in ("b", "n", "f0", "f1", "f2", "f3", "m", "g")}
        sides = []
        for k, b in enumerate((lo, hi)):
            at = np.flatnonzero(col["b"] == b)
            at = at[np.argsort(col["n"][at], kind="stable")]
            f = [col[c][at].view(np.uint64) for c in ("f0", "f1", "f2", "f3", "g")]
            # Halves put over each other differ in no more bits. No topic agrees with no topic.
            half, other, topic = f[0] ^ f[2], f[1] ^ f[3], (f[4] ^ (f[4] >> np.uint64(32))).astype(np.uint32)
            topic[col["m"][at] == 0] = 0 if k else 2**32 - 1
            sides.append((at, col["n"][at].astype(np.int64), col["m"][at].astype(np.int64), half, other, topic, *f))
        left, right = sides
        share, topic_share = (1 - words) / (1 + words), (1 - passages.TOPIC_LEAST) / (1 + passages.TOPIC_LEAST)
        sizes = min(words, passages.TOPIC_SOFT)
        long, short = np.empty(TILE[0] * TILE[1], np.uint64), np.empty(TILE[0] * TILE[1], np.uint32)
        counts = [np.empty(TILE[0] * TILE[1], np.uint8) for _ in range(2)]
        for a in range(0, len(left[0]), TILE[0]):
            x = slice(a, a + TILE[0])
            n = left[1][x]
            # Only sizes that can agree; within one block each pair once.
            first = max(int(np.searchsorted(right[1], sizes * n[0] - 1e-6)), a if lo == hi else 0)
            last = int(np.searchsorted(right[1], n[-1] / sizes + 1e-6, "right"))
            for c in range(first, last, TILE[1]):
                y = slice(c, min(c + TILE[1], last))
                shape = len(n), y.stop - c
                wide, narrow, bits, more = (v[: shape[0] * shape[1]].reshape(shape) for v in (long, short, *counts))
                np.bitwise_count(np.bitwise_xor(left[3][x, None], right[3][y], out=wide), out=bits)
                np.bitwise_count(np.bitwise_xor(left[4][x, None], right[4][y], out=wide), out=more)
                np.add(bits, more, out=bits)
                np.bitwise_count(np.bitwise_xor(left[5][x, None], right[5][y], out=narrow), out=more)
                some = bits <= min(255, int(share * (n[-1] + right[1][y][-1]) + 1e-9))
                some |= more <= min(255, int(topic_share * (left[2][x].max() + right[2][y].max()) + 1e-9))
                p, q = np.nonzero(some)
                p, q = p + a, q + c
                if lo == hi:
                    p, q = p[p < q], q[p < q]
                if not len(p):
                    continue
                exact = sum(np.bitwise_count(left[k][p] ^ right[k][q]).astype(np.int64) for k in range(6, 10))
                by_topic = (left[2][p] > 0) & (right[2][q] > 0) & agree(passages.TOPIC_LEAST, left[2][p], right[2][q], np.bitwise_count(left[10][p] ^ right[10][q]).astype(np.int64))
                fits = agree(words, left[1][p], right[1][q], exact) | (by_topic & agree(passages.TOPIC_SOFT, left[1][p], right[1][q], exact))
                i, j = rows["o"].take(pa.array(left[0][p[fits]])), rows["o"].take(pa.array(right[0][q[fits]]))
                ends = pa.compute.less(i, j)
                both = pa.compute.if_else(ends, i, j), pa.compute.if_else(ends, j, i)
                apart = pa.compute.not_equal(i, j)
                found = pa.table([*(pa.repeat(rows[g][0], len(i)) for g in group), *both], names=target.names).filter(apart)
                yield from found.cast(target).to_batches()

    cuts = marks.groupBy(*group).agg(F.ceil(F.count("*") / block).cast("int").alias("cuts")).where("cuts > 1")
    cut = marks.join(F.broadcast(cuts), group, "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = cut.withColumn("b", F.pmod(F.xxhash64("o"), F.col("cuts")).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    place = [*group, "lo", "hi"]
    rows = cut.select(*group, F.least("b", "x").alias("lo"), F.greatest("b", "x").alias("hi"), "b", "o", "n", "f0", "f1", "f2", "f3", "m", "g")
    parts = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *place).groupBy(*place).applyInArrow(meet, schema)


def dedupe(nodes: DataFrame, group: list[str], order: str, text_col: str = "text", topic_col: str = "topic", threshold: float = 0.76, most_links: int = MOST_LINKS, hot: int = BLOCK) -> DataFrame:
    """The nodes that remain when, in order, each is dropped that is similar to a remaining one before it.

    That is the first maximal independent set in order, not one node per connected group: of a~b, b~c
    with a and c unlike, a and c remain. Nodes equal in text and topic words are one class (of which
    the first counts) before pairs are made, so that copies never make pairs with each other. Null
    and empty texts are dropped. nodes is read several times, so pass a table or a checkpoint. Only
    fingerprints are shuffled for all nodes; texts only for pairs that these allow, and for what goes.
    """
    own, same = [*group, "o"], [*group, "h0", "h1"]
    every = pressed(_marks(nodes, group, order, text_col, topic_col))
    marks = every.where("n > 0")
    more = kept(marks.groupBy(*same).agg(F.min("o").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"))
    copies = kept(among(marks, more, same).join(more, same).where("o > first").select(*own))
    cand = kept(_near(without(marks, copies, own), group, threshold, hot))
    gone = every.where("n = 0").select(*own).unionByName(copies)
    if not cand.isEmpty():
        ends = kept(cand.select(*group, F.col("i").alias("o")).unionByName(cand.select(*group, F.col("j").alias("o"))).distinct())
        texts = among(nodes.withColumn("o", F.col(order)), ends, own).select(*group, "o", F.col(text_col).alias("text"), F.col(topic_col).alias("topic"))
        links = kept(_agreeing(cand, pressed(_features(texts, group, "o", "text", "topic")), group, threshold).select(*group, "i", "j"))
        if not links.isEmpty():
            gone = gone.unionByName(_dropped(links, group, most_links))
    return without(nodes.withColumn("o", F.col(order)), kept(gone), own).select(*nodes.columns)


def keep_error_free(nodes: DataFrame, errors: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes of files none of whose chunks failed; errors has a row for each failed chunk."""
    return nodes.join(errors.select(*keys).distinct(), keys, "left_anti")
