"""Problem 4: near-duplicate texts by their words, through a vantage-point tree and Hamming distance.

A text's fingerprint holds, in 256 bits, the parity of its words by hash. The Hamming distance of
two fingerprints never exceeds the number of words that the texts don't share, so a similarity
threshold gives a radius that loses no pair. A tree of vantage points (the empty text, whose
distance is the number of words, and texts of a bounded sample) cuts the texts: each node puts those
near to its vantage point on one side and the others on the other, and a text looks for partners on
every side that its radius reaches by the triangle inequality. Distances to a vantage text are
told by the words shared with it, half of what its distance and that of the empty text differ by;
the bounds of both together are tighter there. A node is cut where the sample says that it saves
comparisons, until a leaf is small; what no vantage point can cut is cut into shards by hash. Inside
a shard, fingerprints are compared, and the pairs within the radius are checked exactly on their
words. Texts with equal words are one class and are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_text import Memo, fold, slices, spread, table, word_runs
from ..operators.storage import kept

THRESHOLD = 0.7
#: Texts that the tree is planned with, and how many of them are tried as vantage points. It only affects speed.
SAMPLE, VANTAGES = 2048, 40
#: Most texts, and about the most visitors, that one shard holds.
SHARD = 32768
#: Comparisons that a leaf may need, and the share of a node's that a cut has to save.
LEAF_PAIRS, LEAST_SAVING = 1 << 28, 0.04
#: Texts of the sample below which a node isn't cut; bounds the number of leaves.
LEAST_SAMPLE = 24
BITS = 256
_WORDS = BITS // 64
BIT_COLUMNS = [f"b{w}" for w in range(_WORDS)]


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(fold(word))


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(salt)
    return h ^ (h >> np.uint64(29))


def word_sets(texts: list[str | None], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct folded words of all texts, and their bounds."""
    sets = []
    for text in texts:
        own = set(map(memo.__getitem__, set(word_runs(text)))) if text else ()
        sets.append(np.fromiter(own, np.uint64, len(own)))
    return np.concatenate(sets) if sets else np.empty(0, np.uint64), np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)


def fingerprints(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint as four integers, two set hashes) of each row."""
    n = len(bounds) - 1
    rows = np.repeat(np.arange(n), np.diff(bounds))
    parity = np.bincount(rows * BITS + (hashes & np.uint64(BITS - 1)).astype(np.int64), minlength=n * BITS) & 1
    bits = np.packbits(parity.reshape(n, BITS).astype(np.uint8), axis=1).view(np.int64)
    totals = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(hashes, salt), dtype=np.uint64)))
        totals.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return bits, totals[0], totals[1]


class Tree:
    """Vantage points, and the cuts that lead a text to its leaf and to the leaves its partners may be in.

    A cut is (coordinate, value, near side, far side); coordinate 0 is the number of words, and k > 0
    the words shared with vantage text k - 1. A negative side -i - 1 is leaf i.
    """

    def __init__(self, texts: list[str], total: int, threshold: float, leaf_pairs: int = LEAF_PAIRS):
        hashes, bounds = word_sets(texts, Memo(_hash))
        sizes = np.diff(bounds)
        held = np.flatnonzero(sizes)
        self.threshold, self.leaves = threshold, 0
        chosen = held[np.linspace(0, len(held) - 1, min(VANTAGES, len(held))).astype(int)] if len(held) else []
        self._vantages([hashes[bounds[i] : bounds[i + 1]] for i in chosen])
        self.cuts: list[list[int]] = []
        self._places = self._reach(hashes, bounds)
        self._weight, self._leaf_pairs = (total / len(held)) ** 2 if len(held) else 0.0, leaf_pairs
        self.root = self._grow(held, held)
        del self._places
        # Only vantage points of a cut are measured from now on.
        used = sorted({c[0] for c in self.cuts} - {0})
        self._vantages([hashes[bounds[i] : bounds[i + 1]] for i in (chosen[k - 1] for k in used)])
        for c in self.cuts:
            c[0] = used.index(c[0]) + 1 if c[0] else 0

    def _vantages(self, sets: list[np.ndarray]) -> None:
        self.vocabulary = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
        self.member = np.array([np.isin(self.vocabulary, s) for s in sets], np.int32).reshape(len(sets), len(self.vocabulary))

    def _reach(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's coordinates, and the least and greatest ones of a partner with no more words.

        Of n words, a partner lacks at most (1 - t) n, and has at most (1 - t) / (1 + t) n others.
        """
        t, n = self.threshold, np.diff(bounds)
        shared = np.zeros((len(self.member), len(n)), np.int64)
        if len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == hashes
            for i, member in enumerate(self.member):
                total = np.concatenate(([0], np.cumsum(member[at] * hit)))
                shared[i] = total[bounds[1:]] - total[bounds[:-1]]
        lacks, adds = np.floor((1 - t) * n + 1e-9).astype(np.int64), np.floor((1 - t) / (1 + t) * n + 1e-9).astype(np.int64)
        least = np.maximum(1, np.ceil(t * n - 1e-9).astype(np.int64))
        return np.vstack([n, shared]), np.vstack([least, np.maximum(0, shared - lacks)]), np.vstack([n, shared + adds])

    def _grow(self, own: np.ndarray, visitors: np.ndarray) -> int:
        x, low, high = self._places
        best = None
        if len(own) >= LEAST_SAMPLE and len(own) * len(visitors) * self._weight > self._leaf_pairs:
            for c in range(len(x)):
                values = x[c, own]
                for cut in np.unique(np.quantile(values, (0.15, 0.3, 0.4, 0.5, 0.6, 0.7, 0.85)).astype(np.int64)):
                    near = float((values <= cut).mean())
                    if 0 < near < 1:
                        cost = near * float((low[c, visitors] <= cut).mean()) + (1 - near) * float((high[c, visitors] > cut).mean())
                        if best is None or cost < best[0]:
                            best = (cost, c, int(cut))
        if best is None or best[0] > 1 - LEAST_SAVING:
            self.leaves += 1
            return -self.leaves
        _, c, cut = best
        at = len(self.cuts)
        self.cuts.append([c, cut, 0, 0])
        self.cuts[at][2] = self._grow(own[x[c, own] <= cut], visitors[low[c, visitors] <= cut])
        self.cuts[at][3] = self._grow(own[x[c, own] > cut], visitors[high[c, visitors] > cut])
        return at

    def places(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The leaf of each text, and the texts that visit each leaf."""
        x, low, high = self._reach(hashes, bounds)
        every = np.arange(len(bounds) - 1)
        leaf, visits = np.zeros(len(every), np.int64), [every[:0]] * self.leaves
        stack = [(self.root, every, every)]
        while stack:
            node, own, visitors = stack.pop()
            if node < 0:
                leaf[own], visits[-node - 1] = -node - 1, visitors
                continue
            c, cut, near, far = self.cuts[node]
            stack.append((near, own[x[c, own] <= cut], visitors[low[c, visitors] <= cut]))
            stack.append((far, own[x[c, own] > cut], visitors[high[c, visitors] > cut]))
        return leaf, visits


def classes(df: DataFrame, id_col: str, text_col: str, threshold: float, leaf_pairs: int = LEAF_PAIRS) -> DataFrame:
    """(id, k1, k2, size, b0..b3, leaf, reach) of each text that has a word, reach being the leaves
    that its partners may be in; a checkpoint."""
    held = df.select(id_col, text_col).where(F.col(text_col).isNotNull())
    sample = [r[0] for r in held.select(text_col).limit(SAMPLE).collect()]
    tree = Tree(sample, held.count(), threshold, leaf_pairs)
    schema = f"id {df.schema[id_col].dataType.simpleString()}, k1 long, k2 long, size int, b0 long, b1 long, b2 long, b3 long, leaf int, reach array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(_hash)
        for batch in slices(batches):
            hashes, bounds = word_sets(batch.column(1).to_pylist(), memo)
            bits, k1, k2 = fingerprints(hashes, bounds)
            leaf, visits = tree.places(hashes, bounds)
            rows = np.concatenate(visits) if visits else np.empty(0, np.int64)
            to = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
            order = np.argsort(rows, kind="stable")
            offsets = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))))
            reach = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(to[order], pa.int32()))
            sizes = np.diff(bounds)
            columns = [batch.column(0), pa.array(k1), pa.array(k2), pa.array(sizes, pa.int32()), *(pa.array(bits[:, w]) for w in range(_WORDS)), pa.array(leaf, pa.int32()), reach]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "k1", "k2", "size", *BIT_COLUMNS, "leaf", "reach"]).filter(pa.array(sizes > 0))

    return kept(spread(held).mapInArrow(run, schema))


#: Bits that are compared first: the fingerprint folded once, whose distances are no greater.
HALF = BITS // 2


def _signs(bits: np.ndarray) -> np.ndarray:
    """Folded fingerprints as rows of +1 and -1: their product is HALF less twice their distance."""
    half = _WORDS // 2
    return np.unpackbits(np.ascontiguousarray((bits[:half] ^ bits[half:]).T).view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def _within(q_bits: np.ndarray, q_size: np.ndarray, d_bits: np.ndarray, d_size: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (visitor, text) with no more words in the text and a distance within the radius.

    Both sides are sorted by size; blocks outside each other's sizes are passed over. Distances of a
    block come from one matrix product, which is exact for these small integers; what is left is
    compared in all bits.
    """
    share = (1 - threshold) / (1 + threshold)
    rows, cols = [], []
    step_q, step_d = 256, 2048
    texts = _signs(d_bits).T if len(d_size) else None
    product = np.empty((step_q, step_d), np.float32)
    for a in range(0, len(q_size), step_q):
        qs = q_size[a : a + step_q]
        low, high = np.searchsorted(d_size, threshold * qs[0] - 1e-9), np.searchsorted(d_size, qs[-1], "right")
        visitors = _signs(q_bits[:, a : a + step_q]) if low < high else None
        for b in range(low, high, step_d):
            end = min(b + step_d, high)
            ds = d_size[b:end]
            most = floor(share * (int(qs[-1]) + int(ds[-1])) + 1e-9)
            out = product[: len(qs), : end - b]
            np.matmul(visitors, texts[:, b:end], out=out)
            at = np.flatnonzero(out.ravel() >= HALF - 2 * most) if out.flags.c_contiguous else np.flatnonzero(np.ascontiguousarray(out) >= HALF - 2 * most)
            if not len(at):
                continue
            i, j = np.divmod(at, end - b)
            distance = np.bitwise_count(q_bits[:, a + i] ^ d_bits[:, b + j]).sum(axis=0, dtype=np.int64)
            ok = (distance <= np.floor(share * (qs[i].astype(np.int64) + ds[j]) + 1e-9)) & (ds[j] <= qs[i]) & (ds[j] >= threshold * qs[i] - 1e-9)
            rows.append(i[ok] + a)
            cols.append(j[ok] + b)
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.empty(0, np.int64), np.empty(0, np.int64))


def candidate_pairs(found: DataFrame, threshold: float, shard: int = SHARD) -> DataFrame:
    """(k1, k2, j1, j2): pairs of classes within the radius, each once.

    found is a checkpoint with one row per text. Only the numbers of texts and visitors of each leaf
    are brought to the driver; the number of leaves is bounded by the sample, not by the data.
    """
    spark = found.sparkSession
    facts = ["size", *BIT_COLUMNS]
    heads = kept(found.groupBy("k1", "k2").agg(*(F.first(c).alias(c) for c in (*facts, "leaf", "reach"))))
    texts = {r["leaf"]: r["count"] for r in heads.groupBy("leaf").count().collect()}
    visitors = {r["leaf"]: r["count"] for r in heads.select(F.explode("reach").alias("leaf")).groupBy("leaf").count().collect()}
    if not texts:
        return spark.createDataFrame([], "k1 long, k2 long, j1 long, j2 long")
    cuts = {leaf: (-(-n // shard), max(1, -(-visitors.get(leaf, 0) // shard))) for leaf, n in texts.items()}
    columns = "shard string, visits boolean, k1 long, k2 long, size int, b0 long, b1 long, b2 long, b3 long"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            named = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            k1 = named["k1"].to_pylist()
            at, shards, visits = [], [], []
            for i, (leaf, reach) in enumerate(zip(named["leaf"].to_pylist(), named["reach"].to_pylist())):
                parts, chunks = cuts[leaf]
                at += [i] * chunks
                visits += [False] * chunks
                shards += [f"{leaf}/{k1[i] % parts}/{chunk}" for chunk in range(chunks)]
                for to in reach:
                    if to in cuts:
                        parts, chunks = cuts[to]
                        chunk = (k1[i] >> 20) % chunks
                        at += [i] * parts
                        visits += [True] * parts
                        shards += [f"{to}/{part}/{chunk}" for part in range(parts)]
            take = pa.array(at, pa.int32())
            pick = [named[c].take(take) for c in ("k1", "k2", *facts)]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.string()), pa.array(visits, pa.bool_()), *pick], names=["shard", "visits", "k1", "k2", *facts])

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("size")
        visits = group.column("visits").to_numpy()
        sides = []
        for side in (group.filter(pa.array(visits)), group.filter(pa.array(~visits))):
            bits = np.stack([side.column(c).to_numpy() for c in BIT_COLUMNS]).view(np.uint64)
            sides.append((bits, side.column("size").to_numpy(), side.column("k1").to_numpy(), side.column("k2").to_numpy()))
        (qb, qs, q1, q2), (db, ds, d1, d2) = sides
        i, j = _within(qb, qs, db, ds, threshold)
        # Of two texts with as many words, one visits; none is its own partner.
        ok = (qs[i] > ds[j]) | (q1[i] > d1[j]) | ((q1[i] == d1[j]) & (q2[i] > d2[j]))
        i, j = i[ok], j[ok]
        return pa.table({"k1": pa.array(q1[i], pa.int64()), "k2": pa.array(q2[i], pa.int64()), "j1": pa.array(d1[j], pa.int64()), "j2": pa.array(d2[j], pa.int64())})

    routed = heads.select("k1", "k2", *facts, "leaf", "reach").mapInArrow(route, columns)
    return routed.groupBy("shard").applyInArrow(compare, "k1 long, k2 long, j1 long, j2 long")


def near_classes(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, leaf_pairs: int = LEAF_PAIRS, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): (id, k1, k2) of every text with a word, and (k1, k2, j1, j2, similarity)
    of every pair of classes whose texts have at least the threshold of their words in common.

    Null and empty texts and texts without a word have no class. An id may occur in several equal
    rows; other columns are ignored. Equal texts, whatever their number, are one class.
    """
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = classes(texts, "id", "text", threshold, leaf_pairs)
    near = kept(candidate_pairs(found, threshold, shard))
    members = found.select("id", "k1", "k2").distinct()
    # The words of one text for each class in a candidate pair.
    wanted = near.select("k1", "k2").unionByName(near.select(F.col("j1").alias("k1"), F.col("j2").alias("k2"))).distinct()
    heads = found.join(wanted, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.min("id").alias("id"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(_hash)
        for batch in slices(batches):
            hashes, bounds = word_sets(batch.column(2).to_pylist(), memo)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["k1", "k2", "w"])

    own = kept(texts.join(heads, "id").select("k1", "k2", "text").dropDuplicates(["k1", "k2"]).mapInArrow(words, "k1 long, k2 long, w array<long>"))
    other = own.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("w").alias("v"))
    shared = F.size(F.array_intersect("w", "v"))
    checked = near.join(own, ["k1", "k2"]).join(other, ["j1", "j2"]).select("k1", "k2", "j1", "j2", (shared / (F.size("w") + F.size("v") - shared)).alias("similarity"))
    return members, checked.where(F.col("similarity") >= threshold)


#: Copies of one text that meet the copies of another in one place.
COPIES = 1024


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of different ids, as the problem asks for, of equal and of similar texts.

    A class of many copies is met in several places: each of its members is put into one of so many
    lots, and what it is joined with goes to all of them.
    """
    members, pairs = near_classes(table(spark, sf_dir, "nodes"), "id", "text")
    lots = members.groupBy("k1", "k2").agg(F.ceil(F.count("*") / COPIES).cast("int").alias("lots"))
    own = kept(members.join(lots, ["k1", "k2"]).withColumn("lot", F.pmod(F.xxhash64("id"), F.col("lots")).cast("int")))
    spread_out = lambda df: df.withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")
    a = own.select(F.col("id").alias("a"), "k1", "k2", "lot")
    b = own.select(F.col("id").alias("b"), F.col("k1").alias("j1"), F.col("k2").alias("j2"), "lot")
    other = spread_out(own.select(F.col("id").alias("b"), "k1", "k2", "lots"))
    equal = a.join(other, ["k1", "k2", "lot"]).where("a < b").select("a", "b")
    left = spread_out(pairs.join(lots, ["k1", "k2"])).join(a, ["k1", "k2", "lot"]).select("a", "j1", "j2")
    right = spread_out(left.join(lots.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), "lots"), ["j1", "j2"]))
    similar = right.join(b, ["j1", "j2", "lot"]).select("a", "b")
    every = equal.unionByName(similar)
    return every.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).where("id_a < id_b").distinct()


def p4_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id_a, id_b, similarity): similar texts as pairs of the smallest ids that have them; copies are in p4_classes."""
    members, pairs = near_classes(table(spark, sf_dir, "nodes"), "id", "text")
    names = kept(members.groupBy("k1", "k2").agg(F.min("id").alias("name")))
    named = pairs.join(names.withColumnRenamed("name", "a"), ["k1", "k2"]).join(names.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.col("name").alias("b")), ["j1", "j2"])
    return named.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), F.round("similarity", 9).alias("similarity"))


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, class_id, n_links): the smallest id with the same words, and the number of classes similar to its own."""
    members, pairs = near_classes(table(spark, sf_dir, "nodes"), "id", "text")
    ends = pairs.select("k1", "k2").unionByName(pairs.select(F.col("j1").alias("k1"), F.col("j2").alias("k2")))
    names = members.groupBy("k1", "k2").agg(F.min("id").alias("class_id"))
    known = names.join(ends.groupBy("k1", "k2").agg(F.count("*").alias("n_links")), ["k1", "k2"], "left")
    return members.join(known, ["k1", "k2"]).select("id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, group_id): groups of nodes linked by pairs, named by their smallest id; one row per node.

    Smallest names are handed along the pairs of classes until none changes; copies of a text are
    one class, so a group of many copies is no hot key.
    """
    members, pairs = near_classes(table(spark, sf_dir, "nodes"), "id", "text")
    names = members.groupBy("k1", "k2").agg(F.min("id").alias("name"))
    links = kept(pairs.select("k1", "k2", "j1", "j2"))
    both = links.unionByName(links.select(F.col("j1").alias("k1"), F.col("j2").alias("k2"), F.col("k1").alias("j1"), F.col("k2").alias("j2")))
    current = kept(names)
    while True:
        heard = both.join(current.select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), "name"), ["j1", "j2"]).groupBy("k1", "k2").agg(F.min("name").alias("heard"))
        new = kept(current.join(heard, ["k1", "k2"], "left").select("k1", "k2", F.least("name", F.coalesce("heard", "name")).alias("name"), (F.col("heard") < F.col("name")).alias("moved")))
        done = new.where("moved").limit(1).count() == 0
        current = new.drop("moved")
        if done:
            return members.join(current, ["k1", "k2"]).select("id", F.col("name").alias("group_id"))


QUERIES = {"p4_found": p4_found, "p4_groups": p4_groups, "p4_pairs": p4_pairs, "p4_classes": p4_classes}
_LINKED = """
WITH RECURSIVE n AS (SELECT DISTINCT id, replace(strip_accents(lower(text)), 'đ', 'd') AS t FROM nodes WHERE trim(text) <> ''),
every AS (SELECT id, list_sort(list_distinct(regexp_extract_all(t, '[\\p{L}\\p{N}]+'))) AS a FROM n),
w AS (SELECT min(id) AS id, a FROM every WHERE len(a) > 0 GROUP BY a),
m AS (SELECT every.id AS id, w.id AS class_id FROM every JOIN w USING (a)),
x AS (SELECT id, len(a) AS n, unnest(a) AS word FROM w),
df AS (SELECT word, count(*) AS c FROM x GROUP BY word),
o AS (SELECT x.id, x.n, x.word, row_number() OVER (PARTITION BY x.id ORDER BY c, x.word) AS i FROM x JOIN df USING (word)),
p AS (SELECT id, n, word FROM o WHERE i <= n - ceil(0.7 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM p a JOIN p b ON a.word = b.word AND a.id < b.id AND b.n >= 0.7 * a.n - 1e-9 AND a.n >= 0.7 * b.n - 1e-9),
s AS (SELECT id_a, id_b, len(list_intersect(a.a, b.a))::DOUBLE / (len(a.a) + len(b.a) - len(list_intersect(a.a, b.a))) AS similarity FROM cand JOIN w a ON a.id = id_a JOIN w b ON b.id = id_b),
links AS (SELECT * FROM s WHERE similarity >= 0.7 - 1e-12),
ends AS (SELECT id_a AS a, id_b AS b FROM links UNION ALL SELECT id_b, id_a FROM links)
"""
SQL = {
    "p4_found": """
WITH n AS (SELECT DISTINCT id, replace(strip_accents(lower(text)), 'đ', 'd') AS t FROM nodes WHERE trim(text) <> ''),
w AS (SELECT id, list_distinct(regexp_extract_all(t, '[\\p{L}\\p{N}]+')) AS a FROM n),
x AS (SELECT id, len(a) AS n, unnest(a) AS word FROM w),
df AS (SELECT word, count(*) AS c FROM x GROUP BY word),
o AS (SELECT x.id, x.n, x.word, row_number() OVER (PARTITION BY x.id ORDER BY c, x.word) AS i FROM x JOIN df USING (word)),
p AS (SELECT id, n, word FROM o WHERE i <= n - ceil(0.7 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM p a JOIN p b ON a.word = b.word AND a.id < b.id AND b.n >= 0.7 * a.n - 1e-9 AND a.n >= 0.7 * b.n - 1e-9)
SELECT id_a, id_b FROM cand JOIN w a ON a.id = id_a JOIN w b ON b.id = id_b
WHERE len(list_intersect(a.a, b.a)) >= 0.7 * (len(a.a) + len(b.a) - len(list_intersect(a.a, b.a))) - 1e-9
""",
    "p4_pairs": _LINKED + "SELECT id_a, id_b, round(similarity, 9) AS similarity FROM links",
    "p4_classes": _LINKED + ", k AS (SELECT a, count(*) AS c FROM ends GROUP BY a) SELECT m.id, m.class_id, coalesce(k.c, 0) AS n_links FROM m LEFT JOIN k ON k.a = m.class_id",
    "p4_groups": _LINKED + ", r AS (SELECT a AS id, b AS other FROM ends UNION SELECT r.id, ends.b FROM r JOIN ends ON ends.a = r.other), g AS (SELECT id, min(other) AS first FROM r GROUP BY id) SELECT m.id, least(m.class_id, coalesce(g.first, m.class_id)) AS group_id FROM m LEFT JOIN g ON g.id = m.class_id",
}
