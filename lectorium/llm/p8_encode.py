"""Problem 8: encoding a corpus with a public byte-level BPE vocabulary, and decoding it again.

The ranked merges are compiled into a finite-state transducer over bytes. It is determinised
lazily: a state is what can still change (the last token that is settled, and the bytes after
it), and a transition is worked out when a text first takes it. A token is emitted as soon as
no continuation can alter it, which a bounded number of further bytes decides (no more than the
longest token has). Arcs over whole pre-tokens that were walked before are kept as compressed
arcs, so that frequent words cost one lookup.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .arrow_text import Memo, slices, spread, table

VOCABULARY_DIR = os.environ.get("LECTORIUM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Fixed value: the pre-token pattern that belongs to the byte-level vocabularies.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class BpeTransducer:
    """Emits the ids of a byte string that ranked pair merging would give."""

    START = (-1, b"")

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.prefixes = {t[:i] for t in ranks for i in range(1, len(t))}
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.fits = Memo(self._fits, 1 << 20)
        self.arcs = Memo(self._arc, 1 << 20)
        self.ends = Memo(self._end, 1 << 20)

    def merge(self, word: bytes) -> list[int]:
        """Ranked pair merging, step by step; only used on pairs of tokens."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether the second token can follow the first, that is, merging never joins across them."""
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == list(pair)

    def _last(self, left: int, pending: bytes) -> list[tuple[int, int]]:
        """For each length of a prefix of the pending bytes, its last token and where that begins."""
        last = [(left, -1)]
        for end in range(1, len(pending) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = self.ranks.get(pending[begin:end])
                if token is not None and last[begin] is not None and (last[begin][0] < 0 or self.fits[last[begin][0], token]):
                    last.append((token, begin))
                    break
            else:
                last.append(None)
        return last

    def _path(self, last: list, end: int) -> list[tuple[int, int]]:
        """Tokens up to a prefix, each with its end."""
        out = []
        while end > 0:
            token, begin = last[end]
            out.append((token, end))
            end = begin
        return out[::-1]

    def _arc(self, key: tuple[tuple[int, bytes], int]) -> tuple[tuple[int, ...], tuple[int, bytes]]:
        (left, pending), byte = key
        pending += bytes([byte])
        last = self._last(left, pending)
        # The paths that a later token can grow from: all places from which the rest begins some token.
        size = len(pending)
        live = [i for i in range(max(0, size - self.longest + 1), size) if pending[i:] in self.prefixes and last[i] is not None] + [size]
        paths = [self._path(last, i) for i in live]
        settled = 0
        while all(len(p) > settled for p in paths) and len({p[settled] for p in paths}) == 1:
            settled += 1
        if not settled:
            return (), (left, pending)
        tokens = paths[0][:settled]
        return tuple(t for t, _ in tokens), (tokens[-1][0], pending[tokens[-1][1] :])

    def _end(self, state: tuple[int, bytes]) -> tuple[int, ...]:
        left, pending = state
        return tuple(t for t, _ in self._path(self._last(left, pending), len(pending)))

    def encode(self, word: bytes) -> tuple[int, ...]:
        state, out, arcs = self.START, [], self.arcs
        for byte in word:
            emitted, state = arcs[state, byte]
            out += emitted
        return tuple(out) + self.ends[state]


class Encoder:
    """Texts to ids: the pre-token pattern over text, then the transducer with compressed arcs."""

    def __init__(self, path: str):
        import regex

        self.transducer = BpeTransducer(load_ranks(path))
        self.pretokens = regex.compile(PRETOKEN).findall
        self.words = Memo(lambda w: self.transducer.encode(w.encode("utf-8")))

    def encode(self, text: str | None) -> Iterator[int]:
        return chain.from_iterable(map(self.words.__getitem__, self.pretokens(text))) if text else iter(())


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_corpus(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """(id, ids array<int>) of each row. Null and empty texts give an empty list; nothing is trimmed.

    Works row by row without a shuffle. Repeated rows stay repeated; other columns are ignored.
    """
    path = path or f"{VOCABULARY_DIR}/{VOCABULARY}"
    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in slices(batches):
            values, ends = array("i"), [0]
            for text in batch.column(1).to_pylist():
                values.extend(enc.encode(text))
                ends.append(len(values))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(values, np.int32)), type=pa.list_(pa.field("element", pa.int32(), False)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, "ids"])

    return spread(df.select(id_col, text_col)).mapInArrow(run, schema)


# UTF-8 decoding as a state machine: classes of bytes, and the state after each class.
# States: 0 complete, 1..3 so many continuation bytes to come, 4..7 the restricted second bytes
# after E0, ED, F0 and F4, 8 invalid.
def _machine() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(256, 11, np.uint8)
    for low, high, k in ((0x00, 0x7F, 0), (0x80, 0x8F, 1), (0x90, 0x9F, 2), (0xA0, 0xBF, 3), (0xC2, 0xDF, 4), (0xE0, 0xE0, 5), (0xE1, 0xEC, 6), (0xED, 0xED, 7), (0xEE, 0xEF, 6), (0xF0, 0xF0, 8), (0xF1, 0xF3, 9), (0xF4, 0xF4, 10)):
        kind[low : high + 1] = k
    step = np.full((9, 12), 8, np.uint8)
    step[0, [0, 4, 5, 6, 7, 8, 9, 10]] = [0, 1, 4, 2, 5, 6, 3, 7]
    for state, to in ((1, 0), (2, 1), (3, 2)):
        step[state, 1:4] = to
    step[4, 3] = 1
    step[5, 1:3] = 1
    step[6, 2:4] = 2
    step[7, 1] = 2
    return kind, step


class Utf8Stream:
    """Text of a stream of tokens: gives out complete characters and keeps a started one for later."""

    KIND, STEP = _machine()

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.state, self.kept = bytes_of, 0, b""

    def feed(self, ids) -> str:
        data, state, done = self.kept + b"".join(map(self.bytes_of.__getitem__, ids)), 0, 0
        if not data.isascii():
            for i, byte in enumerate(data):
                state = self.STEP[state, self.KIND[byte]]
                if state == 8:
                    raise ValueError("the ids are not those of a text")
                if state == 0:
                    done = i + 1
        else:
            done = len(data)
        self.kept, self.state = data[done:], state
        return data[:done].decode("utf-8")

    def end(self) -> None:
        if self.kept:
            raise ValueError("the ids end inside a character")


def decode_corpus(df: DataFrame, id_col: str, ids_col: str = "ids", path: str | None = None, window: int = 4096) -> DataFrame:
    """(id, text) of lists of ids, decoded in windows of tokens. Null gives the empty text."""
    path = path or f"{VOCABULARY_DIR}/{VOCABULARY}"
    schema = T.StructType([df.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = encoder(path).transducer.bytes_of
        for batch in slices(batches):
            out = []
            for ids in batch.column(1).to_pylist():
                stream, ids = Utf8Stream(bytes_of), ids or []
                out.append("".join(stream.feed(ids[i : i + window]) for i in range(0, len(ids), window)))
                stream.end()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, schema)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The round trip: what the ids of each document decode to."""
    return decode_corpus(p8_ids(spark, sf_dir), "doc_id")


QUERIES = {"p8_ids": p8_ids, "p8_decoded": p8_decoded}
SQL = {"p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
