"""Helpers shared by the training-text operators: Arrow batches and word runs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ..sources.tables import read as table
from ..sources.tables import spread

__all__ = ["WORDS", "Memo", "code_points", "fold", "from_code_points", "slices", "spread", "table", "word_runs"]

#: Rows an operator holds at once; bounds a Python worker's memory whatever the Arrow batch size is.
SLICE_ROWS = 2048

WORDS = re.compile(r"[^\W_]+")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows in one array, and each row's bounds in it (null is empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    starts = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, starts[offsets - offsets[0]]


def from_code_points(points: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The inverse of code_points."""
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    ends = np.concatenate(([0], np.cumsum(width)))
    data = points.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(ends[bounds].astype(np.int64).tobytes()), pa.py_buffer(data)).cast(pa.string())


def fold(word: str) -> str:
    """Lower case, without accents, đ as d."""
    plain = unicodedata.normalize("NFD", word.lower())
    return "".join(c for c in plain if not unicodedata.combining(c)).replace("đ", "d")


def word_runs(text: str) -> list[str]:
    """Runs of letters and digits of a text, accents composed so that they don't split words."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if _MARK.search(text):
            text = _MARK.sub("", text)
    return WORDS.findall(text)


_MARK = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿]")


class Memo(dict):
    """A dict that fills itself; emptied when full, so that it stays bounded."""

    def __init__(self, make, most: int = 1 << 18):
        super().__init__()
        self._make, self._most = make, most

    def __missing__(self, key):
        if len(self) >= self._most:
            self.clear()
        value = self[key] = self._make(key)
        return value
