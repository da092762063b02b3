"""Plain functions as columns and as passes, over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

#: Rows whose values a pass holds as Python objects at once.
SLICE_ROWS = 1024


def per_row(returns: str, rule: Callable, *columns: Column) -> Column:
    """rule of the columns' values, row by row; null where the first value is null."""
    kind = to_arrow_type(T.DataType.fromDDL(returns))

    @F.arrow_udf(returns)
    def run(*values: pa.Array) -> pa.Array:
        return pa.array([None if row[0] is None else rule(*row) for row in zip(*(v.to_pylist() for v in values))], kind)

    return run(*columns)


def mapped(df: DataFrame, schema: str | T.StructType, make: Callable[[], Callable[[dict], list[dict]]]) -> DataFrame:
    """The rows that a function gives for each row. make is called once in every task."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = [out for row in batch.slice(at, SLICE_ROWS).to_pylist() for out in rule(row)]
                yield pa.RecordBatch.from_pylist(rows, target)

    return df.mapInArrow(run, kinds)


def in_order(df: DataFrame, keys: list[str], order: list[str], schema: str | T.StructType, rule: Callable[[list[dict]], list[dict]]) -> DataFrame:
    """The rows that a rule gives for all rows of one key, in order. A key's rows must fit into a task."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        place, out = None, []
        for batch in batches:
            for row in batch.to_pylist():
                at = tuple(row[k] for k in keys)
                if held and at != place:
                    out += rule(held)
                    held = []
                    if len(out) >= SLICE_ROWS:
                        yield pa.RecordBatch.from_pylist(out, target)
                        out = []
                place = at
                held.append(row)
        if held:
            out += rule(held)
        yield pa.RecordBatch.from_pylist(out, target)

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, kinds)
