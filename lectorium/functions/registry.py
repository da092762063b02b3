"""The library's functions for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name: (arguments, result, body)
_SQL = {
    "norm_spaces": ("x STRING", "STRING", "trim(regexp_replace(x, '(?U)\\\\s+', ' '))"),
    "set_jaccard": ("a ARRAY<STRING>, b ARRAY<STRING>", "DOUBLE", "CASE WHEN size(a) = 0 OR size(b) = 0 THEN 0D ELSE size(array_intersect(a, b)) / size(array_union(a, b)) END"),
    "set_containment": ("a ARRAY<STRING>, b ARRAY<STRING>", "DOUBLE", "CASE WHEN size(a) = 0 OR size(b) = 0 THEN 0D ELSE size(array_intersect(a, b)) / size(array_distinct(a)) END"),
    "vtt_time": ("s DOUBLE", "STRING", "format_string('%02d:%02d:%02d.%03d', CAST(floor(s / 3600) AS BIGINT), CAST(floor((s % 3600) / 60) AS BIGINT), CAST(floor(s % 60) AS BIGINT), CAST((s - floor(s)) * 1000 AS INT))"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Temporary SQL functions; their bodies are inlined, so that Catalyst optimises them like any expression."""
    for name, (given, kind, body) in _SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {kind} RETURN {body}")
    return sorted(_SQL)
