"""Lectorium: a Spark-first engine for lecture transcripts and page extracts."""

__version__ = "0.1.0"
