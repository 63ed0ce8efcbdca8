"""lakebind: a PySpark engine for document lakes - ingestion, retrieval, evaluation."""

__version__ = "0.1.0"
