"""Queries of the operator for packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakebind.operators.packed import split_packed
from lakebind.storage import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file of each data_sources that names several."""
    return split_packed(table(spark, folder, "retrieval_questions"), "question_id", "data_sources")


QUERIES = {"p3_found": p3_found}
SQL: dict[str, str] = {}
