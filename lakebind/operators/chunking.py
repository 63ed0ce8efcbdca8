"""Chunks of canonical records, the embedding cache and enrichment merges."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebind.functions import text as T

SIZE, OVERLAP = 1200, 150
#: Characters of a preview that a table without a description is chunked by (a fixed value).
PREVIEW = 6000


def windows(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Sliding windows of collapsed text as structs (index, start_char, end_char, piece); the last one ends with the text."""
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("size must be positive and overlap at least 0 and below it")
    step = size - overlap
    length = F.char_length(text)
    last = F.when(length <= size, 0).otherwise(F.ceil((length - size) / step)).cast("int")
    piece = lambda k: F.struct(
        k.alias("index"), (k * step).cast("int").alias("start_char"), F.least(k * step + size, length).cast("int").alias("end_char"),
        F.substring(text, (k * step + 1).cast("int"), F.lit(size)).alias("piece"))
    return F.transform(F.sequence(F.lit(0), last), piece)


def chunk_records(records: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of records (record_id, source_path, kind, role, locator, text, parser), with stable ids and embedding text.

    A chunk's locator is its record's (``file``, ``image`` or ``table`` where that is empty) with the chunk's number.
    Records without id, path or text, and placeholders, give no chunk.
    """
    rows = records.where((F.coalesce("record_id", F.lit("")) != "") & (F.coalesce("source_path", F.lit("")) != "")).where(~T.is_placeholder(F.col("text"), F.col("parser")))
    rows = rows.withColumn("whole", T.collapse(F.col("text"))).where("whole != ''")
    base = F.coalesce(F.nullif("locator", F.lit("")), F.when(F.col("kind") == "text", "file").otherwise(F.col("kind")))
    out = rows.select("record_id", "source_path", "kind", F.coalesce("role", F.lit("")).alias("role"), base.alias("base"), F.explode(windows(F.col("whole"), size, overlap)).alias("w"))
    out = out.withColumn("locator", F.concat("base", F.lit(";chunk="), F.col("w.index").cast("string")))
    ids = T.stable_id(F.col("record_id"), F.col("kind"), F.col("w.index"), F.col("w.start_char"), F.col("w.end_char"), T.text_hash(F.col("w.piece")))
    embedding_text = F.format_string("Source: %s\nType: %s\nRole: %s\nLocator: %s\n\n%s", "source_path", "kind", "role", "locator", "w.piece")
    return out.select(
        ids.alias("chunk_id"), "source_path", F.col("kind").alias("source_kind"), F.col("record_id").alias("source_record_id"), F.col("role").alias("source_role"),
        "locator", F.col("w.piece").alias("text"), embedding_text.alias("embedding_text"), "w.start_char", "w.end_char")


def table_text(path: Column, columns: Column, preview: Column, description: Column, llm: Column) -> Column:
    """What a table is chunked by: its model description and its structured profile, else its path, columns and preview."""
    def block(label: str, value: Column) -> Column:
        value = F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)^\s+|\s+$", "")
        return F.when(value != "", F.concat(F.lit(label), value))

    described = F.concat_ws("\n\n", block("LLM table description:\n", llm), block("Structured table profile:\n", description))
    head = F.substring(F.regexp_replace(F.coalesce(preview, F.lit("")), r"(?U)^\s+|\s+$", ""), 1, PREVIEW)
    names = F.when(F.size(F.coalesce(columns, F.array().cast("array<string>"))) > 0, F.concat(F.lit("Column names: "), F.array_join(columns, ", ", "None")))
    fallback = F.concat_ws("\n\n", F.concat(F.lit("Source table: "), F.coalesce(path, F.lit(""))), names, F.when(head != "", F.concat(F.lit("Preview:\n"), head)))
    return F.when(described != "", described).otherwise(fallback)


def cache_key(model: str) -> Column:
    return T.stable_id(F.col("chunk_id"), F.lit(model), T.text_hash(F.col("embedding_text")))


def latest_by_key(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of an append-only log for each key."""
    last = Window.partitionBy(key).orderBy(F.desc(order))
    return log.withColumn("rn", F.row_number().over(last)).where("rn = 1").drop("rn")


#: Tokens that a task remembers the places of, at most.
REMEMBERED = 500_000


class EmbeddingProvider(Protocol):
    """What embeds texts; one is made in every task."""

    model: str
    dimension: int

    def embed_batch(self, texts: list[str]) -> list[list[float]]: ...


class HashingProvider:
    """An offline provider: signed hashed token counts, normalised. The same text always has the same vector."""

    def __init__(self, dimension: int = 64):
        self.model, self.dimension, self.known = f"hashing-{dimension}", dimension, {}

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        from hashlib import blake2b

        out = []
        for text in texts:
            vector = [0.0] * self.dimension
            for token in text.lower().split():
                if (place := self.known.get(token)) is None:
                    value = int.from_bytes(blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    place = self.known[token] = value % self.dimension, 1.0 if value >> 63 else -1.0
                vector[place[0]] += place[1]
            norm = sum(x * x for x in vector) ** 0.5 or 1.0
            out.append([x / norm for x in vector])
        return out


def embed(chunks: DataFrame, cache: DataFrame | None, provider: EmbeddingProvider, batch: int = 32) -> tuple[DataFrame, DataFrame]:
    """(vectors, new cache rows): cached vectors are reused by key, the rest are embedded in batches of ``batch``.

    ``cache`` has cache_key and embedding. Only chunks without a cached vector reach the provider.
    """
    keyed = chunks.withColumn("cache_key", cache_key(provider.model))
    known = keyed.join(cache.select("cache_key", "embedding"), "cache_key") if cache is not None else None
    missing = keyed.join(cache, "cache_key", "left_anti") if cache is not None else keyed
    columns = missing.columns

    def embed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column("embedding_text").to_pylist()
            vectors = [v for k in range(0, len(texts), batch) for v in provider.embed_batch(texts[k : k + batch])]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(vectors, pa.list_(pa.float64()))], names=[*columns, "embedding"])

    schema = ", ".join(f"`{c}` {t}" for c, t in missing.dtypes) + ", embedding array<double>"
    fresh = missing.mapInArrow(embed_rows, schema)
    rows = fresh.select("cache_key", "chunk_id", F.lit(provider.model).alias("embedding_model"), T.text_hash(F.col("embedding_text")).alias("embedding_text_hash"), "embedding")
    return (fresh if known is None else known.select(*fresh.columns).unionByName(fresh)), rows


def embedding_report(chunks: DataFrame, fresh: DataFrame, provider: EmbeddingProvider, batch: int = 32) -> DataFrame:
    """One row: chunk_count, embedded_count, reused_count, generated_count, embedding_model, batch_size; ``fresh`` are the new cache rows of ``embed``."""
    counts = chunks.agg(F.count(F.lit(1)).alias("chunk_count")).crossJoin(fresh.agg(F.count(F.lit(1)).alias("embedded_count")))
    return counts.select("chunk_count", "embedded_count", (F.col("chunk_count") - F.col("embedded_count")).alias("reused_count"), F.col("chunk_count").alias("generated_count"), F.lit(provider.model).alias("embedding_model"), F.lit(batch).alias("batch_size"))


def merge_by_key(rows: DataFrame, updates: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """``rows`` with ``columns`` taken from the last update of their key where there is one."""
    last = latest_by_key(updates, key, order).select(key, *[F.col(c).alias(f"new_{c}") for c in columns])
    joined = rows.join(last, key, "left")
    return joined.withColumns({c: F.coalesce(f"new_{c}", c) for c in columns}).drop(*[f"new_{c}" for c in columns])


def first_by_key(df: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key in a given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
