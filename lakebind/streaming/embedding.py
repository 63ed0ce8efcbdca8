"""Incremental embedding: new chunks of a stream are embedded unless the cache already holds their vector."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakebind.operators.chunking import EmbeddingProvider, embed


def embed_stream(spark: SparkSession, chunks: DataFrame, cache_path: str, checkpoint: str, provider: EmbeddingProvider) -> StreamingQuery:
    """Appends to the cache at ``cache_path`` (a Parquet table keyed by cache_key) what each micro-batch adds.

    Vectors are appended batch by batch, so a failure loses none that was written; a batch that is run again finds its
    keys in the cache and adds nothing.
    """
    def append(batch: DataFrame, _: int) -> None:
        try:
            known = spark.read.parquet(cache_path).select("cache_key", "embedding").dropDuplicates(["cache_key"])
        except AnalysisException as missing:  # nothing was embedded yet; any other failure must not look like that
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            known = None
        _, fresh = embed(batch.dropDuplicates(["chunk_id"]), known, provider)
        fresh.write.mode("append").parquet(cache_path)

    return chunks.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
