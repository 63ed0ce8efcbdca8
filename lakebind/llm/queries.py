"""The queries of the operators of this subpackage, and the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebind.llm.encoding import encode_corpus
from lakebind.llm.mojibake import repair_encoding
from lakebind.llm.nearcopies import alike_pairs, groups, near_copies
from lakebind.llm.packing import count_tokens, pack
from lakebind.llm.scans import repair_scans
from lakebind.llm.split import split_oversized
from lakebind.llm.stuffing import stuffed_share
from lakebind.llm.topn import top_n_per_group
from lakebind.storage import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The hits that are among the first five of their source_path."""
    hits = table(spark, folder, "retrieval_hits")
    return top_n_per_group(hits, "source_path", "score", "chunk_id", "hit_id", 5).select("hit_id")


def p2_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and descriptions that bear traces of a scan, as continuous paragraphs."""
    parts = (("text", "canonical_texts", "text_id", "text"), ("image", "canonical_images", "image_id", "description"))
    records = [table(spark, folder, name).select(F.lit(kind).alias("record_kind"), F.col(key).alias("record_id"), F.col(text).alias("text")) for kind, name, key, text in parts]
    return repair_scans(records[0].unionByName(records[1]), "record_kind", "record_id", "text").drop("original")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and descriptions that bear traces of a scan."""
    return p2_repaired(spark, folder).select("record_kind", "record_id").distinct()


def p4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every chunk longer than the limit of its kind."""
    limits = table(spark, folder, "chunk_limits")
    chunks = table(spark, folder, "canonical_chunks").select("chunk_id", "text", "source_kind")
    limited = chunks.join(F.broadcast(limits), "source_kind")  # one row for each of the three kinds
    return split_oversized(limited, "chunk_id", "text", "max_chars", "overlap_chars")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks that had to be cut: those with a second piece."""
    return p4_pieces(spark, folder).where(F.col("piece_no") == 2).select("chunk_id").distinct()


def p5_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Records that hold wrongly decoded characters, with the text restored as far as it can be."""
    parts = (("text", "canonical_texts", "text_id", "text"), ("table", "canonical_tables", "table_id", "preview_text"))
    records = [table(spark, folder, name).select(F.lit(kind).alias("record_kind"), F.col(key).alias("record_id"), F.split("source_path", "/")[0].alias("source"), F.col(text).alias("text")) for kind, name, key, text in parts]
    repaired = repair_encoding(records[0].unionByName(records[1]), "record_kind", "record_id", "source", "text")
    return repaired.where("wrong").select("record_kind", "record_id", "restored").distinct()


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records that hold wrongly decoded characters."""
    return p5_restored(spark, folder).select("record_kind", "record_id").distinct()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of chunks whose texts have at least 0.6 of their runs of three words in common."""
    members, links = near_copies(table(spark, folder, "canonical_chunks"), "chunk_id", "text", likeness=0.6, run=3, least=20)
    return alike_pairs(members, links, "chunk_id")


def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every chunk of at least 20 words with its group of near copies and its number of links."""
    members, links = near_copies(table(spark, folder, "canonical_chunks"), "chunk_id", "text", likeness=0.6, run=3, least=20)
    return groups(members, links, "chunk_id")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The token ids of every document."""
    return encode_corpus(table(spark, folder, "documents"), "doc_id", "text")


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Containers of 4,096 tokens for all documents."""
    return pack(count_tokens(table(spark, folder, "documents"), "doc_id", "text"), "doc_id", "n_tokens", 4096)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that had to be divided: those with a second piece."""
    return p8_containers(spark, folder).where(F.col("piece_no") == 2).select("doc_id").distinct()


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents more than half of whose text is stuffed."""
    shares = stuffed_share(table(spark, folder, "documents"), "doc_id", "text", "lang")
    return shares.where(F.col("share") > 0.5).select("doc_id")


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_repaired": p2_repaired, "p4_found": p4_found, "p4_pieces": p4_pieces, "p5_found": p5_found, "p5_restored": p5_restored, "p6_found": p6_found, "p6_groups": p6_groups, "p7_ids": p7_ids, "p8_found": p8_found, "p8_containers": p8_containers, "p9_found": p9_found}

SQL = {
    "p1_found": """
        WITH hits AS (
            SELECT source_path, hit_id, chunk_id, max(score) AS score FROM retrieval_hits
            WHERE source_path <> '' AND score IS NOT NULL AND NOT isnan(score) GROUP BY source_path, hit_id, chunk_id)
        SELECT hit_id FROM hits QUALIFY row_number() OVER (PARTITION BY source_path ORDER BY score DESC, chunk_id, hit_id) <= 5""",
    "p4_found": """
        SELECT DISTINCT c.chunk_id FROM canonical_chunks c JOIN chunk_limits l USING (source_kind) WHERE length(c.text) > l.max_chars""",
}
