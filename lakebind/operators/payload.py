"""What goes with a ranked source: its kind, reasons, best chunks, score components and summary; judges and enrichers with a cache.

Judges and enrichers call a model in tasks, batch by batch, only for what the cache of earlier replies does not hold; the
cache is a table keyed by a digest of all that the reply depends on, so it is joined, never searched.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebind.functions import text as T

#: Chunks shown with a source, and characters of their text (fixed values).
SHOWN, SNIPPET = 5, 900


def with_payload(ranking: DataFrame, hits: DataFrame, corpus: DataFrame, reason: str, shown: int = SHOWN, texts: bool = True) -> DataFrame:
    """``ranking`` with source_kind, reasons, chunks and source_chunks.

    ``hits`` are the ranked chunks of the retrieval (question_id, chunk_id, source_path, score, rank; optionally reasons,
    an array of a chunk's own). ``chunks`` are the best ones as structs in order of rank, ``reasons`` the distinct ones of
    those and ``reason`` (left out if empty), ``source_chunks`` counts all chunks of the source; without chunks the kind is ``file``.
    Without ``texts`` the chunks have no locator and text, for results that show neither: these would be moved with every chunk.
    """
    keys = ["question_id", "source_path"]
    own = F.col("reasons") if "reasons" in hits.columns else F.array().cast("array<string>")
    best = hits.join(ranking.select(*keys), keys, "left_semi").select(*keys, "chunk_id", "score", "rank", own.alias("reasons"))
    best = best.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))).where(F.col("rn") <= shown)
    said = {"locator": F.col("locator"), "text": T.compact(F.col("text"), SNIPPET)} if texts else {}
    about = corpus.select("chunk_id", "source_kind", *[value.alias(name) for name, value in said.items()]).dropDuplicates(["chunk_id"])
    listed = best.join(about, "chunk_id", "left").groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("rn", "chunk_id", F.round("score", 6).alias("score"), *said))).alias("chunks"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("reasons")))).alias("found"), F.min_by("source_kind", "rn").alias("kind"))
    sizes = corpus.groupBy("source_path").agg(F.countDistinct("chunk_id").alias("source_chunks"))
    out = ranking.join(listed, keys, "left").join(sizes, "source_path", "left")
    given = F.array(F.lit(reason)) if reason else F.array().cast("array<string>")
    return out.select(
        *ranking.columns, F.coalesce("kind", F.lit("file")).alias("source_kind"), F.array_sort(F.array_union(given, F.coalesce("found", F.array().cast("array<string>")))).alias("reasons"),
        "chunks", F.coalesce("source_chunks", F.lit(0)).alias("source_chunks"))


def vector_components(hits: DataFrame, corpus: DataFrame) -> DataFrame:
    """(question_id, source_path, max_chunk_score, mean_top3_chunk_score, matched_chunk_count, matched_chunk_bonus_count, source_chunk_count)."""
    keys = ["question_id", "source_path"]
    ranked = hits.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy("rank")))
    out = ranked.groupBy(*keys).agg(
        F.max("score").alias("max_chunk_score"), F.avg(F.when(F.col("rn") <= 3, F.col("score"))).alias("mean_top3_chunk_score"), F.count(F.lit(1)).alias("matched_chunk_count"),
        F.least(F.count(F.lit(1)), F.lit(3)).alias("matched_chunk_bonus_count"))
    return out.join(corpus.groupBy("source_path").agg(F.countDistinct("chunk_id").alias("source_chunk_count")), "source_path", "left")


def with_summaries(results: DataFrame, summaries: DataFrame) -> DataFrame:
    """Results with the JSON summary of their source; ``{}`` where there is none."""
    columns = [c for c in summaries.columns if c != "source_path"]
    own = summaries.select("source_path", F.to_json(F.struct(*columns)).alias("source_summary"))
    return results.join(own, "source_path", "left").withColumn("source_summary", F.coalesce("source_summary", F.lit("{}")))


def candidate(payload: Column | None = None) -> Column:
    """A result with payload as the JSON that a judge sees; needs source_rank, score and, of ``with_payload``, kind, reasons and chunks."""
    snippets = F.transform(F.slice(F.coalesce("chunks", F.array().cast("array<struct<rn:int,chunk_id:string,score:double,locator:string,text:string>>")), 1, 3), lambda c: F.struct(
        c["rn"].alias("chunk_index"), c["score"].alias("score"), F.coalesce(c["locator"], F.lit("")).alias("locator"), F.substring(F.coalesce(c["text"], F.lit("")), 1, SNIPPET).alias("text")))
    return F.to_json(F.struct(
        F.col("source_rank").alias("rank"), "source_path", "source_kind", F.lower(F.regexp_extract("source_path", r"(\.[^./]+)$", 1)).alias("source_extension"),
        F.round("score", 6).alias("initial_score"), "reasons", snippets.alias("snippets")))


def compact_value(value: object, limit: int) -> str:
    """A value as one line of at most ``limit`` characters: JSON with sorted keys for maps and lists, nothing for nothing."""
    whole = " ".join((json.dumps(value, ensure_ascii=False, sort_keys=True) if isinstance(value, (dict, list)) else str(value or "")).split())
    return whole if len(whole) <= limit else whole[: limit - 3].rstrip() + "..."


def lenient_json(reply: str) -> dict:
    """The object in a model's reply: bare, fenced, or between the first and the last brace; an empty one if there is none."""
    body = re.sub(r"^```\w*|```$", "", (reply or "").strip()).strip()
    for text in (body, body[body.find("{") : body.rfind("}") + 1]):
        try:
            value = json.loads(text)
        except ValueError:
            continue
        return value if isinstance(value, dict) else {}
    return {}


def described(reply: str) -> str:
    """A description from an enricher's reply: its texts, then its lists, each under its name; the reply itself if it holds no object."""
    found = lenient_json(reply)
    if not found:
        return (reply or "").strip()
    title = lambda key: key.replace("_", " ").title()
    shown = lambda v: ", ".join(map(str, v)) if isinstance(v, list) else v
    return "\n".join(f"{title(k)}: {shown(found[k])}" for k in ("description", "visible_text", "objects", "colors", "retrieval_tags") if found.get(k)).strip()


class Model(Protocol):
    """What answers prompts; one is made in every task."""

    name: str

    def ask(self, system: str, prompt: str) -> str: ...


#: What a judge is told, by strategy.
INSTRUCTIONS = {
    "current": "Judge how useful each source is as evidence or data for the question. A table that holds the data a calculation needs is useful even if it does not state the result.",
    "strict": "First say what entities and data the question needs. Keep a source only if it holds them; call it topical_only if it merely shares the topic, task_shape_only if it merely looks alike.",
    "chunk_judge": "Judge every snippet first, then the source: keep it only if a snippet holds evidence, needed data, or a member of the set that is asked for.",
}
SCHEMA = '{"items": [{"source_path": "...", "relevance": 0.0, "evidence_role": "direct_answer|data_item|aggregate_member|context|topical_only|task_shape_only|irrelevant", "keep": true, "reason": "..."}]}'


def asked_with_cache(rows: DataFrame, prompt: Column, system: str, make: Callable[[], Model], model: str, cache: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(rows with reply, new cache rows (digest, reply)): the model is asked only for prompts that the cache does not hold, each once."""
    keyed = rows.withColumn("prompt", prompt).withColumn("digest", F.sha2(F.concat_ws("\x00", F.lit(model), F.lit(system), F.col("prompt")), 256))
    wanted = keyed.select("digest", "prompt").dropDuplicates(["digest"])
    if cache is not None:
        wanted = wanted.join(cache.select("digest"), "digest", "left_anti")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = make()
        for batch in batches:
            replies = [asked.ask(system, p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(replies, pa.string())], names=["digest", "reply"])

    from lakebind.storage import written

    fresh = written(wanted.mapInArrow(ask, "digest string, reply string"), "replies")  # a retried task must not ask again once this stands
    known = fresh if cache is None else fresh.unionByName(cache.select("digest", "reply"))
    return keyed.join(known.dropDuplicates(["digest"]), "digest").drop("prompt"), fresh


def judged(results: DataFrame, questions: DataFrame, make: Callable[[], Model], model: str, strategy: str = "current", cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(scores for ``score_rerank``, new cache rows): one question and all its candidates in each prompt."""
    if strategy not in INSTRUCTIONS:
        raise ValueError(f"Unknown strategy: {strategy}")
    listed = results.groupBy("question_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_rank", candidate().alias("c")))), lambda x: x["c"]), ",\n").alias("l"))
    prompt = F.concat(F.lit("Question:\n"), F.col("question"), F.lit("\n\nCandidates:\n["), F.col("l"), F.lit(f"]\n\nReturn only JSON of this form: {SCHEMA}"))
    replies, fresh = asked_with_cache(questions.select("question_id", "question").join(listed, "question_id"), prompt, INSTRUCTIONS[strategy], make, model, cache)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for question, reply in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                items = lenient_json(reply).get("items")
                for item in items if isinstance(items, list) else ():
                    if isinstance(item, dict) and item.get("source_path"):
                        try:
                            relevance = min(1.0, max(0.0, float(item.get("relevance") or 0.0)))
                        except (TypeError, ValueError):
                            relevance = 0.0
                        out.append((question, str(item["source_path"]), relevance, str(item.get("evidence_role") or ""), bool(item.get("keep", False)), str(item.get("reason") or "")))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = (pa.string(), pa.string(), pa.float64(), pa.string(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["question_id", "source_path", "relevance", "evidence_role", "keep", "judge_reason"])

    scores = replies.select("question_id", "reply").mapInArrow(parse, "question_id string, source_path string, relevance double, evidence_role string, keep boolean, judge_reason string")
    return scores.dropDuplicates(["question_id", "source_path"]), fresh


def select_for_enrichment(rows: DataFrame, key: str, text: str, prefixes: tuple[str, ...] = (), least: int = 0, limit: int | None = None, force: bool = False) -> DataFrame:
    """Rows still to be enriched, in order of their key: below one of the prefixes, described in fewer than ``least`` characters unless ``force``."""
    path = F.replace(F.coalesce("source_path", F.lit("")), F.lit("\\"), F.lit("/"))
    kept = F.lit(not prefixes)
    for prefix in prefixes:
        kept = kept | F.startswith(path, F.lit(prefix.replace("\\", "/")))
    short = F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")) < least
    out = rows.where(kept & (short | F.lit(force or not least)))
    return out if limit is None else out.orderBy(key).limit(limit)


def enriched(rows: DataFrame, key: str, prompt: Column, system: str, make: Callable[[], Model], model: str, cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """((key, description) from a model's replies, new cache rows)."""
    replies, fresh = asked_with_cache(rows, prompt, system, make, model, cache)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([described(r) for r in batch.column(1).to_pylist()], pa.string())], names=[key, "description"])

    return replies.select(key, "reply").mapInArrow(compose, f"{key} {dict(rows.dtypes)[key]}, description string"), fresh


def attach_sources(questions: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Questions with the source_files that a retrieval file lists for them; an empty list where it has none."""
    own = retrieved.groupBy("question_id").agg(F.flatten(F.collect_list("source_files")).alias("source_files"))
    return questions.join(own, "question_id", "left").withColumn("source_files", F.coalesce("source_files", F.array().cast("array<string>")))


def evidence_or_fallback(answers: DataFrame, fallback: DataFrame) -> DataFrame:
    """Answers (question_id, evidences) whose empty evidences are replaced by those of ``fallback`` (question_id, evidences)."""
    joined = answers.join(fallback.select("question_id", F.col("evidences").alias("other")), "question_id", "left")
    return joined.withColumn("evidences", F.when(F.coalesce(F.size("evidences"), F.lit(0)) > 0, F.col("evidences")).otherwise(F.coalesce("other", F.array().cast("array<string>")))).drop("other")
