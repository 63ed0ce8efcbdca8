"""The retrieval pipeline: configuration, presets, validation and dispatch over all questions at once."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebind.operators import evaluation as E
from lakebind.operators import retrieval as R
from lakebind.storage import cut

MODES = ("lexical", "bm25", "vector", "hybrid")
RERANKERS = ("none", "heuristic", "scores")


@dataclass(frozen=True)
class PipelineConfig:
    """What a run does; the defaults are fixed values."""

    mode: str | None = None
    top_k: int = 20
    vector_chunk_k: int = 200
    vector_aggregation: str = "max_mean_top3"
    hybrid_lexical: str = "bm25"
    hybrid_candidate_k: int = 50
    rrf_k: int = 60
    lexical_weight: float = 1.0
    vector_weight: float = 1.0
    rerank: str = "none"
    rerank_candidate_k: int = 50
    rerank_strategy: str = "current"
    filter_keep_false_zero: bool = False
    expand_folders: bool = False
    folder_max_files: int = 80


#: Named settings (fixed values); the second is the first with folder expansion.
PRESETS = {
    "vector_flash": {"mode": "vector", "vector_chunk_k": 80, "vector_aggregation": "legacy", "rerank": "scores", "rerank_candidate_k": 20},
    "folder_expand_flash": {"mode": "vector", "vector_chunk_k": 80, "vector_aggregation": "legacy", "rerank": "scores", "rerank_candidate_k": 20, "expand_folders": True},
}


def configure(preset: str | None = None, **overrides: object) -> PipelineConfig:
    """The defaults, then the preset, then the overrides that are not None."""
    if preset is not None and preset not in PRESETS:
        raise ValueError(f"Unknown preset: {preset}")
    known = {f.name for f in fields(PipelineConfig)}
    if unknown := set(overrides) - known:
        raise ValueError(f"Unknown settings: {', '.join(sorted(unknown))}")
    return PipelineConfig(**{**(PRESETS[preset] if preset else {}), **{k: v for k, v in overrides.items() if v is not None}})


class Pipeline:
    """Retrieves for a table of questions; every step is one DataFrame plan."""

    def __init__(self, config: PipelineConfig, corpus: DataFrame | None = None, vectors: DataFrame | None = None, scores: DataFrame | None = None, universe: DataFrame | None = None):
        mode = config.mode or ("vector" if vectors is not None else "lexical")
        if mode not in MODES:
            raise ValueError(f"Unknown mode: {mode}")
        if config.rerank not in RERANKERS:
            raise ValueError(f"Unknown reranker: {config.rerank}")
        if mode in ("vector", "hybrid") and vectors is None:
            raise ValueError(f"{mode} retrieval needs vectors")
        if (mode != "vector" or config.rerank == "heuristic") and corpus is None:
            raise ValueError(f"{mode} retrieval with {config.rerank} reranking needs a corpus")
        if config.rerank == "scores" and scores is None:
            raise ValueError("reranking by scores needs a table of scores")
        if config.expand_folders and universe is None:
            raise ValueError("folder expansion needs the universe of files")
        self.config, self.mode, self.corpus, self.vectors, self.scores, self.universe = config, mode, corpus, vectors, scores, universe

    def retrieve(self, questions: DataFrame) -> DataFrame:
        """Ranked sources of all questions (question_id, question, and embedding for vector modes)."""
        c = self.config
        k = c.rerank_candidate_k if c.rerank != "none" else c.top_k
        by_bm25 = self.mode == "bm25" or (self.mode == "hybrid" and c.hybrid_lexical == "bm25")
        kept = cut if c.rerank == "heuristic" else lambda df: df  # the reranker reads the chunks again

        def lexical(n: int) -> tuple[DataFrame, DataFrame]:
            hits = kept(R.bm25_hits(self.corpus, questions, with_path=True) if by_bm25 else R.lexical_hits(self.corpus, questions))
            return hits, R.by_source(hits, 0.05, 4, n) if by_bm25 else R.by_source(hits, R.AGGREGATE, 3, n)

        def vector(n: int) -> tuple[DataFrame, DataFrame]:
            hits = kept(R.top_chunks(R.vector_scores(self.vectors, questions), self.vectors, c.vector_chunk_k))
            return hits, R.vector_sources(hits, c.vector_aggregation, n)

        if self.mode == "vector":
            hits, ranking = vector(k)
        elif self.mode == "hybrid":
            channels = [lexical(c.hybrid_candidate_k), vector(c.hybrid_candidate_k)]
            ranking = R.fuse(channels[0][1], channels[1][1], c.rrf_k, k, (c.lexical_weight, c.vector_weight))
            columns = ("question_id", "chunk_id", "source_path", "score", "rank")
            own = [h.join(r.select("question_id", "source_path"), ["question_id", "source_path"], "left_semi").select(*columns, F.lit(no).alias("list")) for no, (h, r) in enumerate(channels)]
            hits = own[0].unionByName(own[1])
        else:
            hits, ranking = lexical(k)
        if c.rerank == "heuristic":
            ranking = R.heuristic_rerank(hits, ranking, self.corpus, questions, c.top_k)
        elif c.rerank == "scores":
            ranking = R.score_rerank(ranking, self.scores, c.rerank_strategy, c.filter_keep_false_zero, c.top_k)
        if c.expand_folders:
            return R.expand_folders(ranking, questions, self.universe, c.folder_max_files)
        return ranking.withColumn("reason", F.lit(""))

    def evaluate(self, questions: DataFrame, expected: DataFrame, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows, summary) of a run against expected sources."""
        predicted = self.retrieve(questions).select("question_id", F.col("source_path").alias("path")).distinct()
        rows = E.expanded_metrics(questions, expected, predicted, universe)
        return rows, E.summary(rows)


def manifest(config: PipelineConfig, run_name: str, preset: str | None = None, **more: object) -> str:
    """What a run was, as JSON."""
    return json.dumps({"run_name": run_name, "preset": preset, "created_at": int(time.time()), **asdict(config), **more}, sort_keys=True)


def timed(stages: dict[str, Callable[[], object]]) -> tuple[list[dict], float]:
    """Runs stages in order; (name and seconds of each, total seconds)."""
    rows, began = [], time.time()
    for name, stage in stages.items():
        start = time.time()
        stage()
        rows.append({"stage": name, "seconds": round(time.time() - start, 3)})
    return rows, round(time.time() - began, 3)


QUERIES: dict = {}
SQL: dict = {}
