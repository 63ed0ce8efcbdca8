"""Retrieval, reranking and evaluation queries over the chunks, questions and embeddings.

Searches take every question against all rows; vector searches, evaluations and ``lexical_retrieve`` those whose id is divisible by 50.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebind.functions import text as T
from lakebind.operators import chunking as C
from lakebind.operators import evaluation as E
from lakebind.operators import payload as P
from lakebind.operators import retrieval as R
from lakebind.operators import scoring as S
from lakebind.storage import AGAIN, cut, distinct_rows, table, written

EVERY = 50


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct chunks."""
    return distinct_rows(table(spark, folder, "canonical_chunks").select("chunk_id", "source_path", "source_kind", "source_role", "locator", "text"), "chunk_id")


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct questions that aren't empty."""
    return table(spark, folder, "retrieval_questions").select("question_id", "question").distinct().where(F.trim(F.coalesce("question", F.lit(""))) != "")


def searched(spark: SparkSession, folder: str) -> DataFrame:
    """Those whose id is divisible by 50."""
    return questions(spark, folder).where(F.expr("try_cast(question_id AS bigint)") % EVERY == 0)


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return rows.select(F.concat(F.lit("v"), F.lpad(F.col("vec_id").cast("string"), 9, "0")).alias("chunk_id"), F.concat(F.lit("label_"), F.col("label").cast("string")).alias("source_path"), F.lit("text").alias("source_kind"), "embedding")


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").where(F.col("vec_id") % EVERY == 0)
    return rows.select(F.col("vec_id").cast("string").alias("question_id"), "embedding", "label")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns or ("score",)})


def bm25_topk(spark, folder):
    return rounded(R.bm25(corpus(spark, folder), questions(spark, folder)))


def bm25_with_path(spark, folder):
    return rounded(R.bm25(corpus(spark, folder), questions(spark, folder), with_path=True))


def lexical_retrieve(spark, folder):
    return rounded(R.lexical(corpus(spark, folder), searched(spark, folder)))


def vector_topk(aggregation):
    def query(spark, folder):
        return rounded(R.vector(vectors(spark, folder), vector_queries(spark, folder), aggregation, chunk_k=200 if aggregation != "legacy" else 80))

    return query


def hybrid_rrf(spark, folder):
    """BM25 with and without the path's own score, fused as two channels over the same sources."""
    texts = R.bm25_texts(corpus(spark, folder), questions(spark, folder), with_path=True)
    if texts.alone:
        return rounded(texts.ranked([[1.0, 0.0], [1.0, R.PATH_WEIGHT]], R.CHUNK_K, then=S.source_ranks(texts.kinds(), 0.05, 4, 50, fused=(R.TOP_K, 60))))
    plain, with_path = (R.by_source(texts.hits(scales, R.CHUNK_K), 0.05, 4, 50) for scales in ([1.0, 0.0], [1.0, R.PATH_WEIGHT]))
    return rounded(R.fuse(plain, with_path), "score")


def heuristic_rerank(spark, folder):
    c, q = corpus(spark, folder), questions(spark, folder)
    hits = cut(R.bm25_hits(c, q))
    return rounded(R.heuristic_rerank(hits, R.by_source(hits, 0.05, 4, 50), c, q))


def outside_scores(ranking: DataFrame) -> DataFrame:
    """``ranking`` with deterministic judgements in place of a model's: derived from the digits of the path's hash."""
    digit = F.conv(F.substring(F.sha1("source_path"), 1, 2), 16, 10).cast("int")
    role = F.when(digit % 5 == 0, "irrelevant").when(digit % 5 == 1, "topical_only").when(digit % 5 == 2, "Task_Shape_Only ").otherwise("direct")
    given = {"relevance": digit / 200.0, "evidence_role": role, "keep": digit % 2 == 0}
    return ranking.select("*", *[F.when(digit % 7 != 0, value).alias(column) for column, value in given.items()])


def external_score_rerank(strategy, drop_unkept=False):
    def query(spark, folder):
        ranking = R.bm25(corpus(spark, folder), questions(spark, folder))
        return rounded(R.score_rerank(outside_scores(ranking), None, strategy, drop_unkept))

    return query


def universe(spark, folder):
    return corpus(spark, folder).where(F.coalesce("source_path", F.lit("")) != "").select("source_path").distinct()


def folder_questions(spark, folder):
    """The folders that questions could name, quoted in all the ways that are understood."""
    folders = universe(spark, folder).select(F.regexp_replace("source_path", "/[^/]*$", "").alias("f")).where(F.contains(F.col("f"), F.lit("/"))).distinct()
    digit = F.conv(F.substring(F.sha1("f"), 1, 1), 16, 10).cast("int") % 4
    last = F.element_at(F.split("f", "/"), -1)
    named = F.when(digit == 0, F.concat(F.lit('How many files are in "'), F.col("f"), F.lit('/"?'))).when(digit == 1, F.concat(F.lit("Count `"), F.upper(last), F.lit("` please"))).when(digit == 2, F.concat(F.lit("List 'nowhere' and '"), last, F.lit("'"))).otherwise(F.concat(F.lit("What is in "), F.col("f")))
    return folders.select(F.col("f").alias("question_id"), named.alias("question"))


def folder_expand(spark, folder):
    asked = folder_questions(spark, folder)
    first = universe(spark, folder).select(F.regexp_replace("source_path", "/[^/]*$", "").alias("question_id"), "source_path").groupBy("question_id").agg(F.min("source_path").alias("source_path"))
    ranking = asked.select("question_id").join(first, "question_id").withColumn("score", F.lit(0.5))
    return rounded(R.expand_folders(ranking, asked, universe(spark, folder)), "score")


def expected_sources(spark, folder):
    """What the questions of the searches expect: the values of their data_sources, by position."""
    from lakebind.operators.packed import split_packed

    asked = table(spark, folder, "retrieval_questions").join(searched(spark, folder).select("question_id"), "question_id")
    rows = split_packed(asked, "question_id", "data_sources", least=1)
    return rows.select("question_id", F.col("position_no").alias("ord"), F.col("value").alias("source"))


def predicted(spark, folder):
    """The distinct sources of the logged hits of the questions of the searches."""
    asked = searched(spark, folder).select("question_id")
    hits = table(spark, folder, "retrieval_hits").where(F.coalesce("source_path", F.lit("")) != "")
    return hits.join(asked, "question_id").select("question_id", F.col("source_path").alias("path")).distinct()


def catalog(spark, folder):
    return table(spark, folder, "source_catalog").select("source_path")


def stated(spark, folder):
    """(question_id, evidences): the sources that questions state, split at any delimiter, quotes and brackets left out."""
    asked = table(spark, folder, "retrieval_questions").select("question_id", "data_sources").distinct()
    plain = F.regexp_replace(F.coalesce("data_sources", F.lit("")), r"[\[\]\"' ]", "")
    return asked.select("question_id", F.filter(F.split(plain, "[,;|\t\n]+"), lambda x: x != "").alias("evidences")).groupBy("question_id").agg(F.max("evidences").alias("evidences"))


def _truth(spark, folder):
    """What the searched questions state, by position; every other one states the folders of its sources as patterns."""
    rows = stated(spark, folder).join(searched(spark, folder).select("question_id").distinct(), "question_id")
    rows = rows.select("question_id", F.posexplode("evidences").alias("k", "source"))
    pattern = F.concat(F.regexp_replace("source", "/[^/]*$", ""), F.lit("/*"))
    return rows.select("question_id", (F.col("k") + 1).cast("bigint").alias("ord"), F.when(F.expr("try_cast(question_id AS bigint)") % (2 * EVERY) == 0, pattern).otherwise(F.col("source")).alias("source"))


def evaluate_glob(spark, folder):
    asked = searched(spark, folder).select("question_id").distinct()
    return rounded(E.expanded_metrics(asked, _truth(spark, folder), predicted(spark, folder), catalog(spark, folder)), "recall", "precision", "pattern_recall")


def evaluate_exact(spark, folder):
    asked = searched(spark, folder).select("question_id").distinct()
    return rounded(E.metrics(asked, _truth(spark, folder).select("question_id", "source").distinct(), predicted(spark, folder)), "recall", "precision")


def eval_summary(spark, folder):
    asked = searched(spark, folder).select("question_id")
    return E.summary(E.expanded_metrics(asked, expected_sources(spark, folder), predicted(spark, folder), catalog(spark, folder)))


def eval_diagnostics(spark, folder):
    """Sources that the searched questions state and no logged hit has, and logged sources that none states."""
    return E.diagnostics(_truth(spark, folder).select("question_id", "source").distinct(), predicted(spark, folder))


def scored_vectors(spark, folder):
    scores = R.vector_scores(vectors(spark, folder), vector_queries(spark, folder))
    labels = vector_queries(spark, folder).select("question_id", F.concat(F.lit("label_"), F.col("label").cast("string")).alias("own"))
    return scores.join(vectors(spark, folder).select("chunk_id", "source_path"), "chunk_id").join(labels, "question_id").select("question_id", F.round("score", 9).alias("score"), (F.col("source_path") == F.col("own")).alias("correct"))


def score_separation(spark, folder):
    return rounded(E.separation(scored_vectors(spark, folder)), "max_correct", "max_wrong", "gap")


def score_describe(spark, folder):
    columns = ("min", "p10", "p25", "median", "mean", "p75", "p90", "max")
    return rounded(E.describe(scored_vectors(spark, folder), "score", ["correct"]), *columns)


def hit_score_describe(spark, folder):
    """The distribution of all logged scores of each run."""
    columns = ("min", "p10", "p25", "median", "mean", "p75", "p90", "max")
    hits = table(spark, folder, "retrieval_hits").select("hit_id", "run_name", "score").distinct()
    return rounded(E.describe(hits, "score", ["run_name"]), *columns)


def solution_export(spark, folder):
    """Every question with its ranked absolute paths, as JSON."""
    ranking = R.bm25(corpus(spark, folder), questions(spark, folder))
    listed = ranking.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("source_rank", F.concat(F.lit("/data/"), F.col("source_path")).alias("path")))).alias("l"))
    return questions(spark, folder).join(listed, "question_id", "left").select(
        F.col("question_id").alias("id"), "question", F.to_json(F.transform(F.coalesce("l", F.array().cast("array<struct<source_rank:bigint,path:string>>")), lambda x: x["path"])).alias("source_files"))


def bm25_payload(spark, folder):
    """BM25 sources with their kind, reasons, best five chunks and number of chunks."""
    c = corpus(spark, folder)
    texts = R.bm25_texts(c, questions(spark, folder))
    if texts.alone:  # then the chunks of a source don't leave the task that ranks them, but for those that are shown
        sizes = cut(texts.rows.groupBy("source_path").agg(F.count("chunk_id").alias("source_chunks")))
        sizes = F.broadcast(sizes) if sizes.count() <= AGAIN else sizes
        out = texts.sources([1.0], R.CHUNK_K, 0.05, 4, R.TOP_K, P.SHOWN).join(sizes, "source_path")
        return rounded(out).select("question_id", "source_path", "score", "source_rank", F.coalesce("source_kind", F.lit("file")).alias("source_kind"), F.lit("bm25").alias("reasons"), F.array_join("chunks", ",").alias("chunks"), "source_chunks")
    hits = written(texts.hits([1.0], R.CHUNK_K), "hits")
    out = P.with_payload(R.by_source(hits, 0.05, 4, R.TOP_K).drop("n_chunks"), hits, c, "bm25", texts=False)
    return rounded(out).select("question_id", "source_path", "score", "source_rank", "source_kind", F.array_join("reasons", ",").alias("reasons"), F.array_join(F.transform("chunks", lambda x: x["chunk_id"]), ",").alias("chunks"), "source_chunks")


def vector_components(spark, folder):
    hits = R.top_chunks(R.vector_scores(vectors(spark, folder), vector_queries(spark, folder), 200), vectors(spark, folder), 200)
    return rounded(P.vector_components(hits, vectors(spark, folder)), "max_chunk_score", "mean_top3_chunk_score")


def result_summaries(spark, folder):
    """BM25 sources with the number of records and the kinds that the lake holds of them, as JSON."""
    ranking = R.bm25(corpus(spark, folder), questions(spark, folder)).select("question_id", "source_path", "source_rank")
    parts = [table(spark, folder, f"canonical_{name}").select("source_path", F.lit(name).alias("kind"), F.col(key).alias("id")).distinct() for name, key in (("texts", "text_id"), ("images", "image_id"))]
    summaries = parts[0].unionByName(parts[1]).groupBy("source_path").agg(F.count(F.lit(1)).alias("records"), F.array_join(F.array_sort(F.collect_set("kind")), "+").alias("kinds"))
    return P.with_summaries(ranking, summaries)


def evidence_fallback(spark, folder):
    """The sources that questions state or, where they state none, those of their logged hits, in order."""
    hits = table(spark, folder, "retrieval_hits").where(F.coalesce("source_path", F.lit("")) != "")
    logged = hits.groupBy("question_id").agg(F.array_sort(F.collect_set("source_path")).alias("evidences"))
    return P.evidence_or_fallback(stated(spark, folder), logged).select("question_id", F.array_join("evidences", ",").alias("evidences"))


def hybrid_lexical_vector(spark, folder):
    """BM25 fused with a vector ranking of the same sources; chunks and questions are embedded by the offline provider."""
    c, q = corpus(spark, folder), questions(spark, folder)
    provider = C.HashingProvider()
    # a task has a group of questions for both searches
    texts = R.bm25_texts(c, q, with_path=True, embed=(F.coalesce("text", F.lit("")), provider.embed_batch))
    if texts.alone and texts.vectors is not None:
        then = S.source_ranks(texts.kinds(), 0.05, 4, 50, fused=(R.TOP_K, 60), by_vectors=True)
        return rounded(texts.ranked([[1.0, R.PATH_WEIGHT]], R.CHUNK_K, then=then, by_vectors=200))
    embedded = lambda df, key, text: C.embed(df.select(F.col(key).alias("chunk_id"), F.coalesce(text, F.lit("")).alias("embedding_text")), None, provider)[0].select(F.col("chunk_id").alias(key), "embedding")
    lexical = R.by_source(texts.hits([1.0, R.PATH_WEIGHT], R.CHUNK_K), 0.05, 4, 50)
    # vectors are multiplied in the tasks that make them
    scores = R.vector_scores(embedded(c, "chunk_id", F.col("text")), embedded(q, "question_id", F.col("question")), 200)
    vector = R.vector_sources(R.top_chunks(scores, c, 200), top_k=50)
    return rounded(R.fuse(lexical, vector), "score")


QUERIES = {
    "bm25_payload": bm25_payload, "vector_components": vector_components, "result_summaries": result_summaries, "evidence_fallback": evidence_fallback, "hybrid_lexical_vector": hybrid_lexical_vector,
    "bm25_topk": bm25_topk, "bm25_with_path": bm25_with_path, "lexical_retrieve": lexical_retrieve,
    "vector_topk_max_mean_top3": vector_topk("max_mean_top3"), "vector_topk_legacy": vector_topk("legacy"),
    "hybrid_rrf": hybrid_rrf, "heuristic_rerank": heuristic_rerank,
    "external_score_rerank_current": external_score_rerank("current"), "external_score_rerank_strict": external_score_rerank("strict"),
    "external_score_rerank_chunk": external_score_rerank("chunk_judge", True),
    "folder_expand": folder_expand, "evaluate_glob": evaluate_glob, "evaluate_exact": evaluate_exact, "eval_summary": eval_summary,
    "eval_diagnostics": eval_diagnostics, "score_separation": score_separation, "score_describe": score_describe,
    "hit_score_describe": hit_score_describe, "solution_export": solution_export,
}

# -- the same in SQL --------------------------------------------------------------------------------------------------

_CORPUS = "corpus AS (SELECT DISTINCT chunk_id, source_path, source_kind, source_role, locator, text FROM canonical_chunks)"
_QUESTIONS = "questions AS (SELECT DISTINCT question_id, question FROM retrieval_questions WHERE trim(coalesce(question, '')) <> '')"
_SEARCHED = f"questions AS (SELECT DISTINCT question_id, question FROM retrieval_questions WHERE trim(coalesce(question, '')) <> '' AND TRY_CAST(question_id AS BIGINT) % {EVERY} = 0)"
_DOCUMENT = r"concat_ws(E'\n', nullif(source_path, ''), nullif(source_kind, ''), nullif(source_role, ''), nullif(locator, ''), nullif(text, ''))"


def _tokens(name: str, source: str, key: str, text: str) -> str:
    return f"{name}_raw AS (SELECT {key}, {T.sql_raw_tokens(text)} AS t FROM {source}), {name} AS (SELECT {key}, list_concat(t, {T.sql_synonyms('t')}) AS tokens FROM {name}_raw)"


def _bm25(name: str, text: str, floor: float = 0.0) -> str:
    return f"""{_tokens(f'{name}_tok', 'corpus', 'chunk_id', text)},
    {name}_tf AS (SELECT chunk_id, token, count(*) AS tf FROM (SELECT chunk_id, unnest(tokens) AS token FROM {name}_tok) GROUP BY ALL),
    {name}_len AS (SELECT chunk_id, len(tokens) AS dl FROM {name}_tok),
    {name}_stats AS (SELECT count(*) AS n, greatest(avg(dl), {floor}) AS avgdl FROM {name}_len),
    {name}_idf AS (SELECT token, ln(1 + (n - df + 0.5e0) / (df + 0.5e0)) AS idf FROM (SELECT token, count(*) AS df FROM {name}_tf GROUP BY token), {name}_stats),
    {name} AS (SELECT question_id, chunk_id, sum(qtf * idf * (tf * 2.2e0) / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / avgdl))) AS score
        FROM qtok JOIN {name}_idf USING (token) JOIN {name}_tf USING (token) JOIN {name}_len USING (chunk_id), {name}_stats GROUP BY ALL)"""


_QTOK = f"""{_tokens('q_tok', 'questions', 'question_id', 'question')},
    qtok AS (SELECT question_id, token, count(*) AS qtf FROM (SELECT question_id, unnest(tokens) AS token FROM q_tok) GROUP BY ALL)"""
_BASE = f"{_CORPUS}, {_QUESTIONS}, {_QTOK}"
_BASE_SEARCHED = f"{_CORPUS}, {_SEARCHED}, {_QTOK}"


def _hits(name: str, scores: str, k: int, source: str = "corpus") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, chunk_id) AS rank FROM {scores}) JOIN (SELECT chunk_id, source_path, source_kind FROM {source}) USING (chunk_id)
        WHERE rank <= {k} AND coalesce(source_path, '') <> '')"""


def _sources(name: str, hits: str, weight: str, last: int, k: int, score: str = "") -> str:
    score = score or f"max(score) + {weight} * coalesce(sum(score) FILTER (WHERE rn BETWEEN 2 AND {last}), 0)"
    return f"""{name}_all AS (SELECT question_id, source_path, {score} AS score, count(*) AS n_chunks, min(rank) AS first FROM
            (SELECT *, row_number() OVER (PARTITION BY question_id, source_path ORDER BY rank) AS rn FROM {hits}) GROUP BY ALL),
    {name} AS (SELECT * EXCLUDE (first) FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, first) AS source_rank FROM {name}_all) WHERE source_rank <= {k})"""


_ROUND = "SELECT * REPLACE (round(score, 6) AS score) FROM"
_BM25 = f"{_BASE}, {_bm25('body', _DOCUMENT)}, {_hits('hits', '(SELECT * FROM body WHERE score > 0)', 120)}"
_BOTH = f"""{_bm25('body', _DOCUMENT)}, {_bm25('path', "replace(coalesce(source_path, ''), '/', ' ')", 1.0)},
    both_scores AS (SELECT question_id, chunk_id, sum(score) AS score FROM (SELECT * FROM body UNION ALL SELECT question_id, chunk_id, 1.6e0 * score FROM path) GROUP BY ALL)"""
_VECTORS = f"""vectors AS (SELECT 'v' || lpad(vec_id::VARCHAR, 9, '0') AS chunk_id, 'label_' || label AS source_path, 'text' AS source_kind, embedding::DOUBLE[] AS v FROM embeddings),
    vq AS (SELECT vec_id::VARCHAR AS question_id, embedding::DOUBLE[] AS q, 'label_' || label AS own FROM embeddings WHERE vec_id % {EVERY} = 0),
    vscores AS (SELECT question_id, chunk_id, CASE WHEN list_dot_product(q, q) = 0 OR list_dot_product(v, v) = 0 THEN 0 ELSE list_dot_product(q, v) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v))) END AS score FROM vq, vectors)"""
_OUTSIDE = """outside AS (SELECT question_id, source_path, d / 200.0e0 AS relevance, CASE WHEN d % 5 = 0 THEN 'irrelevant' WHEN d % 5 = 1 THEN 'topical_only' WHEN d % 5 = 2 THEN 'task_shape_only' ELSE 'direct' END AS role, d % 2 = 0 AS keep
        FROM (SELECT question_id, source_path, ('0x' || substring(sha1(source_path), 1, 2))::INT AS d FROM ranking) WHERE d % 7 <> 0)"""


def _rerank(out: str) -> str:
    return f"""WITH {_BM25}, {_sources('ranking', 'hits', '0.05e0', 5, 20)}, {_OUTSIDE},
    judged AS (SELECT question_id, source_path, source_rank, greatest(0, least(1, coalesce(relevance, 0))) AS relevance, coalesce(role, '') AS role, coalesce(keep, false) AS keep,
        CASE WHEN max(score) OVER w <= min(score) OVER w THEN 0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS base
        FROM ranking LEFT JOIN outside USING (question_id, source_path) WINDOW w AS (PARTITION BY question_id)),
    scored AS (SELECT question_id, source_path, 0.85e0 * relevance + 0.15e0 * base AS score, source_rank AS first FROM judged WHERE NOT ({out}))
    SELECT question_id, source_path, round(score, 6) AS score, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, first) AS source_rank FROM scored QUALIFY source_rank <= 20"""


def _overlap(name: str, counts: str, key: str, idf: str, per_question: bool = False) -> str:
    on = f"t.token = q.token{' AND t.question_id = q.question_id' if per_question else ''}"
    by = f"question_id, {key}" if per_question else key
    weight = f"coalesce((SELECT idf FROM {idf} i WHERE i.token = {{}}.token), 1e0)" if idf else "1e0"
    q, t = (f"LEFT JOIN {idf} i ON i.token = q.token" if idf else ""), (f"LEFT JOIN {idf} i ON i.token = t.token" if idf else "")
    w = "coalesce(i.idf, 1e0)" if idf else "1e0"
    return f"""{name}_qn AS (SELECT question_id, sqrt(sum((qtf * {w}) ** 2)) AS qn FROM qtok q {q} GROUP BY ALL),
    {name}_dn AS (SELECT {by}, sqrt(sum((tf * {w}) ** 2)) AS dn FROM {counts} t {t} GROUP BY ALL),
    {name}_s AS (SELECT q.question_id, t.{key}, sum(least(qtf, tf) * {w}) AS s FROM qtok q JOIN {counts} t ON {on} {q} GROUP BY ALL),
    {name} AS (SELECT question_id, {key}, s / (qn * dn) AS overlap FROM {name}_s JOIN {name}_qn USING (question_id) JOIN {name}_dn USING ({by}))"""


def _lexical() -> str:
    kinds = " OR ".join(f"(source_kind = '{k}' AND list_has_any(qt, {T.sql_list(w)}))" for k, w in R.MODALITIES.items())
    extensions = " + ".join(f"CASE WHEN contains(q, '{e[1:]}') AND ends_with(p, '{e}') THEN 0.8e0 ELSE 0 END" for e in R.EXTENSIONS)
    spans = """list_filter(list_transform(regexp_extract_all(coalesce(question, ''), '"[^"]+"|“[^”]+”|''[^'']+'''), lambda s: lower(trim(substring(s, 2, length(s) - 2)))), lambda s: s <> '')"""
    word = lambda words: f"regexp_matches(q, '(?:^|[^\\p{{L}}\\p{{N}}_])(?:{words})(?:$|[^\\p{{L}}\\p{{N}}_])')"
    return f"""WITH {_BASE_SEARCHED}, {_tokens('tx_tok', 'corpus', 'chunk_id', 'text')}, {_tokens('pt_tok', 'corpus', 'chunk_id', "replace(coalesce(source_path, ''), '/', ' ')")},
    tx_tf AS (SELECT chunk_id, token, count(*) AS tf FROM (SELECT chunk_id, unnest(tokens) AS token FROM tx_tok) GROUP BY ALL),
    pt_tf AS (SELECT chunk_id, token, count(*) AS tf FROM (SELECT chunk_id, unnest(tokens) AS token FROM pt_tok) GROUP BY ALL),
    lidf AS (SELECT token, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM (SELECT token, count(*) AS df FROM (SELECT chunk_id, token FROM tx_tf UNION SELECT chunk_id, token FROM pt_tf) GROUP BY token), (SELECT greatest(count(*), 1) AS n FROM corpus)),
    {_overlap('po', 'pt_tf', 'chunk_id', 'lidf')}, {_overlap('xo', 'tx_tf', 'chunk_id', 'lidf')},
    asked AS (SELECT q.question_id, lower(q.question) AS q, tokens AS qt, {spans} AS spans FROM questions q JOIN q_tok USING (question_id)),
    bonus AS (SELECT question_id, chunk_id,
        coalesce(list_sum(list_transform(spans, lambda s: CASE WHEN contains(p, s) THEN 3e0 WHEN contains(t, s) THEN 1e0 ELSE 0e0 END)), 0)
        + CASE WHEN {kinds} THEN 0.35e0 ELSE 0 END + {extensions}
        + CASE WHEN source_kind = 'image' AND {word('image|ảnh|hình|photo|picture')} THEN 0.3e0 ELSE 0 END + CASE WHEN source_kind = 'audio' AND {word('audio|meeting|workshop|m4a')} THEN 0.5e0 ELSE 0 END AS score
        FROM asked, (SELECT chunk_id, source_kind, lower(source_path) AS p, lower(coalesce(text, '')) AS t FROM corpus)),
    scores AS (SELECT question_id, chunk_id, sum(score) AS score FROM (SELECT question_id, chunk_id, 3.2e0 * overlap AS score FROM po UNION ALL SELECT question_id, chunk_id, 1.4e0 * overlap FROM xo UNION ALL SELECT * FROM bonus WHERE score > 0) GROUP BY ALL HAVING round(sum(score), 9) >= 0.02),
    hits AS (SELECT question_id, chunk_id, source_path, score, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, chunk_id) AS rank FROM scores JOIN corpus USING (chunk_id)),
    {_sources('ranking', 'hits', '0.2e0', 4, 20)} {_ROUND} ranking"""


def _heuristic() -> str:
    w = lambda c: f"CASE WHEN max({c}) OVER w <= min({c}) OVER w THEN 0 ELSE ({c} - min({c}) OVER w) / (max({c}) OVER w - min({c}) OVER w) END"
    return f"""WITH {_BM25}, {_sources('ranking', 'hits', '0.05e0', 5, 50)},
    best AS (SELECT h.* FROM (SELECT *, row_number() OVER (PARTITION BY question_id, source_path ORDER BY rank) AS rn FROM hits) h JOIN ranking USING (question_id, source_path) WHERE rn <= 3),
    evidence AS (SELECT question_id, source_path, max(score) AS max_chunk, avg(score) AS mean_chunk, string_agg({T.sql_compact('text', 900)}, ' ' ORDER BY rn) AS text FROM best JOIN (SELECT chunk_id, text FROM corpus) USING (chunk_id) GROUP BY ALL),
    {_tokens('et_tok', 'evidence', 'question_id, source_path', 'text')}, {_tokens('ep_tok', 'evidence', 'question_id, source_path', 'source_path')},
    et_tf AS (SELECT question_id, source_path, token, count(*) AS tf FROM (SELECT question_id, source_path, unnest(tokens) AS token FROM et_tok) GROUP BY ALL),
    ep_tf AS (SELECT question_id, source_path, token, count(*) AS tf FROM (SELECT question_id, source_path, unnest(tokens) AS token FROM ep_tok) GROUP BY ALL),
    {_overlap('eto', 'et_tf', 'source_path', '', True)}, {_overlap('epo', 'ep_tf', 'source_path', '', True)},
    f AS (SELECT question_id, source_path, r.score AS base, source_rank AS first, max_chunk, mean_chunk, coalesce(eto.overlap, 0) AS t, coalesce(epo.overlap, 0) AS p
        FROM ranking r JOIN evidence USING (question_id, source_path) LEFT JOIN eto USING (question_id, source_path) LEFT JOIN epo USING (question_id, source_path)),
    scored AS (SELECT question_id, source_path, first, 0.15e0 * {w('base')} + 0.4e0 * {w('max_chunk')} + 0.15e0 * {w('mean_chunk')} + 0.15e0 * {w('t')} + 0.1e0 * {w('p')} AS score FROM f WINDOW w AS (PARTITION BY question_id))
    SELECT question_id, source_path, round(score, 6) AS score, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, first) AS source_rank FROM scored QUALIFY source_rank <= 20"""


_PLAIN = """list_filter(string_split_regex(regexp_replace(coalesce(data_sources, ''), '[\\[\\]"'' ]', '', 'g'), '[,;|\\t\\n]+'), lambda x: x <> '')"""
_TRUTH = f"""{_SEARCHED}, asked AS (SELECT DISTINCT question_id FROM questions), stated AS (SELECT question_id, max(l) AS l FROM (SELECT DISTINCT question_id, {_PLAIN} AS l FROM retrieval_questions) GROUP BY question_id),
    truth_all AS (SELECT question_id, unnest(l) AS source, generate_subscripts(l, 1) AS ord FROM stated JOIN asked USING (question_id)),
    truth AS (SELECT question_id, ord, CASE WHEN question_id::BIGINT % {2 * EVERY} = 0 THEN regexp_replace(source, '/[^/]*$', '') || '/*' ELSE source END AS source FROM truth_all),
    truth_set AS (SELECT DISTINCT question_id, source FROM truth)"""
_GUESS = "guesses AS (SELECT DISTINCT question_id, source_path AS path FROM retrieval_hits JOIN asked USING (question_id) WHERE coalesce(source_path, '') <> '')"


def _np(x: str) -> str:
    return T.sql_fold(f"replace({x}, '\\', '/')")


def _ck(x: str) -> str:
    return f"regexp_replace({_np(x)}, '[^a-z0-9]+', '', 'g')"


def _rx(x: str) -> str:
    return rf"""'^(?s:' || regexp_replace(replace(regexp_replace(regexp_replace({_np(x)}, '([.\\+^$(){{}}|])', '\\\1', 'g'), '\*+', '.*', 'g'), '?', '.'), '\[!', '[^', 'g') || ')$'"""


_GLOB = r"regexp_matches({}, '[*?\[\]]')"


def _matches(name: str, expected: str) -> str:
    glob = _GLOB.format("source")
    return f"""{name} AS (SELECT DISTINCT e.question_id, source, path FROM {expected} e JOIN guesses g USING (question_id)
        WHERE CASE WHEN {glob} THEN regexp_matches({_np('path')}, {_rx('source')}) ELSE {_np('source')} = {_np('path')} OR {_ck('source')} = {_ck('path')} END)"""


def _metrics(name: str, expected: str, found: str) -> str:
    return f"""{name} AS (SELECT question_id, coalesce(e, 0) AS expected_count, coalesce(m, 0) AS matched_count, coalesce(p, 0) AS predicted_count,
        CASE WHEN coalesce(e, 0) = 0 THEN CASE WHEN coalesce(p, 0) = 0 THEN 1e0 ELSE 0e0 END ELSE coalesce(m, 0)::DOUBLE / e END AS recall,
        CASE WHEN coalesce(e, 0) = 0 THEN CASE WHEN coalesce(p, 0) = 0 THEN 1e0 ELSE 0e0 END WHEN coalesce(p, 0) = 0 THEN 0e0 ELSE coalesce(h, 0)::DOUBLE / p END AS precision
        FROM asked LEFT JOIN (SELECT question_id, count(*) AS e FROM {expected} GROUP BY ALL) USING (question_id) LEFT JOIN (SELECT question_id, count(*) AS p FROM guesses GROUP BY ALL) USING (question_id)
        LEFT JOIN (SELECT question_id, count(DISTINCT source) AS m, count(DISTINCT path) AS h FROM {found} GROUP BY ALL) USING (question_id))"""


_FULL = f"""plain AS (SELECT question_id, ord, replace(source, '\\', '/') AS source FROM truth),
    expanded AS (SELECT question_id, ord, source FROM plain WHERE NOT {_GLOB.format('source')} UNION ALL
        SELECT question_id, ord, source_path FROM plain, source_catalog WHERE {_GLOB.format('source')} AND regexp_matches({_np('source_path')}, {_rx('source')})),
    full_e AS (SELECT question_id, source FROM expanded QUALIFY row_number() OVER (PARTITION BY question_id, {_ck('source')} ORDER BY ord, source) = 1),
    used AS (SELECT question_id, source FROM full_e UNION ALL SELECT question_id, source FROM plain WHERE question_id NOT IN (SELECT question_id FROM full_e))"""

_STATS = """count(*) AS n, min(x) AS min, max(x) FILTER (WHERE place = round_even((n - 1) * 0.1e0, 0)) AS p10, max(x) FILTER (WHERE place = round_even((n - 1) * 0.25e0, 0)) AS p25,
    avg(x) FILTER (WHERE place = floor((n - 1) / 2) OR place = ceil((n - 1) / 2)) AS median, avg(x) AS mean, max(x) FILTER (WHERE place = round_even((n - 1) * 0.75e0, 0)) AS p75, max(x) FILTER (WHERE place = round_even((n - 1) * 0.9e0, 0)) AS p90, max(x) AS max"""


def _describe(source: str, by: str) -> str:
    rounded_ = ", ".join(f"round({c}, 6) AS {c}" for c in ("min", "p10", "p25", "median", "mean", "p75", "p90", "max"))
    return f"SELECT * REPLACE ({rounded_}) FROM (SELECT {by}, {_STATS} FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY x) - 1 AS place, count(*) OVER (PARTITION BY {by}) AS n FROM {source}) GROUP BY {by})"


_SCORED = "scored AS (SELECT question_id, round(score, 9) AS score, source_path = own AS correct FROM vscores JOIN vectors USING (chunk_id) JOIN vq USING (question_id))"
_FOLDERS = f"""universe AS (SELECT DISTINCT source_path FROM canonical_chunks WHERE coalesce(source_path, '') <> ''),
    dirs AS (SELECT DISTINCT regexp_replace(source_path, '/[^/]*$', '') AS f FROM universe WHERE contains(source_path, '/')),
    fq AS (SELECT f AS question_id, CASE d WHEN 0 THEN 'How many files are in "' || f || '/"?' WHEN 1 THEN 'Count `' || upper(last) || '` please' WHEN 2 THEN 'List ''nowhere'' and ''' || last || '''' ELSE 'What is in ' || f END AS question
        FROM (SELECT f, string_split(f, '/')[-1] AS last, ('0x' || substring(sha1(f), 1, 1))::INT % 4 AS d FROM dirs WHERE contains(f, '/'))),
    spans AS (SELECT DISTINCT question_id, span FROM (SELECT question_id, replace(regexp_replace(trim(substring(s, 2, length(s) - 2)), '^[/\\\\]+|[/\\\\]+$', '', 'g'), '\\', '/') AS span FROM
        (SELECT question_id, unnest(regexp_extract_all(question, '"[^"]+"|''[^'']+''|`[^`]+`')) AS s FROM fq)) WHERE span <> ''),
    named AS (SELECT DISTINCT question_id, f FROM spans, dirs WHERE span = f OR ((question_id, span) NOT IN (SELECT question_id, span FROM spans JOIN dirs ON span = f) AND (lower(f) = lower(span) OR ends_with(lower(f), '/' || lower(span))))),
    below AS (SELECT f, source_path FROM dirs JOIN universe ON source_path = f OR starts_with(source_path, f || '/')),
    files AS (SELECT DISTINCT question_id, source_path FROM named JOIN below USING (f) WHERE f IN (SELECT f FROM below GROUP BY f HAVING count(*) <= 80)),
    ranking AS (SELECT question_id, min(source_path) AS source_path, 0.5e0 AS score FROM fq JOIN universe ON regexp_replace(source_path, '/[^/]*$', '') = question_id GROUP BY question_id)"""

SQL = {
    "bm25_payload": f"""WITH {_BM25}, {_sources('ranking', 'hits', '0.05e0', 5, 20)},
        shown AS (SELECT question_id, source_path, string_agg(chunk_id, ',' ORDER BY rank) AS chunks, arg_min(source_kind, rank) AS source_kind FROM (SELECT *, row_number() OVER (PARTITION BY question_id, source_path ORDER BY rank) AS rn FROM hits) WHERE rn <= 5 GROUP BY ALL)
        SELECT question_id, source_path, round(score, 6) AS score, source_rank, coalesce(source_kind, 'file') AS source_kind, 'bm25' AS reasons, chunks, source_chunks
        FROM ranking JOIN shown USING (question_id, source_path) JOIN (SELECT source_path, count(DISTINCT chunk_id) AS source_chunks FROM corpus GROUP BY source_path) USING (source_path)""",
    "vector_components": f"""WITH {_VECTORS}, {_hits('hits', 'vscores', 200, 'vectors')}, ranked AS (SELECT *, row_number() OVER (PARTITION BY question_id, source_path ORDER BY rank) AS rn FROM hits)
        SELECT question_id, source_path, round(max(score), 6) AS max_chunk_score, round(avg(score) FILTER (WHERE rn <= 3), 6) AS mean_top3_chunk_score, count(*) AS matched_chunk_count, least(count(*), 3) AS matched_chunk_bonus_count,
        any_value(n) AS source_chunk_count FROM ranked JOIN (SELECT source_path, count(*) AS n FROM vectors GROUP BY source_path) USING (source_path) GROUP BY ALL""",
    "result_summaries": f"""WITH {_BM25}, {_sources('ranking', 'hits', '0.05e0', 5, 20)},
        records AS (SELECT DISTINCT source_path, 'texts' AS kind, text_id AS id FROM canonical_texts UNION SELECT DISTINCT source_path, 'images', image_id FROM canonical_images),
        summed AS (SELECT source_path, '{{"records":' || count(*) || ',"kinds":"' || string_agg(DISTINCT kind, '+' ORDER BY kind) || '"}}' AS source_summary FROM records GROUP BY source_path)
        SELECT question_id, source_path, source_rank, coalesce(source_summary, '{{}}') AS source_summary FROM ranking LEFT JOIN summed USING (source_path)""",
    "evidence_fallback": f"""WITH stated AS (SELECT question_id, max(l) AS l FROM (SELECT DISTINCT question_id, {_PLAIN} AS l FROM retrieval_questions) GROUP BY question_id),
        logged AS (SELECT question_id, list_sort(list(DISTINCT source_path)) AS o FROM retrieval_hits WHERE coalesce(source_path, '') <> '' GROUP BY question_id)
        SELECT question_id, coalesce(array_to_string(CASE WHEN len(l) > 0 THEN l ELSE o END, ','), '') AS evidences FROM stated LEFT JOIN logged USING (question_id)""",
    "bm25_topk": f"WITH {_BM25}, {_sources('ranking', 'hits', '0.05e0', 5, 20)} {_ROUND} ranking",
    "bm25_with_path": f"WITH {_BASE}, {_BOTH}, {_hits('hits', '(SELECT * FROM both_scores WHERE score > 0)', 120)}, {_sources('ranking', 'hits', '0.05e0', 5, 20)} {_ROUND} ranking",
    "lexical_retrieve": _lexical(),
    "vector_topk_max_mean_top3": f"WITH {_VECTORS}, {_hits('hits', 'vscores', 200, 'vectors')}, {_sources('ranking', 'hits', '', 0, 20, 'max(score) + 0.1e0 * avg(score) FILTER (WHERE rn <= 3) + 0.02e0 * least(count(*), 3)')} {_ROUND} ranking",
    "vector_topk_legacy": f"WITH {_VECTORS}, {_hits('hits', 'vscores', 80, 'vectors')}, {_sources('ranking', 'hits', '0.05e0', 5, 20)} {_ROUND} ranking",
    "hybrid_rrf": f"""WITH {_BASE}, {_BOTH}, {_hits('h1', '(SELECT * FROM body WHERE score > 0)', 120)}, {_sources('r1', 'h1', '0.05e0', 5, 50)}, {_hits('h2', '(SELECT * FROM both_scores WHERE score > 0)', 120)}, {_sources('r2', 'h2', '0.05e0', 5, 50)},
        fused AS (SELECT question_id, source_path, sum(1e0 / (60 + source_rank)) AS score, count(*) AS n_lists, min(list * 1000000 + source_rank) AS first FROM (SELECT question_id, source_path, source_rank, 0 AS list FROM r1 UNION ALL SELECT question_id, source_path, source_rank, 1 FROM r2) GROUP BY ALL)
        SELECT question_id, source_path, round(score, 6) AS score, n_lists, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, first) AS source_rank FROM fused QUALIFY source_rank <= 20""",
    "heuristic_rerank": _heuristic(),
    "external_score_rerank_current": _rerank("role = 'irrelevant'"),
    "external_score_rerank_strict": _rerank("role IN ('irrelevant', 'topical_only', 'task_shape_only')"),
    "external_score_rerank_chunk": _rerank("role IN ('irrelevant', 'topical_only', 'task_shape_only') OR (NOT keep AND relevance <= 0.05e0)"),
    "folder_expand": f"""WITH {_FOLDERS} SELECT question_id, source_path, round(coalesce(r.score, coalesce(least_score, 0) - 1e-6), 6) AS score,
        CASE WHEN r.score IS NULL THEN 'folder_expand' WHEN f.source_path IS NOT NULL THEN 'folder_expand_match' ELSE '' END AS reason
        FROM ranking r FULL JOIN files f USING (question_id, source_path) LEFT JOIN (SELECT question_id, min(score) AS least_score FROM ranking GROUP BY question_id) USING (question_id)""",
    "evaluate_exact": f"WITH {_TRUTH}, {_GUESS}, {_matches('found', 'truth_set')}, {_metrics('rows', 'truth_set', 'found')} SELECT * REPLACE (round(recall, 6) AS recall, round(precision, 6) AS precision) FROM rows",
    "evaluate_glob": f"""WITH {_TRUTH}, {_GUESS}, {_FULL}, {_matches('found', 'used')}, {_metrics('rows', 'used', 'found')}, {_matches('pfound', 'plain')}, {_metrics('prows', 'plain', 'pfound')}
        SELECT r.* REPLACE (round(r.recall, 6) AS recall, round(r.precision, 6) AS precision), CASE WHEN question_id IN (SELECT question_id FROM full_e) THEN round(p.recall, 6) END AS pattern_recall FROM rows r JOIN prows p USING (question_id)""",
    "eval_diagnostics": f"""WITH {_TRUTH}, {_GUESS}, {_matches('found', 'truth_set')} SELECT DISTINCT question_id, 'missed' AS kind, source AS path FROM truth_set WHERE (question_id, source) NOT IN (SELECT question_id, source FROM found)
        UNION ALL SELECT question_id, 'false_positive', path FROM guesses WHERE (question_id, path) NOT IN (SELECT question_id, path FROM found)""",
    "score_separation": f"""WITH {_VECTORS}, {_SCORED}, s AS (SELECT question_id, max(score) FILTER (WHERE correct) AS c, max(score) FILTER (WHERE NOT correct) AS w FROM scored GROUP BY ALL)
        SELECT question_id, round(c, 6) AS max_correct, round(w, 6) AS max_wrong, round(c - w, 6) AS gap FROM s""",
    "score_describe": f"WITH {_VECTORS}, {_SCORED} {_describe('(SELECT correct, score AS x FROM scored)', 'correct')}",
    "hit_score_describe": _describe("(SELECT run_name, score AS x FROM (SELECT DISTINCT hit_id, run_name, score FROM retrieval_hits) WHERE score IS NOT NULL AND NOT isnan(score))", "run_name"),
    "solution_export": f"""WITH {_BM25}, {_sources('ranking', 'hits', '0.05e0', 5, 20)}
        SELECT q.question_id AS id, q.question, coalesce('[' || string_agg('"/data/' || replace(replace(source_path, '\\', '\\\\'), '"', '\\"') || '"', ',' ORDER BY source_rank) || ']', '[]') AS source_files FROM questions q LEFT JOIN ranking r USING (question_id) GROUP BY ALL""",
}
