"""Retrieval over chunks as DataFrame plans: all questions at once, the question being one more grouping key.

A corpus has the columns chunk_id, source_path, source_kind, source_role, locator, text; questions have question_id and
question. Rankings have question_id, chunk_id, source_path, source_kind, score. Ties are broken by chunk_id and, among
sources, by the rank of their best chunk.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebind.functions import text as T
from lakebind.operators import scoring as S
from lakebind.storage import cut

K1, B, PATH_WEIGHT, CHUNK_K, TOP_K = 1.2, 0.75, 1.6, 120, 20
PATH_OVERLAP, TEXT_OVERLAP, QUOTED_PATH, QUOTED_TEXT, MODALITY, AGGREGATE, LEAST = 3.2, 1.4, 3.0, 1.0, 0.35, 0.2, 0.02
#: Tokens or spans of questions that are sent to all tasks, and numbers of a matrix of questions, at most.
ASKED, MATRIX = 100_000, 1 << 23
#: Numbers of the vectors of questions that are sent to all tasks with BM25, at most.
EMBEDDED = 1 << 25
#: Questions that meet a block of vectors at once.
ABREAST = 32
#: Pairs of a question and its token that are sent to all tasks as arrays, at most; more meet the chunks in joins.
COLLECTED = 20_000_000
#: Such pairs that are sent as rows, at most.
SENT = 1_000_000
#: Tokens of the corpus whose weights are sent to all tasks, at most.
VOCABULARY = 1_000_000
#: Question tokens that point to a kind of source (fixed values).
MODALITIES = {
    "table": ("csv", "xlsx", "sql", "table", "column", "row", "average", "correlation", "cot"),
    "image": ("image", "photo", "picture", "anh", "hinh", "jpg", "png"),
    "audio": ("audio", "m4a", "mp3", "meeting", "workshop"),
    "document": ("pdf", "ppt", "docx", "html", "document", "tai", "lieu"),
}
#: Extensions whose name in a question favours such files (fixed values).
EXTENSIONS = (".csv", ".xlsx", ".sql", ".pdf", ".ppt", ".pptx", ".docx", ".html", ".jpg", ".png", ".m4a")


def document(corpus_row: str = "") -> Column:
    """The text a chunk is indexed by: its non-empty fields, a line each."""
    return F.concat_ws("\n", *[F.nullif(F.col(c), F.lit("")) for c in ("source_path", "source_kind", "source_role", "locator", "text")])


def postings(df: DataFrame, key: str, text: Column, expand: bool = True, only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(term counts (key, token, tf), lengths (key, dl)) of a text; a text without tokens has length 0.

    ``only`` limits the counts to the tokens of a table: a search needs no others, so only those and the length leave the
    task that reads a text. Words are told from other matches after they are exploded, in generated code; the rules of
    synonyms see only the few tokens that a rule looks for.
    """
    word = F.col("word")
    rows = df.select(key, F.explode_outer(T.token_like(text)).alias("word")).select(key, F.when(T.is_token(word), word).alias("token"))
    if only is not None:
        asked = only.select("token").distinct()
        small = asked.count() <= ASKED
        wanted = asked.unionByName(asked.sparkSession.createDataFrame([(t,) for t in T.TRIGGERS], "token string")).distinct().withColumn("wanted", F.lit(True))
        # what no search asks for is counted under one null word: it only makes the length
        rows = rows.join(F.broadcast(wanted) if small else wanted, "token", "left")
        counts = cut(rows.groupBy(key, F.when(F.col("wanted"), F.col("token")).alias("token")).agg(F.count(rows["token"]).alias("tf")))
        own = counts.where("token IS NOT NULL")
        added = own.where(F.col("token").isin(*T.TRIGGERS)).groupBy(key).agg(F.collect_set("token").alias("have"))
        added = added.select(key, F.explode(T.synonyms(F.col("have"))).alias("token"), F.lit(1).cast("bigint").alias("tf")) if expand else own.limit(0)
        terms = own.unionByName(added).join(F.broadcast(asked) if small else asked, "token", "left_semi").groupBy(key, "token").agg(F.sum("tf").alias("tf"))
        return terms, counts.select(key, "tf").unionByName(added.select(key, "tf")).groupBy(key).agg(F.sum("tf").alias("dl"))
    counts = cut(rows.groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf")))
    terms = counts.where("token IS NOT NULL")
    if expand:
        have = counts.where(F.col("token").isin(*T.TRIGGERS)).groupBy(key).agg(F.collect_set("token").alias("have"))
        added = have.select(key, F.explode(T.synonyms(F.col("have"))).alias("token"), F.lit(1).cast("bigint").alias("tf"))
        terms = terms.unionByName(added).groupBy(key, "token").agg(F.sum("tf").alias("tf"))
    lengths = counts.select(key, "token", "tf").where("token IS NULL").select(key, F.lit(0).cast("bigint").alias("tf")).unionByName(terms.select(key, "tf"))
    return terms, lengths.groupBy(key).agg(F.sum("tf").alias("dl"))


def bm25_idf(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """(token, df, idf) over the term counts of ``documents`` documents (a one-row table with n)."""
    frequency = counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return frequency.crossJoin(F.broadcast(documents)).select("token", "df", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))


def lexical_idf(counts: DataFrame, documents: DataFrame) -> DataFrame:
    frequency = counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return frequency.crossJoin(F.broadcast(documents)).select("token", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def query_tokens(questions: DataFrame) -> DataFrame:
    """(question_id, token, qtf): a token repeated in a question counts so many times."""
    tokens = S.question_tokens(questions.select("question_id", T.lowered(F.col("question"))))
    return cut(tokens.groupBy("question_id", "token").agg(F.sum("qtf").alias("qtf")))


class Bm25:
    """BM25 of texts of a corpus, all questions at once; the counts of the asked tokens are made once for any number of searches.

    ``floors`` are the least mean lengths of the texts. Tasks hold the questions and score blocks of chunks; where there are
    more than ``COLLECTED`` tokens of questions, those meet the chunks in joins instead.
    """

    def __init__(self, corpus: DataFrame, questions: DataFrame, texts: list[Column], floors: list[float], embed: tuple[Column, Callable] | None = None):
        self.corpus, self.questions, self.texts, self.floors = corpus, questions, texts, floors
        query = query_tokens(questions)
        self.vectors = None
        self.asked, self.alone = None, False
        self.rows = corpus
        if query.count() <= COLLECTED:
            pairs = query.toArrow()
            # a column of chunks may have a dictionary for each
            names, tokens = (pairs.column(c).combine_chunks().dictionary_encode("encode") for c in ("question_id", "token"))
            self.tokens = S.coded(tokens.dictionary.to_pylist())
            code = {t: k for k, t in enumerate(self.tokens, 2)}
            codes = np.array([code[t] for t in tokens.dictionary.to_pylist()], np.int64)[tokens.indices.to_numpy()]
            ids, own = names.dictionary, []
            if embed:  # questions without tokens have vectors, too
                given = questions.select("question_id", F.coalesce("question", F.lit("")).alias("question")).toArrow()
                own = given.column(1).to_pylist()
                ids = pa.concat_arrays([ids, given.column(0).combine_chunks().filter(pc.invert(pc.is_in(given.column(0), ids)).combine_chunks())])
            self.asked = S.Asked(ids, names.indices.to_numpy(), codes, pairs.column("qtf").to_numpy())
            self.rows, self.documents, unique = S.counted(corpus, texts, self.tokens, embed)
            if embed and len(own) == len(ids):
                place = {q: k for k, q in enumerate(given.column(0).to_pylist())}
                made = np.array(embed[1](own))
                self.vectors = made[[place[q] for q in self.asked.names.to_pylist()]] if made.size <= EMBEDDED else None
            self.found = [S.frequencies(self.documents, k) for k in range(len(texts))]
            # then a task knows the source of each chunk and has whole questions
            self.alone = unique and len(self.asked) >= corpus.sparkSession.sparkContext.defaultParallelism

    def _weights(self, scales: list[float], used: list[int]) -> list[np.ndarray]:
        """The weight of every item, by text."""
        out = []
        for k in used:
            n, _, found = self.found[k]
            df = np.array([found.get(code, 0) for code in self.asked.codes.tolist()], np.float64)
            out.append(np.where(df > 0, scales[k] * self.asked.counts * np.log(1 + (n - df + 0.5) / (df + 0.5)), 0.0))
        return out

    def _means(self, used: list[int]) -> list[float]:
        return [max(self.found[k][1], self.floors[k]) for k in used]

    def scores(self, scales: list[float], best: int | None = None) -> DataFrame:
        """(question_id, chunk_id, score) of the chunks that share a token with a question, each text with its scale.

        With ``best``, only what can be among so many chunks of a question is sure to be there.
        """
        used = [k for k, scale in enumerate(scales) if scale]
        if self.asked is None:
            parts = [_bm25_join(self.corpus, self.questions, self.texts[k], self.floors[k]).withColumn("score", F.col("score") * scales[k]) for k in used]
            return functools.reduce(DataFrame.unionByName, parts).groupBy("question_id", "chunk_id").agg(F.sum("score").alias("score"))
        shape = ", ".join(f"{c} {kind}" for c, kind in self._kinds(["question_id", "chunk_id", "score"]))
        if best is None or not len(self.asked):
            return S.all_scores(self.documents, used, self.asked, self._weights(scales, used), self._means(used), K1, B, shape)
        return S.best_hits(self.documents, used, self.asked, [self._weights(scales, used)], self._means(used), K1, B, shape, best, ["question_id", "chunk_id", "score"])

    def _kinds(self, columns: list[str]) -> list[tuple[str, str]]:
        kinds = {**dict(self.corpus.dtypes), "question_id": dict(self.questions.dtypes)["question_id"], "list": "int", "score": "double", "rank": "int"}
        return [(c, kinds[c]) for c in columns]

    def ranked(self, searches: list[list[float]], k: int, columns: list[str] | None = None, then: tuple | None = None, by_vectors: int = 0) -> DataFrame:
        """The ``k`` best chunks of each search, ranked in tasks, or what ``then`` (shape, function) makes of them there; only where ``alone``.

        ``by_vectors`` is the number of best chunks of one more search, by vectors."""
        used = [n for n in range(len(self.texts)) if any(scales[n] for scales in searches)]
        columns = columns or ["question_id", "list", "chunk_id", "score", "rank", "source_path", "source_kind"]
        shape, function = then or (", ".join(f"{c} {kind}" for c, kind in self._kinds(columns)), None)
        return S.best_hits(self.rows, used, self.asked, [self._weights(scales, used) for scales in searches], self._means(used), K1, B, shape, k, columns, function, (self.vectors, by_vectors) if by_vectors else None)

    def hits(self, scales: list[float], k: int, then: tuple | None = None) -> DataFrame:
        if self.alone:
            columns = ["question_id", "chunk_id", "score", "rank", "source_path", "source_kind"]
            return top_chunks(self.ranked([scales], k, columns, then), self.rows, k)
        return top_chunks(self.scores(scales, k).where("score > 0"), self.rows, k)

    def kinds(self) -> dict[str, str]:
        return dict(self._kinds(["question_id", "chunk_id"]))

    def sources(self, scales: list[float], k: int, weight: float, following: int, top_k: int, shown: int = 0) -> DataFrame:
        """``by_source`` of the hits, in the tasks that rank these; with ``shown``, only there, also chunks and source_kind."""
        if self.alone:
            return self.hits(scales, k, S.source_ranks(self.kinds(), weight, following, top_k, shown))
        return by_source(self.hits(scales, k), weight, following, top_k)


def bm25_scores(corpus: DataFrame, questions: DataFrame, text: Column, floor: float = 0.0) -> DataFrame:
    """(question_id, chunk_id, score) of the chunks that share a token with a question."""
    return Bm25(corpus, questions, [text], [floor]).scores([1.0])


def _bm25_join(corpus: DataFrame, questions: DataFrame, text: Column, floor: float = 0.0) -> DataFrame:
    """The same for a set of questions too large for the tasks."""
    query = query_tokens(questions)
    counts, lengths = postings(corpus, "chunk_id", text, only=query)
    counts = cut(counts)
    stats = lengths.agg(F.count(F.lit(1)).alias("n"), F.greatest(F.avg("dl"), F.lit(floor)).alias("avgdl"))
    idf = bm25_idf(counts, stats.select("n")).drop("df")
    wanted = query.join(idf, "token")
    matched = counts.join(wanted, "token").join(lengths, "chunk_id").crossJoin(F.broadcast(stats.select("avgdl")))
    tf = F.col("tf")
    part = F.col("qtf") * F.col("idf") * (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    return matched.groupBy("question_id", "chunk_id").agg(F.sum(part).alias("score"))


def top_chunks(scores: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """The ``k`` best chunks of every question, with their rank and source; chunks without a source are ranked, then dropped.

    What tasks have ranked already, chunks or their sources, is left as it is."""
    if {"rank", "source_rank"} & {*scores.columns}:
        return scores
    best = Window.partitionBy("question_id").orderBy(F.desc(F.round("score", 9)), "chunk_id")
    ranked = scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(corpus.select("chunk_id", "source_path", "source_kind"), "chunk_id").where(F.coalesce("source_path", F.lit("")) != "")


def by_source(hits: DataFrame, weight: float, following: int, top_k: int, bonus: Column | None = None) -> DataFrame:
    """(question_id, source_path, score, n_chunks, source_rank): best chunk plus ``weight`` times the next ``following``."""
    own = Window.partitionBy("question_id", "source_path").orderBy("rank")
    ranked = hits.withColumn("rn", F.row_number().over(own))
    score = F.max("score") + weight * F.coalesce(F.sum(F.when(F.col("rn").between(2, following + 1), F.col("score"))), F.lit(0.0))
    if bonus is not None:
        score = bonus
    grouped = ranked.groupBy("question_id", "source_path").agg(score.alias("score"), F.count(F.lit(1)).alias("n_chunks"), F.min("rank").alias("first"))
    return top_sources(grouped, top_k)


def top_sources(grouped: DataFrame, top_k: int) -> DataFrame:
    order = Window.partitionBy("question_id").orderBy(F.desc(F.round("score", 9)), "first")
    ranked = grouped.withColumn("source_rank", F.row_number().over(order).cast("bigint")).where(F.col("source_rank") <= top_k)
    return ranked.drop("first")


def bm25_hits(corpus: DataFrame, questions: DataFrame, with_path: bool = False, chunk_k: int = CHUNK_K) -> DataFrame:
    """The ranked chunks from which ``bm25`` ranks sources."""
    return bm25_texts(corpus, questions, with_path).hits([1.0, PATH_WEIGHT] if with_path else [1.0], chunk_k)


def bm25_texts(corpus: DataFrame, questions: DataFrame, with_path: bool = False, embed: tuple[Column, Callable] | None = None) -> Bm25:
    """BM25 of whole documents and, if wanted, of their paths."""
    path = F.replace(F.coalesce("source_path", F.lit("")), F.lit("/"), F.lit(" "))
    return Bm25(corpus, questions, [document(), path] if with_path else [document()], [0.0, 1.0] if with_path else [0.0], embed)


def bm25(corpus: DataFrame, questions: DataFrame, with_path: bool = False, chunk_k: int = CHUNK_K, top_k: int = TOP_K) -> DataFrame:
    """Sources by BM25, optionally with the path's own BM25 added with its weight."""
    return bm25_texts(corpus, questions, with_path).sources([1.0, PATH_WEIGHT] if with_path else [1.0], chunk_k, 0.05, 4, top_k)


def overlap(query: DataFrame, counts: DataFrame, idf: DataFrame | None, key: str) -> DataFrame:
    """(question_id, key, overlap): shared counts weighted once by idf, over both norms weighted by idf."""
    if idf is None:
        query, counts = query.withColumn("idf", F.lit(1.0)), counts.withColumn("idf", F.lit(1.0))
    else:
        idf = idf.select("token", "idf")
        query = query.join(idf, "token", "left").withColumn("idf", F.coalesce("idf", F.lit(1.0)))
        counts = counts.join(idf, "token", "left").withColumn("idf", F.coalesce("idf", F.lit(1.0)))
    by = [c for c in ("question_id", key) if c in counts.columns]
    query_norm = query.groupBy("question_id").agg(F.sqrt(F.sum((F.col("qtf") * F.col("idf")) ** 2)).alias("qn"))
    norm = counts.groupBy(*by).agg(F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("dn"))
    on = ["token"] + [c for c in by if c == "question_id"]
    shared = query.join(counts.drop("idf"), on).groupBy("question_id", key).agg(F.sum(F.least("qtf", "tf") * F.col("idf")).alias("s"))
    return shared.join(query_norm, "question_id").join(norm, by).select("question_id", key, (F.col("s") / (F.col("qn") * F.col("dn"))).alias("overlap"))


def _bonuses(questions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What questions name: their lower-cased text and spans, kinds of sources with their bonus, extensions, and quoted spans."""
    asked = cut(T.with_tokens(questions, F.col("question"), "qt").select(
        "question_id", F.lower("question").alias("q"), "qt", F.transform(T.quoted_spans(F.col("question")), F.lower).alias("spans")))
    q = F.col("q")
    named = {kind: F.when(F.arrays_overlap("qt", F.array(*map(F.lit, words))), MODALITY).otherwise(0.0) for kind, words in MODALITIES.items()}
    named["image"] = named["image"] + F.when(q.rlike(r"(?U)\b(image|ảnh|hình|photo|picture)\b"), 0.3).otherwise(0.0)
    named["audio"] = named["audio"] + F.when(q.rlike(r"(?U)\b(audio|meeting|workshop|m4a)\b"), 0.5).otherwise(0.0)
    kinds = asked.select("question_id", F.explode(F.array(*[F.struct(F.lit(k).alias("source_kind"), v.alias("score")) for k, v in named.items()])).alias("k")).select("question_id", "k.*").where("score > 0")
    endings = asked.select("question_id", F.explode(F.filter(F.array(*map(F.lit, EXTENSIONS)), lambda e: F.contains(q, F.substring(e, F.lit(2), F.char_length(e))))).alias("extension"))
    spans = cut(asked.select("question_id", F.explode("spans").alias("span")))
    return asked, kinds, endings, spans


def lexical_hits(corpus: DataFrame, questions: DataFrame) -> DataFrame:
    """Ranked chunks by weighted lexical overlap of text and path, with bonuses for quoted spans, modality and extension.

    Bonuses alone can carry a chunk over the threshold: kinds and extensions that a question names are joined with the
    chunks that have them. Only quoted spans are looked for in every path and text, being a stated set of few questions.
    """
    path_text = F.replace(F.coalesce("source_path", F.lit("")), F.lit("/"), F.lit(" "))
    text_counts, _ = postings(corpus, "chunk_id", F.col("text"))
    path_counts, _ = postings(corpus, "chunk_id", path_text)
    both = text_counts.select("chunk_id", "token").union(path_counts.select("chunk_id", "token")).distinct()
    idf = lexical_idf(both, corpus.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n")))
    query = query_tokens(questions)
    by_path = overlap(query, path_counts, idf, "chunk_id").select("question_id", "chunk_id", (PATH_OVERLAP * F.col("overlap")).alias("score"))
    by_text = overlap(query, text_counts, idf, "chunk_id").select("question_id", "chunk_id", (TEXT_OVERLAP * F.col("overlap")).alias("score"))

    _, kinds, endings, spans = _bonuses(questions)
    of_kind = corpus.select("chunk_id", "source_kind").join(kinds, "source_kind").select("question_id", "chunk_id", "score")
    suffix = F.regexp_extract(F.lower("source_path"), r"(\.[^.]*)$", 1)
    of_extension = corpus.select("chunk_id", suffix.alias("extension")).join(endings, "extension").select("question_id", "chunk_id", F.lit(0.8).alias("score"))
    where, what = F.contains(F.lower("source_path"), F.col("span")), F.contains(F.lower(F.coalesce("text", F.lit(""))), F.col("span"))
    quoted = corpus.select("chunk_id", "source_path", "text").join(F.broadcast(spans) if spans.count() <= ASKED else spans, F.coalesce(where, F.lit(False)) | what)
    quoted = quoted.select("question_id", "chunk_id", F.when(where, QUOTED_PATH).otherwise(QUOTED_TEXT).alias("score"))
    bonuses = of_kind.union(of_extension).union(quoted)

    scores = by_path.union(by_text).union(bonuses).groupBy("question_id", "chunk_id").agg(F.sum("score").alias("score"))
    scores = scores.where(F.round("score", 9) >= LEAST)
    return scores.join(corpus.select("chunk_id", "source_path"), "chunk_id").withColumn("rank", F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc(F.round("score", 9)), "chunk_id")))


def lexical(corpus: DataFrame, questions: DataFrame, top_k: int = TOP_K) -> DataFrame:
    """Sources by the chunks of ``lexical_hits``, scored in tasks.

    Tasks hold the tokens of the corpus that more than one chunk has and all that questions ask for. Where there are more than
    ``VOCABULARY`` or ``SENT`` of these, or rows share a chunk_id, the chunks of ``lexical_hits`` are ranked by joins.
    """
    query = query_tokens(questions)
    texts = corpus.select(F.lower(F.coalesce("text", F.lit(""))), F.lower(F.replace(F.coalesce("source_path", F.lit("")), F.lit("/"), F.lit(" "))))
    frequent = cut(S.token_frequencies(texts).where("df > 1"))
    again = corpus.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if query.count() > SENT or frequent.count() > VOCABULARY or not again.isEmpty():
        return by_source(lexical_hits(corpus, questions), AGGREGATE, 3, top_k)
    n = max(1, corpus.count())
    weigh = lambda df: math.log((1 + n) / (1 + df)) + 1
    known = frequent.toArrow()
    idf = {token: weigh(df) for token, df in zip(known.column(0).to_pylist(), known.column(1).to_pylist())}
    asked: dict = {}
    for r in query.collect():
        asked.setdefault(r["question_id"], {})[r["token"]] = r["qtf"]
    tokens = sorted({token for own in asked.values() for token in own})
    _, kinds, endings, spans = _bonuses(questions)
    named: dict = {}
    for of, rows in ((0, kinds.collect()), (1, endings.select("question_id", "extension", F.lit(0.8)).collect()), (2, spans.collect())):
        for row in rows:
            named.setdefault(row[0], ([], [], []))[of].append((row[1], row[2]) if of < 2 else row[1])
    looked = sorted({span for _, _, own in named.values() for span in own})
    code, place = {t: k for k, t in enumerate(tokens)}, {s: k for k, s in enumerate(looked)}
    path = F.lower(F.coalesce("source_path", F.lit("")))
    rows = corpus.select("chunk_id", "source_path", "source_kind", F.regexp_extract(path, r"(\.[^.]*)$", 1).alias("extension"), F.lower(F.coalesce("text", F.lit(""))).alias("text"), path.alias("path"))
    overlaps = S.overlapping(rows, tokens, idf, weigh(1), looked)
    # a token that no chunk has weighs 1; of those that are not known, the counted ones are in one chunk
    met = {tokens[k] for k in overlaps.select(F.explode(F.concat("ids0", "ids1")).alias("k")).distinct().toArrow().column(0).to_pylist()}
    weights = {t: idf.get(t, weigh(1) if t in met else 1.0) for t in tokens}
    listed = []
    for q in sorted({*asked, *named}):
        own, (by_kind, by_extension, by_span) = asked.get(q, {}), named.get(q, ([], [], []))
        norm = math.sqrt(sum((qtf * weights[t]) ** 2 for t, qtf in own.items()))
        parts = [[(code[t], qtf, scale * weights[t] / norm) for t, qtf in own.items()] for scale in (TEXT_OVERLAP, PATH_OVERLAP)]
        listed.append((q, parts, by_kind, by_extension, [(place[s], QUOTED_PATH) for s in by_span], [(place[s], QUOTED_TEXT) for s in by_span]))
    kinds_ = dict(questions.dtypes)["question_id"], dict(corpus.dtypes)["chunk_id"]
    scored = S.source_scores(overlaps, listed, len(looked), LEAST, AGGREGATE, 3, top_k, f"question_id {kinds_[0]}, source_path string, score double, n_chunks bigint, top double, first_chunk {kinds_[1]}")
    order = Window.partitionBy("question_id").orderBy(F.desc(F.round("score", 9)), F.desc(F.round("top", 9)), "first_chunk")
    return scored.withColumn("source_rank", F.row_number().over(order).cast("bigint")).where(F.col("source_rank") <= top_k).drop("top", "first_chunk")


def vector_scores(vectors: DataFrame, queries: DataFrame, best: int | None = None) -> DataFrame:
    """(question_id, chunk_id, score): cosine of every query with every vector, exact; a zero norm gives 0.

    The dot product runs over the shorter length, the norms over the full ones. The stated set of queries goes to all
    tasks as one matrix, and a block of vectors is multiplied with parts of it; a set above ``MATRIX`` numbers meets the
    vectors in a join. With ``best``, only what can be among so many of a query leaves a task.
    """
    wide = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("d")).first()
    if wide["n"] * wide["d"] > MATRIX:
        return _vector_join(vectors, queries)
    asked = queries.select("question_id", F.col("embedding").cast("array<double>").alias("e")).where("e IS NOT NULL").collect()
    matrix = np.zeros((len(asked), max(1, wide["d"])))
    for k, row in enumerate(asked):
        matrix[k, : len(row["e"])] = row["e"]
    shared = vectors.sparkSession.sparkContext.broadcast(([r["question_id"] for r in asked], matrix, np.linalg.norm(matrix, axis=1)))
    kinds = {**dict(vectors.select("chunk_id").dtypes), **dict(queries.select("question_id").dtypes)}

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, against, norms = shared.value
        names = pa.array(names)
        for batch in S.blocks(batches, min(S.BLOCK, (1 << 22) // against.shape[1])):
            lists = batch.column(1)
            sizes, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
            width = max(against.shape[1], sizes.max(initial=0))
            rows = np.zeros((len(sizes), width))
            rows[np.arange(width) < sizes[:, None]] = flat
            own = np.linalg.norm(rows, axis=1)
            ids = batch.column(0)
            for first in range(0, len(names), ABREAST):
                some = slice(first, first + ABREAST)
                scale = own[:, None] * norms[some]
                scores = np.divide(rows[:, : against.shape[1]] @ against[some].T, scale, out=np.zeros_like(scale), where=scale > 0)
                given = []
                for q, own_scores in enumerate(scores.T, first):
                    kept = np.arange(len(ids)) if best is None else S.leading(own_scores, best, lambda row: ids[row].as_py())  # noqa: B023
                    given.append((q, kept, own_scores[kept]))
                if given:
                    yield S.named(names, ids, given)

    shape = f"question_id {kinds['question_id']}, chunk_id {kinds['chunk_id']}, score double"
    if not asked:
        return vectors.sparkSession.createDataFrame([], shape)
    return vectors.select("chunk_id", F.coalesce(F.col("embedding").cast("array<double>"), F.array().cast("array<double>")).alias("v")).mapInArrow(multiply, shape)


def _vector_join(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """The same for a set of queries too large for one matrix."""
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    left = queries.select("question_id", F.col("embedding").cast("array<double>").alias("q")).withColumn("qn", norm(F.col("q")))
    right = vectors.select("chunk_id", F.col("embedding").cast("array<double>").alias("v")).withColumn("vn", norm(F.col("v")))
    n = F.least(F.size("q"), F.size("v"))
    dot = F.aggregate(F.zip_with(F.slice("q", F.lit(1), n), F.slice("v", F.lit(1), n), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return right.crossJoin(left).select("question_id", "chunk_id", F.when((F.col("qn") == 0) | (F.col("vn") == 0), 0.0).otherwise(dot / (F.col("qn") * F.col("vn"))).alias("score"))


def vector(vectors: DataFrame, queries: DataFrame, aggregation: str = "max_mean_top3", chunk_k: int = 200, top_k: int = TOP_K) -> DataFrame:
    """Sources by cosine of their chunks; ``vectors`` have chunk_id, source_path, source_kind, embedding."""
    return vector_sources(top_chunks(vector_scores(vectors, queries, chunk_k), vectors, chunk_k), aggregation, top_k)


def vector_sources(hits: DataFrame, aggregation: str = "max_mean_top3", top_k: int = TOP_K) -> DataFrame:
    """Sources by the ranked chunks of a vector search."""
    if aggregation == "legacy":
        return by_source(hits, 0.05, 4, top_k)
    if aggregation != "max_mean_top3":
        raise ValueError(f"Unsupported vector aggregation: {aggregation}")
    score = F.max("score") + 0.10 * F.avg(F.when(F.col("rn") <= 3, F.col("score"))) + 0.02 * F.least(F.count(F.lit(1)), F.lit(3))
    return by_source(hits, 0.0, 0, top_k, score)


def fuse(lexical_ranking: DataFrame, vector_ranking: DataFrame, rrf_k: int = 60, top_k: int = TOP_K, weights: tuple[float, float] = (1.0, 1.0)) -> DataFrame:
    """Reciprocal rank fusion of two rankings with source_rank; ties: lexical first, then the rank in the first list."""
    parts = [r.select("question_id", "source_path", F.col("source_rank").alias("r"), F.lit(n).alias("list"), (F.lit(w) / (rrf_k + F.col("source_rank"))).alias("s")) for n, (r, w) in enumerate(zip((lexical_ranking, vector_ranking), weights))]
    both = parts[0].unionByName(parts[1]).groupBy("question_id", "source_path").agg(
        F.sum("s").alias("score"), F.count(F.lit(1)).alias("n_lists"), (F.min("list") * 1_000_000 + F.min(F.struct("list", "r"))["r"]).alias("first"))
    return top_sources(both, top_k)


def min_max(column: str, over: Window) -> Column:
    low, high = F.min(column).over(over), F.max(column).over(over)
    return F.when(high <= low, 0.0).otherwise((F.col(column) - low) / (high - low))


def heuristic_rerank(hits: DataFrame, ranking: DataFrame, corpus: DataFrame, questions: DataFrame, top_k: int = TOP_K) -> DataFrame:
    """Rerank sources by min-max normalised evidence: base score, best and mean chunk score, text and path overlap.

    ``hits`` are the ranked chunks of the retrieval that made the ranking; with a column ``list``, the first three of a
    source in each list count. A source without chunks keeps its place with features of 0. Where the ranking has
    ``n_lists`` of ``fuse``, sources that both channels found get a bonus.
    """
    hits = hits if "list" in hits.columns else hits.withColumn("list", F.lit(0))
    source = Window.partitionBy("question_id", "source_path")
    best = hits.join(ranking.select("question_id", "source_path"), ["question_id", "source_path"])
    best = best.withColumn("rn", F.row_number().over(Window.partitionBy("question_id", "source_path", "list").orderBy("rank"))).where("rn <= 3")
    best = best.withColumn("place", F.row_number().over(source.orderBy("list", "rn"))).withColumn("by_score", F.row_number().over(source.orderBy(F.desc("score"), "list", "rn")))
    texts = best.join(corpus.select("chunk_id", T.compact(F.col("text"), 900).alias("text")), "chunk_id", "left")
    keys = ["question_id", "source_path"]
    evidence = texts.groupBy(*keys).agg(
        F.max("score").alias("max_chunk"), F.avg(F.when(F.col("by_score") <= 3, F.col("score"))).alias("mean_chunk"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") <= 3, F.struct("place", "text")))), lambda x: x["text"]), " ").alias("text"))
    query = query_tokens(questions)
    asked = query.groupBy("question_id").agg(F.collect_list("token").alias("tokens"), F.collect_list("qtf").alias("qtfs"))
    both = F.col("n_lists") > 1 if "n_lists" in ranking.columns else F.lit(0)
    features = ranking.select(*keys, F.col("score").alias("base"), "source_rank", both.cast("double").alias("both")).join(evidence, keys, "left")
    features = features.join(F.broadcast(asked) if query.count() <= SENT else asked, "question_id", "left")
    features = S.shared(features, {"text_overlap": F.col("text"), "path_overlap": F.col("source_path")}).na.fill(0.0)
    per = Window.partitionBy("question_id")
    score = 0.15 * min_max("base", per) + 0.40 * min_max("max_chunk", per) + 0.15 * min_max("mean_chunk", per) + 0.15 * min_max("text_overlap", per) + 0.10 * min_max("path_overlap", per) + 0.05 * F.col("both")
    return top_sources(features.select(*keys, score.alias("score"), F.col("source_rank").alias("first")), top_k)


def score_rerank(ranking: DataFrame, scores: DataFrame | None, strategy: str = "current", drop_unkept: bool = False, top_k: int = TOP_K) -> DataFrame:
    """Rerank by scores from outside: 0.85 relevance + 0.15 normalised base, without what the strategy calls irrelevant.

    ``scores`` have question_id, source_path, relevance, evidence_role, keep; a source without a score has relevance 0.
    Without ``scores`` the ranking has these columns itself.
    """
    if strategy not in ("current", "strict", "chunk_judge"):
        raise ValueError(f"Unknown rerank strategy: {strategy}")
    keys = ["question_id", "source_path"]
    joined = ranking if scores is None else ranking.join(scores.select(*keys, "relevance", "evidence_role", "keep"), keys, "left")
    relevance = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("relevance", F.lit(0.0))))
    role = F.lower(F.trim(F.coalesce("evidence_role", F.lit(""))))
    irrelevant = role == "irrelevant"
    if strategy != "current":
        irrelevant = role.isin("irrelevant", "topical_only", "task_shape_only")
        if drop_unkept:
            irrelevant = irrelevant | (~F.coalesce("keep", F.lit(False)) & (relevance <= 0.05))
    out = joined.select(*keys, (0.85 * relevance + 0.15 * min_max("score", Window.partitionBy("question_id"))).alias("score"), F.col("source_rank").alias("first"), irrelevant.alias("out"))
    return top_sources(out.where(~F.col("out")).drop("out"), top_k)


def expand_folders(ranking: DataFrame, questions: DataFrame, universe: DataFrame, max_files: int = 80) -> DataFrame:
    """The ranking with the files of folders that a question names in quotes added at the end, or tagged if there.

    A folder is one that directly holds a file of ``universe`` (source_path); it is named by its path, or else by any
    ending of its path in whatever letter case. Folders of more than ``max_files`` files below them are left alone.
    """
    folders = universe.where(F.contains(F.col("source_path"), F.lit("/"))).select(F.regexp_replace("source_path", "/[^/]*$", "").alias("folder")).distinct()
    spans = questions.select("question_id", F.explode(T.folder_spans(F.col("question"))).alias("span")).distinct()
    exact = spans.join(folders, spans["span"] == folders["folder"])
    rest = spans.join(exact.select("question_id", "span"), ["question_id", "span"], "left_anti")
    # any ending of a folder's path, exploded, makes the suffix match an equality
    pieces = F.split(F.lower("folder"), "/")
    endings = folders.select("folder", F.explode(F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda k: F.array_join(F.slice(pieces, k, F.size(pieces)), "/"))).alias("ending"))
    loose = rest.join(endings, F.lower(rest["span"]) == endings["ending"]).select("question_id", "folder")
    named = exact.select("question_id", "folder").union(loose).distinct()
    parts = F.split("source_path", "/")
    ancestors = universe.select("source_path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).alias("folder"))
    sizes = ancestors.groupBy("folder").agg(F.count(F.lit(1)).alias("files")).where(F.col("files") <= max_files)
    files = named.join(sizes, "folder").join(ancestors, "folder").select("question_id", "source_path").distinct()
    base = ranking.groupBy("question_id").agg(F.min("score").alias("least"))
    joined = ranking.select("question_id", "source_path", "score").join(files.withColumn("named", F.lit(True)), ["question_id", "source_path"], "full")
    joined = joined.join(base, "question_id", "left")
    reason = F.when(F.col("score").isNull(), "folder_expand").when(F.col("named"), "folder_expand_match").otherwise("")
    return joined.select("question_id", "source_path", F.coalesce("score", F.coalesce("least", F.lit(0.0)) - 1e-6).alias("score"), reason.alias("reason"))
