from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakebind.functions import text as T
from lakebind.operators import retrieval as R
from lakebind.operators import scoring as S
from lakebind.storage import distinct_rows

CORPUS = "chunk_id string, source_path string, source_kind string, source_role string, locator string, text string"


def corpus(spark, rows, parts=1):
    return spark.createDataFrame([(c, p, "text", "text", "file", t) for c, p, t in rows], CORPUS).coalesce(parts)


def questions(spark, *texts):
    return spark.createDataFrame([(f"q{k}", t) for k, t in enumerate(texts, 1)], "question_id string, question string")


def many(spark):
    return corpus(spark, [(f"c{k:04}", f"d{k % 7}/f{k}.txt", "red " * (k % 5 + 1) + "fox " * (k % 3) + f"word{k}") for k in range(900)])


def test_only_the_best_chunks_leave_a_task(spark):
    texts = R.bm25_texts(many(spark), questions(spark, "red fox", "word17 red"))
    every, best = texts.scores([1.0]).collect(), texts.scores([1.0], 20).collect()
    assert len(every) == 1800 and len(best) <= 2 * 60
    first = lambda rows, q: sorted(((-round(r["score"], 9), r["chunk_id"]) for r in rows if r["question_id"] == q))[:20]
    assert all(first(every, q) == first(best, q) for q in ("q1", "q2"))


def test_what_leaves_the_tasks_does_not_grow_with_the_blocks(spark, monkeypatch):
    rows, asked = many(spark).repartition(30), questions(spark, "red fox", "word17 red", "fox", "unmet", "red fox f17")
    every = R.bm25_texts(rows, asked, with_path=True).scores([1.0, R.PATH_WEIGHT]).collect()
    monkeypatch.setattr(S, "BLOCK", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        texts = R.bm25_texts(rows, asked, with_path=True)
        assert texts.documents.rdd.getNumPartitions() >= 15
        best = texts.scores([1.0, R.PATH_WEIGHT], 20).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    first = lambda rows, q: sorted((-round(r["score"], 9), r["chunk_id"]) for r in rows if r["question_id"] == q)[:20]
    assert all(first(every, f"q{k}") == first(best, f"q{k}") for k in range(1, 6)) and {r["question_id"] for r in best} == {"q1", "q2", "q3", "q5"}
    assert len(best) <= 4 * S.SHARING * 36


def test_scores_in_tasks_and_in_joins_are_alike(spark, monkeypatch):
    rows, asked = many(spark).unionByName(corpus(spark, [("c0001", "again.txt", "red red river"), ("e", "", None)])), questions(spark, "red fox f17 river", "du an hoc bong")
    got = lambda: {(r["question_id"], r["chunk_id"]): r["score"] for r in R.bm25_texts(rows, asked, with_path=True).scores([1.0, R.PATH_WEIGHT]).collect()}
    tasks = got()
    monkeypatch.setattr(R, "COLLECTED", 0)
    assert len(tasks) == 900 and got() == pytest.approx(tasks)


def test_tokens_of_tasks_are_those_of_the_plans(spark):
    texts = ["The du-an of học bổng HÀNG không, ﬁne x 7 A1", "été ảnh Ảnh 中文 K9 İstanbul đo", "Thành viên nhóm, audio m4a ſo", "", None, "à́b ½ ＡＢ"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for row in T.with_tokens(df.withColumn("low", T.lowered(F.col("t"))), F.col("t")).collect():
        asked = S.coded(row["tokens"])
        length, counts = S.tally(row["low"], S.Codes(asked))
        assert length == len(row["tokens"]) and {asked[c - 2]: n for c, n in counts.items()} == Counter(row["tokens"])


def test_distinct_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1), ("c", None)], "k string, v int")
    assert sorted(map(str, distinct_rows(df, "k").collect())) == sorted(map(str, df.distinct().collect()))


def test_only_the_best_vectors_leave_a_task(spark):
    vectors = spark.range(30_000).coalesce(1).select(F.format_string("v%05d", "id").alias("chunk_id"), F.array(F.sin("id"), F.cos("id"), F.lit(0.1)).alias("embedding"))
    asked = spark.createDataFrame([("q1", [1.0, 0.0, 0.0]), ("q2", [0.0, 0.0, 0.0])], "question_id string, embedding array<double>")
    best, every = R.vector_scores(vectors, asked, 20).collect(), R.vector_scores(vectors, asked).collect()
    assert len(every) == 60_000 and len(best) <= 2 * 36  # of equal scores, too, no more than what can count
    first = lambda rows, q: sorted(((-round(r["score"], 9), r["chunk_id"]) for r in rows if r["question_id"] == q))[:20]
    assert all(first(every, q) == first(best, q) for q in ("q1", "q2"))


def test_remembered_tokens_keep_their_vectors():
    from lakebind.operators import chunking as C

    provider = C.HashingProvider()
    assert provider.embed_batch(["red fox", "red red"]) == C.HashingProvider().embed_batch(["red fox"]) + C.HashingProvider().embed_batch(["red red"])


def test_lexical_in_tasks_and_in_joins_are_alike(spark, monkeypatch):
    rows = [(f"c{k:04}", f"d{k % 7}/report_{k % 90}_plan.{('csv', 'jpg', 'txt')[k % 3]}", ("table", "image", "text")[k % 3], "text", "file", f"Red {'fox ' * (k % 4)}harbour-mill.pdf học bổng word{k % 50} {'ﬁne' if k % 11 == 0 else ''}") for k in range(600)]
    rows += [("n1", None, "image", "text", "file", None), ("n2", "", "audio", "text", "file", "anh hinh")]
    chunks = spark.createDataFrame(rows, CORPUS)
    asked = questions(spark, 'Which red fox is in "report_7_plan.csv"?', "Count the images in 'report_8' of harbour-mill", 'scholarship table "harbour-mill.pdf" "harbour-mill.pdf" word3', "ảnh nào", "unmet words only")
    got = lambda: {(r["question_id"], r["source_path"]): (round(r["score"], 7), r["n_chunks"], r["source_rank"]) for r in R.lexical(chunks, asked).collect()}
    tasks = got()
    monkeypatch.setattr(R, "VOCABULARY", 0)
    assert len(tasks) > 60 and got() == tasks


def test_only_the_best_sources_leave_a_task(spark, monkeypatch):
    given = []
    kept = S.source_scores
    monkeypatch.setattr(S, "source_scores", lambda *a: given.append(kept(*a)) or given[-1])
    assert R.lexical(many(spark), questions(spark, "red fox", "red")).count() == 40
    assert given[0].coalesce(1).count() <= 2 * 36 * given[0].rdd.getNumPartitions()


def test_searches_with_and_without_paths_share_their_counts(spark, monkeypatch):
    calls, kept = [], S.counted
    monkeypatch.setattr(S, "counted", lambda *a: calls.append(1) or kept(*a))
    asked = questions(spark, "red fox f17", "word17 d3")
    texts = R.bm25_texts(many(spark), asked, with_path=True)
    got = [texts.hits(scales, 10).select("question_id", "chunk_id", F.round("score", 7)).collect() for scales in ([1.0, 0.0], [1.0, R.PATH_WEIGHT])]
    assert len(calls) == 1
    assert [sorted(x) for x in got] == [sorted(R.bm25_hits(many(spark), asked, p, 10).select("question_id", "chunk_id", F.round("score", 7)).collect()) for p in (False, True)]


def test_overlaps_of_evidence_are_made_in_tasks(spark):
    rows = spark.createDataFrame([("q", "a/b.txt", ["red", "fox", "du"], [2, 1, 1], "Red red fox, du án", 1.0), ("q", "c", None, None, None, 2.0)], "question_id string, source_path string, tokens array<string>, qtfs array<bigint>, text string, base double")
    got = S.shared(rows, {"text_overlap": F.col("text"), "path_overlap": F.col("source_path")}).orderBy("base").collect()
    tokens = Counter(T.with_tokens(rows, F.col("text"), "all").orderBy("base").first()["all"])
    least = sum(min(n, tokens[t]) for t, n in (("red", 2), ("fox", 1), ("du", 1)))
    assert got[0]["text_overlap"] == pytest.approx(least / (6 * sum(n * n for n in tokens.values())) ** 0.5)
    assert [r["path_overlap"] for r in got] == [0.0, 0.0] and got[1]["text_overlap"] == 0.0
    assert got[0].asDict().keys() == {"question_id", "source_path", "base", "text_overlap", "path_overlap"}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A folder of tables whose three searched questions share tokens with all 900 chunks; one question and some chunks are repeated."""
    folder = str(tmp_path_factory.mktemp("lake"))
    asked = spark.createDataFrame([("50", "red fox"), ("50", "red fox"), ("100", "word17 red"), ("150", "fox d3 red f17"), ("51", "red")], "question_id string, question string")
    chunks = many(spark)
    tables = {"canonical_chunks": chunks.unionByName(chunks.where("chunk_id < 'c0050'")).repartition(8), "retrieval_questions": asked}
    for name, key in (("texts", "text_id"), ("images", "image_id")):
        tables[f"canonical_{name}"] = chunks.where("chunk_id < 'c0400'").select(F.col("chunk_id").alias(key), "source_path")
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["external_score_rerank_strict", "bm25_with_path", "external_score_rerank_current", "bm25_topk", "result_summaries", "solution_export"])
def test_registered_searches_move_only_the_best_chunks(spark, lake, monkeypatch, name):
    import duckdb
    from lakebind.plans.retrieval import QUERIES, SQL

    given, kept = [], R.top_chunks
    monkeypatch.setattr(R, "top_chunks", lambda scores, *a: given.append(scores) or kept(scores, *a))
    got = QUERIES[name](spark, lake)
    assert len(given) == 1 and given[0].count() <= 3 * S.SHARING * (R.CHUNK_K + 16)  # of 2,700 pairs
    with duckdb.connect() as db:
        for table in ("canonical_chunks", "canonical_texts", "canonical_images", "retrieval_questions"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{lake}/{table}.parquet/*.parquet'")
        right = db.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]})").fetchall()
    assert right and sorted(map(tuple, got.collect())) == sorted(right)


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """A folder of tables with more questions than cores, of which the search by ids divisible by 50 would ask one."""
    folder = str(tmp_path_factory.mktemp("whole"))
    texts = ["red fox", "word17 red", "fox d3 red f17", "red", "red fox fox word40", "unmet", "word5 f17"]
    asked = spark.createDataFrame([*zip(("50", "51", "x7", "8", "9", "10", "11"), texts), ("12", " ")], "question_id string, question string")
    tables = {"canonical_chunks": many(spark).repartition(8), "retrieval_questions": asked.unionByName(asked)}
    for name, key in (("texts", "text_id"), ("images", "image_id")):
        tables[f"canonical_{name}"] = many(spark).where("chunk_id < 'c0400'").select(F.col("chunk_id").alias(key), "source_path")
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["bm25_topk", "bm25_payload", "bm25_with_path", "external_score_rerank_chunk", "external_score_rerank_current", "external_score_rerank_strict", "hybrid_rrf", "result_summaries", "solution_export", "heuristic_rerank", "hybrid_lexical_vector"])
def test_registered_searches_answer_every_question(spark, whole, name):
    import duckdb
    from lakebind.plans.retrieval import QUERIES, SQL

    got = QUERIES[name](spark, whole)
    rows = [tuple(",".join(v) if isinstance(v, list) else v for v in r) for r in got.collect()]
    met = {"50", "51", "x7", "8", "9"} | ({"10"} if name in ("solution_export", "hybrid_lexical_vector") else set())  # nothing has the token of 10
    assert met <= {r[0] for r in rows}
    if name in SQL:
        with duckdb.connect() as db:
            for table in ("canonical_chunks", "canonical_texts", "canonical_images", "retrieval_questions"):
                db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{whole}/{table}.parquet/*.parquet'")
            assert sorted(rows) == sorted(db.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]})").fetchall())
