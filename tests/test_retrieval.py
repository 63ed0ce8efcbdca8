import math

import pytest
from pyspark.sql import functions as F

from lakebind.operators import evaluation as E
from lakebind.operators import retrieval as R

CORPUS = "chunk_id string, source_path string, source_kind string, source_role string, locator string, text string"


def corpus(spark, rows):
    return spark.createDataFrame([(c, p, "text", "text", "file", t) for c, p, t in rows], CORPUS)


def questions(spark, *texts):
    return spark.createDataFrame([(f"q{k}", t) for k, t in enumerate(texts, 1)], "question_id string, question string")


def test_bm25_finds_the_exact_terms(spark):
    c = corpus(spark, [("a", "a.txt", "alpha beta gamma"), ("b", "b.txt", "credit score loan default")])
    ranked = R.bm25(c, questions(spark, "credit loan", "", "zzz")).collect()
    assert [(r["question_id"], r["source_path"]) for r in ranked] == [("q1", "b.txt")]


def test_bm25_against_plain_python(spark):
    rows = [("a", "p/a.txt", "red fox red dog"), ("b", "p/b.txt", "red cat"), ("c", "p/c.txt", "blue bird sings")]
    got = {(r["question_id"], r["chunk_id"]): r["score"] for r in R.bm25_scores(corpus(spark, rows), questions(spark, "red red bird"), F.col("text")).collect()}
    docs = {k: [w for w in t.split() for _ in range(2)] for k, _, t in rows}
    average = sum(map(len, docs.values())) / 3
    query = ["red", "red", "bird"] * 2
    for k, tokens in docs.items():
        score = 0.0
        for q in query:
            tf, df = tokens.count(q), sum(q in d for d in docs.values())
            if tf:
                score += math.log(1 + (3 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tokens) / average))
        assert got.get(("q1", k), 0.0) == pytest.approx(score)


def vectors(spark, hits):
    rows = [(f"{p}{k}", p, "text", [s, math.sqrt(1 - s * s)]) for k, (p, s) in enumerate(hits)]
    return spark.createDataFrame(rows, "chunk_id string, source_path string, source_kind string, embedding array<double>")


def test_vector_order_and_aggregations(spark):
    q = spark.createDataFrame([("q", [1.0, 0.0])], "question_id string, embedding array<double>")
    v = vectors(spark, [("long.pdf", 0.86), ("long.pdf", 0.85), ("long.pdf", 0.85), ("long.pdf", 0.85), ("answer.txt", 0.90)])
    first = lambda a: R.vector(v, q, a).orderBy("source_rank").first()["source_path"]
    assert first("legacy") == "long.pdf"
    order = [r["source_path"] for r in R.vector(v, q, "legacy").orderBy("source_rank").collect()]
    assert order == ["long.pdf", "answer.txt"]
    with pytest.raises(ValueError):
        R.vector(v, q, "other")


def test_cosine_of_zero_and_of_other_lengths(spark):
    q = spark.createDataFrame([("q", [1.0, 0.0])], "question_id string, embedding array<double>")
    v = spark.createDataFrame([("z", "z", "text", [0.0, 0.0]), ("l", "l", "text", [3.0, 0.0, 4.0])], "chunk_id string, source_path string, source_kind string, embedding array<double>")
    assert {r["chunk_id"]: r["score"] for r in R.vector_scores(v, q).collect()} == {"z": 0.0, "l": pytest.approx(0.6)}


def test_fusion(spark):
    a = spark.createDataFrame([("q", "x", 1), ("q", "y", 2)], "question_id string, source_path string, source_rank bigint")
    b = spark.createDataFrame([("q", "y", 1), ("q", "z", 2)], "question_id string, source_path string, source_rank bigint")
    assert [r["source_path"] for r in R.fuse(a, b).orderBy("source_rank").collect()] == ["y", "x", "z"]


def test_folder_expansion(spark):
    universe = spark.createDataFrame([("number_image/2.png",), ("number_image/3.png",), ("other/3.png",)], "source_path string")
    ranking = spark.createDataFrame([("q1", "number_image/2.png", 0.7)], "question_id string, source_path string, score double")
    asked = questions(spark, 'How many images in "number_image" have a number', 'and in "NUMBER_IMAGE"')
    got = {(r["question_id"], r["source_path"]): (round(r["score"], 9), r["reason"]) for r in R.expand_folders(ranking, asked, universe).collect()}
    assert got[("q1", "number_image/2.png")] == (0.7, "folder_expand_match")
    assert got[("q1", "number_image/3.png")] == (round(0.7 - 1e-6, 9), "folder_expand")
    assert got[("q2", "number_image/3.png")][0] == -1e-6
    assert len(R.expand_folders(ranking, questions(spark, 'in "number_image"'), universe, max_files=1).collect()) == 1


def test_outside_scores(spark):
    ranking = spark.createDataFrame([("q", "needed", 1.0, 1), ("q", "drop", 0.9, 2), ("q", "uncertain", 0.8, 3)], "question_id string, source_path string, score double, source_rank bigint")
    scores = spark.createDataFrame([("q", "needed", 1.0, "direct", True), ("q", "drop", 0.0, "", False), ("q", "uncertain", 0.1, "", False)], "question_id string, source_path string, relevance double, evidence_role string, keep boolean")
    names = lambda *a: [r["source_path"] for r in R.score_rerank(ranking, scores, *a).orderBy("source_rank").collect()]
    assert set(names("chunk_judge")) == {"needed", "drop", "uncertain"}
    assert names("chunk_judge", True) == ["needed", "uncertain"]
    with pytest.raises(ValueError):
        R.score_rerank(ranking, scores, "none")


def test_metrics_with_patterns(spark):
    universe = spark.createDataFrame([("number_image/1.png",), ("number_image/2.png",), ("number_image/3.png",), ("other.txt",)], "source_path string")
    expected = spark.createDataFrame([("q1", 1, "number_image/*")], "question_id string, ord bigint, source string")
    predicted = spark.createDataFrame([("q1", "number_image/2.png"), ("q1", "number_image/3.png")], "question_id string, path string")
    asked = spark.createDataFrame([("q1",), ("q2",)], "question_id string")
    rows = {r["question_id"]: r for r in E.expanded_metrics(asked, expected, predicted, universe).collect()}
    assert (rows["q1"]["expected_count"], rows["q1"]["matched_count"], rows["q1"]["pattern_recall"]) == (3, 2, 1.0)
    assert rows["q1"]["recall"] == pytest.approx(2 / 3)
    assert (rows["q2"]["recall"], rows["q2"]["precision"], rows["q2"]["pattern_recall"]) == (1.0, 1.0, None)
    assert E.summary(E.expanded_metrics(asked, expected, predicted, universe)).first()["macro_recall"] == 0.6667


def test_describe(spark):
    frame = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)] + [("a", float("nan"))], "g string, x double")
    row = E.describe(frame, "x", ["g"]).first()
    assert (row["n"], row["median"], row["p10"], row["p25"], row["p90"]) == (4, 2.5, 1.0, 2.0, 4.0)
