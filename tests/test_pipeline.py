import json

import pytest
from pyspark.sql import functions as F

from lakebind.plans import agent as A
from lakebind.plans import pipeline as P


def test_presets_and_overrides():
    config = P.configure("folder_expand_flash", expand_folders=False, top_k=10, rerank=None)
    assert (config.mode, config.expand_folders, config.top_k, config.rerank) == ("vector", False, 10, "scores")
    with pytest.raises(ValueError):
        P.configure("other")
    with pytest.raises(ValueError):
        P.configure(nonsense=1)
    assert json.loads(P.manifest(config, "r", "folder_expand_flash", model="m"))["vector_aggregation"] == "legacy"


def test_validation():
    with pytest.raises(ValueError):
        P.Pipeline(P.configure(mode="vector"))
    with pytest.raises(ValueError):
        P.Pipeline(P.configure(mode="odd"))
    with pytest.raises(ValueError):
        P.Pipeline(P.configure(mode="bm25"))


def test_pipeline_end_to_end(spark):
    corpus = spark.createDataFrame([("a", "x/a.txt", "text", "t", "f", "alpha beta"), ("b", "x/b.txt", "text", "t", "f", "credit loan")], "chunk_id string, source_path string, source_kind string, source_role string, locator string, text string")
    asked = spark.createDataFrame([("q1", "credit loan in \"x\"", [1.0, 0.0])], "question_id string, question string, embedding array<double>")
    vectors = spark.createDataFrame([("a", "x/a.txt", "text", [1.0, 0.0]), ("b", "x/b.txt", "text", [0.0, 1.0])], "chunk_id string, source_path string, source_kind string, embedding array<double>")
    first = lambda **k: P.Pipeline(P.configure(**k), corpus, vectors).retrieve(asked).orderBy("source_rank").first()["source_path"]
    assert first(mode="bm25") == "x/b.txt" and first(mode="lexical") == "x/b.txt" and first(mode="vector") == "x/a.txt"
    assert first(mode="bm25", rerank="heuristic") == "x/b.txt"
    assert P.Pipeline(P.configure(mode="hybrid"), corpus, vectors).retrieve(asked).count() == 2
    universe = spark.createDataFrame([("x/a.txt",), ("x/b.txt",), ("x/c.txt",)], "source_path string")
    expanded = P.Pipeline(P.configure(mode="bm25", expand_folders=True), corpus, vectors, universe=universe).retrieve(asked)
    assert {r["source_path"] for r in expanded.collect()} == {"x/a.txt", "x/b.txt", "x/c.txt"}
    expected = spark.createDataFrame([("q1", 1, "x/b.txt")], "question_id string, ord bigint, source string")
    rows, summary = P.Pipeline(P.configure(mode="bm25"), corpus).evaluate(asked, expected, universe)
    assert rows.first()["recall"] == 1.0 and summary.first()["perfect_recall_rate"] == 1.0


def test_agent_loop_and_resume(tmp_path):
    fake = A.FakeProvider("DIRECT", "<final_answer> 42 </final_answer>")
    assert A.answer("q", "c", [], fake, f"{tmp_path}/a") == "42" and len(fake.prompts) == 2
    again = A.FakeProvider("never")
    assert A.answer("q", "c", [], again, f"{tmp_path}/a") == "42" and not again.prompts
    fake = A.FakeProvider("CODE", "plan", "```python\nx\n```", "yes", "FINAL_ANSWER: done")
    assert A.answer("q", "c", ["f"], fake, f"{tmp_path}/b", execute=lambda code: (True, code)) == "done"
    fake = A.FakeProvider("CODE", "no")
    assert A.answer("q", "c", ["f"], fake, f"{tmp_path}/c") == "no"
    assert len(fake.prompts) == 1 + 3 * 5 + 1
    assert [A.route("", True), A.route("", False), A.route("go direct", True)] == ["CODE", "DIRECT", "DIRECT"]


def test_heuristic_rerank_keeps_the_sources_of_its_own_retrieval(spark):
    corpus = spark.createDataFrame([(c, f"x/{c}.txt", "text", "t", "f", t) for c, t in (("a", "alpha beta"), ("b", "credit loan"), ("d", "nothing shared"))], "chunk_id string, source_path string, source_kind string, source_role string, locator string, text string")
    asked = spark.createDataFrame([("q1", "credit loan", [1.0, 0.0])], "question_id string, question string, embedding array<double>")
    vectors = spark.createDataFrame([(c, f"x/{c}.txt", "text", v) for c, v in (("a", [1.0, 0.0]), ("b", [0.8, 0.6]), ("v", [0.6, 0.8]))], "chunk_id string, source_path string, source_kind string, embedding array<double>")

    def scores(**k):
        return {r["source_path"]: round(r["score"], 6) for r in P.Pipeline(P.configure(rerank="heuristic", **k), corpus, vectors).retrieve(asked).collect()}

    by_vector = scores(mode="vector")
    assert set(by_vector) == {"x/a.txt", "x/b.txt", "x/v.txt"}  # a and v share no token with the question
    assert by_vector["x/a.txt"] == 0.7 and by_vector["x/v.txt"] == 0.0  # scored on their own cosines
    both = scores(mode="hybrid")
    assert set(both) == {"x/a.txt", "x/b.txt", "x/v.txt"}
    assert both["x/b.txt"] == pytest.approx(0.15 + 0.4 + 0.15 + 0.15 + 0.05)  # found by both channels
    kinds = spark.createDataFrame([("p", "y/p.csv", "table", "t", "f", "unrelated")], corpus.schema)
    named = asked.withColumn("question", F.lit("which csv"))
    assert P.Pipeline(P.configure(mode="lexical", rerank="heuristic"), kinds).retrieve(named).count() == 1


def test_questions_are_answered_in_tasks_and_resumed(spark, tmp_path):
    from lakebind.plans import agent as A
    from lakebind.sources import files as S

    asked = spark.createDataFrame([("1", "how many?", ["a.txt", "b.txt"]), ("x/2", "why?", [])], "question_id string, question string, source_files array<string>")
    contexts = spark.createDataFrame([("a.txt", "three reeds")], "source_path string, context string")

    def echo(reply):
        def make():
            class Echo:
                def generate(self, prompt):
                    return "DIRECT" if prompt.startswith("DIRECT") else f"<final_answer>{reply} {'three reeds' in prompt} {'No context found for b.txt' in prompt}</final_answer>"

            return Echo()

        return make

    def broken():
        raise RuntimeError("no model")

    answers = lambda make: {r["question_id"]: (r["answer"], r["n_files"]) for r in A.answer_all(asked, contexts, make, str(tmp_path / "steps")).collect()}
    assert answers(echo("yes")) == {"1": ("yes True True", 2), "x/2": ("yes False False", 0)}
    assert answers(echo("again")) == {"1": ("yes True True", 2), "x/2": ("yes False False", 0)}
    assert {r["answer"] for r in A.answer_all(asked, contexts, broken, str(tmp_path / "other")).collect()} == {""}
    cache = str(tmp_path / "cache")
    assert A.recall(spark, cache).count() == 0
    for result in ("old", "new"):
        A.remember(spark.createDataFrame([("a.txt", "code", result)], "file string, code string, result string"), cache)
    assert [r["result"] for r in A.recall(spark, cache).collect()] == ["new"]
    S.write_evaluation(spark.createDataFrame([("2", 1.0), ("1", 0.5)], "question_id string, recall double"), spark.createDataFrame([(0.75,)], "macro_recall double"), str(tmp_path / "eval"))
    assert [r["value"][:22] for r in spark.read.text(str(tmp_path / "eval")).collect()] == ['{"summary":{"macro_rec', '{"result":{"question_i', '{"result":{"question_i']
