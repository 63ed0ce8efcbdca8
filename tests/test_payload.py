import json

import pytest
from pyspark.sql import functions as F

from lakebind.operators import evaluation as E
from lakebind.operators import payload as P
from lakebind.operators import retrieval as R
from lakebind.operators import tables as B


def echo(log, reply):
    """Makes a model that answers every prompt and counts what it is asked in a file, as it runs in another process."""

    def make():
        class Echo:
            name = "echo"

            def ask(self, system, prompt):
                with open(log, "a") as out:
                    out.write("x\n")
                return reply

        return Echo()

    return make


def _results(spark):
    corpus = spark.createDataFrame([(f"c{k}", f"s{k % 3}.csv" if k < 9 else "lone.png", "table" if k < 9 else "image", "r", f"l{k}", f"text {k}" + " long" * 400 * (k == 0)) for k in range(10)], "chunk_id string, source_path string, source_kind string, source_role string, locator string, text string")
    hits = spark.createDataFrame([("q", f"c{k}", f"s{k % 3}.csv", 1.0 - k / 10, k + 1) for k in range(8)], "question_id string, chunk_id string, source_path string, score double, rank int")
    ranking = spark.createDataFrame([("q", "s0.csv", 1.0, 1), ("q", "s1.csv", 0.9, 2), ("q", "absent", 0.1, 3)], "question_id string, source_path string, score double, source_rank int")
    return corpus, hits, ranking


def test_payload_of_results(spark):
    corpus, hits, ranking = _results(spark)
    rows = {r["source_path"]: r for r in P.with_payload(ranking, hits, corpus, "bm25", 2).collect()}
    assert [c["chunk_id"] for c in rows["s0.csv"]["chunks"]] == ["c0", "c3"] and rows["s0.csv"]["source_kind"] == "table" and rows["s0.csv"]["reasons"] == ["bm25"]
    assert 890 < len(rows["s0.csv"]["chunks"][0]["text"]) <= 900 and rows["s0.csv"]["source_chunks"] == 3
    assert rows["absent"]["source_kind"] == "file" and rows["absent"]["chunks"] is None and rows["absent"]["source_chunks"] == 0
    own = hits.withColumn("reasons", F.array(F.lit("path"), F.lit("content")))
    assert P.with_payload(ranking, own, corpus, "").where("source_path = 's0.csv'").first()["reasons"] == ["content", "path"]
    parts = {r["source_path"]: r for r in P.vector_components(hits, corpus).collect()}
    assert parts["s0.csv"]["matched_chunk_count"] == 3 and abs(parts["s0.csv"]["mean_top3_chunk_score"] - (1.0 + 0.7 + 0.4) / 3) < 1e-9 and parts["s2.csv"]["matched_chunk_bonus_count"] == 2
    told = P.with_summaries(ranking, spark.createDataFrame([("s0.csv", 2)], "source_path string, tables int"))
    assert {r["source_path"]: r["source_summary"] for r in told.collect()} == {"s0.csv": '{"tables":2}', "s1.csv": "{}", "absent": "{}"}


def test_payload_without_texts_moves_none(spark):
    corpus, hits, ranking = _results(spark)
    whole, bare = P.with_payload(ranking, hits, corpus, "bm25"), P.with_payload(ranking, hits, corpus, "bm25", texts=False)
    plain = lambda df: sorted(map(str, df.withColumn("chunks", F.transform("chunks", lambda c: c["chunk_id"])).collect()))
    assert plain(bare) == plain(whole)
    held = lambda df: [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "text#" in line and "LogicalRDD" not in line]
    assert held(whole) and not held(bare)


def test_judge_is_asked_once_and_its_reply_is_parsed(spark, tmp_path):
    corpus, hits, ranking = _results(spark)
    results = P.with_payload(ranking, hits, corpus, "bm25")
    asked = spark.createDataFrame([("q", "why?")], "question_id string, question string")
    reply = 'Sure: ```json\n{"items": [{"source_path": "s0.csv", "relevance": 3, "evidence_role": "data_item", "keep": true}, {"source_path": "s1.csv", "relevance": "x"}, 5]}```'
    log = str(tmp_path / "log")
    scores, cache = P.judged(results, asked, echo(log, reply), "echo")
    got = {r["source_path"]: (r["relevance"], r["keep"]) for r in scores.collect()}
    assert got == {"s0.csv": (1.0, True), "s1.csv": (0.0, False)}
    again, fresh = P.judged(results, asked, echo(log, "other"), "echo", cache=cache)
    assert fresh.count() == 0 and {r["source_path"] for r in again.collect()} == set(got) and len((tmp_path / "log").read_text().split()) == 1
    _, other = P.judged(results, asked, echo(log, reply), "echo", "strict", cache)
    assert other.count() == 1
    top = R.score_rerank(ranking, scores).collect()
    assert top[0]["source_path"] == "s0.csv" and len(top) == 3
    with pytest.raises(ValueError):
        P.judged(results, asked, lambda: None, "echo", "unknown")


def test_candidates_and_small_parsers(spark):
    corpus, hits, ranking = _results(spark)
    row = json.loads(P.with_payload(ranking, hits, corpus, "bm25").where("source_path = 's1.csv'").select(P.candidate().alias("c")).first()["c"])
    assert row["source_extension"] == ".csv" and [s["chunk_index"] for s in row["snippets"]] == [1, 2, 3] and row["reasons"] == ["bm25"]
    assert P.lenient_json('```json\n{"a": 1}\n```') == {"a": 1} and P.lenient_json("no") == {} and P.lenient_json("[1]") == {} and P.lenient_json('x {"a": {"b": 2}} y') == {"a": {"b": 2}}
    assert P.described('{"description": "a pond", "objects": ["reed", 2], "colors": "green"}') == "Description: a pond\nObjects: reed, 2\nColors: green" and P.described(" plain ") == "plain"
    assert P.compact_value({"b": 1, "a": "x  y"}, 100) == '{"a": "x y", "b": 1}' and P.compact_value(None, 5) == "" and P.compact_value("abcdefgh", 6) == "abc..."


def test_enrichment_selects_asks_and_keeps(spark, tmp_path):
    rows = spark.createDataFrame([("1", "photos/a.png", "short"), ("2", "photos\\b.png", "a long enough text"), ("3", "maps/c.png", None), ("4", "photos/d.png", None)], "image_id string, source_path string, description string")
    pick = lambda **k: [r["image_id"] for r in P.select_for_enrichment(rows, "image_id", F.col("description"), **k).orderBy("image_id").collect()]
    assert pick(prefixes=("photos/",), least=10) == ["1", "4"] and pick() == ["1", "2", "3", "4"] and pick(least=10, limit=2) == ["1", "3"] and pick(least=10, force=True) == ["1", "2", "3", "4"]
    out, cache = P.enriched(rows, "image_id", F.concat(F.lit("Source: "), "source_path"), "describe", echo(str(tmp_path / "log"), '{"description": "x"}'), "echo")
    assert {r["description"] for r in out.collect()} == {"Description: x"} and cache.count() == 4


def test_sources_are_attached_and_evidences_fall_back(spark):
    asked = spark.createDataFrame([("1", "a"), ("2", "b")], "question_id string, question string")
    retrieved = spark.createDataFrame([("1", ["x", "y"])], "question_id string, source_files array<string>")
    assert {r["question_id"]: r["source_files"] for r in P.attach_sources(asked, retrieved).collect()} == {"1": ["x", "y"], "2": []}
    answers = spark.createDataFrame([("1", ["a"]), ("2", []), ("3", None)], "question_id string, evidences array<string>")
    other = spark.createDataFrame([("1", ["b"]), ("2", ["c"])], "question_id string, evidences array<string>")
    assert {r["question_id"]: r["evidences"] for r in P.evidence_or_fallback(answers, other).collect()} == {"1": ["a"], "2": ["c"], "3": []}


def test_scripts_and_percentiles(spark):
    scripts = spark.createDataFrame([("a", 'CREATE TABLE class(id INTEGER, name TEXT); SELECT x FROM t1 JOIN `s.t2` ON 1'), ("b", "nothing")], "k string, body string")
    names, columns = B.sql_names(F.col("body"))
    assert [tuple(r) for r in scripts.select(F.array_join(names, ","), F.array_join(columns, ",")).collect()] == [("class,s.t2,t1", "id,name"), ("", "")]
    rows = spark.createDataFrame([("g", float(v % 7)) for v in range(101)] + [("h", 1.0), ("h", None), ("h", float("nan"))], "g string, x double")
    got = {r["g"]: r for r in E.describe(rows, "x", ["g"]).collect()}
    values = sorted(float(v % 7) for v in range(101))
    assert (got["g"]["n"], got["g"]["p10"], got["g"]["median"], got["g"]["p90"]) == (101, values[10], values[50], values[90]) and got["h"]["n"] == 1 and got["h"]["p75"] == 1.0


def test_patterns_and_keys_of_stated_truths(spark):
    truth = spark.createDataFrame([("q1", 1, "reports/*"), ("q1", 2, "Reports\\Absent.pdf"), ("q2", 1, "*.csv"), ("q3", 1, "SCANS/Harbour-Trust/minutes PDF"), ("q4", 1, "no/such/*")], "question_id string, ord bigint, source string")
    universe = spark.createDataFrame([("reports/a.pdf",), ("reports/b.csv",), ("scans/harbour_trust/minutes.pdf",)], "source_path string")
    guesses = spark.createDataFrame([("q1", "reports/a.pdf"), ("q1", "x"), ("q3", "scans/harbour_trust/minutes.pdf")], "question_id string, path string")
    asked = spark.createDataFrame([(f"q{k}",) for k in range(1, 6)], "question_id string")
    rows = {r["question_id"]: r for r in E.expanded_metrics(asked, truth, guesses, universe).collect()}
    assert abs(rows["q1"]["recall"] - 1 / 3) < 1e-9 and rows["q1"]["precision"] == 0.5 and rows["q3"]["recall"] == 1.0 and rows["q2"]["recall"] == 0.0 and rows["q5"]["recall"] == 1.0
    wrong = {(r["kind"], r["path"]) for r in E.diagnostics(truth.select("question_id", "source"), guesses).where("question_id = 'q1'").collect()}
    assert wrong == {("missed", "Reports\\Absent.pdf"), ("false_positive", "x")}


def test_vectors_by_matrix_and_by_join(spark):
    vectors = spark.createDataFrame([(f"v{k}", "s", "text", [float(k), 1.0, 0.5][: 2 + k % 2]) for k in range(30)] + [("zero", "s", "text", [0.0, 0.0]), ("none", "s", "text", None)], "chunk_id string, source_path string, source_kind string, embedding array<double>")
    queries = spark.createDataFrame([("a", [1.0, 2.0, 3.0]), ("b", [0.0, 0.0])], "question_id string, embedding array<double>")
    got = {(r["question_id"], r["chunk_id"]): r["score"] for r in R.vector_scores(vectors, queries).collect()}
    joined = {(r["question_id"], r["chunk_id"]): r["score"] for r in R._vector_join(vectors.where("embedding IS NOT NULL"), queries).collect()}
    assert all(abs(got[k] - v) < 1e-12 for k, v in joined.items()) and len(got) == 64 and got["a", "none"] == 0.0
    top = {r["chunk_id"] for r in R.vector_scores(vectors, queries, 3).where("question_id = 'a'").collect()}
    assert {c for (q, c), s in sorted(got.items(), key=lambda x: -x[1]) if q == "a"}.issuperset(top) and len(top) >= 3
