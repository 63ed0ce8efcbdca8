import hashlib
import io
import json
import zipfile
import zlib

from pyspark.sql import functions as F

from lakebind.operators import chunking as C
from lakebind.operators import tables as B
from lakebind.operators.packed import resolve, split_packed
from lakebind.sources import files as S

RECORD = "record_id string, source_path string, kind string, role string, locator string, text string, parser string"


def test_chunks_of_long_short_and_placeholder_texts(spark):
    rows = [("a", "a.txt", "text", "text", "file", "abcdef" * 300, "plain-text"), ("b", "b.txt", "text", "text", "file", "x" * 100, ""), ("c", "c.ppt", "text", "text", "file", "real", "ppt-placeholder"), ("d", "d", "text", "t", "f", None, None), ("", "e", "text", "t", "f", "x", "")]
    chunks = C.chunk_records(spark.createDataFrame(rows, RECORD), 100, 10).orderBy("source_record_id", "start_char").collect()
    assert [c["source_record_id"] for c in chunks].count("b") == 1
    own = [c for c in chunks if c["source_record_id"] == "a"]
    assert len(own) == 20 and own[-1]["end_char"] == 1800 and own[1]["start_char"] == 90
    assert all("Source: a.txt" in c["embedding_text"] for c in own)
    assert {c["source_record_id"] for c in chunks} == {"a", "b"}
    assert own[1]["locator"] == "file;chunk=1" and own[1]["embedding_text"] == "Source: a.txt\nType: text\nRole: text\nLocator: file;chunk=1\n\n" + ("abcdef" * 300)[90:190]
    piece = "x" * 100
    expected = hashlib.sha1(f"b::text::0::0::100::{hashlib.sha256(piece.encode()).hexdigest()}".encode()).hexdigest()[:24]
    assert [c["chunk_id"] for c in chunks if c["source_record_id"] == "b"] == [expected]


def test_locators_default_to_the_kind_and_tables_are_labelled(spark):
    rows = [("i", "a.png", "image", None, None, "a pond", ""), ("t", "a.csv", "table", "r", "", "x", ""), ("s", "b.csv", "table", "r", "sheet=One", "x", ""), ("p", "c.csv", "table", "r", "", "x", "table-placeholder")]
    got = {c["source_record_id"]: c["locator"] for c in C.chunk_records(spark.createDataFrame(rows, RECORD)).collect()}
    assert got == {"i": "image;chunk=0", "t": "table;chunk=0", "s": "sheet=One;chunk=0"}
    frame = spark.createDataFrame([("d.csv", ["a", "b"], " 1,2 ", " profile ", "model"), ("d.csv", ["a", "b"], " 1,2 ", "", " "), ("d.csv", None, None, None, "model")], "p string, c array<string>, v string, d string, l string")
    texts = [r[0] for r in frame.select(C.table_text(*map(F.col, frame.columns))).collect()]
    assert texts == ["LLM table description:\nmodel\n\nStructured table profile:\nprofile", "Source table: d.csv\n\nColumn names: a, b\n\nPreview:\n1,2", "LLM table description:\nmodel"]


def test_embedding_reuses_the_cache(spark):
    rows = [("a", "a.txt", "text", "text", "file", "hello world", ""), ("b", "b.txt", "text", "text", "file", "other text", "")]
    chunks = C.chunk_records(spark.createDataFrame(rows, RECORD))
    first, cache = C.embed(chunks, None, C.HashingProvider(8))
    cache = spark.createDataFrame(cache.collect(), cache.schema)
    second, fresh = C.embed(chunks, cache.select("cache_key", "embedding"), C.HashingProvider(8))
    assert fresh.count() == 0
    pick = lambda df: {r["chunk_id"]: r["embedding"] for r in df.collect()}
    assert pick(first) == pick(second)


def test_messy_table(spark):
    text = "Loan export\nmade by hand\ncustomer_id,score,segment\nc1,720,A\nc2,650,B"
    row = B.analyze(spark.createDataFrame([("t", text)], "k string, x string"), "k", "x", F.lit(",")).first()
    assert (row["columns"], row["first_rows"][0][0], row["last_rows"][-1][0], row["data_rows"]) == (["customer_id", "score", "segment"], "c1", "c2", 2)
    assert "made by hand" in row["metadata_text"]
    names = spark.createDataFrame([(["a", "", "a", " b  c "],)], "h array<string>").select(B.column_names(F.col("h"))).first()[0]
    assert names == ["a", "column_2", "a_3", "b c"]
    odd = spark.createDataFrame([(["a", "a", "a_2"], ["1", "2", "3"]), (["a_3", "a", "a"], ["1", "2", "3", "4"]), (["x", "y"], ["1"])], "h array<string>, c array<string>")
    odd = odd.select(B.column_names(F.col("h")).alias("h"), "c").select("h", B.row_map(F.col("h"), F.col("c")).alias("m")).collect()
    assert [r["h"] for r in odd] == [["a", "a_2", "a_2_3"], ["a_3", "a", "a_3"], ["x", "y"]]
    assert [r["m"] for r in odd] == [{"a": "1", "a_2": "2", "a_2_3": "3"}, {"a_3": "3", "a": "2"}, {"x": "1", "y": ""}]
    cases = spark.createDataFrame([("Id,ID\nx,x\n1,2",), ("alone",), ("",), (None,)], "x string")
    found = [(r["header_index"], r["columns"], r["data_rows"]) for r in B.analyze(cases.withColumn("k", F.lit(1)), "k", "x", F.lit(",")).collect()]
    assert found == [(0, ["Id", "ID"], 2), (None, ["column_1"], 1), (None, [], 0), (None, [], 0)]


def test_sheets_of_a_workbook_are_taken_together(spark):
    sheets = spark.createDataFrame([("w", "One", [["note"], ["id", "v"], ["1", "2"]]), ("w", "Two", [["v", "z"], ["3", "4"]])], "k string, s string, g array<array<string>>")
    row = B.sheet_rollup(sheets, "k", "s", "g").first()
    assert row["columns"] == ["id", "v", "z"] and row["sheet_count"] == 2 and row["metadata_text"] == "Sheet One: note"
    assert [json.loads(x) for x in row["first_rows"]] == [{"sheet": "One", "id": "1", "v": "2"}, {"sheet": "Two", "v": "3", "z": "4"}]
    assert [x["observed_row_count"] for x in json.loads(row["sheets"])] == [3, 2]


def test_packed_rules():
    plain = lambda text: [
        "".join(tokens[a:b]) for tokens in [__import__("re").findall(__import__("lakebind.operators.packed", fromlist=["x"]).TOKEN, text)]
        for a, b, _ in resolve("".join(t if len(t) == 1 and t in __import__("lakebind.operators.packed", fromlist=["x"]).STRUCTURE else "a" for t in tokens))]
    assert plain("a/b.txt, c d.csv ;; e|f") == ["a/b.txt", "c d.csv", "e", "f"]
    assert plain('"x, y.txt";z') == ["x, y.txt", "z"]
    assert plain("kid's file.md\tb") == ["kid's file.md", "b"]
    assert plain("") == [] and plain("[]") == ["[]"] or plain("[]") == []


def test_packed_fields(spark):
    rows = [("1", '["a.txt", "B\\u1ea3ng.pdf"]', "z"), ("1", '["a.txt", "B\\u1ea3ng.pdf"]', "z"), ("2", "'x \"y\"' | ; z\\w", "z"), ("3", '"the ""set"" 3";b', "z"), ("4", "only", "z"), ("5", None, "z"), ("6", " ", "z"), (None, "a,b", "z"), ("7", "[\"q\\\\r\", 's']", "z"), ("8", "a,a", "z")]
    frame = spark.createDataFrame(rows, "question_id string, data_sources string, value string")
    got = sorted(map(tuple, split_packed(frame, "question_id", "data_sources").collect()))
    assert got == sorted([("1", 1, "a.txt"), ("1", 2, "Bảng.pdf"), ("2", 1, 'x "y"'), ("2", 2, "z\\w"), ("3", 1, 'the "set" 3'), ("3", 2, "b"), ("7", 1, "q\\r"), ("7", 2, "s"), ("8", 1, "a"), ("8", 2, "a")])
    shuffled = split_packed(frame, "question_id", "data_sources", broadcast_bytes=0)
    assert sorted(map(tuple, shuffled.collect())) == got
    assert split_packed(frame.limit(0), "question_id", "data_sources").count() == 0


def _zip(parts):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as archive:
        for name, body in parts.items():
            archive.writestr(name, body)
    return raw.getvalue()


def _pdf():
    content = zlib.compress(b"BT /F1 12 Tf 72 700 Td (Hello \\(world\\)) Tj 0 -14 Td [(sec)-20(ond) -300 (line)] TJ ET")
    page = b"<</Type /Page /Parent 2 0 R /Contents 4 0 R /Resources <</Font <</F1 5 0 R>> /XObject <</I 6 0 R>> >> >>"
    return (
        b"%PDF-1.4\n1 0 obj <</Type /Catalog /Pages 2 0 R>> endobj\n2 0 obj <</Type /Pages /Kids [3 0 R] /Count 1>> endobj\n3 0 obj " + page + b" endobj\n4 0 obj <</Filter /FlateDecode>> stream\n" + content
        + b"\nendstream endobj\n5 0 obj <</Type /Font>> endobj\n6 0 obj <</Subtype /Image /Filter /DCTDecode>> stream\nJPEG\nendstream endobj\ntrailer <</Root 1 0 R>>")


def test_lake_of_files(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    a = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
    m = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    (tmp_path / "sub").mkdir()
    files = {
        "a.txt": "café".encode(), "sub/b.html": b"<p>x &amp; y</p><script>no</script>", "c.csv": b"note\nid,score\n1,2\n3,4", "bad.docx": b"no zip", ".hidden.txt": b"h",
        "d.docx": _zip({"word/document.xml": f"<d {w}><w:t>one</w:t><w:t>two</w:t></d>"}),
        "e.pptx": _zip({"ppt/slides/slide1.xml": f"<s {a}><a:t>first</a:t></s>", "ppt/slides/slide2.xml": f"<s {a}></s>", "ppt/slides/slide10.xml": f"<s {a}><a:t>last</a:t></s>", "ppt/media/i.png": b"x"}),
        "f.sql": b"CREATE TABLE g(id INTEGER, v REAL); INSERT INTO g VALUES (1, 8.0), (2, NULL);", "h.mp3": b"", "i.mp3": b"", "i.srt": b"spoken", "k.png": b"x", "m.png": b"y", "odd.bin": b"z", "broken.pdf": b"no", "l.pdf": _pdf(),
        "g.xlsx": _zip({"xl/workbook.xml": f'<w {m}><sheets><sheet name="Orders" r:id="r1"/></sheets></w>', "xl/_rels/workbook.xml.rels": '<R><Relationship Id="r1" Target="worksheets/s1.xml"/></R>', "xl/worksheets/s1.xml": f'<w {m}><row><c r="A1" t="inlineStr"><is><t>order_id</t></is></c><c r="C1" t="inlineStr"><is><t>amount</t></is></c></row><row><c r="A2"><v>1</v></c><c r="C2"><v>10</v></c></row></w>'}),
    }
    for name, body in files.items():
        (tmp_path / name).write_bytes(body)
    cache = tmp_path.parent / "cache"
    cache.mkdir()
    (cache / "m.json").write_text(json.dumps({"markdown": "text ![a chart](r1.png) more", "image_files": [{"path": "r1.png"}]}))
    rows = S.read_lake(spark, str(tmp_path), str(cache), str(tmp_path.parent / "kept")).collect()
    by = {(r["file_path"] if r["record"] == "table" else r["source_path"], r["record"]): r for r in rows}
    assert by[("a.txt", "text")]["text"] == "café" and by[("sub/b.html", "text")]["text"] == "x & y" and by[("a.txt", "text")]["mime_type"] == "text/plain"
    assert by[("a.txt", "text")]["record_id"] == hashlib.sha1(b"a.txt::text").hexdigest()[:20]
    assert by[("d.docx", "text")]["text"] == "one two" and by[("e.pptx", "text")]["text"] == "Slide 1: first\n\nSlide 3: last"
    assert by[("e.pptx", "image")]["locator"] == "ppt/media/i.png" and by[("bad.docx", "text")]["parser"] == "docx-placeholder"
    assert (tmp_path.parent / "kept" / by[("e.pptx", "image")]["file_path"]).read_bytes() == b"x"
    table = by[("f.sql#table=g", "table")]
    assert table["n_rows"] == 2 and table["first_rows"] == [{"id": "1", "v": "8.0"}, {"id": "2", "v": ""}] and json.loads(table["table_shape"])["statement_count"] == 2
    assert by[("g.xlsx#sheet=Orders", "table")]["columns"] == ["order_id", "column_2", "amount"] and by[("g.xlsx#sheet=Orders", "table")]["source_path"] == "g.xlsx"
    assert by[("c.csv", "table")]["columns"] == ["id", "score"] and by[("c.csv", "table")]["metadata_text"] == "note" and "Column names: id, score" in by[("c.csv", "table")]["description"]
    assert "ASR is disabled" in by[("h.mp3", "text")]["text"] and by[("i.mp3", "text")]["text"] == "spoken"
    assert by[("l.pdf", "text")]["text"] == "Page 1:\nHello (world)\nsecond line" and by[("l.pdf", "image")]["locator"] == "page=1;image=0"
    assert by[("broken.pdf", "text")]["parser"] == "pdf-placeholder" and by[("odd.bin", "text")]["role"] == "unhandled_placeholder"
    assert by[("m.png", "text")]["role"] == "raw_image_ocr_text" and by[("m.png", "image")]["text"] == "a chart" and by[("k.png", "image")]["role"] == "raw_image"
    assert not [r for r in rows if "hidden" in r["source_path"]]
    lexical = {r["source_path"]: r for r in S.read_lexical(spark, str(tmp_path)).collect()}
    assert lexical["c.csv"]["text"] == "c.csv c note id score 1 2 3 4" and lexical["c.csv"]["source_kind"] == "table" and lexical["g.xlsx"]["text"].startswith("g.xlsx g Sheet Orders order_id")
    assert lexical["bad.docx"]["text"].startswith("bad.docx bad Extraction failed for bad.docx: BadZipFile") and lexical["l.pdf"]["text"].endswith("second line")


def test_captions_stems_and_parser_texts():
    assert S.captions("![ one ](a) ![](b) ![two](c d)") == ["one", "two"] and S.plain_markdown("see ![a](b) [c](d)") == "see a c"
    assert S.figure_captions({"figures": [{"caption": " x "}, {"text": "y"}, "z", ""], "images": None}) == ["x", "y", "z"]
    assert S.best_text({"text": "short", "extraction": {"main_text": "longer text", "tables": [{"content": "a"}, {"caption": "b"}]}}) == "longer text"
    assert S.safe_stem("a b/ü.png").startswith("a__b__.png__"[:3]) and S.safe_stem("a\\b") == S.safe_stem("a/b") and [S.column_number(x) for x in ("A1", "Z3", "AA9")] == [0, 25, 26]


def test_sinks_and_registry(spark, tmp_path):
    frame = spark.createDataFrame([("1", 'say "x"')], "id string, answer string")
    S.write_jsonl(frame, f"{tmp_path}/j")
    assert S.read_jsonl(spark, f"{tmp_path}/j", "id string, answer string").collect() == frame.collect()
    S.write_csv(frame, f"{tmp_path}/c", "id")
    assert spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/c").collect() == frame.collect()
    for name in ("r1", "r2", "r1"):
        S.write_run(frame, f"{tmp_path}/runs", name, {"top_k": 20}, {"recall": 0.5})
    assert S.list_runs(f"{tmp_path}/runs") == ["r1", "r2"]
    results, manifest, summary = S.read_run(spark, f"{tmp_path}/runs", "r2")
    assert results.count() == 1 and manifest == {"run_name": "r2", "top_k": 20} and summary == {"recall": 0.5}
    assert json.loads((tmp_path / "runs" / "latest.json").read_text())["run_dir"] == "run_name=r1"
    forms = ('[{"id": 3, "source_files": ["a"]}]', '{"results": [{"id": "3", "source_files": ["a"]}]}', '{"3": ["a"]}')
    for k, form in enumerate(forms):
        (tmp_path / f"r{k}.json").write_text(form)
        assert [tuple(r) for r in S.read_retrieval_json(spark, f"{tmp_path}/r{k}.json").collect()] == [("3", ["a"])]
    (tmp_path / "config.json").write_text('{"top_k": 5}')
    assert S.read_config(f"{tmp_path}/config.json") == {"top_k": 5}
    (tmp_path / "q.csv").write_text('STT,Question,data sources\n3.0,"why, so",["a.txt"]\n4,,x\n5,how,b.txt\n'.replace('["a.txt"]', '"[""a.txt""]"'))
    rows = {r["question_id"]: r["data_sources"] for r in S.read_questions(spark, f"{tmp_path}/q.csv").collect()}
    assert rows == {"3": ["a.txt"], "5": ["b.txt"]}
    assert sorted(tuple(r) for r in S.read_agent_questions(spark, f"{tmp_path}/q.csv").collect()) == [("3", "why, so"), ("5", "how")]


def test_stream_embeds_new_chunks_once(spark, tmp_path):
    from lakebind.streaming.embedding import embed_stream

    chunks = C.chunk_records(spark.createDataFrame([("a", "a.txt", "text", "text", "file", "hello world", "")], RECORD)).select("chunk_id", "embedding_text")
    for k in range(2):
        chunks.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(chunks.schema).parquet(f"{tmp_path}/in")
        embed_stream(spark, stream, f"{tmp_path}/cache", f"{tmp_path}/check", C.HashingProvider(4)).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/cache").count() == 1


def test_queries_and_sql_have_the_same_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_contexts_hold_all_records_and_fit_the_budget(spark):
    from lakebind.plans import canonical as P

    sample = "sample_rows array<map<string,string>>, tail_sample_rows array<map<string,string>>"
    texts = spark.createDataFrame([(f"t{k}", "a.txt", "x" * 500 + f"\nend{k} ", "r", None) for k in range(5)] + [("t0", "a.txt", "x" * 500 + "\nend0 ", "r", None), ("long", "b.txt", "y" * 30000, "r", "p")], "text_id string, source_path string, text string, role string, parser string")
    tables = spark.createDataFrame([("k", "a.txt", "r", "p", "about", "1,2", ["id", "v"], [{"id": "é"}], [{"id": "9"}], None), ("l", "a.txt", "r", "p", "", "", [], None, [{"id": "9"}], "more")], f"table_id string, source_path string, role string, parser string, description string, preview_text string, columns array<string>, {sample}, llm_description string")
    images = spark.createDataFrame([("i", "a.txt", "photo", "a pond"), ("j", " ", "photo", "lost")], "image_id string, source_path string, role string, description string")
    contexts = P.render_contexts(texts, tables, images)
    got = {r["source_path"]: r["context"] for r in contexts.collect()}
    text = "\n\n".join(f"Role: r\nText context:\n{'x' * 500}\nend{k}" for k in range(5))
    first = 'Role: r\nParser: p\nDescription:\nabout\nPreview:\n1,2\nColumns:\nid, v\nSample rows:\n[\n  {\n    "id": "é"\n  }\n]'
    second = 'Role: r\nParser: p\nTail sample rows:\n[\n  {\n    "id": "9"\n  }\n]\nEnhanced description:\nmore'
    assert got["a.txt"] == f"Path: a.txt\n[TEXT CONTEXT]\n{text}\n\n\n[TABLE CONTEXT]\n{first}\n\n{second}\n\n\n[IMAGE CONTEXT]\nRole: photo\nDescription:\na pond"
    assert got["b.txt"].endswith("y" * 19980 + "\n[... truncated ...]") and set(got) == {"a.txt", "b.txt"}
    whole = {k: len(v) for k, v in got.items()}
    hits = spark.createDataFrame([("q", "b.txt", 0.9), ("q", "none", 0.8), ("q", "a.txt", 0.7), ("q", "a.txt", float("nan")), ("q", "", 1.0), (None, "a.txt", 1.0)], "question_id string, source_path string, score double")
    kept = {r["source_path"]: r["kept"] for r in P.budget_contexts(contexts, hits).collect()}
    assert kept == {"b.txt": whole["b.txt"], "none": len("Path: none\nNo canonical context found for none."), "a.txt": whole["a.txt"]}
    many = contexts.limit(0).unionByName(spark.createDataFrame([(f"s{k}", "z" * 25000) for k in range(4)], contexts.schema))
    hits = spark.createDataFrame([("q", f"s{k}", 1.0 - k / 10) for k in range(4)], "question_id string, source_path string, score double")
    assert {r["source_path"]: r["kept"] for r in P.budget_contexts(many, hits).collect()} == {"s0": 25000, "s1": 25000, "s2": 10000}


def test_descriptions_have_samples_shape_and_metadata(spark):
    rows = "array<map<string,string>>"
    frame = spark.createDataFrame(
        [("a.csv", ".csv", "p", " note\n", ["id"], [{"id": "é"}], [{"id": "9"}], '{"row_count": 4, "column_count": 1}'), ("b", "", "p", None, None, [{"id": "1"}], [{"id": "1"}], None), ("c", "", "p", "", [], None, [{"id": "x" * 6000}], "{}")],
        f"path string, extension string, parser string, metadata string, columns array<string>, sample {rows}, tail {rows}, shape string")
    got = {r[0]: r[1] for r in frame.select("path", B.description(*map(F.col, frame.columns))).collect()}
    assert got["a.csv"] == (
        "Source table: a.csv\n\nFile type: csv\n\nParser: p\n\nMetadata or explanation text before/around the table:\nnote\n\nColumn names: id\n\n"
        'First sample rows:\n[\n  {\n    "id": "é"\n  }\n]\n\nLast sample rows:\n[\n  {\n    "id": "9"\n  }\n]\n\nObserved table shape/profile: {"column_count": 1, "row_count": 4}')
    assert got["b"] == 'Source table: b\n\nFile type: table\n\nParser: p\n\nFirst sample rows:\n[\n  {\n    "id": "1"\n  }\n]'
    assert len(got["c"].split("Last sample rows:\n")[1]) == 5000
