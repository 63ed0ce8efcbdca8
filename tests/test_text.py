import hashlib

from pyspark.sql import functions as F

from lakebind.functions import text as T


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression.alias("y")).first()["y"]


def tokens(spark, value, expand=False):
    return T.with_tokens(spark.createDataFrame([(value,)], "x string"), F.col("x"), expand=expand).first()["tokens"]


def test_tokens_come_from_raw_and_folded_text(spark):
    assert tokens(spark, "alpha") == ["alpha", "alpha"]
    assert sorted(tokens(spark, "việt")) == ["vi", "viet"]
    assert tokens(spark, "điểm") == ["iem"] or sorted(tokens(spark, "điểm")) == ["iem"]
    assert "cua" in tokens(spark, "của")
    assert tokens(spark, "the a x") == []
    assert tokens(spark, "文字").count("文") == 2
    assert tokens(spark, None) == []


def test_synonyms_are_added_once_and_sorted(spark):
    assert tokens(spark, "thu vien", expand=True)[-2:] == ["library", "smart"]
    assert tokens(spark, "hinh", expand=True)[-5:] == ["image", "jpg", "photo", "picture", "png"]


def test_compact_and_truncate(spark):
    assert one(spark, T.compact(F.col("x"), 10), " a\n\t b  ") == "a b"
    assert one(spark, T.compact(F.col("x"), 8), "abcd efghij") == "abcd..."
    assert one(spark, T.agent_truncate(F.col("x"), 30), "x" * 40) == "x" * 10 + "\n[... truncated ...]"


def test_spans(spark):
    assert one(spark, T.quoted_spans(F.col("x")), "a \"b c\" “d” 'e' \"\"") == ["b c", "d", "e"]
    assert one(spark, T.folder_spans(F.col("x")), "in \"/a/b/\" and `c\\d`") == ["a/b", "c/d"]


def test_ids_and_paths(spark):
    frame = spark.createDataFrame([("r", "text", 0)], "a string, b string, c int")
    assert frame.select(T.stable_id("a" and F.col("a"), F.col("b"), F.col("c"))).first()[0] == hashlib.sha1(b"r::text::0").hexdigest()[:24]
    assert one(spark, T.compact_key(F.col("x")), "Dự án\\Ảnh 1.PNG") == "duananh1png"


def test_placeholder(spark):
    frame = spark.createDataFrame([("Deck available at x", ""), ("real", "ppt-placeholder"), ("real text", "plain"), (None, None)], "t string, p string")
    assert [r[0] for r in frame.select(T.is_placeholder(F.col("t"), F.col("p"))).collect()] == [True, True, False, False]
