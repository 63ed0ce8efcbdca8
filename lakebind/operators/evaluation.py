"""Retrieval metrics: recall and precision with path, key and pattern matching, and score separation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebind.functions import text as T
from lakebind.storage import cut, shuffle_partitions


def is_pattern(path: Column) -> Column:
    return path.rlike(r"[*?\[\]]")


def expand_expected(expected: DataFrame, universe: DataFrame) -> DataFrame:
    """(question_id, source): expected patterns replaced by the files they match, then one source for each compact key.

    The first of equal keys stays, in the order of ``ord``, then of the path.
    """
    rows = expected.select("question_id", "ord", F.replace("source", F.lit("\\"), F.lit("/")).alias("source"))
    patterns = rows.where(is_pattern(F.col("source")))
    distinct = patterns.select("source").distinct().withColumn("rx", T.glob_regex(T.normal_path(F.col("source"))))
    # patterns are few and distinct; files meet them by their regular expressions
    files = universe.select(F.col("source_path").alias("path"), T.normal_path(F.col("source_path")).alias("np"))
    matched = distinct.join(files, F.expr("np RLIKE rx")).select("source", "path")
    expanded = patterns.join(matched, "source").select("question_id", "ord", F.col("path").alias("source"))
    both = rows.where(~is_pattern(F.col("source"))).unionByName(expanded)
    keyed = both.groupBy("question_id", T.compact_key(F.col("source")).alias("ck")).agg(F.min(F.struct("ord", "source")).alias("s"))
    return keyed.select("question_id", F.col("s.source").alias("source"))


def matches(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """(question_id, source, path): expected sources with the predictions they match by path, compact key or pattern."""
    e = expected.select("question_id", "source", T.normal_path(F.col("source")).alias("en"), T.compact_key(F.col("source")).alias("ek"), is_pattern(F.col("source")).alias("glob"))
    p = predicted.select("question_id", "path", T.normal_path(F.col("path")).alias("pn"), T.compact_key(F.col("path")).alias("pk"))
    plain = e.where(~F.col("glob")).join(p, "question_id").where((F.col("en") == F.col("pn")) | (F.col("ek") == F.col("pk")))
    globs = e.where("glob").withColumn("rx", T.glob_regex(F.col("en"))).join(p, "question_id").where(F.expr("pn RLIKE rx"))
    return plain.select("question_id", "source", "path").unionByName(globs.select("question_id", "source", "path")).distinct()


def metrics(questions: DataFrame, expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row a question: expected_count, matched_count, predicted_count, recall, precision. Nothing expected and nothing predicted is 1."""
    found = matches(expected, predicted)
    e = expected.groupBy("question_id").agg(F.count(F.lit(1)).alias("expected_count"))
    p = predicted.groupBy("question_id").agg(F.count(F.lit(1)).alias("predicted_count"))
    m = found.groupBy("question_id").agg(F.countDistinct("source").alias("matched_count"), F.countDistinct("path").alias("hits"))
    rows = questions.select("question_id").join(e, "question_id", "left").join(p, "question_id", "left").join(m, "question_id", "left").na.fill(0)
    none = F.when(F.col("predicted_count") == 0, 1.0).otherwise(0.0)
    recall = F.when(F.col("expected_count") == 0, none).otherwise(F.try_divide(F.col("matched_count"), F.col("expected_count")))
    precision = F.when(F.col("expected_count") == 0, none).when(F.col("predicted_count") == 0, 0.0).otherwise(F.try_divide(F.col("hits"), F.col("predicted_count")))
    return rows.select("question_id", "expected_count", "matched_count", "predicted_count", recall.alias("recall"), precision.alias("precision"))


def expanded_metrics(questions: DataFrame, expected: DataFrame, predicted: DataFrame, universe: DataFrame) -> DataFrame:
    """``metrics`` over the expanded sources, with the recall of the patterns; questions whose expansion is empty keep the unexpanded ones."""
    full = expand_expected(expected, universe)
    has = full.select("question_id").distinct()
    plain = expected.select("question_id", F.replace("source", F.lit("\\"), F.lit("/")).alias("source"))
    used = full.unionByName(plain.join(has, "question_id", "left_anti"))
    rows = metrics(questions, used, predicted)
    of_patterns = metrics(questions, plain, predicted).select("question_id", F.col("recall").alias("pattern_recall"))
    return rows.join(of_patterns.join(has, "question_id", "left_semi"), "question_id", "left")


def summary(rows: DataFrame) -> DataFrame:
    """Macro averages over the questions that expect sources, rounded to four digits; a missing pattern recall is the recall."""
    scored = rows.where("expected_count > 0")
    return scored.agg(
        F.count(F.lit(1)).alias("n_questions"), F.round(F.avg("recall"), 4).alias("macro_recall"), F.round(F.avg("precision"), 4).alias("macro_precision"),
        F.round(F.avg(F.coalesce("pattern_recall", "recall")), 4).alias("macro_pattern_recall"), F.round(F.avg((F.col("recall") >= 1.0).cast("double")), 4).alias("perfect_recall_rate"))


def diagnostics(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """(question_id, kind, path): expected sources that were missed and predictions that match nothing expected."""
    found = matches(expected, predicted)
    missed = expected.select("question_id", "source").distinct().join(found, ["question_id", "source"], "left_anti").select("question_id", F.lit("missed").alias("kind"), F.col("source").alias("path"))
    wrong = predicted.select("question_id", "path").distinct().join(found, ["question_id", "path"], "left_anti").select("question_id", F.lit("false_positive").alias("kind"), "path")
    return missed.unionByName(wrong)


def separation(scored: DataFrame) -> DataFrame:
    """One row a question of (question_id, score, correct): best correct and best wrong score, and their gap."""
    rows = scored.groupBy("question_id").agg(F.max(F.when(F.col("correct"), F.col("score"))).alias("max_correct"), F.max(F.when(~F.col("correct"), F.col("score"))).alias("max_wrong"))
    return rows.withColumn("gap", F.col("max_correct") - F.col("max_wrong"))


def describe(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """n, min, p10, p25, median, mean, p75, p90, max of a column in groups: a percentile is the value at the place
    (n - 1) p, rounded half to even; the median averages the two middle values; null and NaN values are left out.

    Values are sorted over all groups by range, so that a large group lies in many partitions; a value's place is its
    place in its partition and the number of its group's values in the partitions before.
    """
    rows = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).select(*by, F.col(column).cast("double").alias("x"))
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("min"), F.avg("x").alias("mean"), F.max("x").alias("max"))
    ranges = rows.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("times")).repartitionByRange(shuffle_partitions(df.sparkSession), *by, "x")
    ranges = cut(ranges.withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy(*by, "part").agg(F.sum("times").alias("inside")).withColumn("skipped", F.coalesce(F.sum("inside").over(before), F.lit(0)))
    within = Window.partitionBy(*by, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("earlier", F.coalesce(F.sum("times").over(within), F.lit(0)))
    placed = placed.join(parts.select(*by, "part", "skipped"), [*by, "part"]).join(counts.select(*by, "n"), by)
    placed = placed.withColumn("from", F.col("skipped") + F.col("earlier")).withColumn("to", F.col("from") + F.col("times") - 1)

    def at(p: float) -> Column:
        return F.max(F.when(F.bround((F.col("n") - 1) * F.lit(p), 0).between(F.col("from"), F.col("to")), F.col("x")))

    half = lambda f: F.max(F.when(f((F.col("n") - 1) / 2).between(F.col("from"), F.col("to")), F.col("x")))
    middle = (half(F.floor) + half(F.ceil)) / 2
    stats = placed.groupBy(*by).agg(at(0.1).alias("p10"), at(0.25).alias("p25"), middle.alias("median"), at(0.75).alias("p75"), at(0.9).alias("p90"))
    return counts.join(stats, by).select(*by, "n", "min", "p10", "p25", "median", "mean", "p75", "p90", "max")
