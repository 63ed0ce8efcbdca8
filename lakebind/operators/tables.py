"""Profiles of tables: header guess, column names, samples, descriptions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Rows among which the header is sought, and rows of a sample (fixed values).
HEAD, SAMPLES = 20, 5


def stripped(text: Column) -> Column:
    """A text without white space at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def grid(text: Column, delimiter: Column) -> Column:
    """The cells of a preview: rows with any non-empty cell, in order, cells stripped; null has no rows."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    cut = lambda line: F.transform(F.split(line, F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E"))), stripped)
    return filled_rows(F.transform(lines, cut))


def filled_rows(rows: Column) -> Column:
    return F.filter(rows, lambda row: F.exists(row, lambda c: c != ""))


def _filled(row: Column) -> Column:
    return F.filter(row, lambda c: c != "")


def header_index(rows: Column) -> Column:
    """Where the header of a grid is; null if no row among the first ``HEAD`` has two non-empty cells.

    A row has a point for each non-empty cell, one more for each that holds a letter, one if all differ, and one if the
    following row is filled by half at least (two cells at least). The first of the best rows is the header.
    """
    def points(row: Column, k: Column) -> Column:
        own = _filled(row)
        n, following = F.size(own), F.size(_filled(F.coalesce(F.get(rows, k + 1), F.array().cast("array<string>"))))
        lettered = F.size(F.filter(own, lambda c: c.rlike("[A-Za-z_À-ỹ]")))
        total = n + lettered + (F.size(F.array_distinct(own)) == n).cast("int") + (following >= F.greatest(F.lit(2), F.floor(n / 2))).cast("int")
        return F.when(n >= 2, F.struct(total.alias("points"), (-k).alias("before")))

    best = F.array_max(F.filter(F.transform(F.slice(rows, 1, HEAD), points), lambda x: x.isNotNull()))
    return (-best["before"]).cast("int")


def column_names(header: Column) -> Column:
    """Collapsed names; blank ones are ``column_i``, and one that equals a name already given gets its place as suffix."""
    plain = F.transform(header, lambda c, i: F.coalesce(F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit("")), F.concat(F.lit("column_"), (i + 1).cast("string"))))
    placed = lambda done, c: F.when(F.array_contains(done, c), F.concat(c, F.lit("_"), (F.size(done) + 1).cast("string"))).otherwise(c)
    return F.aggregate(plain, F.array().cast("array<string>"), lambda done, c: F.array_append(done, placed(done, c)))


def aligned(row: Column, width: Column) -> Column:
    """A row of exactly ``width`` cells: missing ones are empty, extra ones are dropped."""
    return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda k: F.coalesce(F.get(row, k), F.lit("")))).otherwise(F.array().cast("array<string>"))


def analyzed(df: DataFrame, rows: str) -> DataFrame:
    """``df`` with header_index, columns, first_rows, last_rows, data_rows and metadata_text of its column of grids.

    ``first_rows`` and ``last_rows`` hold up to ``SAMPLES`` rows aligned to the columns. Without a header row the
    columns are generated from the first row's width and all rows are data; an empty grid has no columns. A grid is
    looked at where it lies: no row of it is shuffled.
    """
    g = F.col(rows)
    df = df.withColumn("header_index", header_index(g))
    at = F.col("header_index")
    first = F.coalesce(F.get(g, F.lit(0)), F.array().cast("array<string>"))
    df = df.withColumn("columns", column_names(F.when(at.isNull(), F.transform(first, lambda c: F.lit(""))).otherwise(F.get(g, at))))
    start = F.coalesce(at + 1, F.lit(0))
    df = df.withColumn("data_rows", F.greatest(F.size(g) - start, F.lit(0)).cast("bigint"))
    width = F.size("columns")
    of = lambda a: F.transform(F.slice(g, a, F.lit(SAMPLES)), lambda row: aligned(row, width))
    df = df.withColumn("first_rows", of(start + 1))
    df = df.withColumn("last_rows", of(F.greatest(start, F.size(g) - SAMPLES) + 1))
    return df.withColumn("metadata_text", F.array_join(F.transform(F.slice(g, F.lit(1), F.coalesce(at, F.lit(0))), lambda row: F.array_join(_filled(row), " | ")), "\n"))


def analyze(tables: DataFrame, key: str, text: str, delimiter: Column) -> DataFrame:
    """(key, header_index, columns, first_rows, last_rows, data_rows, metadata_text) of delimited previews."""
    out = analyzed(tables.select(key, grid(F.col(text), delimiter).alias("grid_")), "grid_")
    return out.select(key, "header_index", "columns", "first_rows", "last_rows", "data_rows", "metadata_text")


def row_map(columns: Column, cells: Column) -> Column:
    """A row as a map: missing cells are empty, extra ones are dropped; of columns of one name the last counts."""
    names = F.array_distinct(columns)
    value = lambda name: F.coalesce(F.get(cells, F.size(columns) - F.array_position(F.reverse(columns), name).cast("int")), F.lit(""))
    return F.map_from_arrays(names, F.transform(names, value))


def row_maps(columns: Column, rows: Column) -> Column:
    return F.transform(rows, lambda row: row_map(columns, row))


def sheet_rollup(sheets: DataFrame, key: str, name: str, rows: str) -> DataFrame:
    """(key, columns, sheet_count, sheets, first_rows, last_rows, metadata_text): the sheets of each workbook taken together.

    ``sheets`` has one row a sheet: its workbook, its name and its grid. Columns are the distinct ones in order of sheet
    and place; the sample rows are maps that also name the sheet, the first and last ``SAMPLES`` over all sheets.
    """
    own = analyzed(sheets.select(F.col(key).alias("k_"), F.coalesce(F.nullif(name, F.lit("")), F.lit("Sheet")).alias("s_"), F.col(rows).alias("g_")), "g_")
    tagged = lambda c: F.transform(row_maps(F.col("columns"), F.col(c)), lambda m: F.map_concat(F.map_filter(F.create_map(F.lit("sheet"), F.col("s_")), lambda k, _: ~F.array_contains("columns", k)), m))
    shape = F.struct(F.col("s_").alias("sheet_name"), F.col("columns"), F.size("first_rows").alias("sample_row_count"), F.coalesce("header_index", F.lit(0)).alias("metadata_row_count"), F.size("g_").alias("observed_row_count"))
    note = F.when(F.col("metadata_text") != "", F.concat(F.lit("Sheet "), F.col("s_"), F.lit(": "), F.col("metadata_text")))
    parts = own.select("k_", F.struct("s_", F.col("columns").alias("c"), tagged("first_rows").alias("a"), tagged("last_rows").alias("b"), shape.alias("shape"), note.alias("note")).alias("x"))
    listed = parts.groupBy("k_").agg(F.array_sort(F.collect_list(F.struct(F.col("x.s_").alias("o"), F.col("x.c").alias("c"), F.transform("x.a", lambda m: F.to_json(m)).alias("a"), F.transform("x.b", lambda m: F.to_json(m)).alias("b"), F.col("x.shape").alias("shape"), F.col("x.note").alias("note")))).alias("l"))
    field = lambda f: F.transform("l", lambda x: x[f])
    every = F.flatten(field("b"))
    return listed.select(
        F.col("k_").alias(key), F.array_distinct(F.flatten(field("c"))).alias("columns"), F.size("l").alias("sheet_count"), F.to_json(field("shape")).alias("sheets"),
        F.slice(F.flatten(field("a")), 1, SAMPLES).alias("first_rows"), F.slice(every, F.greatest(F.size(every) - SAMPLES, F.lit(0)) + 1, F.lit(SAMPLES)).alias("last_rows"),
        F.concat_ws("\n", F.filter(field("note"), lambda x: x.isNotNull())).alias("metadata_text"))


def profile(df: DataFrame, key: str, name: str, samples: int = 5) -> DataFrame:
    """(table_name, position, row): the first and last rows of a table by ``key``, as maps of strings, with the row count."""
    columns = df.columns
    as_map = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    total = df.count()
    head = df.orderBy(key).limit(samples).withColumn("position", F.row_number().over(Window.orderBy(key)))
    tail = df.orderBy(F.desc(key)).limit(samples).withColumn("position", F.lit(total + 1) - F.row_number().over(Window.orderBy(F.desc(key))))
    rows = head.unionByName(tail).dropDuplicates(["position"])
    return rows.select(F.lit(name).alias("table_name"), F.lit(len(columns)).cast("bigint").alias("n_columns"), F.lit(total).cast("bigint").alias("n_rows"), F.col("position").cast("bigint").alias("position"), F.to_json(as_map).alias("row_json"))


def json_text(value: Column) -> Column:
    """A string as a JSON literal; null is ``null``."""
    whole = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(whole, F.lit(2), F.char_length(whole) - 2)


def json_rows(rows: Column) -> Column:
    """An array of maps as JSON, indented by two blanks."""
    field = lambda e: F.concat(F.lit("    "), json_text(e["key"]), F.lit(": "), json_text(e["value"]))
    row = lambda m: F.when(F.size(m) == 0, F.lit("  {}")).otherwise(F.concat(F.lit("  {\n"), F.array_join(F.transform(F.map_entries(m), field), ",\n"), F.lit("\n  }")))
    return F.concat(F.lit("[\n"), F.array_join(F.transform(rows, row), ",\n"), F.lit("\n]"))


@F.pandas_udf(StringType())
def sorted_json(texts: pd.Series) -> pd.Series:
    """JSON with its keys in order, blanks after commas and colons; what is no JSON is taken as a string; nothing gives null."""
    def one(text: str | None) -> str | None:
        try:
            value = json.loads(text or "{}")
        except ValueError:
            value = text
        return json.dumps(value, ensure_ascii=False, sort_keys=True) if value else None

    return texts.map(one)


def description(path: Column, extension: Column, parser: Column, metadata: Column, columns: Column, sample: Column, tail: Column, shape: Column) -> Column:
    """The labelled blocks of a table description; ``sample`` and ``tail`` are arrays of maps, ``shape`` is JSON."""
    metadata, empty = stripped(F.coalesce(metadata, F.lit(""))), F.array().cast("array<map<string,string>>")
    sample, tail = F.coalesce(sample, empty), F.coalesce(tail, empty)
    first, last = json_rows(sample), json_rows(tail)
    return F.concat_ws(
        "\n\n", F.concat(F.lit("Source table: "), path), F.concat(F.lit("File type: "), F.coalesce(F.nullif(F.ltrim(F.regexp_replace(extension, r"^\.", "")), F.lit("")), F.lit("table"))), F.concat(F.lit("Parser: "), parser),
        F.when(metadata != "", F.concat(F.lit("Metadata or explanation text before/around the table:\n"), F.substring(metadata, 1, 2500))),
        F.when(F.size(F.coalesce(columns, F.array().cast("array<string>"))) > 0, F.concat(F.lit("Column names: "), F.array_join(F.slice(columns, 1, 80), ", "))),
        F.when(F.size(sample) > 0, F.concat(F.lit("First sample rows:\n"), F.substring(first, 1, 5000))),
        F.when((F.size(tail) > 0) & (last != first), F.concat(F.lit("Last sample rows:\n"), F.substring(last, 1, 5000))),
        F.concat(F.lit("Observed table shape/profile: "), F.substring(sorted_json(shape), 1, 2500)))


def sql_names(text: Column) -> tuple[Column, Column]:
    """Sorted distinct names of tables and of typed columns in an SQL script."""
    tables = F.regexp_extract_all(text, F.lit(r"(?i)\b(?:CREATE\s+TABLE|FROM|JOIN|INTO|UPDATE)\s+[`\"\[]?([A-Za-z_][\w.]*)"), F.lit(1))
    columns = F.regexp_extract_all(text, F.lit(r"(?i)\b([A-Za-z_]\w*)\s+(?:INTEGER|INT|REAL|TEXT|VARCHAR|DATE|FLOAT|DOUBLE|BOOLEAN|NUMERIC)\b"), F.lit(1))
    return F.array_sort(F.array_distinct(tables)), F.array_sort(F.array_distinct(columns))
