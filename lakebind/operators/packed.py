"""Splitting fields that hold several delimited values, by the delimiter skeleton of the field.

A field is tokenised into single structural characters and runs of ordinary ones, blanks between those included. Its
skeleton is the tokens with every run masked: names of one, two or more words look alike. Fields of one skeleton split the same way, so the rule (which tokens make up each value, and how its
escapes are resolved) is worked out once per distinct skeleton and applied by token position, inside the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebind.storage import written

DELIMITERS = ",;|\t\n\r"
#: Opening quotes and the marks that close them.
QUOTES = {'"': '"', "'": "'", "“": "”", "«": "»", "`": "`"}
BLANKS = " \u00a0\u3000"
STRUCTURE = DELIMITERS + "".join(sorted(set("".join(QUOTES) + "".join(QUOTES.values())))) + BLANKS + "[]\\"
MASK = "a"
_CLASS = "".join("\\" + c if c in "[]\\\"'" else c for c in STRUCTURE)
ORDINARY = f"[^{_CLASS}]+(?:[{BLANKS}]+[^{_CLASS}]+)*+"
TOKEN = f"[{_CLASS}]|{ORDINARY}"
#: Ways of resolving escapes: none, doubled quotes, JSON, and the repr of a list of strings.
PLAIN, DOUBLED, JSON, REPR = 0, 1, 2, 3


def _closing(tokens: list[str], at: int, close: str, end: int, escapes: bool, doubled: bool) -> int | None:
    """The place of the mark that closes the quote opened at ``at``, if any before ``end``."""
    k = at + 1
    while k < end:
        if escapes and tokens[k] == "\\":
            k += 2
            continue
        if tokens[k] == close:
            if doubled and k + 1 < end and tokens[k + 1] == close:
                k += 2
                continue
            return k
        k += 1
    return None


def _blank(tokens: list[str], a: int, b: int) -> tuple[int, int]:
    while a < b and tokens[a] in BLANKS + DELIMITERS and tokens[a].isspace():
        a += 1
    while b > a and tokens[b - 1] in BLANKS + DELIMITERS and tokens[b - 1].isspace():
        b -= 1
    return a, b


def _list_rule(tokens: list[str], a: int, b: int) -> list[tuple[int, int, int]] | None:
    """The values of a bracketed list of quoted strings, or None if the tokens are something else."""
    out, k, marks = [], a + 1, set()
    expect_value = True
    while True:
        k, _ = _blank(tokens, k, b - 1)
        if k >= b - 1:
            break
        if expect_value:
            if tokens[k] not in "\"'":
                return None
            close = _closing(tokens, k, tokens[k], b - 1, escapes=True, doubled=False)
            if close is None:
                return None
            marks.add(tokens[k])
            out.append((k + 1, close))
            k = close + 1
        elif tokens[k] == ",":
            k += 1
        else:
            return None
        expect_value = not expect_value
    mode = JSON if marks <= {'"'} else REPR
    return [(x, y, mode if "\\" in tokens[x:y] else PLAIN) for x, y in out]


def resolve(skeleton: str) -> list[tuple[int, int, int]]:
    """The rule of a skeleton: (first token, end token, way of resolving escapes) of each value that is not empty."""
    tokens = list(skeleton)
    a, b = _blank(tokens, 0, len(tokens))
    if b - a >= 2 and tokens[a] == "[" and tokens[b - 1] == "]":
        found = _list_rule(tokens, a, b)
        if found is not None:
            return [(x, y, mode) for x, y, mode in ((*_blank(tokens, x, y), mode) for x, y, mode in found) if x < y]
    out: list[tuple[int, int, int]] = []
    k = a
    while k < b:
        while k < b and tokens[k] in BLANKS:
            k += 1
        if k >= b:
            break
        if tokens[k] in DELIMITERS:
            k += 1
            continue
        stop = None
        if tokens[k] in QUOTES:
            close = _closing(tokens, k, QUOTES[tokens[k]], b, escapes=False, doubled=QUOTES[tokens[k]] == tokens[k])
            after = close + 1 if close is not None else b
            while after < b and tokens[after] in BLANKS:
                after += 1
            if close is not None and (after >= b or tokens[after] in DELIMITERS):
                inner, mark = (k + 1, close), tokens[k]
                trimmed = _blank(tokens, *inner)
                if trimmed[0] < trimmed[1]:
                    out.append((*trimmed, DOUBLED if mark in tokens[inner[0] : inner[1]] else PLAIN))
                stop = after
        if stop is None:
            stop = k
            while stop < b and tokens[stop] not in DELIMITERS:
                stop += 1
            trimmed = _blank(tokens, k, stop)
            if trimmed[0] < trimmed[1]:
                out.append((*trimmed, PLAIN))
        k = stop + 1
    return out


def tokens_of(column: Column) -> Column:
    return F.regexp_extract_all(column, F.lit(TOKEN), F.lit(0))


def skeleton_of(column: Column) -> Column:
    return F.regexp_replace(column, ORDINARY, MASK)


def _resolve_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("a", pa.int32()), ("n", pa.int32()), ("mode", pa.int32())]))
    for batch in batches:
        rules = [[{"a": a + 1, "n": b - a, "mode": mode} for a, b, mode in resolve(s)] for s in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rules, kind)], names=["skeleton", "rule"])


def split_packed(df: DataFrame, key: str, field: str, least: int = 2, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """Columns (key, position_no, value): one row per value of each field that holds at least ``least`` values.

    Values are separated by commas, semicolons, bars, tabs or line breaks, in any mixture, with or without quotes
    around single values (a doubled quote inside stands for one), or the field is a JSON list or the repr of a list of
    strings, whose escapes are resolved. Values are trimmed; empty ones are dropped; repeated ones stay; positions
    count the rest from 1. A quote that opens a value and is not closed before a delimiter is an ordinary character.
    Null, empty and blank fields and null keys give no row; repeated rows of ``df`` count once; other columns are
    ignored. The rules are broadcast if all skeletons together are below ``broadcast_bytes``, else joined by shuffle,
    where AQE splits the partition of a skeleton that very many rows share.
    """
    rows = df.select(F.col(key).alias("k"), F.col(field).alias("f")).where(F.col("k").isNotNull() & F.col("f").rlike(f"[^{_CLASS}]"))
    rows = rows.distinct().withColumn("skeleton", skeleton_of(F.col("f")))
    skeletons = rows.select("skeleton").distinct()
    rules = written(skeletons.mapInArrow(_resolve_batches, "skeleton string, rule array<struct<a:int,n:int,mode:int>>"), "rules")
    weight = rules.agg(F.coalesce(F.sum(F.octet_length("skeleton") + 16 * F.size("rule")), F.lit(0))).first()[0]
    rules = rules.where(F.size("rule") >= least)
    joined = rows.join(F.broadcast(rules) if weight <= broadcast_bytes else rules, "skeleton")

    def value(part: Column, tokens: Column) -> Column:
        raw = F.array_join(F.slice(tokens, part["a"], part["n"]), "")
        text = F.concat(F.lit('["'), raw, F.lit('"]'))
        decoded = F.get(F.from_json(text, "array<string>"), F.lit(0))
        spoken = F.regexp_replace(raw, r"\\(['\"\\])", "$1")
        first = F.get(tokens, part["a"] - 2)
        return F.trim(
            F.when(part["mode"] == JSON, F.coalesce(decoded, raw)).when(part["mode"] == REPR, spoken)
            .when(part["mode"] == DOUBLED, F.replace(raw, F.concat(first, first), first)).otherwise(raw))

    with_tokens = joined.withColumn("tokens", tokens_of(F.col("f")))
    values = with_tokens.select("k", F.transform("rule", lambda part: value(part, F.col("tokens"))).alias("v"))
    values = values.withColumn("v", F.filter("v", lambda x: x != "")).where(F.size("v") >= least)
    out = values.select("k", F.posexplode("v").alias("p", "value"))
    return out.select(F.col("k").alias(key), (F.col("p") + 1).cast("bigint").alias("position_no"), "value")
