"""Keyword-stuffed and link-list pages, by block-wise compression ratio and sentence punctuation.

A text is cut into blocks of running sentences and blocks of everything else, each of about ``BLOCK`` characters. A
block's compression ratio is set against the median of all blocks of its language, length and layout, in units of
their spread. A block that compresses far better than its like is redundant; outside sentences that is enough
(keyword lists, menus and links have no sentence punctuation); inside sentences, and among rows of table cells, only
extreme redundancy counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebind.storage import cut, written

#: Sentences and the rest are cut alike, so that the medians of a length come mostly from ordinary prose.
BLOCK = 256
#: Deviations below the median from which a block counts: without and with sentence punctuation or rows of cells.
LOOSE, STRICT = -2.5, -6.0
#: A block mainly of figures is data: digits may make up at most this share of its letters and digits.
FIGURES = 0.35
#: Fewest blocks of a language, layout and length for their own median.
FEW = 50

_STOPS, _CLOSERS = ".!?…。！？", "\"”’»)]"
_UNIT = regex.compile(rf"(?:[^\n{_STOPS}]|[{_STOPS}]++(?=[^\s{regex.escape(_CLOSERS)}]))*+(?:[{_STOPS}]+[{regex.escape(_CLOSERS)}]*(?=\s|$)|\n|$)\s*")
_WORD = regex.compile(r"[^\W_]+")


def _is_sentence(unit: str) -> bool | None:
    """Whether a unit is a sentence; None for a stop after too few words to tell."""
    bare = unit.rstrip().rstrip(_CLOSERS)
    if not bare or bare[-1] not in _STOPS:
        return False
    if len(unit) > 300:
        return False
    return True if len(_WORD.findall(unit)) >= 5 else None


def blocks(text: str) -> list[tuple[bool, str]]:
    """(runs as sentences, text) of the blocks; together they are the text."""
    runs: list[tuple[bool, list[str]]] = []
    for match in _UNIT.finditer(text):
        unit = match.group()
        if not unit:
            continue
        kind = _is_sentence(unit)
        if kind is None or not unit.strip():
            kind = runs[-1][0] if runs else False
        if runs and runs[-1][0] == kind:
            runs[-1][1].append(unit)
        else:
            runs.append((kind, [unit]))
    out = []
    for kind, units in runs:
        run = "".join(units)
        parts = max(1, round(len(run) / BLOCK))
        out += [(kind, run[len(run) * k // parts : len(run) * (k + 1) // parts]) for k in range(parts)]
    return out


def _rows_of_cells(block: str) -> bool:
    """Whether most lines of a block have the same number of cell separators."""
    lines = [line for line in block.split("\n") if line.strip()]
    if len(lines) < 3:
        return False
    counts = [line.count("|") + line.count("\t") for line in lines[1:-1]]
    most = max(set(counts), key=counts.count)
    return most > 0 and counts.count(most) * 2 >= len(counts)


def measure(block: str) -> tuple[float, float]:
    """Compression ratio, and digits among letters and digits."""
    raw = block.encode("utf-8", "surrogatepass")
    digits, letters = sum(map(str.isdigit, block)), sum(map(str.isalpha, block))
    return (len(zlib.compress(raw, 6)) - 8) / len(raw), digits / max(1, digits + letters)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        for key, lang, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
            for sentence, block in blocks(text):
                ratio, figures = measure(block)
                for column, x in zip(out, (key, lang, _rows_of_cells(block), int(4 * math.log2(len(block))), len(block), int(round(1000 * ratio)), 2 if figures >= FIGURES else int(sentence))):
                    column.append(x)
        kinds = (batch.schema.field(0).type, pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["k", "lang", "cells", "size", "n", "ratio", "kind"])


def _medians(counts: DataFrame, by: list[str]) -> DataFrame:
    """Median of the binned ratios and their median deviation, by groups of blocks."""
    middle = counts.groupBy(by).agg(F.percentile("ratio", 0.5, F.col("c")).alias("mid"), F.sum("c").alias("blocks"))
    apart = counts.join(middle, by).groupBy(*by, "mid", "blocks").agg(F.percentile(F.abs(F.col("ratio") - F.col("mid")), 0.5, F.col("c")).alias("dev"))
    return apart.withColumn("dev", F.greatest(F.col("dev") * 1.4826, F.lit(20.0)))


def stuffed_share(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Columns (key, share): the share of each text's characters that lies in stuffed blocks.

    Medians and spreads are taken over all blocks of all texts. The language is the first two or three letters of
    ``lang`` in lower case, else ``und``; a group of fewer than ``FEW`` blocks is measured against its length and
    layout in all languages. Null, empty and blank texts and null keys give no row; a repeated row changes nothing;
    a text of any length is measured whole; other columns are ignored.
    """
    code = F.regexp_extract(F.lower(F.coalesce(F.col(lang), F.lit(""))), "^[a-z]{2,3}(?![a-z])", 0)
    rows = df.select(F.col(key).alias("k"), F.when(code == "", "und").otherwise(code).alias("lang"), F.col(text).alias("t"))
    rows = rows.where(F.col("k").isNotNull() & F.col("t").rlike(r"\S"))
    kind = dict(rows.dtypes)["k"]
    measured = written(rows.mapInArrow(_measured, f"k {kind}, lang string, cells boolean, size int, n int, ratio int, kind int"), "blocks")
    counts = cut(measured.groupBy("lang", "cells", "size", "ratio").agg(F.count(F.lit(1)).alias("c")))
    # at most one row for each code of two or three letters, layout and size class: small enough to send to all
    own = _medians(counts, ["lang", "cells", "size"]).where(F.col("blocks") >= FEW).drop("blocks")
    common = _medians(counts.groupBy("cells", "size", "ratio").agg(F.sum("c").alias("c")), ["cells", "size"]).drop("blocks")
    joined = measured.join(F.broadcast(own), ["lang", "cells", "size"], "left").join(
        F.broadcast(common.withColumnsRenamed({"mid": "mid_all", "dev": "dev_all"})), ["cells", "size"])
    apart = (F.col("ratio") - F.coalesce("mid", "mid_all")) / F.coalesce("dev", "dev_all")
    stuffed = (apart < F.when((F.col("kind") == 0) & ~F.col("cells"), LOOSE).otherwise(STRICT)) & (F.col("kind") != 2)
    shares = joined.groupBy("k").agg((F.sum(F.when(stuffed, F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    return shares.select(F.col("k").alias(key), "share")
