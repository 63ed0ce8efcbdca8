"""Cutting oversized texts at natural boundaries, by dynamic programming over the boundary positions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a cut costs after each kind of pause; a cut inside a word costs most.
PAUSES = (
    (0.0, regex.compile(r"\n[^\S\n]*\n\s*")),
    (0.15, regex.compile(r"\n\s*")),
    (0.3, regex.compile(r"[.!?…。！？]+[\"'”’»)\]]*\s+")),
    (0.7, regex.compile(r"[;:,]\s+|\s+[–—-]\s+|\s\|\s")),
    (1.2, regex.compile(r"\s+")),
)
INSIDE = 4.0
BALANCE = 2.0


def boundaries(text: str, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a piece may end, ascending and without the end of the text, and what a cut there costs.

    Where no pause lies within an eighth of ``step``, positions inside the run are added, away from combining marks
    if possible, so that every stretch of ``step`` characters holds a position.
    """
    cost: dict[int, float] = {}
    for penalty, pattern in PAUSES:
        for match in pattern.finditer(text):
            cost.setdefault(match.end(), penalty)
    cost.pop(len(text), None)
    cost.pop(0, None)
    stride = max(1, step // 8)
    natural = [0, *sorted(cost), len(text)]
    for left, right in zip(natural, natural[1:]):
        for at in range(left + stride, right, stride):
            back = at
            while back > left + 1 and back > at - stride // 2 and (unicodedata.combining(text[back]) or text[back] in "‍️"):
                back -= 1
            cost.setdefault(back, INSIDE)
    where = np.array(sorted(cost), dtype=np.int64)
    return where, np.array([cost[p] for p in where.tolist()], dtype=np.float64)


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``text``: at most ``limit`` characters, each starting ``overlap`` before the last one's end."""
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and below the limit")
    length, step = len(text), limit - overlap
    if length <= limit:
        return [(0, length)]
    where, penalty = boundaries(text, step)
    where, penalty = np.append(where, length), np.append(penalty, 0.0)
    ideal = (length - overlap) / -(-(length - overlap) // step)
    count = len(where)
    best = np.full(count, np.inf)
    came = np.full(count, -1, dtype=np.int64)
    balance = BALANCE / step**2
    opening = int(np.searchsorted(where, limit, side="right"))
    best[:opening] = penalty[:opening] + balance * (where[:opening] - overlap - ideal) ** 2
    usable = int(np.searchsorted(where, overlap, side="right"))  # a piece must start after the last one's start
    lows = np.maximum(np.searchsorted(where, where - step), usable).tolist()
    shifted = where + ideal
    for k, (at, low) in enumerate(zip(where.tolist(), lows)):
        if low < k:
            apart = at - shifted[low:k]
            total = best[low:k] + balance * apart * apart
            chosen = int(total.argmin())
            if total[chosen] + penalty[k] < best[k]:
                best[k], came[k] = total[chosen] + penalty[k], low + chosen
    ends, k = [], len(where) - 1
    while k >= 0:
        ends.append(int(where[k]))
        k = int(came[k])
    ends.reverse()
    return [(0 if not j else ends[j - 1] - overlap, end) for j, end in enumerate(ends)]


def split_oversized(df: DataFrame, key: str, text: str, limit: str, overlap: str) -> DataFrame:
    """Columns (key, piece_no, start_char, end_char, piece): the pieces of every text longer than its limit.

    Lengths and positions are in code points; ``piece_no`` counts from 1. Consecutive pieces share exactly
    ``overlap`` characters, the pieces cover the text, and none is longer than the limit. Rows whose text is null or
    not longer than the limit, or whose key or limit is null, have no piece; a null overlap is 0; an overlap that is
    negative or not below the limit raises ValueError. Repeated rows are cut once. Other columns are ignored.
    """
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(limit).cast("int").alias("l"), F.coalesce(F.col(overlap).cast("int"), F.lit(0)).alias("o"))
    rows = rows.where(F.col("k").isNotNull() & (F.char_length("t") > F.col("l"))).dropDuplicates(["k", "t", "l", "o"])

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, t, most, shared in zip(*(batch.column(c).to_pylist() for c in ("k", "t", "l", "o"))):
                out += [(k, n, a, b, t[a:b]) for n, (a, b) in enumerate(pieces(t, most, shared), 1)]
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (batch.schema.field("k").type, pa.int32(), pa.int32(), pa.int32(), pa.string()))],
                names=["k", "piece_no", "start_char", "end_char", "piece"])

    kind = dict(rows.dtypes)["k"]
    out = rows.mapInArrow(cut_batches, f"k {kind}, piece_no int, start_char int, end_char int, piece string")
    return out.withColumnRenamed("k", key)
