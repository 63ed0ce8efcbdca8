"""Filling containers of fixed capacity, by local best fit and a tree of merges of underfull containers.

Round one packs the items of every partition by best fit, largest first. Containers that are nearly full are closed;
the others go on as items of the next round, in a quarter of the partitions, until one partition can hold all that is
open, or a round closes and merges next to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebind.llm.tokens import BYTE_BPE_50K, byte_bpe
from lakebind.storage import cut, shuffle_partitions

#: Share of the capacity from which a container is closed.
NEARLY = 0.995
#: Most items or open containers that one task takes.
IN_TASK = 200_000


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, in the order given: the fullest one that still takes it, else a new one."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, count = 0, 0
    out = np.empty(len(sizes), dtype=np.int64)
    for k, size in enumerate(sizes.tolist()):
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            chosen = room[free].pop()
            if not room[free]:
                some &= ~(1 << free)
        else:
            free, chosen, count = capacity, count, count + 1
        out[k] = chosen
        left = free - size
        room[left].append(chosen)
        some |= 1 << left
    return out


def count_tokens(df: DataFrame, key: str, text: str, path: str = BYTE_BPE_50K) -> DataFrame:
    """Columns (key, n_tokens); null and empty texts have none."""
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path)
        for batch in batches:
            counts = [len(coder.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["k", "n"])

    out = rows.mapInArrow(counted, f"k {dict(rows.dtypes)['k']}, n bigint")
    return out.select(F.col("k").alias(key), F.col("n").alias("n_tokens"))


def pack(df: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """Columns (key, piece_no, piece_size, container): where each item goes.

    Only an item larger than ``capacity`` is divided: into pieces of exactly the capacity, which fill a container
    each, and the rest, which is packed like any other item; ``piece_no`` counts from 1. No container holds more than
    the capacity. Items of size 0 go into containers like the others. Rows with a null key or a null or negative size
    are left out; of rows with the same key the largest size counts; other columns are ignored; an empty table gives
    an empty result. Container numbers are unique, not consecutive, and the same in every run on the same partitions.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    spark = df.sparkSession
    items = df.select(F.col(key).alias("k"), F.col(size).cast("bigint").alias("s")).where(F.col("k").isNotNull() & (F.col("s") >= 0))
    items = cut(items.groupBy("k").agg(F.max("s").alias("s")))
    whole = F.when(F.col("s") > capacity, F.floor((F.col("s") - 1) / capacity)).otherwise(F.lit(0)).cast("int")
    full = items.where(F.col("s") > capacity).withColumn("piece_no", F.explode(F.sequence(F.lit(1), whole)))
    full = full.select("k", "piece_no", F.lit(capacity).cast("bigint").alias("piece_size"), F.xxhash64("k", "piece_no").alias("h"))
    rest = items.select("k", (whole + 1).alias("piece_no"), (F.col("s") - whole * F.lit(capacity)).alias("piece_size"))

    def packed(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = [b for b in batches if b.num_rows]
            if not got:
                return
            table = pa.Table.from_batches(got).sort_by([("size", "descending"), ("name", "ascending")])
            sizes = table.column("size").to_numpy()
            where = best_fit(sizes, capacity)
            filled = np.bincount(where, weights=sizes).astype(np.int64)
            base = (level << 56) | (TaskContext.get().partitionId() << 32)
            columns = [table.column("name").combine_chunks(), pa.array(base + where), pa.array(filled[where])]
            yield from pa.Table.from_arrays(columns, names=["name", "container", "filled"]).to_batches(max_chunksize=50_000)

        return run

    # an item's name is its key and piece; a container that goes on is named by its number
    kind = dict(items.dtypes)["k"]
    parts = max(shuffle_partitions(spark), -(-items.count() // IN_TASK))
    level, opened = 1, rest.select(F.col("k").alias("name"), F.col("piece_size").alias("size"))
    placed = cut(opened.repartition(parts, "name").mapInArrow(packed(1), f"name {kind}, container bigint, filled bigint"))
    where = placed
    chain = []
    before = None
    while level < 100:
        under = placed.where(F.col("filled") < NEARLY * capacity).select(F.col("container").alias("name"), F.col("filled").alias("size")).distinct()
        left = under.count()
        if left < 2 or (parts == 1 and level > 1) or (before is not None and parts <= -(-left // IN_TASK) and left > 0.995 * before):
            break
        before, level = left, level + 1
        parts = max(-(-left // IN_TASK), parts // 4, 1)
        spread = under.repartition(parts, F.xxhash64("name", F.lit(level)))
        placed = cut(spread.mapInArrow(packed(level), "name bigint, container bigint, filled bigint"))
        chain.append(placed.select(F.col("name").alias("container"), F.col("container").alias("merged")))
    final = where.select(F.col("name").alias("k"), "container")
    for step in chain:
        final = final.join(step, "container", "left").select("k", F.coalesce("merged", "container").alias("container"))
    out = rest.join(final, "k").select("k", "piece_no", "piece_size", "container")
    filled = full.select("k", "piece_no", "piece_size", (F.col("h").bitwiseAND(F.lit((1 << 62) - 1)) - F.lit(1 << 62)).alias("container"))
    return out.unionByName(filled).withColumnRenamed("k", key)
