"""Near copies: all pairs of texts whose sets of word runs have at least a given likeness, without comparing all pairs.

1. Every text gets the hashes of its runs of consecutive words. A sketch of fixed size, summed over all texts, tells
   about how often each occurs; it serves the order of runs only, so that its errors cost time and no pair.
2. Two texts of likeness t or more share one of the first n - ceil(t n) + 1 of their n runs in any common order. The
   order is rare runs first; those are sent, packed by bucket of their hash, with the text's parity bitmap.
3. Within a bucket, texts that share a run are compared if their sizes and the run's places allow the likeness. Their
   bitmaps, wider for longer texts, are compared bit-sliced: the XOR of 64 pairs per word stands in vertical bit planes,
   carry-save adders count all distances at once, and blocks of 64 pairs are abandoned when all exceed the radius. As the
   distance of parity bitmaps never exceeds the number of runs in which two texts differ, no pair is lost; a wider bitmap
   folds onto a narrower one by XOR of its parts.
4. The pairs that are left are compared by their full sets of runs.

Equal texts form one class, compared once. Nothing is sampled or capped. Runs are told apart by hashes: of 64 bits in the
search, where two equal ones only add a candidate, and of 48 bits when sets are compared, where two different runs of a
pair of texts of 1,000 runs each are taken for one once in some 10^8 pairs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebind.storage import cut, shuffle_partitions, written

#: Bits of the bitmap of a text of up to so many runs: about 1.6 for each, so that the distances of unlike texts show.
WIDTHS = ((160, 256), (640, 1024), (2560, 4096))
WIDEST = 16384
#: Postings that one bucket should hold on average.
IN_BUCKET = 2_000_000
#: Slots of the sketch of counts, as a power of two. Its size never grows.
COUNTS = 20
#: Texts with one run from which its block is spread over a grid of buckets.
HOT = 2000
_BLOCK = 1 << 16
_WORD = re.compile(r"[^\W_]+")


class _Words(dict):
    """Hashes of words, kept for reuse."""

    def __missing__(self, word: str) -> int:
        if len(self) > 2_000_000:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return value


def runs_of(texts: list[str], words: dict[str, int], run: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct runs of ``run`` words, ordered by both; texts of fewer than ``least`` words have none."""
    found, lengths = [], np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        own = _WORD.findall(text.lower())
        if len(own) >= max(least, run):
            found += own
            lengths[k] = len(own)
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    ids = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    owner = np.repeat(np.arange(len(texts)), lengths)
    mixed = np.zeros(len(ids) - run + 1, dtype=np.uint64)
    for k in range(run):
        mixed = (mixed ^ ids[k : k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    owner, last = owner[: len(mixed)], owner[run - 1 :]
    mixed, owner = mixed[owner == last], owner[owner == last]
    order = np.lexsort((mixed, owner))
    mixed, owner = mixed[order], owner[order]
    new = np.ones(len(mixed), dtype=bool)
    new[1:] = (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], mixed[new]


def needed(total: np.ndarray, likeness: float) -> np.ndarray:
    """Fewest shared runs of two texts with ``total`` runs together."""
    return np.ceil(total * likeness / (1 + likeness) - 1e-9).astype(np.int64)


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: the sums and carries of three planes."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _planes(bits: np.ndarray) -> np.ndarray:
    """Rows of bits (0 or 1, a multiple of 64 rows) as one plane of 64-bit words for each bit."""
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")).view(np.uint64)


def _exceeds(counters: list[np.ndarray], limits: np.ndarray) -> np.ndarray:
    """Lanes whose vertical count is above their limit."""
    more = np.zeros_like(limits[0])
    same = ~more
    for k in reversed(range(len(limits))):
        digit = counters[k] if k < len(counters) else np.zeros_like(more)
        more |= same & digit & ~limits[k]
        same &= ~(digit ^ limits[k])
    return more


def widths_of(sizes: np.ndarray) -> np.ndarray:
    """Bits of the bitmaps of texts with so many runs."""
    out = np.full(len(sizes), WIDEST, dtype=np.int64)
    for most, bits in reversed(WIDTHS):
        out[sizes <= most] = bits
    return out


def bitmaps_of(owner: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The parity bitmap of each text: bit k tells whether an odd number of its hashes end in k."""
    widths = widths_of(sizes)
    starts = np.concatenate(([0], np.cumsum(widths)))
    at = starts[owner] + ((hashes >> np.uint64(17)) & (widths[owner] - 1).astype(np.uint64)).astype(np.int64)
    parity = np.bincount(at, minlength=starts[-1]).astype(np.uint8) & 1
    packed = np.packbits(parity).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(starts, starts[1:])]


def folded(raw: bytes, sizes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of each text or -1, rows): the bitmaps of at least ``bits`` bits among those of ``raw``, folded to that width."""
    widths = widths_of(sizes)
    starts = np.concatenate(([0], np.cumsum(widths // 8)))
    row, rows = np.full(len(sizes), -1, dtype=np.int64), []
    flat, count = np.frombuffer(raw, dtype=np.uint8), 0
    for width in np.unique(widths[widths >= bits]):
        own = np.flatnonzero(widths == width)
        block = flat[starts[own][:, None] + np.arange(width // 8)]
        rows.append(np.bitwise_xor.reduce(block.reshape(len(own), width // bits, bits // 8), axis=1))
        row[own] = count + np.arange(len(own))
        count += len(own)
    return row, np.concatenate(rows) if rows else np.empty((0, bits // 8), dtype=np.uint8)


def within(left: np.ndarray, right: np.ndarray, radius: np.ndarray, slab: int = 1 << 14) -> np.ndarray:
    """Which pairs of packed bitmaps (rows of bytes) differ in at most ``radius`` bits, counted bit-sliced."""
    out = np.zeros(len(left), dtype=bool)
    bits_ = 8 * left.shape[1]
    digits, slab = bits_.bit_length(), max(64, slab * 256 // bits_)
    for start in range(0, len(left), slab):
        apart = left[start : start + slab] ^ right[start : start + slab]
        lanes = len(apart)
        padded = -(-lanes // 64) * 64
        bits = np.zeros((padded, bits_), dtype=np.uint8)
        bits[:lanes] = np.unpackbits(apart, axis=1)
        planes = _planes(bits)
        most = np.zeros(padded, dtype=np.int64)
        most[:lanes] = np.minimum(radius[start : start + slab], bits_)
        limits = _planes(((most[:, None] >> np.arange(digits)) & 1).astype(np.uint8))
        words = np.arange(planes.shape[1])
        counters = [np.zeros(len(words), dtype=np.uint64) for _ in range(digits)]
        for group in range(0, bits_, 32):
            for k in range(group, group + 32, 2):
                counters[0], carry = _add(counters[0], planes[k], planes[k + 1])
                for d in range(1, digits):
                    counters[d], carry = counters[d] ^ carry, counters[d] & carry
                    if not carry.any():
                        break
            alive = ~_exceeds(counters, limits) != 0
            if not alive.all():
                words, planes, limits = words[alive], planes[:, alive], limits[:, alive]
                counters = [c[alive] for c in counters]
            if not len(words):
                break
        near = np.zeros(padded // 64, dtype=np.uint64)
        if len(words):
            near[words] = ~_exceeds(counters, limits)
        out[start : start + lanes] = np.unpackbits(near.view(np.uint8), bitorder="little")[:lanes].astype(bool)
    return out


def _class_of(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _fresh(texts: list[str | None], seen: set[bytes]) -> tuple[list[bytes], list[str]]:
    """The texts of a batch that the task has not met yet, and their classes."""
    classes, new = [], []
    for text in texts:
        if text:
            name = _class_of(text)
            if name not in seen:
                seen.add(name)
                classes.append(name)
                new.append(text)
    return classes, new


def _first_pass(run: int, least: int):
    """Members (key and class of each text long enough) and, at the end of a task, its sketches by block."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        counts = np.zeros(1 << COUNTS, dtype=np.uint32)
        long_enough: dict[bytes, bool] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            classes, new = _fresh(texts, seen)
            owner, hashes = runs_of(new, words, run, least)
            some = set(owner.tolist())
            long_enough.update((c, k in some) for k, c in enumerate(classes))
            counts += np.bincount((hashes & np.uint64((1 << COUNTS) - 1)).astype(np.int64), minlength=1 << COUNTS).astype(np.uint32)
            names = [_class_of(t) if t else None for t in texts]
            kept = [(k, n) for k, n in zip(keys, names) if n is not None and long_enough[n]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in kept], kind), pa.array([n for _, n in kept], pa.binary()), pa.nulls(len(kept), pa.int32()), pa.nulls(len(kept), pa.binary())],
                names=["k", "class", "block", "payload"])
        if kind is None:
            return
        blocks = [(b, zlib.compress(part.tobytes(), 1)) for b, part in enumerate(counts.reshape(-1, _BLOCK)) if part.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(blocks), kind), pa.nulls(len(blocks), pa.binary()), pa.array([b for b, _ in blocks], pa.int32()), pa.array([p for _, p in blocks], pa.binary())],
            names=["k", "class", "block", "payload"])

    return emit


def _merge(table: pa.Table) -> pa.Table:
    """One block of the sketch from those of several tasks."""
    parts = [zlib.decompress(p) for p in table.column("payload").to_pylist()]
    total = reduce(lambda a, b: a + np.frombuffer(b, dtype=np.uint32).astype(np.uint64), parts, np.zeros(_BLOCK, dtype=np.uint64))
    merged = np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes()
    return pa.table({"block": table.column("block")[:1].combine_chunks(), "payload": pa.array([zlib.compress(merged, 1)], pa.binary())})


def _sketch(first: DataFrame) -> np.ndarray:
    """The counts from all tasks: 4 MB whatever the input. Those of very many tasks are merged in two steps."""
    blocks = first.where(F.col("block").isNotNull()).select("block", "payload")
    shape = "block int, payload binary"
    if len(first.inputFiles()) > 64:
        blocks = blocks.withColumn("part", F.spark_partition_id() % 64).groupBy("block", "part").applyInArrow(_merge, shape)
    counts = np.zeros(1 << COUNTS, dtype=np.uint32)
    for row in blocks.groupBy("block").applyInArrow(_merge, shape).toLocalIterator():
        counts[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = np.frombuffer(zlib.decompress(row["payload"]), dtype=np.uint32)
    return counts


def _planar(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits by byte planes, whose many zeros the shuffle compresses away."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _packed(hashes: np.ndarray) -> bytes:
    """The lower 48 bits of hashes: two runs of a pair of texts are taken for one once in some billion pairs."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return np.unique(wide.view("<u8").ravel())


def _postings(sketch, buckets: int, likeness: float, run: int, least: int):
    """Packed rows by bucket: the class, size, bitmap and leading runs of each text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        noise = int(2 * np.median(counts))
        words, seen = _Words(), set()
        for batch in batches:
            classes, new = _fresh(batch.column(0).to_pylist(), seen)
            owner, hashes = runs_of(new, words, run, least)
            if not len(owner):
                continue
            sizes = np.bincount(owner, minlength=len(new))
            bitmaps = bitmaps_of(owner, hashes, sizes)
            often = counts[(hashes & np.uint64((1 << COUNTS) - 1)).astype(np.int64)].astype(np.int64)
            order = np.lexsort((hashes, often, owner))
            owner, hashes, often = owner[order], hashes[order], often[order]
            place = np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]
            prefix = sizes - np.ceil(likeness * sizes - 1e-9).astype(np.int64) + 1
            sent = place < prefix[owner]
            owner, hashes, place, often = owner[sent], hashes[sent], place[sent], np.maximum(often[sent] - noise, 0)
            token, bucket = (hashes >> np.uint64(32)).astype(np.uint32), ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
            hot = np.flatnonzero(often > HOT)
            if len(hot):
                side = -(-often[hot] // HOT)
                stripe = np.array([int.from_bytes(classes[o][:4], "little") for o in owner[hot]], dtype=np.int64) % side
                each = np.repeat(np.arange(len(hot)), side)
                other = np.arange(len(each)) - np.repeat(np.cumsum(side) - side, side)
                low, high = np.minimum(stripe[each], other).astype(np.uint64), np.maximum(stripe[each], other).astype(np.uint64)
                mixed = (hashes[hot][each] + low * np.uint64(0x9E3779B97F4A7C15) + high * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)
                cold = np.ones(len(owner), dtype=bool)
                cold[hot] = False
                token = np.concatenate((token[cold], (mixed >> np.uint64(32)).astype(np.uint32)))
                bucket = np.concatenate((bucket[cold], ((mixed & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)))
                owner, place = np.concatenate((owner[cold], owner[hot][each])), np.concatenate((place[cold], place[hot][each]))
            order = np.lexsort((owner, bucket))
            owner, token, place, bucket = owner[order], token[order], place[order], bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1))
            names = np.frombuffer(b"".join(classes), dtype=np.uint8).reshape(-1, 16)
            out: list[list] = [[] for _ in range(7)]
            for a, b in zip(edges, np.append(edges[1:], len(bucket))):
                texts, times = np.unique(owner[a:b], return_counts=True)
                for column, x in zip(out, (int(bucket[a]), names[texts].tobytes(), _planar(sizes[texts]), b"".join(bitmaps[t] for t in texts.tolist()), _planar(times), token[a:b].tobytes(), _planar(place[a:b]))):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], names=["bucket", "classes", "sizes", "bitmaps", "times", "tokens", "places"])

    return emit


def _compare(likeness: float):
    """Pairs of classes of one bucket that may have the likeness."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        for bucket in sorted({row["bucket"] for row in rows}):
            own = [row for row in rows if row["bucket"] == bucket]
            join = lambda name, kind: np.frombuffer(b"".join(row[name] for row in own), dtype=kind)  # noqa: B023, E731
            numbers = lambda name: np.concatenate([_numbers(row[name]) for row in own])  # noqa: B023, E731
            names, sizes = join("classes", np.uint8).reshape(-1, 16), numbers("sizes")
            bitmaps = b"".join(row["bitmaps"] for row in own)
            text, token, place = np.repeat(np.arange(len(names)), numbers("times")), join("tokens", np.uint32), numbers("places")
            _, first, same = np.unique(names.view("V16").ravel(), return_index=True, return_inverse=True)
            text = first[same.ravel()][text]  # copies from other tasks are one text
            order = np.lexsort((place, text, token))
            text, token, place = text[order], token[order], place[order]
            once = np.ones(len(text), dtype=bool)
            once[1:] = (text[1:] != text[:-1]) | (token[1:] != token[:-1])
            text, token, place = text[once], token[once], place[once]
            found, far = [], 1
            live = np.arange(len(token))
            while True:
                live = live[live + far < len(token)]
                live = live[token[live] == token[live + far]]
                if not len(live):
                    break
                a, b = text[live], text[live + far]
                total = sizes[a] + sizes[b]
                share = needed(total, likeness)
                possible = np.minimum(sizes[a], sizes[b]) >= likeness * np.maximum(sizes[a], sizes[b]) - 1e-9
                possible &= np.minimum(sizes[a] - place[live], sizes[b] - place[live + far]) >= share
                found.append(a[possible] * len(names) + b[possible])
                far += 1
            pairs = np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.int64)
            a, b = pairs // len(names), pairs % len(names)
            total = sizes[a] + sizes[b]
            near, widths = np.zeros(len(a), dtype=bool), widths_of(sizes)
            common = np.minimum(widths[a], widths[b])
            for bits in np.unique(common):
                these = np.flatnonzero(common == bits)
                row, rows_ = folded(bitmaps, sizes, int(bits))
                near[these] = within(rows_[row[a[these]]], rows_[row[b[these]]], (total - 2 * needed(total, likeness))[these])
            a, b = a[near], b[near]
            ordered = [(x, y) if x < y else (y, x) for x, y in ((names[i].tobytes(), names[j].tobytes()) for i, j in zip(a, b))]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in ordered], pa.binary()), pa.array([y for _, y in ordered], pa.binary())], names=["a", "b"])

    return emit


def _bits_of(classes: DataFrame, bits: int = 24) -> np.ndarray:
    """A fixed-size filter of class names: no false negatives."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                flags[int.from_bytes(name[:4], "little") >> (32 - bits)] = True
        out = [(b, zlib.compress(np.packbits(part).tobytes(), 1)) for b, part in enumerate(flags.reshape(-1, _BLOCK)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([p for _, p in out], pa.binary())], names=["block", "payload"])

    def merge(table: pa.Table) -> pa.Table:
        both = reduce(np.bitwise_or, [np.frombuffer(zlib.decompress(p), dtype=np.uint8) for p in table.column("payload").to_pylist()])
        return pa.table({"block": table.column("block")[:1].combine_chunks(), "payload": pa.array([zlib.compress(both.tobytes(), 1)], pa.binary())})

    shape = "block int, payload binary"
    merged = classes.mapInArrow(blocks, shape).withColumn("part", F.spark_partition_id() % 64).groupBy("block", "part").applyInArrow(merge, shape)
    flags = np.zeros((1 << bits) // 8, dtype=np.uint8)
    step = _BLOCK // 8
    for row in merged.groupBy("block").applyInArrow(merge, shape).toLocalIterator():
        flags[row["block"] * step : (row["block"] + 1) * step] = np.frombuffer(zlib.decompress(row["payload"]), dtype=np.uint8)
    return np.unpackbits(flags).astype(bool)


def near_copies(df: DataFrame, key: str, text: str, likeness: float = 0.8, run: int = 5, least: int = 5) -> tuple[DataFrame, DataFrame]:
    """(members, links): members (key, class) and links (a, b, likeness) between classes a < b of different texts.

    A class holds the keys with one and the same text. Words are the maximal runs of letters and digits of the
    lower-cased text; the likeness of two texts is the share of distinct runs of ``run`` words they have in common
    among those of either. Texts that are null or have fewer than ``least`` words (or than ``run``) belong to no class.
    Every link of at least ``likeness`` is found. Repeated rows count once, a key may have several texts, other columns
    are ignored, and an empty table gives empty results.
    """
    if not 0 < likeness <= 1 or run < 1:
        raise ValueError("the likeness must be above 0 and at most 1, the run at least 1")
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("k").isNotNull() & F.col("t").isNotNull())
    kind = dict(rows.dtypes)["k"]
    first = written(rows.mapInArrow(_first_pass(run, least), f"k {kind}, class binary, block int, payload binary"), "first")
    members = first.where(F.col("class").isNotNull()).select("k", "class").distinct()
    counts = _sketch(first)
    buckets = max(shuffle_partitions(spark), int(counts.sum() * (1 - likeness)) // IN_BUCKET)
    sketch = spark.sparkContext.broadcast(counts)
    shape = "bucket int, classes binary, sizes binary, bitmaps binary, times binary, tokens binary, places binary"
    postings = rows.select("t").mapInArrow(_postings(sketch, buckets, likeness, run, least), shape)
    maybe = postings.repartitionById(buckets, F.col("bucket")).mapInArrow(_compare(likeness), "a binary, b binary")
    pairs = written(maybe.distinct(), "pairs")

    flags = spark.sparkContext.broadcast(_bits_of(pairs.select(F.explode(F.array("a", "b")).alias("class"))))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, words, seen = flags.value, _Words(), set()
        for batch in batches:
            classes, new = _fresh(batch.column(0).to_pylist(), seen)
            kept = [(c, t) for c, t in zip(classes, new) if wanted[int.from_bytes(c[:4], "little") >> 8]]
            owner, hashes = runs_of([t for _, t in kept], words, run, least)
            edges = np.searchsorted(owner, np.arange(len(kept) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in kept], pa.binary()), pa.array([_packed(hashes[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())], names=["class", "runs"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = _unpacked(x), _unpacked(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                shares.append(both / (len(x) + len(y) - both))
            kept = pa.array(np.array(shares, dtype=np.float64) >= likeness - 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shares, pa.float64())], names=["a", "b", "likeness"]).filter(kept)

    runs = written(rows.select("t").mapInArrow(sets, "class binary, runs binary").dropDuplicates(["class"]), "runs")
    both = pairs.join(runs.select(F.col("class").alias("a"), F.col("runs").alias("x")), "a").join(runs.select(F.col("class").alias("b"), F.col("runs").alias("y")), "b")
    links = written(both.select("a", "b", "x", "y").mapInArrow(verify, "a binary, b binary, likeness double"), "links")
    return members.withColumnRenamed("k", key), links


def alike_pairs(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Columns (key_a, key_b), key_a < key_b: all pairs of keys whose texts are equal or linked."""
    left, right = (members.select(F.col(key).alias(f"{key}_{s}"), F.col("class").alias(s)) for s in ("a", "b"))
    copies = members.groupBy("class").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("class").alias("a"), F.col("class").alias("b"))
    pairs = copies.unionByName(links.select("a", "b")).join(left, "a").join(right, "b")
    a, b = F.col(f"{key}_a"), F.col(f"{key}_b")
    pairs = pairs.where((a != b) & ((F.col("a") != F.col("b")) | (a < b)))
    return pairs.select(F.least(a, b).alias(f"{key}_a"), F.greatest(a, b).alias(f"{key}_b")).distinct()


def groups(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Columns (key, group_id, n_links): the connected group of every member, and its number of links to other texts.

    Labels spread by alternately linking every class to the smallest neighbour (large star, small star), on tables
    cut by checkpoints, until nothing changes; no component is gathered in one place.
    """
    edges = cut(links.select("a", "b"))
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").union(lowest.select("u", "m")).distinct()
        following = cut(small.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).select("a", "b").distinct())
        changed = following.exceptAll(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).limit(1).count()
        edges = following
        if not changed:
            break
    roots = edges.groupBy(F.col("b").alias("class")).agg(F.min("a").alias("root"))
    counts = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    out = members.join(roots, "class", "left").join(counts, "class", "left")
    return out.select(key, F.lower(F.hex(F.coalesce("root", "class"))).alias("group_id"), F.coalesce("n", F.lit(0)).alias("n_links"))
