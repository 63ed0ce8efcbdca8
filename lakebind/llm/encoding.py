"""Encoding a corpus with a public tokenizer, reusing the ids of chunks that documents share.

Every text is cut into content-defined chunks: a rolling hash of the characters before a position decides whether it
is a cut, so the same passage is cut alike in every document. Documents are brought together by the smallest digest of
their chunks, which copies and near copies share; a task encodes each distinct chunk once. Where chunks meet at a
place the splitting pattern never crosses, their ids are simply joined; at any other place the ids around the join are
replaced by a fresh encoding, between the nearest such places on both sides, so that the result is exactly that of
encoding the text at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebind.llm.tokens import BYTE_BPE_50K, byte_bpe, encode

WINDOW = 16
#: One in so many safe positions is a cut; in a run of ``LONG`` characters without any, one in ``RARE`` of the others.
EVERY, LONG, RARE = 40, 4096, 1024
#: Bytes of ids that a task keeps for reuse before it starts afresh.
KEPT = 64 << 20
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(WINDOW)]
_MIX = np.uint64(0xD6E8FEB86659FD93)


def safe_positions(codes: np.ndarray) -> np.ndarray:
    """Where a space or line break follows a visible ASCII character: no pre-token of the pattern crosses these."""
    before, at = codes[:-1], codes[1:]
    return np.flatnonzero(((at == 32) | (at == 10)) & (before > 32) & (before < 127)) + 1


def rolling_hash(codes: np.ndarray) -> np.ndarray:
    """For every position, a hash of the up to ``WINDOW`` characters before it."""
    wide = codes.astype(np.uint64)
    out = np.zeros(len(wide) + 1, dtype=np.uint64)
    for back in range(1, min(WINDOW, len(wide)) + 1):
        out[back:] += wide[: len(wide) - back + 1] * _POWERS[back - 1]
    out ^= out >> np.uint64(32)
    return (out * _MIX) >> np.uint64(33)


def cuts(texts: list[str]) -> list[np.ndarray]:
    """For each text, the ascending positions at which it is cut; the first ``WINDOW`` characters hold none."""
    raw = [text.encode("utf-32-le", "surrogatepass") for text in texts]
    codes = np.frombuffer(b"".join(raw), dtype=np.uint32)
    ends = np.cumsum([len(x) // 4 for x in raw])
    starts = ends - [len(x) // 4 for x in raw]
    hashes, safe = rolling_hash(codes), safe_positions(codes)
    found = safe[hashes[safe] % EVERY == 0]
    owner = np.searchsorted(ends, found, side="right")
    found = found[found - starts[owner] >= WINDOW] if len(found) else found
    edges = np.unique(np.concatenate((starts, ends, found)))
    for k in np.flatnonzero(np.diff(edges) > LONG):
        inside = np.arange(edges[k] + WINDOW, edges[k + 1])
        found = np.concatenate((found, inside[hashes[inside] % RARE == 0]))
    found = np.unique(found)
    first, last = np.searchsorted(found, starts, side="right"), np.searchsorted(found, ends, side="left")
    return [(found[a:b] - start).astype(np.int32) for a, b, start in zip(first, last, starts)]


def join_exactly(coder, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
    """The ids of ``left + right`` from those of both: whatever lies between the nearest safe places is encoded anew."""

    def codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    places = safe_positions(codes(left))
    start = int(places[-1]) if len(places) else 0
    both = codes(left[start:] + right)
    places = safe_positions(both)
    places = places[places > len(left) - start]
    end = int(places[0]) - (len(left) - start) if len(places) else len(right)
    lengths = coder_lengths(coder)
    keep_left = np.searchsorted(np.cumsum(lengths[left_ids]), len(left[:start].encode()), side="right")
    drop_right = np.searchsorted(np.cumsum(lengths[right_ids]), len(right[:end].encode()), side="right")
    if lengths[left_ids[:keep_left]].sum() != len(left[:start].encode()) or lengths[right_ids[:drop_right]].sum() != len(right[:end].encode()):
        return encode(coder, left + right)
    return np.concatenate((left_ids[:keep_left], encode(coder, left[start:] + right[:end]), right_ids[drop_right:]))


_LENGTHS: dict[int, np.ndarray] = {}


def coder_lengths(coder) -> np.ndarray:
    """Bytes of every token."""
    if id(coder) not in _LENGTHS:
        _LENGTHS[id(coder)] = np.array([len(t) for t in sorted_tokens(coder)], dtype=np.int64)
    return _LENGTHS[id(coder)]


def sorted_tokens(coder) -> list[bytes]:
    return [coder.decode_single_token_bytes(k) for k in range(coder.max_token_value + 1)]


def encode_chunks(coder, text: str, places: list[int], known: Callable[[str], np.ndarray]) -> np.ndarray:
    """The ids of ``text``, cut at ``places``, of whose chunks ``known`` gives the ids."""
    edges = [0, *places, len(text)]
    parts: list[np.ndarray] = []
    ids, held = np.empty(0, dtype=np.int32), ""
    for a, b in zip(edges, edges[1:]):
        chunk = text[a:b]
        now = known(chunk)
        if not held:
            ids, held = now, chunk
        elif chunk[:1] in (" ", "\n") and "!" <= held[-1] <= "~":
            parts.append(ids)
            ids, held = now, chunk
        else:
            ids, held = join_exactly(coder, held, ids, chunk, now), held + chunk
    parts.append(ids)
    return np.concatenate(parts) if len(parts) > 1 else ids


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_cuts, sketches = [], []
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for text, places in zip(texts, cuts(texts)):
            edges = [0, *places.tolist(), len(text)]
            digests = (int.from_bytes(blake2b(text[a:b].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for a, b in zip(edges, edges[1:])) if text else ()
            all_cuts.append(places)
            sketches.append(min(digests, default=0))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(all_cuts, pa.list_(pa.int32())), pa.array(sketches, pa.int64())], names=["k", "t", "cuts", "sketch"])


def encode_corpus(df: DataFrame, key: str, text: str, path: str = BYTE_BPE_50K) -> DataFrame:
    """Columns (key, ids): the token ids of each text as ``array<int>``, without special tokens.

    Null and empty texts have an empty list. One row comes out for every row of ``df``, repeated ones too; strings of
    special tokens are ordinary text; other columns are ignored. A smallest digest that very many documents share
    (a third of the corpus may be copies) is spread by the rebalancing shuffle, and each part encodes the chunk once.
    """
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = dict(rows.dtypes)["k"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path)
        ids_of: dict[bytes, np.ndarray] = {}
        held = 0

        def known(chunk: str) -> np.ndarray:
            nonlocal held
            name = blake2b(chunk.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            ids = ids_of.get(name)
            if ids is None:
                ids = encode(coder, chunk)
                held += ids.nbytes + 150
                if held > KEPT:
                    ids_of.clear()
                    held = ids.nbytes + 150
                ids_of[name] = ids
            return ids

        for batch in batches:
            lists = [encode_chunks(coder, t, places, known) if t else np.empty(0, dtype=np.int32) for t, places in zip(batch.column("t").to_pylist(), batch.column("cuts").to_pylist())]
            offsets = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            flat = np.concatenate(lists) if lists else np.empty(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))], names=["k", "ids"])

    sketched = rows.mapInArrow(_sketched, f"k {kind}, t string, cuts array<int>, sketch bigint")
    gathered = sketched.hint("rebalance", "sketch").select("k", "t", "cuts")
    return gathered.mapInArrow(encoded, f"k {kind}, ids array<int>").withColumnRenamed("k", key)
