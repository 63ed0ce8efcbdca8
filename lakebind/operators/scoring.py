"""Counts of asked tokens and scores of chunks, made in tasks.

A text is read once and leaves its task as the counts of the tokens that questions ask for, which are written as a small
table. Scores are then added up in tasks over blocks of that table. A task has a group of the questions and goes through all
blocks, so that it ranks chunks and sources itself, and what leaves the tasks grows with the questions and not with the blocks as well.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebind.functions import text as T
from lakebind.storage import AGAIN, cut, written

#: Chunks of a block, words that a task remembers, and rows of a batch that it returns, at most.
BLOCK, KNOWN, GIVEN = 1 << 16, 500_000, 1 << 16
#: Questions of a group, as long as there are no more than so many groups (or the cores), and tasks of a group, at least, where questions
#: are fewer than cores; each group reads the counts once.
TOGETHER, GROUPS, SHARING = 1 << 15, 64, 2
#: Questions whose vectors meet a block at once.
ABREAST = 64
#: Chunks of which a task holds id and source before it leaves out those that are no longer needed.
HELD = 1 << 21
#: Scores this far below the last one that counts may be equal to it when rounded to nine digits.
NEAR = 2e-9

_FIND, _MARKED, _MARKS = re.compile(T.TOKEN).findall, re.compile(f"[a-z]{T.MARKS}+"), re.compile(f"{T.MARKS}+")
_FOLDED, _STOP = str.maketrans(T.ACCENTED, T.PLAIN), frozenset(T.STOPWORDS)


class Codes(dict):
    """The tokens of pieces of lowered texts as they are met: as codes, 1 for what nobody asks for and from 2 the given ones, or as words if none are given.

    No token and no fold reaches over a blank, so pieces between blanks are looked at once and remembered."""

    def __init__(self, given: list[str] | None = None):
        super().__init__()
        self.given = None if given is None else {word: code for code, word in enumerate(given, 2)}
        self.triggers = {self.given[w]: w for w in T.TRIGGERS if w in self.given} if self.given else {}

    def __missing__(self, piece: str) -> tuple:
        if len(self) >= KNOWN:
            self.clear()
        tokens = [word for word in words(piece) if is_token(word)]
        out = self[piece] = tuple(tokens if self.given is None else [self.given.get(word, 1) for word in tokens])
        return out

    def counts(self, lowered: str) -> Counter:
        return Counter(chain.from_iterable(map(self.__getitem__, lowered.split(" "))))


def is_token(word: str) -> bool:
    return (len(word) > 1 or word >= "一") and word not in _STOP


def words(lowered: str) -> list[str]:
    """``text.token_like`` of a text that ``text.lowered`` has lowered."""
    if lowered.isascii():
        return _FIND(lowered) * 2
    return _FIND(_MARKED.sub(" ", lowered)) + _FIND(_MARKS.sub("", lowered).translate(_FOLDED))


def synonyms(have: set[str]) -> set[str]:
    """``text.synonyms`` of a set of tokens."""
    return {word for groups, added in T.SYNONYMS if any(have.issuperset(group) for group in groups) for word in added}


def tally(lowered: str, codes: Codes) -> tuple[int, dict[int, int]]:
    """(number of tokens, count by code from 2) of a lowered text, with the tokens that the rules of synonyms add."""
    counts = codes.counts(lowered)
    length = sum(counts.values())
    counts.pop(1, None)
    have = counts.keys() & codes.triggers.keys()
    if have:
        for word in (added := synonyms({codes.triggers[c] for c in have})):
            if (code := codes.given.get(word)) is not None:
                counts[code] += 1
        length += len(added)
    return length, counts


def question_tokens(questions: DataFrame) -> DataFrame:
    """(question_id, token, qtf) of the rows of question_id and lowered text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            own = [_tokens(text or "", codes) for text in batch.column(1).to_pylist()]
            place = np.repeat(np.arange(len(own)), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place)), pa.array([t for x in own for t in x], pa.string()), pa.array([n for x in own for n in x.values()], pa.int64())], names=["question_id", "token", "qtf"])

    return questions.mapInArrow(count, f"question_id {questions.dtypes[0][1]}, token string, qtf bigint")


def coded(tokens: list[str]) -> list[str]:
    """The tokens to be counted, in order of their codes from 2."""
    return sorted({*tokens, *T.TRIGGERS})


def counted(corpus: DataFrame, texts: list[Column], given: list[str], embed: tuple[Column, Callable] | None = None) -> tuple[DataFrame, DataFrame, bool]:
    """(rows, documents, whether no chunk_id is repeated): of every row its chunk_id, source_path and source_kind; and of every chunk the number of
    tokens, dl0, and codes and counts of the given ones, ids0 and tfs0, for each text. Rows of one chunk_id are one document.
    With ``embed``, a text and what makes a list of vectors of a list of texts, rows also have a vector."""
    shared = corpus.sparkSession.sparkContext.broadcast(given)
    fields, make = range(len(texts)), embed and embed[1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(shared.value)
        for batch in batches:
            columns = list(batch.columns[:3])
            for k in fields:
                tallies = [tally(text, codes) for text in batch.column(3 + k).to_pylist()]
                columns += _lists([t[0] for t in tallies], [t[1] for t in tallies])
            if make:
                columns.append(pa.array(make(batch.column(3 + len(fields)).to_pylist()), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "vector"] if make else names)

    names = ["chunk_id", "source_path", "source_kind", *(f"{c}{k}" for k in fields for c in ("dl", "ids", "tfs"))]
    kind = ", ".join(f"dl{k} bigint, ids{k} array<int>, tfs{k} array<int>" for k in fields)
    key = dict(corpus.dtypes)["chunk_id"]
    lowered = corpus.select("chunk_id", "source_path", "source_kind", *[T.lowered(text).alias(f"t{k}") for k, text in enumerate(texts)], *([embed[0].alias("embedded")] if embed else []))
    rows = written(lowered.mapInArrow(count, f"chunk_id {key}, source_path string, source_kind string, {kind}" + ", vector array<double>" * bool(embed)), "counts")
    documents = rows.drop("source_path", "source_kind", "vector")
    repeated = cut(rows.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("chunk_id").alias("again")))
    some = repeated.count()
    if not some:
        return rows, documents, True
    if some <= AGAIN:
        repeated = F.broadcast(repeated)
    same = F.col("chunk_id").eqNullSafe(F.col("again"))
    sums = [c for k in fields for c in (F.sum(f"dl{k}").alias(f"dl{k}"), F.flatten(F.collect_list(f"ids{k}")).alias(f"ids{k}"), F.flatten(F.collect_list(f"tfs{k}")).alias(f"tfs{k}"))]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0)]
            for k in fields:
                merged = []
                for ids, tfs in zip(batch.column(2 + 3 * k).to_pylist(), batch.column(3 + 3 * k).to_pylist()):
                    merged.append(Counter())
                    for code, n in zip(ids, tfs):
                        merged[-1][code] += n
                columns += _lists(batch.column(1 + 3 * k), merged)
            yield pa.RecordBatch.from_arrays(columns, names=["chunk_id", *names[3:]])

    joined = documents.join(repeated, same, "left_semi").groupBy("chunk_id").agg(*sums).mapInArrow(merge, f"chunk_id {key}, {kind}")
    merged = documents.join(repeated, same, "left_anti").unionByName(written(joined, "counts"))
    return rows, merged if some <= AGAIN else written(merged, "counts"), False


def _lists(lengths: list[int] | pa.Array, counts: list[dict[int, int]]) -> list[pa.Array]:
    offsets = pa.array(np.cumsum([0, *map(len, counts)]), pa.int32())
    flat = lambda values: pa.ListArray.from_arrays(offsets, pa.array(np.fromiter(values, np.int32)))
    return [pa.array(lengths, pa.int64()), flat(c for x in counts for c in x), flat(n for x in counts for n in x.values())]


def frequencies(documents: DataFrame, k: int) -> tuple[int, float, dict[int, int]]:
    """(number of documents, their mean number of tokens, documents by code) of text ``k``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n, length = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            own = np.bincount(batch.column(1).flatten().to_numpy(), minlength=len(found))
            own[: len(found)] += found
            found, n, length = own, n + len(batch), length + int(batch.column(0).to_numpy().sum())
        codes = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *codes], pa.int32()), pa.array([length, n, *found[codes]], pa.int64())], names=["code", "n"])

    got = {r["code"]: r["n"] for r in documents.select(f"dl{k}", f"ids{k}").mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()}
    length, n = got.pop(-2, 0), got.pop(-1, 0)
    return n, length / n if n else 0.0, got


def blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batches put together to blocks of ``most`` rows or so."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(map(len, kept)) >= most:
            yield pa.concat_batches(kept)
            kept = []
    if kept:
        yield pa.concat_batches(kept)


def inverted(ids: pa.ListArray, tfs: pa.ListArray, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(starts, rows, counts): those of code c are from starts[c] to starts[c + 1]."""
    codes = ids.flatten().to_numpy()
    if most < (1 << 16) - 1:  # such are sorted by radix
        codes = np.minimum(codes, (1 << 16) - 1).astype(np.uint16)
    rows = np.repeat(np.arange(len(ids)), np.diff(ids.offsets.to_numpy()))
    order = np.argsort(codes, kind="stable")
    starts = np.searchsorted(codes[order], np.arange(most + 2)).tolist()
    return starts, rows[order], tfs.flatten().to_numpy()[order].astype(np.float64)


def leading(scores: np.ndarray, best: int, name) -> np.ndarray:
    """The places of all scores that can be among the ``best`` when rounded to nine digits; of equal ones the first by name."""
    if len(scores) <= best:
        return np.arange(len(scores))
    kept = np.flatnonzero(scores >= np.partition(scores, -best)[-best] - NEAR)
    if len(kept) <= best + 16:
        return kept
    out = []
    values, group = np.unique(scores[kept], return_inverse=True)
    for g, n in enumerate(np.bincount(group, minlength=len(values))):
        own = kept[group == g] if n > best else None
        if own is not None:
            out.append(np.array(sorted(own.tolist(), key=name)[:best]))
    large = np.bincount(group, minlength=len(values)) > best
    return np.concatenate([kept[~large[group]], *out]).astype(np.int64)


class Asked:
    """Questions with the codes and counts of their tokens, as arrays. Tokens of a question are in order of how many questions have
    them and questions in order of these lists, so that neighbours share sums: ``alike`` is the number of first items that a
    question shares with the next. An item is a token with its count in a question."""

    def __init__(self, names: pa.Array, places: np.ndarray, codes: np.ndarray, counts: np.ndarray):
        pairs, item, uses = np.unique(np.stack([codes, counts]), axis=1, return_inverse=True, return_counts=True)
        by_use = np.argsort(-uses, kind="stable")
        order = np.empty(len(by_use), np.int64)
        order[by_use] = np.arange(len(by_use))
        self.codes, self.counts = pairs[0][by_use], pairs[1][by_use]
        item = order[item.reshape(-1)]
        sorted_ = np.lexsort((item, places))
        item, bounds = item[sorted_], np.searchsorted(places[sorted_], np.arange(len(names) + 1))
        own = [item[bounds[q] : bounds[q + 1]].tolist() for q in range(len(names))]
        listed = sorted(range(len(names)), key=own.__getitem__)
        self.names = names.take(pa.array(listed, pa.int64()))
        self.starts = np.cumsum([0, *(len(own[q]) for q in listed)])
        self.items = np.fromiter(chain.from_iterable(own[q] for q in listed), np.int32)
        self.alike = [next((n for n, (x, y) in enumerate(zip(own[a], own[b])) if x != y), min(len(own[a]), len(own[b]))) for a, b in zip(listed, listed[1:])] + [0]

    def __len__(self) -> int:
        return len(self.names)


def groups_of(questions: int, cores: int) -> int:
    """The number of groups of questions; where it is that of the cores or more, one task has a group and goes through all chunks."""
    return max(1, min(questions, max(GROUPS, cores), cores * -(-questions // (TOGETHER * cores))))


def _valued(block: pa.RecordBatch, at: int, averages: list[float], most: int, k1: float, b: float) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
    """(starts, rows, parts) of the texts of a block by code, whose columns begin at ``at``."""
    fields = []
    for k, average in enumerate(averages):
        starts, rows, tf = inverted(block.column(at + 1 + 3 * k), block.column(at + 2 + 3 * k), most)
        dl = block.column(at + 3 * k).to_numpy().astype(np.float64)
        fields.append((starts, rows, tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[rows] / average)) if len(rows) else tf))
    return fields


def _totals(fields: list, weights: list[list[float]], codes: list[int], questions: "Asked", of: range, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(question, scores of the rows of a block); the sums that neighbours share are added up once. The scores hold until the next ones."""
    buffers, kept = [np.zeros(size)], [0]

    def above(items: list[int]) -> np.ndarray:
        """The topmost sums with those of the items, in the next buffer."""
        if len(buffers) == len(kept):
            buffers.append(np.empty(size))
        total = buffers[len(kept)]
        np.copyto(total, buffers[len(kept) - 1])
        for item in items:
            code = codes[item]
            for (starts, rows, part), by in zip(fields, weights):
                if (first := starts[code]) < (last := starts[code + 1]) and by[item]:
                    total[rows[first:last]] += by[item] * part[first:last]
        return total

    for q in of:
        own = questions.items[questions.starts[q] : questions.starts[q + 1]].tolist()
        while kept[-1] > (questions.alike[q - 1] if q > of.start else 0):
            kept.pop()
        if (common := questions.alike[q]) > kept[-1]:
            above(own[kept[-1] : common])
            kept.append(common)
        yield q, above(own[kept[-1] :]) if len(own) > kept[-1] else buffers[len(kept) - 1]


def all_scores(documents: DataFrame, texts: list[int], questions: Asked, weights: list[np.ndarray], averages: list[float], k1: float, b: float, shape: str) -> DataFrame:
    """(question_id, chunk_id, score) by BM25 of all chunks that share a token, added up over the ``texts`` by number; ``weights`` are by text and item."""
    most, size_of_block = int(questions.codes.max(initial=1)), BLOCK
    shared = documents.sparkSession.sparkContext.broadcast((questions, weights))

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, by = shared.value
        by, codes = [w.tolist() for w in by], asked.codes.tolist()
        for block in blocks(batches, size_of_block):
            ids, given, size = block.column(0), [], 0
            for q, total in _totals(_valued(block, 1, averages, most, k1, b), by, codes, asked, range(len(asked)), len(block)):
                found = np.flatnonzero(total)
                if len(found):
                    given.append((q, found, total[found]))
                    size += len(found)
                if size >= GIVEN:
                    yield named(asked.names, ids, given)
                    given, size = [], 0
            if given:
                yield named(asked.names, ids, given)

    columns = ["chunk_id", *(f"{c}{k}" for k in texts for c in ("dl", "ids", "tfs"))]
    return documents.where("chunk_id IS NOT NULL").select(*columns).mapInArrow(every, shape)


class _Best:
    """The best chunks of each question of a group, as blocks go by: ``best`` and those that may be equal to the last of them."""

    def __init__(self, best: int, least: float):
        self.best, self.least, self.kept, self.floors = best, least, {}, {}

    def floor(self, q: int, total: np.ndarray, near: float = NEAR) -> float:
        """What a score is at least if it counts; what is best of some is a bound for all."""
        if (floor := self.floors.get(q)) is None:
            floor = self.least if len(total) <= 64 * self.best else max(self.least, np.partition(total[: 32 * self.best], -self.best)[-self.best] - near)
        return floor

    def add(self, q: int, found: np.ndarray, scores: np.ndarray, base: int, name) -> None:
        if not len(found):
            return
        places = found + base
        if (known := self.kept.get(q)) is not None:
            scores, places = np.concatenate([known[0], scores]), np.concatenate([known[1], places])
        if len(scores) > self.best:
            lead = leading(scores, self.best, lambda row: name(places[row]))
            scores, places = scores[lead], places[lead]
            self.floors[q] = max(self.least, np.partition(scores, -self.best)[-self.best] - NEAR)
        self.kept[q] = scores, places


#: Further than this, a cosine of single precision isn't from that of double precision.
SINGLE = 1e-5


def _multiplied(lists: pa.ListArray, asked: np.ndarray, of: range, leader: _Best, base: int, name) -> None:
    """Cosines of the vectors of a block with those of a group of questions: all in single precision, those that may count in double."""
    rows = lists.flatten().to_numpy().reshape(len(lists), asked.shape[1])
    unit = lambda x: np.divide(x, (n := np.linalg.norm(x, axis=1))[:, None], out=np.zeros_like(x), where=n[:, None] > 0)
    rows = unit(rows)
    single = np.ascontiguousarray(rows.T, np.float32)
    for start in range(of.start, of.stop, ABREAST):
        some = unit(asked[start : min(start + ABREAST, of.stop)])
        for q, (own, total) in enumerate(zip(some, some.astype(np.float32) @ single), start):
            found = np.flatnonzero(total >= np.float32(leader.floor(q, total, SINGLE) - SINGLE))
            leader.add(q, found, rows[found] @ own, base, name)


def best_hits(rows: DataFrame, texts: list[int], questions: Asked, searches: list[list[np.ndarray]], averages: list[float], k1: float, b: float, shape: str, best: int, given: list[str], then: Callable | None = None, vectors: tuple[np.ndarray, int] | None = None) -> DataFrame:
    """The ``best`` chunks by BM25 of every question and search with their rank, in order: columns ``given`` of question_id, list, score, rank and those of ``rows``.

    ``searches`` are weights by text and item; ``list`` is the number of the search; ``then`` makes other rows of these in the same task.
    ``vectors``, of the questions in their order, and a number of best chunks are one more search, by the cosine with the vector of a row. A task has a group of the questions and goes through
    all chunks; where questions are fewer than cores, so many tasks share the chunks, at least ``SHARING``, and ranks are those within a task."""
    context, size_of_block, most = rows.sparkSession.sparkContext, BLOCK, int(questions.codes.max(initial=1))
    own = ["chunk_id", *(c for c in given if c in ("source_path", "source_kind"))]
    groups = groups_of(len(questions), context.defaultParallelism)
    bounds = [len(questions) * g // groups for g in range(groups + 1)]
    shared = context.broadcast((questions, searches, vectors))

    def first(group: int):
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, by, embedded = shared.value
            by, codes = [[w.tolist() for w in search] for search in by], asked.codes.tolist()
            found, of = [_Best(best, np.finfo(np.float64).tiny) for _ in by], range(bounds[group], bounds[group + 1])
            if embedded:
                found.append(_Best(embedded[1], -np.inf))
            met, base = [], 0
            for block in blocks(batches, size_of_block):
                about = block.select(own)
                met.append(about)
                fields = _valued(block, len(own), averages, most, k1, b)
                ends = np.cumsum([0, *map(len, met)])
                name = lambda place: met[(k := int(np.searchsorted(ends, place, "right")) - 1)].column(0)[int(place - ends[k])].as_py()  # noqa: B023, E731
                for leader, weights in zip(found, by):
                    for q, total in _totals(fields, weights, codes, asked, of, len(block)):
                        places = np.flatnonzero(total >= leader.floor(q, total))
                        leader.add(q, places, total[places], base, name)
                if embedded:
                    _multiplied(block.column("vector"), embedded[0], of, found[-1], base, name)
                base += len(block)
                if base > HELD:
                    met, base = _compact(met, found)
            ranked = _ranked(met, found, asked.names, given)
            yield from then(ranked) if then else ranked

        return score

    rows = rows.where("chunk_id IS NOT NULL").select(*own, *(f"{c}{k}" for k in texts for c in ("dl", "ids", "tfs")), *["vector"] * bool(vectors))
    if groups < context.defaultParallelism:
        parts = [rows.coalesce(max(SHARING, -(-context.defaultParallelism // groups))).mapInArrow(first(g), shape) for g in range(groups)]
    else:
        # of nothing but single partitions, a union would be one again
        none = rows.sparkSession.range(0, 2, 1, 2).mapInArrow(lambda batches: iter(()), shape)
        parts = [none, *(rows.coalesce(1).mapInArrow(first(g), shape) for g in range(groups))]
    return functools.reduce(DataFrame.union, parts)


def _compact(met: list[pa.RecordBatch], found: list[_Best]) -> tuple[list[pa.RecordBatch], int]:
    """What is known of chunks, without those that are no longer among the best of any question."""
    used = np.unique(np.concatenate([np.zeros(0, np.int64), *(places for leader in found for _, places in leader.kept.values())]))
    for leader in found:
        leader.kept = {q: (scores, np.searchsorted(used, places)) for q, (scores, places) in leader.kept.items()}
    return [pa.Table.from_batches(met).take(pa.array(used)).combine_chunks().to_batches()[0]] if len(used) else [], len(used)


def _ranked(met: list[pa.RecordBatch], found: list[_Best], names: pa.Array, given: list[str]) -> Iterator[pa.RecordBatch]:
    if not met:
        return
    about = pa.concat_batches(met)
    by_name = np.empty(len(about), np.int64)
    by_name[pc.sort_indices(about.column(0)).to_numpy()] = np.arange(len(about))
    listed = sorted((q, n) for n, leader in enumerate(found) for q in leader.kept)
    for start in range(0, len(listed), step := max(1, GIVEN // max(leader.best for leader in found))):
        some = listed[start : start + step]
        kept = [found[n].kept[q] for q, n in some]
        of = np.repeat(np.arange(len(some)), [len(scores) for scores, _ in kept])
        scores, places = np.concatenate([x for x, _ in kept]), np.concatenate([x for _, x in kept])
        order = np.lexsort((by_name[places], -np.round(scores, 9), of))
        rank = np.arange(len(of)) - np.searchsorted(of, of) + 1
        within = rank <= np.array([found[n].best for _, n in some])[of]
        of, rank, order = of[within], rank[within], order[within]
        places, at = pa.array(places[order]), np.array(some)
        columns = {"question_id": lambda: names.take(pa.array(at[of, 0])), "list": lambda: pa.array(at[of, 1], pa.int32()), "score": lambda: pa.array(scores[order]), "rank": lambda: pa.array(rank, pa.int32())}  # noqa: B023
        batch = pa.RecordBatch.from_arrays([columns[c]() if c in columns else about.column(c).take(places) for c in given], names=given)
        yield batch.filter(pc.not_equal(pc.fill_null(batch.column("source_path"), ""), "")) if "source_path" in given else batch


def _by_question(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches put together to blocks of ``GIVEN`` rows or so with all rows of a question in one, where these follow one another."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(map(len, kept)) >= GIVEN:
            block = pa.concat_batches(kept)
            last = int(_starts(block.column("question_id"))[-1])
            kept = [block.slice(last)]
            if last:
                yield block.slice(0, last)
    if kept and sum(map(len, kept)):
        yield pa.concat_batches(kept)


def _numbered(order: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The numbers from 1 of the places ``order``, anew for each value of ``of``, by which they are in order."""
    ordered = of[order]
    return np.arange(len(order)) - np.searchsorted(ordered, ordered) + 1


def source_ranks(kinds: dict[str, str], weight: float, following: int, best: int, shown: int = 0, fused: tuple[int, int] | None = None, by_vectors: bool = False) -> tuple[str, Callable]:
    """(shape, function for ``then``): the ``best`` sources of the ranked chunks of ``best_hits`` as by ``retrieval.by_source``.

    With ``shown``, also the ids of so many chunks of a source in order of rank, chunks, and the first kind of these, source_kind. With
    ``fused``, the number of sources and the constant of a reciprocal rank fusion of the lists, whose result is returned; ``by_vectors`` tells that the second list is of a vector search, ranked as by ``retrieval.vector_sources``."""
    shape = f"question_id {kinds['question_id']}, source_path string, score double, {'n_lists' if fused else 'n_chunks'} bigint, source_rank bigint"
    names = ["question_id", "source_path", "score", "n_lists" if fused else "n_chunks", "source_rank"]
    if shown:
        shape, names = shape + f", chunks array<{kinds['chunk_id']}>, source_kind string", [*names, "chunks", "source_kind"]

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _by_question(batches):
            starts = _starts(block.column("question_id"))
            question = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(block))))
            source = block.column("source_path").dictionary_encode().indices.to_numpy()
            n_list = block.column("list").to_numpy() if fused else np.zeros(len(block), np.int64)
            scores, ranks = block.column("score").to_numpy(), block.column("rank").to_numpy()
            rows = np.lexsort((ranks, source, n_list, question))
            changes = np.flatnonzero(np.any([np.diff(x[rows]) != 0 for x in (question, n_list, source)], axis=0)) + 1
            begin = np.append(0, changes)
            sizes = np.diff(np.append(begin, len(rows)))
            within, own = np.arange(len(rows)) - np.repeat(begin, sizes), scores[rows]
            sums = np.maximum.reduceat(own, begin) + weight * np.add.reduceat(np.where((within > 0) & (within <= following), own, 0.0), begin)
            lead = rows[begin]
            if by_vectors:
                three = np.add.reduceat(np.where(within < 3, own, 0.0), begin) / np.minimum(sizes, 3)
                sums = np.where(n_list[lead] == 1, np.maximum.reduceat(own, begin) + 0.10 * three + 0.02 * np.minimum(sizes, 3), sums)
            search = question[lead] * 2 + n_list[lead]
            order = np.lexsort((ranks[lead], -np.round(sums, 9), search))
            place = _numbered(order, search)
            order, place = order[place <= best], place[place <= best]
            if fused:
                lead, listed, parts = lead[order], n_list[lead[order]], 1.0 / (fused[1] + place)
                again = np.lexsort((listed, source[lead], question[lead]))
                lead, listed, parts, place = lead[again], listed[again], parts[again], place[again]
                begin = np.append(0, np.flatnonzero((np.diff(question[lead]) != 0) | (np.diff(source[lead]) != 0)) + 1)
                sums, counts = np.add.reduceat(parts, begin), np.diff(np.append(begin, len(lead)))
                lead, first = lead[begin], listed[begin] * 1_000_000 + place[begin]
                order = np.lexsort((first, -np.round(sums, 9), question[lead]))
                place = _numbered(order, question[lead])
                order, place = order[place <= fused[0]], place[place <= fused[0]]
            else:
                counts = sizes
            at = pa.array(lead[order])
            columns = [block.column("question_id").take(at), block.column("source_path").take(at), pa.array(sums[order]), pa.array(counts[order].astype(np.int64)), pa.array(place.astype(np.int64))]
            if shown:
                n = np.minimum(sizes[order], shown)
                offsets = np.append(0, np.cumsum(n))
                some = pa.array(rows[np.repeat(begin[order] - offsets[:-1], n) + np.arange(offsets[-1])])
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), block.column("chunk_id").take(some)))
                told = block.column("source_kind").take(some).to_pylist()
                columns.append(pa.array([next((k for k in told[a:z] if k is not None), None) for a, z in zip(offsets, offsets[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return shape, rank


def named(names: pa.Array, ids: pa.Array, given: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of (place of the question, places of the chunks, their scores)."""
    place = np.repeat([q for q, _, _ in given], [len(x) for _, x, _ in given])
    rows, scores = np.concatenate([x for _, x, _ in given]), np.concatenate([x for _, _, x in given])
    return pa.RecordBatch.from_arrays([names.take(pa.array(place)), ids.take(pa.array(rows)), pa.array(scores)], names=["question_id", "chunk_id", "score"])


def shared(rows: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """``rows`` with the overlap of each of the texts with the question of its row, instead of its text, tokens and qtfs:
    the shared counts over both norms."""
    kept, names = [c for c in rows.columns if c not in ("text", "tokens", "qtfs")], list(texts)

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            asked = [dict(zip(t or (), n or ())) for t, n in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist())]
            columns = list(batch.columns[: len(kept)])
            for k in range(len(names)):
                out = []
                for question, text in zip(asked, batch.column(len(kept) + 2 + k).to_pylist()):
                    own = _tokens(text, codes)
                    same = sum(min(question[token], own[token]) for token in question.keys() & own.keys())
                    out.append(same / ((sum(n * n for n in question.values()) * sum(n * n for n in own.values())) ** 0.5) if same else 0.0)
                columns.append(pa.array(out, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    kinds = dict(rows.dtypes)
    shape = ", ".join([f"`{c}` {kinds[c]}" for c in kept] + [f"{c} double" for c in names])
    return rows.select(*kept, "tokens", "qtfs", *[T.lowered(text).alias(f"t{k}") for k, text in enumerate(texts.values())]).mapInArrow(overlap, shape)


# -- overlap of texts and paths with bonuses, by source -----------------------------------------------------------------

#: A word of a span with other ASCII signs on both sides: a text that holds the span has it as a token.
_WITHIN = re.compile(r"(?<=[\x00-\x7f])(?<![a-z0-9])[a-z0-9]{2,}(?=[\x00-\x7f])(?![a-z0-9])")


def _unjoined(lowered: str) -> str:
    if not lowered.isascii():
        for joined, letters in T.LIGATURES:
            lowered = lowered.replace(joined, letters)
    return lowered


def _tokens(lowered: str, codes: Codes) -> Counter:
    """Counts of the tokens of a lowered text, with those that the rules of synonyms add."""
    counts = codes.counts(_unjoined(lowered))
    have = counts.keys() & _TRIGGERS
    if have:
        counts.update(synonyms(have))
    return counts


_TRIGGERS = frozenset(T.TRIGGERS)


def token_frequencies(texts: DataFrame) -> DataFrame:
    """(token, df): rows of ``texts``, two lower-cased columns, that have a token in either."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, found = Codes(), Counter()
        for batch in batches:
            for pair in zip(*(c.to_pylist() for c in batch.columns)):
                found.update(_tokens(pair[0], codes).keys() | _tokens(pair[1], codes).keys())
            if len(found) >= KNOWN:
                yield _found(found)
                found = Counter()
        yield _found(found)

    return texts.mapInArrow(count, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("df"))


def _found(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["token", "n"])


def overlapping(rows: DataFrame, given: list[str], idf: dict[str, float], once: float, spans: list[str]) -> DataFrame:
    """(chunk_id, source_path, source_kind, extension) of ``rows``, which end with the lower-cased text and path, and of
    either the norm, n0, and codes and counts of the given tokens, ids0 and tfs0; and the places of the ``spans`` that are in
    the path, in0, or else in the text, in1. Tokens without an idf have that of a token of one row, ``once``."""
    shared = rows.sparkSession.sparkContext.broadcast((given, idf, spans))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights, looked = shared.value
        code = {token: k for k, token in enumerate(asked)}
        by_word: dict[str, list[int]] = {}
        always = []
        for k, span in enumerate(looked):
            inner = [w for w in _WITHIN.findall(span) if is_token(w)]
            if inner:
                by_word.setdefault(max(inner, key=len), []).append(k)
            else:
                always.append(k)
        codes, keys = Codes(), frozenset(by_word)
        for batch in batches:
            columns, found = list(batch.columns[:4]), []
            for n in (4, 5):
                norms, counts, held = [], [], []
                for text in batch.column(n).to_pylist():
                    own = _tokens(text, codes)
                    norms.append(sum((tf * weights.get(token, once)) ** 2 for token, tf in own.items()) ** 0.5)
                    counts.append({code[token]: own[token] for token in own.keys() & code.keys()})
                    maybe = always + [k for word in own.keys() & keys for k in by_word[word]]
                    held.append({k for k in maybe if looked[k] in text})
                columns += [pa.array(norms, pa.float64()), *_lists([0] * len(norms), counts)[1:]]
                found.append(held)
            columns += [_lists([], [dict.fromkeys(x, 1) for x in found[1]])[1], _lists([], [dict.fromkeys(x - y, 1) for x, y in zip(*found)])[1]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["chunk_id", "source_path", "source_kind", "extension", *(f"{c}{k}" for k in (0, 1) for c in ("n", "ids", "tfs")), "in0", "in1"]
    kind = ", ".join(f"n{k} double, ids{k} array<int>, tfs{k} array<int>" for k in (0, 1))
    return written(rows.mapInArrow(count, f"chunk_id {dict(rows.dtypes)['chunk_id']}, source_path string, source_kind string, extension string, {kind}, in0 array<int>, in1 array<int>"), "overlaps")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows in order of source_path, all rows of a source in one."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(map(len, kept)) >= BLOCK:
            block = pa.concat_batches(kept)
            last = _starts(block.column(1))[-1]
            if last:
                yield block.slice(0, last)
                kept = [block.slice(last)]
            else:
                kept = [block]
    if kept and sum(map(len, kept)):
        yield pa.concat_batches(kept)


def _starts(paths: pa.Array) -> np.ndarray:
    codes = paths.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])


def source_scores(overlaps: DataFrame, questions: list[tuple], n_spans: int, least: float, weight: float, following: int, best: int, shape: str) -> DataFrame:
    """(question_id, source_path, score, n_chunks, top, first_chunk): the best chunk of a source plus ``weight`` times the next
    ``following``, of its chunks from ``least`` on; ``top`` is the best score and ``first_chunk`` the first chunk that has it.
    Only what can be among the ``best`` sources of a question leaves a block.

    A question is (id, tokens of either text as (code, count, weight), bonuses by kind, by extension, by span in paths and in texts).
    """
    shared = overlaps.sparkSession.sparkContext.broadcast(questions)
    most = max((code for q in questions for text in q[1] for code, _, _ in text), default=0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole(batches):
            ids = block.column(0).to_pylist()
            place = np.empty(len(ids), np.int64)
            place[sorted(range(len(ids)), key=ids.__getitem__)] = np.arange(len(ids))
            starts = _starts(block.column(1))
            ends = np.append(starts[1:], len(ids))
            fields = []
            for k in (0, 1):
                first, rows, tf = inverted(block.column(5 + 3 * k), block.column(6 + 3 * k), most)
                fields.append((first, rows, tf, 1 / block.column(4 + 3 * k).to_numpy()[rows]))
            having = [_having(block.column(k).to_pylist()) for k in (2, 3)]
            held = [inverted(block.column(k), block.column(k), n_spans)[:2] for k in (10, 11)]
            total, out = np.zeros(len(ids)), []
            for name, tokens, *bonuses in shared.value:
                total[:] = 0.0
                for (first, rows, tf, inverse), own in zip(fields, tokens):
                    for code, qtf, weight_ in own:
                        if (a := first[code]) < (z := first[code + 1]):
                            total[rows[a:z]] += weight_ * np.minimum(tf[a:z], qtf) * inverse[a:z]
                for by, own in zip(having, bonuses[:2]):
                    for value, bonus in own:
                        if value in by:
                            total[by[value]] += bonus
                for (first, rows), own in zip(held, bonuses[2:]):
                    for span, bonus in own:
                        total[rows[first[span] : first[span + 1]]] += bonus
                tops = np.maximum.reduceat(total, starts)
                some = np.flatnonzero(np.round(tops, 9) >= least)
                if len(some) > best:
                    # a source has at least its best score and at most that of as many equal ones
                    floor = np.partition(tops[some], -best)[-best]
                    some = some[tops[some] * (1 + weight * following) >= floor - NEAR]
                if not len(some):
                    continue
                sizes = ends[some] - starts[some]
                source = np.repeat(np.arange(len(some)), sizes)
                rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[some], sizes)
                valued = np.round(total[rows], 9)
                kept = valued >= least
                source, rows, valued = source[kept], rows[kept], valued[kept]
                order = np.lexsort((place[rows], -valued, source))
                source, rows = source[order], rows[order]
                begin = np.searchsorted(source, np.arange(len(some)))
                within = np.arange(len(rows)) - begin[source]
                own = total[rows]
                sums = np.add.reduceat(np.where(within == 0, own, np.where(within <= following, weight * own, 0.0)), begin)
                counts = np.diff(np.append(begin, len(rows)))
                lead = rows[begin]
                if len(some) > best:
                    at = np.flatnonzero(sums >= np.partition(sums, -best)[-best] - NEAR)
                    if len(at) > best + 16:  # many equal ones
                        at = at[np.lexsort((place[lead[at]], -np.round(total[lead[at]], 9), -np.round(sums[at], 9)))[:best]]
                    sums, counts, lead = sums[at], counts[at], lead[at]
                out.append((name, sums, counts, lead, total[lead]))
            if out:
                lead = pa.array(np.concatenate([x[3] for x in out]))
                names = [x[0] for x in out for _ in x[1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), block.column(1).take(lead), pa.array(np.concatenate([x[1] for x in out])), pa.array(np.concatenate([x[2] for x in out])), pa.array(np.concatenate([x[4] for x in out])), block.column(0).take(lead)],
                    names=["question_id", "source_path", "score", "n_chunks", "top", "first_chunk"])

    # one source may be cut by no task: all its rows are hashed to one and sorted there
    ordered = overlaps.where("chunk_id IS NOT NULL").repartition("source_path").sortWithinPartitions("source_path")
    return ordered.mapInArrow(score, shape)


def _having(values: list) -> dict:
    out: dict = {}
    for row, value in enumerate(values):
        out.setdefault(value, []).append(row)
    return {value: np.array(rows) for value, rows in out.items()}
