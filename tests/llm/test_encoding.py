import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakebind.llm.encoding import cuts, encode_chunks, encode_corpus
from lakebind.llm.packing import best_fit, count_tokens, pack
from lakebind.llm.tokens import BYTE_BPE_50K, byte_bpe, encode

CODER = byte_bpe(BYTE_BPE_50K)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 1é'.\n\t ​文📊́s"), max_size=120), st.lists(st.integers(0, 120), max_size=6))
def test_any_cuts_are_repaired(text, places):
    places = sorted({p for p in places if 0 < p < len(text)})
    assert np.array_equal(encode_chunks(CODER, text, places, lambda s: encode(CODER, s)), encode(CODER, text))


def test_cuts_depend_on_content_only():
    dice = random.Random(5)
    passage = " ".join(dice.choices(["alpha", "beta", "gamma", "delta", "épsilon"], k=3000))
    alone, shifted = cuts([passage, "an unrelated opening " + passage])
    assert len(alone) > 20
    assert len(set(alone + len("an unrelated opening ")) & set(shifted)) >= len(alone) - 1


def test_operator_equals_direct_encoding(spark):
    dice = random.Random(6)
    copy = " ".join(dice.choices(["one", "two", "drei"], k=800))
    texts = [copy] * 60 + [None, "", " ", "x" * 30_000, "文字" * 3000, "<|endoftext|>", "it's  a\n\ntest"] + [" ".join(dice.choices(["a", "bc", "def's", "9"], k=300)) + copy for _ in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 AS k", "2 AS cuts")
    rows = {r["doc_id"]: r["ids"] for r in encode_corpus(frame, "doc_id", "text").collect()}
    assert rows == {k: CODER.encode_ordinary(t) if t else [] for k, t in enumerate(texts)}
    assert encode_corpus(frame.limit(0), "doc_id", "text").count() == 0
    counted = {r["doc_id"]: r["n_tokens"] for r in count_tokens(frame, "doc_id", "text").collect()}
    assert counted == {k: len(v) for k, v in rows.items()}


def test_best_fit():
    sizes = np.array([60, 50, 40, 30, 20])
    where = best_fit(sizes, 100)
    assert np.bincount(where, weights=sizes).max() <= 100 and where.max() == 1


def test_packing(spark):
    dice = random.Random(8)
    rows = [(k, dice.randint(0, 90), 0) for k in range(3000)] + [(5000, 250, 0), (5001, 200, 0), (5002, 0, 0), (7, 1, 0), (None, 5, 0), (6000, None, 0), (6001, -1, 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, n bigint, container int")
    out = pack(frame, "doc_id", "n", 100).collect()
    sizes = {}
    for k, n, _ in rows:
        if k is not None and n is not None and n >= 0:
            sizes[k] = max(n, sizes.get(k, 0))
    assert {k: sum(r["piece_size"] for r in out if r["doc_id"] == k) for k in (5000, 5001, 7)} == {5000: 250, 5001: 200, 7: sizes[7]}
    assert sorted({r["doc_id"] for r in out}) == sorted(sizes)
    assert {r["doc_id"] for r in out if r["piece_no"] == 2} == {5000, 5001}
    filled = {}
    for r in out:
        filled[r["container"]] = filled.get(r["container"], 0) + r["piece_size"]
    assert max(filled.values()) <= 100
    assert len(filled) <= -(-sum(sizes.values()) // 100) * 1.01 + 2
    assert pack(frame.limit(0), "doc_id", "n", 100).count() == 0
    assert len({r["container"] for r in pack(spark.createDataFrame([(k, 60) for k in range(50)], "doc_id bigint, n bigint"), "doc_id", "n", 100).collect()}) == 50
