import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakebind.llm.split import pieces, split_oversized


def check(text, limit, overlap):
    cuts = pieces(text, limit, overlap)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert all(0 < b - a <= limit or not text for a, b in cuts)
    assert all(b - c == overlap for (_, b), (c, _) in zip(cuts, cuts[1:]))
    assert all(y > x for (x, _), (y, _) in zip(cuts, cuts[1:]))
    return cuts


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é.\n,́📊", max_size=400), st.integers(1, 60), st.data())
def test_pieces_cover_and_overlap(text, limit, data):
    check(text, limit, data.draw(st.integers(0, limit - 1)))


def test_cuts_fall_on_pauses():
    sentences = " ".join(f"Sentence number {k} ends here." for k in range(200))
    assert all(sentences[:b].endswith(". ") for _, b in check(sentences, 400, 50)[:-1])
    paragraphs = "\n\n".join("word " * 40 for _ in range(12))
    assert all(paragraphs[:b].endswith("\n\n") for _, b in check(paragraphs, 450, 0)[:-1])


def test_very_long_and_unbroken_texts():
    check("x" * 50_000, 1200, 150)
    check(" ".join(random.Random(1).choices(["a", "bb", "ccc."], k=60_000)), 1200, 150)
    with pytest.raises(ValueError):
        pieces("abc", 2, 2)


def test_operator(spark):
    rows = [("a", "x" * 5, 5, 1, "k"), ("b", "x" * 6, 5, 1, "k"), ("b", "x" * 6, 5, 1, "k"), ("c", None, 5, 1, "k"), ("d", "", 5, 1, "k"), (None, "x" * 9, 5, 1, "k"), ("e", "x" * 9, None, 1, "k"), ("f", "é" * 7, 5, None, "k")]
    frame = spark.createDataFrame(rows, "chunk_id string, text string, l int, o int, k string")
    got = sorted(map(tuple, split_oversized(frame, "chunk_id", "text", "l", "o").collect()))
    assert {r[0] for r in got} == {"b", "f"} and all(len(r[4]) <= 5 for r in got)
    assert split_oversized(frame.limit(0), "chunk_id", "text", "l", "o").count() == 0
