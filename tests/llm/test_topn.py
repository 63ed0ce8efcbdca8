import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakebind.llm.topn import top_n_per_group

SCHEMA = "source_path string, score double, chunk_id string, hit_id bigint, g string, s string, salt string"


def brute(rows, n):
    seen = {}
    for g, s, t, i, *_ in rows:
        if g and s is not None and s == s and i is not None:
            seen[g, i, t] = max(s, seen.get((g, i, t), -float("inf")))
    out = set()
    for group in {k[0] for k in seen}:
        own = sorted(((-s, t is None, (t or "").encode(), i) for (g, i, t), s in seen.items() if g == group))
        out |= {(group, i) for *_, i in own[:n]}
    return out


def got(spark, rows, n, fanout=128):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return {(r["source_path"], r["hit_id"]) for r in top_n_per_group(frame, "source_path", "score", "chunk_id", "hit_id", n, fanout).collect()}


def test_ties_nulls_repeats_and_a_hot_group(spark):
    dice = random.Random(3)
    rows = [("hot", dice.choice([0.5, 0.5, 0.25, -0.0, 0.0, float("inf"), -float("inf")]), dice.choice(["aaaaaaaa", "aaaaaaab", "aaaaaaaaé", "", None]), k) for k in range(1500)]
    rows += [(f"g{k % 40}", dice.choice([1.0, 2.0, None, float("nan")]), f"c{k % 3}", k + 10_000) for k in range(400)]
    rows += [("", 9.0, "c", 1), (None, 9.0, "c", 2), ("n", 1.0, "c", None), ("one", 1e308, "c", 5), ("one", -1e308, "c", 6), ("one", 0.0, "c", 7)]
    rows += rows[:300]
    for n in (1, 5):
        assert got(spark, rows, n) == brute(rows, n)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from([0.1, 0.2, 5e-324, 1.0]), st.sampled_from(["x", "xy", "é" * 9]), st.integers(-(2**63), 2**63 - 1)), min_size=1, max_size=30))
def test_against_sorting(spark, rows):
    assert got(spark, rows, 3, 4) == brute(rows, 3)


def test_empty_and_wrong_arguments(spark):
    assert got(spark, [], 5) == set()
    with pytest.raises(ValueError):
        top_n_per_group(spark.createDataFrame([], SCHEMA), "source_path", "score", "chunk_id", "hit_id", 0)


def test_very_long_ids_cost_no_more(spark):
    long = "x" * 12_000
    rows = [("a", 1.0, long + f"{k:03d}", k) for k in range(40)] + [("a", 1.0, long, 99), ("b", 0.5, "y", 1), ("b", 0.5, None, 2), ("b", 0.5, "y\0", 3), ("b", 0.5, "", 4)]
    for n in (3, 7):
        assert got(spark, rows, n) == brute(rows, n)
