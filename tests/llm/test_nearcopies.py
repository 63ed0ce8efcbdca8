import random
import re
from itertools import combinations

import numpy as np

from lakebind.llm.nearcopies import alike_pairs, groups, near_copies, within


def test_bit_sliced_distances():
    dice = np.random.default_rng(1)
    left = dice.integers(0, 256, (3000, 32), dtype=np.uint8)
    right = left.copy()
    flipped = dice.random((3000, 32)) < dice.random((3000, 1))
    right[flipped] ^= dice.integers(0, 256, flipped.sum(), dtype=np.uint8)
    radius = dice.integers(0, 300, 3000)
    assert np.array_equal(within(left, right, radius, 512), np.bitwise_count(left ^ right).sum(1) <= radius)
    assert len(within(left[:0], right[:0], radius[:0])) == 0


def brute(rows, likeness, run, least):
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        if key and len(words) >= least:
            sets[key] = {tuple(words[k : k + run]) for k in range(len(words) - run + 1)}
    return {tuple(sorted(p)) for p in combinations(sets, 2) if len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]) >= likeness}


def test_all_pairs_are_found(spark):
    dice = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(60):
        base = dice.choices(words, k=dice.randint(18, 70))
        rows.append((f"a{k}", " ".join(base)))
        for j in range(dice.randint(0, 4)):
            copy = base[:]
            for _ in range(dice.randint(0, 6)):
                copy[dice.randrange(len(copy))] = dice.choice(words)
            rows.append((f"a{k}-{j}", " ".join(copy).upper() if j == 1 else " ".join(copy)))
    rows += [(f"same{k}", "one and the same text for all " * 5) for k in range(12)] + [("n", None), ("e", ""), ("s", "few words"), (None, "x y z " * 10)]
    rows += rows[:20]
    frame = spark.createDataFrame([(*r, "c", "p") for r in rows], "chunk_id string, text string, class string, payload string")
    members, links = near_copies(frame, "chunk_id", "text", 0.6, 3, 20)
    got = {(r["chunk_id_a"], r["chunk_id_b"]) for r in alike_pairs(members, links, "chunk_id").collect()}
    truth = brute(dict(rows).items(), 0.6, 3, 20)
    assert got == truth and len(truth) > 60
    found = {}
    for r in groups(members, links, "chunk_id").collect():
        found.setdefault(r["group_id"], set()).add(r["chunk_id"])
    parent = {k: {k} for s in found.values() for k in s}
    for a, b in truth:
        merged = parent[a] | parent[b]
        for k in merged:
            parent[k] = merged
    assert {frozenset(s) for s in found.values()} == {frozenset(s) for s in parent.values()}


def test_hot_runs_use_the_grid(spark, monkeypatch):
    import lakebind.llm.nearcopies as N

    tail = " ".join(f"common{k}" for k in range(30))
    rows = [(f"k{j}", f"{tail} own{j} word{j}") for j in range(40)]
    frame = spark.createDataFrame(rows, "chunk_id string, text string")
    monkeypatch.setattr(N, "HOT", 8)
    members, links = N.near_copies(frame, "chunk_id", "text", 0.6, 3, 20)
    assert {(r["chunk_id_a"], r["chunk_id_b"]) for r in N.alike_pairs(members, links, "chunk_id").collect()} == brute(rows, 0.6, 3, 20)


def test_empty(spark):
    members, links = near_copies(spark.createDataFrame([], "chunk_id string, text string"), "chunk_id", "text")
    assert members.count() == 0 and links.count() == 0 and alike_pairs(members, links, "chunk_id").count() == 0


def test_bitmaps_of_longer_texts_are_wider_and_fold():
    import lakebind.llm.nearcopies as N

    dice = np.random.default_rng(2)
    sizes = np.array([100, 400, 2000, 5000, 150])
    owner = np.repeat(np.arange(5), sizes)
    hashes = dice.integers(0, 2**63, len(owner)).astype(np.uint64)
    maps = N.bitmaps_of(owner, hashes, sizes)
    assert [8 * len(m) for m in maps] == [256, 1024, 4096, 16384, 256]
    for bits in (256, 1024, 4096):
        row, rows = N.folded(b"".join(maps), sizes, bits)
        assert [r >= 0 for r in row] == [8 * len(m) >= bits for m in maps]
        for k in np.flatnonzero(row >= 0):
            own = np.bincount(((hashes[owner == k] >> np.uint64(17)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
            assert np.array_equal(np.packbits(own.astype(np.uint8)), rows[row[k]])
    # unlike texts of any length are told apart, so the comparison rejects what shares one run only
    for size in (150, 600, 2400):
        one, two = (N.bitmaps_of(np.zeros(size, dtype=np.int64), dice.integers(0, 2**63, size).astype(np.uint64), np.array([size]))[0] for _ in range(2))
        a, b = (np.frombuffer(m, dtype=np.uint8)[None] for m in (one, two))
        assert not N.within(a, b, np.array([2 * size - 2 * int(np.ceil(2 * size * 0.6 / 1.6))]))[0]


def test_a_full_sketch_and_long_texts_lose_nothing(spark, monkeypatch):
    import lakebind.llm.nearcopies as N

    dice = random.Random(6)
    words = [f"w{k}" for k in range(900)]
    rows = []
    for k in range(40):
        base = dice.choices(words, k=dice.choice([30, 200, 700, 3000]))
        rows.append((f"a{k}", " ".join(base)))
        for j in range(2):
            copy = base[:]
            for _ in range(dice.randint(0, len(base) // 8)):
                copy[dice.randrange(len(copy))] = dice.choice(words)
            rows.append((f"a{k}-{j}", " ".join(copy)))
    monkeypatch.setattr(N, "COUNTS", 16)  # many runs in each slot, as in a collection of many times the size
    frame = spark.createDataFrame(rows, "chunk_id string, text string")
    members, links = N.near_copies(frame, "chunk_id", "text", 0.6, 3, 20)
    assert {(r["chunk_id_a"], r["chunk_id_b"]) for r in N.alike_pairs(members, links, "chunk_id").collect()} == brute(rows, 0.6, 3, 20)
