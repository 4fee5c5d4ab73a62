"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from talentlake.llm.jaccard import _LEAST, first_of_groups, jaccard_join, least_equal, similar_pairs
from talentlake.llm.shingles import shingles

SCHEMA = "doc_id bigint, text string, node string, first string, size int, component int"


def plain_shingles(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(rows):
    sets = [plain_shingles(r[1]) for r in rows]
    near = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                near[i].add(j)
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)

        def least(which):
            ids = [rows[j][0] for j in which if rows[j][0] is not None]
            return min(ids, default=None)

        same = [j for j in range(len(rows)) if sets[j] == sets[i]] if sets[i] else [i]
        out.append((row[0], least(same), len(near[i]), least(seen)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    for i in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 300))]
        out.append((i, " ".join(base)))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append((len(out) + 100, " ".join(copy)))
    crowd = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(80):
        copy = list(crowd)
        copy[rng.randrange(120)] = "x"
        out.append((1000 + i, " ".join(copy)))
    passage = " ".join(crowd[:60])
    out += [(2000 + i, f"{passage} {' '.join(rng.choices(vocabulary, k=60))}") for i in range(20)]
    out += [(3000, None), (3001, ""), (3002, "  \n"), (3003, "A b"), (3004, "a  B"), (None, "a b"), (3005, "a"), (3006, out[0][1].upper())]
    out += [out[3]] * 3
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "f", 1, 2) for r in rows], SCHEMA)


def test_against_all_pairs(spark, rows):
    expected = brute(rows)
    for options in ({}, {"block_classes": 10, "block_words": 500}):
        found = jaccard_join(frame(spark, rows), **options).collect()
        assert sorted([(r["doc_id"], r["class_id"], r["n_links"], r["group_id"]) for r in found], key=repr) == expected
    assert sum(n for _, _, n, _ in expected) > 2000


def test_first_of_groups(spark, rows):
    docs = frame(spark, rows)
    kept = first_of_groups(docs)
    assert kept.columns == docs.columns
    blank = [3000, 3001, 3002]
    expected = sorted([*blank, *{g for d, _, _, g in brute(rows) if d not in blank}])
    assert sorted(r["doc_id"] for r in kept.collect()) == expected
    assert first_of_groups(docs.limit(0)).collect() == []


def test_pruning_loses_nothing():
    rng = np.random.default_rng(2)
    pool = np.sort(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    base = pool[:400]
    sets = [np.unique(np.concatenate([base[k:], pool[500 : 500 + k]])) for k in range(0, 100, 3)] + [pool[1000:3000]]
    a, b = similar_pairs(sets, None)
    plain = {
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
    }
    assert set(zip(a.tolist(), b.tolist())) == plain
    assert _LEAST[20] == least_equal(20) < 16


def test_shingles():
    assert len(shingles("a b c d e f")) == 2
    assert len(shingles("")) == 0
    assert (shingles("A b") == shingles("a   B")).all()
    assert len(shingles("x " * 100)) == 1
