"""Embedding near-duplicates and components against brute force."""

import math
import random

import numpy as np
import pytest

from talentlake.llm.collisions import collisions, least_collisions, near_duplicates
from talentlake.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, size int, own string"


def brute(rows, threshold):
    """(n_links, least id of the component) of every row."""
    def usable(r):
        v = r[1]
        return r[2] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    x = {i: np.array(r[1], dtype=np.float32).astype(float) for i, r in enumerate(rows) if usable(r)}
    near = {i: set() for i in range(len(rows))}
    for i in x:
        for j in x:
            if i != j and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / (np.linalg.norm(x[i]) * np.linalg.norm(x[j])) >= threshold:
                    near[i].add(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids, default=None)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    base = rng.standard_normal((40, 64)) / 8
    for i in range(300):
        v = base[i % 40] + rng.standard_normal(64) / 8 * rng.choice([0, 0.2, 0.35, 0.5])
        out.append((1000 - i, v.tolist(), i % 3 if i % 7 else None))
    out += [(2000 + i, out[5][1], out[5][2]) for i in range(30)] + [out[5]] * 3
    out += [(1, None, 1), (2, [], 1), (3, [0.0] * 64, 1), (4, [float("nan")] * 64, 1), (5, [1.0, None] * 32, 1)]
    out += [(6, [float("inf")] * 64, 1), (7, [1.0, 2.0], 1), (8, [1.0, 2.1], 1), (None, [1.0, 2.0], 1), (9, [2.0, 4.0], 1)]
    return out


def test_against_all_pairs(spark, rows):
    df = spark.createDataFrame([(*r, "n", 1, "o") for r in rows], SCHEMA)
    for block in (2048, 16):
        found = near_duplicates(df, block=block).collect()
        assert sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in found], key=repr) == brute(rows, 0.93)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert sum(n for _, n, _ in brute(rows, 0.93)) > 1000


def test_empty_table(spark, rows):
    df = spark.createDataFrame([(*r, "n", 1, "o") for r in rows[:1]], SCHEMA).limit(0)
    assert near_duplicates(df).collect() == []


def test_collision_counts():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((50, 8)), rng.standard_normal((70, 8))
    plain = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.4).sum(axis=2)
    assert (collisions(a, b, 0.4) == plain).all()
    assert 0 < least_collisions() < 24


def test_components_against_search(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges += [(1000, 1000 + i) for i in range(300)] + [(5000 + i, 5001 + i) for i in range(60)] + [(7, 7)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    expected = {}
    for start in sorted(near):
        todo = [start] if start not in expected else []
        while todo:
            if (node := todo.pop()) not in expected:
                expected[node] = start
                todo += near[node]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == expected
    assert len(found) == len(expected)
