"""Line dedup against all pairs of lines."""

import random

import numpy as np
import pytest

from talentlake.llm.line_dedup import Hashed, line_words, repeated_lines, within_one, without_repeats

SCHEMA = "doc_id bigint, text string, row string, removed string, n_chars bigint, near int"


def distance(a, b):
    """Edit distance of two word lists."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, min_words=8):
    """Removed line numbers of each (id, text)."""
    lines = []
    for doc_id, text in set(rows):
        for k, line in enumerate((text or "").split("\n")):
            words = line_words(line)
            if words:
                lines.append(((doc_id is None, doc_id or 0, k), (doc_id, text), k, words))
    out = {row: [] for row in rows}
    for order, row, k, words in lines:
        for other, _, _, earlier in lines:
            edits = 1 if min(len(words), len(earlier)) >= min_words else 0
            if other < order and abs(len(words) - len(earlier)) <= edits and distance(words, earlier) <= edits:
                out[row].append(k)
                break
    return {row: sorted(ks) for row, ks in out.items()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randrange(7, 14))] for _ in range(25)]
    pool.append(["a"] * 9)

    def line():
        words = list(rng.choice(pool))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at, kind = rng.randrange(len(words)), rng.randrange(3)
            words[at : at + (kind != 0)] = [] if kind == 2 else [rng.choice(vocabulary)]
        return " ".join(words).upper() if rng.random() < 0.1 else " ".join(words)

    out = [(i, "\n".join(line() for _ in range(rng.randrange(1, 6)))) for i in range(90)]
    family = [rng.choice(vocabulary) for _ in range(12)]
    out += [(500 + i, "short line\n\n" + " ".join([*family[:5], f"n{i}", *family[6:]])) for i in range(60)]
    out += [(900, None), (901, ""), (902, "\n \n"), (None, out[3][1]), (903, " ".join(["w"] * 5000)), (904, " ".join(["w"] * 5001))]
    return out + out[:4]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "x", len(r[1] or ""), 3) for r in rows], SCHEMA)


def test_against_all_pairs(spark, rows):
    expected = brute(rows)
    docs = frame(spark, rows)
    by_key = {(r["doc_id"], r["text_hash"]): r["removed"] for r in repeated_lines(docs).collect()}
    keys = docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) h").collect()
    assert {(k["doc_id"], k["text"]): by_key.get((k["doc_id"], k["h"]), []) for k in keys} == expected
    assert sum(map(len, expected.values())) > 150

    left = without_repeats(docs, size="n_chars")
    assert left.columns == docs.columns
    out = left.collect()
    found = sorted(((r["doc_id"], r["text"]) for r in out), key=repr)
    plain = []
    for row in rows:
        kept = "\n".join(x for k, x in enumerate((row[1] or "").split("\n")) if k not in expected[row])
        if not expected[row]:
            plain.append(row)
        elif kept.split():
            plain.append((row[0], kept))
    assert found == sorted(plain, key=repr)
    assert all(r["n_chars"] == len(r["text"] or "") for r in out)


def test_empty_table(spark, rows):
    assert repeated_lines(frame(spark, rows).limit(0)).collect() == []


def test_variant_hashes_are_those_of_the_shorter_line():
    lines = [[f"w{i}" for i in range(n)] for n in (8, 9, 300)]
    hashed = Hashed(lines)
    for i, line in enumerate(lines):
        places = np.arange(len(line))
        shorter = Hashed([line[:p] + line[p + 1 :] for p in places])
        assert (hashed.variants(np.full(len(line), i), places) == shorter.whole()).all()


def test_within_one():
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.choice("xyz") for _ in range(rng.randrange(6))]
        b = [rng.choice("xyz") for _ in range(rng.randrange(6))]
        assert within_one(a, b) == (distance(a, b) <= 1)
