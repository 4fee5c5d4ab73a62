"""Spelling variants against plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

from talentlake.llm.spelling import variants

SCHEMA = "doc_id bigint, text string, word string, n int, block string, job string, root string, form string"


def near(a, b):
    """Whether exactly one letter inserted, deleted or replaced turns a into b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows, min_count):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= min_count}
    forms, out = {}, []
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x)) if found else None
        forms[w] = best if best and words[best] >= 5 * n else None
        out.append((w, n, len(found)))
    def root(w):
        while forms[w]:
            w = forms[w]
        return w
    return sorted((w, forms[w], root(w), n, k, words[forms[w]] if forms[w] else None) for w, n, k in out)


def rows_of(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "b", "j", "r", "f") for i, t in rows], SCHEMA)


def corpus(seed, n=150):
    chosen = random.Random(seed)
    stems = ["".join(chosen.choices("abéß", k=chosen.randrange(5, 9))) for _ in range(60)]
    weights = [1 / (i + 1) ** 2 for i in range(len(stems))]
    out = []
    for i in range(n):
        words = []
        for stem in chosen.choices(stems, weights, k=chosen.randrange(0, 120)):
            if chosen.random() < 0.1:
                k = chosen.randrange(len(stem))
                stem = stem[:k] + chosen.choice(["", "a", "é", "xy"]) + stem[k + 1 :]
            words.append(stem.title() if chosen.random() < 0.2 else stem)
        out.append((i, chosen.choice([" ", ", ", "0", "—"]).join(words)))
    return out


def test_against_plain_comparison(spark):
    rows = corpus(5) + [(None, "abcabcd " * 30 + "abcabce"), (None, None), (900, ""), (901, "×÷ÀÖ×÷ÀÖ " * 9), (902, "ab" * 30000)]
    rows += [(903, "abcabcde zzzzzz")] * 6
    for min_count in (1, 5):
        expected = plain(rows, min_count)
        assert any(row[1] for row in expected)
        assert rows_of(variants(frame(spark, rows), min_count=min_count)) == expected


def test_crowded_blocks_are_dealt_into_slices(spark):
    rows = corpus(6, 40)
    expected = plain(rows, 1)
    assert rows_of(variants(frame(spark, rows), min_count=1, slice_words=2)) == expected
    assert rows_of(variants(frame(spark, rows), min_count=1, slice_letters=20)) == expected


def test_chain_of_forms(spark):
    text = " ".join(["banana"] * 625 + ["bananaa"] * 125 + ["bananaaa"] * 25 + ["bananaaaa"] * 5)
    found = {r[0]: r[1:3] for r in rows_of(variants(frame(spark, [(7, text)])))}
    assert found["bananaaaa"][1] == "banana" and found["bananaaaa"][0] == "bananaaa"


def test_empty_table(spark):
    assert variants(frame(spark, [])).collect() == []
    assert variants(frame(spark, [(1, None), (2, "short")])).collect() == []
